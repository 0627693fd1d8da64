"""Joins: positional, semi, anti, interval, nearest, containment, fuzzy, and assignments."""

from __future__ import annotations

from difflib import SequenceMatcher
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructType

#: Rows and bytes up to which a dimension is broadcast after both have been counted.
BROADCAST_ROWS, BROADCAST_BYTES = 50_000, 32 << 20


def fits(df: DataFrame, most: int = BROADCAST_ROWS) -> bool:
    """Whether df has at most `most` rows and BROADCAST_BYTES bytes; one pass over at most `most` + 1 rows tells."""
    def size(name: str, kind: str) -> Column:
        if kind in ("string", "binary"):
            return F.octet_length(name)
        return F.size(name) * 16 if kind.startswith(("array", "map")) else F.lit(16)

    row = sum((F.coalesce(size(n, k), F.lit(0)) + 16 for n, k in df.dtypes), F.lit(0)).cast("long")
    n, size_ = df.limit(most + 1).agg(F.count("*"), F.sum(row)).first()
    return n <= most and (size_ or 0) <= BROADCAST_BYTES


def small(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if it fits, else df itself."""
    return F.broadcast(df) if fits(df, most) else df


def tiles(a: DataFrame, b: DataFrame, a_key: str, b_key: str, most: int | None = None) -> DataFrame:
    """Each row of a with each row of b, for a stated query set against a table.

    A side that fits `most` rows and BROADCAST_BYTES is broadcast. Of two larger ones, both are dealt by a hash of their key into blocks
    of about `most` rows, and each block of one meets each block of the other as one key of an equi-join, so no task
    holds more than two blocks however large the tables are.
    """
    most = BROADCAST_ROWS if most is None else most
    for x, y in ((a, b), (b, a)):
        if fits(x, most):
            return y.join(F.broadcast(x), F.lit(True)).select(*a.columns, *b.columns)
    na, nb = -(-a.count() // most), -(-b.count() // most)
    deal = lambda key, n: F.pmod(F.xxhash64(key), F.lit(n)).cast("int")
    x = a.withColumn("_row", deal(a_key, na)).withColumn("_col", F.explode(F.sequence(F.lit(0), F.lit(nb - 1))))
    y = b.withColumn("_col", deal(b_key, nb)).withColumn("_row", F.explode(F.sequence(F.lit(0), F.lit(na - 1))))
    return x.join(y, ["_row", "_col"]).select(*a.columns, *b.columns)


def shared_token_pairs(a: DataFrame, a_key: str, b: DataFrame, b_key: str, tokens: str, at_least: float) -> DataFrame:
    """Pairs of different tables that share a token, with the Jaccard similarity of their token sets.

    An inverted join on equal tokens: only pairs that share one arise, and their counts are combined map-side. Sets of
    which one is so much larger that even all of the smaller would be too little are not paired.
    """
    x = a.select(a_key, F.array_distinct(tokens).alias("_t"))
    y = b.select(b_key, F.array_distinct(tokens).alias("_t"))
    xs = x.select(a_key, F.size("_t").alias("_na"), F.explode("_t").alias("_tok"))
    ys = y.select(b_key, F.size("_t").alias("_nb"), F.explode("_t").alias("_tok"))
    alike = F.least("_na", "_nb") >= at_least * F.greatest("_na", "_nb") - 1e-9
    both = xs.join(ys, "_tok").where(alike).groupBy(a_key, b_key, "_na", "_nb").agg(F.count("*").alias("_k"))
    return both.withColumn("jaccard", F.col("_k") / (F.col("_na") + F.col("_nb") - F.col("_k"))).where(F.col("jaccard") >= at_least)


def contained_terms(texts: DataFrame, key: str, text: str, terms: DataFrame, term_key: str, term: str) -> DataFrame:
    """(key, term_key) for each term that a text contains.

    Terms that fit are broadcast. More of them are joined on their first characters, as many as the shortest term has and
    four at most, with the runs of so many characters of each text; what begins alike is then compared as a whole.
    """
    t = texts.select(key, F.col(text).alias("_text"))
    d = terms.select(term_key, F.col(term).alias("_term")).where("_term <> ''")
    if fits(d):
        return t.join(F.broadcast(d), F.contains(F.col("_text"), F.col("_term"))).select(key, term_key)
    k = min(4, d.agg(F.min(F.char_length("_term"))).first()[0])
    starts = F.sequence(F.lit(1), F.char_length("_text") - (k - 1))
    runs = F.array_distinct(F.transform(starts, lambda i: F.substring(F.col("_text"), i, F.lit(k))))
    begun = t.where(F.char_length("_text") >= k).withColumn("_run", F.explode(runs))
    found = begun.join(d.withColumn("_run", F.substring("_term", 1, k)), "_run")
    return found.where(F.contains(F.col("_text"), F.col("_term"))).select(key, term_key)


def consume_once(left: DataFrame, right: DataFrame, group: list[str], name: list[str], pos: str, values: list[str]) -> DataFrame:
    """Left rows with the values of the right row of the same name and turn, else of the same position, in a group."""
    turn = Window.partitionBy(*group, *name).orderBy(pos)
    place = Window.partitionBy(*group).orderBy(pos)
    l2 = left.withColumn("_turn", F.row_number().over(turn)).withColumn("_place", F.row_number().over(place))
    r2 = right.withColumn("_turn", F.row_number().over(turn)).withColumn("_place", F.row_number().over(place))
    named = r2.select(*group, *name, "_turn", *[F.col(v).alias(f"_n_{v}") for v in values])
    placed = r2.select(*group, "_place", *[F.col(v).alias(f"_p_{v}") for v in values], F.lit(True).alias("_has"))
    out = l2.join(named, [*group, *name, "_turn"], "left").join(placed, [*group, "_place"], "left")
    return out.select(*[F.col(c) for c in left.columns], *[F.coalesce(f"_n_{v}", f"_p_{v}").alias(v) for v in values if v not in left.columns])


def bucket_width(*intervals: tuple[DataFrame, str, str]) -> float:
    """A bucket as wide as the mean interval, and at least a thousandth of the longest: an interval meets two or three
    buckets on average, and a thousand at most."""
    wide = 0.0
    for df, start, end in intervals:
        span = F.col(end).cast("double") - F.col(start).cast("double")
        mean, most = df.where(span > 0).agg(F.avg(span), F.max(span)).first()
        wide = max(wide, mean or 0.0, (most or 0.0) / 1000)
    return wide or 1.0


def overlapping(a: DataFrame, b: DataFrame, on: list[str], a_start: str, a_end: str, b_start: str, b_end: str, width: float | None = None) -> DataFrame:
    """Rows of a and b with equal `on` whose intervals share more than a point.

    Both sides are dealt to the buckets of `width` (by default, as long as their intervals are) that their intervals meet; a pair is kept
    in the first bucket that both have, so it comes once. Columns of the two must differ but for `on`.
    """
    width = bucket_width((a, a_start, a_end), (b, b_start, b_end)) if width is None else width
    bucket = lambda c: F.floor(F.col(c).cast("double") / width)
    spread = lambda df, s, e: df.where(F.col(s) < F.col(e)).withColumn("_b", F.explode(F.sequence(bucket(s), bucket(e))))
    x, y = spread(a, a_start, a_end), spread(b, b_start, b_end)
    joined = x.join(y, [*on, "_b"]).where((F.col(a_start) < F.col(b_end)) & (F.col(b_start) < F.col(a_end)))
    return joined.where(F.col("_b") == F.greatest(bucket(a_start), bucket(b_start))).drop("_b")


def first_containing(points: DataFrame, spans: DataFrame, on: list[str], point_key: list[str], value: str, start: str, end: str, order: list, width: float | None = None) -> DataFrame:
    """For each point, the first span by `order` that contains it (ends included); points without one have nulls."""
    width = bucket_width((spans, start, end)) if width is None else width
    bucket = lambda c: F.floor(F.col(c).cast("double") / width)
    s = spans.withColumn("_b", F.explode(F.sequence(bucket(start), bucket(end))))
    found = points.withColumn("_b", bucket(value)).join(s, [*on, "_b"]).where(F.col(value).between(F.col(start), F.col(end)))
    w = Window.partitionBy(*on, *point_key).orderBy(*order)
    best = found.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r", "_b", *[c for c in points.columns if c not in (*on, *point_key)])
    return points.join(best, [*on, *point_key], "left")


def nearest(a: DataFrame, b: DataFrame, on: list[str], a_key: str, a_value: str, b_value: str, b_columns: list[str]) -> DataFrame:
    """For each row of a, the row of b with equal `on` whose value is nearest; the smaller value wins a tie.

    Both are one stream ordered by value; the last b before and the first b after each a are window values, so no
    pair of rows arises but the two that are compared.
    """
    payload = F.struct(F.col(b_value).alias("v"), *b_columns)
    x = a.select(*on, F.col(a_value).alias("_v"), F.struct(*a.columns).alias("_a"), F.lit(None).cast(b.select(payload.alias("p")).schema["p"].dataType).alias("_b"), F.lit(1).alias("_side"))
    y = b.select(*on, F.col(b_value).alias("_v"), F.lit(None).cast(x.schema["_a"].dataType).alias("_a"), payload.alias("_b"), F.lit(0).alias("_side"))
    rows = x.unionByName(y)
    tie = F.coalesce(F.to_json("_b"), F.lit(""))
    w = Window.partitionBy(*on).orderBy("_v", "_side", tie)
    before = F.last("_b", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    after = F.first("_b", ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))
    near = rows.withColumn("_p", before).withColumn("_n", after).where("_side = 1")
    pick = F.when(F.col("_p").isNull(), F.col("_n")).when(F.col("_n").isNull(), F.col("_p")).when(F.col("_v") - F.col("_p.v") <= F.col("_n.v") - F.col("_v"), F.col("_p")).otherwise(F.col("_n"))
    return near.select("_a.*", pick.alias("_x")).select(*a.columns, F.col("_x.v").alias(b_value), *[F.col(f"_x.{c}").alias(c) for c in b_columns])


#: Different points, and different boxes, that meet in one task at most.
BLOCK = 10_000


def _first_holding(points: np.ndarray, boxes: np.ndarray) -> np.ndarray:
    """For each point (x, y), the place of the first box (x0, y0, x1, y1) that holds it, or -1."""
    out, left = np.full(len(points), -1), np.arange(len(points))
    for i in range(0, len(boxes), 64):
        b = boxes[i : i + 64]
        for j in range(0, len(left), 1 << 14):
            at = left[j : j + (1 << 14)]
            x, y = points[at, 0][:, None], points[at, 1][:, None]
            hit = (x >= b[:, 0]) & (x <= b[:, 2]) & (y >= b[:, 1]) & (y <= b[:, 3])
            some = hit.any(axis=1)
            out[at[some]] = i + hit[some].argmax(axis=1)
        left = left[out[left] < 0]
    return out


def smallest_covering(items: DataFrame, boxes: DataFrame, on: list[str], item_key: str, x: str, y: str, box: str, box_key: str) -> DataFrame:
    """For each point, the box of least area that holds it; of equal areas the first key.

    Equal points and equal boxes of an image count once. Both are dealt into blocks of BLOCK or so, and each block of an
    image's points meets each of its boxes, so no task holds an image that is larger. Boxes are tried by area, on the points
    that none before has held.
    """
    points = items.select(*on, item_key, F.col(x).alias("_x"), F.col(y).alias("_y")).where("_x IS NOT NULL AND _y IS NOT NULL")
    b = boxes.select(*on, F.col(box_key).alias("_key"), *[F.col(box)[k].alias(f"_{k}") for k in range(4)]).where("_0 IS NOT NULL AND _1 IS NOT NULL AND _2 IS NOT NULL AND _3 IS NOT NULL")
    p = points.select(*on, "_x", "_y").distinct()
    b = b.groupBy(*on, "_0", "_1", "_2", "_3").agg(F.min(F.struct("_key")).alias("_k"))
    b = b.select(*on, "_0", "_1", "_2", "_3", F.col("_k._key").alias("_key"), ((F.col("_2") - F.col("_0")) * (F.col("_3") - F.col("_1"))).alias("_area"))
    blocks = lambda df, name: df.groupBy(*on).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias(name))
    n = blocks(p, "_np").join(blocks(b, "_nb"), on)
    deal = lambda count, *cols: F.pmod(F.xxhash64(*cols), F.col(count)).cast("int")
    each = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    left = p.join(n, on).withColumn("_row", deal("_np", "_x", "_y")).withColumn("_col", each("_nb")).drop("_np", "_nb")
    right = b.join(n, on).withColumn("_col", deal("_nb", "_0", "_1", "_2", "_3")).withColumn("_row", each("_np"))
    mine = [f"_on{k}" for k in range(len(on))]  # names of its own, as both sides may come of one table
    right = right.select(*[F.col(c).alias(m) for c, m in zip(on, mine)], *[F.col(c).alias(c) for c in ("_row", "_col", "_0", "_1", "_2", "_3", "_key", "_area")])

    def block(of: pa.Table, by: pa.Table) -> pa.Table:
        area = np.unique(by["_area"].to_numpy(), return_inverse=True)[1]
        by = by.append_column("_rank", pa.array(area)).sort_by([("_rank", "ascending"), ("_key", "ascending")])
        ranks = []
        for v, low, high in (("_x", "_0", "_2"), ("_y", "_1", "_3")):  # as ranks, NaN is the greatest, as it is to Spark
            parts = [of[v].to_numpy(), by[low].to_numpy(), by[high].to_numpy()]
            ranks.append(np.split(np.unique(np.concatenate(parts), return_inverse=True)[1].astype("i4"), np.cumsum([len(c) for c in parts[:2]])))
        (px, x0, x1), (py, y0, y1) = ranks
        found = _first_holding(np.stack([px, py], 1), np.stack([x0, y0, x1, y1], 1))
        got, best = pa.array(np.flatnonzero(found >= 0)), pa.array(found[found >= 0])
        return pa.table([of[c].take(got) for c in (*on, "_x", "_y")] + [by[c].take(best) for c in ("_area", "_key")], names=[*on, "_x", "_y", "_area", "_key"])

    schema = StructType([*[p.schema[c] for c in (*on, "_x", "_y")], *[b.schema[c] for c in ("_area", "_key")]])
    held = left.groupBy(*on, "_row", "_col").cogroup(right.groupBy(*mine, "_row", "_col")).applyInArrow(block, schema)
    first = F.min_by("_key", F.struct("_area", "_key")).alias("_key")
    best = held.groupBy(*on, "_x", "_y").agg(first, F.min("_area").alias("_area"))
    return points.join(best, [*on, "_x", "_y"]).groupBy(*on, item_key).agg(first).select(*on, item_key, F.col("_key").alias(box_key))


def similarity(left: str, right: str) -> float:
    """1 for equal names, .93 for an equal ending of four, .9 for containment, else the matching-blocks ratio."""
    a, b = (left or "").strip().lower(), (right or "").strip().lower()
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    if len(a) >= 4 and len(b) >= 4 and a[-4:] == b[-4:]:
        return 0.93
    if a in b or b in a:
        return 0.9
    return SequenceMatcher(None, a, b).ratio()


@F.pandas_udf(StringType())
def plain_udf(text: pd.Series) -> pd.Series:
    """Texts as similarity() compares them."""
    return pd.Series([(x or "").strip().lower() for x in text], dtype=object)


@lru_cache(1 << 17)
def _ratio(a: str, b: str, at_least: float) -> float:
    """The matching-blocks ratio, or -1 if not even the letters in common come to at_least."""
    m = SequenceMatcher(None, a, b)
    return m.ratio() if m.quick_ratio() >= at_least else -1.0


@F.pandas_udf(DoubleType())
def ratio_udf(a: pd.Series, b: pd.Series, at_least: pd.Series) -> pd.Series:
    return pd.Series([_ratio(*x) for x in zip(a, b, at_least)], dtype="float64")


def fuzzy_best(items: DataFrame, cells: DataFrame, on: list[str], item_key: str, item_text: str, cell_key: str, cell_text: str, at_least: float = 0.62) -> DataFrame:
    """For each item, the cell of equal `on` whose text is most similar, at `at_least` or more.

    Each text of a group is compared once, however many rows have it: the first cell of a text stands for all. The
    ratio is taken in Python only of texts that nothing simpler tells and that are not too different in length.
    """
    raw = lambda df, text: df.withColumn("_raw", F.coalesce(F.col(text), F.lit("")))
    texts = raw(items, item_text).select(*on, "_raw").distinct().withColumn("_a", plain_udf("_raw"))
    firsts = raw(cells, cell_text).groupBy(*on, "_raw").agg(F.min(F.struct(F.col(cell_key).alias("k"))).alias("_k"))
    y = firsts.withColumn("_b", plain_udf("_raw")).groupBy(*on, "_b").agg(F.min("_k").alias("_k"))
    pairs = texts.select(*on, "_a").distinct().join(y, on)
    n, m = F.char_length("_a"), F.char_length("_b")
    told = (
        F.when((n == 0) | (m == 0), 0.0).when(F.col("_a") == F.col("_b"), 1.0)
        .when((n >= 4) & (m >= 4) & (F.substring("_a", -4, 4) == F.substring("_b", -4, 4)), 0.93)
        .when(F.contains("_a", F.col("_b")) | F.contains("_b", F.col("_a")), 0.9)
    )
    pairs = pairs.select(*pairs.columns, told.alias("score"))
    near = (F.col("score").isNull()) & (2.0 * F.least(n, m) / (n + m) >= at_least)
    scored = pairs.where(F.col("score") >= at_least).unionByName(pairs.where(near).withColumn("score", ratio_udf("_a", "_b", F.lit(at_least))))
    top = lambda df, key: df.groupBy(*on, key).agg(F.min_by(F.struct("_k", "score"), F.struct(-F.col("score"), F.col("_k"))).alias("_best"))
    best = top(scored, "_a").select(*on, "_a", "_best._k", "_best.score").where(F.col("score") >= at_least).join(texts, [*on, "_a"])
    found = top(raw(items, item_text).select(*on, item_key, "_raw").join(best.drop("_a"), [*on, "_raw"]), item_key)
    return found.select(*on, item_key, F.col("_best._k.k").alias(cell_key), "_best.score")


def match_tracks(raw: DataFrame, tracks: DataFrame, image: str) -> DataFrame:
    """raw(image, raw_pos, track_id, header) to tracks(image, track_id, pos, header): by id, else by the most similar
    header among unused tracks, else by position. One image's tracks are one group, which a page bounds."""

    def assign(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        left, right = left.sort_values("raw_pos"), right.sort_values("pos").reset_index(drop=True)
        used: set[int] = set()
        out = []
        for r in left.itertuples():
            hit = [i for i, t in enumerate(right.track_id) if t == r.track_id and r.track_id]
            how = "id"
            if not hit:
                scores = [(similarity(r.header, h), -i) for i, h in enumerate(right.header) if i not in used]
                best = max(scores, default=(0.0, 0))
                hit, how = ([-best[1]], "header") if best[0] >= 0.62 else ([], "")
            if not hit and r.raw_pos < len(right) and r.raw_pos not in used:
                hit, how = [r.raw_pos], "position"
            if hit:
                used.add(hit[0])
            out.append((key[0], r.raw_pos, right.track_id[hit[0]] if hit else None, how))
        return pd.DataFrame(out, columns=[image, "raw_pos", "track_id", "matched_by"])

    kind = raw.schema[image].dataType.simpleString()
    return raw.groupBy(image).cogroup(tracks.groupBy(image)).applyInPandas(assign, f"{image} {kind}, raw_pos long, track_id string, matched_by string")


def resolve_alias(refs: DataFrame, ref: str, entities: DataFrame, key: list[str], local_id: str, name: str, graph_id: str) -> DataFrame:
    """refs with graph_id by local id or, failing that, by name; of several entities the first by graph id counts."""
    ids = entities.select(*key, F.col(local_id).alias("_alias"), F.lit(0).alias("_rank"), F.col(graph_id).alias("_gid"))
    names = entities.select(*key, F.col(name).alias("_alias"), F.lit(1).alias("_rank"), F.col(graph_id).alias("_gid"))
    table = ids.unionByName(names).where("_alias IS NOT NULL AND _alias <> ''").groupBy(*key, "_alias").agg(F.min_by("_gid", F.struct("_rank", "_gid")).alias(graph_id))
    return refs.withColumn("_alias", F.col(ref)).join(table, [*key, "_alias"], "left").drop("_alias")


def templates_product(rows: DataFrame, sources: Column, targets: Column, keep: list[str]) -> DataFrame:
    """A row for each (source, target) of two arrays in a row."""
    return rows.select(*keep, F.explode(sources).alias("source"), targets.alias("_t")).select(*keep, "source", F.explode("_t").alias("target"))
