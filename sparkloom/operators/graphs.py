"""Graphs as entity, relation and event tables: merge, validate, assemble, correct, align."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from sparkloom.functions.scalars import clean_name, cosine, stable_id
from sparkloom.sources.scratch import drop, store


def merge_last(df: DataFrame, key: list[str], seq: str, values: list[str]) -> DataFrame:
    """One row for each key: the values of its last occurrence, at the place (pos) of its first."""
    return df.groupBy(*key).agg(F.min(seq).alias("pos"), *[F.max_by(v, seq).alias(v) for v in values], F.count("*").alias("occurrences"))


def merge_first(df: DataFrame, key: list[str], seq: str, values: list[str]) -> DataFrame:
    """One row for each key: that of its first occurrence."""
    return df.groupBy(*key).agg(F.min(seq).alias("pos"), *[F.min_by(v, seq).alias(v) for v in values])


def merge_explicit(df: DataFrame, triple: list[str], explicit: str, seq: str, values: list[str]) -> DataFrame:
    """One row for each triple: an explicit one before derived ones, then the first."""
    best = F.struct((~F.col(explicit)).cast("int"), seq)
    return df.groupBy(*triple).agg(F.bool_or(explicit).alias(explicit), *[F.min_by(v, best).alias(v) for v in values])


def merge_graphs(graphs: DataFrame) -> DataFrame:
    """graph_meta(graph_group, document_id, modality) as one row for each group: document_id only if there is one,
    modality mixed if there are several, and the number of graphs."""
    return graphs.groupBy("graph_group").agg(
        F.when(F.count_distinct("document_id") == 1, F.min("document_id")).alias("document_id"),
        F.when(F.count_distinct("modality") > 1, "mixed").otherwise(F.min("modality")).alias("modality"),
        F.count("*").alias("merged_graph_count"),
    )


def dangling(relations: DataFrame, ends: list[str], entities: DataFrame, entity: str, keep: list[str]) -> DataFrame:
    """keep..., end, ref: a row for each end of a relation that names no entity."""
    pairs = F.array(*[F.struct(F.lit(e).alias("end"), F.col(e).cast("string").alias("ref")) for e in ends])
    refs = relations.select(*keep, F.explode(pairs).alias("p")).select(*keep, "p.end", "p.ref")
    return refs.join(entities.select(F.col(entity).cast("string").alias("ref")).distinct(), "ref", "left_anti").select(*keep, "end", "ref")


def dangling_participants(events: DataFrame, event: str, participants: str, entities: DataFrame, entity: str) -> DataFrame:
    refs = events.select(event, F.explode(participants).alias("ref"))
    return refs.join(entities.select(F.col(entity).alias("ref")).distinct(), "ref", "left_anti").select(event, "ref")


def illegal_triples(relations: DataFrame, triple: list[str], allowed: DataFrame, keep: list[str]) -> DataFrame:
    """Relations whose (source type, relation, target type) is not allowed; an empty whitelist allows all, and a
    missing type is not judged."""
    known = relations.where(" AND ".join(f"{c} IS NOT NULL" for c in triple))
    if not allowed.head(1):
        return known.select(*keep).limit(0)
    return known.join(allowed.select(*triple).distinct(), triple, "left_anti").select(*keep)


def missing_provenance(df: DataFrame, key: str, provenance: str) -> DataFrame:
    return df.where(F.col(provenance).isNull() | (F.trim(F.col(provenance).cast("string")) == "")).select(key, F.lit("missing_provenance").alias("problem"))


def error_list(*checks: tuple[Column, str]) -> Column:
    """The names of the checks that hold, in order."""
    return F.array_compact(F.array(*[F.when(cond, F.lit(name)) for cond, name in checks]))


def parse_candidates(entities: DataFrame, relations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stable ids for candidate entities (chunk_id, temp_id, name, type) and relations (chunk_id, temp_id, type,
    source_id, target_id). Invalid rows stay, with the list of their errors; an end that names no entity gets a
    missing_ent id made from the name it gave."""
    e = entities.select(
        "chunk_id", "temp_id", clean_name("name").alias("name"), F.upper(F.trim("type")).alias("type"),
        error_list((clean_name("name") == "", "missing_name"), (F.coalesce(F.trim("type"), F.lit("")) == "", "missing_type")).alias("errors"),
    ).withColumn("entity_id", stable_id("ent", "chunk_id", "type", "name"))
    ids = e.select("chunk_id", "temp_id", "entity_id", F.col("name").alias("n")).dropDuplicates(["chunk_id", "temp_id"])
    end = lambda side: ids.select("chunk_id", F.col("temp_id").alias(f"{side}_id"), F.col("entity_id").alias(f"_{side}"), F.col("n").alias(f"{side}_name"))
    r = relations.join(end("source"), ["chunk_id", "source_id"], "left").join(end("target"), ["chunk_id", "target_id"], "left")
    s, t = F.coalesce("_source", stable_id("missing_ent", "chunk_id", "source_id")), F.coalesce("_target", stable_id("missing_ent", "chunk_id", "target_id"))
    r = r.select(
        "chunk_id", "temp_id", F.upper(F.trim("type")).alias("type"), s.alias("source_id"), t.alias("target_id"), "source_name", "target_name",
        error_list((F.col("_source").isNull(), "missing_source"), (F.col("_target").isNull(), "missing_target"), (F.coalesce(F.trim("type"), F.lit("")) == "", "missing_type")).alias("errors"),
    )
    return e, r.withColumn("relation_id", stable_id("rel", "chunk_id", "type", "source_id", "target_id"))


def legal_relations(relations: DataFrame, rules: DataFrame, triple: list[str], key: str, seq: str, values: list[str]) -> tuple[DataFrame, DataFrame]:
    """(one row for each key of the relations a rule allows, the last one; those that none allows)."""
    ok = relations.join(rules.select(*triple).distinct(), triple, "left_semi")
    return merge_last(ok, [key], seq, values), relations.join(rules.select(*triple).distinct(), triple, "left_anti")


INVERSE = {"contains": "part_of", "part_of": "contains", "directly_overlies": "directly_underlies", "directly_underlies": "directly_overlies"}


def with_inverse(relations: DataFrame, source: str, kind: str, target: str, inverse: dict[str, str] = INVERSE) -> DataFrame:
    """The relations and, for types that have one, their inverses, marked as not explicit."""
    table = F.create_map(*[F.lit(x) for kv in inverse.items() for x in kv])
    back = relations.where(F.col(kind).isin(list(inverse))).select(
        *[{source: F.col(target).alias(source), target: F.col(source).alias(target), kind: F.element_at(table, F.col(kind)).alias(kind), "explicit": F.lit(False).alias("explicit")}.get(c, F.col(c)) for c in relations.columns]
    )
    return relations.unionByName(back)


def prune_isolated(nodes: DataFrame, node: str, edges: DataFrame, source: str, target: str) -> DataFrame:
    linked = edges.select(F.explode(F.array(source, target)).alias(node)).distinct()
    return nodes.join(linked, node, "left_semi")


def neighbourhood(edges: DataFrame, seeds: DataFrame, seed: str, source: str, target: str, order: list, most: int = 200) -> DataFrame:
    """Edges with an end among the seeds, the first `most` by order. Two semi joins, as one on either end has no key."""
    s = seeds.select(F.col(seed).alias("_s"))
    by = lambda c: edges.join(s, edges[c] == s["_s"], "left_semi")
    return by(source).unionByName(by(target)).distinct().orderBy(*order).limit(most)


def induced(edges: DataFrame, names: DataFrame, name: str, source: str, target: str, order: list, most: int = 500) -> DataFrame:
    """Edges with both ends among the names, each once, the first `most` by order."""
    a, b = names.select(F.col(name).alias("_a")), names.select(F.col(name).alias("_b"))
    both = edges.join(a, edges[source] == a["_a"], "left_semi").join(b, edges[target] == b["_b"], "left_semi")
    return both.distinct().orderBy(*order).limit(most)


def overlay(base: DataFrame, patch: DataFrame, key: str, pos: str, columns: list[str]) -> DataFrame:
    """Rows of base with the patch's values where it has any; new rows of the patch follow in its order."""
    p = patch.select(F.col(key), F.col(pos).alias("_pp"), *[F.col(c).alias(f"_{c}") for c in columns])
    joined = base.join(p, key, "full_outer")
    return joined.select(
        key, F.coalesce(F.struct(F.lit(0).alias("new"), F.col(pos).alias("at")), F.lit(None)).getField("at").alias("_at"),
        *[F.coalesce(f"_{c}", c).alias(c) for c in columns], F.col(pos).isNull().alias("added"), F.coalesce(pos, "_pp").alias(pos),
    ).drop("_at")


def rewrite_refs(relations: DataFrame, ends: list[str], aliases: DataFrame, old: str, new: str) -> DataFrame:
    """relations with each end replaced by what its alias stands for."""
    out = relations
    for e in ends:
        a = aliases.select(F.col(old).alias(e), F.col(new).alias("_new"))
        out = out.join(a, e, "left").withColumn(e, F.coalesce("_new", e)).drop("_new")
    return out.select(*relations.columns)


def guarded_corrections(instructions: DataFrame, entities: DataFrame) -> DataFrame:
    """instructions(instr_id, name, action, least) with the entities of exactly that name and whether they apply:
    an update needs exactly one match, a merge at least `least` (2 if null)."""
    found = instructions.join(entities.select("entity_id", "name"), "name", "left").groupBy("instr_id", "action", "name", "least").agg(
        F.count("entity_id").alias("matches"), F.array_sort(F.collect_list("entity_id")).alias("entity_ids")
    )
    ok = F.when(F.col("action") == "update", F.col("matches") == 1).when(F.col("action") == "merge", F.col("matches") >= F.coalesce("least", F.lit(2))).otherwise(F.lit(False))
    return found.withColumn("applied", ok).withColumn("reason", F.when(~ok & (F.col("matches") == 0), "no_match").when(~ok, "match_count"))


def semantic_error(relation: str = "type", source: str = "source_type", target: str = "target_type", same: Column | None = None) -> Column:
    """The first rule that a relation breaks, by the types of its ends; null if it breaks none."""
    r, s, t = F.col(relation), F.col(source), F.col(target)
    return (
        F.when(F.lit(False) if same is None else same, "self_relation")
        .when(r.isin("directly_overlies", "directly_underlies") & ~(s.isin("unit", "segment") & t.isin("unit", "segment")), "vertical_endpoints")
        .when((s == "model") & (r != "contains"), "root_as_context")
        .when((r == "transports") & ~s.isin("agent", "process"), "transports_source")
        .when((r == "generates") & ~s.isin("source_rock", "process"), "generates_source")
        .when((r == "source_rock_of") & (s != "source_rock"), "source_rock_source")
        .when((r == "controls") & s.isin("unit", "lithology"), "controls_source")
        .when((r == "dolomitizes") & (t != "lithology"), "dolomitizes_target")
    )


def relation_rejects(relations: DataFrame, entities: DataFrame, entity: str, source: str, target: str, kind: str, allowed: list[str]) -> DataFrame:
    """relations with a reason: unresolved_endpoint, self_relation, unsupported_relation_type, or null if accepted."""
    known = entities.select(F.col(entity).alias("_e")).distinct()
    a = known.select(F.col("_e").alias(source), F.lit(True).alias("_s"))
    b = known.select(F.col("_e").alias(target), F.lit(True).alias("_t"))
    joined = relations.join(a, source, "left").join(b, target, "left")
    reason = F.when(F.col("_s").isNull() | F.col("_t").isNull(), "unresolved_endpoint").when(F.col(source) == F.col(target), "self_relation").when(~F.col(kind).isin(allowed), "unsupported_relation_type")
    return joined.select(*relations.columns, reason.alias("reason"))


def repair_context(relations: DataFrame, lithologies: DataFrame) -> DataFrame:
    """dolomitizes relations whose target is a unit go to the longest lithology that their context names; a
    source rock's source_rock_of becomes generates. repaired tells which changed."""
    from sparkloom.operators.joins import contained_terms

    broken = relations.where("type = 'dolomitizes' AND target_type = 'unit'")
    named = contained_terms(broken, "relation_id", "context", lithologies, "lithology_id", "name").join(lithologies.select("lithology_id", F.length("name").alias("_n")), "lithology_id")
    best = named.groupBy("relation_id").agg(F.max_by("lithology_id", F.struct("_n", "lithology_id")).alias("_l"))
    out = relations.join(best, "relation_id", "left")
    rock = (F.col("type") == "source_rock_of") & (F.col("source_type") == "source_rock")
    return out.select(
        *[c for c in relations.columns if c not in ("type", "target_id", "target_type")],
        F.when(rock, "generates").otherwise(F.col("type")).alias("type"), F.coalesce("_l", "target_id").alias("target_id"),
        F.when(F.col("_l").isNotNull(), "lithology").otherwise(F.col("target_type")).alias("target_type"), (rock | F.col("_l").isNotNull()).alias("repaired"),
    )


def expand_targets(events: DataFrame, systems: DataFrame, key: str) -> DataFrame:
    """Events of a diagram with more than one system get all its systems as targets, in order."""
    all_ = systems.groupBy(key).agg(F.array_sort(F.collect_set("system_id")).alias("_s"))
    return events.join(all_, key, "left").withColumn("targets", F.when(F.size("_s") > 1, F.col("_s")).otherwise(F.col("targets"))).drop("_s")


def wells_named_faults(wells: DataFrame, faults: DataFrame, segment: str) -> DataFrame:
    """fault_id, well_id for faults whose name, without a trailing word for fault, is a well's of the same segment."""
    bare = lambda c: F.lower(F.trim(F.regexp_replace(c, r"(?i)\s*(fault|断层|断裂)$", "")))
    w = wells.select(segment, F.lower(F.trim("name")).alias("_n"), "well_id")
    return faults.select(segment, bare(F.col("name")).alias("_n"), "fault_id").join(w, [segment, "_n"]).select(segment, "fault_id", "well_id")


def select_targets(manifest: DataFrame, subtype: str) -> DataFrame:
    """Records of a subtype with whether their id and path are unique in it."""
    t = manifest.where(F.col("subtype") == subtype)
    return t.withColumn("unique_id", F.count("*").over(Window.partitionBy("image_id")) == 1).withColumn("unique_path", F.count("*").over(Window.partitionBy("path")) == 1)


def result_status(graphs: DataFrame, errors: DataFrame, dropped: DataFrame, key: str, exempt: list[str]) -> DataFrame:
    """completed iff the graph is, no validation error holds and no explicit relation of another than the exempt
    types was dropped."""
    e = errors.groupBy(key).agg(F.count("*").alias("n_errors"))
    d = dropped.where(F.col("explicit") & ~F.col("type").isin(exempt)).groupBy(key).agg(F.count("*").alias("n_dropped"))
    out = graphs.join(e, key, "left").join(d, key, "left").na.fill(0, ["n_errors", "n_dropped"])
    return out.withColumn("final_status", F.when((F.col("status") == "completed") & (F.col("n_errors") == 0) & (F.col("n_dropped") == 0), "completed").otherwise("failed"))


def table_graph(cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes (id, type, name) and edges (source, type, target) of table cells (table_id, row, col, header, text)."""
    tid = stable_id("tbl", "table_id")
    row, col = stable_id("row", "table_id", F.col("row") + 1), stable_id("col", "table_id", F.col("col") + 1)
    cell = stable_id("cell", "table_id", F.col("row") + 1, F.col("col") + 1)
    header = stable_id("hdr", "table_id", "header")
    parts = [(tid, "Table", F.col("table_id").cast("string")), (row, "Row", F.col("row").cast("string")), (col, "Column", F.col("header")), (header, "Header", F.col("header")), (cell, "Cell", F.col("text"))]
    nodes = cells.select(F.explode(F.array(*[F.struct(i.alias("id"), F.lit(k).alias("type"), n.alias("name")) for i, k, n in parts])).alias("n")).select("n.*").distinct()
    links = [(tid, "HAS_ROW", row), (tid, "HAS_COLUMN", col), (col, "HAS_HEADER", header), (row, "HAS_CELL", cell), (cell, "IN_COLUMN", col)]
    edges = cells.select(F.explode(F.array(*[F.struct(s.alias("source"), F.lit(k).alias("type"), t.alias("target")) for s, k, t in links])).alias("e")).select("e.*").distinct()
    return nodes, edges


def record_map(cells: DataFrame, key: list[str], pos: str, header: str, value: str) -> DataFrame:
    """A map of header to value for each record; of equal headers the last counts."""
    last = cells.groupBy(*key, header).agg(F.max_by(value, pos).alias("_v"), F.min(pos).alias("_p"))
    return last.groupBy(*key).agg(F.map_from_entries(F.transform(F.array_sort(F.collect_list(F.struct("_p", header, "_v"))), lambda x: F.struct(x[header], x["_v"]))).alias("record"))


#: Numbers in a block of items and of queries at most, pairs whose scores are held at once, and queries and items whose scores are one matrix.
ITEM_VALUES, QUERY_VALUES, PAIRS, TILE = 1 << 23, 1 << 21, 1 << 20, (512, 4096)


def _vectors(column: pa.ChunkedArray) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places, rows and squared norms by length; vectors that are null, empty, zero or hold a null are left out."""
    lists = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).copy()
    flat, start = lists.flatten(), np.cumsum(size) - size
    if flat.null_count:
        size[np.repeat(np.arange(len(size)), size)[flat.is_null().to_numpy(zero_copy_only=False)]] = 0
        flat = pc.fill_null(flat, 0)
    flat = (flat if pa.types.is_float32(flat.type) else flat.cast(pa.float64())).to_numpy()
    out = {}
    for n in np.unique(size[size > 0]).tolist():
        at = np.flatnonzero(size == n)
        m = flat.reshape(-1, n) if len(at) * n == len(flat) else flat[start[at][:, None] + np.arange(n)]
        norm = np.zeros(len(at))
        for d in range(n):
            v = m[:, d].astype("f8")
            norm += v * v
        out[n] = (at, m, norm) if norm.all() else (at[norm != 0], m[norm != 0], norm[norm != 0])
    return out


def _copies(m: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows sorted by classes of equal ones, the first of each class at most, and each class's start and length there; classes lie by their first row."""
    bits, h = m.view(f"u{m.itemsize}"), np.zeros(len(m), "u8")
    for d in range(m.shape[1]):
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + bits[:, d]
    by = np.argsort(h, kind="stable")
    new = np.r_[True, h[by][1:] != h[by][:-1]][: len(m)]
    for j in np.array_split(np.flatnonzero(~new), 1 + len(m) // 16384):
        new[j] = (bits[by[j]] != bits[by[j - 1]]).any(axis=1)
    start = np.flatnonzero(new)
    size = np.diff(np.r_[start, len(m)])
    order = np.argsort(by[start])
    start, size = start[order], np.minimum(size[order], most)
    return by[_runs(start, size)], np.cumsum(size) - size, size


def _runs(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each run, one after the other."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())


def _unit(m: np.ndarray, norm: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of length 1 in single precision, and which are odd: zeros, as their norm is not finite or so large or small that rounding counts."""
    odd, out = ~((norm > 1e-150) & (norm < 1e150)), np.empty(m.shape, "f4")
    for j in range(0, len(m), 16384):
        s = slice(j, j + 16384)
        out[s] = m[s] / np.sqrt(norm[s])[:, None]
    out[odd] = 0.0
    return out, odd


def _cosines(q: np.ndarray, qn: np.ndarray, a: np.ndarray, x: np.ndarray, xn: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row a of q and row b of x, summed in the order of the numbers, so equal vectors have equal scores wherever they lie."""
    out, some = np.empty(len(a)), max(1, PAIRS // q.shape[1])
    for j in range(0, len(a), some):
        s, t = a[j : j + some], b[j : j + some]
        left, right = q[s].astype("f8"), x[t].astype("f8")
        dot, square = np.zeros(len(s)), qn[s] * xn[t]
        for d in range(q.shape[1]):
            dot += left[:, d] * right[:, d]
        norm = np.where((square > 1e-300) & (square < 1e300), np.sqrt(square), np.sqrt(qn[s]) * np.sqrt(xn[t]))
        out[j : j + some] = np.clip(dot / norm, -1.0, 1.0) + 0.0
    return out


def _hits(near: np.ndarray, low: np.ndarray, odd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns that are not below low, and all of odd columns; hits are few, so they are looked for by eight."""
    width = near.shape[1]
    hit = np.zeros((len(near), -(-width // 8) * 8), bool)
    np.greater_equal(near, low[:, None], out=hit[:, :width])
    hit[:, np.flatnonzero(odd)] = True
    flat = hit.reshape(-1)
    eight = np.flatnonzero(flat.view("u8"))
    at, byte = np.nonzero(flat.reshape(-1, 8)[eight])
    flat = eight[at] * 8 + byte
    return flat // hit.shape[1], flat % hit.shape[1]


def _near_best(q: np.ndarray, qn: np.ndarray, x: np.ndarray, xn: np.ndarray, size: np.ndarray, unit: tuple[np.ndarray, np.ndarray], k: int, at_least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of q, rows of x and exact scores: whatever may be among the k best of a query, if row i of x stands for size[i] items.

    Products in single precision find all that come within rounding of the k-th best so far; of those, exact scores decide.
    """
    slack = (q.shape[1] + 16) * 2.0**-23
    (qu, odd_q), (xu, odd_x) = _unit(q, qn), unit
    low = np.where(odd_q, -np.inf, at_least - slack).astype("f4")
    a, b, v, seen, then = np.zeros(0, "i8"), np.zeros(0, "i8"), np.zeros(0, "f4"), 0, 1
    room = np.empty(len(q) * min(TILE[1], len(x)), "f4")
    for j in range(0, len(x), TILE[1]):
        odd = odd_x[j : j + TILE[1]]
        near = np.matmul(qu, xu[j : j + TILE[1]].T, out=room[: len(q) * len(odd)].reshape(len(q), -1))
        near[:, odd] = -2.0
        if not j and near.shape[1] > k:
            kth = np.partition(near, near.shape[1] - k, axis=1)[:, near.shape[1] - k]
            low = np.where(odd_q, low, np.maximum(low, kth - np.float32(slack)))
        i, c = _hits(near, low, odd)
        a, b, v, seen = np.r_[a, i], np.r_[b, c + j], np.r_[v, near[i, c]], seen + 1
        if seen < then and len(a) < PAIRS:
            continue
        then = 2 * seen
        key = np.sort((a << 32) | ((v.astype("f8") + 2.0) * 2.0**29).astype("i8"))
        end = np.searchsorted(key, np.arange(1, len(q) + 1) << 32)
        many = np.flatnonzero((np.diff(np.r_[0, end]) >= k) & ~odd_q)
        kth = (key[end[many] - k] & 0xFFFFFFFF) * 2.0**-29 - 2.0
        low[many] = np.maximum(low[many], (kth - slack).astype("f4"))
        keep = (v >= low[a]) | (v == -2.0)
        a, b, v = a[keep], b[keep], v[keep]
        if len(a) >= PAIRS // 2:
            keep = _may_be_first(a, b, _cosines(q, qn, a, x, xn, b), size, k)
            a, b, v = a[keep], b[keep], v[keep]
    score = _cosines(q, qn, a, x, xn, b)
    keep = _may_be_first(a, b, score, size, k)
    return a[keep], b[keep], score[keep]


def _may_be_first(a: np.ndarray, b: np.ndarray, score: np.ndarray, size: np.ndarray, k: int) -> np.ndarray:
    """Which rows b still have an item among the k best of a: fewer than k items score better or stand in earlier rows of equal score."""
    by = np.lexsort((b, -np.where(np.isnan(score), np.inf, score), a))
    a, score, many = a[by], np.nan_to_num(score[by], nan=2.0), size[b[by]]
    at, before = np.arange(len(a)), np.cumsum(many) - many
    group = np.maximum.accumulate(np.where(np.r_[True, a[1:] != a[:-1]][: len(a)], at, 0))
    tie = np.maximum.accumulate(np.where(np.r_[True, (a[1:] != a[:-1]) | (score[1:] != score[:-1])][: len(a)], at, 0))
    return by[before[tie] - before[group] + at - tie < k]


def _best_of_block(left: pa.Table, right: pa.Table, k: int, at_least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of queries, places of items and scores of the k best of each query; items lie by their key.

    Equal vectors are compared once: of equal items only the first k can be among the k best, equal queries have the same.
    """
    items, found, rest = _vectors(right["_i"]), [], np.arange(left.num_rows)

    def unlike(which: np.ndarray, n: int) -> None:
        if at_least <= 0.0:
            others = np.setdiff1d(np.arange(right.num_rows), items[n][0] if n in items else [])[:k]
            found.append((np.repeat(which, len(others)), np.tile(others, len(which)), np.zeros(len(which) * len(others))))

    for n, (at, q, qn) in _vectors(left["_q"]).items():
        rest = np.setdiff1d(rest, at)
        unlike(at, n)
        if n not in items or not len(items[n][0]):
            continue
        place, x, xn = items[n]
        same, first, size = _copies(x, k)
        x, xn = (x, xn) if len(first) == len(x) else (x[same[first]], xn[same[first]])
        unit = _unit(x, xn)
        same_q, first_q, size_q = _copies(q, len(q))
        for i in range(0, len(first_q), TILE[0]):
            some = same_q[first_q[i : i + TILE[0]]]
            a, b, score = _near_best(q[some], qn[some], x, xn, size, unit, k, at_least)
            a, b, score = _first(np.repeat(a, size[b]), place[same[_runs(first[b], size[b])]], np.repeat(score, size[b]), k, at_least)
            many = size_q[i + a]
            found.append((at[same_q[_runs(first_q[i + a], many)]], np.repeat(b, many), np.repeat(score, many)))
    unlike(rest, 0)
    return _first(*[np.concatenate([np.zeros(0, "f8" if c == 2 else "i8"), *[f[c] for f in found]]) for c in range(3)], k, at_least)


def _first(q: np.ndarray, i: np.ndarray, score: np.ndarray, k: int, at_least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best of each query, of equal scores the first items; NaN is above all numbers, as it is to Spark."""
    keep = ~(score < at_least)
    q, i, score = q[keep], i[keep], score[keep]
    by = np.lexsort((i, -np.where(np.isnan(score), np.inf, score), q))
    q, i, score = q[by], i[by], score[by]
    new = np.r_[True, q[1:] != q[:-1]][: len(q)]
    top = np.arange(len(q)) - np.maximum.accumulate(np.where(new, np.arange(len(q)), 0)) < k
    return q[top], i[top], score[top]


def top_k_similar(queries: DataFrame, q_key: str, q_vec: str, items: DataFrame, i_key: str, i_vec: str, k: int, at_least: float) -> DataFrame:
    """The k items most similar to each query by exact cosine, for a stated set of queries against all items.

    Both are dealt by a hash of their key into blocks of bounded numbers, and each block of one meets each block of the
    other, so no task holds more than two however large the tables are; only the best k of each query leave a pair of blocks.
    """
    q = queries.select(F.col(q_key).alias("_qk"), F.col(q_vec).alias("_q"))
    i = items.select(F.col(i_key).alias("_ik"), F.col(i_vec).alias("_i"))
    size = lambda df, v: df.agg(F.count("*"), F.greatest(F.max(F.size(v)), F.lit(1))).first()
    (nq, wide_q), (ni, wide_i) = size(q, "_q"), size(i, "_i")
    few = min(2 * q.sparkSession.sparkContext.defaultParallelism, -(-ni // 1024))
    rows, cols = max(1, -(-nq * wide_q // QUERY_VALUES)), max(1, few, -(-ni * wide_i // ITEM_VALUES))
    deal = lambda key, n: F.pmod(F.xxhash64(key), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    x = q.withColumn("_row", deal("_qk", rows)).withColumn("_col", each(cols))
    y = i.withColumn("_col", deal("_ik", cols)).withColumn("_row", each(rows))

    def block(left: pa.Table, right: pa.Table) -> pa.Table:
        if right.num_rows:
            right = right.take(pc.sort_indices(right, [("_ik", "ascending")], null_placement="at_start"))
        with np.errstate(all="ignore"):
            a, b, score = _best_of_block(left, right, k, at_least)
        return pa.table({q_key: left["_qk"].take(pa.array(a)), i_key: right["_ik"].take(pa.array(b)), "score": pa.array(score, pa.float64())})

    schema = StructType([StructField(q_key, q.schema["_qk"].dataType), StructField(i_key, i.schema["_ik"].dataType), StructField("score", DoubleType())])
    best = x.groupBy("_row", "_col").cogroup(y.groupBy("_row", "_col")).applyInArrow(block, schema)
    w = Window.partitionBy(q_key).orderBy(F.desc("score"), i_key)
    return best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def clusters(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """node, cluster_id: the smallest node that links lead to. Labels are halved along by pointer jumping, until none changes."""
    both = store(pairs.select(F.col(a).alias("x"), F.col(b).alias("y")).unionByName(pairs.select(F.col(b).alias("x"), F.col(a).alias("y"))).distinct())
    label = store(both.groupBy("x").agg(F.least(F.min("x"), F.min("y")).alias("l")))
    while True:
        near = both.join(label.select(F.col("x").alias("y"), F.col("l").alias("m")), "y").groupBy("x").agg(F.min("m").alias("m"))
        step = label.join(near, "x").select("x", F.least("l", "m").alias("l"))
        jump = step.join(label.select(F.col("x").alias("l"), F.col("l").alias("ll")), "l", "left").select("x", F.least("l", F.coalesce("ll", "l")).alias("l"))
        now = store(jump)
        if not now.exceptAll(label).head(1):
            return now.select(F.col("x").alias("node"), F.col("l").alias("cluster_id"))
        drop(label)
        label = now


def align_entities(entities: DataFrame, at_least: float) -> DataFrame:
    """entity_id, cluster_id: entities of one type whose names are equal or which share an alias, and, within a
    block of equal type and first word, those whose embeddings are similar. Clusters are the components."""
    name = F.lower(F.regexp_replace(F.col("name"), r"[\s\-_]+", ""))
    e = entities.select("entity_id", "type", name.alias("n"), F.col("aliases"), "embedding", F.lower(F.split("name", r"\s+")[0]).alias("block"))
    keys = e.select("entity_id", "type", F.explode(F.array_union(F.array("n"), F.transform("aliases", lambda a: F.lower(F.regexp_replace(a, r"[\s\-_]+", ""))))).alias("k")).where("k <> ''")
    first = keys.groupBy("type", "k").agg(F.min("entity_id").alias("b"))
    same = keys.join(first, ["type", "k"]).select(F.col("entity_id").alias("a"), "b")
    x, y = e.alias("x"), e.alias("y")
    near = x.join(y, (F.col("x.type") == F.col("y.type")) & (F.col("x.block") == F.col("y.block")) & (F.col("x.entity_id") < F.col("y.entity_id"))).where(cosine(F.col("x.embedding"), F.col("y.embedding")) >= at_least)
    return clusters(same.unionByName(near.select(F.col("x.entity_id").alias("a"), F.col("y.entity_id").alias("b"))), "a", "b").select(F.col("node").alias("entity_id"), "cluster_id")


def align_relations(relations: DataFrame, members: DataFrame) -> DataFrame:
    """Relations between clusters: for each (source, type, target) the most confident one, and how many there were."""
    s = members.select(F.col("entity_id").alias("source_id"), F.col("cluster_id").alias("_s"))
    t = members.select(F.col("entity_id").alias("target_id"), F.col("cluster_id").alias("_t"))
    joined = relations.join(s, "source_id", "left").join(t, "target_id", "left")
    mapped = joined.select("relation_id", F.coalesce("_s", "source_id").alias("source"), F.upper(F.trim("type")).alias("type"), F.coalesce("_t", "target_id").alias("target"), "confidence")
    return mapped.groupBy("source", "type", "target").agg(F.min_by("relation_id", F.struct(-F.col("confidence"), F.col("relation_id"))).alias("relation_id"), F.max("confidence").alias("confidence"), F.count("*").alias("support"))


def fuse(parts: dict[str, DataFrame]) -> DataFrame:
    """The union of skeleton, aligned, discovered and provenance edges, with their origin."""
    out = None
    for name, df in parts.items():
        p = df.withColumn("origin", F.lit(name))
        out = p if out is None else out.unionByName(p, allowMissingColumns=True)
    return out


def disambiguated(sequences: DataFrame, least: int = 2) -> DataFrame:
    """Sequences of which at least `least` members are left."""
    return sequences.where(F.size("members") >= least)
