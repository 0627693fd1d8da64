"""Plans for tables that do not fit a broadcast, against the plain result; and assembled results on small cases."""

import math
import random

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparkloom.operators import assembly as B
from sparkloom.operators import graphs as G
from sparkloom.operators import joins as J
from sparkloom.operators import lines as L
from sparkloom.sources import files as I


def test_upload_batches_keep_order_and_size(spark):
    items = spark.range(0, 400_000, 1, 8).select(((F.col("id") * 7919) % 400_000).alias("k"))
    batches = I.upload_batches(items, "k").collect()
    assert len(batches) == 20_000
    assert all(b.items == list(range(b.batch * 20, b.batch * 20 + 20)) for b in batches)
    assert I.upload_batches(items.limit(0), "k").count() == 0


@pytest.mark.parametrize("bound", [32 << 20, 0])
def test_contained_terms_by_either_plan(spark, monkeypatch, bound):
    monkeypatch.setattr(J, "BROADCAST_BYTES", bound)
    rng = random.Random(1)
    texts = [(i, "".join(rng.choice("abcé ") for _ in range(rng.randint(0, 30)))) for i in range(60)] + [(100, None), (101, "")]
    terms = [(f"t{i}", "".join(rng.choice("abcé ") for _ in range(rng.randint(2, 5)))) for i in range(40)] + [("e", "")]
    found = J.contained_terms(spark.createDataFrame(texts, "id int, text string"), "id", "text", spark.createDataFrame(terms, "tid string, term string"), "tid", "term")
    want = sorted((i, k) for i, t in texts for k, w in terms if t and w and w in t)
    assert sorted(map(tuple, found.collect())) == want


@pytest.mark.parametrize("bound", [32 << 20, 0])
def test_tiles_by_either_plan(spark, monkeypatch, bound):
    monkeypatch.setattr(J, "BROADCAST_BYTES", bound)
    a, b = spark.range(7).withColumnRenamed("id", "a"), spark.range(9).withColumnRenamed("id", "b")
    assert sorted(map(tuple, J.tiles(a, b, "a", "b", 4).collect())) == [(x, y) for x in range(7) for y in range(9)]


def test_fits_counts_bytes(spark):
    wide = spark.range(100).select(F.array_repeat(F.lit(1.0), 1024).alias("v"))
    assert J.fits(wide, 1000) and not J.fits(wide, 99)
    assert not J.fits(spark.range(3000).select(F.array_repeat(F.lit(1.0), 1024).alias("v")), 50_000)


def test_clusters_of_a_long_chain(spark):
    pairs = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r.cluster_id for r in G.clusters(pairs, "a", "b").collect()} == {0}


def test_sections_of_any_depth(spark):
    rows = [(1, k, k) for k in range(1, 21)] + [(1, 21, 5)]
    found = L.section_parents(spark.createDataFrame(rows, "id int, section_no int, level int"), "id")
    assert {r.section_no: r.parent_no for r in found.collect()} == {1: None, **{k: k - 1 for k in range(2, 21)}, 21: 4}


def test_process_graph_first_candidate_counts(spark):
    schema = "g int, local_id string, name string, type string, pos int"
    one = spark.createDataFrame([(1, "l1", "Sand", "lithology", 0), (1, "l2", "Sand", "lithology", 1)], schema)
    two = spark.createDataFrame([(1, "u1", "Sand", "unit", 0), (1, "u2", "Top", "unit", 1), (2, "u1", "Sand", "unit", 0)], schema)
    rel = spark.createDataFrame([(1, "u2", "on", "l2", 0), (1, "Top", "on", "u1", 1), (1, "u2", "on", "none", 2), (2, "u1", "on", "Sand", 3)], "g int, source string, type string, target string, pos int")
    e, r, d = B.process_graph([one, two], [rel], "g")
    assert sorted((x.g, x.name, x.type) for x in e.collect()) == [(1, "Sand", "lithology"), (1, "Top", "unit"), (2, "Sand", "unit")]
    assert r.count() == 1 and sorted((x.g, x.reason) for x in d.collect()) == [(1, "unresolved_endpoint"), (2, "self_relation")]


def test_strict_profile_fails_on_an_unknown_end(spark):
    profiles = spark.createDataFrame([(1, "p")], "g int, name string")
    items = spark.createDataFrame([(1, "a", "A", "interval", 0.5)], "g int, local_id string, name string, type string, confidence double")
    rel = spark.createDataFrame([(1, "a", "near", "b", 0.5, True)], "g int, source string, type string, target string, confidence double, explicit boolean")
    assert B.profile_graph(profiles, items, rel, "g")[1].count() == 1
    with pytest.raises(Exception, match="unknown end of a near b"):
        B.profile_graph(profiles, items, rel, "g", strict=True)[1].collect()


def test_query_runner_takes_parameters(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert [r.v for r in I.run_query(spark, "SELECT v FROM x WHERE k = :k", {"x": t}, k=2).collect()] == ["b"]


@pytest.mark.parametrize("increases", ["down", "up"])
def test_longest_monotone_run_against_brute_force(spark, increases):
    from itertools import combinations

    from sparkloom.operators.aggregates import longest_monotone

    rng = random.Random(2)
    rows = [(g, rng.randrange(6), float(rng.randrange(6))) for g in range(30) for _ in range(rng.randint(1, 8))]
    got = {}
    for r in longest_monotone(spark.createDataFrame(rows, "g int, p int, v double"), ["g"], "p", "v", increases).collect():
        got.setdefault(r.g, []).append((r.p, r.v))
    sign = 1 if increases == "down" else -1
    for g in {r[0] for r in rows}:
        points = sorted({(p, v) for h, p, v in rows if h == g})
        runs = [c for n in range(1, len(points) + 1) for c in combinations(points, n) if all(x[0] < y[0] and sign * x[1] < sign * y[1] for x, y in zip(c, c[1:]))]
        measure = lambda c: (len(c), sign * (c[-1][1] - c[0][1]))
        found = sorted(got[g])
        assert tuple(found) in runs and measure(found) == max(map(measure, runs))


@pytest.mark.parametrize("at_least", [-1.0, 0.55])
def test_top_k_ranks_as_sql_does(spark, monkeypatch, at_least):
    monkeypatch.setattr(G, "ITEM_VALUES", 150)
    monkeypatch.setattr(G, "QUERY_VALUES", 60)
    rng = random.Random(3)
    base = [[rng.uniform(-1, 1) for _ in range(5)] for _ in range(40)]
    vecs = list(enumerate(base + [[c * v for v in base[k % 4]] for k in range(60) for c in (1.0, 0.3, 7.0)]))
    e = spark.createDataFrame(vecs, "id long, v array<float>")
    found = G.top_k_similar(e.where("id % 10 = 0").select(F.col("id").alias("q"), F.col("v").alias("w")), "q", "w", e, "id", "v", 12, at_least)
    assert "NestedLoop" not in found._jdf.queryExecution().toString()
    con = duckdb.connect()
    con.execute("create table e (id bigint, v float[])")
    con.executemany("insert into e values (?, ?)", vecs)
    sql = """WITH s AS (SELECT q.id AS q, i.id, list_cosine_similarity(q.v::double[], i.v::double[]) AS score FROM e q, e i WHERE q.id % 10 = 0),
        r AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, id) AS rank FROM s WHERE score >= ?) SELECT q, id, rank, score FROM r WHERE rank <= 12"""
    assert sorted((r.q, r.id, r["rank"], r.score) for r in found.collect()) == sorted(con.execute(sql, [at_least]).fetchall())


def test_top_k_of_odd_vectors_against_all_pairs(spark, monkeypatch):
    from sparkloom.functions.scalars import cosine

    monkeypatch.setattr(G, "ITEM_VALUES", 30)
    vecs = [[1.0, 0.0], [0.0, 0.0], None, [], [1.0, None], [1.0, 2.0, 3.0], [math.nan, 1.0], [-1.0, 0.0], [1e-180, 1e-180], [2.0, 1.0], [1.0, 0.0], [0.0, 1.0]] * 3
    e = spark.createDataFrame([(f"k{i}", v) for i, v in enumerate(vecs)], "id string, v array<double>")
    q = e.select(F.col("id").alias("q"), F.col("v").alias("w"))
    for k, at_least in ((2, -1.0), (40, -1.0), (5, 0.0), (5, 0.1)):
        got = G.top_k_similar(q, "q", "w", e, "id", "v", k, at_least).collect()
        zero = lambda v: F.aggregate(v, F.lit(0.0), lambda a, b: a + b * b) == 0
        score = F.when(zero("w") | zero("v"), 0.0).otherwise(cosine("w", "v"))  # against NaN too
        pairs = q.crossJoin(e).select("q", "id", score.alias("score")).where(F.col("score") >= at_least).collect()
        want = []
        for key in {r.q for r in pairs}:
            best = sorted((r for r in pairs if r.q == key), key=lambda r: (-math.inf if math.isnan(r.score) else -round(r.score, 12), r.id))[:k]
            want += [(key, r.id, n + 1, str(round(r.score + 0.0, 9))) for n, r in enumerate(best)]
        assert sorted((r.q, r.id, r["rank"], str(round(r.score, 9))) for r in got) == sorted(want)


def best_of_block(queries, items, k, at_least):
    table = lambda name, vectors: pa.table({name: pa.array(vectors, pa.list_(pa.float64()))})
    return list(zip(*(c.tolist() for c in G._best_of_block(table("_q", queries), table("_i", items), k, at_least))))


def cosine_in_order(q, v):
    dot, a, b = 0.0, 0.0, 0.0
    for x, y in zip(q, v):
        dot, a, b = dot + x * y, a + x * x, b + y * y
    return min(1.0, max(-1.0, dot / math.sqrt(a * b)))


@pytest.mark.parametrize("pairs", [8, 1 << 20])
def test_top_k_in_small_tiles_and_closer_than_single_precision(monkeypatch, pairs):
    monkeypatch.setattr(G, "TILE", (3, 7))
    monkeypatch.setattr(G, "PAIRS", pairs)
    rng = random.Random(6)
    base = [[rng.uniform(-1, 1) for _ in range(6)] for _ in range(30)]
    base += [[v + rng.uniform(-1e-9, 1e-9) for v in base[n % 3]] for n in range(60)]  # too close for single precision
    items = [rng.choice(base) for _ in range(200)] + [[3.0 * v for v in base[0]]] * 4
    queries = [rng.choice(base) for _ in range(20)]
    for k, at_least in ((12, -1.0), (3, 0.55), (300, 0.2)):
        want = []
        for a, q in enumerate(queries):
            best = sorted((-s, b) for b, v in enumerate(items) if (s := cosine_in_order(q, v)) >= at_least)[:k]
            want += [(a, b, -s) for s, b in best]
        assert best_of_block(queries, items, k, at_least) == want


def test_top_k_scores_a_very_common_vector_once(monkeypatch):
    scored, cosines = [], G._cosines
    monkeypatch.setattr(G, "_cosines", lambda *a: scored.append(len(out := cosines(*a))) or out)
    rng = random.Random(7)
    items = [[rng.uniform(-1, 1) for _ in range(4)] for _ in range(1000)]
    items[::2] = [items[0]] * 500
    found = best_of_block(items[::10], items, 5, -1.0)
    assert len(found) == 500 and [b for a, b, _ in found if a == 50] == [0, 2, 4, 6, 8]
    assert sum(scored) <= 20 * 100  # 50,000 pairs of equal vectors


def test_top_k_of_empty_tables(spark):
    e = spark.createDataFrame([(1, [1.0])], "id long, v array<double>")
    q = e.select(F.col("id").alias("q"), F.col("v").alias("w"))
    assert not G.top_k_similar(q.limit(0), "q", "w", e, "id", "v", 3, -1.0).collect() and not G.top_k_similar(q, "q", "w", e.limit(0), "id", "v", 3, -1.0).collect()


@pytest.mark.parametrize("at_least", [0.62, 0.0, 0.9])
def test_fuzzy_best_against_all_pairs(spark, at_least):
    rng = random.Random(4)
    words = ["Bed", "bed ", "İx", "sand", "sandy", "Silt\u00a0", "SILT", "the unit", "x unit", "unit", "grey bed", "gray bed", "", None, "\U0001f600abc", "abc"]
    items = [(rng.randrange(4), i % 70, rng.choice(words)) for i in range(90)]
    cells = [(rng.randrange(5), f"c{rng.randrange(900)}", rng.choice(words)) for _ in range(90)] + [(1, None, "unit")]
    got = J.fuzzy_best(spark.createDataFrame(items, "g int, item int, t string"), spark.createDataFrame(cells, "g int, cell string, u string"), ["g"], "item", "t", "cell", "u", at_least)
    want = {}
    for g, item, t in items:
        for h, cell, u in cells:
            score = J.similarity(t, u)
            if g == h and score >= at_least:
                want[g, item] = min(want.get((g, item), (9, "z", "z")), (-score, cell is not None, cell or ""))
    assert sorted((r.g, r.item, r.cell or "", r.score) for r in got.collect()) == sorted((*k, v[2], -v[0]) for k, v in want.items())


def test_fuzzy_best_compares_each_text_once(spark):
    """40,000 rows of five names in a group would be 400 million pairs."""
    rows = spark.range(40_000).select(F.lit(1).alias("g"), F.col("id"), F.concat(F.lit("name "), (F.col("id") % 5).cast("string")).alias("t"))
    cells = rows.select("g", F.col("id").alias("cell"), F.concat(F.lit("same "), F.col("t"), F.lit(".")).alias("u"))
    found = J.fuzzy_best(rows, cells, ["g"], "id", "t", "cell", "u")
    assert found.where("cell = id % 5 AND score = 0.9").count() == 40_000


@pytest.mark.parametrize("block", [10_000, 7])
def test_smallest_covering_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(J, "BLOCK", block)
    rng = random.Random(6)
    some = lambda: float(rng.randrange(12))
    items = [(rng.randrange(3), i % 110, some(), some()) for i in range(120)] + [(0, 200, None, 1.0), (1, 201, math.nan, 2.0), (2, 202, -0.0, 0.0), (None, 203, 1.0, 1.0)]
    boxes = [(rng.randrange(4), f"b{rng.randrange(1000)}", [a, b, a + some(), b + some()]) for a, b in ((some() - 1, some() - 1) for _ in range(90))]
    boxes += [(1, "n", [0.0, 0.0, math.nan, 5.0]), (2, "z", [0.0, 0.0, 0.0, 0.0]), (2, "y", [0.0, 0.0, 0.0, 0.0]), (0, "o", [None, 0.0, 9.0, 9.0]), (0, None, [0.0, 0.0, 3.0, 3.0]), (None, "q", [0.0, 0.0, 9.0, 9.0]), (0, "no", None)]
    got = J.smallest_covering(spark.createDataFrame(items, "g int, item int, x double, y double"), spark.createDataFrame(boxes, "g int, box_id string, box array<double>"), ["g"], "item", "x", "y", "box", "box_id")
    up = lambda v: (math.isnan(v), 0.0 if math.isnan(v) else v)
    want = {}
    for g, item, x, y in items:
        for h, key, box in boxes:
            if g is not None and g == h and x is not None and box and None not in box and up(box[0]) <= up(x) <= up(box[2]) and up(box[1]) <= up(y) <= up(box[3]):
                best = (up((box[2] - box[0]) * (box[3] - box[1])), key is not None, key or "")
                want[g, item] = min(want.get((g, item), (up(math.nan), True, "zz")), best)
    assert sorted((r.g, r.item, r.box_id or "") for r in got.collect()) == sorted((*k, v[2]) for k, v in want.items())


def test_smallest_covering_takes_equal_points_once(spark):
    """40,000 points and boxes of six kinds in one image would be 1,600 million pairs."""
    rows = spark.range(40_000).select(F.lit(1).alias("g"), F.col("id"), (F.col("id") % 6).cast("double").alias("x"))
    boxes = rows.select("g", F.col("id").alias("box_id"), F.array(F.lit(0.0), F.lit(0.0), "x", "x").alias("box"))
    found = J.smallest_covering(rows.withColumn("y", F.col("x")), boxes, ["g"], "id", "x", "y", "box", "box_id")
    assert found.where("box_id = id % 6").count() == 40_000


def test_boundaries_of_papers_against_a_plain_reading(spark):
    import re

    rng = random.Random(7)
    kinds = ["# Title", "## Part", "#### Deep", "## References", "# 参考文献", "Abstract: x", "key words: y", "text", "", "   ### In", "    ## code"]
    texts = ["\n".join(rng.choice(kinds) for _ in range(rng.randint(1, 9))) for _ in range(300)] + ["## References\n# A\n## B", "", None]
    lines = L.explode_lines(spark.createDataFrame(list(enumerate(texts)), "id int, text string"), "id", "text")
    found = L.boundaries(lines, "id")
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()
    heading = re.compile(L.HEADING)
    want = []
    for i, text in enumerate(texts):
        if text is None:
            continue
        rows = list(enumerate(text.split("\n")))
        ref = min((p for p, x in rows if heading.match(x) and re.search(L.REFERENCE_WORDS, x)), default=None)
        first = min((p for p, x in rows if re.match(r"\s{0,3}#{2,6}\s+", x) and (ref is None or p < ref)), default=None)
        ends = [p for p, x in rows if (heading.match(x) or re.match(r"(?i)\s*(abstract|keywords?|key words|摘要|关键词)", x)) and (first is None or p < first)]
        want.append((i, ref, first, max(ends, default=None)))
    assert sorted(map(tuple, found.collect())) == want
