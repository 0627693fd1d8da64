"""Geometry, corrections, headings and schema selection on small frames."""

from pyspark.sql import functions as F

from sparkloom.operators import geometry as M
from sparkloom.operators import lines as L
from sparkloom.operators import selection as P


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_geometry(spark):
    prim = spark.createDataFrame([(1, "p", ["a", "b"]), (1, "q", ["zz"]), (1, "r", None)], "img int, primitive_id string, refs array<string>")
    meas = spark.createDataFrame([(1, "a", [0, 0, 5, 5]), (1, "b", [3, 2, 9, 4])], "img int, ref string, box array<int>")
    got, notes = M.apply_geometry(prim, meas, "img")
    assert rows(got, "primitive_id", "box") == [("p", [0, 0, 9, 5])] and rows(notes, "primitive_id") == [("q",), ("r",)]
    grey = bytearray(b"\xff" * 50)
    grey[20:30] = bytes(10)
    for k in range(5):
        grey[k * 10 + 7] = 0
    img = spark.createDataFrame([(1, bytes(grey), 10, 5), (2, b"x", 10, 5)], "id int, px binary, w int, h int")
    assert rows(M.rule_lines(img, "id", "px", "w", "h"), "id", "axis", "position") == [(1, "column", 7), (1, "row", 2)]


def test_alignment(spark):
    f = spark.createDataFrame([(1, "f", 10.0, 20.0)], "img int, feature_id string, top double, bottom double")
    u = spark.createDataFrame([(1, "whole", None, 0.0, 100.0), (1, "part", "whole", 5.0, 18.0), (1, "touch", None, 19.0, 90.0)], "img int, unit_id string, parent_id string, top double, bottom double")
    assert rows(M.depth_alignment(f, u, "img"), "unit_id", "overlap") == [("part", 0.8)]
    m = spark.createDataFrame([(1, "m", 12.0), (1, "n", 500.0)], "img int, marker_id string, value double")
    spans = "img int, id string, pos int, top double, bottom double"
    got = M.marker_alignment(m, spark.createDataFrame([(1, "res", 1, 11.0, 13.0)], spans), spark.createDataFrame([(1, "unit", 0, 0.0, 90.0)], spans), "img")
    assert rows(got, "marker_id", "target") == [("m", "res"), ("n", None)]


def test_corrections(spark):
    s = spark.createDataFrame([("s", "sand", "primary", 0.9), ("s", "clay", "context", 0.5), ("t", "x", "primary", 0.4)], "seg string, lithology string, role string, confidence double")
    i = spark.createDataFrame([("s", 2, "change_role", "silt", "secondary"), ("s", 1, "replace", "sand", "silt"), ("s", 3, "remove", "clay", None), ("s", 4, "add", "marl", "context"), ("s", 5, "odd", "silt", None)], "seg string, seq int, action string, lithology string, value string")
    assert rows(M.corrected(s, i, "seg"), "seg", "lithology", "role") == [("s", "marl", "context"), ("s", "silt", "secondary"), ("t", "x", "primary")]


def test_captioned_tables_and_headings(spark):
    text = "Table 1 caption\n\n![](a.png)\n![](b.png)\n![](c.png)\nIn Table 9 we see\n![](d.png)\n表2\n![](e.png)"
    lines = L.explode_lines(spark.createDataFrame([(1, text)], "id int, text string"), "id", "text").withColumn("t", F.contains("line", F.lit("b.png")))
    assert rows(M.captioned_image_tables(lines, "id", "t"), "table_no", "caption", "paths") == [(1, "Table 1 caption", ["a.png", "b.png"]), (2, "表2", ["e.png"])]
    text = "# T\n## 1 A\n### (1) x\n### (2) y\n### 1.1 B\n## Notes\n## Notes"
    h = M.headings(L.explode_lines(spark.createDataFrame([(1, text)], "id int, text string"), "id", "text"), "id")
    assert [(r.section_id, r.level, r.parent_id) for r in h.orderBy("pos").collect()] == [
        ("t", 1, None), ("1", 2, "t"), ("1.(1)", 3, "1"), ("1.(2)", 3, "1"), ("1.1", 3, "1"), ("notes", 2, "t"), ("notes-2", 2, "t"),
    ]


def test_enrichment_and_groups(spark):
    n = spark.createDataFrame([("a", None), ("b", "old")], "id string, official_name string")
    e = spark.createDataFrame([("a", "A1"), ("c", "C"), ("a", "A2")], "id string, official_name string")
    assert rows(M.enrich_nodes(n, e, "id"), "id", "official_name", "error") == [("a", "A1", "duplicate_id"), ("b", "old", "missing_id"), ("c", "C", "unknown_id")]
    r = spark.createDataFrame([(1, 0, "W1", ""), (1, 1, "W2", "x"), (1, 2, "W3", ""), (1, 3, "K1", "")], "t int, pos int, k string, well string")
    assert rows(M.group_columns(r, "t", "pos", ["well"], "k"), "pos", "well") == [(0, "x"), (1, "x"), (2, "x"), (3, None)]


def test_selection(spark):
    concepts = spark.createDataFrame(
        [("Basin", "basin", "place", ["Tarim"], [1.0, 0.0]), ("Formation", "formation", "unit", [], [0.0, 1.0]), ("SourceRock", "source rock", "unit", [], [0.6, 0.8]), ("Paper", "paper", "other", [], [-1.0, 0.0])],
        "schema string, name string, category string, examples array<string>, embedding array<double>",
    )
    edges = spark.createDataFrame([("Basin", "CONTAINS", "Formation"), ("SourceRock", "DEVELOPED_IN", "Basin"), ("Paper", "CITES", "Paper")], "src string, rel string, dst string")
    docs = spark.createDataFrame([("d", "the basin holds rock", ["rock"], ["Formation"], [0.9, 0.1])], "doc string, text string, terms array<string>, keys array<string>, embedding array<double>")
    scores = P.concept_scores(docs, ["doc"], concepts)
    pool = P.document_pool(scores, "doc", trees=2)
    assert rows(pool, "schema") == [("Basin",), ("Formation",), ("SourceRock",)]
    chunks = P.concept_scores(docs.withColumn("chunk", F.lit("c")), ["doc", "chunk"], concepts)
    chosen = P.chunk_selection(pool, chunks, edges, "doc", "chunk", seeds=1)
    assert {r[0] for r in rows(chosen, "schema")} >= {"Basin", "Formation", "SourceRock"}
    assert rows(P.induced_edges(chosen, edges, ["doc", "chunk"]), "src", "rel", "dst") == [("Basin", "CONTAINS", "Formation"), ("SourceRock", "DEVELOPED_IN", "Basin")]
    bad = spark.createDataFrame([("d", "a", "text"), ("d", "a", "text"), ("d", "b", "video"), (None, "x", "text")], "document_id string, chunk_id string, modality string")
    assert rows(P.context_errors(bad), "chunk_id", "error") == [("a", "duplicate_chunk_id"), ("b", "unknown_modality"), ("x", "missing_document")]
    ctx = spark.createDataFrame([("d", "s", "c2", 2, "b"), ("d", "s", "c1", 1, "a"), ("d", "t", "c3", 3, " ")], "document_id string, section_id string, chunk_id string, ord int, text string")
    (r,) = P.document_context(ctx).collect()
    assert (r.n_chunks, r.n_sections, r.section_chunks) == (2, 1, {"s": ["c1", "c2"]})
