"""Golden cases of the operators, on small frames."""

import random

import pytest
from pyspark.sql import functions as F

from sparkloom.functions import clients, scalars as S
from sparkloom.operators import aggregates as A
from sparkloom.operators import chunks as C
from sparkloom.operators import graphs as G
from sparkloom.operators import grids as T
from sparkloom.operators import hierarchy as H
from sparkloom.operators import joins as J
from sparkloom.operators import lines as L
from sparkloom.operators import rules as R
from sparkloom.sources import files as I


def one(spark, **columns):
    row = spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()
    return row.asDict()


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_pack_paragraphs(spark):
    got = one(spark, a=C.pack_paragraphs(F.lit("aa\n\n bb \ncccccc\nd"), 5), b=C.pack_paragraphs(F.lit(None).cast("string")), c=C.pack_paragraphs(F.lit("  \n")))
    assert got == {"a": ["aa\nbb", "cccccc", "d"], "b": [], "c": []}
    with pytest.raises(ValueError):
        C.pack_paragraphs(F.lit("x"), 0)


def test_pack_paragraphs_of_long_texts(spark):
    rng = random.Random(1)
    texts = ["\n".join("w" * rng.randrange(300) for _ in range(n)) for n in (1, 2, 3, 8, 50, 333, 1000)]
    for most in (1, 90, 500):
        got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", C.pack_paragraphs(F.col("t"), most).alias("c")).collect()
        for r in got:
            want = []
            for line in filter(None, r.t.split("\n")):
                if want and len(want[-1]) + 1 + len(line) <= most:
                    want[-1] += "\n" + line
                else:
                    want.append(line)
            assert r.c == want


def test_shared_token_pairs(spark):
    rng = random.Random(2)
    sets = [[rng.choice("abcdefghijkl") for _ in range(rng.randrange(12))] for _ in range(60)]
    frame = lambda name, part: spark.createDataFrame(list(enumerate(part)), f"{name} long, t array<string>")
    for least in (0.1, 0.5, 1.0):
        got = {(r.a, r.b) for r in J.shared_token_pairs(frame("a", sets[:20]), "a", frame("b", sets[20:]), "b", "t", least).collect()}
        pairs = [(i, j, set(x), set(y)) for i, x in enumerate(sets[:20]) for j, y in enumerate(sets[20:])]
        assert got == {(i, j) for i, j, x, y in pairs if x & y and len(x & y) / len(x | y) >= least}


def test_stable_ids_and_falsy_parts(spark):
    got = one(spark, a=S.stable_id("ent", F.lit(" A "), F.lit("b")), b=S.stable_id("ent", F.lit("a"), F.lit("B　")), c=S.stable_id("x", S.falsy_to_empty(F.lit(0))), d=S.stable_id("x", F.lit("")))
    assert got["a"] == got["b"] and got["c"] == got["d"] and len(got["a"]) == 24


def test_scores(spark):
    got = one(
        spark, w=S.weighted_score(F.lit(0.8), F.lit(0.6), F.lit(0.0)), c0=S.cosine(F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(1.0), F.lit(0.0))),
        c1=S.cosine(F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(0.0), F.lit(1.0))), c2=S.cosine(F.array(F.lit(1.0)), F.array(F.lit(1.0), F.lit(0.0))),
        k0=S.schema_key_score(F.array(F.lit("Basin")), F.lit("Basin")), k1=S.schema_key_score(F.array(F.lit("Fault")), F.lit("Fault/Crack")), k2=S.schema_key_score(F.array(F.lit("Rock")), F.lit("RockBody")), k3=S.schema_key_score(F.array(F.lit("x")), F.lit("y")),
        j=S.jaccard(F.array(F.lit("a"), F.lit("b")), F.array(F.lit("b"), F.lit("c"))),
        x=S.lexical_score(F.lit("the basin"), F.lit("basin"), F.array().cast("array<string>"), F.array().cast("array<string>"), F.lit(0.0), F.lit(0)),
        y=S.lexical_score(F.lit("the basin"), F.lit("rock"), F.array(F.lit("basin")), F.array().cast("array<string>"), F.lit(0.5), F.lit(2)),
    )
    assert round(got["w"], 6) == round((0.5 * 0.8 + 0.25 * 0.6) / 0.75, 6)
    assert (got["c0"], got["c1"], got["c2"]) == (1.0, 0.0, 0.0)
    assert (got["k0"], got["k1"], got["k2"], got["k3"]) == (1.0, 0.9, 0.75, 0.0)
    assert round(got["j"], 6) == 0.333333 and got["x"] == 1.0 and got["y"] == 0.9


def test_scalars(spark):
    box = lambda *v: F.array(*[F.lit(float(x)) for x in v])
    got = one(
        spark, a=S.clamp_confidence(F.lit("1.7")), b=S.clamp_confidence(F.lit("no")), n=S.full_width_number(F.lit("１２．５ m")), m=S.full_width_number(F.lit("12 x")),
        o=S.overlap_ratio(F.lit(0), F.lit(10), F.lit(5), F.lit(25)), box=S.clip_box(box(-5, 10, 2000, 500)), bad=S.clip_box(box(5, 5, 5, 9)), inside=S.box_contained(box(0, 0, 10, 10), box(0, 0, 10, 5)),
        t=S.without_thinking(F.lit("<THINK>a\nb</think> ok")), f=S.json_fragment(F.lit('x ```json\n{"a": [1]}\n``` y')), none=S.json_fragment(F.lit("nothing")),
        p=S.path_key(F.lit("A/B.png")), u=S.data_url(F.lit("image/png"), F.lit("ab").cast("binary")), yes=S.parse_flag(F.lit(" On ")), q=S.query_text([("a", F.lit("x")), ("b", F.lit(" "))]),
        h=S.head(F.lit("abcdef"), 3), c=S.clean_name(F.lit("N/A")), sk=S.symbol_kind(F.lit("k_1")), lit=S.strip_markup(F.lit("**a** [b](c)  d")),
    )
    assert got == {
        "a": 1.0, "b": 0.7, "n": 12.5, "m": None, "o": 0.5, "box": [0.0, 10.0, 1000.0, 500.0], "bad": [], "inside": 0.5, "t": "ok", "f": '{"a": [1]}', "none": None,
        "p": "a\\b.png", "u": "data:image/png;base64,YWI=", "yes": True, "q": "a: x", "h": "abc……", "c": "", "sk": "subscript_variable", "lit": "a b d",
    }


HTML = "<table><tr><th rowspan=2>Name</th><th colspan='2'>Value &amp; more</th></tr><tr><th>a</th><th>b</th></tr><tr><td>x</td><td>1</td><td>2 ppm</td></tr></table>"


def test_span_table(spark):
    cells = T.cells(spark.createDataFrame([(1, HTML), (2, None), (3, "<p>no table")], "id int, html string"), "id", "html")
    assert T.matrix(cells, "id").collect()[0].matrix == [["Name", "Value & more", "Value & more"], ["Name", "a", "b"], ["x", "1", "2 ppm"]]
    layout = T.structure(cells, "id")
    assert rows(layout, "header_rows", "first_data_row", "caption_rows") == [([0, 1], 2, [])]
    assert rows(T.header_paths(cells, layout, "id"), "col", "path") == [(0, "Name"), (1, "Value & more / a"), (2, "Value & more / b")]
    assert T.canonical_html("<TABLE><tr><td  colspan=2 class=x>a<br>b</td></tr></TABLE>") == '<table><tr><td colspan="2">a b</td></tr></table>'


def test_caption_rows_and_headerless(spark):
    caption = "<table><tr><td colspan=2>T1</td></tr><tr><td colspan=2>units</td></tr><tr><td>k</td><td>v</td></tr><tr><td>a</td><td>3</td></tr></table>"
    plain = "<table><tr><td>1</td><td>2</td></tr><tr><td>3</td><td>4</td></tr></table>"
    cells = T.cells(spark.createDataFrame([(1, caption), (2, plain)], "id int, html string"), "id", "html")
    layout = T.structure(cells, "id")
    assert rows(layout, "id", "caption_rows", "header_rows", "first_data_row") == [(1, [0, 1], [2], 3), (2, [], [], 0)]
    assert rows(T.header_paths(cells, layout, "id").where("id = 2"), "col", "path") == [(0, "column_1"), (1, "column_2")]


def test_values_and_units(spark):
    texts = ["1,200", "≤ 3.5 %", "2.5-1 m", "n/a", "red", None, "-4"]
    got = [tuple(r[0]) for r in spark.createDataFrame([(t,) for t in texts], "t string").select(T.parse_value(F.col("t"))).collect()]
    assert got == [
        ("number", 1200.0, None, None, "", ""), ("number", 3.5, None, None, "≤", "%"), ("range", None, 1.0, 2.5, "", "m"),
        ("missing", None, None, None, "", ""), ("text", None, None, None, "", ""), ("missing", None, None, None, "", ""), ("number", -4.0, None, None, "", ""),
    ]
    units = one(spark, a=T.header_unit(F.lit("Depth (m)")), b=T.header_unit(F.lit("Rate / kg")), c=T.header_unit(F.lit("Au ppm")), d=T.header_unit(F.lit("Name")), g=T.repeating_groups(F.array(*map(F.lit, "ababab"))))
    assert units == {"a": "m", "b": "kg", "c": "ppm", "d": "", "g": 2}


def test_recovery_and_quality(spark):
    items = spark.createDataFrame([(1, 10.0, 101.0, "a"), (1, 52.0, 99.0, "b"), (1, 49.0, 130.0, "c"), (1, 9.0, 300.0, "far")], "id int, x double, y double, text string")
    keys = spark.createDataFrame([(1, 0, 100.0), (1, 1, 128.0)], "id int, row_no int, y double")
    centres = spark.createDataFrame([(1, 0, 10.0), (1, 1, 50.0)], "id int, col int, x double")
    assert rows(T.recover_rows(items, keys, centres, "id", 12.0), "row_no", "col", "text") == [(0, 0, "a"), (0, 1, "b"), (1, 1, "c")]
    cells = T.cells(spark.createDataFrame([(1, HTML), (2, "<table><tr><td>a</td></tr><tr><td></td></tr><tr><td></td></tr></table>")], "id int, html string"), "id", "html")
    boxed = T.attach_boxes(cells, spark.createDataFrame([(1, [[0, 0, 5, 5]] * 7), (2, [[0, 0, 0, 0]])], "id int, boxes array<array<int>>"), "id")
    q = T.table_quality(boxed, spark.createDataFrame([(1, "Name"), (1, "b"), (2, "zz")], "id int, text string"), "id")
    assert [(r.id, r.errors, r.passed) for r in q.orderBy("id").collect()] == [(1, [], True), (2, ["sparse_tail_rows"], False)]


def test_sections_parents_and_boundaries(spark):
    text = "# Title\nAbstract: x\n## 1 A\nt1\n### 1.1 B\nt2\n#### plain\n## 2 C\n\n# References\n## not a section"
    lines = L.explode_lines(spark.createDataFrame([(1, text)], "id int, text string"), "id", "text")
    assert rows(L.boundaries(lines, "id"), "reference_pos", "first_section_pos", "preamble_end") == [(9, 2, 1)]
    found = L.section_parents(L.sections(lines, "id"), "id")
    assert rows(found, "section_no", "level", "heading", "body", "parent_no") == [(1, 2, "1 A", "t1", None), (2, 3, "1.1 B", "t2", 1), (3, 4, "plain", "", 2), (4, 2, "2 C", "", None)]
    assert rows(L.titles(lines, "id"), "title", "title_pos") == [("Title", 0)]


def test_spans_captions_images_metadata(spark):
    spans = spark.createDataFrame([(1, 2, 4), (1, 4, 6), (1, 8, 9)], "id int, start int, end int")
    docs = spark.createDataFrame([(1, "0123456789"), (2, "same")], "id int, text string")
    assert rows(L.strip_spans_from(docs, "id", "text", spans), "id", "text") == [(1, "01679"), (2, "same")]
    text = "Table 1 caption\ntext\n![](t.png)\n\n![](u.png)\nplain\nFig. 2 shows\n![](v.png)"
    lines = L.explode_lines(spark.createDataFrame([(1, text)], "id int, text string"), "id", "text")
    assert rows(L.image_groups(lines, "id"), "paths", "caption") == [(["t.png", "u.png"], "Fig. 2 shows"), (["v.png"], None)]
    near = L.nearby_caption(lines, "id", F.col("line").startswith("!["), F.col("line").rlike("^(Table|Fig)"))
    assert rows(near, "pos", "caption") == [(2, "Table 1 caption"), (4, "Table 1 caption"), (7, "Fig. 2 shows")]
    meta = L.metadata(spark.createDataFrame([(1, "Authors: A B, C D\nAbstract: Some text\nhere\nKeywords: x; y；z\n# 1")], "id int, text string"), "id", "text")
    assert rows(meta, "abstract", "keywords", "authors") == [("Some text\nhere", ["x", "y", "z"], ["A B", "C D"])]
    notes = one(spark, m=L.symbol_notes(F.lit("k — rate, 1/s; m - mass")), x=L.latex_text(F.lit(" "), F.lit("$$ a  b $$"), F.lit("c")), n=L.labelled_numbers(F.lit("Fig. 1, Fig 2.1; fig 1"), ["fig"]))
    assert {k: tuple(v) for k, v in notes["m"].items()} == {"k": ("rate", "1/s"), "m": ("mass", "")} and notes["x"] == "a b" and notes["n"] == ["1", "2.1"]


def test_interval_point_nearest_joins(spark):
    a = spark.createDataFrame([(1, "f", 0.0, 10.0), (1, "g", 50.0, 60.0)], "img int, a string, s double, e double")
    b = spark.createDataFrame([(1, "u", 8.0, 55.0), (1, "v", 60.0, 61.0)], "img int, b string, s2 double, e2 double")
    assert rows(J.overlapping(a, b, ["img"], "s", "e", "s2", "e2", 7.0), "a", "b") == [("f", "u"), ("g", "u")]
    p = spark.createDataFrame([(1, "m", 9.0), (1, "n", 99.0)], "img int, p string, v double")
    assert rows(J.first_containing(p, b.withColumnRenamed("b", "span"), ["img"], ["p"], "v", "s2", "e2", ["span"], 5.0), "p", "span") == [("m", "u"), ("n", None)]
    x = spark.createDataFrame([(1, "p", 5.0), (1, "q", 7.0), (2, "r", 1.0)], "img int, k string, v double")
    y = spark.createDataFrame([(1, 4.0, "lo"), (1, 6.0, "hi")], "img int, w double, name string")
    assert rows(J.nearest(x, y, ["img"], "k", "v", "w", ["name"]), "k", "w", "name") == [("p", 4.0, "lo"), ("q", 6.0, "hi"), ("r", None, None)]


def test_fuzzy_and_tracks(spark):
    assert J.similarity("Bed A", "bed a") == 1.0 and J.similarity("x unit", "the unit") == 0.93 and J.similarity("abc", "xxabcxx") == 0.9 and J.similarity("", "a") == 0
    items = spark.createDataFrame([(1, "i", "sandstone")], "img int, item string, t string")
    cells = spark.createDataFrame([(1, "c1", "sand stone"), (1, "c2", "shale")], "img int, cell string, u string")
    assert rows(J.fuzzy_best(items, cells, ["img"], "item", "t", "cell", "u"), "item", "cell") == [("i", "c1")]
    raw = spark.createDataFrame([(1, 0, "", "depth (m)"), (1, 1, "t1", "x"), (1, 2, "", "zzz")], "img int, raw_pos long, track_id string, header string")
    tracks = spark.createDataFrame([(1, "t0", 0, "Depth m"), (1, "t1", 1, "GR"), (1, "t2", 2, "lith")], "img int, track_id string, pos long, header string")
    assert rows(J.match_tracks(raw, tracks, "img"), "raw_pos", "track_id", "matched_by") == [(0, "t0", "header"), (1, "t1", "id"), (2, "t2", "position")]


def test_axis_clusters_monotone_nms(spark):
    pts = spark.createDataFrame([(1, 60.0, 10.0), (1, 110.0, 20.0), (2, 5.0, 1.0), (3, 5.0, 1.0), (3, 5.0, 2.0)], "ax int, y double, v double")
    fit = {r.ax: (r.slope, r.intercept, r.rmse, r.error) for r in A.fit_line(pts, ["ax"], "y", "v").collect()}
    assert fit[1][:2] == (pytest.approx(0.2), pytest.approx(-2.0)) and fit[1][2] == pytest.approx(0, abs=1e-9)
    assert fit[2][3] == "too_few_points" and fit[3][3] == "same_position"
    c = A.cluster_1d(spark.createDataFrame([(1, v) for v in (1.0, 2.0, 3.0, 10.0)], "k int, v double"), ["k"], "v", 2.0)
    assert rows(c, "position", "support") == [(10.0, 1), (2.0, 3)]
    run = A.longest_monotone(spark.createDataFrame([(1, i, v) for i, v in enumerate([1.0, 9.0, 2.0, 3.0, 0.5])], "k int, p int, v double"), ["k"], "p", "v")
    assert rows(run, "v") == [(1.0,), (2.0,), (3.0,)]
    boxes = spark.createDataFrame([(1, 1, 0.0, 0.0, 10.0, 10.0, 0.9), (1, 2, 0.0, 0.0, 9.0, 9.0, 0.8), (1, 3, 50.0, 0.0, 60.0, 10.0, 0.1)], "img int, id int, x0 double, y0 double, x1 double, y1 double, score double")
    assert rows(A.suppress_boxes(boxes, ["img"], "score", "id"), "id") == [(1,), (3,)]


def test_graph_merges_and_validation(spark):
    e = spark.createDataFrame([("a", 1, "old"), ("b", 2, "x"), ("a", 3, "new")], "id string, seq int, v string")
    assert rows(G.merge_last(e, ["id"], "seq", ["v"]), "id", "pos", "v") == [("a", 1, "new"), ("b", 2, "x")]
    assert rows(G.merge_first(e, ["id"], "seq", ["v"]), "id", "v") == [("a", "old"), ("b", "x")]
    r = spark.createDataFrame([("r1", "a", "b"), ("r2", "a", "zz")], "rid string, s string, t string")
    assert rows(G.dangling(r, ["s", "t"], e, "id", ["rid"]), "rid", "end", "ref") == [("r2", "t", "zz")]
    ents = spark.createDataFrame([("c", "t1", "Bed", "unit"), ("c", "t2", None, "")], "chunk_id string, temp_id string, name string, type string")
    rels = spark.createDataFrame([("c", "x", "has", "t1", "t9")], "chunk_id string, temp_id string, type string, source_id string, target_id string")
    got, rel = G.parse_candidates(ents, rels)
    assert rows(got, "temp_id", "type", "errors") == [("t1", "UNIT", []), ("t2", "", ["missing_name", "missing_type"])]
    (x,) = rel.collect()
    assert x.errors == ["missing_target"] and x.target_id.startswith("missing_ent_") and x.source_name == "Bed"
    allowed = spark.createDataFrame([("U", "over", "U")], "st string, r string, tt string")
    rr = spark.createDataFrame([(1, "U", "over", "U"), (2, "U", "in", "U"), (3, None, "in", "U")], "k int, st string, r string, tt string")
    assert rows(G.illegal_triples(rr, ["st", "r", "tt"], allowed, ["k"]), "k") == [(2,)]
    assert G.illegal_triples(rr, ["st", "r", "tt"], allowed.limit(0), ["k"]).count() == 0


def test_overlay_inverse_clusters_alignment(spark):
    base = spark.createDataFrame([("a", 0, "x", "1"), ("b", 1, "y", "2")], "id string, pos int, n string, m string")
    patch = spark.createDataFrame([("b", 0, "yy", None), ("c", 1, "new", "3")], "id string, pos int, n string, m string")
    assert rows(G.overlay(base, patch, "id", "pos", ["n", "m"]), "id", "n", "m", "added") == [("a", "x", "1", False), ("b", "yy", "2", False), ("c", "new", "3", True)]
    inv = G.with_inverse(spark.createDataFrame([("a", "contains", "b", True), ("a", "near", "b", True)], "s string, r string, t string, explicit boolean"), "s", "r", "t")
    assert rows(inv, "s", "r", "t", "explicit") == [("a", "contains", "b", True), ("a", "near", "b", True), ("b", "part_of", "a", False)]
    chain = spark.createDataFrame([(i, i + 1) for i in range(9)] + [(20, 21)], "a long, b long")
    assert rows(G.clusters(chain, "a", "b"), "node", "cluster_id") == sorted([(i, 0) for i in range(10)] + [(20, 20), (21, 20)], key=repr)
    ents = spark.createDataFrame([(1, "T", "Big Bed", ["BB"], [1.0, 0.0]), (2, "T", "bb", [], [0.0, 1.0]), (3, "T", "Big Rock", [], [0.99, 0.01]), (4, "U", "Big Bed", [], [1.0, 0.0])], "entity_id long, type string, name string, aliases array<string>, embedding array<double>")
    assert rows(G.align_entities(ents, 0.95), "entity_id", "cluster_id") == [(1, 1), (2, 1), (3, 1), (4, 4)]


def test_tiles_and_top_k(spark, monkeypatch):
    a = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(12)], "q long, v array<double>")
    b = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(17)], "id long, v array<double>")
    want = rows(G.top_k_similar(a, "q", "v", b, "id", "v", 3, 0.1), "q", "id", "rank")
    assert len(want) == 36
    for most in (14, 5):
        monkeypatch.setattr(J, "BROADCAST_ROWS", most)
        assert rows(G.top_k_similar(a, "q", "v", b, "id", "v", 3, 0.1), "q", "id", "rank") == want
    x, y = a.select("q"), b.select("id")
    assert rows(J.tiles(x, y, "q", "id", 4), "q", "id") == sorted([(i, j) for i in range(12) for j in range(17)], key=repr)


def test_rules(spark):
    c = spark.createDataFrame([(1, "a", 0.94, "dots", True, False, 0), (1, "b", 0.91, "lines", True, False, 1), (1, "a", 0.99, "", True, False, 2), (1, "a", 0.95, "x", True, False, 3), (1, "z", 0.9, "x", True, False, 4)], "u int, lithology string, confidence double, pattern string, in_scope boolean, unresolved boolean, pos int")
    assert rows(R.colour_gates(c, ["u"], ["a", "b"]), "pos", "gate_reason") == [(0, None), (1, None), (2, "missing_pattern_evidence"), (3, "duplicate"), (4, "not_allowed")]
    v = spark.createDataFrame([("v", "p", [0, 155, 1000, 234])], "region_id string, parent string, box array<int>")
    lat = spark.createDataFrame([("p", [0, 0, 1000, 234])], "parent string, box array<int>")
    assert rows(R.surface_gates(v, lat, "parent"), "region_id", "gate_reason") == [("v", "unresolved_surface_role_overlap")]
    boxes = spark.createDataFrame([("i", [0, 530, 1000, 680], 1000, 442, "")], "image string, box array<int>, w int, h int, d string")
    assert rows(R.coordinate_space(boxes, "image", "box", "w", "h", "d"), "space") == [("normalized_0_1000",)]
    assert boxes.select(R.to_pixels(F.col("box"), F.col("w"), F.col("h"))).first()[0] == [0, 234, 1000, 301]
    f = spark.createDataFrame([(1, "a", "x", "1"), (1, "b", "x", "2"), (1, "a", "y", "3")], "k int, segment string, field string, value string")
    assert rows(R.merge_segments(f, "k", ["a", "b"]), "field", "error") == [("x", "several_owners"), ("y", None)]
    e = one(spark, a=R.explicitness(F.lit("from body text"), F.lit("contains"), F.lit(True)), b=R.explicitness(F.lit("an arrow"), F.lit("causes"), F.lit(True)), r=R.route(F.lit(" a01 "), {"A01": "map"}, "other"))
    assert e == {"a": False, "b": True, "r": "map"}


def test_windows_and_trees(spark):
    t = spark.createDataFrame([("d", "r", None, 0), ("d", "a", "r", 0), ("d", "b", "r", 1), ("d", "c", "a", 0)], "doc string, id string, parent string, ord int")
    assert rows(H.levels(t, ["doc"], "id", "parent"), "id", "height") == [("a", 1), ("b", 0), ("c", 0), ("r", 2)]
    assert [r.id for r in H.paths(t, ["doc"], "id", "parent", "ord").orderBy("sort_path").collect()] == ["r", "a", "c", "b"]
    up = H.bottom_up(t, ["doc"], "id", "parent", "ord", F.col("id"), lambda own, kids: F.concat(own, F.lit("["), F.array_join(kids, ","), F.lit("]")), "none")
    assert {r.id: r.summary for r in up.collect()}["r"] == "r[a[c[]],b[]]"
    a = spark.createDataFrame([(1, 0, "x"), (1, 1, "y"), (1, 1, "z"), (1, 2, "w"), (1, 3, "v")], "k int, o int, n string")
    assert rows(H.adjacent_pairs(a, ["k"], "o", "n"), "lower", "upper") == [("w", "v")]
    conv = spark.createDataFrame([(1, i, "x" * 5) for i in range(4)], "c int, t int, text string")
    assert rows(C.budgeted(conv, ["c"], ["t"], "text", 12, 4), "t", "part") == [(0, "xxxx"), (1, "xxxx"), (2, "xxxx")]
    s = spark.createDataFrame([("a", 1, 5), ("a", 2, 9), ("b", 3, 1)], "g string, id int, n int")
    assert [r.id for r in C.round_robin(s, "g", [F.desc("n")], F.col("id"), 3).collect()] == [2, 3, 1]


def test_sources(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.md").write_bytes("中文".encode("gb18030"))
    (tmp_path / "y.md").write_bytes("﻿plain".encode())
    assert sorted(r.text for r in I.read_texts(spark, str(tmp_path)).collect()) == ["plain", "中文"]
    (tmp_path / "j.jsonl").write_text('{"id": 1}\n{"id": 2}\n{"id": \n{"id": 4}\n')
    assert [r.id for r in I.read_journal(spark, str(tmp_path / "j.jsonl"), "id int").orderBy("id").collect()] == [1, 2]
    assert I.find_member('{"a": [{"table_body": ""}, {"b": {"table_body": "<t>"}}]}') == "<t>" and I.find_member("bad") is None
    parts = I.split_parts(spark.createDataFrame([("a.pdf", 450), ("b.PDF", 3), ("c.pdf", None)], "name string, pages int"))
    assert rows(parts, "part_name", "first_page", "last_page") == [("a_part001.pdf", 0, 199), ("a_part002.pdf", 200, 399), ("a_part003.pdf", 400, 449), ("b.PDF", 0, 2), ("c.pdf", None, None)]
    pdfs = spark.createDataFrame([("a.pdf",), ("0a1b2c3d-0000-0000-0000-0123456789ab_origin.pdf",), ("b.pdf",)], "name string")
    assert rows(I.pending_pdfs(pdfs, spark.createDataFrame([("b.pdf", "full.md"), ("a.pdf", "x.txt")], "name string, file string")), "name") == [("a.pdf",)]


def test_clients_and_registry(spark):
    class Failing:
        def chat(self, p):
            if "bad" in p:
                raise RuntimeError("no")
            return p.upper()

    assert clients.answer(Failing(), "bad", 2, lambda s: None) == (None, "model_error", "RuntimeError: no")
    tasks = spark.createDataFrame([("c1", "text", "a"), ("c2", "map", " "), ("c3", "image", "x")], "chunk_id string, kind string, p string")
    out = clients.call_model(tasks, "chunk_id", "p", clients.EchoChat)
    assert rows(out, "chunk_id", "response", "status") == [("c1", "a", "completed"), ("c2", None, "skipped_empty"), ("c3", "x", "completed")]
    reg = clients.Registry()
    reg.register("text", lambda df: df.select("chunk_id", F.lit("completed").alias("status"), F.lit(1).alias("entities"), F.lit(0).alias("relations")))
    with pytest.raises(ValueError):
        reg.register("text", clients.empty_extractor)
    assert rows(reg.dispatch(tasks, "kind", ["text", "map"]), "chunk_id", "status") == [("c1", "completed"), ("c2", "not_implemented"), ("c3", "skipped_kind")]


def test_resume(spark, tmp_path):
    from sparkloom.streaming.incremental import run_batches

    for k in range(3):
        spark.range(k * 10, k * 10 + 10).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    seen = []
    stream = lambda: spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    run_batches(stream(), str(tmp_path / "cp"), lambda df, n: seen.append((n, df.count())))
    assert [c for _, c in seen] == [10, 10, 10]
    run_batches(stream(), str(tmp_path / "cp"), lambda df, n: seen.append((n, df.count())))
    assert len(seen) == 3
