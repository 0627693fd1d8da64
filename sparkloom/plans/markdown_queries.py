"""Queries of Markdown, caption, asset and chunk operators over texts made of the star schema's rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.operators import chunks as C
from sparkloom.operators import geometry as Y
from sparkloom.operators import grids as T
from sparkloom.operators import lines as L
from sparkloom.plans.registry import register
from sparkloom.sources.tables import read

_S = F.lit


def _text(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def newlines(spark: SparkSession, sf: str) -> DataFrame:
    mixed = F.regexp_replace(F.regexp_replace("text", "\n", "\r\n"), "\\. ", ".\r")
    return read(spark, sf, "documents").select("doc_id", F.md5(L.normalize_newlines(mixed).cast("binary")).alias("text_md5"))


register("newlines", newlines, "SELECT doc_id, md5(replace(text, '. ', '.' || chr(10))) AS text_md5 FROM documents")


def _papers(spark: SparkSession, sf: str) -> DataFrame:
    """A paper for each customer: its intro has as many lines as the key mod 4, its references one as the key mod 3."""
    k = F.col("c_custkey")
    intro = F.array_join(F.array_repeat(_S("intro\n"), (k % 4).cast("int")), "")
    text = _text("# ", F.col("c_name"), "\n", intro, "Authors: ", F.col("c_name"), "; ", F.col("c_mktsegment"), "\nAbstract: about ", F.col("c_mktsegment"), "\nKeywords: ", F.col("c_mktsegment"), "; key ", k.cast("string"), "\n## 1 First\nbody ", k.cast("string"), "\n### 1.1 Deep\nmore\n## References\n[1] x")
    return read(spark, sf, "customer").select("c_custkey", text.alias("text"))


def preamble_bounds(spark: SparkSession, sf: str) -> DataFrame:
    return L.boundaries(L.explode_lines(_papers(spark, sf), "c_custkey", "text"), "c_custkey")


register("preamble_bounds", preamble_bounds, """
SELECT c_custkey, CAST(8 + c_custkey % 4 AS INTEGER) AS reference_pos, CAST(4 + c_custkey % 4 AS INTEGER) AS first_section_pos, CAST(3 + c_custkey % 4 AS INTEGER) AS preamble_end FROM customer
""")


def preamble_metadata(spark: SparkSession, sf: str) -> DataFrame:
    m = L.metadata(_papers(spark, sf), "c_custkey", "text")
    return m.select("c_custkey", "abstract", F.array_join("keywords", "|").alias("keywords"), F.array_join("authors", "|").alias("authors"))


register("preamble_metadata", preamble_metadata, """
SELECT c_custkey, 'about ' || c_mktsegment AS abstract, c_mktsegment || '|key ' || c_custkey AS keywords, c_name || '|' || c_mktsegment AS authors FROM customer
""")


def embedded_tables(spark: SparkSession, sf: str) -> DataFrame:
    table = lambda c: _text("<table><tr><td>", F.col(c).cast("string"), "</td></tr></table>")
    docs = read(spark, sf, "supplier").select("s_suppkey", _text("a\n", table("s_name"), "\nb ", F.when(F.col("s_nationkey") > 9, table("s_nationkey")).otherwise("<p>none</p>")).alias("text"))
    return L.html_tables(docs, "s_suppkey", "text")


register("embedded_tables", embedded_tables, """
SELECT s_suppkey, 1 AS table_no, '<table><tr><td>' || s_name || '</td></tr></table>' AS html FROM supplier
UNION ALL SELECT s_suppkey, 2, '<table><tr><td>' || s_nationkey || '</td></tr></table>' FROM supplier WHERE s_nationkey > 9
""")


def canonical_tables(spark: SparkSession, sf: str) -> DataFrame:
    html = _text("<TABLE class=x><TR><th ColSpan=2 >", F.col("s_name"), "<br>&amp; Co</TH></tr><tr><td rowspan='1'> ", F.col("s_nationkey").cast("string"), " </td><td>x  y</td></tr></TABLE>")
    return T.canonicalise(read(spark, sf, "supplier").select("s_suppkey", html.alias("html")), "s_suppkey", "html")


register("canonical_tables", canonical_tables, """
SELECT s_suppkey, '<table><tr><th colspan="2">' || s_name || ' &amp; Co</th></tr><tr><td>' || s_nationkey || '</td><td>x y</td></tr></table>' AS canonical FROM supplier
""")


def _figures(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of a page for each part: a captioned table image, as many further images as the size mod 3, a figure with two."""
    k = F.col("p_partkey").cast("string")
    more = F.array_join(F.transform(F.sequence(_S(0), F.col("p_size") % 3), lambda i: F.when(i > 0, _text("![](t", i.cast("string"), ".png)\n")).otherwise("")), "")
    text = _text("Table ", k, " sizes\nnote\n![](t.png)\n", more, "plain\n![](a.png)\n\n![](b.png)\nFig. ", k, " shows")
    return L.explode_lines(read(spark, sf, "part").select("p_partkey", text.alias("text")), "p_partkey", "text")


def captioned_images(spark: SparkSession, sf: str) -> DataFrame:
    rows = _figures(spark, sf).withColumn("is_table", F.col("line").rlike(r"\(t"))
    return Y.captioned_image_tables(rows, "p_partkey", "is_table").select("p_partkey", "table_no", "caption", F.array_join("paths", "|").alias("paths"))


register("captioned_images", captioned_images, """
SELECT p_partkey, 1 AS table_no, 'Table ' || p_partkey || ' sizes' AS caption, CASE p_size % 3 WHEN 0 THEN 't.png' WHEN 1 THEN 't.png|t1.png' ELSE 't.png|t1.png|t2.png' END AS paths FROM part
""")


def figure_groups(spark: SparkSession, sf: str) -> DataFrame:
    return L.image_groups(_figures(spark, sf), "p_partkey").select("p_partkey", F.array_join("paths", "|").alias("paths"), "caption")


register("figure_groups", figure_groups, """
SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 't.png' WHEN 1 THEN 't.png|t1.png' ELSE 't.png|t1.png|t2.png' END AS paths, 'Fig. ' || p_partkey || ' shows' AS caption FROM part
UNION ALL SELECT p_partkey, 'a.png|b.png', 'Fig. ' || p_partkey || ' shows' FROM part
""")


def near_captions(spark: SparkSession, sf: str) -> DataFrame:
    found = L.nearby_caption(_figures(spark, sf), "p_partkey", F.col("line").startswith("!["), F.col("line").rlike("^(Table|Fig)"), before=3)
    return found.select("p_partkey", "line", "caption")


register("near_captions", near_captions, """
WITH i AS (SELECT p_partkey, p_size % 3 AS n, unnest(CASE p_size % 3 WHEN 0 THEN ['t.png', 'a.png', 'b.png'] WHEN 1 THEN ['t.png', 't1.png', 'a.png', 'b.png'] ELSE ['t.png', 't1.png', 't2.png', 'a.png', 'b.png'] END) AS f FROM part)
SELECT p_partkey, '![](' || f || ')' AS line, CASE WHEN f IN ('t.png', 't1.png') THEN 'Table ' || p_partkey || ' sizes' ELSE 'Fig. ' || p_partkey || ' shows' END AS caption FROM i
""")


def label_numbers(spark: SparkSession, sf: str) -> DataFrame:
    text = _text("see Fig. ", F.col("p_size").cast("string"), ", figure 7 and FIG ", F.col("p_partkey").cast("string"), ".2; Table 3")
    return read(spark, sf, "part").select("p_partkey", F.array_join(L.labelled_numbers(text, ["fig", "figure"]), "|").alias("numbers"))


register("label_numbers", label_numbers, """
SELECT p_partkey, CASE WHEN p_size = 7 THEN '7|' ELSE p_size || '|7|' END || p_partkey || '.2' AS numbers FROM part
""")


def removed_spans(spark: SparkSession, sf: str) -> DataFrame:
    d = read(spark, sf, "documents").where("char_length(text) >= 40")
    spans = d.select("doc_id", F.explode(F.array(*[F.struct(_S(a).alias("start"), _S(b).alias("end")) for a, b in ((5, 20), (0, 10), (30, 40))])).alias("s")).select("doc_id", "s.start", "s.end")
    return L.strip_spans_from(read(spark, sf, "documents"), "doc_id", "text", spans).select("doc_id", F.md5(F.col("text").cast("binary")).alias("text_md5"))


register("removed_spans", removed_spans, """
SELECT doc_id, md5(CASE WHEN length(text) >= 40 THEN substr(text, 21, 10) || substr(text, 41) ELSE text END) AS text_md5 FROM documents
""")


def sub_header_groups(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("p_size") % 4 + 2
    headers = F.concat(F.flatten(F.array_repeat(F.transform(F.sequence(_S(1), n), lambda i: _text("h", i.cast("string"))), 3)), F.when(F.col("p_size") % 3 == 0, F.array(_S("odd"))).otherwise(F.array().cast("array<string>")))
    return read(spark, sf, "part").select("p_partkey", T.repeating_groups(headers).alias("length"))


register("sub_header_groups", sub_header_groups, "SELECT p_partkey, CAST(CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_size % 4 + 2 END AS INTEGER) AS length FROM part")


def source_kinds(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("p_partkey").cast("string")
    md = F.expr("CASE p_size % 4 WHEN 0 THEN 'a.png\\n\\n b.JPG' WHEN 1 THEN '<Table><tr></tr></Table>' WHEN 2 THEN '| a | b |' ELSE 'words' END")
    chunks = read(spark, sf, "part").select(_text("c", k).alias("chunk_id"), F.when(F.col("p_size") > 40, F.array(_S("x.png"))).otherwise(F.array().cast("array<string>")).alias("table_path"), md.alias("markdown"))
    return T.table_sources(chunks)


register("source_kinds", source_kinds, """
SELECT 'c' || p_partkey AS chunk_id, 0 AS part, 'x.png' AS value, 'image' AS kind FROM part WHERE p_size > 40
UNION ALL SELECT 'c' || p_partkey, 0, 'a.png', 'image' FROM part WHERE p_size <= 40 AND p_size % 4 = 0 UNION ALL SELECT 'c' || p_partkey, 1, 'b.JPG', 'image' FROM part WHERE p_size <= 40 AND p_size % 4 = 0
UNION ALL SELECT 'c' || p_partkey, 0, '<Table><tr></tr></Table>', 'html' FROM part WHERE p_size <= 40 AND p_size % 4 = 1 UNION ALL SELECT 'c' || p_partkey, 0, '| a | b |', 'markdown' FROM part WHERE p_size <= 40 AND p_size % 4 = 2
""")


def _grid(spark: SparkSession, sf: str) -> DataFrame:
    s = read(spark, sf, "supplier")
    html = _text("<table><tr><th>A</th><th>B</th></tr><tr><td>", F.col("s_name"), "</td><td>", F.col("s_nationkey").cast("string"), "</td></tr></table>")
    return T.cells(s.select("s_suppkey", html.alias("html")), "s_suppkey", "html")


def attached_boxes(spark: SparkSession, sf: str) -> DataFrame:
    boxes = read(spark, sf, "supplier").select("s_suppkey", F.array(*[F.array(_S(0), _S(0), F.col("s_nationkey") - _S(i * 5), _S(9)) for i in range(4)]).alias("boxes"))
    return T.attach_boxes(_grid(spark, sf), boxes, "s_suppkey").select("s_suppkey", "cell_id", F.element_at("bbox", 3).alias("right"))


register("attached_boxes", attached_boxes, """
SELECT s_suppkey, id AS cell_id, CASE WHEN s_nationkey - 5 * i > 0 THEN s_nationkey - 5 * i END AS right FROM supplier, (VALUES ('r0c0', 0), ('r0c1', 1), ('r1c0', 2), ('r1c1', 3)) v(id, i)
""")


def recovered_rows(spark: SparkSession, sf: str) -> DataFrame:
    li = read(spark, sf, "lineitem")
    items = li.select("l_orderkey", F.col("l_quantity").alias("x"), (F.col("l_linenumber") * 10 + F.col("l_tax") * 10).alias("y"), F.col("l_linenumber").cast("string").alias("text"))
    keys = li.select("l_orderkey", F.col("l_linenumber").alias("row_no"), (F.col("l_linenumber") * 10).cast("double").alias("y"))
    centres = li.select("l_orderkey").distinct().select("l_orderkey", F.explode(F.array(_S(0), _S(1))).alias("col")).withColumn("x", F.col("col") * 50.0)
    return T.recover_rows(items, keys, centres, "l_orderkey", 3.0)


register("recovered_rows", recovered_rows, """
SELECT l_orderkey, l_linenumber AS row_no, CASE WHEN l_quantity <= 25 THEN 0 ELSE 1 END AS col, string_agg(CAST(l_linenumber AS VARCHAR), ' ') AS text FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_quantity, l_tax FROM lineitem) GROUP BY 1, 2, 3
""")


def table_scores(spark: SparkSession, sf: str) -> DataFrame:
    boxes = read(spark, sf, "supplier").select("s_suppkey", F.array_repeat(F.array(_S(0), _S(0), _S(5), _S(5)), (F.col("s_nationkey") % 5).cast("int")).alias("boxes"))
    ocr = read(spark, sf, "supplier").select("s_suppkey", F.explode(F.array(F.col("s_name"), F.lit("?" * 18))).alias("text"))
    q = T.table_quality(T.attach_boxes(_grid(spark, sf), boxes, "s_suppkey"), ocr, "s_suppkey")
    return q.select("s_suppkey", F.round("score", 6).alias("score"), F.size("errors").alias("n_errors"), "passed")


register("table_scores", table_scores, """
WITH s AS (SELECT s_suppkey, 0.35 + 0.35 * length(s_name) / (length(s_name) + 18) + 0.30 * (s_nationkey % 5) / 4 AS score FROM supplier)
SELECT s_suppkey, round(score, 6) AS score, 0 AS n_errors, score >= 0.55 AS passed FROM s
""")


def best_headers(spark: SparkSession, sf: str) -> DataFrame:
    c = read(spark, sf, "part").select("p_brand", F.col("p_size").alias("col"), F.split("p_name", " ")[0].alias("term"), F.floor("p_retailprice").alias("score"))
    return Y.repaired_headers(c, "p_brand")


register("best_headers", best_headers, """
WITH c AS (SELECT p_brand, p_size AS col, split_part(p_name, ' ', 1) AS term, floor(p_retailprice) AS score FROM part)
SELECT p_brand, col, term FROM (SELECT *, row_number() OVER (PARTITION BY p_brand, col ORDER BY score DESC, length(term) DESC, term) AS r FROM c) WHERE r = 1
""")


def latex_pick(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("n_nationkey")
    text = L.latex_text(F.when(k % 3 == 0, _S(" a  = b ")).otherwise(" "), F.when(k % 3 == 1, _text("$$ x_", k.cast("string"), "\n= y $$")), F.col("n_name"))
    return read(spark, sf, "nation").select("n_nationkey", text.alias("latex"))


register("latex_pick", latex_pick, "SELECT n_nationkey, CASE n_nationkey % 3 WHEN 0 THEN 'a = b' WHEN 1 THEN 'x_' || n_nationkey || ' = y' ELSE n_name END AS latex FROM nation")


def symbol_meanings(spark: SparkSession, sf: str) -> DataFrame:
    notes = _text("k — rate of ", F.col("n_name"), ", 1/s; m_", F.col("n_nationkey").cast("string"), " - mass\nnothing here")
    return read(spark, sf, "nation").select("n_nationkey", F.explode(L.symbol_notes(notes)).alias("symbol", "v")).select("n_nationkey", "symbol", "v.meaning", "v.unit")


register("symbol_meanings", symbol_meanings, """
SELECT n_nationkey, 'k' AS symbol, 'rate of ' || n_name AS meaning, '1/s' AS unit FROM nation UNION ALL SELECT n_nationkey, 'm_' || n_nationkey, 'mass', '' FROM nation
""")


def section_chunks(spark: SparkSession, sf: str) -> DataFrame:
    r = read(spark, sf, "customer")
    none = F.array().cast("array<string>")
    s = r.select(
        F.col("c_nationkey").alias("document_id"), F.col("c_custkey").cast("string").alias("section_id"), _text(F.col("c_name"), "\n\n", F.col("c_mktsegment")).alias("content"),
        F.when(F.col("c_custkey") % 2 == 0, F.array(_S("i1"), _S("i2"))).otherwise(none).alias("images"), F.array("c_mktsegment").alias("tables"), none.alias("formulas"),
    )
    return C.modality_chunks(s, 10)


register("section_chunks", section_chunks, """
WITH c AS (SELECT c_nationkey AS document_id, CAST(c_custkey AS VARCHAR) AS section_id, c_custkey AS k, c_name, c_mktsegment FROM customer),
r AS (SELECT document_id, section_id, 0 AS kind, 'text' AS modality, 0 AS i, c_name AS body FROM c UNION ALL SELECT document_id, section_id, 0, 'text', 1, c_mktsegment FROM c
  UNION ALL SELECT document_id, section_id, 1, 'image', 0, 'i1' FROM c WHERE k % 2 = 0 UNION ALL SELECT document_id, section_id, 1, 'image', 1, 'i2' FROM c WHERE k % 2 = 0
  UNION ALL SELECT document_id, section_id, 2, 'table', 0, c_mktsegment FROM c)
SELECT document_id, section_id, section_id || ':' || modality || ':' || i AS chunk_id, modality, body, CAST(row_number() OVER (PARTITION BY document_id, section_id ORDER BY kind, i) - 1 AS INTEGER) AS ord FROM r
""")


def prompt_parts(spark: SparkSession, sf: str) -> DataFrame:
    e = read(spark, sf, "events").select("event_id", F.col("event_id").cast("string").alias("id"), F.when(F.col("event_type") == "click", "image").otherwise("text").alias("kind"), F.when(F.col("event_type") != "view", F.col("props")).alias("text"), F.col("event_type").alias("caption"))
    return e.select("event_id", C.text_part("kind", "id", "text", "caption").alias("part"))


register("prompt_parts", prompt_parts, """
SELECT event_id, '[' || CASE WHEN event_type = 'click' THEN 'image' ELSE 'text' END || ' ' || event_id || ']' || chr(10) || CASE event_type WHEN 'click' THEN 'click' WHEN 'view' THEN '' ELSE props END AS part FROM events
""")


def allowed_categories(spark: SparkSession, sf: str) -> DataFrame:
    values = F.array(F.col("p_brand"), _text(" ", F.col("p_type"), " "), F.col("p_brand"), F.lit("nothing"), F.col("p_name"))
    p = read(spark, sf, "part")
    return p.select("p_partkey", F.array_join(C.whitelist(values, F.array("p_type", "p_brand", "p_name"), 2), "|").alias("kept"))


register("allowed_categories", allowed_categories, "SELECT p_partkey, p_brand || '|' || p_type AS kept FROM part")
