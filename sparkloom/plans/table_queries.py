"""Queries of parsing: HTML, Markdown, lines, grids, values, formulas; and of incremental work and clients."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.functions import scalars as S
from sparkloom.operators import chunks as C
from sparkloom.operators import grids as T
from sparkloom.operators import lines as L
from sparkloom.plans.registry import register
from sparkloom.sources.tables import read


def html_title_clean(spark: SparkSession, sf: str) -> DataFrame:
    p = read(spark, sf, "pages")
    return p.select("page_id", L.clean_inline(F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1)).alias("title"))


register("html_title_clean", html_title_clean, """
SELECT page_id, trim(regexp_replace(regexp_replace(replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_extract(html, '<title>(.*?)</title>', 1, 's'), '<[^>]+>', '', 'g'),
  '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&apos;', ''''), '&nbsp;', ' '), '&amp;', '&'), '[　 ]', ' ', 'g'), '[ \t]+', ' ', 'g')) AS title FROM pages
""")


def html_paragraphs(spark: SparkSession, sf: str) -> DataFrame:
    found = F.regexp_extract_all("html", F.lit("(?s)<p>(.*?)</p>"), F.lit(1))
    return read(spark, sf, "pages").select("page_id", F.posexplode(found).alias("pos", "p")).groupBy("page_id").agg(F.count("*").alias("n"), F.sum(F.char_length("p")).alias("chars"))


register("html_paragraphs", html_paragraphs, """
WITH p AS (SELECT page_id, unnest(regexp_extract_all(html, '<p>(.*?)</p>', 1, 's')) AS p FROM pages) SELECT page_id, count(*) AS n, CAST(sum(length(p)) AS BIGINT) AS chars FROM p GROUP BY 1
""")


def value_parse(spark: SparkSession, sf: str) -> DataFrame:
    li = read(spark, sf, "lineitem")
    q = F.col("l_quantity").cast("int").cast("string")
    text = F.when(F.col("l_linenumber") == 1, F.concat(F.lit("<"), q, F.lit(" ppm"))).when(F.col("l_linenumber") == 2, F.concat(q, F.lit("-12 %"))).when(F.col("l_linenumber") == 3, F.lit("N/A")).when(F.col("l_linenumber") == 4, F.concat(F.lit("about "), q)).otherwise(F.concat(q, F.lit(",000")))
    v = T.parse_value(text)
    return li.select("l_orderkey", "l_linenumber", v["value_type"].alias("value_type"), v["num"].alias("num"), v["min_value"].alias("min_value"), v["max_value"].alias("max_value"), v["comparator"].alias("comparator"), v["unit"].alias("unit"))


register("value_parse", value_parse, """
WITH l AS (SELECT l_orderkey, l_linenumber AS n, CAST(l_quantity AS INTEGER) AS q FROM lineitem)
SELECT l_orderkey, n AS l_linenumber, CASE n WHEN 1 THEN 'number' WHEN 2 THEN 'range' WHEN 3 THEN 'missing' WHEN 4 THEN 'text' ELSE 'number' END AS value_type,
  CAST(CASE WHEN n = 1 THEN q WHEN n >= 5 THEN q * 1000 END AS DOUBLE) AS num, CAST(CASE WHEN n = 2 THEN least(q, 12) END AS DOUBLE) AS min_value, CAST(CASE WHEN n = 2 THEN greatest(q, 12) END AS DOUBLE) AS max_value,
  CASE WHEN n = 1 THEN '<' ELSE '' END AS comparator, CASE n WHEN 1 THEN 'ppm' WHEN 2 THEN '%' ELSE '' END AS unit FROM l
""")


def cross_reference(spark: SparkSession, sf: str) -> DataFrame:
    c = read(spark, sf, "conversations").withColumn("text", F.concat(F.lit("As shown (Fig. "), (F.col("turn") % 4).cast("string"), F.lit("; Table 2) here, not Fig. 9 there")))
    assets = spark.createDataFrame([(i, lab, str(i % 5)) for i, lab in enumerate(["Fig", "Fig", "Table", "Fig", "Table", "Fig"])], "asset_id int, label string, number string")
    return L.cross_references(c, ["conv_id", "turn"], "text", assets, ["asset_id"], "label", "number")


register("cross_reference", cross_reference, """
WITH a(asset_id, label, number) AS (VALUES (0, 'fig', '0'), (1, 'fig', '1'), (2, 'table', '2'), (3, 'fig', '3'), (4, 'table', '4'), (5, 'fig', '0')),
r AS (SELECT conv_id, turn, 'fig' AS label, CAST(turn % 4 AS VARCHAR) AS number FROM conversations UNION SELECT conv_id, turn, 'table', '2' FROM conversations)
SELECT DISTINCT conv_id, turn, CAST(asset_id AS INTEGER) AS asset_id FROM r JOIN a USING (label, number)
""")


def _table_html(spark: SparkSession, sf: str) -> DataFrame:
    s = read(spark, sf, "supplier")
    rows = F.concat(F.lit("<tr><td rowspan=2>"), "s_name", F.lit("</td><td>"), F.col("s_nationkey").cast("string"), F.lit("</td></tr><tr><td>7 ppm</td></tr>"))
    return s.select("s_suppkey", F.concat(F.lit("<table><tr><th colspan=2>Head</th></tr><tr><th>A</th><th>B</th></tr>"), rows, F.lit("</table>")).alias("html"))


def html_grid(spark: SparkSession, sf: str) -> DataFrame:
    cells = T.cells(_table_html(spark, sf), "s_suppkey", "html")
    return cells.groupBy("s_suppkey").agg(F.count("*").alias("cells"), F.max("row_end").alias("last_row"), F.max("col_end").alias("last_col"), F.count_if("is_header").alias("headers"))


register("html_grid", html_grid, "SELECT s_suppkey, CAST(6 AS BIGINT) AS cells, 3 AS last_row, 1 AS last_col, CAST(3 AS BIGINT) AS headers FROM supplier")


def grid_matrix(spark: SparkSession, sf: str) -> DataFrame:
    m = T.matrix(T.cells(_table_html(spark, sf), "s_suppkey", "html"), "s_suppkey")
    return m.select("s_suppkey", F.array_join(F.transform("matrix", lambda r: F.array_join(r, "|")), "/").alias("grid"))


register("grid_matrix", grid_matrix, "SELECT s_suppkey, 'Head|Head/A|B/' || s_name || '|' || s_nationkey || '/' || s_name || '|7 ppm' AS grid FROM supplier")


def grid_headers(spark: SparkSession, sf: str) -> DataFrame:
    cells = T.cells(_table_html(spark, sf), "s_suppkey", "html")
    return T.header_paths(cells, T.structure(cells, "s_suppkey"), "s_suppkey")


register("grid_headers", grid_headers, "SELECT s_suppkey, col, path FROM supplier, (VALUES (0, 'A'), (1, 'B')) v(col, path)")


def pipe_tables(spark: SparkSession, sf: str) -> DataFrame:
    n = read(spark, sf, "nation")
    md = F.concat(F.lit("| name | region |\n|---|---|\n| "), "n_name", F.lit(" | "), F.col("n_regionkey").cast("string"), F.lit(" |\n| short |"))
    return n.select("n_nationkey", T.pipe_table_html(md).alias("html"))


register("pipe_tables", pipe_tables, """
SELECT n_nationkey, '<table><tr><th>name</th><th>region</th></tr><tr><td>' || n_name || '</td><td>' || n_regionkey || '</td></tr><tr><td>short</td><td></td></tr></table>' AS html FROM nation
""")


def section_tree(spark: SparkSession, sf: str) -> DataFrame:
    text = F.concat(F.lit("# T\n## 1 Intro\n"), "n_name", F.lit("\n### 1.1 Part\nx\n## 2 Next\ny\n## References\nz"))
    docs = read(spark, sf, "nation").select("n_nationkey", text.alias("text"))
    found = L.section_parents(L.sections(L.explode_lines(docs, "n_nationkey", "text"), "n_nationkey"), "n_nationkey")
    return found.select("n_nationkey", "section_no", "level", "heading", "body", "parent_no")


register("section_tree", section_tree, """
SELECT n_nationkey, CAST(no AS BIGINT) AS section_no, level, heading, CASE no WHEN 1 THEN n_name WHEN 2 THEN 'x' ELSE 'y' END AS body, CAST(p AS BIGINT) AS parent_no
FROM nation, (VALUES (1, 2, '1 Intro', NULL), (2, 3, '1.1 Part', 1), (3, 2, '2 Next', NULL)) s(no, level, heading, p)
""")


def document_titles(spark: SparkSession, sf: str) -> DataFrame:
    return L.titles(L.explode_lines(read(spark, sf, "documents"), "doc_id", "text"), "doc_id").select("doc_id", F.md5(F.col("title").cast("binary")).alias("title_md5"), "title_pos")


register("document_titles", document_titles, """
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents)
SELECT doc_id, md5(min_by(trim(line), pos)) AS title_md5, CAST(min(pos) AS INTEGER) AS title_pos FROM l WHERE trim(line) <> '' GROUP BY 1
""")


def formula_symbols(spark: SparkSession, sf: str) -> DataFrame:
    text = F.concat(F.lit("a $$ E = m c^2 $$ b $$ k_"), F.col("n_nationkey").cast("string"), F.lit(" = \\alpha P $$"))
    docs = read(spark, sf, "nation").select("n_nationkey", text.alias("text"))
    f = L.formulas(docs, "n_nationkey", "text")
    return f.select("n_nationkey", "formula_no", F.array_join(L.symbols(F.col("latex")), ",").alias("symbols"))


register("formula_symbols", formula_symbols, """
SELECT n_nationkey, 1 AS formula_no, 'E,c,m' AS symbols FROM nation UNION ALL SELECT n_nationkey, 2, CASE WHEN n_nationkey < 10 THEN 'P,k_' || n_nationkey || ',\\alpha' ELSE 'P,k_' || n_nationkey || ',\\alpha' END FROM nation
""".replace("\\\\", "\\"))


def modality_filter(spark: SparkSession, sf: str) -> DataFrame:
    e = read(spark, sf, "events")
    raw = F.expr("CASE event_type WHEN 'click' THEN 'Figure' WHEN 'view' THEN ' text' WHEN 'error' THEN 'equation' WHEN 'signup' THEN 'TABLE' ELSE 'video' END")
    return e.withColumn("modality", C.modality(raw)).groupBy("modality").agg(F.count("*").alias("n"))


register("modality_filter", modality_filter, """
SELECT CASE event_type WHEN 'click' THEN 'image' WHEN 'view' THEN 'text' WHEN 'error' THEN 'formula' WHEN 'signup' THEN 'table' END AS modality, count(*) AS n FROM events GROUP BY 1
""")


def flattened_chunks(spark: SparkSession, sf: str) -> DataFrame:
    n = read(spark, sf, "nation").select("n_regionkey", F.struct(F.concat(F.lit("c"), "n_nationkey").alias("id"), F.lit("Text").alias("modality"), F.col("n_name").alias("text"), F.when(F.col("n_nationkey") % 2 == 0, F.lit("own")).alias("section_title")).alias("c"))
    s = n.groupBy("n_regionkey").agg(F.array_sort(F.collect_list("c")).alias("chunks"))
    docs = s.select(F.lit("d").alias("document_id"), F.lit("T").alias("title"), F.array(F.struct(F.concat(F.lit("s"), "n_regionkey").alias("id"), F.lit("Sec").alias("title"), F.lit("sum").alias("summary"), F.array(F.lit("k")).alias("schemaKeys"), "chunks")).alias("sections"))
    return C.flatten_sections(docs).select("section_id", "section_title", "chunk_id", "modality", "summary", "text")


register("flattened_chunks", flattened_chunks, """
SELECT 's' || n_regionkey AS section_id, CASE WHEN n_nationkey % 2 = 0 THEN 'own' ELSE 'Sec' END AS section_title, 'c' || n_nationkey AS chunk_id, 'text' AS modality, 'sum' AS summary, n_name AS text FROM nation
""")


def resume_stream(spark: SparkSession, sf: str) -> DataFrame:
    from sparkloom.streaming.incremental import process_available

    return process_available(spark, f"{sf}/events.parquet", "event_id", lambda df: df.groupBy("event_type").agg(F.count("*").alias("n")))


register("resume_stream", resume_stream, "SELECT event_type, count(*) AS n FROM events GROUP BY 1")


def client_stub(spark: SparkSession, sf: str) -> DataFrame:
    from sparkloom.functions.clients import EchoChat, call_model

    prompts = read(spark, sf, "nation").select("n_nationkey", F.concat(F.lit("<think>x</think>name: "), "n_name").alias("prompt"))
    out = call_model(prompts, "n_nationkey", "prompt", EchoChat)
    return out.select("n_nationkey", S.without_thinking("response").alias("response"), "status")


register("client_stub", client_stub, "SELECT n_nationkey, 'name: ' || n_name AS response, 'completed' AS status FROM nation")
