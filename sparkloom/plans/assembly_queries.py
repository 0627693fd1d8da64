"""Queries of whole results: parsed documents, table, process and profile graphs, runs; and of sources, sinks and clients."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkloom.functions import clients as K
from sparkloom.operators import assembly as B
from sparkloom.operators import geometry as Y
from sparkloom.operators import graphs as G
from sparkloom.operators import joins as J
from sparkloom.operators import rules as R
from sparkloom.plans.registry import register
from sparkloom.sources import files as I
from sparkloom.sources.scratch import shared_folder
from sparkloom.sources.tables import read
from sparkloom.streaming import incremental as N


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/files-{uuid.uuid4().hex}"


def _reports(spark: SparkSession, sf: str) -> DataFrame:
    s = read(spark, sf, "supplier")
    k = F.col("s_suppkey").cast("string")
    text = F.concat(F.lit("# "), "s_name", F.lit("\r\n## 1 Data\r\nrow <table><tr><td>"), k, F.lit("</td></tr></table>\r\n\r\nand $$ x_"), k, F.lit(" $$ end\r\n### 1.1 Plate\r\n![p]("), k, F.lit(".png)\r\n## References\r\n[1]"))
    return s.select("s_suppkey", text.alias("text"))


def parsed_documents(spark: SparkSession, sf: str) -> DataFrame:
    return B.parse_documents(_reports(spark, sf), "s_suppkey", "text").select("s_suppkey", "title", "section_no", "level", "heading", "parent_no")


register("parsed_documents", parsed_documents, """
SELECT s_suppkey, s_name AS title, CAST(no AS BIGINT) AS section_no, level, heading, CAST(p AS BIGINT) AS parent_no FROM supplier, (VALUES (1, 2, '1 Data', NULL), (2, 3, '1.1 Plate', 1)) v(no, level, heading, p)
""")


def section_assets(spark: SparkSession, sf: str) -> DataFrame:
    parsed = B.parse_documents(_reports(spark, sf), "s_suppkey", "text")
    assets, rest = B.section_assets(parsed, ["s_suppkey", "section_no"], "body")
    return assets.unionByName(rest.select("s_suppkey", "section_no", F.lit("text").alias("kind"), F.lit(0).alias("asset_no"), "content"))


register("section_assets", section_assets, """
SELECT s_suppkey, CAST(1 AS BIGINT) AS section_no, 'table' AS kind, 1 AS asset_no, '<table><tr><td>' || s_suppkey || '</td></tr></table>' AS content FROM supplier
UNION ALL SELECT s_suppkey, 1, 'formula', 1, '$$ x_' || s_suppkey || ' $$' FROM supplier UNION ALL SELECT s_suppkey, 2, 'image', 1, '![p](' || s_suppkey || '.png)' FROM supplier
UNION ALL SELECT s_suppkey, 1, 'text', 0, 'row ' || chr(10) || 'and  end' FROM supplier UNION ALL SELECT s_suppkey, 2, 'text', 0, '' FROM supplier
""")


def _sample_tables(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    alone = F.count("*").over(Window.partitionBy("l_orderkey", "l_linenumber")) == 1  # two records of one row would be ambiguous
    li = read(spark, sf, "lineitem").withColumn("alone", alone).where("alone")
    texts = [F.concat(F.lit("S"), F.col("l_linenumber").cast("string")), F.when(F.col("l_returnflag") == "A", "N/A").otherwise(F.col("l_returnflag")), F.col("l_linestatus"), F.when(F.col("l_tax") > 0.04, "5").otherwise("")]
    cells = li.select(
        F.lit("d").alias("document_id"), F.col("l_orderkey").cast("string").alias("table_id"), F.col("l_linenumber").alias("row"),
        F.posexplode(F.array(*texts)).alias("col", "text"),
    )
    tables = cells.select("table_id").distinct()
    plans = tables.select("table_id", F.lit("Sample").alias("subject_type"), F.lit(0).alias("subject_col"), F.lit(1).alias("data_start_row"))
    heads = F.array(*[F.struct(F.lit(c).alias("col"), F.lit(t).cast("string").alias("context_type"), F.lit(m).cast("string").alias("mineral")) for c, t, m in ((1, "Well", None), (2, "Lithology", None), (3, None, "quartz"))])
    return cells, plans, tables.select("table_id", F.inline(heads))


def domain_graph(spark: SparkSession, sf: str) -> DataFrame:
    entities, relations = B.domain_graph(*_sample_tables(spark, sf))
    e = entities.groupBy("type").agg(F.count("*").alias("n"))
    return e.unionByName(relations.groupBy("type").agg(F.count("*").alias("n")))


def _domain_sql() -> str:
    rows = "l AS (SELECT DISTINCT l_orderkey AS t, l_linenumber AS n, l_returnflag AS w, l_linestatus AS r, l_tax > 0.04 AS q FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS k FROM lineitem) WHERE k = 1)"
    return f"""WITH {rows} SELECT 'Sample' AS type, count(DISTINCT n) AS n FROM l UNION ALL SELECT 'Well', count(DISTINCT w) FROM l WHERE w <> 'A' UNION ALL SELECT 'Lithology', count(DISTINCT r) FROM l UNION ALL SELECT 'Mineral', 1
UNION ALL SELECT 'REPORTS', count(*) FROM (SELECT DISTINCT t, n FROM l) UNION ALL SELECT 'RECORDED_IN', count(*) FROM (SELECT DISTINCT t, n FROM l)
UNION ALL SELECT 'COLLECTED_FROM', (SELECT count(*) FROM (SELECT DISTINCT n, w FROM l WHERE w <> 'A')) + (SELECT count(*) FROM (SELECT DISTINCT n, r FROM l)) UNION ALL SELECT 'DESCRIBES', count(*) FROM (SELECT DISTINCT t, r FROM l)
UNION ALL SELECT 'COMPOSED_OF', count(DISTINCT r) FROM l WHERE q"""


register("domain_graph", domain_graph, _domain_sql())


def cell_sources(spark: SparkSession, sf: str) -> DataFrame:
    p = read(spark, sf, "part")
    whole, cell = B.cell_provenance(F.col("p_brand"), F.col("p_type")), B.cell_provenance(F.col("p_brand"), F.col("p_type"), F.col("p_size"), F.lit(2), F.col("p_name"))
    return p.select("p_partkey", F.when(F.col("p_size") > 25, cell).otherwise(whole).alias("provenance"))


register("cell_sources", cell_sources, """
SELECT p_partkey, p_brand || ' | table=' || p_type || CASE WHEN p_size > 25 THEN ' | row=' || p_size || '-' || p_size || ',col=2-2 | ' || p_name ELSE '' END AS provenance FROM part
""")


def table_runs(spark: SparkSession, sf: str) -> DataFrame:
    o, li = read(spark, sf, "orders").select("o_orderkey"), read(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    quality = li.groupBy("o_orderkey").agg((F.max("l_quantity") > 30).alias("passed"))
    return B.table_run(o, quality, li.where("l_returnflag = 'R'"), "o_orderkey")


register("table_runs", table_runs, """
WITH q AS (SELECT l_orderkey, max(l_quantity) > 30 AS passed, count(*) FILTER (l_returnflag = 'R') AS n FROM lineitem GROUP BY 1)
SELECT o_orderkey, CASE WHEN passed IS NULL THEN 'failed' WHEN passed THEN 'success' ELSE 'manual_review' END AS status, coalesce(n, 0) AS n_entities FROM orders LEFT JOIN q ON l_orderkey = o_orderkey
""")


def process_graph(spark: SparkSession, sf: str) -> DataFrame:
    p = read(spark, sf, "part").select(F.col("p_brand").alias("g"), F.col("p_partkey").cast("string").alias("k"), "p_name", "p_type", F.col("p_partkey").alias("pos"), "p_size")
    legend = p.select("g", F.concat(F.lit("a"), "k").alias("local_id"), F.col("p_type").alias("name"), F.lit("lithology").alias("type"), "pos")
    scene = p.select("g", F.concat(F.lit("b"), "k").alias("local_id"), F.when(F.col("p_size") % 2 == 0, F.col("p_type")).otherwise(F.concat(F.lit("u"), "k")).alias("name"), F.lit("unit").alias("type"), "pos")
    drawn = p.select("g", F.concat(F.lit("b"), "k").alias("source"), F.lit("has_lithology").alias("type"), F.col("p_type").alias("target"), "pos")
    wild = p.select("g", F.concat(F.lit("b"), "k").alias("source"), F.lit("near").alias("type"), F.when(F.col("p_size") > 40, "nowhere").otherwise(F.concat(F.lit("u"), "k")).alias("target"), "pos")
    e, r, d = B.process_graph([legend, scene], [drawn, wild], "g")
    n = lambda df, kind: df.groupBy("g", F.col(kind).alias("kind")).agg(F.count("*").alias("n"))
    return n(e, "type").unionByName(n(r, "type")).unionByName(n(d, "reason"))


register("process_graph", process_graph, """
WITH p AS (SELECT p_brand AS g, p_partkey AS k, p_type AS t, p_size AS s FROM part)
SELECT g, 'lithology' AS kind, count(DISTINCT t) AS n FROM p GROUP BY 1 UNION ALL SELECT g, 'unit', count(*) FROM p WHERE s % 2 = 1 GROUP BY 1
UNION ALL SELECT g, 'has_lithology', count(*) FROM p WHERE s % 2 = 1 GROUP BY 1 UNION ALL SELECT g, 'unresolved_endpoint', count(*) FROM p WHERE s > 40 OR s % 2 = 0 GROUP BY 1
UNION ALL SELECT g, 'self_relation', count(*) FROM (SELECT g FROM p WHERE s % 2 = 0 UNION ALL SELECT g FROM p WHERE s % 2 = 1 AND s <= 40) GROUP BY 1
""")


def profile_graph(spark: SparkSession, sf: str) -> DataFrame:
    n, s = read(spark, sf, "nation"), read(spark, sf, "supplier")
    profiles = n.select(F.col("n_nationkey").alias("g"), F.col("n_name").alias("name"))
    items = s.select(F.col("s_nationkey").alias("g"), F.col("s_suppkey").cast("string").alias("local_id"), F.col("s_name").alias("name"), F.when(F.col("s_acctbal") > 5000, "log_curve").otherwise("interval").alias("type"), (F.col("s_acctbal") / 9000).alias("confidence"))
    rel = s.select(F.col("s_nationkey").alias("g"), F.col("s_suppkey").cast("string").alias("source"), F.lit("aligned_with").alias("type"), (F.col("s_suppkey") + 1).cast("string").alias("target"), F.lit(0.8).alias("confidence"), F.lit(False).alias("explicit"))
    e, r = B.profile_graph(profiles, items, rel, "g")
    return e.groupBy("g").agg(F.count("*").alias("entities"), F.round(F.sum("confidence"), 3).alias("confidence")).join(r.groupBy("g").agg(F.count_if(F.col("type") == "has_log_curve").alias("curves"), F.count_if(F.col("type") == "aligned_with").alias("aligned")), "g", "left").na.fill(0)


register("profile_graph", profile_graph, """
SELECT n_nationkey AS g, 1 + count(s_suppkey) AS entities, round(1 + coalesce(sum(round(least(1.0, greatest(0.0, s_acctbal / 9000)), 3)), 0), 3) AS confidence, count(*) FILTER (s_acctbal > 5000) AS curves,
  count(*) FILTER (EXISTS (SELECT 1 FROM supplier t WHERE t.s_nationkey = n_nationkey AND t.s_suppkey = s.s_suppkey + 1)) AS aligned FROM nation LEFT JOIN supplier s ON s_nationkey = n_nationkey GROUP BY 1
""")


def precedence_relations(spark: SparkSession, sf: str) -> DataFrame:
    li = read(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")
    part = lambda cond: li.where(cond).select("l_partkey", "l_suppkey").distinct()
    return B.relations_by_precedence({"structural": part("l_returnflag = 'R'"), "visual": part("l_linestatus = 'F'"), "vertical": part("true")}, ["l_partkey", "l_suppkey"])


register("precedence_relations", precedence_relations, """
SELECT l_partkey, l_suppkey, CASE WHEN bool_or(l_returnflag = 'R') THEN 'structural' WHEN bool_or(l_linestatus = 'F') THEN 'visual' ELSE 'vertical' END AS basis FROM lineitem GROUP BY 1, 2
""")


def hybrid_quality(spark: SparkSession, sf: str) -> DataFrame:
    p = read(spark, sf, "part").withColumnRenamed("p_brand", "image")
    labels = p.select("image", F.col("p_size").cast("double").alias("y"), (F.col("p_size") * 2.0 + 10).alias("value"))
    edges = p.groupBy("image", F.col("p_size").cast("double").alias("x")).agg(F.count("*").alias("support"))
    features = p.select("image", F.col("p_partkey").alias("feature_id"), F.col("p_size").cast("double").alias("top_y"), (F.col("p_size") + 1.0).alias("bottom_y"))
    units = p.select("image").distinct().select("image", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("i")).select("image", F.col("i").alias("unit_id"), F.lit(None).cast("int").alias("parent_id"), (F.col("i") * 30.0).alias("top"), (F.col("i") * 30.0 + 30).alias("bottom"))
    q = B.hybrid_result(labels, edges, features, units, "image")["quality"]
    return q.select("image", F.round("rmse", 4).alias("rmse"), "n_tracks", "n_intervals", "n_alignments")


register("hybrid_quality", hybrid_quality, """
WITH t AS (SELECT image, count(*) AS n FROM (SELECT p_brand AS image, p_size, lead(p_size) OVER (PARTITION BY p_brand ORDER BY p_size) - p_size AS w FROM (SELECT DISTINCT p_brand, p_size FROM part)) WHERE w >= 3 GROUP BY 1),
a AS (SELECT p_brand AS image, count(*) AS n FROM part, range(0, 5) u(i) WHERE (least(p_size * 2 + 12, i * 30 + 30) - greatest(p_size * 2 + 10, i * 30)) / 2 >= 0.15 GROUP BY 1)
SELECT p_brand AS image, 0.0::DOUBLE AS rmse, coalesce(any_value(t.n), 0) AS n_tracks, count(*) AS n_intervals, coalesce(any_value(a.n), 0) AS n_alignments FROM part LEFT JOIN t ON t.image = p_brand LEFT JOIN a ON a.image = p_brand GROUP BY 1
""")


def result_records(spark: SparkSession, sf: str) -> DataFrame:
    n, c, s = read(spark, sf, "nation"), read(spark, sf, "customer"), read(spark, sf, "supplier")
    images = n.select(F.col("n_nationkey").alias("image"))
    entities = s.select(F.col("s_nationkey").alias("image"), (F.col("s_suppkey") % 100).alias("entity_id"))
    rel = c.select(F.col("c_nationkey").alias("image"), (F.col("c_custkey") % 100).alias("source_id"), F.when(F.col("c_acctbal") > 0, "overlies").otherwise("contains").alias("type"), (F.col("c_custkey") % 100).alias("target_id"))
    return B.result_record(images, entities, rel, "image", ["overlies", "contains"])


register("result_records", result_records, """
WITH e AS (SELECT s_nationkey AS image, count(*) AS n FROM supplier GROUP BY 1), k AS (SELECT DISTINCT s_nationkey AS image, s_suppkey % 100 AS id FROM supplier),
r AS (SELECT c_nationkey AS image, count(*) AS n, count(*) FILTER (c_acctbal > 0) AS o, count(*) FILTER (NOT c_acctbal > 0) AS c, 2 * count(*) FILTER (k.id IS NULL) AS d FROM customer LEFT JOIN k ON k.image = c_nationkey AND k.id = c_custkey % 100 GROUP BY 1)
SELECT n_nationkey AS image, coalesce(e.n, 0) AS n_entities, coalesce(r.n, 0) AS n_relations, coalesce(o, 0) AS n_overlies, coalesce(c, 0) AS n_contains, coalesce(d, 0) AS n_dangling, CASE WHEN e.n IS NULL THEN 'empty' WHEN coalesce(d, 0) > 0 THEN 'failed' ELSE 'completed' END AS status
FROM nation LEFT JOIN e ON e.image = n_nationkey LEFT JOIN r ON r.image = n_nationkey
""")


def arbitration(spark: SparkSession, sf: str) -> DataFrame:
    p = read(spark, sf, "part")
    first = p.select("p_partkey", F.col("p_brand").alias("lithology"), (F.col("p_size") / 50).alias("confidence"))
    review = p.where("p_retailprice > 1000").select("p_partkey", F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).otherwise(F.col("p_type")).alias("lithology"), F.lit(0.5).alias("confidence"))
    decided = p.where("p_size % 3 = 0").select("p_partkey", F.lit("judge").alias("lithology"))
    return B.arbitrated(first, review, decided, ["p_partkey"])


register("arbitration", arbitration, """
WITH x AS (SELECT *, p_size / 50 < 0.86 AND p_retailprice > 1000 AS rv, CASE WHEN p_size % 2 = 0 THEN p_brand ELSE p_type END AS rl FROM part)
SELECT p_partkey, CASE WHEN rv AND rl <> p_brand AND p_size % 3 = 0 THEN 'judge' WHEN rv THEN rl ELSE p_brand END AS lithology, CASE WHEN rv THEN greatest(p_size / 50, 0.5) ELSE p_size / 50 END AS confidence,
  CASE WHEN rv AND rl <> p_brand AND p_size % 3 = 0 THEN 'decision' WHEN rv THEN 'review' ELSE 'first' END AS decided_by FROM x
""")


def cluster_results(spark: SparkSession, sf: str) -> DataFrame:
    c = read(spark, sf, "customer").select("c_nationkey", "c_custkey", "c_name", (F.col("c_acctbal") / 10000).alias("confidence"))
    return B.cluster_result(c, "c_nationkey", "c_custkey", "c_name", "confidence").select("c_nationkey", "canonical", F.array_join("members", ",").alias("members"), F.round("confidence", 6).alias("confidence"))


register("cluster_results", cluster_results, """
SELECT c_nationkey, arg_min(c_name, (-c_acctbal, c_custkey)) AS canonical, string_agg(CAST(c_custkey AS VARCHAR), ',' ORDER BY c_custkey) AS members, round(avg(c_acctbal / 10000), 6) AS confidence FROM customer GROUP BY 1
""")


def query_runner(spark: SparkSession, sf: str) -> DataFrame:
    tables = {"people": read(spark, sf, "customer"), "places": read(spark, sf, "nation")}
    return I.run_query(spark, "SELECT n_name, count(*) AS n FROM people JOIN places ON n_nationkey = c_nationkey WHERE c_acctbal >= :least GROUP BY n_name", tables, least=1000.0)


register("query_runner", query_runner, "SELECT n_name, count(*) AS n FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE c_acctbal >= 1000 GROUP BY 1")


def catalogue_rows(spark: SparkSession, sf: str) -> DataFrame:
    path = _folder(spark)
    I.write_catalogue(read(spark, sf, "part").select(F.concat(F.lit("/in/"), F.col("p_partkey").cast("string"), F.lit(".PDF")).alias("path")), "/out/", path)
    return I.read_json(spark, path, "paper_id string, source_pdf string, source_path string, output_dir string", lines=True)


register("catalogue_rows", catalogue_rows, "SELECT CAST(p_partkey AS VARCHAR) AS paper_id, p_partkey || '.PDF' AS source_pdf, '/in/' || p_partkey || '.PDF' AS source_path, '/out/' || p_partkey AS output_dir FROM part")


def batch_states(spark: SparkSession, sf: str) -> DataFrame:
    e = read(spark, sf, "events").withColumn("state", F.expr("CASE event_type WHEN 'click' THEN 'Done' WHEN 'view' THEN 'done ' WHEN 'error' THEN 'failed' ELSE 'running' END"))
    return I.poll_states(e, "user_id", "state")


register("batch_states", batch_states, """
SELECT user_id, count(*) FILTER (event_type IN ('click', 'view')) AS done, count(*) FILTER (event_type = 'error') AS failed, count(*) FILTER (event_type NOT IN ('click', 'view', 'error')) AS open, count(*) FILTER (event_type NOT IN ('click', 'view', 'error')) = 0 AS finished FROM events GROUP BY 1
""")


def json_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = _folder(spark)
    I.write_json(read(spark, sf, "customer").select("c_custkey", "c_name", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("bal"), "c_nationkey"), path, ["c_nationkey"])
    return I.read_json(spark, path, "c_custkey long, c_name string, bal double, c_nationkey int", lines=True)


register("json_round_trip", json_round_trip, "SELECT c_custkey, c_name, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS bal, c_nationkey FROM customer")


def journal_rows(spark: SparkSession, sf: str) -> DataFrame:
    path = _folder(spark)
    line = F.when(F.col("n_nationkey") == 20, F.lit('{"n_nationkey": oops')).otherwise(F.to_json(F.struct("n_nationkey", "n_name")))
    whole = read(spark, sf, "nation").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", line.alias("l")))), lambda x: x["l"]), "\n").alias("value"))
    whole.write.text(path)
    return I.read_journal(spark, path, "n_nationkey int, n_name string").select("n_nationkey", "n_name")


register("journal_rows", journal_rows, "SELECT n_nationkey, n_name FROM nation WHERE n_nationkey < 20")


def text_files(spark: SparkSession, sf: str) -> DataFrame:
    path = _folder(spark)
    read(spark, sf, "customer").select(F.concat("c_name", F.lit(" é 日本")).alias("value")).write.text(path)
    found = I.read_texts(spark, path, "*.txt")
    return found.select(F.explode(F.split("text", "\n")).alias("line")).where("line <> ''").groupBy("line").agg(F.count("*").alias("n"))


register("text_files", text_files, "SELECT c_name || ' é 日本' AS line, count(*) AS n FROM customer GROUP BY 1")


def pending_files(spark: SparkSession, sf: str) -> DataFrame:
    name = F.concat(F.lit("f"), F.col("p_partkey").cast("string"))
    p = read(spark, sf, "part")
    outputs = p.select(name.alias("name"), F.expr("CASE p_size % 3 WHEN 0 THEN 'full.md' WHEN 1 THEN 'other.txt' ELSE 'layout.json' END").alias("file"))
    return I.pending_pdfs(p.select(name.alias("name"), "p_size"), outputs)


register("pending_files", pending_files, "SELECT 'f' || p_partkey AS name, p_size FROM part WHERE p_size % 3 = 1")


def table_bodies(spark: SparkSession, sf: str) -> DataFrame:
    payload = F.concat(F.lit('{"a": [{"table_body": " "}, {"b": {"table_body": "'), "c_name", F.lit('"}}]}'))
    return read(spark, sf, "customer").select("c_custkey", I.table_body(F.when(F.col("c_acctbal") > 0, payload).otherwise("{broken")).alias("body"))


register("table_bodies", table_bodies, "SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_name END AS body FROM customer")


def cached_requests(spark: SparkSession, sf: str) -> DataFrame:
    p = read(spark, sf, "part")
    print_ = I.fingerprint(F.col("p_name"), F.col("p_size"), F.col("p_partkey"), F.lit("m1"))
    requests = p.select("p_partkey", print_.alias("fingerprint"))
    return I.to_compute(requests.unionByName(requests), requests.join(p.where("p_size < 25").select("p_partkey"), "p_partkey"), ["p_partkey", "fingerprint"])


register("cached_requests", cached_requests, "SELECT p_partkey, sha256(p_name || '|' || p_size || '|' || p_partkey || '|m1') AS fingerprint FROM part WHERE p_size >= 25")


def classified_images(spark: SparkSession, sf: str) -> DataFrame:
    p = read(spark, sf, "part")
    path = F.concat(F.lit("a/"), F.col("p_partkey").cast("string"), F.lit(".PNG"))
    tasks = R.image_tasks(p.select(F.col("p_brand").alias("chunk_id"), F.array(path, F.concat(F.lit("x"), path)).alias("image_path"))).withColumn("inline_code", F.lit("A09")).where("image_index = 0")
    records = p.where("p_size > 40").select(F.lit(None).cast("string").alias("chunk_id"), F.lit(None).cast("int").alias("image_index"), F.lower(F.replace(path, F.lit("/"), F.lit("\\"))).alias("path"), F.col("p_type").alias("code"))
    return R.resolve_classification(tasks, records).select("path", "code")


register("classified_images", classified_images, "SELECT 'a/' || p_partkey || '.PNG' AS path, CASE WHEN p_size > 40 THEN p_type ELSE 'A09' END AS code FROM part")


def schema_fallback(spark: SparkSession, sf: str) -> DataFrame:
    c = read(spark, sf, "customer").groupBy("c_nationkey").agg(F.lit("live").alias("origin"))
    n = read(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.lit("static").alias("origin"))
    return I.prefer(c.where("c_nationkey < 20"), n, ["c_nationkey"])


register("schema_fallback", schema_fallback, "SELECT n_nationkey AS c_nationkey, CASE WHEN n_nationkey < 20 AND EXISTS (SELECT 1 FROM customer c WHERE c.c_nationkey = n_nationkey) THEN 'live' ELSE 'static' END AS origin FROM nation")


def replayed_calls(spark: SparkSession, sf: str) -> DataFrame:
    o = read(spark, sf, "orders").select(F.col("o_orderkey").alias("name"))
    return I.replayed(o, read(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("name"), F.col("o_orderpriority").alias("response")), "name")


register("replayed_calls", replayed_calls, "SELECT o_orderkey AS name, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS response, CASE WHEN o_orderstatus = 'F' THEN 'replayed' ELSE 'missing' END AS status FROM orders")


def graph_sidecars(spark: SparkSession, sf: str) -> DataFrame:
    path = _folder(spark)
    o = read(spark, sf, "orders").select("o_orderkey", "o_custkey", F.when(F.col("o_orderstatus") == "F", "completed").otherwise("failed").alias("status"))
    I.write_graph(o.select("o_orderkey", "status"), o, path)
    edges = spark.read.parquet(f"{path}/edges")
    return spark.read.parquet(f"{path}/nodes").join(edges, "o_orderkey")


register("graph_sidecars", graph_sidecars, "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F'")


def graph_viewer(spark: SparkSession, sf: str) -> DataFrame:
    g = read(spark, sf, "conversations").groupBy("conv_id").agg(F.count("*").alias("score")).withColumnRenamed("conv_id", "chunk_id")
    c = read(spark, sf, "documents").select(F.col("doc_id").alias("chunk_id"), "text")
    return I.viewer(g, c, "AN").select("chunk_id", "score")


register("graph_viewer", graph_viewer, "SELECT conv_id AS chunk_id, count(*) AS score FROM conversations JOIN documents ON doc_id = conv_id WHERE contains(lower(documents.text), 'an') GROUP BY 1")


def matched_tracks(spark: SparkSession, sf: str) -> DataFrame:
    p = read(spark, sf, "part")
    raw = p.select(F.col("p_brand").alias("image"), F.col("p_size").alias("raw_pos"), F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("t"), F.col("p_size").cast("string"))).otherwise("").alias("track_id"), F.concat(F.lit("Zq"), F.lpad(F.col("p_size").cast("string"), 6, "0")).alias("header")).dropDuplicates(["image", "raw_pos"])
    tracks = raw.select("image", F.concat(F.lit("t"), F.col("raw_pos").cast("string")).alias("track_id"), F.col("raw_pos").alias("pos"), F.upper("header").alias("header"))
    return J.match_tracks(raw, tracks, "image").groupBy("image", "matched_by").agg(F.count("*").alias("n"), F.count_if(F.col("track_id") == F.concat(F.lit("t"), F.col("raw_pos").cast("string"))).alias("right"))


register("matched_tracks", matched_tracks, """
WITH s AS (SELECT DISTINCT p_brand AS image, p_size FROM part) SELECT image, CASE WHEN p_size % 2 = 0 THEN 'id' ELSE 'header' END AS matched_by, count(*) AS n, count(*) AS right FROM s GROUP BY 1, 2
""")


def product_templates(spark: SparkSession, sf: str) -> DataFrame:
    n = read(spark, sf, "customer")
    return J.templates_product(n, F.array("c_name", "c_mktsegment"), F.array(F.lit("x"), F.col("c_name")), ["c_custkey"])


register("product_templates", product_templates, """
SELECT c_custkey, source, target FROM customer, LATERAL (SELECT unnest([c_name, c_mktsegment]) AS source) a, LATERAL (SELECT unnest(['x', c_name]) AS target) b
""")


def legal_relations(spark: SparkSession, sf: str) -> DataFrame:
    li = read(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber", F.col("l_suppkey").alias("k"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"))
    one = li.groupBy("k", "seq", "l_returnflag", "l_linestatus", "l_linenumber").agg(F.lit(1).alias("one"))
    rules = spark.createDataFrame([("R", "F", 1), ("N", "O", 2), ("A", "F", 3)], "l_returnflag string, l_linestatus string, l_linenumber int")
    ok, bad = G.legal_relations(one, rules, ["l_returnflag", "l_linestatus", "l_linenumber"], "k", "seq", ["one"])
    return ok.select("k", F.col("occurrences").alias("n"), F.lit("legal").alias("kind")).unionByName(bad.groupBy("k").agg(F.count("*").alias("n")).withColumn("kind", F.lit("illegal")))


register("legal_relations", legal_relations, """
WITH o AS (SELECT DISTINCT l_suppkey AS k, l_orderkey * 10 + l_linenumber AS seq, l_returnflag || l_linestatus || l_linenumber AS t FROM lineitem)
SELECT k, count(*) AS n, CASE WHEN t IN ('RF1', 'NO2', 'AF3') THEN 'legal' ELSE 'illegal' END AS kind FROM o GROUP BY 1, 3
""")


def measured_boxes(spark: SparkSession, sf: str) -> DataFrame:
    li = read(spark, sf, "lineitem")
    prim = read(spark, sf, "orders").select(F.lit("i").alias("image"), F.col("o_orderkey").alias("primitive_id"), F.array(F.col("o_orderkey").cast("string"), F.lit("none")).alias("refs"))
    box = li.groupBy("l_orderkey").agg(F.min("l_quantity").alias("a"), F.min("l_tax").alias("b"), F.max("l_quantity").alias("c"), F.max("l_tax").alias("d")).where("c > 20")
    got, notes = Y.apply_geometry(prim, box.select(F.lit("i").alias("image"), F.col("l_orderkey").cast("string").alias("ref"), F.array("a", "b", "c", "d").alias("box")), "image")
    return got.select("primitive_id", F.col("box")[2].alias("right"), F.lit(None).cast("string").alias("note")).unionByName(notes.select("primitive_id", F.lit(None).cast("double").alias("right"), "note"))


register("measured_boxes", measured_boxes, """
WITH b AS (SELECT l_orderkey, max(l_quantity) AS r FROM lineitem GROUP BY 1 HAVING max(l_quantity) > 20)
SELECT o_orderkey AS primitive_id, r AS right, CASE WHEN r IS NULL THEN 'unresolved_geometry' END AS note FROM orders LEFT JOIN b ON l_orderkey = o_orderkey
""")


def drawn_lines(spark: SparkSession, sf: str) -> DataFrame:
    """An image of 6 rows and 4 columns for each part; one row is black."""
    rows = [F.when(F.col("p_size") % 6 == r, F.lit("00000000")).otherwise(F.lit("FFFFFFFF")) for r in range(6)]
    img = read(spark, sf, "part").select("p_partkey", F.unhex(F.concat(*rows)).alias("px"), F.lit(4).alias("w"), F.lit(6).alias("h"))
    return Y.rule_lines(img, "p_partkey", "px", "w", "h")


register("drawn_lines", drawn_lines, "SELECT p_partkey, 'row' AS axis, CAST(p_size % 6 AS INTEGER) AS position FROM part")


def wells_as_faults(spark: SparkSession, sf: str) -> DataFrame:
    c = read(spark, sf, "customer")
    wells = c.select(F.col("c_nationkey").alias("segment"), F.col("c_mktsegment").alias("name"), F.col("c_custkey").alias("well_id"))
    faults = read(spark, sf, "supplier").select(F.col("s_nationkey").alias("segment"), F.lit("Building FAULT").alias("name"), F.col("s_suppkey").alias("fault_id"))
    return G.wells_named_faults(wells, faults, "segment")


register("wells_as_faults", wells_as_faults, "SELECT s_nationkey AS segment, s_suppkey AS fault_id, c_custkey AS well_id FROM supplier JOIN customer ON c_nationkey = s_nationkey WHERE lower(c_mktsegment) = 'building'")


def unique_targets(spark: SparkSession, sf: str) -> DataFrame:
    p = read(spark, sf, "part").select("p_partkey", F.col("p_name").alias("image_id"), F.col("p_type").alias("path"), F.when(F.col("p_size") > 25, "2d").otherwise("3d").alias("subtype"))
    return G.select_targets(p, "2d").select("p_partkey", "unique_id", "unique_path")


register("unique_targets", unique_targets, "SELECT p_partkey, count(*) OVER (PARTITION BY p_name) = 1 AS unique_id, count(*) OVER (PARTITION BY p_type) = 1 AS unique_path FROM part WHERE p_size > 25")


def enriched_nodes(spark: SparkSession, sf: str) -> DataFrame:
    n = read(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("official_name"))
    e = read(spark, sf, "supplier").select((F.col("s_nationkey") + 5).alias("n_nationkey"), F.lit("new").alias("official_name"))
    return Y.enrich_nodes(n, e, "n_nationkey")


register("enriched_nodes", enriched_nodes, """
WITH e AS (SELECT s_nationkey + 5 AS k, count(*) AS c FROM supplier GROUP BY 1)
SELECT coalesce(n_nationkey, k) AS n_nationkey, CASE WHEN k IS NULL THEN n_name ELSE 'new' END AS official_name, CASE WHEN n_nationkey IS NULL THEN 'unknown_id' WHEN c > 1 THEN 'duplicate_id' WHEN k IS NULL THEN 'missing_id' END AS error FROM nation FULL JOIN e ON k = n_nationkey
""")


def corrected_segments(spark: SparkSession, sf: str) -> DataFrame:
    p = read(spark, sf, "part").select(F.col("p_partkey").alias("g"), "p_size")
    seg = p.select("g", F.explode(F.array(F.struct(F.lit("sand").alias("lithology"), F.lit("primary").alias("role"), F.lit(0.9).alias("confidence")), F.struct(F.lit("clay").alias("lithology"), F.lit("context").alias("role"), F.lit(0.8).alias("confidence")))).alias("s")).select("g", "s.*")
    step = lambda n, a, lith, v: F.struct(F.lit(n).alias("seq"), F.lit(a).alias("action"), F.lit(lith).alias("lithology"), F.lit(v).cast("string").alias("value"))
    steps = F.when(F.col("p_size") % 2 == 0, F.array(step(1, "replace", "sand", "silt"), step(2, "remove", "clay", None))).otherwise(F.array(step(1, "add", "coal", None), step(2, "change_role", "clay", "primary")))
    out = Y.corrected(seg, p.select("g", F.explode(steps).alias("i")).select("g", "i.*"), "g")
    return out.withColumn("confidence", F.round("confidence", 3))


register("corrected_segments", corrected_segments, """
SELECT p_partkey AS g, 'silt' AS lithology, 'primary' AS role, 0.9::DOUBLE AS confidence FROM part WHERE p_size % 2 = 0 UNION ALL SELECT p_partkey, 'sand', 'primary', 0.9 FROM part WHERE p_size % 2 = 1
UNION ALL SELECT p_partkey, 'clay', 'primary', 0.8 FROM part WHERE p_size % 2 = 1 UNION ALL SELECT p_partkey, 'coal', 'secondary', 0.7 FROM part WHERE p_size % 2 = 1
""")


def surface_overlaps(spark: SparkSession, sf: str) -> DataFrame:
    p = read(spark, sf, "part")
    v = p.select("p_type", F.col("p_partkey").alias("region_id"), F.array(F.lit(0.0), F.col("p_size").cast("double"), F.lit(10.0), F.col("p_size") + 10.0).alias("box"))
    l = p.where("p_size = 20").select("p_type", F.array(F.lit(0.0), F.lit(0.0), F.lit(10.0), F.lit(30.0)).alias("box")).distinct()
    return R.surface_gates(v, l, "p_type").select("region_id", "gate_reason")


register("surface_overlaps", surface_overlaps, """
SELECT p_partkey AS region_id, CASE WHEN p_size <= 21 AND p_type IN (SELECT p_type FROM part WHERE p_size = 20) THEN 'unresolved_surface_role_overlap' END AS gate_reason FROM part
""")


def marker_targets(spark: SparkSession, sf: str) -> DataFrame:
    p = read(spark, sf, "part")
    m = p.select(F.col("p_brand").alias("image"), F.col("p_partkey").alias("marker_id"), F.col("p_size").cast("double").alias("value"))
    span = lambda name, a, b: p.select(F.col("p_brand").alias("image")).distinct().select("image", F.lit(1).alias("pos"), F.lit(name).alias("id"), F.lit(a).alias("top"), F.lit(b).alias("bottom"))
    return Y.marker_alignment(m, span("reservoir", 10.0, 20.0), span("unit", 5.0, 40.0), "image").select("marker_id", "target")


register("marker_targets", marker_targets, "SELECT p_partkey AS marker_id, CASE WHEN p_size BETWEEN 10 AND 20 THEN 'reservoir' WHEN p_size BETWEEN 5 AND 40 THEN 'unit' END AS target FROM part")


def reused_calls(spark: SparkSession, sf: str) -> DataFrame:
    o = read(spark, sf, "orders").select(F.col("o_orderkey").alias("task_id"), F.concat(F.lit("p"), F.col("o_orderkey").cast("string")).alias("prompt"))
    rec = read(spark, sf, "orders").select(F.col("o_orderkey").alias("task_id"), F.sha1(F.concat(F.lit("p"), F.col("o_orderkey").cast("string")).cast("binary")).alias("prompt_sha1"), F.when(F.col("o_orderstatus") == "F", "v2").otherwise("v1").alias("parser_version"), F.col("o_orderpriority").alias("response"), F.col("o_orderdate").alias("finished_at"))
    done, todo = N.reuse_calls(o, rec, "v2")
    return done.select("task_id", "response").unionByName(todo.select("task_id", F.lit("to do").alias("response")))


register("reused_calls", reused_calls, "SELECT o_orderkey AS task_id, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority ELSE 'to do' END AS response FROM orders")


class _Flaky:
    """A client that refuses prompts for nation 3 and any prompt once."""

    def __init__(self) -> None:
        self.seen: set[str] = set()

    def chat(self, prompt: str) -> str:
        if prompt.endswith(" 3") or prompt not in self.seen:
            self.seen.add(prompt)
            raise ValueError("busy")
        return prompt.upper()

    def encode(self, texts: list[str]) -> list[list[float]]:
        return [[float(len(t)), 1.0] for t in texts]


def retried_calls(spark: SparkSession, sf: str) -> DataFrame:
    p = read(spark, sf, "region").select(F.col("r_regionkey").alias("k"), F.when(F.col("r_regionkey") != 4, F.concat(F.lit("region "), F.col("r_regionkey").cast("string"))).alias("prompt"))
    return K.call_model(p, "k", "prompt", _Flaky, tries=2, least_interval=0.01, partitions=1)


register("retried_calls", retried_calls, """
SELECT r_regionkey AS k, CASE WHEN r_regionkey NOT IN (3, 4) THEN 'REGION ' || r_regionkey END AS response, CASE r_regionkey WHEN 3 THEN 'model_error' WHEN 4 THEN 'skipped_empty' ELSE 'completed' END AS status, CASE WHEN r_regionkey = 3 THEN 'ValueError: busy' END AS error FROM region
""")


def embedded_texts(spark: SparkSession, sf: str) -> DataFrame:
    return K.embed(read(spark, sf, "customer"), "c_custkey", "c_name", _Flaky).select("c_custkey", F.col("vector")[0].cast("double").alias("n"), F.size("vector").alias("size"))


register("embedded_texts", embedded_texts, "SELECT c_custkey, CAST(length(c_name) AS DOUBLE) AS n, 2 AS size FROM customer")


def detected_tables(spark: SparkSession, sf: str) -> DataFrame:
    judge = K.table_detector(lambda: lambda path, least: path.endswith("7") and least > 0.9)
    return read(spark, sf, "customer").select("c_custkey", judge(F.col("c_custkey").cast("string")).alias("is_table"))


register("detected_tables", detected_tables, "SELECT c_custkey, c_custkey % 10 = 7 AS is_table FROM customer")


def dispatched_tasks(spark: SparkSession, sf: str) -> DataFrame:
    reg = K.Registry()
    reg.register("click", lambda t: t.select(F.col("chunk_id").cast("string"), F.lit("completed").alias("status"), F.lit(2).alias("entities"), F.lit(1).alias("relations")))
    tasks = read(spark, sf, "events").select(F.col("event_id").alias("chunk_id"), "event_type")
    return reg.dispatch(tasks, "event_type", ["click", "view", "purchase"]).select("chunk_id", "status", "entities")


register("dispatched_tasks", dispatched_tasks, """
SELECT CAST(event_id AS VARCHAR) AS chunk_id, CASE WHEN event_type = 'click' THEN 'completed' WHEN event_type IN ('view', 'purchase') THEN 'not_implemented' ELSE 'skipped_kind' END AS status, CASE WHEN event_type = 'click' THEN 2 ELSE 0 END AS entities FROM events
""")


def routed_prompts(spark: SparkSession, sf: str) -> DataFrame:
    e = read(spark, sf, "events")
    text = K.prompt("Type {type} of {user}: {none}", type="event_type", user=F.to_json(F.struct("user_id")), none=F.lit(None).cast("string"))
    return e.select("event_id", text.alias("prompt"), K.route_model(F.when(F.col("event_type") == "view", "image").otherwise("text")).alias("model"))


register("routed_prompts", routed_prompts, """
SELECT event_id, 'Type ' || event_type || ' of {"user_id":' || user_id || '}: ' AS prompt, CASE WHEN event_type = 'view' THEN 'vision' ELSE 'text' END AS model FROM events
""")


class _Parser:
    """A layout service that cannot read files whose number ends in 3."""

    def parse(self, path: str) -> str:
        if path.endswith("3.pdf"):
            raise OSError("unreadable")
        return '{"pages": [{"path": "' + path + '"}]}'


def remote_parses(spark: SparkSession, sf: str) -> DataFrame:
    files = read(spark, sf, "customer").select("c_custkey", F.concat(F.lit("in/"), F.col("c_custkey").cast("string"), F.lit(".pdf")).alias("path"))
    out = K.remote_parse(files, "c_custkey", "path", _Parser)
    return out.select("c_custkey", "state", F.get_json_object("content", "$.pages[0].path").alias("path"), "error")


register("remote_parses", remote_parses, """
SELECT c_custkey, CASE WHEN c_custkey % 10 = 3 THEN 'failed' ELSE 'done' END AS state, CASE WHEN c_custkey % 10 <> 3 THEN 'in/' || c_custkey || '.pdf' END AS path, CASE WHEN c_custkey % 10 = 3 THEN 'OSError: unreadable' END AS error FROM customer
""")


class _Explains:
    """A model that explains the first symbol of a formula, and talks past the question for formulas of z."""

    def chat(self, prompt: str) -> str:
        if prompt.endswith("z"):
            return "I do not know"
        first = prompt.split("Symbols: ")[1].split("\n")[0].split(", ")[0]
        return '<think>hm</think>Sure: {"symbols": [{"symbol": "' + first + '", "meaning": "size", "unit": "m"}]}'


def explained_symbols(spark: SparkSession, sf: str) -> DataFrame:
    f = read(spark, sf, "nation").select("n_nationkey", F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit("k_"), F.col("n_nationkey").cast("string"), F.lit(" = y"))).otherwise("x = z").alias("latex"))
    symbols = F.when(F.col("n_nationkey") % 2 == 0, F.array(F.concat(F.lit("k_"), F.col("n_nationkey").cast("string")), F.lit("y"))).otherwise(F.array(F.lit("x"), F.lit("z")))
    return K.formula_semantics(f.withColumn("symbols", symbols), "n_nationkey", "latex", "symbols", _Explains)


register("explained_symbols", explained_symbols, "SELECT n_nationkey, 'k_' || n_nationkey AS symbol, 'size' AS meaning, 'm' AS unit FROM nation WHERE n_nationkey % 2 = 0")


def audited_units(spark: SparkSession, sf: str) -> DataFrame:
    p = read(spark, sf, "part").select(F.col("p_type").alias("g"), F.col("p_partkey").alias("id"), F.col("p_brand").alias("lithology"), "p_size")
    last = p.groupBy("g").agg(F.max("p_size").alias("m"))
    audit = p.join(last, "g").where("m < 50 OR p_size < 50").select("g", "id", F.lit("audited").alias("lithology"))
    return B.audited(p.drop("p_size"), audit, "g", "id", "lithology")


register("audited_units", audited_units, """
WITH m AS (SELECT p_type, max(p_size) < 50 AS ok FROM part GROUP BY 1)
SELECT p_type AS g, p_partkey AS id, CASE WHEN ok THEN 'audited' ELSE p_brand END AS lithology, ok AS accepted FROM part JOIN m USING (p_type)
""")


def table_tasks(spark: SparkSession, sf: str) -> DataFrame:
    e = read(spark, sf, "events").select("event_id", F.when(F.col("event_type") == "view", "table").otherwise("image").alias("kind"))
    return B.table_only(e, "kind", "table_embedded_hybrid").select("event_id", "code", "status")


register("table_tasks", table_tasks, """
SELECT event_id, CASE WHEN event_type = 'view' THEN 'table_embedded_hybrid' END AS code, CASE WHEN event_type = 'view' THEN 'pending' ELSE 'skipped_kind' END AS status FROM events
""")


def formula_graph(spark: SparkSession, sf: str) -> DataFrame:
    f = read(spark, sf, "customer").select("c_custkey", F.concat(F.lit("E_"), F.col("c_nationkey").cast("string"), F.lit(" = m c")).alias("latex"))
    nodes, edges = B.formula_records(f, "c_custkey", "latex")
    named = nodes.where("type = 'Symbol'").select(F.col("id").alias("target"), "name")
    return edges.join(named, "target").groupBy("name").agg(F.count("*").alias("n"))


register("formula_graph", formula_graph, "SELECT 'E_' || c_nationkey AS name, count(*) AS n FROM customer GROUP BY 1 UNION ALL SELECT s, (SELECT count(*) FROM customer) FROM (VALUES ('m'), ('c')) v(s)")


def chunk_graph_rows(spark: SparkSession, sf: str) -> DataFrame:
    o, li, c = read(spark, sf, "orders"), read(spark, sf, "lineitem"), read(spark, sf, "customer")
    parts = {"entity": c.select(F.col("c_custkey").alias("k"), F.col("c_name").alias("id")), "relation": o.select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("id")), "event": li.select(F.col("l_suppkey").alias("k"), F.col("l_orderkey").alias("id"))}
    rows = B.graph_rows(parts, F.lit("d"), F.col("k"), "text", "stage_04")
    return rows.groupBy("chunk_id", "kind", "modality").agg(F.count("*").alias("n"))


register("chunk_graph_rows", chunk_graph_rows, """
SELECT c_custkey AS chunk_id, 'entity' AS kind, 'text' AS modality, count(*) AS n FROM customer GROUP BY 1 UNION ALL SELECT o_custkey, 'relation', 'text', count(*) FROM orders GROUP BY 1 UNION ALL SELECT l_suppkey, 'event', 'text', count(*) FROM lineitem GROUP BY 1
""")


def stamped_rows(spark: SparkSession, sf: str) -> DataFrame:
    out = I.stamped(read(spark, sf, "embeddings").select("vec_id"))
    return out.select("vec_id", (F.col("updated_at") > F.lit("2020-01-01").cast("timestamp")).alias("stamped"))


register("stamped_rows", stamped_rows, "SELECT vec_id, true AS stamped FROM embeddings")
