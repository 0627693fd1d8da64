"""Queries of classification, routing, acceptance and scalar rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.functions import scalars as S
from sparkloom.operators import rules as R
from sparkloom.plans.registry import register
from sparkloom.sources import files as I
from sparkloom.sources.tables import read

ROUTES = {"CLICK": "interaction", "VIEW": "interaction", "PURCHASE": "commerce", "SIGNUP": "account"}
CAPTIONS = [("oneaen|thean", "A01", 0.9), ("^en ", "A02", 0.8), ("(^| )les? ", "A03", 0.75), ("ung", "A04", 0.7)]


def url_route(spark: SparkSession, sf: str) -> DataFrame:
    p = read(spark, sf, "pages")
    return p.select("page_id", S.path_key(F.regexp_replace("url", r"\?.*$", "")).alias("path_key"), F.regexp_extract("url", r"^https?://([^/]+)", 1).alias("host"))


register("url_route", url_route, r"""
SELECT page_id, lower(replace(regexp_replace(url, '\?.*$', ''), '/', '\')) AS path_key, regexp_extract(url, '^https?://([^/]+)', 1) AS host FROM pages
""")


def code_routing(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "events").select("event_id", R.route(F.col("event_type"), ROUTES, "composite").alias("kind"))


register("code_routing", code_routing, """
SELECT event_id, CASE event_type WHEN 'click' THEN 'interaction' WHEN 'view' THEN 'interaction' WHEN 'purchase' THEN 'commerce' WHEN 'signup' THEN 'account' ELSE 'composite' END AS kind FROM events
""")


def rule_classify(spark: SparkSession, sf: str) -> DataFrame:
    d = read(spark, sf, "documents").withColumn("caption", F.col("text"))
    manual = d.where("doc_id % 100 = 0").select("doc_id", F.lit("A19").alias("code"))
    return R.classify(d, "doc_id", "caption", CAPTIONS, ("A20", 0.6), manual)


register("rule_classify", rule_classify, r"""
WITH c AS (SELECT doc_id, lower(text) AS t FROM documents),
k AS (SELECT doc_id, CASE WHEN doc_id % 100 = 0 THEN 'A19' WHEN regexp_matches(t, 'oneaen|thean') THEN 'A01' WHEN regexp_matches(t, '^en ') THEN 'A02' WHEN regexp_matches(t, '(^| )les? ') THEN 'A03' WHEN regexp_matches(t, 'ung') THEN 'A04' ELSE 'A20' END AS code FROM c)
SELECT doc_id, code, CAST(CASE code WHEN 'A19' THEN 1.0 WHEN 'A01' THEN 0.9 WHEN 'A02' THEN 0.8 WHEN 'A03' THEN 0.75 WHEN 'A04' THEN 0.7 ELSE 0.6 END AS DOUBLE) AS confidence FROM k
""")


def skipped_kinds(spark: SparkSession, sf: str) -> DataFrame:
    return R.skipped_by_kind(read(spark, sf, "events"), "event_type", ["click", "view"]).groupBy("status", "event_type").agg(F.count("*").alias("n"))


register("skipped_kinds", skipped_kinds, "SELECT CASE WHEN event_type IN ('click', 'view') THEN 'pending' ELSE 'skipped_kind' END AS status, event_type, count(*) AS n FROM events GROUP BY 1, 2")


def json_props(spark: SparkSession, sf: str) -> DataFrame:
    e = read(spark, sf, "events")
    return e.select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"), R.payload_is(F.concat(F.lit('{"schema_version":"1","items":['), "props", F.lit("]}")), "1", ["items"]).alias("valid"), F.length(S.json_fragment(F.concat(F.lit("note ```json "), "props", F.lit("```")))).alias("n"))


register("json_props", json_props, "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, true AS valid, CAST(length(props) AS INTEGER) AS n FROM events")


def entity_rejects(spark: SparkSession, sf: str) -> DataFrame:
    rows = read(spark, sf, "lineitem").select((F.col("l_orderkey") % 100).alias("g"), F.when(F.col("l_tax") > 0, F.col("l_partkey").cast("string")).alias("id"), F.when(F.col("l_discount") > 0, F.lit("x")).alias("name"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pos"))
    ok, bad = R.normalise_entities(rows, ["g"], "pos")
    return ok.select("g", "pos", F.lit("accepted").alias("reason")).unionByName(bad.select("g", "pos", "reason"))


register("entity_rejects", entity_rejects, """
WITH r AS (SELECT l_orderkey % 100 AS g, CASE WHEN l_tax > 0 THEN CAST(l_partkey AS VARCHAR) END AS id, l_discount > 0 AS named, l_orderkey * 10 + l_linenumber AS pos FROM lineitem),
n AS (SELECT *, row_number() OVER (PARTITION BY g, id ORDER BY pos, named) AS k FROM r)
SELECT g, pos, CASE WHEN id IS NULL THEN 'missing_id' WHEN NOT named THEN 'missing_name' WHEN k > 1 THEN 'duplicate_id' ELSE 'accepted' END AS reason FROM n
""")


def colour_gates(spark: SparkSession, sf: str) -> DataFrame:
    li = read(spark, sf, "lineitem").select(
        (F.col("l_orderkey") % 50).alias("unit"), F.col("l_linestatus").alias("lithology"), (F.col("l_quantity") / 50).alias("confidence"),
        F.when(F.col("l_tax") > 0, F.lit("dots")).alias("pattern"), (F.col("l_discount") < 0.09).alias("in_scope"), (F.col("l_returnflag") == "A").alias("unresolved"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pos"),
    )
    return R.colour_gates(li, ["unit"], ["O"]).select("unit", "pos", "gate_reason")


register("colour_gates", colour_gates, """
WITH p AS (SELECT l_orderkey % 50 AS unit, l_linestatus AS lith, l_orderkey * 10 + l_linenumber AS pos,
  CASE WHEN l_linestatus <> 'O' THEN 'not_allowed' WHEN l_tax <= 0 THEN 'missing_pattern_evidence' WHEN NOT l_discount < 0.09 THEN 'outside_label_scope' WHEN l_returnflag = 'A' THEN 'unresolved' WHEN l_quantity / 50 < 0.82 THEN 'low_confidence' END AS pre FROM lineitem)
SELECT unit, pos, coalesce(pre, CASE WHEN count(*) FILTER (pre IS NULL) OVER (PARTITION BY unit, lith ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > 0 THEN 'duplicate' END) AS gate_reason FROM p
""")


def layer_results(spark: SparkSession, sf: str) -> DataFrame:
    li = read(spark, sf, "lineitem").select(
        (F.col("l_orderkey") % 200).alias("segment"), (F.col("l_partkey") % 5).cast("string").alias("lithology"),
        F.when(F.col("l_returnflag") == "N", "primary").otherwise("context").alias("role"), (F.col("l_quantity") / 50).alias("confidence"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pos"), (F.col("l_discount") >= 0.1).alias("conflict"),
    )
    return R.layer_results(li, ["segment"], ["0", "1", "2"]).select("segment", "lithology", "pos", "role", F.round("confidence", 6).alias("confidence"))


register("layer_results", layer_results, """
WITH l AS (SELECT l_orderkey % 200 AS segment, CAST(l_partkey % 5 AS VARCHAR) AS lithology, CASE WHEN l_returnflag = 'N' THEN 'primary' ELSE 'context' END AS role, l_quantity / 50 AS confidence, l_orderkey * 10 + l_linenumber AS pos, l_discount >= 0.1 AS conflict FROM lineitem),
k AS (SELECT *, row_number() OVER (PARTITION BY segment, lithology ORDER BY confidence DESC, pos, role DESC) AS best FROM l WHERE lithology IN ('0', '1', '2')),
b AS (SELECT segment, lithology, min(pos) AS pos, max(confidence) AS c, max(CASE WHEN best = 1 THEN role END) AS role, bool_or(conflict) AS conflict FROM k GROUP BY 1, 2)
SELECT segment, lithology, pos, CASE WHEN b.role = 'primary' AND row_number() OVER (PARTITION BY b.segment, b.role ORDER BY b.pos, b.lithology) > 1 THEN 'secondary' ELSE b.role END AS role,
  round(least(c, CASE WHEN conflict THEN 0.75 WHEN b.role = 'context' THEN 0.85 ELSE 1.0 END), 6) AS confidence FROM b
""")


def inventory(spark: SparkSession, sf: str) -> DataFrame:
    units = read(spark, sf, "supplier").select((F.col("s_suppkey") % 10).alias("g"), F.col("s_suppkey").cast("string").alias("unit_id"), F.col("s_suppkey").alias("unit_order"))
    seg = read(spark, sf, "lineitem").where("l_quantity = 50 AND l_tax = 0").select((F.col("l_suppkey") % 10).alias("g"), F.col("l_suppkey").cast("string").alias("unit_id"), F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("segment_id"), F.col("l_linenumber").alias("place"))
    return R.complete_inventory(units, seg, ["g"]).select("g", "segment_id", "ord", "fallback")


register("inventory", inventory, """
WITH u AS (SELECT s_suppkey % 10 AS g, s_suppkey AS k FROM supplier), s AS (SELECT l_suppkey % 10 AS g, l_suppkey AS k, l_orderkey || '-' || l_linenumber AS id, l_linenumber AS place FROM lineitem WHERE l_quantity = 50 AND l_tax = 0),
a AS (SELECT u.g, u.k, id, place, false AS fallback FROM u JOIN s USING (g, k) UNION ALL SELECT g, k, 'fallback_' || k, 0, true FROM u WHERE k NOT IN (SELECT k FROM s)),
r AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY k, place, id) AS ord FROM a)
SELECT g, id AS segment_id, CAST(ord AS INTEGER) AS ord, fallback FROM r WHERE ord <= 24
""")


def unit_batches(spark: SparkSession, sf: str) -> DataFrame:
    return R.batches(read(spark, sf, "supplier"), ["s_nationkey"], ["s_suppkey"], 4).select("s_suppkey", "batch")


register("unit_batches", unit_batches, "SELECT s_suppkey, CAST(floor((row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1) / 4) AS INTEGER) AS batch FROM supplier")


def clipped_boxes(spark: SparkSession, sf: str) -> DataFrame:
    b = F.array(F.col("l_quantity") * 20, F.col("l_tax") * 5000, F.col("l_extendedprice") / 50, F.col("l_discount") * 12000)
    box = S.clip_box(b)
    return read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.size(box).alias("n"), F.round(F.try_element_at(box, F.lit(3)), 4).alias("x1"))


register("clipped_boxes", clipped_boxes, """
WITH b AS (SELECT l_orderkey, l_linenumber, least(1000, greatest(0, l_quantity * 20)) AS x0, least(1000, greatest(0, l_tax * 5000)) AS y0, least(1000, greatest(0, l_extendedprice / 50)) AS x1, least(1000, greatest(0, l_discount * 12000)) AS y1 FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN x1 > x0 AND y1 > y0 THEN 4 ELSE 0 END AS n, CASE WHEN x1 > x0 AND y1 > y0 THEN round(x1, 4) END AS x1 FROM b
""")


def split_pages(spark: SparkSession, sf: str) -> DataFrame:
    p = read(spark, sf, "part").select(F.concat(F.lit("f"), F.col("p_partkey").cast("string"), F.lit(".pdf")).alias("name"), (F.col("p_size") * 17).alias("pages"))
    return I.split_parts(p)


register("split_pages", split_pages, """
WITH p AS (SELECT 'f' || p_partkey AS stem, p_size * 17 AS pages FROM part), s AS (SELECT stem, pages, unnest(range(0, pages, 200)) AS first_page FROM p)
SELECT stem || '.pdf' AS name, CAST(first_page // 200 + 1 AS INTEGER) AS part, CAST(first_page AS INTEGER) AS first_page, CASE WHEN pages > 200 THEN stem || '_part' || lpad(CAST(first_page // 200 + 1 AS VARCHAR), 3, '0') || '.pdf' ELSE stem || '.pdf' END AS part_name,
  CAST(least(first_page + 200, pages) - 1 AS INTEGER) AS last_page FROM s
""")


def upload_batches(spark: SparkSession, sf: str) -> DataFrame:
    b = I.upload_batches(read(spark, sf, "customer").select("c_custkey"), "c_custkey")
    return b.select("batch", F.size("items").alias("n"), F.element_at("items", 1).alias("first_item"))


register("upload_batches", upload_batches, """
WITH r AS (SELECT c_custkey, CAST(floor((row_number() OVER (ORDER BY c_custkey) - 1) / 20) AS INTEGER) AS batch FROM customer) SELECT batch, CAST(count(*) AS INTEGER) AS n, min(c_custkey) AS first_item FROM r GROUP BY 1
""")


def pending_work(spark: SparkSession, sf: str) -> DataFrame:
    orders = read(spark, sf, "orders").select(F.col("o_orderkey").alias("chunk_id"))
    return I.pending_chunks(orders, read(spark, sf, "lineitem").where("l_quantity > 45").select(F.col("l_orderkey").alias("chunk_id")), "chunk_id")


register("pending_work", pending_work, "SELECT o_orderkey AS chunk_id FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)")


def schema_upsert(spark: SparkSession, sf: str) -> DataFrame:
    nodes = read(spark, sf, "nation").select(F.col("n_name").alias("schema"), F.col("n_regionkey").alias("category"), F.col("n_nationkey").alias("seq"))
    again = nodes.where("seq % 5 = 0").select("schema", (F.col("category") + 10).alias("category"), (F.col("seq") + 100).alias("seq"))
    e = read(spark, sf, "supplier").select(F.concat(F.lit("NATION_"), F.col("s_nationkey").cast("string")).alias("src"), F.lit("REL").alias("rel"), F.concat(F.lit("NATION_"), (F.col("s_nationkey") + 1).cast("string")).alias("dst"), F.col("s_suppkey").alias("seq"))
    n, edges = I.upsert_schema(nodes.unionByName(again), e)
    return n.select("schema", F.col("category").cast("string").alias("value")).unionByName(edges.select(F.col("key").alias("schema"), F.col("dst").alias("value")))


register("schema_upsert", schema_upsert, """
SELECT n_name AS schema, CAST(CASE WHEN n_nationkey % 5 = 0 THEN n_regionkey + 10 ELSE n_regionkey END AS VARCHAR) AS value FROM nation
UNION ALL SELECT DISTINCT 'NATION_' || s_nationkey || '_REL_NATION_' || (s_nationkey + 1), 'NATION_' || (s_nationkey + 1) FROM supplier WHERE s_nationkey + 1 < 25
""")


def vector_write_back(spark: SparkSession, sf: str) -> DataFrame:
    e = read(spark, sf, "embeddings").select(F.col("vec_id").alias("schema"), F.when(F.col("label") > 4, F.col("embedding")).alias("embedding"))
    v = read(spark, sf, "embeddings").where("vec_id % 3 <> 0").select(F.col("vec_id").alias("schema"), F.col("embedding").alias("vector"))
    out = I.write_back_vectors(e, v, 64)
    return out.agg(F.count("*").alias("n"), F.count_if(F.col("embedding").isNull()).alias("missing"), F.count_if(F.size("embedding") == 64).alias("right_size"))


register("vector_write_back", vector_write_back, """
SELECT count(*) AS n, count(*) FILTER (label <= 4 AND vec_id % 3 = 0) AS missing, count(*) FILTER (label > 4 OR vec_id % 3 <> 0) AS right_size FROM embeddings
""")


def category_scan(spark: SparkSession, sf: str) -> DataFrame:
    return I.category_names(read(spark, sf, "customer"), "c_mktsegment", "c_custkey")


register("category_scan", category_scan, "SELECT trim(c_mktsegment) AS name, min(c_custkey) AS pos FROM customer GROUP BY 1")


def concept_scan(spark: SparkSession, sf: str) -> DataFrame:
    concepts = read(spark, sf, "nation").select(F.col("n_name").alias("schema"), F.lit("own").alias("category"))
    links = read(spark, sf, "nation").where("n_regionkey < 2").select(F.col("n_name").alias("schema"), F.col("n_regionkey").cast("string").alias("category"))
    return I.concept_scan(concepts, links)


register("concept_scan", concept_scan, "SELECT n_name AS schema, CASE WHEN n_regionkey < 2 THEN CAST(n_regionkey AS VARCHAR) ELSE 'own' END AS category FROM nation ORDER BY 1")


def catalogue_lookup(spark: SparkSession, sf: str) -> DataFrame:
    pages = read(spark, sf, "pages")
    requests = pages.select(F.col("page_id").alias("request_id"), F.when(F.col("page_id") % 7 == 0, F.concat(F.lit("P"), F.col("page_id").cast("string"))).alias("paper_id"), F.concat(F.lit("in/f"), F.col("page_id").cast("string"), F.lit(".pdf")).alias("file_name"))
    cat = pages.where("page_id % 2 = 0").select(F.concat(F.lit("in/f"), F.col("page_id").cast("string"), F.lit(".pdf")).alias("source_pdf"), F.concat(F.lit("C"), F.col("page_id").cast("string")).alias("paper_id"))
    return I.catalogue_lookup(requests, cat)


register("catalogue_lookup", catalogue_lookup, """
SELECT page_id AS request_id, CASE WHEN page_id % 7 = 0 THEN 'P' || page_id WHEN page_id % 2 = 0 THEN 'C' || page_id ELSE 'f' || page_id END AS paper_id FROM pages
""")


def explicit_downgrade(spark: SparkSession, sf: str) -> DataFrame:
    e = read(spark, sf, "events")
    kind = F.when(F.col("event_type") == "click", "causes").when(F.col("event_type") == "view", "before").otherwise("contains")
    evidence = F.when(F.col("value") < 50, "Body text only").when(F.col("value") < 100, "arrow and cross-cutting").otherwise("label")
    return e.select("event_id", R.explicitness(evidence, kind, F.lit(True)).alias("explicit"))


register("explicit_downgrade", explicit_downgrade, """
SELECT event_id, NOT (value < 50 OR (event_type = 'click' AND value >= 100) OR (event_type = 'view' AND value < 100)) AS explicit FROM events
""")
