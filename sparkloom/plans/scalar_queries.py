"""Queries of scalar expressions and of acceptance, repair and selection rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.functions import scalars as S
from sparkloom.operators import aggregates as A
from sparkloom.operators import graphs as G
from sparkloom.operators import rules as R
from sparkloom.operators import selection as Z
from sparkloom.plans.registry import register
from sparkloom.sources.tables import read


def _sel(table: str, key: str, **columns):
    """A query that computes one column expression for each row of a table."""
    return lambda spark, sf: read(spark, sf, table).select(key, *[c().alias(n) for n, c in columns.items()])


register("safe_names", _sel("customer", "c_custkey", name=lambda: S.safe_name(F.concat("c_name", F.lit(" / é "), "c_mktsegment"), 12)), """
SELECT c_custkey, substr(regexp_replace(c_name || ' / é ' || c_mktsegment, '[^0-9A-Za-z._-]+', '_', 'g'), 1, 12) || '_' || substr(sha1(c_name || ' / é ' || c_mktsegment), 1, 8) AS name FROM customer
""")
register("clamped_confidence", _sel("lineitem", "l_orderkey", l_linenumber=lambda: F.col("l_linenumber"), confidence=lambda: S.clamp_confidence(F.when(F.col("l_returnflag") == "N", F.lit("none")).otherwise((F.col("l_quantity") / 32 - 0.25).cast("string")), digits=6)), """
SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'N' THEN 0.7 ELSE round(least(1.0, greatest(0.0, l_quantity / 32 - 0.25)), 6) END AS confidence FROM lineitem
""")
register("collapsed_space", _sel("documents", "doc_id", text_md5=lambda: F.md5(S.collapse_space("text").cast("binary"))), r"""
SELECT doc_id, md5(trim(regexp_replace(text, '[\s\x0b\x1c-\x1f\x85\xa0]+', ' ', 'g'))) AS text_md5 FROM documents
""")
register("plain_markup", _sel("nation", "n_nationkey", plain=lambda: S.strip_markup(F.concat(F.lit("## **"), "n_name", F.lit("** ![pic](a.png)  [link "), F.col("n_nationkey").cast("string"), F.lit("](http://x) `c`")))), """
SELECT n_nationkey, replace(n_name, '_', ' ') || ' pic link ' || n_nationkey || ' c' AS plain FROM nation
""")
register("clean_names", _sel("events", "event_id", name=lambda: S.clean_name(F.when(F.col("event_type") == "view", " N/A ").when(F.col("event_type") == "error", None).otherwise(F.concat(F.lit(" "), "event_type")))), """
SELECT event_id, CASE WHEN event_type IN ('view', 'error') THEN '' ELSE event_type END AS name FROM events
""")
register("schema_key_scores", _sel("part", "p_partkey", score=lambda: S.schema_key_score(F.array(F.split("p_name", " ")[0], F.lit("Brand#11")), F.when(F.col("p_size") % 3 == 0, F.col("p_brand")).when(F.col("p_size") % 3 == 1, F.concat(F.lit("x / "), F.split("p_name", " ")[0])).otherwise(F.concat(F.lit("pre"), F.split("p_name", " ")[0])))), """
SELECT p_partkey, CAST(CASE p_size % 3 WHEN 0 THEN CASE WHEN p_brand = 'Brand#11' THEN 1.0 WHEN contains(p_brand, split_part(p_name, ' ', 1)) OR contains('Brand#11', p_brand) OR contains(p_brand, 'Brand#11') THEN 0.75 ELSE 0.0 END WHEN 1 THEN 0.9 ELSE 0.75 END AS DOUBLE) AS score FROM part
""")
register("keyword_types", _sel("customer", "c_custkey", kind=lambda: S.keyword_type(F.col("c_mktsegment"), [("BUILD", "Site"), ("MACH", "Tool"), ("AUTO", "Tool"), ("HOUSE", "Home")])), """
SELECT c_custkey, CASE WHEN contains(c_mktsegment, 'BUILD') THEN 'Site' WHEN contains(c_mktsegment, 'MACH') OR contains(c_mktsegment, 'AUTO') THEN 'Tool' WHEN contains(c_mktsegment, 'HOUSE') THEN 'Home' ELSE 'Unknown' END AS kind FROM customer
""")
_BOX = lambda: F.array(F.lit(0.0), F.col("l_tax") * 100, F.col("l_quantity"), F.col("l_tax") * 100 + F.col("l_linenumber"))
_OUTER = lambda: F.array(F.lit(10.0), F.lit(0.0), F.lit(30.0), F.lit(6.0))
register("box_measures", _sel("lineitem", "l_orderkey", l_linenumber=lambda: F.col("l_linenumber"), area=lambda: F.round(S.box_area(_BOX()), 6), x=lambda: S.box_centre(_BOX())["x"], y=lambda: F.round(S.box_centre(_BOX())["y"], 6), inside=lambda: F.round(S.box_contained(_BOX(), _OUTER()), 6)), """
WITH b AS (SELECT l_orderkey, l_linenumber, l_quantity AS x1, l_tax * 100 AS y0, l_tax * 100 + l_linenumber AS y1 FROM lineitem)
SELECT l_orderkey, l_linenumber, round(x1 * (y1 - y0), 6) AS area, x1 / 2 AS x, round((y0 + y1) / 2, 6) AS y,
  round(greatest(least(x1, 30) - 10, 0) * greatest(least(y1, 6) - y0, 0) / (x1 * (y1 - y0)), 6) AS inside FROM b
""")
register("axis_values", _sel("lineitem", "l_orderkey", l_linenumber=lambda: F.col("l_linenumber"), value=lambda: F.round(S.value_at(F.lit(0.5), "l_tax", "l_quantity"), 6)), "SELECT l_orderkey, l_linenumber, round(0.5 * l_quantity + l_tax, 6) AS value FROM lineitem")
register("wide_numbers", _sel("part", "p_partkey", value=lambda: S.full_width_number(F.when(F.col("p_size") % 4 == 3, F.lit("12 x")).otherwise(F.concat(F.translate(F.col("p_size").cast("string"), S.HALF_WIDTH, S.FULL_WIDTH), F.lit("．５ m"))))), """
SELECT p_partkey, CASE WHEN p_size % 4 = 3 THEN NULL ELSE p_size + 0.5::DOUBLE END AS value FROM part
""")
register("query_texts", _sel("customer", "c_custkey", query=lambda: S.query_text([("name", F.col("c_name")), ("none", F.lit(" ")), ("segment", F.col("c_mktsegment"))], 30)), """
SELECT c_custkey, substr('name: ' || c_name || chr(10) || 'segment: ' || c_mktsegment, 1, 30) AS query FROM customer
""")
register("data_urls", _sel("nation", "n_nationkey", url=lambda: S.data_url(F.lit("image/png"), F.col("n_name").cast("binary"))), "SELECT n_nationkey, 'data:image/png;base64,' || to_base64(encode(n_name)) AS url FROM nation")
register("parsed_flags", _sel("events", "event_id", flag=lambda: S.parse_flag(F.expr("CASE event_type WHEN 'click' THEN ' On' WHEN 'view' THEN '0' WHEN 'error' THEN 'N' ELSE 'maybe' END"))), """
SELECT event_id, CASE event_type WHEN 'click' THEN true WHEN 'view' THEN false WHEN 'error' THEN false END AS flag FROM events
""")
register("symbol_kinds", _sel("part", "p_partkey", kind=lambda: S.symbol_kind(F.expr(r"CASE p_size % 5 WHEN 0 THEN '\\pi' WHEN 1 THEN '\\alpha' WHEN 2 THEN concat('k_', p_size) WHEN 3 THEN 'P' ELSE 'x' END"))), """
SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN 'constant' WHEN 1 THEN 'greek_parameter' WHEN 2 THEN 'subscript_variable' WHEN 3 THEN 'parameter' ELSE 'variable' END AS kind FROM part
""")
register("cut_texts", _sel("documents", "doc_id", head_md5=lambda: F.md5(S.head("text", 200).cast("binary")), tail_md5=lambda: F.md5(S.tail("text", 80).cast("binary"))), """
SELECT doc_id, md5(CASE WHEN length(text) > 200 THEN substr(text, 1, 200) || '……' ELSE text END) AS head_md5, md5(right(text, 80)) AS tail_md5 FROM documents
""")


def subtype_rules(spark: SparkSession, sf: str) -> DataFrame:
    p = read(spark, sf, "part")
    first = R.first_match(F.lower("p_type"), [("steel|tin", "2d", 0.9), ("copper", "3d", 0.8)], ("hybrid", 0.5))
    return p.select("p_partkey", R.refine_subtype(first["code"], F.col("p_size") > 45, F.col("p_size") % 5, F.col("p_brand") > "Brand#3").alias("subtype"), first["confidence"].alias("confidence"))


register("subtype_rules", subtype_rules, """
WITH c AS (SELECT *, CASE WHEN regexp_matches(lower(p_type), 'steel|tin') THEN '2d' WHEN regexp_matches(lower(p_type), 'copper') THEN '3d' ELSE 'hybrid' END AS code FROM part)
SELECT p_partkey, CASE WHEN p_size > 45 THEN '2d' WHEN p_size % 5 >= 2 AND p_brand > 'Brand#3' THEN 'table' ELSE code END AS subtype, CAST(CASE code WHEN '2d' THEN 0.9 WHEN '3d' THEN 0.8 ELSE 0.5 END AS DOUBLE) AS confidence FROM c
""")


def box_spaces(spark: SparkSession, sf: str) -> DataFrame:
    li = read(spark, sf, "lineitem").select("l_orderkey", F.array(F.lit(0.0), F.lit(0.0), F.col("l_quantity") * 21, F.lit(300.0)).alias("box"), F.lit(900.0).alias("w"), F.lit(400.0).alias("h"), F.when(F.col("l_returnflag") == "R", "normalized").otherwise("pixel").alias("said"))
    return R.coordinate_space(li, "l_orderkey", "box", "w", "h", "said")


register("box_spaces", box_spaces, """
SELECT l_orderkey, CASE WHEN greatest(300, max(l_quantity * 21)) <= 1000 AND (bool_or(l_returnflag = 'R') OR max(l_quantity * 21) > 900 OR count(*) FILTER (l_quantity * 21 >= 1000) >= greatest(2, count(*) / 2)) THEN 'normalized_0_1000' ELSE 'pixels' END AS space FROM lineitem GROUP BY 1
""")


def pixel_boxes(spark: SparkSession, sf: str) -> DataFrame:
    box = R.to_pixels(F.array(F.lit(0), F.col("p_size") * 10, F.lit(1000), F.col("p_size") * 15), F.lit(640), F.lit(480))
    return read(spark, sf, "part").select("p_partkey", F.array_join(F.transform(box, lambda v: v.cast("string")), ",").alias("box"))


register("pixel_boxes", pixel_boxes, "SELECT p_partkey, '0,' || CAST(round(p_size * 4800 / 1000) AS INTEGER) || ',640,' || CAST(round(p_size * 7200 / 1000) AS INTEGER) AS box FROM part")

_RELS = """CASE l_linenumber WHEN 1 THEN 'directly_overlies' WHEN 2 THEN 'contains' WHEN 3 THEN 'transports' WHEN 4 THEN 'source_rock_of' WHEN 5 THEN 'controls' WHEN 6 THEN 'dolomitizes' ELSE 'generates' END"""
_FROM = "CASE l_returnflag WHEN 'A' THEN 'unit' WHEN 'N' THEN 'source_rock' ELSE 'model' END"
_TO = "CASE l_linestatus WHEN 'O' THEN 'unit' ELSE 'lithology' END"


def semantic_errors(spark: SparkSession, sf: str) -> DataFrame:
    li = read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.expr(_RELS).alias("type"), F.expr(_FROM).alias("source_type"), F.expr(_TO).alias("target_type"), (F.col("l_tax") == 0).alias("same"))
    return li.select("l_orderkey", "l_linenumber", G.semantic_error(same=F.col("same")).alias("error"))


register("semantic_errors", semantic_errors, f"""
WITH r AS (SELECT l_orderkey, l_linenumber, {_RELS} AS t, {_FROM} AS s, {_TO} AS d, l_tax = 0 AS same FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN same THEN 'self_relation' WHEN t = 'directly_overlies' AND NOT (s = 'unit' AND d = 'unit') THEN 'vertical_endpoints' WHEN s = 'model' AND t <> 'contains' THEN 'root_as_context'
  WHEN t = 'transports' THEN 'transports_source' WHEN t = 'generates' AND s <> 'source_rock' THEN 'generates_source' WHEN t = 'source_rock_of' AND s <> 'source_rock' THEN 'source_rock_source' WHEN t = 'controls' AND s = 'unit' THEN 'controls_source' WHEN t = 'dolomitizes' AND d <> 'lithology' THEN 'dolomitizes_target' END AS error FROM r
""")


def repaired_relations(spark: SparkSession, sf: str) -> DataFrame:
    p = read(spark, sf, "part")
    rel = p.select(F.col("p_partkey").alias("relation_id"), F.when(F.col("p_size") % 2 == 0, "dolomitizes").otherwise("source_rock_of").alias("type"), F.lit("source_rock").alias("source_type"), F.lit("u").alias("target_id"), F.lit("unit").alias("target_type"), F.lower("p_type").alias("context"))
    lith = spark.createDataFrame([("l1", "steel"), ("l2", "polished steel"), ("l3", "tin"), ("l4", "brass")], "lithology_id string, name string")
    return G.repair_context(rel, lith).select("relation_id", "type", "target_id", "target_type", "repaired")


register("repaired_relations", repaired_relations, """
WITH x AS (SELECT p_partkey AS relation_id, p_size % 2 = 0 AS d, CASE WHEN p_size % 2 <> 0 THEN NULL WHEN contains(lower(p_type), 'polished steel') THEN 'l2' WHEN contains(lower(p_type), 'steel') AND contains(lower(p_type), 'brass') THEN 'l4' WHEN contains(lower(p_type), 'brass') THEN 'l4' WHEN contains(lower(p_type), 'steel') THEN 'l1' WHEN contains(lower(p_type), 'tin') THEN 'l3' END AS l FROM part)
SELECT relation_id, CASE WHEN d THEN 'dolomitizes' ELSE 'generates' END AS type, coalesce(l, 'u') AS target_id, CASE WHEN l IS NULL THEN 'unit' ELSE 'lithology' END AS target_type, NOT d OR l IS NOT NULL AS repaired FROM x
""")


def label_rocks(spark: SparkSession, sf: str) -> DataFrame:
    words = spark.createDataFrame([("steel", "Steel", 2), ("brass", "Brass", 1), ("plated", "Plated", 0)], "term string, lithology string, priority int")
    return R.label_lithology(read(spark, sf, "part").select("p_partkey", "p_type"), "p_partkey", "p_type", words)


register("label_rocks", label_rocks, """
SELECT * FROM (SELECT p_partkey, CASE WHEN contains(lower(p_type), 'plated') THEN 'Plated' WHEN contains(lower(p_type), 'brass') THEN 'Brass' WHEN contains(lower(p_type), 'steel') THEN 'Steel' END AS lithology, 0.99::DOUBLE AS confidence FROM part) WHERE lithology IS NOT NULL
""")


def event_targets(spark: SparkSession, sf: str) -> DataFrame:
    e = read(spark, sf, "events").select("event_id", "user_id", F.array(F.lit("own")).alias("targets"))
    systems = read(spark, sf, "events").select("user_id", F.col("event_type").alias("system_id"))
    return G.expand_targets(e, systems, "user_id").select("event_id", F.array_join("targets", ",").alias("targets"))


register("event_targets", event_targets, """
WITH s AS (SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS t, count(DISTINCT event_type) AS n FROM events GROUP BY 1)
SELECT event_id, CASE WHEN n > 1 THEN t ELSE 'own' END AS targets FROM events JOIN s USING (user_id)
""")


def first_gates(spark: SparkSession, sf: str) -> DataFrame:
    gate = R.first_reason((F.col("l_tax") == 0, "unresolved"), (F.col("l_quantity") < 10, "too_small"), (F.col("l_discount") > 0.08, "conflict"))
    return read(spark, sf, "lineitem").groupBy(gate.alias("reason")).agg(F.count("*").alias("n"))


register("first_gates", first_gates, "SELECT CASE WHEN l_tax = 0 THEN 'unresolved' WHEN l_quantity < 10 THEN 'too_small' WHEN l_discount > 0.08 THEN 'conflict' END AS reason, count(*) AS n FROM lineitem GROUP BY 1")


def selection_confidence(spark: SparkSession, sf: str) -> DataFrame:
    g = read(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.max("l_discount").alias("m"), F.count_if(F.col("l_tax") > 0.04).alias("a"), F.count("*").alias("n"), F.count_if(F.col("l_returnflag") == "R").alias("r"))
    return g.select("l_orderkey", F.round(A.selection_confidence(F.col("m") * 10, F.col("a"), F.col("n"), F.col("r"), F.col("n") - 1), 6).alias("confidence"))


register("selection_confidence", selection_confidence, """
WITH g AS (SELECT l_orderkey, max(l_discount) AS m, count(*) FILTER (l_tax > 0.04) AS a, count(*) AS n, count(*) FILTER (l_returnflag = 'R') AS r FROM lineitem GROUP BY 1)
SELECT l_orderkey, round(greatest(0, least(1.0, 0.65 * m * 10 + 0.20 * a / n + 0.15 * CASE WHEN n > 1 THEN r / (n - 1) ELSE 0 END)), 6) AS confidence FROM g
""")


def colour_signatures(spark: SparkSession, sf: str) -> DataFrame:
    li = read(spark, sf, "lineitem")
    px = li.select("l_suppkey", F.when(F.col("l_returnflag") == "R", 250).otherwise(20).alias("r"), F.when(F.col("l_returnflag") == "A", 240).otherwise(30).alias("g"), F.when(F.col("l_linestatus") == "O", 25).otherwise(35).alias("b"))
    c = A.colour_signature(px, ["l_suppkey"], most=2)
    return c.select("l_suppkey", F.size("colours").alias("n"), F.col("colours")[0]["r"].alias("r"), F.col("colours")[0]["g"].alias("g"))


register("colour_signatures", colour_signatures, """
WITH p AS (SELECT l_suppkey, CASE l_returnflag WHEN 'R' THEN 248 ELSE 24 END AS r, CASE l_returnflag WHEN 'A' THEN 248 ELSE 24 END AS g, CASE l_linestatus WHEN 'O' THEN 24 ELSE 40 END AS b FROM lineitem),
c AS (SELECT l_suppkey, r, g, b, count(*) AS n, count(*) / sum(count(*)) OVER (PARTITION BY l_suppkey) AS share FROM p GROUP BY 1, 2, 3, 4),
o AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY CASE WHEN greatest(r, g, b) - least(r, g, b) >= 24 AND share >= 0.025 THEN 0 ELSE 1 END, n DESC, r, g, b) AS k FROM c),
f AS (SELECT l_suppkey, r, g, b FROM o WHERE k = 1)
SELECT f.l_suppkey, CAST(CASE WHEN EXISTS (SELECT 1 FROM o WHERE o.l_suppkey = f.l_suppkey AND sqrt((o.r - f.r) ** 2 + (o.g - f.g) ** 2 + (o.b - f.b) ** 2) >= 28) THEN 2 ELSE 1 END AS INTEGER) AS n, CAST(r AS INTEGER) AS r, CAST(g AS INTEGER) AS g FROM f
""")


def review_agreement(spark: SparkSession, sf: str) -> DataFrame:
    names = lambda kind: read(spark, sf, "lineitem").where(F.col("l_linestatus") == kind).groupBy("l_suppkey").agg(F.collect_set(F.concat("l_returnflag", F.col("l_linenumber").cast("string"))).alias("names"), (F.max("l_discount") * 9).alias("confidence"))
    out = A.agreeing_reviews(names("O"), names("F"), ["l_suppkey"], "names", "confidence")
    return out.select("l_suppkey", F.size("names").alias("n"), F.round("confidence", 6).alias("confidence"), "agreed")


register("review_agreement", review_agreement, """
WITH g AS (SELECT l_suppkey, l_linestatus AS s, list_sort(list_distinct(list(l_returnflag || l_linenumber))) AS names, max(l_discount) * 9 AS c FROM lineitem GROUP BY 1, 2)
SELECT a.l_suppkey, CAST(len(a.names) AS INTEGER) AS n, round(CASE WHEN a.names = b.names THEN least(0.99, (a.c + b.c) / 2 + 0.05) ELSE a.c END, 6) AS confidence, coalesce(a.names = b.names, false) AS agreed FROM (SELECT * FROM g WHERE s = 'O') a LEFT JOIN (SELECT * FROM g WHERE s = 'F') b USING (l_suppkey)
""")


def inventory_choice(spark: SparkSession, sf: str) -> DataFrame:
    e = read(spark, sf, "events").withColumn("covered", F.floor(F.col("value") / 50)).withColumn("segments", F.col("event_id") % 7).withColumn("review", F.col("event_type") == "view")
    best = e.groupBy("user_id", "covered", "segments", "review").agg(F.min("event_id").alias("event_id"))
    return A.better_inventory(best, ["user_id"], "covered", "segments", "review", "event_id")


register("inventory_choice", inventory_choice, """
WITH e AS (SELECT user_id, floor(value / 50) AS c, event_id % 7 AS s, event_type = 'view' AS r, min(event_id) AS event_id FROM events GROUP BY 1, 2, 3, 4)
SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY c DESC, s DESC, r DESC) AS k FROM e) WHERE k = 1
""")


def document_contexts(spark: SparkSession, sf: str) -> DataFrame:
    c = read(spark, sf, "conversations").select(F.col("conv_id").alias("document_id"), F.col("role").alias("section_id"), F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("chunk_id"), F.col("turn").alias("ord"), "text")
    out = Z.document_context(c)
    return out.select("document_id", "n_chunks", "n_sections", F.array_join(F.element_at("section_chunks", F.lit("user")), ",").alias("user_chunks"))


register("document_contexts", document_contexts, """
SELECT conv_id AS document_id, count(*) AS n_chunks, count(DISTINCT role) AS n_sections, string_agg(conv_id || ':' || turn, ',' ORDER BY turn) FILTER (role = 'user') AS user_chunks FROM conversations WHERE trim(text) <> '' GROUP BY 1
""")


def context_problems(spark: SparkSession, sf: str) -> DataFrame:
    e = read(spark, sf, "events").select("user_id", F.when(F.col("event_type") != "error", F.col("event_id") % 5000).cast("string").alias("chunk_id"), F.when(F.col("event_type") == "view", "text").otherwise("video").alias("modality"))
    return Z.context_errors(e, "user_id").groupBy("error").agg(F.count("*").alias("n"))


register("context_problems", context_problems, """
WITH e AS (SELECT user_id, CASE WHEN event_type <> 'error' THEN CAST(event_id % 5000 AS VARCHAR) END AS c, CASE WHEN event_type = 'view' THEN 'text' ELSE 'video' END AS m FROM events),
x AS (SELECT DISTINCT user_id, c, CASE WHEN c IS NULL THEN 'missing_chunk_id' WHEN count(*) OVER (PARTITION BY user_id, c) > 1 THEN 'duplicate_chunk_id' WHEN m <> 'text' THEN 'unknown_modality' END AS error FROM e)
SELECT error, count(*) AS n FROM x WHERE error IS NOT NULL GROUP BY 1
""")


def _scores(spark: SparkSession, sf: str) -> DataFrame:
    li = read(spark, sf, "lineitem").groupBy((F.col("l_orderkey") % 50).alias("document_id"), F.col("l_orderkey").alias("chunk_id"), F.col("l_suppkey").cast("string").alias("schema"))
    s = li.agg((F.max("l_discount") * 10).alias("score"), F.bool_or(F.col("l_returnflag") == "R").alias("exact"))
    return s.withColumn("category", F.substring("schema", 1, 1))


_SCORES = """
c AS (SELECT l_orderkey % 50 AS d, l_orderkey AS ch, CAST(l_suppkey AS VARCHAR) AS sch, max(l_discount) * 10 AS score, bool_or(l_returnflag = 'R') AS exact FROM lineitem GROUP BY 1, 2, 3),
s AS (SELECT d, sch, substr(sch, 1, 1) AS cat, max(score) AS score, bool_or(exact) AS exact FROM c GROUP BY 1, 2),
t AS (SELECT d, cat, avg(score) AS cs FROM (SELECT *, row_number() OVER (PARTITION BY d, cat ORDER BY score DESC, sch) AS r FROM s) WHERE r <= 3 GROUP BY 1, 2),
b AS (SELECT *, row_number() OVER (PARTITION BY d ORDER BY round(cs, 9) DESC, cat) <= 3 AS core FROM t),
p AS (SELECT * FROM (SELECT s.*, core, row_number() OVER (PARTITION BY s.d ORDER BY core DESC, exact DESC, score DESC, sch) AS rank FROM s JOIN b USING (d, cat) WHERE score >= 0.3 OR exact) WHERE rank <= 30)
"""


def _pool(spark: SparkSession, sf: str) -> DataFrame:
    best = _scores(spark, sf).groupBy("document_id", "schema", "category").agg(F.max("score").alias("score"), F.bool_or("exact").alias("exact"))
    return Z.document_pool(best, "document_id")


def schema_pool(spark: SparkSession, sf: str) -> DataFrame:
    return _pool(spark, sf).select("document_id", "schema", "core", "rank")


register("schema_pool", schema_pool, f"WITH {_SCORES} SELECT d AS document_id, sch AS schema, core, CAST(rank AS INTEGER) AS rank FROM p")


def schema_selection(spark: SparkSession, sf: str) -> DataFrame:
    s = read(spark, sf, "supplier")
    edges = s.select(F.col("s_suppkey").cast("string").alias("src"), (F.col("s_suppkey") + 1).cast("string").alias("dst"))
    return Z.chunk_selection(_pool(spark, sf), _scores(spark, sf), edges, "document_id", "chunk_id").groupBy("document_id", "role").agg(F.count("*").alias("n"))


register("schema_selection", schema_selection, f"""
WITH {_SCORES}, sd AS (SELECT * FROM (SELECT c.*, row_number() OVER (PARTITION BY c.d, ch ORDER BY c.exact DESC, c.score DESC, c.sch) AS r FROM c JOIN p ON p.d = c.d AND p.sch = c.sch) WHERE r <= 10),
e AS (SELECT CAST(s_suppkey AS VARCHAR) AS a, CAST(s_suppkey + 1 AS VARCHAR) AS b FROM supplier UNION SELECT CAST(s_suppkey + 1 AS VARCHAR), CAST(s_suppkey AS VARCHAR) FROM supplier),
nr AS (SELECT DISTINCT sd.d, sd.ch, e.b AS sch FROM sd JOIN e ON e.a = sd.sch),
mo AS (SELECT * FROM (SELECT nr.*, row_number() OVER (PARTITION BY nr.d, nr.ch ORDER BY score DESC, nr.sch) AS r FROM nr JOIN c USING (d, ch, sch)) WHERE r <= 15),
u AS (SELECT DISTINCT c.d, c.ch, p.sch, 0 AS k FROM p JOIN c ON c.d = p.d WHERE core UNION ALL SELECT d, ch, sch, 1 FROM sd UNION ALL SELECT d, ch, sch, 2 FROM mo),
m AS (SELECT d, ch, sch, min(k) AS k FROM u GROUP BY 1, 2, 3)
SELECT d AS document_id, CASE k WHEN 0 THEN 'core' WHEN 1 THEN 'seed' ELSE 'expansion' END AS role, count(*) AS n FROM m GROUP BY 1, 2
""")


def concept_ranking(spark: SparkSession, sf: str) -> DataFrame:
    none = F.array().cast("array<double>")
    texts = read(spark, sf, "part").select("p_partkey", F.lower("p_type").alias("text"), F.array("p_brand").alias("terms"), F.array(F.lit("tin")).alias("keys"), none.alias("embedding"))
    concepts = spark.createDataFrame([("steel", "steel", "m", ["plated"]), ("tin", "tin", "m", ["none"]), ("x/brass", "brass", "m", ["small"])], "schema string, name string, category string, examples array<string>").withColumn("embedding", none)
    return Z.concept_scores(texts, ["p_partkey"], concepts).select("p_partkey", "schema", "exact", F.round("score", 6).alias("score"))


register("concept_ranking", concept_ranking, """
WITH c(schema, name, example) AS (VALUES ('steel', 'steel', 'plated'), ('tin', 'tin', 'none'), ('x/brass', 'brass', 'small')),
x AS (SELECT p_partkey, schema, contains(lower(p_type), name) AS named, contains(lower(p_type), example) AS ex, schema = 'tin' AS key FROM part, c),
l AS (SELECT *, CASE WHEN named OR (schema <> 'x/brass' AND named) THEN 1.0 WHEN ex THEN 0.9 ELSE 0.0 END AS lex FROM x)
SELECT p_partkey, schema, named OR key AS exact, round(CAST(greatest(CASE WHEN key THEN (0.25 * lex + 0.25) / 1.0 ELSE 0.25 * lex / 0.75 END, CASE WHEN named OR key THEN 0.9 ELSE 0.0 END) AS DOUBLE), 6) AS score FROM l
""")


def segment_merge(spark: SparkSession, sf: str) -> DataFrame:
    f = read(spark, sf, "lineitem").select("l_orderkey", F.col("l_returnflag").alias("segment"), F.col("l_linenumber").cast("string").alias("field"), F.col("l_shipdate").cast("string").alias("value"))
    return R.merge_segments(f, "l_orderkey", ["A", "R"]).select("l_orderkey", "field", "error")


register("segment_merge", segment_merge, """
WITH h AS (SELECT l_orderkey, list_distinct(list(l_returnflag)) AS have FROM lineitem GROUP BY 1)
SELECT l_orderkey, CAST(l_linenumber AS VARCHAR) AS field, CASE WHEN count(DISTINCT l_returnflag) > 1 THEN 'several_owners' WHEN NOT list_has_all(any_value(have), ['A', 'R']) THEN 'missing_segment' END AS error FROM lineitem JOIN h USING (l_orderkey) GROUP BY 1, 2
""")
