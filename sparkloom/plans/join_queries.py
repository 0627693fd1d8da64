"""Queries of joins, similarity search, fits and clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.functions import scalars as S
from sparkloom.operators import aggregates as A
from sparkloom.operators import graphs as G
from sparkloom.operators import hierarchy as H
from sparkloom.operators import joins as J
from sparkloom.plans.registry import register
from sparkloom.sources.tables import epoch, read

_COS = "list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(i.embedding AS DOUBLE[]))"


def cosine_topk(spark: SparkSession, sf: str) -> DataFrame:
    e = read(spark, sf, "embeddings")
    q = e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q"))
    found = G.top_k_similar(q, "query_id", "q", e, "vec_id", "embedding", 30, -1.0)
    return found.select("query_id", "vec_id", "rank", F.round("score", 6).alias("score"))


register("cosine_topk", cosine_topk, f"""
WITH s AS (SELECT q.vec_id AS query_id, i.vec_id, {_COS} AS score FROM embeddings q, embeddings i WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, vec_id, CAST(rank AS INTEGER) AS rank, round(score, 6) AS score FROM r WHERE rank <= 30
""")


def cosine_threshold(spark: SparkSession, sf: str) -> DataFrame:
    e = read(spark, sf, "embeddings")
    q = e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q"))
    found = G.top_k_similar(q, "query_id", "q", e, "vec_id", "embedding", 10, 0.55)
    return found.groupBy("query_id").agg(F.count("*").alias("n"), F.round(F.max("score"), 6).alias("best"))


register("cosine_threshold", cosine_threshold, f"""
WITH s AS (SELECT q.vec_id AS query_id, i.vec_id, {_COS} AS score FROM embeddings q, embeddings i WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s WHERE score >= 0.55)
SELECT query_id, count(*) AS n, round(max(score), 6) AS best FROM r WHERE rank <= 10 GROUP BY 1
""")


def label_top3_mean(spark: SparkSession, sf: str) -> DataFrame:
    e = read(spark, sf, "embeddings")
    q = e.where("vec_id = 0").select(F.lit(0).alias("k"), F.col("embedding").alias("q"))
    scored = e.crossJoin(F.broadcast(q)).select("label", "vec_id", S.cosine("q", "embedding").alias("score"))  # the query is one row
    return A.top_mean(scored, ["label"], "score", ["vec_id"]).select("label", F.round("score", 6).alias("score"), "n")


register("label_top3_mean", label_top3_mean, f"""
WITH s AS (SELECT i.label, i.vec_id, {_COS} AS score FROM embeddings q, embeddings i WHERE q.vec_id = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY score DESC, vec_id) AS rk FROM s)
SELECT label, round(avg(score), 6) AS score, count(*) AS n FROM r WHERE rk <= 3 GROUP BY 1
""")


def weighted_score(spark: SparkSession, sf: str) -> DataFrame:
    li = read(spark, sf, "lineitem")
    key = F.when(F.col("l_returnflag") == "R", F.lit(0.9)).otherwise(F.lit(0.0))
    return li.select("l_orderkey", "l_linenumber", F.round(S.weighted_score(F.col("l_discount") * 10, F.col("l_tax") * 10, key), 6).alias("score"))


register("weighted_score", weighted_score, """
SELECT l_orderkey, l_linenumber, round(CASE WHEN l_returnflag = 'R' THEN (l_discount * 10 * 0.5 + l_tax * 10 * 0.25 + 0.9 * 0.25) / 1.0 ELSE (l_discount * 10 * 0.5 + l_tax * 10 * 0.25) / 0.75 END, 6) AS score
FROM lineitem
""")


def _spans(spark: SparkSession, sf: str) -> DataFrame:
    li = read(spark, sf, "lineitem").select("l_orderkey", epoch("l_shipdate").alias("t"))
    return li.groupBy("l_orderkey").agg((F.min("t") / 86400).alias("s"), (F.max("t") / 86400).alias("e"))


_SPANS = "sp AS (SELECT l_orderkey, epoch(min(l_shipdate)) / 86400 AS s, epoch(max(l_shipdate)) / 86400 AS e FROM lineitem GROUP BY 1)"


def interval_overlap(spark: SparkSession, sf: str) -> DataFrame:
    o = read(spark, sf, "orders").select("o_orderkey", "o_custkey")
    spans = _spans(spark, sf).join(o, F.col("l_orderkey") == F.col("o_orderkey")).select("o_custkey", "o_orderkey", "s", "e")
    other = spans.select("o_custkey", F.col("o_orderkey").alias("k2"), F.col("s").alias("s2"), F.col("e").alias("e2"))
    pairs = J.overlapping(spans, other, ["o_custkey"], "s", "e", "s2", "e2").where("o_orderkey < k2")
    scored = pairs.withColumn("ratio", S.overlap_ratio("s", "e", "s2", "e2")).where("ratio >= 0.15")
    return scored.select("o_custkey", "o_orderkey", "k2", F.round("ratio", 6).alias("ratio"))


register("interval_overlap", interval_overlap, f"""
WITH {_SPANS}, x AS (SELECT o_custkey, o_orderkey, s, e FROM sp JOIN orders ON o_orderkey = l_orderkey WHERE s < e)
SELECT a.o_custkey, a.o_orderkey, b.o_orderkey AS k2, round((least(a.e, b.e) - greatest(a.s, b.s)) / least(a.e - a.s, b.e - b.s), 6) AS ratio
FROM x a JOIN x b ON a.o_custkey = b.o_custkey AND a.o_orderkey < b.o_orderkey AND a.s < b.e AND b.s < a.e
WHERE (least(a.e, b.e) - greatest(a.s, b.s)) / least(a.e - a.s, b.e - b.s) >= 0.15
""")


def point_in_interval(spark: SparkSession, sf: str) -> DataFrame:
    o = read(spark, sf, "orders").select("o_custkey", "o_orderkey", (epoch("o_orderdate") / 86400).alias("d"))
    spans = _spans(spark, sf).join(o.select("o_custkey", "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey")).select("o_custkey", F.col("l_orderkey").alias("hit"), "s", "e")
    return J.first_containing(o, spans, ["o_custkey"], ["o_orderkey"], "d", "s", "e", ["hit"]).select("o_custkey", "o_orderkey", "hit")


register("point_in_interval", point_in_interval, f"""
WITH {_SPANS}, x AS (SELECT o_custkey, o_orderkey AS hit, s, e FROM sp JOIN orders ON o_orderkey = l_orderkey)
SELECT o.o_custkey, o.o_orderkey, (SELECT min(hit) FROM x WHERE x.o_custkey = o.o_custkey AND epoch(o.o_orderdate) / 86400 BETWEEN x.s AND x.e) AS hit FROM orders o
""")


def nearest_event(spark: SparkSession, sf: str) -> DataFrame:
    e = read(spark, sf, "events").select("event_id", "user_id", "event_type", epoch("ts", "MICROSECOND").alias("t"))
    a = e.where("event_type = 'purchase'").select("user_id", "event_id", "t")
    b = e.where("event_type = 'view'").select("user_id", F.col("t").alias("t2"))
    return J.nearest(a, b, ["user_id"], "event_id", "t", "t2", []).select("user_id", "event_id", F.abs(F.col("t") - F.col("t2")).alias("gap"))


register("nearest_event", nearest_event, """
SELECT a.user_id, a.event_id, (SELECT min(abs(epoch_us(a.ts) - epoch_us(b.ts))) FROM events b WHERE b.event_type = 'view' AND b.user_id = a.user_id) AS gap FROM events a WHERE event_type = 'purchase'
""")


def axis_fit(spark: SparkSession, sf: str) -> DataFrame:
    fits = A.fit_line(read(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], "l_quantity", "l_extendedprice")
    return fits.select("l_returnflag", "l_linestatus", "n", F.round("slope", 3).alias("slope"), F.round("intercept", 2).alias("intercept"), F.round("rmse", 2).alias("rmse"), "error")


register("axis_fit", axis_fit, """
SELECT l_returnflag, l_linestatus, count(*) AS n, round(regr_slope(l_extendedprice, l_quantity), 3) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 2) AS intercept,
  round(sqrt((regr_syy(l_extendedprice, l_quantity) - regr_sxy(l_extendedprice, l_quantity) ** 2 / regr_sxx(l_extendedprice, l_quantity)) / count(*)), 2) AS rmse, CAST(NULL AS VARCHAR) AS error FROM lineitem GROUP BY 1, 2
""")


def cluster_1d(spark: SparkSession, sf: str) -> DataFrame:
    e = read(spark, sf, "events").select("user_id", epoch("ts").alias("t"))
    return A.cluster_1d(e, ["user_id"], "t", 20_000).select("user_id", "cluster", F.round("position", 3).alias("position"), "support", "first", "last")


register("cluster_1d", cluster_1d, """
WITH e AS (SELECT user_id, event_id, CAST(floor(epoch(ts)) AS BIGINT) AS t FROM events),
g AS (SELECT user_id, t, row_number() OVER (PARTITION BY user_id ORDER BY t) AS o, t - lag(t) OVER (PARTITION BY user_id ORDER BY t) AS gap FROM e),
c AS (SELECT user_id, t, CAST(sum(CASE WHEN gap IS NULL OR gap > 20000 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY o) AS BIGINT) AS cluster FROM g)
SELECT user_id, cluster, round(avg(t), 3) AS position, count(*) AS support, min(t) AS first, max(t) AS last FROM c GROUP BY 1, 2
""")


def bbox_union(spark: SparkSession, sf: str) -> DataFrame:
    return A.union_box(read(spark, sf, "lineitem"), ["l_suppkey"], "l_quantity", "l_extendedprice", "l_quantity", "l_extendedprice")


register("bbox_union", bbox_union, "SELECT l_suppkey, min(l_quantity) AS x0, min(l_extendedprice) AS y0, max(l_quantity) AS x1, max(l_extendedprice) AS y1 FROM lineitem GROUP BY 1")


def fill_down(spark: SparkSession, sf: str) -> DataFrame:
    e = read(spark, sf, "events").withColumn("kind", F.when(F.col("event_type").isin("purchase", "signup"), F.col("event_type")))
    return H.fill_down(e, ["user_id"], ["ts", "event_id"], "kind").select("event_id", "user_id", "kind_filled")


register("fill_down", fill_down, """
WITH e AS (SELECT event_id, user_id, ts, CASE WHEN event_type IN ('purchase', 'signup') THEN event_type END AS kind FROM events)
SELECT event_id, user_id, coalesce(last_value(kind IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(kind IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS kind_filled FROM e
""")


def consume_once_join(spark: SparkSession, sf: str) -> DataFrame:
    e = read(spark, sf, "events")
    left = e.where("event_id % 2 = 0").select("user_id", "event_type", F.col("event_id").alias("pos"))
    right = e.where("event_id % 2 = 1").select("user_id", "event_type", F.col("event_id").alias("pos"), "value")
    return J.consume_once(left, right, ["user_id"], ["event_type"], "pos", ["value"])


register("consume_once_join", consume_once_join, """
WITH l AS (SELECT user_id, event_type, event_id AS pos, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS t, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS p FROM events WHERE event_id % 2 = 0),
r AS (SELECT user_id, event_type, value, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS t, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS p FROM events WHERE event_id % 2 = 1)
SELECT l.user_id, l.event_type, l.pos, coalesce(n.value, q.value) AS value FROM l LEFT JOIN r n ON n.user_id = l.user_id AND n.event_type = l.event_type AND n.t = l.t LEFT JOIN r q ON q.user_id = l.user_id AND q.p = l.p
""")


def status_rollup(spark: SparkSession, sf: str) -> DataFrame:
    e = read(spark, sf, "events").withColumn("status", F.expr("CASE event_type WHEN 'click' THEN 'completed' WHEN 'view' THEN 'completed' WHEN 'error' THEN 'error' ELSE 'skipped_kind' END"))
    return A.status_rollup(e.withColumn("hour", F.floor(epoch("ts") / 3600)), ["hour"], "status")


register("status_rollup", status_rollup, """
WITH s AS (SELECT CAST(floor(epoch(ts) / 3600) AS BIGINT) AS hour, CASE event_type WHEN 'click' THEN 'completed' WHEN 'view' THEN 'completed' WHEN 'error' THEN 'error' ELSE 'skipped_kind' END AS st FROM events)
SELECT hour, CASE WHEN bool_and(st = 'completed') THEN 'completed' WHEN bool_and(st LIKE 'skipped%') THEN 'skipped' WHEN bool_or(st = 'completed') THEN 'partial' WHEN bool_or(st = 'error') THEN 'model_error' ELSE 'not_implemented' END AS status,
  count(*) FILTER (st = 'completed') AS n_completed, count(*) AS n FROM s GROUP BY 1
""")


def histograms(spark: SparkSession, sf: str) -> DataFrame:
    return A.histograms(read(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"])


register("histograms", histograms, """
SELECT 'o_orderstatus' AS dimension, o_orderstatus AS value, count(*) AS n FROM orders GROUP BY 2 UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders GROUP BY 2
""")


def grouping_totals(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "lineitem").cube("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"), F.grouping_id().cast("int").alias("gid"))


register("grouping_totals", grouping_totals, """
SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS quantity, CAST(grouping(l_returnflag, l_linestatus) AS INTEGER) AS gid FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)
""")


def dominant_row(spark: SparkSession, sf: str) -> DataFrame:
    return A.dominant(read(spark, sf, "part"), ["p_brand"], "p_retailprice", "p_size", "p_partkey").select("p_brand", "p_partkey")


register("dominant_row", dominant_row, "SELECT p_brand, p_partkey FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_size DESC, p_partkey) AS r FROM part) WHERE r = 1")


def first_filled(spark: SparkSession, sf: str) -> DataFrame:
    e = read(spark, sf, "events").select("user_id", "event_id", F.when(F.col("event_type") == "purchase", F.col("event_type")).otherwise("").alias("a"), F.when(F.col("value") > 400, F.col("value")).alias("b"))
    return A.first_filled(e, ["user_id"], "event_id", ["a", "b"])


register("first_filled", first_filled, """
SELECT user_id, min_by(CASE WHEN event_type = 'purchase' THEN event_type ELSE '' END, event_id) FILTER (event_type = 'purchase') AS a, min_by(value, event_id) FILTER (value > 400) AS b FROM events GROUP BY 1
""")


def reference_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return A.reference_rollup(read(spark, sf, "conversations"), ["conv_id"], "turn", "text", 20).select("conv_id", F.md5(F.col("references").cast("binary")).alias("refs_md5"))


register("reference_rollup", reference_rollup, """
WITH d AS (SELECT conv_id, substr(text, 1, 600) AS t, min(turn) AS f FROM conversations WHERE trim(text) <> '' GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY f, t) AS k FROM d)
SELECT conv_id, md5(string_agg(t, chr(10) ORDER BY f, t)) AS refs_md5 FROM r WHERE k <= 20 GROUP BY 1
""")


def merged_spans(spark: SparkSession, sf: str) -> DataFrame:
    from sparkloom.operators.lines import merge_spans

    li = read(spark, sf, "lineitem").select("l_suppkey", F.floor(epoch("l_shipdate") / 86400).alias("s"))
    return merge_spans(li.withColumn("e", F.col("s") + 3), ["l_suppkey"], "s", "e")


register("merged_spans", merged_spans, """
WITH x AS (SELECT l_suppkey, CAST(floor(epoch(l_shipdate) / 86400) AS BIGINT) AS s, CAST(floor(epoch(l_shipdate) / 86400) AS BIGINT) + 3 AS e FROM lineitem),
r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY s, e) AS k, max(e) OVER (PARTITION BY l_suppkey ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS u FROM x),
g AS (SELECT *, sum(CASE WHEN u IS NULL OR s > u THEN 1 ELSE 0 END) OVER (PARTITION BY l_suppkey ORDER BY k) AS i FROM r)
SELECT l_suppkey, min(s) AS s, max(e) AS e FROM g GROUP BY l_suppkey, i
""")


def monotone_run(spark: SparkSession, sf: str) -> DataFrame:
    e = read(spark, sf, "events").select("user_id", F.col("event_id").alias("pos"), "value")
    return A.longest_monotone(e, ["user_id"], "pos", "value").groupBy("user_id").agg(F.count("*").alias("n"))


# Round n + 1 finds the events that some earlier event of a lower value, itself the end of a run of n, comes before.
register("monotone_run", monotone_run, """
WITH RECURSIVE e AS MATERIALIZED (SELECT user_id, event_id, value FROM events WHERE value IS NOT NULL), run AS (
  SELECT user_id, event_id, value, 1 AS n FROM e
  UNION ALL
  SELECT user_id, event_id, value, n + 1 FROM (
    SELECT e.user_id, e.event_id, e.value, max(r.n) OVER () AS n,
      min(r.value) OVER (PARTITION BY e.user_id ORDER BY e.event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS low
    FROM e LEFT JOIN run r ON r.user_id = e.user_id AND r.event_id = e.event_id)
  WHERE low < value)
SELECT user_id, max(n)::BIGINT AS n FROM run GROUP BY user_id
""")


def nms_boxes(spark: SparkSession, sf: str) -> DataFrame:
    li = read(spark, sf, "lineitem")
    b = li.select(F.floor(F.col("l_orderkey") / 100).alias("image"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("box_id"), (F.col("l_quantity") * 4).alias("x0"), (F.col("l_tax") * 1000).alias("y0"), F.col("l_extendedprice").alias("score"))
    boxes = b.withColumn("x1", F.col("x0") + 60).withColumn("y1", F.col("y0") + 40)
    return A.suppress_boxes(boxes, ["image"], "score", "box_id").select("image", "box_id")


# Each round keeps the best box left in an image and drops the ones that it covers.
register("nms_boxes", nms_boxes, """
WITH RECURSIVE b AS (
  SELECT l_orderkey // 100 AS image, l_orderkey * 10 + l_linenumber AS box_id, l_quantity::DOUBLE * 4 AS x, l_tax::DOUBLE * 1000 AS y, l_extendedprice AS score FROM lineitem
), s AS (
  SELECT *, row_number() OVER (PARTITION BY image ORDER BY score DESC, box_id) AS place, false AS kept FROM b
  UNION ALL
  SELECT image, box_id, x, y, score, place, place = best AS kept FROM (
    SELECT *, first_value(place) OVER w AS best, least(x, first_value(x) OVER w) + 60 - greatest(x, first_value(x) OVER w) AS wide,
      least(y, first_value(y) OVER w) + 40 - greatest(y, first_value(y) OVER w) AS high, 60 * least(y + 40 - y, first_value(y) OVER w + 40 - first_value(y) OVER w) AS area
    FROM s WHERE NOT kept WINDOW w AS (PARTITION BY image ORDER BY place))
  WHERE place = best OR NOT (wide > 0 AND high > 0 AND wide * high / area >= 0.65))
SELECT image, box_id FROM s WHERE kept
""")


def fuzzy_match(spark: SparkSession, sf: str) -> DataFrame:
    p = read(spark, sf, "part")
    items = p.select("p_brand", "p_size", "p_partkey", F.col("p_name").alias("a"))
    cells = p.select("p_brand", "p_size", F.col("p_partkey").alias("cell"), F.concat(F.lit("[a cell that says "), F.upper("p_name"), F.lit("]")).alias("b"))
    return J.fuzzy_best(items, cells, ["p_brand", "p_size"], "p_partkey", "a", "cell", "b")


# A cell is so much longer than any name that only containment gives .9; a name is in its own cell at least.
register("fuzzy_match", fuzzy_match, """
SELECT i.p_brand, i.p_size, i.p_partkey, min(c.p_partkey) AS cell, 0.9::DOUBLE AS score FROM part i JOIN part c ON c.p_brand = i.p_brand AND c.p_size = i.p_size AND contains(c.p_name, i.p_name) GROUP BY 1, 2, 3
""")


def covering_box(spark: SparkSession, sf: str) -> DataFrame:
    p = read(spark, sf, "part").select("p_brand", "p_type", "p_partkey", F.col("p_size").cast("double").alias("x"), (F.col("p_partkey") % 50).cast("double").alias("y"))
    boxes = read(spark, sf, "part").select("p_brand", "p_type", F.col("p_partkey").alias("box_id"), F.array(F.lit(0.0), F.lit(0.0), F.col("p_size").cast("double"), (F.col("p_partkey") % 50).cast("double")).alias("box"))
    return J.smallest_covering(p, boxes, ["p_brand", "p_type"], "p_partkey", "x", "y", "box", "box_id").select("p_partkey", "box_id")


register("covering_box", covering_box, """
WITH h AS (SELECT p.p_partkey, b.p_partkey AS box_id, row_number() OVER (PARTITION BY p.p_partkey ORDER BY b.p_size * (b.p_partkey % 50), b.p_partkey) AS r
  FROM part p JOIN part b ON b.p_brand = p.p_brand AND b.p_type = p.p_type AND p.p_size BETWEEN 0 AND b.p_size AND p.p_partkey % 50 BETWEEN 0 AND b.p_partkey % 50)
SELECT p_partkey, box_id FROM h WHERE r = 1
""")


def alias_resolution(spark: SparkSession, sf: str) -> DataFrame:
    n = read(spark, sf, "nation").select(F.lit(1).alias("g"), F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("local_id"), F.col("n_name").alias("name"), F.col("n_nationkey").alias("graph_id"))
    refs = n.select("g", F.col("local_id").alias("ref")).unionByName(n.select("g", F.col("name").alias("ref"))).unionByName(spark.createDataFrame([(1, "nowhere")], "g int, ref string"))
    return J.resolve_alias(refs, "ref", n, ["g"], "local_id", "name", "graph_id").select("ref", "graph_id")


register("alias_resolution", alias_resolution, "SELECT 'n' || n_nationkey AS ref, n_nationkey AS graph_id FROM nation UNION ALL SELECT n_name, n_nationkey FROM nation UNION ALL SELECT 'nowhere', NULL")


def inferred_sequences(spark: SparkSession, sf: str) -> DataFrame:
    p = read(spark, sf, "part").select("p_brand", "p_type", "p_size", "p_partkey")
    return H.inferred_order(p, ["p_brand", "p_type"], "p_partkey", "p_size").select("p_brand", "p_type", F.array_join(F.transform("members", lambda x: x.cast("string")), ",").alias("members"), "n")


register("inferred_sequences", inferred_sequences, """
SELECT p_brand, p_type, string_agg(CAST(p_partkey AS VARCHAR), ',' ORDER BY p_size, p_partkey) AS members, count(*) AS n FROM part GROUP BY 1, 2 HAVING count(*) >= 2 AND count(*) = count(DISTINCT p_size)
""")


def track_edges(spark: SparkSession, sf: str) -> DataFrame:
    e = read(spark, sf, "part").groupBy("p_brand", F.col("p_size").cast("double").alias("x")).agg(F.count("*").alias("support"))
    return H.tracks(e, "p_brand", "x", 1, 3.0)


register("track_edges", track_edges, """
WITH e AS (SELECT p_brand, CAST(p_size AS DOUBLE) AS x0, lead(CAST(p_size AS DOUBLE)) OVER (PARTITION BY p_brand ORDER BY p_size) AS x1 FROM (SELECT DISTINCT p_brand, p_size FROM part))
SELECT p_brand, x0, x1, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY x0) AS INTEGER) AS track_no FROM e WHERE x1 - x0 >= 3
""")
