"""Queries over graphs made of keys of the star schema, and over events as observations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.functions import scalars as S
from sparkloom.operators import aggregates as A
from sparkloom.operators import graphs as G
from sparkloom.operators import hierarchy as H
from sparkloom.plans.registry import register
from sparkloom.sources.tables import read


def stable_ids(spark: SparkSession, sf: str) -> DataFrame:
    c = read(spark, sf, "customer")
    return c.select("c_custkey", S.stable_id("ent", "c_name", "c_mktsegment", S.falsy_to_empty("c_nationkey")).alias("entity_id"), S.image_id(F.lit("img"), "c_mktsegment", "c_name").alias("image_id"))


register("stable_ids", stable_ids, """
SELECT c_custkey, 'ent_' || substr(sha1(lower(trim(c_name)) || '|' || lower(trim(c_mktsegment)) || '|' || CASE WHEN c_nationkey = 0 THEN '' ELSE CAST(c_nationkey AS VARCHAR) END), 1, 20) AS entity_id,
  c_mktsegment || '_' || substr(regexp_replace(regexp_replace(lower(c_name), '[^0-9a-z]+', '_', 'g'), '^_+|_+$', '', 'g'), 1, 48) || '_' || substr(sha1('img|' || c_mktsegment || '|' || c_name), 1, 10) AS image_id
FROM customer
""")


def graph_merge_last(spark: SparkSession, sf: str) -> DataFrame:
    e = read(spark, sf, "events").select("user_id", "event_type", "event_id", "value")
    return G.merge_last(e, ["user_id"], "event_id", ["event_type", "value"])


register("graph_merge_last", graph_merge_last, """
SELECT user_id, min(event_id) AS pos, max_by(event_type, event_id) AS event_type, max_by(value, event_id) AS value, count(*) AS occurrences FROM events GROUP BY 1
""")


def graph_merge_first(spark: SparkSession, sf: str) -> DataFrame:
    return G.merge_first(read(spark, sf, "events"), ["user_id"], "event_id", ["event_type", "value"])


register("graph_merge_first", graph_merge_first, """
SELECT user_id, min(event_id) AS pos, min_by(event_type, event_id) AS event_type, min_by(value, event_id) AS value FROM events GROUP BY 1
""")


def explicit_wins(spark: SparkSession, sf: str) -> DataFrame:
    e = read(spark, sf, "events").withColumn("explicit", F.col("event_type") == "purchase").withColumn("day", F.to_date("ts"))
    return G.merge_explicit(e, ["user_id", "day"], "explicit", "event_id", ["event_type", "value"])


register("explicit_wins", explicit_wins, """
WITH r AS (SELECT user_id, CAST(ts AS DATE) AS day, event_type, value, event_type = 'purchase' AS explicit,
  row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY CASE WHEN event_type = 'purchase' THEN 0 ELSE 1 END, event_id) AS rn FROM events)
SELECT user_id, day, explicit, event_type, value FROM r WHERE rn = 1
""")


def max_conf(spark: SparkSession, sf: str) -> DataFrame:
    e = read(spark, sf, "events").withColumn("tags", F.array("event_type"))
    return A.best_by_confidence(e, ["user_id"], "value", "event_id", ["event_id"], ["tags"], ["event_type"]).select(
        "user_id", "value", "event_id", F.array_join("tags", ",").alias("tags"), "event_type"
    )


register("max_conf", max_conf, """
SELECT user_id, max(value) AS value, (SELECT event_id FROM events i WHERE i.user_id = e.user_id ORDER BY value DESC, event_id LIMIT 1) AS event_id,
  string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS tags, string_agg(DISTINCT event_type, '; ' ORDER BY event_type) AS event_type FROM events e GROUP BY user_id
""")


def graph_meta(spark: SparkSession, sf: str) -> DataFrame:
    d = read(spark, sf, "documents").select(F.col("source").alias("graph_group"), F.col("doc_id").alias("document_id"), F.col("lang").alias("modality"))
    return G.merge_graphs(d)


register("graph_meta", graph_meta, """
SELECT source AS graph_group, CASE WHEN count(DISTINCT doc_id) = 1 THEN min(doc_id) END AS document_id,
  CASE WHEN count(DISTINCT lang) > 1 THEN 'mixed' ELSE min(lang) END AS modality, count(*) AS merged_graph_count FROM documents GROUP BY 1
""")


def dangling_refs(spark: SparkSession, sf: str) -> DataFrame:
    lines = read(spark, sf, "lineitem")
    parts = read(spark, sf, "part").where("p_size < 45")
    return G.dangling(lines, ["l_partkey"], parts, "p_partkey", ["l_orderkey", "l_linenumber"])


register("dangling_refs", dangling_refs, """
SELECT l_orderkey, l_linenumber, 'l_partkey' AS "end", CAST(l_partkey AS VARCHAR) AS ref FROM lineitem
WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 45)
""")


def dup_ids(spark: SparkSession, sf: str) -> DataFrame:
    return A.duplicates(read(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"]).unionByName(
        A.duplicates(read(spark, sf, "lineitem").select("l_orderkey", F.lit(0).alias("l_linenumber")), ["l_orderkey", "l_linenumber"])
    )


register("dup_ids", dup_ids, """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
UNION ALL SELECT l_orderkey, 0, count(*) FROM lineitem GROUP BY 1 HAVING count(*) > 1
""")


def schema_triples(spark: SparkSession, sf: str) -> DataFrame:
    lines = read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", F.month("l_shipdate").alias("m"))
    allowed = read(spark, sf, "lineitem").where("l_quantity > 49").select("l_returnflag", "l_linestatus", F.month("l_shipdate").alias("m"))
    return G.illegal_triples(lines, ["l_returnflag", "l_linestatus", "m"], allowed.where("m < 7"), ["l_orderkey", "l_linenumber"])


register("schema_triples", schema_triples, """
WITH a AS (SELECT DISTINCT l_returnflag, l_linestatus, month(l_shipdate) AS m FROM lineitem WHERE l_quantity > 49 AND month(l_shipdate) < 7)
SELECT l_orderkey, l_linenumber FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.l_returnflag = l.l_returnflag AND a.l_linestatus = l.l_linestatus AND a.m = month(l.l_shipdate))
""")


def provenance(spark: SparkSession, sf: str) -> DataFrame:
    e = read(spark, sf, "events").withColumn("p", F.when(F.col("event_type") == "view", F.lit(" ")).when(F.col("event_type") != "error", F.col("event_type")))
    return G.missing_provenance(e, "event_id", "p")


register("provenance", provenance, """
SELECT event_id, 'missing_provenance' AS problem FROM events WHERE event_type IN ('view', 'error')
""")


def retained_invalid(spark: SparkSession, sf: str) -> DataFrame:
    o = read(spark, sf, "orders")
    name = F.when(F.col("o_orderkey") % 7 != 0, F.concat(F.lit("order "), F.col("o_orderkey").cast("string")))
    entities = o.select(F.col("o_custkey").alias("chunk_id"), F.col("o_orderkey").alias("temp_id"), name.alias("name"), F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderstatus")).alias("type"))
    none = o.select(F.col("o_custkey").alias("chunk_id"), F.col("o_orderkey").alias("temp_id"), F.lit("x").alias("type"), F.col("o_orderkey").alias("source_id"), (F.col("o_orderkey") + 1).alias("target_id"))
    found, relations = G.parse_candidates(entities, none)
    e = found.select("temp_id", F.lit("entity").alias("kind"), F.array_join("errors", ",").alias("errors"))
    return e.unionByName(relations.select("temp_id", F.lit("relation").alias("kind"), F.array_join("errors", ",").alias("errors")))


register("retained_invalid", retained_invalid, """
SELECT o_orderkey AS temp_id, 'entity' AS kind, concat_ws(',', CASE WHEN o_orderkey % 7 = 0 THEN 'missing_name' END, CASE WHEN o_orderkey % 5 = 0 THEN 'missing_type' END) AS errors FROM orders
UNION ALL
SELECT o.o_orderkey, 'relation', CASE WHEN EXISTS (SELECT 1 FROM orders n WHERE n.o_custkey = o.o_custkey AND n.o_orderkey = o.o_orderkey + 1) THEN '' ELSE 'missing_target' END FROM orders o
""")


def _edges(spark: SparkSession, sf: str) -> DataFrame:
    n, c, s = read(spark, sf, "nation"), read(spark, sf, "customer"), read(spark, sf, "supplier")
    edge = lambda df, a, b, kind: df.select(F.concat(F.lit(a[0]), F.col(a[1]).cast("string")).alias("src"), F.lit(kind).alias("rel"), F.concat(F.lit(b[0]), F.col(b[1]).cast("string")).alias("dst"))
    return edge(n, ("n", "n_nationkey"), ("r", "n_regionkey"), "part_of").unionByName(edge(c, ("c", "c_custkey"), ("n", "c_nationkey"), "lives_in")).unionByName(edge(s, ("s", "s_suppkey"), ("n", "s_nationkey"), "works_in"))


_EDGES = """
e AS (SELECT 'n' || n_nationkey AS src, 'part_of' AS rel, 'r' || n_regionkey AS dst FROM nation
  UNION ALL SELECT 'c' || c_custkey, 'lives_in', 'n' || c_nationkey FROM customer
  UNION ALL SELECT 's' || s_suppkey, 'works_in', 'n' || s_nationkey FROM supplier)
"""


def one_hop(spark: SparkSession, sf: str) -> DataFrame:
    seeds = read(spark, sf, "nation").where("n_regionkey = 1").select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("seed"))
    return G.neighbourhood(_edges(spark, sf), seeds, "seed", "src", "dst", ["src", "rel", "dst"], 200)


register("one_hop", one_hop, f"""
WITH {_EDGES}, s AS (SELECT 'n' || n_nationkey AS seed FROM nation WHERE n_regionkey = 1)
SELECT DISTINCT src, rel, dst FROM e WHERE src IN (SELECT seed FROM s) OR dst IN (SELECT seed FROM s) ORDER BY src, rel, dst LIMIT 200
""")


def induced_edges(spark: SparkSession, sf: str) -> DataFrame:
    e = _edges(spark, sf)
    names = e.where("rel <> 'works_in'").select(F.col("dst").alias("name")).unionByName(e.where("src LIKE 's%'").select(F.col("src").alias("name"))).distinct()
    return G.induced(e, names, "name", "src", "dst", ["src", "rel", "dst"], 500)


register("induced_edges", induced_edges, f"""
WITH {_EDGES}, n AS (SELECT dst AS name FROM e WHERE rel <> 'works_in' UNION SELECT src FROM e WHERE src LIKE 's%')
SELECT DISTINCT src, rel, dst FROM e WHERE src IN (SELECT name FROM n) AND dst IN (SELECT name FROM n) ORDER BY src, rel, dst LIMIT 500
""")


def inverse_edges(spark: SparkSession, sf: str) -> DataFrame:
    e = _edges(spark, sf).withColumn("explicit", F.lit(True))
    return G.with_inverse(e, "src", "rel", "dst")


register("inverse_edges", inverse_edges, f"""
WITH {_EDGES} SELECT src, rel, dst, true AS explicit FROM e UNION ALL SELECT dst, 'contains', src, false FROM e WHERE rel = 'part_of'
""")


def isolated_prune(spark: SparkSession, sf: str) -> DataFrame:
    n = read(spark, sf, "nation").select("n_nationkey", "n_name")
    s = read(spark, sf, "supplier").select("s_nationkey", "s_suppkey")
    return G.prune_isolated(n.withColumnRenamed("n_nationkey", "k"), "k", s.select(F.col("s_nationkey").alias("a"), F.col("s_nationkey").alias("b")), "a", "b")


register("isolated_prune", isolated_prune, "SELECT n_nationkey AS k, n_name FROM nation WHERE n_nationkey IN (SELECT s_nationkey FROM supplier)")


def node_degrees(spark: SparkSession, sf: str) -> DataFrame:
    e = _edges(spark, sf)
    nodes = e.select(F.explode(F.array("src", "dst")).alias("node")).unionByName(spark.createDataFrame([("zz",)], "node string"))
    return A.degrees(nodes, "node", e, "src", "dst")


register("node_degrees", node_degrees, f"""
WITH {_EDGES}, d AS (SELECT src AS node FROM e UNION ALL SELECT dst FROM e) SELECT node, count(*) AS degree FROM d GROUP BY 1 UNION ALL SELECT 'zz', 0
""")


def adjacent_overlies(spark: SparkSession, sf: str) -> DataFrame:
    return H.adjacent_pairs(read(spark, sf, "part"), ["p_brand", "p_type"], "p_size", "p_partkey")


register("adjacent_overlies", adjacent_overlies, """
WITH r AS (SELECT p_brand, p_type, p_partkey, count(*) OVER (PARTITION BY p_brand, p_type, p_size) AS n,
  lead(p_partkey) OVER w AS nx FROM part WINDOW w AS (PARTITION BY p_brand, p_type ORDER BY p_size, p_partkey)),
m AS (SELECT r.*, c.n AS nn FROM r JOIN r c ON c.p_partkey = r.nx)
SELECT p_brand, p_type, p_partkey AS lower, nx AS upper FROM m WHERE n = 1 AND nn = 1
""")


def _tree(spark: SparkSession, sf: str) -> DataFrame:
    r = read(spark, sf, "region").select(F.concat(F.lit("r"), "r_regionkey").alias("node"), F.lit(None).cast("string").alias("parent"), F.col("r_regionkey").cast("long").alias("ord"), F.lit(0.0).alias("v"))
    n = read(spark, sf, "nation").select(F.concat(F.lit("n"), "n_nationkey").alias("node"), F.concat(F.lit("r"), "n_regionkey").alias("parent"), F.col("n_nationkey").cast("long").alias("ord"), F.lit(0.0).alias("v"))
    c = read(spark, sf, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("node"), F.concat(F.lit("n"), "c_nationkey").alias("parent"), F.col("c_custkey").alias("ord"), F.lit(0.0).alias("v"))
    o = read(spark, sf, "orders").select(F.concat(F.lit("o"), "o_orderkey").alias("node"), F.concat(F.lit("c"), "o_custkey").alias("parent"), F.col("o_orderkey").alias("ord"), F.col("o_totalprice").alias("v"))
    return r.unionByName(n).unionByName(c).unionByName(o).withColumn("tree", F.lit(0))


_TREE = """
t AS (SELECT 'r' || r_regionkey AS node, CAST(NULL AS VARCHAR) AS parent, CAST(r_regionkey AS BIGINT) AS ord, 0.0::DOUBLE AS v FROM region
  UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, n_nationkey, 0.0 FROM nation
  UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey, c_custkey, 0.0 FROM customer
  UNION ALL SELECT 'o' || o_orderkey, 'c' || o_custkey, o_orderkey, o_totalprice FROM orders)
"""


def tree_levels(spark: SparkSession, sf: str) -> DataFrame:
    return H.levels(_tree(spark, sf), ["tree"], "node", "parent").select("node", "height")


register("tree_levels", tree_levels, f"""
WITH RECURSIVE {_TREE}, up AS (SELECT node, parent, 0 AS h FROM t UNION ALL SELECT t.node, t.parent, up.h + 1 FROM up JOIN t ON t.node = up.parent)
SELECT node, CAST(max(h) AS INTEGER) AS height FROM up GROUP BY 1
""")


def bottom_up_totals(spark: SparkSession, sf: str) -> DataFrame:
    return H.rollup_totals(_tree(spark, sf), "node", "parent", "v").select("node", F.round("total", 2).alias("total"))


register("bottom_up_totals", bottom_up_totals, f"""
WITH RECURSIVE {_TREE}, up AS (SELECT node AS root, node, parent, v FROM t UNION ALL SELECT up.root, t.node, t.parent, up.v FROM up JOIN t ON t.node = up.parent)
SELECT node, round(sum(v), 2) AS total FROM up GROUP BY 1
""")


def dfs_order(spark: SparkSession, sf: str) -> DataFrame:
    return H.paths(_tree(spark, sf), ["tree"], "node", "parent", "ord").select("node", F.array_join(F.transform("sort_path", lambda x: x.cast("string")), "/").alias("path"))


register("dfs_order", dfs_order, f"""
WITH RECURSIVE {_TREE}, p AS (SELECT node, CAST(ord AS VARCHAR) AS path FROM t WHERE parent IS NULL UNION ALL SELECT t.node, p.path || '/' || t.ord FROM p JOIN t ON t.parent = p.node)
SELECT node, path FROM p
""")


def bottom_up_fold(spark: SparkSession, sf: str) -> DataFrame:
    t = _tree(spark, sf)
    summed = H.bottom_up(t, ["tree"], "node", "parent", "ord", F.col("node"), lambda own, kids: F.concat(own, F.lit("("), F.size(kids).cast("string"), F.lit(":"), F.substring(F.md5(F.array_join(kids, "").cast("binary")), 1, 6), F.lit(")")), "empty")
    return summed.select("node", "summary")


register("bottom_up_fold", bottom_up_fold, f"""
WITH {_TREE}, o AS (SELECT node, parent, ord, node || '(0:' || substr(md5(''), 1, 6) || ')' AS s FROM t WHERE node LIKE 'o%'),
c AS (SELECT t.node, t.parent, t.ord, t.node || '(' || count(o.node) || ':' || substr(md5(coalesce(string_agg(o.s, '' ORDER BY o.ord), '')), 1, 6) || ')' AS s FROM t LEFT JOIN o ON o.parent = t.node WHERE t.node LIKE 'c%' GROUP BY t.node, t.parent, t.ord),
n AS (SELECT t.node, t.parent, t.ord, t.node || '(' || count(c.node) || ':' || substr(md5(coalesce(string_agg(c.s, '' ORDER BY c.ord), '')), 1, 6) || ')' AS s FROM t LEFT JOIN c ON c.parent = t.node WHERE t.node LIKE 'n%' GROUP BY t.node, t.parent, t.ord),
r AS (SELECT t.node, t.node || '(' || count(n.node) || ':' || substr(md5(coalesce(string_agg(n.s, '' ORDER BY n.ord), '')), 1, 6) || ')' AS s FROM t LEFT JOIN n ON n.parent = t.node WHERE t.node LIKE 'r%' GROUP BY t.node)
SELECT node, s AS summary FROM o UNION ALL SELECT node, s FROM c UNION ALL SELECT node, s FROM n UNION ALL SELECT node, s FROM r
""")


def overlay_merge(spark: SparkSession, sf: str) -> DataFrame:
    c = read(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", F.col("c_custkey").alias("pos"))
    p = c.where("c_custkey % 10 = 0").select("c_custkey", F.concat("c_name", F.lit(" new")).alias("c_name"), F.lit(None).cast("string").alias("c_mktsegment"), "pos")
    more = c.where("c_custkey % 25 = 0 AND c_custkey > 0").select((-F.col("c_custkey")).alias("c_custkey"), F.lit("added").alias("c_name"), F.lit("X").alias("c_mktsegment"), "pos")
    return G.overlay(c, p.unionByName(more), "c_custkey", "pos", ["c_name", "c_mktsegment"])


register("overlay_merge", overlay_merge, """
SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN c_name || ' new' ELSE c_name END AS c_name, c_mktsegment, false AS added, c_custkey AS pos FROM customer
UNION ALL SELECT -c_custkey, 'added', 'X', true, c_custkey FROM customer WHERE c_custkey % 25 = 0 AND c_custkey > 0
""")


def alias_rewrite(spark: SparkSession, sf: str) -> DataFrame:
    aliases = read(spark, sf, "nation").select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("old"), F.col("n_name").alias("new"))
    return G.rewrite_refs(_edges(spark, sf), ["src", "dst"], aliases, "old", "new")


register("alias_rewrite", alias_rewrite, f"""
WITH {_EDGES}, a AS (SELECT 'n' || n_nationkey AS o, n_name AS nw FROM nation)
SELECT coalesce(x.nw, src) AS src, rel, coalesce(y.nw, dst) AS dst FROM e LEFT JOIN a x ON x.o = src LEFT JOIN a y ON y.o = dst
""")


def relation_freq(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "events").groupBy(F.upper(F.trim("event_type")).alias("relation")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "relation")


register("relation_freq", relation_freq, "SELECT upper(trim(event_type)) AS relation, count(*) AS n FROM events GROUP BY 1 ORDER BY 2 DESC, 1")


def dedupe_entities(spark: SparkSession, sf: str) -> DataFrame:
    d = read(spark, sf, "documents").select("doc_id", F.lower(F.trim(F.split("text", "\n")[0])).alias("name"), F.col("lang").alias("type"))
    return G.merge_first(d, ["name", "type"], "doc_id", ["doc_id"]).select("doc_id", "type", F.md5(F.col("name").cast("binary")).alias("name_md5"), "pos")


register("dedupe_entities", dedupe_entities, """
WITH d AS (SELECT doc_id, lower(trim(string_split(text, chr(10))[1])) AS name, lang AS type FROM documents)
SELECT min(doc_id) AS doc_id, type, md5(name) AS name_md5, min(doc_id) AS pos FROM d GROUP BY name, type
""")


def entity_clusters(spark: SparkSession, sf: str) -> DataFrame:
    d = read(spark, sf, "documents").select("doc_id", F.md5(F.split("text", "\n")[0].cast("binary")).alias("k"))
    first = d.groupBy("k").agg(F.min("doc_id").alias("f"))
    return G.clusters(d.join(first, "k"), "doc_id", "f")


register("entity_clusters", entity_clusters, """
SELECT doc_id AS node, min(doc_id) OVER (PARTITION BY md5(string_split(text, chr(10))[1])) AS cluster_id FROM documents
""")


def aligned_relations(spark: SparkSession, sf: str) -> DataFrame:
    e = read(spark, sf, "events")
    members = e.select(F.col("user_id").alias("entity_id"), (F.col("user_id") % 20).alias("cluster_id")).distinct()
    rel = e.select(F.col("event_id").alias("relation_id"), F.col("user_id").alias("source_id"), F.col("event_type").alias("type"), (F.col("user_id") + 1).alias("target_id"), F.col("value").alias("confidence"))
    return G.align_relations(rel, members)


register("aligned_relations", aligned_relations, """
WITH m AS (SELECT DISTINCT user_id FROM events),
r AS (SELECT event_id, e.user_id % 20 AS source, upper(event_type) AS type, CASE WHEN t.user_id IS NULL THEN e.user_id + 1 ELSE t.user_id % 20 END AS target, value FROM events e LEFT JOIN m t ON t.user_id = e.user_id + 1)
SELECT source, type, target, arg_min(event_id, (-value, event_id)) AS relation_id, max(value) AS confidence, count(*) AS support FROM r GROUP BY 1, 2, 3
""")


def fused_graph(spark: SparkSession, sf: str) -> DataFrame:
    e = _edges(spark, sf)
    return G.fuse({"skeleton": e.where("rel = 'part_of'"), "aligned": e.where("rel = 'lives_in'"), "discovered": e.where("rel = 'works_in'").select("src", "dst")})


register("fused_graph", fused_graph, f"""
WITH {_EDGES} SELECT src, CASE WHEN rel = 'works_in' THEN NULL ELSE rel END AS rel, dst, CASE rel WHEN 'part_of' THEN 'skeleton' WHEN 'lives_in' THEN 'aligned' ELSE 'discovered' END AS origin FROM e
""")


def unpivot_record(spark: SparkSession, sf: str) -> DataFrame:
    li = read(spark, sf, "lineitem")
    pairs = F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(c).alias("header"), F.col(c).alias("value")) for i, c in enumerate(["l_quantity", "l_extendedprice", "l_discount", "l_tax"])])
    return li.select("l_orderkey", "l_linenumber", F.explode(pairs).alias("p")).select("l_orderkey", "l_linenumber", "p.header", "p.value")


register("unpivot_record", unpivot_record, """
SELECT l_orderkey, l_linenumber, header, value FROM (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem)
UNPIVOT (value FOR header IN (l_quantity, l_extendedprice, l_discount, l_tax))
""")


def _cells(spark: SparkSession, sf: str) -> DataFrame:
    s = read(spark, sf, "supplier")
    cols = F.array(*[F.struct(F.lit(i).alias("col"), F.lit(c).alias("header"), F.col(c).cast("string").alias("text")) for i, c in enumerate(["s_name", "s_nationkey"])])
    return s.select(F.lit("t1").alias("table_id"), (F.col("s_suppkey") - 1).cast("int").alias("row"), F.explode(cols).alias("c")).select("table_id", "row", "c.col", "c.header", "c.text")


def cell_edges(spark: SparkSession, sf: str) -> DataFrame:
    _, edges = G.table_graph(_cells(spark, sf))
    return edges.groupBy("type").agg(F.count("*").alias("n"), F.count_distinct("source").alias("sources"), F.count_distinct("target").alias("targets"))


register("cell_edges", cell_edges, """
WITH s AS (SELECT s_suppkey FROM supplier), n AS (SELECT count(*) AS n FROM s)
SELECT 'HAS_ROW' AS type, n AS n, 1 AS sources, n AS targets FROM n UNION ALL SELECT 'HAS_COLUMN', 2, 1, 2
UNION ALL SELECT 'HAS_HEADER', 2, 2, 2 UNION ALL SELECT 'HAS_CELL', 2 * n, n, 2 * n FROM n UNION ALL SELECT 'IN_COLUMN', 2 * n, 2 * n, 2 FROM n
""")


def record_maps(spark: SparkSession, sf: str) -> DataFrame:
    r = G.record_map(_cells(spark, sf), ["table_id", "row"], "col", "header", "text")
    return r.select("row", F.col("record")["s_name"].alias("name"), F.col("record")["s_nationkey"].alias("nation"), F.size("record").alias("n"))


register("record_maps", record_maps, """
SELECT CAST(s_suppkey - 1 AS INTEGER) AS row, s_name AS name, CAST(s_nationkey AS VARCHAR) AS nation, 2 AS n FROM supplier
""")


def guarded_updates(spark: SparkSession, sf: str) -> DataFrame:
    name = F.concat_ws(" ", "c_mktsegment", F.col("c_nationkey").cast("string"), F.floor(F.col("c_acctbal") / 1000).cast("string"))
    c = read(spark, sf, "customer").select("c_custkey", name.alias("name"))
    e = c.select(F.col("c_custkey").alias("entity_id"), "name")
    one = c.select(F.col("c_custkey").alias("instr_id"), "name", F.lit("merge").alias("action"), F.lit(2).alias("least"))
    two = spark.createDataFrame([(-1, "nobody", "update", None)], "instr_id long, name string, action string, least int")
    out = G.guarded_corrections(one.unionByName(two), e)
    return out.select("instr_id", "matches", "applied", "reason", F.size("entity_ids").alias("n"))


register("guarded_updates", guarded_updates, """
WITH c AS (SELECT c_custkey, c_mktsegment || ' ' || c_nationkey || ' ' || CAST(floor(c_acctbal / 1000) AS BIGINT) AS name FROM customer), m AS (SELECT name, count(*) AS k FROM c GROUP BY 1)
SELECT c_custkey AS instr_id, k AS matches, k >= 2 AS applied, CASE WHEN k < 2 THEN 'match_count' END AS reason, CAST(k AS INTEGER) AS n FROM c JOIN m USING (name)
UNION ALL SELECT -1, 0, false, 'no_match', 0
""")


def relation_rejects(spark: SparkSession, sf: str) -> DataFrame:
    e = _edges(spark, sf).unionByName(spark.createDataFrame([("n1", "part_of", "n1"), ("n1", "odd", "n2")], "src string, rel string, dst string"))
    nodes = e.where("rel = 'part_of'").select(F.explode(F.array("src", "dst")).alias("node")).unionByName(e.where("rel = 'works_in'").select(F.col("src").alias("node")))
    return G.relation_rejects(e, nodes, "node", "src", "dst", "rel", ["part_of", "works_in", "lives_in"])


register("relation_rejects", relation_rejects, f"""
WITH {_EDGES}, x AS (SELECT * FROM e UNION ALL SELECT 'n1', 'part_of', 'n1' UNION ALL SELECT 'n1', 'odd', 'n2'),
k AS (SELECT src AS node FROM x WHERE rel IN ('part_of', 'works_in') UNION SELECT dst FROM x WHERE rel = 'part_of')
SELECT src, rel, dst, CASE WHEN src NOT IN (SELECT node FROM k) OR dst NOT IN (SELECT node FROM k) THEN 'unresolved_endpoint' WHEN src = dst THEN 'self_relation' WHEN rel = 'odd' THEN 'unsupported_relation_type' END AS reason FROM x
""")


def result_status(spark: SparkSession, sf: str) -> DataFrame:
    o = read(spark, sf, "orders")
    graphs = o.select("o_orderkey", F.when(F.col("o_orderstatus") == "F", "completed").otherwise("failed").alias("status"))
    errors = read(spark, sf, "lineitem").where("l_quantity > 48").select(F.col("l_orderkey").alias("o_orderkey"))
    dropped = read(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), (F.col("l_returnflag") == "R").alias("explicit"), F.col("l_linestatus").alias("type"))
    return G.result_status(graphs, errors, dropped, "o_orderkey", ["O"]).select("o_orderkey", "n_errors", "n_dropped", "final_status")


register("result_status", result_status, """
WITH e AS (SELECT l_orderkey, count(*) AS k FROM lineitem WHERE l_quantity > 48 GROUP BY 1), d AS (SELECT l_orderkey, count(*) AS k FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus <> 'O' GROUP BY 1)
SELECT o_orderkey, coalesce(e.k, 0) AS n_errors, coalesce(d.k, 0) AS n_dropped, CASE WHEN o_orderstatus = 'F' AND e.k IS NULL AND d.k IS NULL THEN 'completed' ELSE 'failed' END AS final_status
FROM orders LEFT JOIN e ON e.l_orderkey = o_orderkey LEFT JOIN d ON d.l_orderkey = o_orderkey
""")
