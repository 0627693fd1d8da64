"""Queries over documents and conversations: chunks, context, terms, scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.functions import scalars as S
from sparkloom.operators import chunks as C
from sparkloom.plans.registry import register
from sparkloom.sources.tables import read

STOP = ["that", "this", "with", "from", "what", "were", "have", "para", "para", "dans", "pour", "avec"]
_STOP_SQL = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP))

#: The fold that packs lines: chunks are joined by \x01 while it runs.
_PACKED = """
list_reduce(list_prepend('', list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> '')),
  lambda acc, x: CASE WHEN acc = '' THEN x
    WHEN length(string_split(acc, chr(1))[-1]) + 1 + length(x) <= 500 THEN acc || chr(10) || x
    ELSE acc || chr(1) || x END)
"""


def chunk_pack(spark: SparkSession, sf: str) -> DataFrame:
    chunks = C.chunk_documents(read(spark, sf, "documents"))
    return chunks.select("doc_id", "ord", F.char_length("chunk_text").alias("n"), S.stable_id("chunk", "doc_id", "ord", "chunk_text").alias("chunk_id"))


register("chunk_pack", chunk_pack, f"""
WITH p AS (SELECT doc_id, string_split({_PACKED}, chr(1)) AS c FROM documents),
e AS (SELECT doc_id, unnest(c) AS chunk_text, generate_subscripts(c, 1) - 1 AS ord FROM p)
SELECT doc_id, CAST(ord AS INTEGER) AS ord, CAST(length(chunk_text) AS INTEGER) AS n,
  'chunk_' || substr(sha1(lower(trim(CAST(doc_id AS VARCHAR))) || '|' || CAST(ord AS VARCHAR) || '|' || lower(trim(chunk_text, ' ' || chr(9) || chr(10) || chr(13)))), 1, 20) AS chunk_id
FROM e WHERE chunk_text <> ''
""")


def chunk_order_context(spark: SparkSession, sf: str) -> DataFrame:
    rows = C.with_index(read(spark, sf, "conversations"), ["conv_id"], ["turn"])
    near = C.neighbour_context(rows, ["conv_id"], ["turn"], "text")
    return near.select("conv_id", "turn", "idx", "previous_tail", "next_head")


register("chunk_order_context", chunk_order_context, """
SELECT conv_id, turn, CAST(row_number() OVER w - 1 AS INTEGER) AS idx,
  right(lag(text) OVER w, 180) AS previous_tail, left(lead(text) OVER w, 180) AS next_head
FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)
""")


def context_budget(spark: SparkSession, sf: str) -> DataFrame:
    kept = C.budgeted(read(spark, sf, "conversations"), ["conv_id"], ["turn"], "text", budget=600, each=200)
    return kept.select("conv_id", "turn", F.char_length("part").alias("n"), F.md5(F.col("part").cast("binary")).alias("part_md5"))


register("context_budget", context_budget, """
WITH c AS (SELECT conv_id, turn, substr(text, 1, 200) AS cut,
    coalesce(sum(length(substr(text, 1, 200))) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used FROM conversations),
p AS (SELECT conv_id, turn, substr(cut, 1, CAST(greatest(0, 600 - used) AS BIGINT)) AS part FROM c)
SELECT conv_id, turn, CAST(length(part) AS INTEGER) AS n, md5(part) AS part_md5 FROM p WHERE length(part) > 0
""")


def round_robin_sample(spark: SparkSession, sf: str) -> DataFrame:
    docs = read(spark, sf, "documents").select("doc_id", "source", "n_chars")
    return C.round_robin(docs, "source", [F.desc("n_chars"), "doc_id"], F.col("doc_id"), 50).select("doc_id", "source", "round")


register("round_robin_sample", round_robin_sample, """
WITH r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS round,
  min(doc_id) OVER (PARTITION BY source) AS seen FROM documents)
SELECT doc_id, source, CAST(round AS INTEGER) AS round FROM r ORDER BY r.round, seen, source LIMIT 50
""")


def term_topk(spark: SparkSession, sf: str) -> DataFrame:
    return C.term_counts(read(spark, sf, "documents"), "doc_id", ["source"], "text", STOP, 40).select("source", "term", "tf", "df", "rank")


register("term_topk", term_topk, f"""
WITH t AS (SELECT doc_id, source, unnest(list_transform(regexp_extract_all(text, '[A-Za-z][A-Za-z-]{{3,}}'), lambda x: lower(x))) AS term FROM documents),
c AS (SELECT source, term, count(*) AS tf, count(DISTINCT doc_id) AS df FROM t WHERE term NOT IN ({_STOP_SQL}) GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY tf DESC, length(term) DESC, term) AS rank FROM c)
SELECT source, term, tf, df, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 40
""")


def term_df(spark: SparkSession, sf: str) -> DataFrame:
    return C.term_counts(read(spark, sf, "documents"), "doc_id", ["lang"], "text", STOP, 100).select("lang", "term", "df")


register("term_df", term_df, f"""
WITH t AS (SELECT doc_id, lang, unnest(list_transform(regexp_extract_all(text, '[A-Za-z][A-Za-z-]{{3,}}'), lambda x: lower(x))) AS term FROM documents),
c AS (SELECT lang, term, count(*) AS tf, count(DISTINCT doc_id) AS df FROM t WHERE term NOT IN ({_STOP_SQL}) GROUP BY 1, 2)
SELECT lang, term, df FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY tf DESC, length(term) DESC, term) AS rk FROM c) WHERE rk <= 100
""")


def line_islands(spark: SparkSession, sf: str) -> DataFrame:
    from sparkloom.operators.lines import explode_lines, islands

    rows = explode_lines(read(spark, sf, "documents"), "doc_id", "text")
    found = islands(rows, ["doc_id"], "pos", F.char_length("line") >= 60)
    return found.groupBy("doc_id", "island").agg(F.count("*").alias("n_lines"), F.min("pos").alias("first_pos"))


register("line_islands", line_islands, """
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents),
i AS (SELECT doc_id, pos, CAST(sum(CASE WHEN length(line) >= 60 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos) AS BIGINT) AS island FROM l)
SELECT doc_id, island, count(*) AS n_lines, CAST(min(pos) AS INTEGER) AS first_pos FROM i GROUP BY 1, 2
""")


def quality_score(spark: SparkSession, sf: str) -> DataFrame:
    from sparkloom.operators.aggregates import quality_report

    d = read(spark, sf, "documents").select("doc_id", "source", F.length("text").alias("n"), F.size(F.split("text", "\n")).alias("lines"))
    return quality_report(d)


register("quality_score", quality_score, """
WITH d AS (SELECT doc_id, source, length(text) AS n, len(string_split(text, chr(10))) AS lines FROM documents),
p AS (SELECT doc_id, least(1.0, n / 2000.0) AS filled, least(1.0, lines / 10.0) AS covered, CASE WHEN n > 100 THEN 1.0 ELSE 0.0 END AS placed, n, lines FROM d)
SELECT doc_id, round(0.35 * filled + 0.35 * covered + 0.30 * placed, 6) AS score,
  concat_ws(',', CASE WHEN n < 50 THEN 'too_short' END, CASE WHEN lines < 2 THEN 'single_line' END) AS errors,
  (0.35 * filled + 0.35 * covered + 0.30 * placed) >= 0.55 AND n >= 50 AND lines >= 2 AS passed
FROM p
""")


def jaccard_pairs(spark: SparkSession, sf: str) -> DataFrame:
    from sparkloom.operators.joins import shared_token_pairs

    docs = read(spark, sf, "documents").select("doc_id", C.technical_terms(F.col("text"), STOP).alias("tokens"))
    items = read(spark, sf, "benchmark").select("item_id", C.technical_terms(F.col("text"), STOP).alias("tokens"))
    return shared_token_pairs(items, "item_id", docs, "doc_id", "tokens", at_least=0.1).select("item_id", "doc_id", F.round("jaccard", 6).alias("jaccard"))


register("jaccard_pairs", jaccard_pairs, f"""
WITH d AS (SELECT DISTINCT doc_id, unnest(list_transform(regexp_extract_all(text, '[A-Za-z][A-Za-z-]{{3,}}'), lambda x: lower(x))) AS t FROM documents),
b AS (SELECT DISTINCT item_id, unnest(list_transform(regexp_extract_all(text, '[A-Za-z][A-Za-z-]{{3,}}'), lambda x: lower(x))) AS t FROM benchmark),
d1 AS (SELECT * FROM d WHERE t NOT IN ({_STOP_SQL})), b1 AS (SELECT * FROM b WHERE t NOT IN ({_STOP_SQL})),
dn AS (SELECT doc_id, count(*) AS n FROM d1 GROUP BY 1), bn AS (SELECT item_id, count(*) AS n FROM b1 GROUP BY 1),
s AS (SELECT item_id, doc_id, count(*) AS k FROM b1 JOIN d1 USING (t) GROUP BY 1, 2)
SELECT item_id, doc_id, round(k / (dn.n + bn.n - k), 6) AS jaccard FROM s JOIN dn USING (doc_id) JOIN bn USING (item_id) WHERE k / (dn.n + bn.n - k) >= 0.1
""")


def lexical_score(spark: SparkSession, sf: str) -> DataFrame:
    from sparkloom.operators.joins import contained_terms

    parts = read(spark, sf, "part").select("p_partkey", F.split("p_name", " ")[0].alias("first_word"), F.lower("p_name").alias("name"))
    names = read(spark, sf, "part").select(F.split("p_name", " ")[0].alias("name")).distinct().withColumn("n_nationkey", F.col("name"))
    found = contained_terms(parts, "p_partkey", "name", names, "n_nationkey", "name")
    return found.groupBy("p_partkey").agg(F.count("*").alias("hits")).select(
        "p_partkey", "hits",
        F.round(S.lexical_score(F.lit(""), F.lit(""), F.array().cast("array<string>"), F.array().cast("array<string>"), F.lit(0.0), F.col("hits")), 6).alias("score"),
    )


register("lexical_score", lexical_score, """
WITH n AS (SELECT DISTINCT split_part(p_name, ' ', 1) AS name FROM part), h AS (SELECT p_partkey, count(*) AS hits FROM part JOIN n ON contains(lower(p_name), name) GROUP BY 1)
SELECT p_partkey, hits, CAST(round(least(0.85, 0.45 + 0.1 * hits), 6) AS DOUBLE) AS score FROM h
""")
