"""The registered queries of this subpackage, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm.common import table


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkloom.llm.fingerprint import fingerprint_with_neighbours

    return fingerprint_with_neighbours(table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkloom.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkloom.llm.tokenise import encode_digests

    return encode_digests(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkloom.llm.quality import quality

    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkloom.llm.toxicity import toxicity

    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkloom.llm.sharding import shard

    return shard(table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkloom.llm.simhash import near_duplicates

    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkloom.llm.rules import quality_rules

    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkloom.llm.lines import drop_recurring_lines

    found = drop_recurring_lines(table(spark, sf_dir, "documents"), copy_share=1.0)
    return found.select("doc_id", "text", "n_lines", "n_dropped", F.array_join("dropped_lines", ",").alias("dropped_lines"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkloom.llm.tokenise import token_counts

    counts = token_counts(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 2048)


QUERIES = {
    "op1_fingerprints": op1_fingerprints,
    "op2_packing": op2_packing,
    "op3_bpe": op3_bpe,
    "op4_quality": op4_quality,
    "op5_toxicity": op5_toxicity,
    "op6_sharding": op6_sharding,
    "op7_simhash": op7_simhash,
    "op8_rules": op8_rules,
    "op9_lines": op9_lines,
    "op10_token_counts": op10_token_counts,
}

#: Queries that SQL expresses over whole tables: none of these; tests hold them against brute force.
ORACLE_SQL: dict[str, str] = {}
