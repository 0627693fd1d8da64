"""The corpus pipeline: documents pass through five stages, each written as Parquet and read again."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm.common import materialize, scratch_dir, table
from sparkloom.llm.lines import drop_recurring_lines
from sparkloom.llm.packing import pack
from sparkloom.llm.quality import keep_good
from sparkloom.llm.queries import vocabulary
from sparkloom.llm.simhash import near_duplicates
from sparkloom.llm.toxicity import reject_toxic

#: A list of rows to drop is broadcast up to this many bytes, at so many bytes a row.
BROADCAST_BYTES, ROW_BYTES = 32 << 20, 64


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents whose toxicity score reaches the threshold go.

    Null and empty texts have the score of no difference and stay, repeated rows go or stay together; any columns.
    """
    return reject_toxic(docs, table(spark, sf_dir, "labels"))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents whose quality score is below the threshold go.

    Null and empty texts are scored by their statistics, all 0, like any other; repeated rows go or stay together.
    """
    return keep_good(docs, table(spark, sf_dir, "labels"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: lines of recurring templates go from the text; n_chars, if there is one, follows it.

    Null texts stay null; a document of which nothing is left stays with an empty text. Repeated rows are treated alike.
    """
    found = drop_recurring_lines(docs, copy_share=1.0).select(*docs.columns)
    if "n_chars" in docs.columns:
        changed = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        found = found.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(changed))
    return found


def _placed(docs: DataFrame) -> tuple[DataFrame, tuple[Column, Column]]:
    """docs, written first unless it is a table of files, and the columns that tell its rows apart: file and place."""
    try:
        place = docs.metadataColumn("_metadata")
        docs.select(place["file_path"], place["row_index"])
    except AnalysisException:
        docs = materialize(docs, "pipeline-rows")
        place = docs.metadataColumn("_metadata")
    return docs, (F.xxhash64(place["file_path"]), place["row_index"])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: of each component one row stays, that of the smallest doc_id; rows without an id come last.

    Each row has a class of its own text, whether it shares its id, or has none. Of rows that are equal in id, those of
    the smallest hash of the text, then of the other columns, come first; of rows that are repeated, any one. Texts are
    shuffled only if the list of rows to drop is too long to broadcast, and any columns are carried as they are.
    """
    docs, (file, row) = _placed(docs)
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    rest = F.xxhash64(F.to_json(F.struct(*[docs[c] for c in others]))) if others else F.lit(0).cast("long")
    key = F.struct(
        docs["doc_id"].isNull().alias("no_id"), docs["doc_id"].alias("id"), F.xxhash64(docs["text"]).alias("text_key"), rest.alias("rest_key"),
        file.alias("file"), row.alias("row"),
    )
    classes = near_duplicates(docs.select(key.alias("doc_id"), docs["text"]))
    gone = materialize(classes.where("doc_id <> component_id").select("doc_id.file", "doc_id.row"), "pipeline-copies")
    if gone.count() * ROW_BYTES <= BROADCAST_BYTES:
        gone = F.broadcast(gone)
    return docs.join(gone, (file == gone["file"]) & (row == gone["row"]), "left_anti")


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: the remaining documents as pieces of packed sequences; a null or empty text is one end id."""
    return pack(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_classifier", drop_poor),
    ("line_dedup", drop_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("packing", pack_tokens),
]

#: No stage of trained models, and no tokenizer, can be put in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage for the documents in sf_dir."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{scratch_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
