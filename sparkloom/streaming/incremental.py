"""Incremental work: streams of chunk files, resume from what is done, reuse of recorded calls."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.sources.scratch import shared_folder


def stream_files(spark: SparkSession, path: str, schema, files_per_batch: int = 1) -> DataFrame:
    """A stream of the Parquet files at a path."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def run_batches(stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None]) -> None:
    """Hand each micro-batch that is not yet done to `handle`, and stop when all there is has been done.

    The checkpoint tells which batches are done, so a second call does no work; `handle` must overwrite by its batch
    number to be safe against a batch that is run again.
    """
    query = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(handle).start()
    query.awaitTermination()


def process_available(spark: SparkSession, path: str, key: str, transform: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """transform() of the distinct keys of a streamed table: batches are written once each, then read as one table."""
    schema = spark.read.parquet(path).schema
    base = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"

    def handle(batch: DataFrame, number: int) -> None:
        batch.dropDuplicates([key]).write.mode("overwrite").parquet(f"{base}/out/batch={number}")

    # A file source lists a folder: a table of one file is picked by name from the folder that holds it.
    folder, _, name = path.rstrip("/").rpartition("/")
    single = spark.read.parquet(path).inputFiles()[0].endswith(f"/{name}")
    reader = spark.readStream.schema(schema)
    stream = reader.option("pathGlobFilter", name).parquet(folder) if single else reader.parquet(path)
    run_batches(stream, f"{base}/checkpoint", handle)
    done = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{base}/out")
    return transform(done.dropDuplicates([key]))


def windowed_counts(stream: DataFrame, time: str, group: list[str], length: str, late: str) -> DataFrame:
    """Counts in tumbling windows, final when the watermark has passed."""
    return stream.withWatermark(time, late).groupBy(F.window(time, length), *group).agg(F.count("*").alias("n"))


def reuse_calls(tasks: DataFrame, recorded: DataFrame, version: str) -> tuple[DataFrame, DataFrame]:
    """(tasks with the response recorded for the same task, prompt and version; tasks still to do)."""
    keyed = tasks.withColumn("prompt_sha1", F.sha1(F.col("prompt").cast("binary")))
    own = recorded.where(F.col("parser_version") == version).groupBy("task_id", "prompt_sha1").agg(F.max_by("response", "finished_at").alias("response"))
    return keyed.join(own, ["task_id", "prompt_sha1"]), keyed.join(own, ["task_id", "prompt_sha1"], "left_anti")
