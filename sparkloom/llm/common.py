"""Helpers that the training-data operators share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Temporary folders of local sessions without spark.checkpoint.dir, by application.
_OWN: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: spark.checkpoint.dir of the session.

    Only a local master without that setting gets a temporary folder, which goes when Python ends; a cluster without
    it is an error, as its executors would write where the others cannot read.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = tempfile.mkdtemp(prefix="sparkloom-")
        atexit.register(shutil.rmtree, _OWN[app], True)
    return _OWN[app]


def _file_system(spark: SparkSession, folder: str) -> tuple:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder and read it back, so that a lost executor never restarts the lineage above it.

    The files go when the driver's JVM ends, unless drop_materialized() takes them before.
    """
    spark = df.sparkSession
    folder = f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    system, path = _file_system(spark, folder)
    system.deleteOnExit(path)
    found = spark.read.schema(df.schema).parquet(folder)
    found._folder = folder
    return found


def drop_materialized(*tables: DataFrame) -> None:
    """Remove the files behind DataFrames that materialize() returned and that nothing reads any more."""
    for df in tables:
        system, path = _file_system(df.sparkSession, df._folder)
        system.delete(path, True)


#: A key with more rows than this is broadcast to them instead of being shuffled to one task.
HEAVY = 50_000


def join_counted(rows: DataFrame, side: DataFrame, key: str, n: str, heavy: int | None = None) -> DataFrame:
    """rows joined to side on key, where side has a row for each key and in n how many of rows have it.

    Keys of more than `heavy` rows, of which there are less than 1 / heavy of the number of rows, are broadcast, so their
    rows stay where they are; the others are joined by a shuffle. side should be a stored table: it is read up to four times.
    """
    heavy = HEAVY if heavy is None else heavy
    hot = side.where(F.col(n) > heavy)
    if not hot.head(1):
        return rows.join(side.drop(n), key)
    usual = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(side.where(F.col(n) <= heavy).drop(n), key)
    return usual.unionByName(rows.join(F.broadcast(hot.drop(n)), key))


def bounded_batches(spark: SparkSession, rows: int = 512) -> None:
    """Keep Arrow batches small: texts may be very long, and a batch is held whole by the JVM and by Python."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def id_crc(doc_id: Column | str) -> Column:
    """CRC-32 of the id as text; a null id counts as the empty string."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary"))


def one_label(labels: DataFrame, name: str) -> DataFrame:
    """(doc_id, y): one label for each id; null labels and ids do not count, of conflicting ones the larger counts."""
    rows = labels.select("doc_id", F.col(name).cast("int").alias("y")).where("doc_id IS NOT NULL AND y IN (0, 1)")
    return rows.groupBy("doc_id").agg(F.max("y").alias("y"))


def thinned(text: Column, most: int, pieces: int = 16) -> Column:
    """The text if it has at most `most` code points, else that many in evenly spread pieces, a line each."""
    n, size = F.char_length(text), most // pieces
    spread = [F.substring(text, F.floor((n - size) * (k / (pieces - 1))).cast("int") + 1, F.lit(size)) for k in range(pieces)]
    return F.when(n <= most, text).otherwise(F.concat_ws("\n", *spread))


def labelled_sample(docs: DataFrame, labels: DataFrame, per_class: tuple[int, int], max_chars: int, seed: int = 11) -> list[tuple[str, int]]:
    """At most per_class[y] (text, y) pairs of each class y, from labelled rows of docs; empty texts are left out.

    The ids that docs has are drawn first, by hash order, so that only sum(per_class) ids are broadcast and as many texts
    collected. Of a longer text the driver receives max_chars code points, from all of its parts.
    """
    y = labels.join(docs.select("doc_id"), "doc_id", "left_semi").withColumn("h", F.xxhash64("doc_id", F.lit(seed)))
    picked = None
    for value in (0, 1):
        part = y.where(F.col("y") == value).orderBy("h", "doc_id").limit(per_class[value])
        picked = part if picked is None else picked.unionByName(part)
    found = (
        docs.select("doc_id", "text")
        .where(F.octet_length("text") > 0)
        .join(F.broadcast(picked.select("doc_id", "y", "h")), "doc_id")
        .select("doc_id", thinned(F.col("text"), max_chars).alias("text"), "y", "h")
        .groupBy("doc_id").agg(F.min("text").alias("text"), F.min("y").alias("y"), F.min("h").alias("h"))
        .orderBy("h", "doc_id")
    )
    return [(r["text"], r["y"]) for r in found.collect()]
