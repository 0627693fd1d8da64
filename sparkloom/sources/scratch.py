"""Intermediate tables of iterative operators."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Temporary folders of local sessions without spark.checkpoint.dir, by application.
_OWN: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir; a temporary folder, gone when Python ends, in a local session without it alone."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = tempfile.mkdtemp(prefix="sparkloom-")
        atexit.register(shutil.rmtree, _OWN[app], True)
    return _OWN[app]


def store(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read back: a round's plan does not hold the rounds before it.

    The files go when the driver's JVM ends, or by drop() once nothing reads them.
    """
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/step-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    found = spark.read.schema(df.schema).parquet(folder)
    found._folder = folder
    return found


def drop(*tables: DataFrame) -> None:
    """Remove the files of tables that store() returned."""
    for df in tables:
        spark = df.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df._folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
