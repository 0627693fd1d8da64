"""Parquet tables of a data folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def epoch(column: str, unit: str = "SECOND") -> Column:
    """Whole units since 1970 of a timestamp without a zone, whatever the session's zone is."""
    return F.expr(f"timestampdiff({unit}, TIMESTAMP_NTZ'1970-01-01 00:00:00', {column})")
