"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import drop_materialized, join_counted, materialize


def _stars(pairs: DataFrame, larger_only: bool) -> tuple[DataFrame, DataFrame]:
    """Link each node's neighbours (larger_only: those above it) to the smallest of them and itself; also the table of these."""
    low = materialize(pairs.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n"), "star-low")
    joined = join_counted(pairs, low, "u", "n")
    if larger_only:
        joined = joined.where("v > u")
    else:
        joined = joined.unionByName(low.select("u", F.col("u").alias("v"), "m").select(*joined.columns))
    return joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), low


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): the smallest node that can be reached, for each node that has an edge to another one.

    Each round writes its edges to the shared folder; the number of rounds grows with the logarithm of the number
    of nodes. The smallest neighbours are counted before they are shuffled, and a node of very many edges has its
    smallest neighbour broadcast to them, so that it is no single task's work.
    """
    now = materialize(
        edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges"
    )
    seen = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or state[0] == 0:
            break
        seen = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        star, low = _stars(both, larger_only=True)
        large = materialize(star, "large-star")
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        star, low_down = _stars(down, larger_only=False)
        small = materialize(star, "small-star")
        drop_materialized(now, large, low, low_down)
        now = small
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root"))
    ).distinct()
