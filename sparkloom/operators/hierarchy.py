"""Trees as tables: heights, paths, bottom-up folds, adjacency and order."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.sources.scratch import store


def levels(nodes: DataFrame, key: list[str], node: str, parent: str, most: int = 64) -> DataFrame:
    """nodes with height: 0 for a leaf, else 1 over its highest child.

    A round joins the nodes that grew in the round before to their parents; there are as many as the tree is deep.
    """
    tree = store(nodes.select(*key, node, parent))
    front = store(tree.join(tree.select(*key, F.col(parent).alias(node)).distinct(), [*key, node], "left_anti").withColumn("height", F.lit(0)))
    found = front
    for h in range(1, most + 1):
        up = front.where(F.col(parent).isNotNull()).select(*key, F.col(parent).alias(node)).distinct()
        front = store(tree.join(up, [*key, node], "left_semi").withColumn("height", F.lit(h)))
        if not front.head(1):
            highest = found.groupBy(*key, node).agg(F.max("height").alias("height"))
            return nodes.join(highest, [*key, node]).select(*nodes.columns, "height")
        found = found.unionByName(front)
    raise ValueError("the tree is deeper than expected, or has a cycle")


def paths(nodes: DataFrame, key: list[str], node: str, parent: str, order: str, most: int = 64) -> DataFrame:
    """nodes with sort_path, the orders from the root down: sorting by it walks the tree depth first."""
    roots = nodes.where(F.col(parent).isNull()).withColumn("sort_path", F.array(F.col(order).cast("long")))
    out, front = roots, roots
    for _ in range(most):
        above = front.select(*key, F.col(node).alias(parent), F.col("sort_path").alias("_p"))
        front = store(nodes.join(above, [*key, parent]).select(*nodes.columns, F.array_append("_p", F.col(order).cast("long")).alias("sort_path")))
        if not front.head(1):
            return out
        out = out.unionByName(front)
    raise ValueError("the tree is deeper than expected, or has a cycle")


def bottom_up(nodes: DataFrame, key: list[str], node: str, parent: str, order: str, leaf: Column, combine: Callable[[Column, Column], Column], empty: str) -> DataFrame:
    """summary of each node: combine(own text, ordered child summaries), one join for each height.

    A node without own text and children gets `empty`, and combine is not asked.
    """
    rows = store(levels(nodes, key, node, parent))
    top = rows.agg(F.max("height")).first()[0]
    if top is None:
        return rows.withColumn("summary", F.lit(None).cast("string"))
    done = rows.where("height = 0").withColumn("summary", F.when(F.coalesce(leaf, F.lit("")) == "", F.lit(empty)).otherwise(combine(leaf, F.array().cast("array<string>"))))
    for h in range(1, top + 1):
        kids = done.where(F.col(parent).isNotNull()).groupBy(*key, F.col(parent).alias(node)).agg(
            F.transform(F.array_sort(F.collect_list(F.struct(order, "summary"))), lambda x: x["summary"]).alias("_kids")
        )
        now = rows.where(F.col("height") == h).join(kids, [*key, node], "left")
        now = now.withColumn("summary", combine(leaf, F.coalesce("_kids", F.array().cast("array<string>")))).drop("_kids")
        done = done.unionByName(store(now))
    return done


def rollup_totals(nodes: DataFrame, node: str, parent: str, value: str, most: int = 64) -> DataFrame:
    """node and total: its own value and those of all below it."""
    total = nodes.select(node, F.col(value).alias("v"), F.col(parent).alias("up"))
    carried = total.select(F.col(node).alias("to"), "v")
    front = total.where("up IS NOT NULL").select(F.col("up").alias("to"), "v")
    links = nodes.select(F.col(node).alias("to"), F.col(parent).alias("up"))
    for _ in range(most):
        front = store(front.groupBy("to").agg(F.sum("v").alias("v")))
        if not front.head(1):
            return carried.groupBy(F.col("to").alias(node)).agg(F.sum("v").alias("total"))
        carried = carried.unionByName(front)
        front = front.join(links, "to").where("up IS NOT NULL").select(F.col("up").alias("to"), "v")
    raise ValueError("the tree is deeper than expected, or has a cycle")


def adjacent_pairs(df: DataFrame, key: list[str], order: str, node: str) -> DataFrame:
    """upper, lower of rows that follow each other; an order that several rows share is skipped, and not bridged."""
    same = Window.partitionBy(*key, order)
    w = Window.partitionBy(*key).orderBy(order, node)
    rows = df.withColumn("_n", F.count("*").over(same)).withColumn("_next", F.lead(node).over(w)).withColumn("_next_n", F.lead("_n").over(w))
    return rows.where("_n = 1 AND _next_n = 1").select(*key, F.col(node).alias("lower"), F.col("_next").alias("upper"))


def fill_down(df: DataFrame, key: list[str], order: list, column: str) -> DataFrame:
    """Empty cells take the last value above them; those before the first value take that one."""
    w = Window.partitionBy(*key).orderBy(*order)
    value = F.when(F.col(column).cast("string") != "", F.col(column))
    above = F.last(value, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    below = F.first(value, ignorenulls=True).over(w.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    return df.withColumn(f"{column}_filled", F.coalesce(above, below))


def inferred_order(entities: DataFrame, key: list[str], node: str, position: str) -> DataFrame:
    """The nodes of each group by position, for groups of two or more whose positions are all set and different."""
    return entities.groupBy(*key).agg(
        F.transform(F.array_sort(F.collect_list(F.struct(position, node))), lambda x: x[node]).alias("members"),
        F.count("*").alias("n"), F.count_distinct(position).alias("_d"),
    ).where("n >= 2 AND n = _d").drop("_d")


def tracks(edges: DataFrame, image: str, position: str, least_support: int, least_width: float) -> DataFrame:
    """Consecutive pairs of supported edges at least `least_width` apart: track_no, x0, x1."""
    w = Window.partitionBy(image).orderBy(position)
    pairs = edges.where(F.col("support") >= least_support).withColumn("x1", F.lead(position).over(w))
    kept = pairs.where(F.col("x1") - F.col(position) >= least_width)
    return kept.select(image, F.col(position).alias("x0"), "x1", F.row_number().over(w).alias("track_no"))


def track_headers(track: DataFrame, ocr: DataFrame, image: str, top: float) -> DataFrame:
    """The texts over a track's head, from left to right."""
    inside = track.join(ocr.where(F.col("y") <= top), image).where((F.col("x") >= F.col("x0")) & (F.col("x") < F.col("x1")))
    text = inside.groupBy(image, "track_no").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("y", "x", "text"))), lambda x: x["text"]), " ").alias("header"))
    return track.join(text, [image, "track_no"], "left")
