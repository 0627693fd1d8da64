"""Aggregations: roll-ups, top-3 means, line fits, clusters, boxes, precedence merges."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.operators.lines import islands


def histograms(df: DataFrame, columns: list[str]) -> DataFrame:
    """dimension, value, n: the counts of each column's values, in one pass over the rows."""
    pairs = F.array(*[F.struct(F.lit(c).alias("dimension"), F.col(c).cast("string").alias("value")) for c in columns])
    return df.select(F.explode(pairs).alias("p")).groupBy("p.dimension", "p.value").agg(F.count("*").alias("n"))


def status_rollup(df: DataFrame, key: list[str], status: str) -> DataFrame:
    """completed if all are, skipped if all start with skipped, partial if some completed and some did not,
    model_error if any is an error, else not_implemented."""
    s = F.col(status)
    done, skipped = s == "completed", s.startswith("skipped")
    error = s.isin("error", "model_error", "failed")
    return df.groupBy(*key).agg(
        F.when(F.bool_and(done), "completed").when(F.bool_and(skipped), "skipped").when(F.bool_or(done), "partial")
        .when(F.bool_or(error), "model_error").otherwise("not_implemented").alias("status"),
        F.count_if(done).alias("n_completed"), F.count("*").alias("n"),
    )


def top_mean(df: DataFrame, key: list[str], score: str, tie: list, k: int = 3) -> DataFrame:
    """The mean of the k best scores of each group."""
    w = Window.partitionBy(*key).orderBy(F.desc(score), *tie)
    return df.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k).groupBy(*key).agg(F.avg(score).alias("score"), F.count("*").alias("n"))


def selection_confidence(top3_mean: Column, covered: Column, terms: Column, linked: Column, selected: Column) -> Column:
    """.65 of the mean of the best three, .20 of the covered share of terms, .15 of the linked share; from 0 to 1."""
    share = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), 0.65 * F.coalesce(top3_mean, F.lit(0.0)) + 0.20 * share(covered, terms) + 0.15 * share(linked, selected)))


def duplicates(df: DataFrame, key: list[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def fit_line(df: DataFrame, key: list[str], y: str, value: str, increases: str | None = None) -> DataFrame:
    """slope, intercept, rmse, n of value = slope * y + intercept, and an error where there is no valid fit."""
    fits = df.groupBy(*key).agg(
        F.count(F.when(F.col(y).isNotNull() & F.col(value).isNotNull(), 1)).alias("n"),
        F.regr_slope(value, y).alias("slope"), F.regr_intercept(value, y).alias("intercept"),
        F.regr_syy(value, y).alias("_syy"), F.regr_sxy(value, y).alias("_sxy"), F.regr_sxx(value, y).alias("_sxx"),
        *([F.first(increases).alias("_dir")] if increases else []),
    )
    residual = F.greatest(F.lit(0.0), F.col("_syy") - F.col("_sxy") * F.col("_sxy") / F.col("_sxx"))
    error = F.when(F.col("n") < 2, "too_few_points").when(F.col("_sxx") == 0, "same_position")
    if increases:
        error = error.when((F.col("_dir") == "down") & (F.col("slope") < 0), "direction").when((F.col("_dir") == "up") & (F.col("slope") > 0), "direction")
    return fits.withColumn("error", error).select(
        *key, "n", *[F.when(F.col("error").isNull(), c).alias(a) for c, a in ((F.col("slope"), "slope"), (F.col("intercept"), "intercept"), (F.sqrt(residual / F.col("n")), "rmse"))], "error"
    )


def cluster_1d(df: DataFrame, key: list[str], value: str, tolerance: float) -> DataFrame:
    """Groups of sorted values whose gaps do not exceed the tolerance: position (mean), support, first and last."""
    w = Window.partitionBy(*key).orderBy(value)
    rows = df.withColumn("_gap", F.col(value) - F.lag(value).over(w)).withColumn("_o", F.row_number().over(w))
    marked = islands(rows, key, "_o", F.col("_gap").isNull() | (F.col("_gap") > tolerance))
    return marked.groupBy(*key, F.col("island").alias("cluster")).agg(F.avg(value).alias("position"), F.count("*").alias("support"), F.min(value).alias("first"), F.max(value).alias("last"))


def union_box(df: DataFrame, key: list[str], x0: str, y0: str, x1: str, y1: str) -> DataFrame:
    return df.groupBy(*key).agg(F.min(x0).alias("x0"), F.min(y0).alias("y0"), F.max(x1).alias("x1"), F.max(y1).alias("y1"))


def dominant(df: DataFrame, key: list[str], area: str, cells: str, tie: str) -> DataFrame:
    """The row of largest area, then most cells, then smallest tie column."""
    w = Window.partitionBy(*key).orderBy(F.desc(area), F.desc(cells), tie)
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def colour_signature(pixels: DataFrame, key: list[str], most: int = 3, least_chroma: int = 24, least_share: float = 0.025, apart: float = 28.0) -> DataFrame:
    """Up to `most` dominant colours (r, g, b in 16 levels): chromatic and frequent ones first, none within `apart`
    of an earlier one. Pixels are counted before a group is folded, so a group has at most 4096 colours."""
    level = lambda c: (F.floor(F.col(c) / 16) * 16 + 8).cast("int").alias(c)
    counts = pixels.select(*key, level("r"), level("g"), level("b")).groupBy(*key, "r", "g", "b").agg(F.count("*").alias("n"))
    total = counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(*key)))
    chroma = F.greatest("r", "g", "b") - F.least("r", "g", "b")
    vivid = ((chroma >= least_chroma) & (F.col("share") >= least_share)).cast("int")
    rows = total.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct((-vivid).alias("v"), (-F.col("n")).alias("m"), "r", "g", "b", "share"))).alias("c"))
    near = lambda x, y: F.sqrt((x["r"] - y["r"]) ** 2 + (x["g"] - y["g"]) ** 2 + (x["b"] - y["b"]) ** 2) < apart
    fold = F.aggregate(
        "c", F.slice(F.col("c"), 1, 1),
        lambda acc, x: F.when((F.size(acc) < most) & ~F.exists(acc, lambda y: near(x, y)), F.array_append(acc, x)).otherwise(acc),
    )
    return rows.select(*key, F.transform(fold, lambda x: F.struct(x["r"].alias("r"), x["g"].alias("g"), x["b"].alias("b"), x["share"].alias("share"))).alias("colours"))


def quality_report(df: DataFrame) -> DataFrame:
    """doc_id, score, errors, passed of rows with n (characters) and lines: a weighted mean of three shares, which
    passes at .55 and more if no error holds."""
    filled, covered = F.least(F.lit(1.0), F.col("n") / 2000.0), F.least(F.lit(1.0), F.col("lines") / 10.0)
    placed = F.when(F.col("n") > 100, 1.0).otherwise(0.0)
    score = 0.35 * filled + 0.35 * covered + 0.30 * placed
    errors = F.concat_ws(",", F.when(F.col("n") < 50, "too_short"), F.when(F.col("lines") < 2, "single_line"))
    return df.select("doc_id", F.round(score, 6).alias("score"), errors.alias("errors"), ((score >= 0.55) & (errors == "")).alias("passed"))


def best_by_confidence(df: DataFrame, key: list[str], confidence: str, seq: str, values: list[str], union: list[str] = (), texts: list[str] = ()) -> DataFrame:
    """The values of the most confident row (the first one on a tie), the union of array columns and distinct texts."""
    best = F.struct(F.col(confidence), -F.col(seq))
    return df.groupBy(*key).agg(
        F.max(confidence).alias(confidence), *[F.max_by(v, best).alias(v) for v in values],
        *[F.array_sort(F.array_distinct(F.flatten(F.collect_list(u)))).alias(u) for u in union],
        *[F.array_join(F.array_sort(F.collect_set(t)), "; ").alias(t) for t in texts],
    )


def agreeing_reviews(a: DataFrame, b: DataFrame, key: list[str], names: str, confidence: str) -> DataFrame:
    """confidence is raised by .05 over the mean, .99 at most, where both reviews have the same set of names."""
    y = b.select(*key, F.col(names).alias("_names"), F.col(confidence).alias("_conf"))
    norm = lambda c: F.array_sort(F.array_distinct(F.col(c)))
    same = norm(names) == norm("_names")
    up = F.least(F.lit(0.99), (F.col(confidence) + F.col("_conf")) / 2 + 0.05)
    return a.join(y, key, "left").select(*key, names, F.when(same, up).otherwise(F.col(confidence)).alias(confidence), F.coalesce(same, F.lit(False)).alias("agreed"))


def better_inventory(rows: DataFrame, key: list[str], covered: str, segments: str, is_review: str, payload: str) -> DataFrame:
    """The payload that covers more, then has more segments; the review wins a tie."""
    return rows.groupBy(*key).agg(F.max_by(payload, F.struct(covered, segments, F.col(is_review).cast("int"))).alias(payload))


def first_filled(df: DataFrame, key: list[str], seq: str, columns: list[str]) -> DataFrame:
    """For each column, the first value that is neither null nor empty."""
    filled = lambda c: F.col(c).isNotNull() & (F.col(c).cast("string") != "")
    return df.groupBy(*key).agg(*[F.min_by(F.col(c), F.when(filled(c), F.col(seq))).alias(c) for c in columns])


def degrees(nodes: DataFrame, node: str, edges: DataFrame, source: str, target: str) -> DataFrame:
    """node, degree: 0 for isolated nodes."""
    ends = edges.select(F.explode(F.array(source, target)).alias(node)).groupBy(node).agg(F.count("*").alias("degree"))
    return nodes.select(node).distinct().join(ends, node, "left").select(node, F.coalesce("degree", F.lit(0)).alias("degree"))


def reference_rollup(df: DataFrame, key: list[str], seq: str, text: str, most: int = 20, chars: int = 600) -> DataFrame:
    """The first `most` distinct texts in order, each cut, joined by line ends."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct(seq, F.substring(F.col(text), 1, chars).alias("t")))), lambda x: x["t"])
    return df.where(F.trim(text) != "").groupBy(*key).agg(F.array_join(F.slice(F.array_distinct(ordered), 1, most), "\n").alias("references"))


def longest_monotone(points: DataFrame, key: list[str], pos: str, value: str, increases: str = "down") -> DataFrame:
    """The longest run of points, not necessarily adjacent, whose values rise (or fall) with pos; among equals the one
    of larger span. One axis's labels are one group, whose time grows by n log n: a tree over the ranks of the values holds
    the best run that ends at or below each."""

    def longest(k: tuple, df: pd.DataFrame) -> pd.DataFrame:
        df = df.drop_duplicates([pos, value]).sort_values([pos, value]).reset_index(drop=True)
        p, v = df[pos].tolist(), ((1 if increases == "down" else -1) * df[value]).tolist()
        rank = (np.unique(v, return_inverse=True)[1] + 1).tolist()
        size = max(rank, default=0)
        none = (0, 0.0, 0)  # length, less the first value, less the row
        tree, runs, before = [none] * (size + 1), [], []
        at = 0
        while at < len(p):
            end = at
            while end < len(p) and p[end] == p[at]:  # points of one place do not follow each other
                best, r = none, rank[end] - 1
                while r:
                    best = max(best, tree[r])
                    r &= r - 1
                runs.append((best[0] + 1, best[1] if best[0] else -v[end], -end))
                before.append(-best[2] if best[0] else None)
                end += 1
            for i in range(at, end):
                r = rank[i]
                while r <= size:
                    tree[r] = max(tree[r], runs[i])
                    r += r & -r
            at = end
        chain = []
        i = max(range(len(p)), key=lambda i: (runs[i][0], v[i] + runs[i][1]), default=None)
        while i is not None:
            chain.append(i)
            i = before[i]
        return df.iloc[chain[::-1]]

    return points.groupBy(*key).applyInPandas(longest, points.schema)


def suppress_boxes(boxes: DataFrame, key: list[str], score: str, tie: str, at_least: float = 0.65) -> DataFrame:
    """Boxes (x0, y0, x1, y1) by falling score, without those of which a better one covers `at_least` of the smaller
    area. The boxes of one image are one group; each box that is kept is held against those left, in one array step."""

    def keep(k: tuple, df: pd.DataFrame) -> pd.DataFrame:
        df = df.sort_values([score, tie], ascending=[False, True]).reset_index(drop=True)
        x0, y0, x1, y1 = (df[c].to_numpy(float) for c in ("x0", "y0", "x1", "y1"))
        area = (x1 - x0).clip(0) * (y1 - y0).clip(0)
        left, kept = np.arange(len(df)), []
        while len(left):
            i, left = left[0], left[1:]
            kept.append(i)
            w = np.minimum(x1[i], x1[left]) - np.maximum(x0[i], x0[left])
            h = np.minimum(y1[i], y1[left]) - np.maximum(y0[i], y0[left])
            least = np.minimum(area[i], area[left])
            over = (w > 0) & (h > 0) & (least > 0)
            share = np.divide(w * h, least, out=np.zeros(len(left)), where=over)
            left = left[~(over & (share >= at_least))]
        return df.iloc[kept]

    return boxes.groupBy(*key).applyInPandas(keep, boxes.schema)
