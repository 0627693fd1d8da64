"""Measured geometry of figures: replacing model boxes, rule lines, depth alignment, ordered corrections."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.functions.scalars import overlap_ratio
from sparkloom.operators.joins import first_containing, overlapping


def apply_geometry(primitives: DataFrame, measured: DataFrame, image: str) -> tuple[DataFrame, DataFrame]:
    """(primitives(image, primitive_id, refs) with the union of the measured boxes their refs name; uncertainties).

    A primitive none of whose refs was measured is left out and noted.
    """
    refs = primitives.select(image, "primitive_id", F.explode_outer("refs").alias("ref"))
    boxes = refs.join(measured.select(image, "ref", "box"), [image, "ref"]).groupBy(image, "primitive_id").agg(
        F.array(*[f(F.col("box")[k]) for k, f in enumerate((F.min, F.min, F.max, F.max))]).alias("box")
    )
    notes = primitives.join(boxes, [image, "primitive_id"], "left_anti").select(image, "primitive_id", F.lit("unresolved_geometry").alias("note"))
    return primitives.join(boxes, [image, "primitive_id"]), notes


def rule_lines(images: DataFrame, key: str, pixels: str, width: str, height: str, dark: int = 96, rows_at: float = 0.45, columns_at: float = 0.55) -> DataFrame:
    """key, axis, position: pixel rows and columns whose share of dark pixels reaches a threshold, adjacent ones as
    their middle. pixels holds the grey values row by row; an image whose size does not fit them has no lines."""
    kind = images.schema[key].dataType.simpleString()

    def middles(hit: np.ndarray) -> list[int]:
        at = np.flatnonzero(hit)
        if not len(at):
            return []
        return [int(round(float(g.mean()))) for g in np.split(at, np.flatnonzero(np.diff(at) > 1) + 1)]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in frames:
            out = []
            for k, data, w, h in zip(df[key], df[pixels], df[width], df[height]):
                if data is None or len(data) != w * h or not w * h:
                    continue
                black = np.frombuffer(bytes(data), np.uint8).reshape(int(h), int(w)) < dark
                out += [(k, "row", p) for p in middles(black.mean(axis=1) >= rows_at)]
                out += [(k, "column", p) for p in middles(black.mean(axis=0) >= columns_at)]
            yield pd.DataFrame(out, columns=[key, "axis", "position"])

    return images.select(key, pixels, width, height).mapInPandas(run, f"{key} {kind}, axis string, position int")


def depth_alignment(features: DataFrame, units: DataFrame, image: str, width: float = 50.0, at_least: float = 0.15) -> DataFrame:
    """features(image, feature_id, top, bottom) with the units(image, unit_id, parent_id, top, bottom) they overlap by
    `at_least`; a unit goes where one of its direct children matches the same feature."""
    u = units.select(image, "unit_id", "parent_id", F.col("top").alias("u_top"), F.col("bottom").alias("u_bottom"))
    hit = overlapping(features, u, [image], "top", "bottom", "u_top", "u_bottom", width).withColumn("overlap", overlap_ratio("top", "bottom", "u_top", "u_bottom")).where(F.col("overlap") >= at_least)
    children = hit.where("parent_id IS NOT NULL").select(image, "feature_id", F.col("parent_id").alias("unit_id")).distinct()
    return hit.join(children, [image, "feature_id", "unit_id"], "left_anti").select(image, "feature_id", "unit_id", "overlap")


def marker_alignment(markers: DataFrame, reservoirs: DataFrame, units: DataFrame, image: str, width: float = 50.0) -> DataFrame:
    """markers(image, marker_id, value) with the first reservoir that holds the value, else the first unit."""
    spans = reservoirs.select(image, F.lit(0).alias("rank"), "pos", F.col("id").alias("target"), "top", "bottom").unionByName(units.select(image, F.lit(1).alias("rank"), "pos", F.col("id").alias("target"), "top", "bottom"))
    return first_containing(markers, spans, [image], ["marker_id"], "value", "top", "bottom", ["rank", "pos"], width).select(image, "marker_id", "target")


def corrected(segments: DataFrame, instructions: DataFrame, group: str) -> DataFrame:
    """segments(group, lithology, role, confidence) after the ordered instructions(group, seq, action, lithology, value):
    remove, replace (by value), add (role value, once) and change_role. Later instructions see earlier results, so a
    group is folded as one; a figure bounds its size. Unknown actions and missing lithologies change nothing."""
    kind = segments.schema[group].dataType.simpleString()

    def fold(key: tuple, rows: pd.DataFrame, steps: pd.DataFrame) -> pd.DataFrame:
        state = {r.lithology: (r.role, r.confidence) for r in rows.itertuples()}
        for s in steps.sort_values("seq").itertuples():
            if s.action == "remove":
                state.pop(s.lithology, None)
            elif s.action == "replace" and s.lithology in state and s.value:
                state = {(s.value if k == s.lithology else k): v for k, v in state.items()}
            elif s.action == "add":
                state.setdefault(s.lithology, (s.value or "secondary", 0.7))
            elif s.action == "change_role" and s.lithology in state:
                state[s.lithology] = (s.value, state[s.lithology][1])
        return pd.DataFrame([(key[0], k, *v) for k, v in state.items()], columns=[group, "lithology", "role", "confidence"])

    return segments.groupBy(group).cogroup(instructions.groupBy(group)).applyInPandas(fold, f"{group} {kind}, lithology string, role string, confidence double")


def captioned_image_tables(lines: DataFrame, key: str, is_table: str, most: int = 12) -> DataFrame:
    """key, table_no, caption, paths: after a caption line that names a table, the first image within `most` non-blank
    lines starts a table; images that follow at once are further parts while the detector's column says so."""
    kind = lines.schema[key].dataType.simpleString()

    def scan(k: tuple, df: pd.DataFrame) -> pd.DataFrame:
        import re

        out: list[list] = []
        caption, left, open_ = None, 0, False
        for r in df.sort_values("pos").itertuples():
            line = r.line.strip()
            image = re.fullmatch(r"!\[[^\]]*\]\(([^)]+)\)", line)
            if not line:
                continue
            if re.match(r"(?i)(?:表|table)\s*\d", line):
                caption, left, open_ = line, most, False
            elif image and caption is not None and left > 0:
                out.append([caption, [image[1]]])
                caption, open_ = None, True
            elif image and open_ and getattr(r, is_table):
                out[-1][1].append(image[1])
            else:
                left, open_ = left - 1, False
        return pd.DataFrame([(k[0], n, c, p) for n, (c, p) in enumerate(out, 1)], columns=[key, "table_no", "caption", "paths"])

    return lines.groupBy(key).applyInPandas(scan, f"{key} {kind}, table_no int, caption string, paths array<string>")


def headings(lines: DataFrame, key: str) -> DataFrame:
    """key, pos, section_id, level, title, parent_id: numbered headings by their parts, `(n)` ones as children of the
    section before them, others by their marks with a slug for an id. One document's headings are one group."""
    kind = lines.schema[key].dataType.simpleString()

    def parse(k: tuple, df: pd.DataFrame) -> pd.DataFrame:
        import re

        out, stack, counts = [], [], {}
        for r in df.sort_values("pos").itertuples():
            m = re.match(r"\s{0,3}(#{1,6})\s+(.*?)\s*#*\s*$", r.line)
            if not m or not m[2]:
                continue
            title = m[2]
            nested, dotted = re.match(r"[(（](\d+)[)）]\s*(.*)", title), re.match(r"(\d+(?:\.\d+)*)[.、]?\s+(.*)", title)
            if nested and stack:
                base = next((s for s in reversed(stack) if not s[2]), stack[-1])
                level, sid = base[1] + 1, f"{base[0]}.({nested[1]})"
            elif dotted:
                level, sid = len(dotted[1].split(".")) + 1, dotted[1]
            else:
                level, sid = len(m[1]), re.sub(r"\W+", "-", title.lower()).strip("-") or "section"
            counts[sid] = counts.get(sid, 0) + 1
            sid = sid if counts[sid] == 1 else f"{sid}-{counts[sid]}"
            while stack and stack[-1][1] >= level:
                stack.pop()
            out.append((k[0], r.pos, sid, level, title, stack[-1][0] if stack else None))
            stack.append((sid, level, bool(nested)))
        return pd.DataFrame(out, columns=[key, "pos", "section_id", "level", "title", "parent_id"])

    return lines.groupBy(key).applyInPandas(parse, f"{key} {kind}, pos int, section_id string, level int, title string, parent_id string")


def enrich_nodes(nodes: DataFrame, enrichment: DataFrame, key: str) -> DataFrame:
    """nodes with official names from enrichment, and an error for unknown, duplicate and missing ids."""
    e = enrichment.groupBy(key).agg(F.min("official_name").alias("_new"), F.count("*").alias("_n"))
    out = nodes.withColumn("_known", F.lit(True)).join(e, key, "full_outer")
    error = F.when(F.col("_known").isNull(), "unknown_id").when(F.col("_n") > 1, "duplicate_id").when(F.col("_n").isNull(), "missing_id")
    return out.withColumn("official_name", F.coalesce("_new", "official_name")).withColumn("error", error).drop("_new", "_n", "_known")


def axis_points(labels: DataFrame, image: str) -> DataFrame:
    """labels(image, text, y) as numeric axis points; texts that are no numbers go."""
    from sparkloom.functions.scalars import full_width_number

    return labels.withColumn("value", full_width_number("text")).where("value IS NOT NULL").select(image, "y", "value")


def group_columns(rows: DataFrame, key: str, order: str, columns: list[str], prefix: str) -> DataFrame:
    """Empty cells of group columns filled from above among rows whose record key has the same prefix, the first
    value also upwards."""
    from sparkloom.operators.hierarchy import fill_down

    out = rows.withColumn("_prefix", F.regexp_extract(prefix, r"^([^\d]+)", 1))
    for c in columns:
        out = fill_down(out, [key, "_prefix"], [order], c).drop(c).withColumnRenamed(f"{c}_filled", c)
    return out.drop("_prefix").select(*rows.columns)


def repaired_headers(candidates: DataFrame, key: str) -> DataFrame:
    """key, col, term: the best scored candidate term of each column, the longer one on a tie."""
    w = Window.partitionBy(key, "col").orderBy(F.desc("score"), F.desc(F.length("term")), "term")
    return candidates.withColumn("_r", F.row_number().over(w)).where("_r = 1").select(key, "col", "term")


def response_table(path_rows: list[tuple[str, dict]]) -> list[tuple[str, str]]:
    """(name, JSON text) rows of recorded responses."""
    return [(name, json.dumps(value, ensure_ascii=False, sort_keys=True)) for name, value in path_rows]
