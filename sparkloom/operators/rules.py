"""Classification, routing and acceptance rules over payload tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.functions.scalars import box_contained


def first_match(text: Column, rules: list[tuple[str, str, float]], default: tuple[str, float]) -> Column:
    """struct(code, confidence) of the first (pattern, code, confidence) whose pattern the text matches."""
    pick = lambda code, conf: F.struct(F.lit(code).alias("code"), F.lit(conf).alias("confidence"))
    out = None
    for pattern, code, conf in rules:
        hit = text.rlike(pattern)
        out = F.when(hit, pick(code, conf)) if out is None else out.when(hit, pick(code, conf))
    return pick(*default) if out is None else out.otherwise(pick(*default))


def classify(df: DataFrame, key: str, caption: str, rules: list[tuple[str, str, float]], default: tuple[str, float], overrides: DataFrame | None = None) -> DataFrame:
    """key, code, confidence: a manual override by key first, then the rules over the caption."""
    found = df.select(key, first_match(F.lower(F.coalesce(F.col(caption), F.lit(""))), rules, default).alias("r"))
    if overrides is None:
        return found.select(key, "r.code", "r.confidence")
    o = overrides.select(key, F.col("code").alias("_code"))
    return found.join(o, key, "left").select(key, F.coalesce("_code", "r.code").alias("code"), F.when(F.col("_code").isNotNull(), 1.0).otherwise(F.col("r.confidence")).alias("confidence"))


def route(code: Column, table: dict[str, str], default: str) -> Column:
    entries = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.coalesce(F.element_at(entries, F.upper(F.trim(code))), F.lit(default))


def resolve_classification(tasks: DataFrame, records: DataFrame) -> DataFrame:
    """tasks(chunk_id, image_index, path, inline_code) with code: by (chunk, index), then by path, then the inline one."""
    norm = lambda c: F.lower(F.replace(F.col(c), F.lit("/"), F.lit("\\")))
    by_place = records.where("chunk_id IS NOT NULL").groupBy("chunk_id", "image_index").agg(F.min("code").alias("_a"))
    by_path = records.where("path IS NOT NULL").groupBy(norm("path").alias("_path")).agg(F.min("code").alias("_b"))
    return tasks.withColumn("_path", norm("path")).join(by_place, ["chunk_id", "image_index"], "left").join(by_path, "_path", "left").withColumn("code", F.coalesce("_a", "_b", "inline_code")).drop("_a", "_b", "_path")


def image_tasks(chunks: DataFrame) -> DataFrame:
    """chunk_id, image_index, path: a row for each path of an image chunk."""
    return chunks.select("chunk_id", F.posexplode("image_path").alias("image_index", "path"))


def skipped_by_kind(tasks: DataFrame, kind: str, allowed: list[str]) -> DataFrame:
    """All tasks, with status pending or skipped_kind: rows are traceable, none goes."""
    return tasks.withColumn("status", F.when(F.col(kind).isin(allowed), "pending").otherwise("skipped_kind"))


def refine_subtype(subtype: Column, cross_well: Column, panels: Column, repeated_headers: Column) -> Column:
    return F.when(cross_well, "2d").when((panels >= 2) & repeated_headers, "table").otherwise(subtype)


def payload_is(payload: Column, version: str, arrays: list[str]) -> Column:
    """Whether JSON text has the schema version and the named members as arrays."""
    ok = F.get_json_object(payload, "$.schema_version") == version
    for name in arrays:
        ok = ok & F.coalesce(F.get_json_object(payload, f"$.{name}").startswith("["), F.lit(False))
    return F.coalesce(ok, F.lit(False))


def coordinate_space(boxes: DataFrame, image: str, box: str, width: str, height: str, declared: str) -> DataFrame:
    """normalized_0_1000 if all values are at most 1000 and that was declared, or a box exceeds the image, or at
    least max(2, half) right edges lie at 1000; else pixels."""
    b = F.col(box)
    g = boxes.groupBy(image).agg(
        F.max(F.array_max(b)).alias("top"), F.bool_or((b[2] > F.col(width)) | (b[3] > F.col(height))).alias("over"),
        F.count_if(b[2] >= 1000).alias("at_edge"), F.count("*").alias("n"), F.bool_or(F.col(declared).startswith("normal")).alias("said"),
    )
    edge = F.col("at_edge") >= F.greatest(F.lit(2), F.col("n") / 2)
    return g.select(image, F.when((F.col("top") <= 1000) & (F.col("said") | F.col("over") | edge), "normalized_0_1000").otherwise("pixels").alias("space"))


def to_pixels(box: Column, width: Column, height: Column) -> Column:
    x = lambda v, m: F.round(v * m / 1000).cast("int")
    return F.array(x(box[0], width), x(box[1], height), x(box[2], width), x(box[3], height))


def normalise_entities(rows: DataFrame, group: list[str], pos: str) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejects with reason) of rows(id, name): missing ids and names, and later ones of an id, are rejected."""
    w = Window.partitionBy(*group, "id").orderBy(pos, "name")
    blank = lambda c: F.coalesce(F.trim(F.col(c)), F.lit("")) == ""
    marked = rows.withColumn("_n", F.row_number().over(w)).withColumn("reason", F.when(blank("id"), "missing_id").when(blank("name"), "missing_name").when(F.col("_n") > 1, "duplicate_id")).drop("_n")
    return marked.where("reason IS NULL").drop("reason"), marked.where("reason IS NOT NULL")


def explicitness(evidence: Column, kind: Column, explicit: Column) -> Column:
    """explicit, unless the evidence is body text alone, a cause without an arrow, or a time from cross-cutting."""
    e = F.lower(F.coalesce(evidence, F.lit("")))
    weak = F.contains(e, F.lit("body text")) | (kind.isin("causes", "controls") & ~F.contains(e, F.lit("arrow"))) | (kind.isin("before", "after") & F.contains(e, F.lit("cross-cut")))
    return explicit & ~weak


def label_lithology(labels: DataFrame, key: str, label: str, dictionary: DataFrame) -> DataFrame:
    """The lithology of highest priority that a unit's label names, with confidence .99."""
    from sparkloom.operators.joins import contained_terms

    found = contained_terms(labels.select(key, F.lower(label).alias("_label")), key, "_label", dictionary.withColumn("_word", F.col("term")), "_word", "term")
    named = found.join(dictionary.select(F.col("term").alias("_word"), "lithology", "priority"), "_word")
    return named.groupBy(key).agg(F.min_by("lithology", F.struct("priority", "_word")).alias("lithology")).withColumn("confidence", F.lit(0.99))


def first_reason(*gates: tuple[Column, str]) -> Column:
    """The name of the first gate that holds, else null."""
    out = None
    for cond, name in gates:
        out = F.when(cond, name) if out is None else out.when(cond, name)
    return out


def colour_gates(rows: DataFrame, group: list[str], allowed: list[str], threshold: float = 0.82) -> DataFrame:
    """candidates(lithology, confidence, pattern, in_scope, unresolved, pos) with the first gate that rejects them."""
    w = Window.partitionBy(*group, "lithology").orderBy("pos")
    earlier = F.count_if(F.col("_pre").isNull()).over(w.rowsBetween(Window.unboundedPreceding, -1))
    pre = first_reason(
        (~F.col("lithology").isin(allowed), "not_allowed"), (F.coalesce(F.trim("pattern"), F.lit("")) == "", "missing_pattern_evidence"),
        (~F.col("in_scope"), "outside_label_scope"), (F.col("unresolved"), "unresolved"), (F.col("confidence") < threshold, "low_confidence"),
    )
    marked = rows.withColumn("_pre", pre)
    return marked.withColumn("gate_reason", F.coalesce("_pre", F.when(earlier > 0, "duplicate"))).drop("_pre")


def surface_gates(vertical: DataFrame, lateral: DataFrame, parent: str, at_least: float = 0.9) -> DataFrame:
    """vertical regions (region_id, box) with a gate reason where a lateral one of the same parent contains them."""
    l = lateral.select(parent, F.col("box").alias("_l"))
    hit = vertical.join(l, parent).where(box_contained(F.col("box"), F.col("_l")) >= at_least).select("region_id").distinct().withColumn("gate_reason", F.lit("unresolved_surface_role_overlap"))
    return vertical.join(hit, "region_id", "left")


def layer_results(rows: DataFrame, group: list[str], allowed: list[str]) -> DataFrame:
    """rows(lithology, role, confidence, pos, conflict): the most confident of each allowed lithology at its first
    place, one primary only, context at most .85, conflicts at most .75."""
    best = rows.where(F.col("lithology").isin(allowed)).groupBy(*group, "lithology").agg(
        F.min("pos").alias("pos"), F.max("confidence").alias("confidence"), F.max_by("role", F.struct("confidence", -F.col("pos"), "role")).alias("role"), F.bool_or("conflict").alias("conflict")
    )
    w = Window.partitionBy(*group, "role").orderBy("pos", "lithology")
    role = F.when((F.col("role") == "primary") & (F.row_number().over(w) > 1), "secondary").otherwise(F.col("role"))
    capped = F.least(F.col("confidence"), F.when(F.col("conflict"), 0.75).when(F.col("role") == "context", 0.85).otherwise(1.0))
    return best.withColumn("role", role).withColumn("confidence", capped)


def complete_inventory(units: DataFrame, segments: DataFrame, group: list[str], most: int = 24) -> DataFrame:
    """Segments of known units, and one fallback segment for each unit without any; the first `most` by (unit, place)."""
    known = segments.join(units.select(*group, "unit_id", "unit_order"), [*group, "unit_id"])
    missing = units.join(segments.select(*group, "unit_id").distinct(), [*group, "unit_id"], "left_anti")
    fallback = missing.select(*group, "unit_id", F.concat(F.lit("fallback_"), "unit_id").alias("segment_id"), F.lit(0).alias("place"), "unit_order", F.lit(True).alias("fallback"))
    rows = known.select(*group, "unit_id", "segment_id", "place", "unit_order", F.lit(False).alias("fallback")).unionByName(fallback)
    w = Window.partitionBy(*group).orderBy("unit_order", "place", "segment_id")
    return rows.withColumn("ord", F.row_number().over(w)).where(F.col("ord") <= most)


def batches(df: DataFrame, group: list[str], order: list, size: int) -> DataFrame:
    """batch number (from 0) of rows in order, `size` rows each."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("batch", F.floor((F.row_number().over(w) - 1) / size).cast("int"))


def merge_segments(fields: DataFrame, key: str, wanted: list[str]) -> DataFrame:
    """fields(key, segment, field, value) merged; a field that several segments own, or a missing segment, is an error."""
    per = fields.groupBy(key, "field").agg(F.count_distinct("segment").alias("owners"), F.min("value").alias("value"))
    have = fields.groupBy(key).agg(F.array_sort(F.collect_set("segment")).alias("have"))
    return per.join(have, key).select(
        key, "field", "value",
        first_reason((F.col("owners") > 1, "several_owners"), (F.size(F.array_except(F.array(*[F.lit(x) for x in wanted]), F.col("have"))) > 0, "missing_segment")).alias("error"),
    )
