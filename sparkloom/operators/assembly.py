"""Whole results put together from the single operators: parsed documents, table, process and profile graphs, runs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.functions.scalars import clamp_confidence, clean_name, stable_id, value_at
from sparkloom.operators import aggregates as A
from sparkloom.operators import geometry as Y
from sparkloom.operators import hierarchy as H
from sparkloom.operators import lines as L


def parse_documents(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, title, section_no, level, heading, parent_no, body: a document's sections with its title on each.

    A document without sections has no rows; line ends are made equal first.
    """
    plain = docs.select(key, L.normalize_newlines(F.col(text)).alias(text))
    rows = L.explode_lines(plain, key, text)
    found = L.section_parents(L.sections(rows, key), key)
    return found.join(L.titles(rows, key).select(key, "title"), key).select(key, "title", "section_no", "level", "heading", "parent_no", "body")


def section_assets(sections: DataFrame, key: list[str], body: str) -> tuple[DataFrame, DataFrame]:
    """(key..., kind, asset_no, content) for the tables, formulas and images of each section, numbered within; (key..., content)
    with the sections' texts without them."""
    forms = {"table": r"(?is)(<table\b.*?</table>)", "formula": r"(?s)(\$\$.+?\$\$)", "image": r"(!\[[^\]]*\]\([^)]+\))"}
    each = [sections.select(*key, F.lit(kind).alias("kind"), F.posexplode(F.regexp_extract_all(F.col(body), F.lit(p), F.lit(1))).alias("_i", "content")) for kind, p in forms.items()]
    assets = reduce(DataFrame.unionByName, each).select(*key, "kind", (F.col("_i") + 1).alias("asset_no"), "content")
    rest = F.col(body)
    for p in forms.values():
        rest = F.regexp_replace(rest, p, "")
    return assets, sections.select(*key, F.trim(F.regexp_replace(rest, r"\n\s*\n+", "\n")).alias("content"))


def cell_provenance(image: Column, table: Column, row: Column | None = None, col: Column | None = None, text: Column | None = None) -> Column:
    """Where a value is from: image | table=... and, of a cell, row=a-a,col=b-b and its text."""
    parts = [image, F.concat(F.lit("table="), table)]
    if row is not None:
        r, c = row.cast("string"), col.cast("string")
        parts += [F.concat(F.lit("row="), r, F.lit("-"), r, F.lit(",col="), c, F.lit("-"), c), text]
    return F.concat_ws(" | ", *parts)


#: How a table is linked to a subject of a type (fixed values).
TABLE_RELATION = {
    "Sample": "REPORTS", "Experiment": "REPORTS", "AnalyticalMethod": "REPORTS", "Lithology": "DESCRIBES", "Reservoir": "DESCRIBES",
    "ReservoirInterval": "DESCRIBES", "Formation": "DESCRIBES", "StratigraphicMember": "DESCRIBES",
}
CONTEXT_TYPES = ["Well", "Formation", "StratigraphicMember", "ReservoirInterval", "Lithology"]


def domain_graph(cells: DataFrame, plans: DataFrame, columns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entities (entity_id, type, name) and relations (source, type, target) of tables whose records have a subject.

    cells: document_id, table_id, row, col, text; plans: table_id, subject_type, subject_col, data_start_row; columns:
    table_id, col, context_type, mineral (null where a header names none). A record's subject is the cleaned text of
    its subject column. Samples are linked to the contexts of their row, lithologies of a row to the minerals whose cell is not
    empty, and the table to its subjects by TABLE_RELATION.
    """
    named = cells.where(clean_name("text") != "").join(plans, "table_id").where(F.col("row") >= F.col("data_start_row"))
    rows = named.select("document_id", "table_id", "subject_type", "subject_col", "row", "col", clean_name("text").alias("name"))
    entity = lambda kind, name: stable_id("domain", "document_id", kind, name)
    subjects = rows.where((F.col("col") == F.col("subject_col")) & (F.col("subject_type") != "TableRow")).select(
        "document_id", "table_id", "row", F.col("subject_type").alias("type"), "name", entity("subject_type", "name").alias("id")
    )
    other = rows.where("col <> subject_col").join(columns, ["table_id", "col"])
    contexts = other.where((F.col("subject_type") == "Sample") & F.col("context_type").isin(CONTEXT_TYPES)).select(
        "document_id", "table_id", "row", F.col("context_type").alias("type"), "name", entity("context_type", "name").alias("id")
    )
    rocks = subjects.unionByName(contexts).where("type = 'Lithology'").select("table_id", "row", F.col("id").alias("rock"))
    minerals = other.where("mineral IS NOT NULL").join(rocks, ["table_id", "row"]).select("rock", F.col("mineral").alias("name"), stable_id("mineral", "mineral").alias("id"))
    table = stable_id("tbl", "table_id")
    kinds = F.create_map(*[F.lit(x) for kv in TABLE_RELATION.items() for x in kv])
    link = lambda df, s, k, t: df.select(s.alias("source"), k.alias("type"), t.alias("target"))
    pair = subjects.select("table_id", "row", F.col("id").alias("subject")).join(contexts.select("table_id", "row", "id", "type"), ["table_id", "row"])
    relations = [
        link(subjects, table, F.element_at(kinds, F.col("type")), F.col("id")).where("type IS NOT NULL"),
        link(subjects.where("type = 'Sample'"), F.col("id"), F.lit("RECORDED_IN"), table),
        link(pair, F.col("subject"), F.lit("COLLECTED_FROM"), F.col("id")),
        link(pair.where("type <> 'Well'"), table, F.lit("DESCRIBES"), F.col("id")),
        link(minerals, F.col("rock"), F.lit("COMPOSED_OF"), F.col("id")),
    ]
    found = subjects.unionByName(contexts).select(F.col("id").alias("entity_id"), "type", "name").unionByName(minerals.select(F.col("id").alias("entity_id"), F.lit("Mineral").alias("type"), "name"))
    return found.groupBy("entity_id").agg(F.min("type").alias("type"), F.min("name").alias("name")), reduce(DataFrame.unionByName, relations).distinct()


def table_run(tables: DataFrame, quality: DataFrame, graphs: DataFrame, key: str) -> DataFrame:
    """key, status, n_entities: failed for a table that gave no cells, manual_review if its quality does not pass, else
    success. No table's failure ends the run."""
    q = quality.select(key, F.col("passed").alias("_passed"))
    n = graphs.groupBy(key).agg(F.count("*").alias("n_entities"))
    status = F.when(F.col("_passed").isNull(), "failed").when(F.col("_passed"), "success").otherwise("manual_review")
    return tables.select(key).join(q, key, "left").join(n, key, "left").select(key, status.alias("status"), F.coalesce("n_entities", F.lit(0)).alias("n_entities"))


def process_graph(parts: list[DataFrame], relations: list[DataFrame], group: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(entities, relations, dropped) from ordered passes of candidates.

    parts: (group, local_id, name, type, pos) in order of their pass; of candidates that share a local id or a name with an
    earlier one, the earlier one's id counts, so each later alias leads to it. relations: (group, source, type, target,
    pos), whose ends are local ids or names; the first of equal (source, type, target) counts, and one with an end
    that nothing resolves, or with equal ends, is dropped with a reason.
    """
    tagged = reduce(DataFrame.unionByName, [p.withColumn("pass_no", F.lit(k)) for k, p in enumerate(parts)])
    rows = tagged.select(group, F.trim("local_id").alias("local_id"), F.coalesce(F.nullif(F.trim("name"), F.lit("")), F.trim("local_id")).alias("name"), "type", "pass_no", "pos")
    at = F.struct("pass_no", "pos", "local_id")
    by_id = rows.groupBy(group, "local_id").agg(F.min(at).alias("_a"))
    by_name = rows.groupBy(group, "name").agg(F.min(at).alias("_b"))
    first = rows.join(by_id, [group, "local_id"]).join(by_name, [group, "name"]).withColumn("_first", F.least("_a", "_b"))
    own = first.where(F.col("_first") == at).select(group, F.col("local_id").alias("_owner"), stable_id("entity", group, "local_id").alias("entity_id"), "name", "type")
    owner = first.withColumn("_owner", F.col("_first.local_id")).join(own.select(group, "_owner", "entity_id"), [group, "_owner"])
    alias = owner.select(group, F.explode(F.array("local_id", "name")).alias("alias"), "entity_id", "_first")
    alias = alias.groupBy(group, "alias").agg(F.min_by("entity_id", "_first").alias("entity_id"))
    links = reduce(DataFrame.unionByName, [r.withColumn("pass_no", F.lit(k)) for k, r in enumerate(relations)])
    end = lambda name: alias.select(group, F.col("alias").alias(name), F.col("entity_id").alias(f"{name}_id"))
    known = links.join(end("source"), [group, "source"], "left").join(end("target"), [group, "target"], "left")
    reason = F.when(F.col("source_id").isNull() | F.col("target_id").isNull(), "unresolved_endpoint").when(F.col("source_id") == F.col("target_id"), "self_relation")
    judged = known.withColumn("reason", reason)
    kept = judged.where("reason IS NULL").groupBy(group, "source_id", "type", "target_id").agg(F.min(F.struct("pass_no", "pos")).alias("_at"))
    return own.drop("_owner"), kept.select(group, "source_id", "type", "target_id", F.col("_at.pass_no").alias("pass_no")), judged.where("reason IS NOT NULL").select(group, "source", "type", "target", "reason")


def profile_graph(profiles: DataFrame, items: DataFrame, relations: DataFrame, group: str, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Entities and relations of profiles: a root, which contains each item, and the relations whose ends are known.

    profiles: (group, name); items: (group, local_id, name, type, confidence); relations: (group, source, type, target,
    confidence, explicit). Log curves hang by has_log_curve. strict: a relation with an unknown end fails the job when
    it is run, in place of being left out.
    """
    root = profiles.select(group, stable_id("profile", group).alias("entity_id"), "name", F.lit("stratigraphic_profile").alias("type"), F.lit(1.0).alias("confidence"))
    ids = items.where(F.trim("local_id") != "").select(group, "local_id", stable_id("node", group, "local_id").alias("entity_id"), "name", "type", clamp_confidence("confidence", 0.9).alias("confidence")).dropDuplicates([group, "local_id"])
    inside = ids.join(root.select(group, F.col("entity_id").alias("_root")), group).select(
        group, F.col("_root").alias("source_id"), F.when(F.col("type") == "log_curve", "has_log_curve").otherwise("contains").alias("type"), F.col("entity_id").alias("target_id"), "confidence", F.lit(True).alias("explicit")
    )
    end = lambda name: ids.select(group, F.col("local_id").alias(name), F.col("entity_id").alias(f"{name}_id"))
    linked = relations.join(end("source"), [group, "source"], "left").join(end("target"), [group, "target"], "left")
    dangling = F.col("source_id").isNull() | F.col("target_id").isNull()
    if strict:
        linked = linked.withColumn("source_id", F.when(dangling, F.raise_error(F.concat(F.lit("unknown end of "), "source", F.lit(" "), "type", F.lit(" "), "target")).cast("string")).otherwise(F.col("source_id")))
    else:
        linked = linked.where(~dangling)
    drawn = linked.select(group, "source_id", "type", "target_id", clamp_confidence("confidence").alias("confidence"), "explicit")
    return root.unionByName(ids.drop("local_id")), inside.unionByName(drawn)


def relations_by_precedence(parts: dict[str, DataFrame], key: list[str]) -> DataFrame:
    """The relations of several sources, named in order of precedence: of equal keys the first source's row counts."""
    rows = reduce(DataFrame.unionByName, [df.withColumn("basis", F.lit(name)).withColumn("_rank", F.lit(k)) for k, (name, df) in enumerate(parts.items())])
    w = Window.partitionBy(*key).orderBy("_rank")
    return rows.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r", "_rank")


def hybrid_result(labels: DataFrame, edges: DataFrame, features: DataFrame, units: DataFrame, image: str) -> dict[str, DataFrame]:
    """The measured tables of figures with a vertical axis: fits, tracks, intervals, alignments and quality.

    labels(image, y, value) give the axis; edges(image, x, support) the tracks; features(image, feature_id, top_y,
    bottom_y) get axis values from the fit and are aligned with units(image, unit_id, parent_id, top, bottom).
    Images without a valid fit have tracks and quality alone.
    """
    fits = A.fit_line(labels, [image], "y", "value")
    good = fits.where("error IS NULL").select(image, "slope", "intercept")
    ends = [value_at("slope", "intercept", c) for c in ("top_y", "bottom_y")]
    intervals = features.join(good, image).select(image, "feature_id", F.least(*ends).alias("top"), F.greatest(*ends).alias("bottom"))
    tracks = H.tracks(edges, image, "x", 1, 3.0)
    aligned = Y.depth_alignment(intervals, units, image)
    count = lambda df, name: df.groupBy(image).agg(F.count("*").alias(name))
    quality = fits.select(image, "rmse", "error")
    for df, name in ((tracks, "n_tracks"), (intervals, "n_intervals"), (aligned, "n_alignments")):
        quality = quality.join(count(df, name), image, "left").na.fill(0, [name])
    return {"fits": fits, "tracks": tracks, "intervals": intervals, "alignments": aligned, "quality": quality}


def result_record(images: DataFrame, entities: DataFrame, relations: DataFrame, key: str, kinds: list[str]) -> DataFrame:
    """key, n_entities, n_relations, a count for each relation type in kinds, n_dangling, status of each image."""
    e = entities.groupBy(key).agg(F.count("*").alias("n_entities"))
    ids = entities.select(key, F.col("entity_id").alias("_id")).distinct()
    ends = relations.select(key, F.explode(F.array("source_id", "target_id")).alias("_id"))
    bad = ends.join(ids, [key, "_id"], "left_anti").groupBy(key).agg(F.count("*").alias("n_dangling"))
    r = relations.groupBy(key).agg(F.count("*").alias("n_relations"), *[F.count_if(F.col("type") == k).alias(f"n_{k}") for k in kinds])
    names = ["n_entities", "n_relations", *(f"n_{k}" for k in kinds), "n_dangling"]
    out = images.select(key).join(e, key, "left").join(r, key, "left").join(bad, key, "left").na.fill(0, names)
    return out.withColumn("status", F.when(F.col("n_entities") == 0, "empty").when(F.col("n_dangling") > 0, "failed").otherwise("completed"))


def arbitrated(first: DataFrame, reviews: DataFrame, decisions: DataFrame, key: list[str], review_below: float = 0.86) -> DataFrame:
    """key, lithology, confidence, decided_by of layered model passes: first (lithology, confidence) unless its confidence is
    below review_below and a review has one; where the two then differ, the decision counts if there is one."""
    r = reviews.select(*key, F.col("lithology").alias("_l"), F.col("confidence").alias("_c"))
    d = decisions.select(*key, F.col("lithology").alias("_d"))
    reviewed = (F.col("confidence") < review_below) & F.col("_l").isNotNull()
    differs = reviewed & (F.col("_l") != F.col("lithology"))
    by = F.when(differs & F.col("_d").isNotNull(), "decision").when(reviewed, "review").otherwise("first")
    return first.join(r, key, "left").join(d, key, "left").withColumn("decided_by", by).select(
        *key, F.when(by == "decision", F.col("_d")).when(by == "review", F.col("_l")).otherwise(F.col("lithology")).alias("lithology"),
        F.when(reviewed, F.greatest("confidence", "_c")).otherwise(F.col("confidence")).alias("confidence"), "decided_by",
    )


def cluster_result(members: DataFrame, cluster: str, member: str, name: str, confidence: str) -> DataFrame:
    """cluster, canonical (the most confident member's name), members in order, confidence (their mean)."""
    return members.groupBy(cluster).agg(
        F.min_by(name, F.struct(-F.col(confidence), F.col(member))).alias("canonical"), F.array_sort(F.collect_list(member)).alias("members"), F.avg(confidence).alias("confidence")
    )


def audited(units: DataFrame, audit: DataFrame, group: str, key: str, value: str) -> DataFrame:
    """units with the audit's values, in groups where the audit names exactly the ids that the units have; accepted tells."""
    ids = lambda df: df.groupBy(group).agg(F.array_sort(F.collect_set(key)).alias("_ids"))
    same = ids(units).join(ids(audit).withColumnRenamed("_ids", "_audit"), group).where("_ids = _audit").select(group, F.lit(True).alias("accepted"))
    new = audit.select(group, key, F.col(value).alias("_value"))
    out = units.join(same, group, "left").join(new, [group, key], "left")
    accepted = F.coalesce("accepted", F.lit(False))
    return out.withColumn(value, F.when(accepted, F.col("_value")).otherwise(F.col(value))).withColumn("accepted", accepted).select(*units.columns, "accepted")


def table_only(tasks: DataFrame, kind: str, subtype: str) -> DataFrame:
    """Tasks with the classification of table figures forced on them; those of another kind are skipped rows."""
    ok = F.col(kind) == "table"
    return tasks.withColumn("code", F.when(ok, F.lit(subtype))).withColumn("status", F.when(ok, "pending").otherwise("skipped_kind"))


def formula_records(formulas: DataFrame, key: str, latex: str) -> tuple[DataFrame, DataFrame]:
    """Nodes (id, type, name) and HAS_SYMBOL edges (source, type, target) of formulas and their symbols, with ids that do not change."""
    rows = formulas.select(stable_id("formula", key, latex).alias("f"), F.col(latex).alias("name"), F.explode_outer(L.symbols(F.col(latex))).alias("s"))
    sym = stable_id("symbol", "f", "s")
    nodes = rows.select(F.col("f").alias("id"), F.lit("Formula").alias("type"), "name").unionByName(rows.where("s IS NOT NULL").select(sym.alias("id"), F.lit("Symbol").alias("type"), F.col("s").alias("name")))
    return nodes.distinct(), rows.where("s IS NOT NULL").select(F.col("f").alias("source"), F.lit("HAS_SYMBOL").alias("type"), sym.alias("target")).distinct()


def graph_rows(parts: dict[str, DataFrame], document: Column, chunk: Column, modality: str, stage: str) -> DataFrame:
    """document_id, chunk_id, modality, stage, kind, id: a chunk's entities, relations and events as one long table."""
    rows = [df.select(document.alias("document_id"), chunk.alias("chunk_id"), F.lit(modality).alias("modality"), F.lit(stage).alias("stage"), F.lit(kind).alias("kind"), F.col("id").cast("string").alias("id")) for kind, df in parts.items()]
    return reduce(DataFrame.unionByName, rows)
