"""Document context and two-level schema selection: a pool for each document, then a sub-graph for each chunk."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.functions.scalars import cosine, lexical_score, schema_key_score, weighted_score
from sparkloom.operators.joins import tiles


def context_errors(chunks: DataFrame, document: str = "document_id", chunk: str = "chunk_id") -> DataFrame:
    """document, error for missing ids, repeated chunk ids and unknown modalities."""
    w = Window.partitionBy(document, chunk)
    marked = chunks.withColumn("_n", F.count("*").over(w))
    error = (
        F.when(F.col(document).isNull(), "missing_document").when(F.coalesce(F.trim(F.col(chunk)), F.lit("")) == "", "missing_chunk_id")
        .when(F.col("_n") > 1, "duplicate_chunk_id").when(~F.col("modality").isin("text", "table", "image", "formula"), "unknown_modality")
    )
    return marked.select(document, chunk, error.alias("error")).where("error IS NOT NULL").distinct()


def document_context(chunks: DataFrame) -> DataFrame:
    """document_id, n_chunks, n_sections, section_chunks (section to ordered chunk ids) of chunks that have text."""
    rows = chunks.where(F.trim("text") != "")
    per = rows.groupBy("document_id", "section_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("ord", "chunk_id"))), lambda x: x["chunk_id"]).alias("ids"), F.count("*").alias("n")
    )
    return per.groupBy("document_id").agg(
        F.sum("n").alias("n_chunks"), F.count("*").alias("n_sections"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("section_id", "ids")))).alias("section_chunks")
    )


def concept_scores(texts: DataFrame, key: list[str], concepts: DataFrame) -> DataFrame:
    """key..., schema, category, exact, score of texts(key, text, terms, keys, embedding) against all concepts.

    The concepts are a dimension of tens of rows; they are counted before they are broadcast (joins.tiles).
    """
    c = concepts.select("schema", "name", "category", "examples", F.col("embedding").alias("_vec"))
    pairs = tiles(texts.select(*key, "text", "terms", "keys", "embedding"), c, key[-1], "schema")
    hits = F.size(F.filter("terms", lambda t: F.contains(F.lower("name"), F.lower(t))))
    lexical = lexical_score("text", "name", "examples", F.array("schema"), F.lit(0.0), hits)
    key_score = schema_key_score("keys", F.col("schema"))
    exact = F.contains("text", F.col("name")) | (key_score == 1.0)
    return pairs.select(*key, "schema", "category", exact.alias("exact"), F.greatest(weighted_score(cosine("embedding", "_vec"), lexical, key_score), F.when(exact, 0.9).otherwise(0.0)).alias("score"))


def document_pool(scores: DataFrame, key: str, trees: int = 3, most: int = 30, at_least: float = 0.3) -> DataFrame:
    """The concepts of the best `trees` categories (by the mean of their three best) with a sufficient score, and the
    best others up to `most`: exact ones first, then by score and name."""
    ranked = Window.partitionBy(key, "category").orderBy(F.desc("score"), "schema")
    cat = scores.withColumn("_r", F.row_number().over(ranked)).where("_r <= 3").groupBy(key, "category").agg(F.avg("score").alias("category_score"))
    best = cat.withColumn("_c", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("category_score"), "category"))).withColumn("core", F.col("_c") <= trees)
    rows = scores.join(best.select(key, "category", "category_score", "core"), [key, "category"]).where((F.col("score") >= at_least) | F.col("exact"))
    order = Window.partitionBy(key).orderBy(F.desc("core"), F.desc("exact"), F.desc("score"), "schema")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def chunk_selection(pool: DataFrame, chunk_scores: DataFrame, edges: DataFrame, document: str, chunk: str, seeds: int = 10, expansion: int = 15) -> DataFrame:
    """document, chunk, schema, role: the pool's core, the chunk's best scored concepts of the pool as seeds, and their
    neighbours over edges(src, dst) by score."""
    inside = chunk_scores.join(pool.select(document, "schema"), [document, "schema"])
    s = inside.withColumn("_r", F.row_number().over(Window.partitionBy(document, chunk).orderBy(F.desc("exact"), F.desc("score"), "schema"))).where(F.col("_r") <= seeds)
    both = edges.select("src", "dst").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()
    near = s.select(document, chunk, F.col("schema").alias("src")).join(both, "src").select(document, chunk, F.col("dst").alias("schema")).distinct()
    scored = near.join(chunk_scores.select(document, chunk, "schema", "score"), [document, chunk, "schema"])
    more = scored.withColumn("_r", F.row_number().over(Window.partitionBy(document, chunk).orderBy(F.desc("score"), "schema"))).where(F.col("_r") <= expansion)
    core = pool.where("core").select(document, "schema").join(chunk_scores.select(document, chunk).distinct(), document)
    parts = [(core, 0, "core"), (s, 1, "seed"), (more, 2, "expansion")]
    out = None
    for df, rank, role in parts:
        p = df.select(document, chunk, "schema", F.lit(rank).alias("_rank"), F.lit(role).alias("role"))
        out = p if out is None else out.unionByName(p)
    return out.groupBy(document, chunk, "schema").agg(F.min_by("role", "_rank").alias("role"))


def induced_edges(selected: DataFrame, edges: DataFrame, key: list[str]) -> DataFrame:
    """Edges with both ends selected for the same key."""
    a = selected.select(*key, F.col("schema").alias("src"))
    b = selected.select(*key, F.col("schema").alias("dst"))
    return edges.join(a, "src").join(b, [*key, "dst"]).select(*key, "src", "rel", "dst").distinct()
