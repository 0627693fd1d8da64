"""Documents to chunks: paragraph packing, ordering, neighbours, budgets, flattening and sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_CHUNK = 500


def pack_paragraphs(text: Column, most: int = MAX_CHUNK) -> Column:
    """Array of chunks: trimmed, non-blank lines joined by line ends while they stay within `most` characters.

    A longer line is a chunk of its own. Null gives an empty array. Lines are folded in blocks, so that what is
    copied grows by n ** 1.5 with the lines of a text and not by its square.
    """
    if most <= 0:
        raise ValueError("the length of a chunk must be over 0")
    lines = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.trim(x)), lambda x: x != "")
    none = F.array().cast("array<string>")

    def step(acc: Column, line: Column) -> Column:
        done, now = acc["done"], acc["now"]
        size = F.char_length(now) + 1 + F.char_length(line)
        return (
            F.when(now == "", F.struct(done.alias("done"), line.alias("now")))
            .when(size <= most, F.struct(done.alias("done"), F.concat(now, F.lit("\n"), line).alias("now")))
            .otherwise(F.struct(F.array_append(done, now).alias("done"), line.alias("now")))
        )

    def block(acc: Column, lines: Column) -> Column:
        packed = F.aggregate(lines, F.struct(none.alias("done"), acc["now"].alias("now")), step)
        return F.transform(F.array(packed), lambda p: F.struct(F.array_append(acc["blocks"], p["done"]).alias("blocks"), p["now"].alias("now")))[0]

    start = F.struct(F.array().cast("array<array<string>>").alias("blocks"), F.lit("").alias("now"))
    whole = lambda acc: F.concat(F.flatten(acc["blocks"]), F.when(acc["now"] == "", none).otherwise(F.array(acc["now"])))
    return F.transform(F.array(lines), lambda x: F.aggregate(_blocks(x), start, block, whole))[0]


def _blocks(lines: Column) -> Column:
    """The lines in blocks of about as many lines as there are blocks, so that no fold appends to an array of all chunks."""
    size = F.ceil(F.sqrt(F.size(lines) + 1)).cast("int")
    return F.transform(F.sequence(F.lit(0), F.floor(F.size(lines) / size).cast("int")), lambda k: F.slice(lines, k * size + 1, size))


def chunk_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", most: int = MAX_CHUNK) -> DataFrame:
    """key, ord (from 0), chunk_text: one row for each chunk."""
    return docs.select(key, F.posexplode(pack_paragraphs(F.col(text), most)).alias("ord", "chunk_text"))


def with_index(df: DataFrame, partition: list[str], order: list) -> DataFrame:
    """A 0-based idx in the stable order of each partition."""
    return df.withColumn("idx", F.row_number().over(Window.partitionBy(*partition).orderBy(*order)) - 1)


def neighbour_context(df: DataFrame, partition: list[str], order: list, text: str, chars: int = 180) -> DataFrame:
    """previous_tail and next_head: the ends of the neighbours' texts in the same partition, null at its ends."""
    w = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn("previous_tail", F.right(F.lag(text).over(w), F.lit(chars))).withColumn("next_head", F.left(F.lead(text).over(w), F.lit(chars)))


def budgeted(df: DataFrame, partition: list[str], order: list, text: str, budget: int = 12_000, each: int = 4_000) -> DataFrame:
    """Each text cut to `each` characters, then to what is left of the partition's budget; rows with nothing left go."""
    w = Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    cut = F.substring(F.col(text), 1, each)
    used = F.coalesce(F.sum(F.char_length(cut)).over(w), F.lit(0))
    rows = df.withColumn("_used", used).withColumn("_cut", cut)
    kept = F.substring(F.col("_cut"), F.lit(1), F.greatest(F.lit(0), F.lit(budget) - F.col("_used")).cast("int"))
    return rows.withColumn("part", kept).where(F.char_length("part") > 0).drop("_used", "_cut")


def round_robin(df: DataFrame, group: str, rank_by: list, first_seen: Column, most: int) -> DataFrame:
    """The best of each group in order of the groups' first appearance, then the second best, up to `most` rows."""
    ranked = df.withColumn("round", F.row_number().over(Window.partitionBy(group).orderBy(*rank_by)))
    seen = df.groupBy(group).agg(F.min(first_seen).alias("seen"))
    return ranked.join(seen, group).orderBy("round", "seen", group).limit(most)


def flatten_sections(docs: DataFrame) -> DataFrame:
    """Chunks of documents(document_id, title, sections array<struct<id, title, summary, schemaKeys, chunks>>), each
    with the context of its section and document where it has none of its own."""
    sections = docs.select("document_id", F.col("title").alias("document_title"), F.posexplode("sections").alias("section_pos", "s"))
    rows = sections.select("document_id", "document_title", "section_pos", "s", F.posexplode("s.chunks").alias("chunk_pos", "c"))
    names = {f.name for f in rows.schema["c"].dataType.fields}
    own = lambda n, other: F.coalesce(F.col(f"c.{n}"), other) if n in names else other
    return rows.select(
        "document_id", "document_title",
        own("section_id", F.col("s.id")).alias("section_id"),
        own("section_title", F.col("s.title")).alias("section_title"),
        own("summary", F.col("s.summary")).alias("summary"),
        own("schemaKeys", F.col("s.schemaKeys")).alias("schema_keys"),
        F.col("c.id").alias("chunk_id"), "section_pos", "chunk_pos",
        F.lower(F.coalesce(F.col("c.modality"), F.lit("text"))).alias("modality"),
        F.col("c.text").alias("text"),
    )


MODALITIES = {"text": "text", "paragraph": "text", "table": "table", "image": "image", "figure": "image", "formula": "formula", "equation": "formula"}


def modality(*candidates: Column) -> Column:
    """The first candidate that is set, as one of text, table, image, formula; null for any other."""
    first = F.lower(F.trim(F.coalesce(*[F.when(F.trim(c) != "", c) for c in candidates])))
    table = F.create_map(*[F.lit(x) for kv in MODALITIES.items() for x in kv])
    return F.element_at(table, first)


def modality_chunks(sections: DataFrame, most: int = MAX_CHUNK) -> DataFrame:
    """Chunks of sections(document_id, section_id, content, images, tables, formulas): per section text chunks, then
    images, tables and formulas, with ids section:modality:i and a running ord."""
    key = ["document_id", "section_id"]
    text = sections.select(*key, F.lit(0).alias("kind"), F.lit("text").alias("modality"), F.posexplode(pack_paragraphs(F.col("content"), most)).alias("i", "body"))
    parts = [text]
    for kind, (column, name) in enumerate([("images", "image"), ("tables", "table"), ("formulas", "formula")], 1):
        parts.append(sections.select(*key, F.lit(kind).alias("kind"), F.lit(name).alias("modality"), F.posexplode(column).alias("i", "body")))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    order = Window.partitionBy(*key).orderBy("kind", "i")
    return rows.select(
        *key, F.concat_ws(":", "section_id", "modality", F.col("i").cast("string")).alias("chunk_id"), "modality", "body",
        (F.row_number().over(order) - 1).alias("ord"),
    )


def text_part(kind: str, chunk_id: str, text: str, caption: str) -> Column:
    """A chunk as labelled text for a prompt, by its modality."""
    label = F.concat(F.lit("["), F.col(kind), F.lit(" "), F.col(chunk_id), F.lit("]\n"))
    return F.concat(label, F.when(F.col(kind) == "image", F.coalesce(F.col(caption), F.lit(""))).otherwise(F.coalesce(F.col(text), F.lit(""))))


def whitelist(values: Column, allowed: Column, most: int | None = None) -> Column:
    """The trimmed values that are allowed, each once, in order, the first `most` of them."""
    kept = F.array_distinct(F.filter(F.transform(values, lambda x: F.trim(x)), lambda x: F.array_contains(allowed, x)))
    return kept if most is None else F.slice(kept, 1, most)


TECHNICAL = r"[A-Za-z][A-Za-z-]{3,}"


def technical_terms(text: Column, stop: list[str], pattern: str = TECHNICAL) -> Column:
    """All matches of the pattern in lower case that are not on the stop list, repeats included."""
    found = F.transform(F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1)), lambda x: F.lower(x))
    return F.filter(found, lambda x: ~x.isin(stop)) if stop else found


def term_counts(df: DataFrame, key: str, group: list[str], text: str, stop: list[str], most: int) -> DataFrame:
    """The `most` frequent terms of each group, by count, then length, then name; tf counts uses, df distinct keys.

    Terms are counted per group with partial aggregation; the window sees one row for each term.
    """
    terms = df.select(key, *group, F.explode(technical_terms(F.col(text), stop)).alias("term"))
    each = terms.groupBy(key, *group, "term").agg(F.count("*").alias("n"))
    counts = each.groupBy(*group, "term").agg(F.sum("n").alias("tf"), F.count("*").alias("df"))
    order = Window.partitionBy(*group).orderBy(F.desc("tf"), F.desc(F.char_length("term")), "term")
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
