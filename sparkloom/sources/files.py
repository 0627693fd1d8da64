"""File sources and sinks: tolerant text, Markdown and PDF discovery, JSON, journals, catalogues, caches."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from sparkloom.sources.scratch import store

ENCODINGS = ("utf-8-sig", "utf-8", "gb18030")
#: Files that mark a PDF's output folder as done (fixed values).
DONE_FILES = ["full.md", "content_list.json", "layout.json"]


def decode(content: bytes) -> str:
    """The text under the first encoding that reads it, else UTF-8 with replacement characters."""
    for name in ENCODINGS:
        try:
            return content.decode(name)
        except UnicodeDecodeError:
            pass
    return content.decode("utf-8", "replace")


@F.pandas_udf(StringType())
def decode_udf(content: pd.Series) -> pd.Series:
    return content.map(lambda b: None if b is None else decode(bytes(b)))


def read_texts(spark: SparkSession, path: str, pattern: str = "*.md") -> DataFrame:
    """path, text of all files below a folder that match the pattern."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    return files.select("path", decode_udf("content").alias("text"))


def read_json(spark: SparkSession, path: str, schema: str | None = None, lines: bool = False) -> DataFrame:
    """JSON files of one value each, or, with lines, of one on each line, as write_json() leaves them."""
    reader = spark.read.option("multiLine", str(not lines).lower())
    return (reader.schema(schema) if schema else reader).json(path)


def read_journal(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of JSON-lines files before the first line of each that cannot be read.

    A file is one row while it is split, so line numbers need no shuffle of the whole folder; journals are appended
    a chunk at a time and are small files.
    """
    files = spark.read.format("binaryFile").load(path).select("path", F.decode("content", "UTF-8").alias("text"))
    lines = files.select("path", F.posexplode(F.split("text", "\n")).alias("line_no", "line")).where(F.trim("line") != "")
    parsed = lines.withColumn("row", F.from_json("line", schema + ", _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    w = Window.partitionBy("path").orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    kept = parsed.withColumn("_ok", F.bool_and(F.col("row").isNotNull() & F.col("row._bad").isNull()).over(w)).where("_ok")
    return kept.select("path", "line_no", "row.*").drop("_bad")


def list_pdfs(spark: SparkSession, path: str) -> DataFrame:
    """path, size of PDF files below a folder, whatever the case of their ending; no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.where(F.lower("path").endswith(".pdf")).select("path", F.col("length").alias("size"))


def pending_pdfs(pdfs: DataFrame, outputs: DataFrame) -> DataFrame:
    """pdfs(name, ...) without layout copies and those whose folder in outputs(name, file) holds a result."""
    done = outputs.where(F.col("file").isin(DONE_FILES)).select("name").distinct()
    own = ~F.col("name").rlike(r"^[0-9a-fA-F]{8}-[0-9a-fA-F-]{27}_origin\.pdf$")
    return pdfs.where(own).join(done, "name", "left_anti")


def split_parts(pdfs: DataFrame, most: int = 200) -> DataFrame:
    """name, part, first_page, last_page (from 0) and part_name; files without a page count pass as they are."""
    rows = pdfs.withColumn("_start", F.explode_outer(F.when(F.col("pages") > 0, F.sequence(F.lit(0), F.col("pages") - 1, F.lit(most)))))
    part = F.floor(F.col("_start") / most).cast("int") + 1
    stem = F.regexp_replace("name", r"(?i)\.pdf$", "")
    return rows.select(
        "name", part.alias("part"), F.col("_start").alias("first_page"), F.least(F.col("_start") + most, F.col("pages")).alias("_e"),
        F.when(F.col("pages") > most, F.concat(stem, F.lit("_part"), F.lpad(part.cast("string"), 3, "0"), F.lit(".pdf"))).otherwise(F.col("name")).alias("part_name"),
    ).withColumn("last_page", F.col("_e") - 1).drop("_e")


def upload_batches(items: DataFrame, order: str, size: int = 20, parts: int = 1024) -> DataFrame:
    """batch, items: fixed numbers of items in order.

    The items are dealt to sorted ranges, which are written before anything is counted, as the bounds of ranges come
    from a sample and differ between two runs. A batch is its range's offset and the rank within.
    """
    ranges = items.select(order).repartitionByRange(max(1, min(parts, items.rdd.getNumPartitions())), order)
    ranged = store(ranges.withColumn("_p", F.spark_partition_id()))
    w = Window.partitionBy("_p").orderBy(order)
    local = ranged.withColumn("_r", F.row_number().over(w))
    totals = {r["_p"]: r["n"] for r in local.groupBy("_p").agg(F.count("*").alias("n")).collect()}
    before, at = [], 0
    for p in sorted(totals):
        before.append((p, at))
        at += totals[p]
    bases = F.broadcast(items.sparkSession.createDataFrame(before, "_p int, _base long"))  # a row for each range
    batch = F.floor((F.col("_base") + F.col("_r") - 1) / size).cast("int").alias("batch")
    return local.join(bases, "_p").select(batch, order).groupBy("batch").agg(F.array_sort(F.collect_list(order)).alias("items"))


def catalogue_lookup(requests: DataFrame, catalogue: DataFrame) -> DataFrame:
    """requests(request_id, paper_id, file_name) with the paper id: the explicit one, else that of the catalogue's
    source_pdf, else the file's stem."""
    c = catalogue.select(F.col("source_pdf").alias("file_name"), F.col("paper_id").alias("_found")).dropDuplicates(["file_name"])
    stem = F.regexp_replace(F.element_at(F.split("file_name", "/"), -1), r"\.[^.]+$", "")
    return requests.join(c, "file_name", "left").select("request_id", F.coalesce(F.nullif(F.trim("paper_id"), F.lit("")), "_found", stem).alias("paper_id"))


def find_member(payload: str, name: str = "table_body") -> str | None:
    """The first non-empty member of that name anywhere in JSON text, depth first."""
    import json

    def walk(value):
        if isinstance(value, dict):
            if isinstance(value.get(name), str) and value[name].strip():
                return value[name]
            value = list(value.values())
        if isinstance(value, list):
            return next((x for x in map(walk, value) if x), None)
        return None

    try:
        return walk(json.loads(payload))
    except (TypeError, ValueError):
        return None


@F.pandas_udf(StringType())
def table_body(payload: pd.Series) -> pd.Series:
    return payload.map(find_member)


def concept_scan(concepts: DataFrame, categories: DataFrame) -> DataFrame:
    """Concepts with their category: the linked one, else their own, else empty."""
    c = categories.select("schema", F.col("category").alias("_c"))
    return concepts.join(c, "schema", "left").withColumn("category", F.coalesce("_c", "category", F.lit(""))).drop("_c").orderBy("schema")


def category_names(categories: DataFrame, name: str, order: str) -> DataFrame:
    """Distinct trimmed names in order of first appearance."""
    t = F.trim(F.col(name))
    return categories.where(t.isNotNull() & (t != "")).groupBy(t.alias("name")).agg(F.min(order).alias("pos"))


def prefer(primary: DataFrame, fallback: DataFrame, key: list[str]) -> DataFrame:
    """Rows of primary, and those of fallback whose key it lacks."""
    return primary.unionByName(fallback.join(primary.select(*key).distinct(), key, "left_anti"))


def fingerprint(path: Column, size: Column, modified: Column, models: Column) -> Column:
    return F.sha2(F.concat_ws("|", path, size.cast("string"), modified.cast("string"), models), 256)


def to_compute(requests: DataFrame, stored: DataFrame, key: list[str]) -> DataFrame:
    """Requests whose result is not stored under the same fingerprint, once each."""
    return requests.dropDuplicates(key).join(stored.select(*key), key, "left_anti")


def replayed(requests: DataFrame, recorded: DataFrame, name: str) -> DataFrame:
    """Requests with the recorded response of their file name, missing where there is none."""
    return requests.join(recorded.select(name, "response"), name, "left").withColumn("status", F.when(F.col("response").isNull(), "missing").otherwise("replayed"))


def write_json(df: DataFrame, path: str, partition: list[str] = ()) -> None:
    writer = df.write.mode("overwrite").option("ignoreNullFields", "false")
    (writer.partitionBy(*partition) if partition else writer).json(path)


def write_graph(entities: DataFrame, relations: DataFrame, path: str) -> None:
    """Node and edge side-cars of completed graphs."""
    entities.where("status = 'completed'").drop("status").write.mode("overwrite").parquet(f"{path}/nodes")
    relations.where("status = 'completed'").drop("status").write.mode("overwrite").parquet(f"{path}/edges")


def upsert_schema(nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes by schema and edges by key, the last of each; edges whose ends are no nodes go."""
    n = nodes.groupBy("schema").agg(*[F.max_by(c, "seq").alias(c) for c in nodes.columns if c not in ("schema", "seq")])
    ends = n.select("schema")
    ok = edges.join(ends.withColumnRenamed("schema", "src"), "src", "left_semi").join(ends.withColumnRenamed("schema", "dst"), "dst", "left_semi")
    keyed = ok.withColumn("key", F.concat_ws("_", "src", "rel", "dst"))
    return n, keyed.groupBy("key").agg(*[F.max_by(c, "seq").alias(c) for c in ("src", "rel", "dst")])


def write_back_vectors(concepts: DataFrame, vectors: DataFrame, dimension: int, force: bool = False) -> DataFrame:
    """concepts with missing embeddings (all if forced) filled from vectors(schema, vector) of the right dimension."""
    v = vectors.where(F.size("vector") == dimension).select("schema", F.col("vector").alias("_v"))
    new = F.coalesce("_v", "embedding") if force else F.coalesce("embedding", "_v")
    return concepts.join(v, "schema", "left").withColumn("embedding", new).drop("_v")


def pending_chunks(chunks: DataFrame, journal: DataFrame, key: str) -> DataFrame:
    return chunks.join(journal.select(key).distinct(), key, "left_anti")


def viewer(graphs: DataFrame, chunks: DataFrame, search: str = "") -> DataFrame:
    """Graph counts next to their chunk's text, filtered by a search term, best score first."""
    rows = graphs.join(chunks, "chunk_id")
    found = rows.where(F.contains(F.lower("text"), F.lit(search.lower()))) if search else rows
    return found.orderBy(F.desc("score"), "chunk_id")



def run_query(spark: SparkSession, query: str, tables: dict[str, DataFrame], **params) -> DataFrame:
    """A SQL query over named DataFrames, with :name parameters; no view is left behind."""
    bound = {f"_t{k}": df for k, df in enumerate(tables.values())}
    with_ = ", ".join(f"{name} AS (SELECT * FROM {{_t{k}}})" for k, name in enumerate(tables))
    return spark.sql(f"WITH {with_} {query}" if tables else query, args=params or None, **bound)


def write_catalogue(pdfs: DataFrame, root: str, path: str) -> None:
    """The catalogue of parsed files: paper_id, source_pdf, source_path, output_dir for pdfs(path), as JSON."""
    name = F.element_at(F.split("path", "/"), -1)
    stem = F.regexp_replace(name, r"(?i)\.pdf$", "")
    write_json(pdfs.select(stem.alias("paper_id"), name.alias("source_pdf"), F.col("path").alias("source_path"), F.concat(F.lit(root.rstrip("/") + "/"), stem).alias("output_dir")), path)


def poll_states(tasks: DataFrame, batch: str, state: str) -> DataFrame:
    """batch, done, failed, open, finished: how far the tasks of a remote batch are, and whether all have ended."""
    s = F.lower(F.trim(state))
    out = tasks.groupBy(batch).agg(F.count_if(s == "done").alias("done"), F.count_if(s == "failed").alias("failed"), F.count_if(~s.isin("done", "failed")).alias("open"))
    return out.withColumn("finished", F.col("open") == 0)


def stamped(df: DataFrame, column: str = "updated_at") -> DataFrame:
    """df with the time at which the query that writes it began."""
    return df.withColumn(column, F.current_timestamp())
