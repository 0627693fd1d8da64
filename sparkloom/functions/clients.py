"""Model clients as injected factories, extractor registry, prompts."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType


class EchoChat:
    """The offline stub: answers with the prompt."""

    def chat(self, prompt: str) -> str:
        return prompt


def answer(client, prompt: str, tries: int = 3, wait: Callable[[float], None] = time.sleep) -> tuple[str | None, str, str | None]:
    """(response, status, error) after up to `tries` calls, 1, 2, 4 ... seconds apart."""
    error = None
    for n in range(tries):
        try:
            return client.chat(prompt), "completed", None
        except Exception as e:  # a client may raise anything; the row keeps it
            error = f"{type(e).__name__}: {e}"
            if n + 1 < tries:
                wait(2.0**n)
    return None, "model_error", error


def call_model(rows: DataFrame, key: str, prompt: str, factory: Callable[[], object], tries: int = 3, least_interval: float = 0.0, partitions: int | None = None) -> DataFrame:
    """key, response, status, error: one client for each partition, made where it is used.

    least_interval seconds pass between a partition's calls, so `partitions` caps the rate. Blank prompts are
    skipped and no call is made. A failed call is a row with its error, never a failed job.
    """
    kind = rows.schema[key].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client, last = factory(), 0.0
        for df in frames:
            out = []
            for k, p in zip(df[key], df[prompt]):
                if p is None or not str(p).strip():
                    out.append((k, None, "skipped_empty", None))
                    continue
                if least_interval:
                    time.sleep(max(0.0, last + least_interval - time.monotonic()))
                    last = time.monotonic()
                out.append((k, *answer(client, p, tries)))
            yield pd.DataFrame(out, columns=[key, "response", "status", "error"])

    picked = rows.select(key, prompt)
    picked = picked.coalesce(partitions) if partitions else picked
    return picked.mapInPandas(run, f"{key} {kind}, response string, status string, error string")


def embed(rows: DataFrame, key: str, text: str, factory: Callable[[], object], batch: int = 32) -> DataFrame:
    """key, vector: texts go to client.encode(list of texts) in batches."""
    kind = rows.schema[key].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = factory()
        for df in frames:
            for k in range(0, len(df), batch):
                part = df.iloc[k : k + batch]
                yield pd.DataFrame({key: part[key], "vector": [list(map(float, v)) for v in client.encode(part[text].tolist())]})

    return rows.select(key, text).mapInPandas(run, f"{key} {kind}, vector array<float>")


def table_detector(factory: Callable[[], Callable[[str, float], bool]], threshold: float = 0.95):
    """A boolean UDF of image paths."""

    @F.pandas_udf(BooleanType())
    def detect(path: pd.Series) -> pd.Series:
        judge = factory()
        return path.map(lambda p: bool(p) and bool(judge(p, threshold)))

    return detect


def route_model(modality: Column) -> Column:
    """vision for images, text for all else."""
    return F.when(modality == "image", "vision").otherwise("text")


Extractor = Callable[[DataFrame], DataFrame]
GRAPH_SCHEMA = "chunk_id string, status string, entities int, relations int"


def empty_extractor(tasks: DataFrame) -> DataFrame:
    """The default: a row for each task without a graph."""
    return tasks.select(F.col("chunk_id").cast("string"), F.lit("not_implemented").alias("status"), F.lit(0).alias("entities"), F.lit(0).alias("relations"))


class Registry:
    """Extractors by kind."""

    def __init__(self):
        self._of: dict[str, Extractor] = {}

    def register(self, kind: str, extractor: Extractor, replace: bool = False) -> None:
        if kind in self._of and not replace:
            raise ValueError(f"{kind} has an extractor")
        self._of[kind] = extractor

    def get(self, kind: str) -> Extractor:
        return self._of.get(kind, empty_extractor)

    def kinds(self) -> list[str]:
        return sorted(self._of)

    def dispatch(self, tasks: DataFrame, kind: str, allowed: list[str] | None = None) -> DataFrame:
        """Each task to the extractor of its kind; tasks of kinds that are not allowed are skipped rows."""
        kinds = self.kinds()
        ok = F.lit(True) if allowed is None else F.col(kind).isin(allowed)
        out = tasks.where(~ok).select(F.col("chunk_id").cast("string"), F.lit("skipped_kind").alias("status"), F.lit(0).alias("entities"), F.lit(0).alias("relations"))
        for k in kinds:
            out = out.unionByName(self.get(k)(tasks.where(ok & (F.col(kind) == k))))
        return out.unionByName(empty_extractor(tasks.where(ok & ~F.col(kind).isin(kinds))))


def prompt(template: str, **columns) -> Column:
    """A template with {name} places filled by columns; lists and structs go in as JSON."""
    out = F.lit(template)
    for name, c in columns.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(c if isinstance(c, Column) else F.col(c), F.lit("")))
    return out


ENTITY_PROMPT = "List the entities of the text as JSON. Allowed types: {types}.\n\n{text}"
RELATION_PROMPT = "List the relations between these entities as JSON.\nEntities: {entities}\nAllowed relations: {relations}\n\n{text}"
SUMMARY_PROMPT = "Summarise the section {title}. Child summaries: {children}\nCategories to choose from: {categories}\n\n{text}"
AUDIT_PROMPT = "Check each relation against the figure and its caption, and answer with the ids to keep.\n{relations}\nCaption: {caption}"


def remote_parse(files: DataFrame, key: str, path: str, factory: Callable[[], object], tries: int = 3) -> DataFrame:
    """key, state (done or failed), content, error: what client.parse(path) returns for each file, as JSON text.

    The connector is injected; a file that it cannot parse is a failed row, never a failed job.
    """
    kind = files.schema[key].dataType.simpleString()

    class _Asked:
        def __init__(self, client) -> None:
            self.chat = client.parse

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        asked = _Asked(factory())
        for df in frames:
            out = []
            for k, p in zip(df[key], df[path]):
                content, status, error = answer(asked, p, tries, lambda seconds: None)
                out.append((k, "done" if status == "completed" else "failed", content, error))
            yield pd.DataFrame(out, columns=[key, "state", "content", "error"])

    return files.select(key, path).mapInPandas(run, f"{key} {kind}, state string, content string, error string")


FORMULA_PROMPT = "Give the meaning and unit of each symbol as JSON.\nSymbols: {symbols}\nFormula: {latex}"


def formula_semantics(formulas: DataFrame, key: str, latex: str, symbols: str, factory: Callable[[], object]) -> DataFrame:
    """key, symbol, meaning, unit of the symbols that a model explains; an answer that is no JSON explains none."""
    from sparkloom.functions.scalars import json_fragment, without_thinking

    asked = formulas.select(key, prompt(FORMULA_PROMPT, symbols=F.array_join(symbols, ", "), latex=latex).alias("_prompt"))
    answers = call_model(asked, key, "_prompt", factory)
    parsed = F.from_json(json_fragment(without_thinking("response")), "symbols array<struct<symbol:string,meaning:string,unit:string>>")
    return answers.select(key, F.inline(parsed["symbols"]))
