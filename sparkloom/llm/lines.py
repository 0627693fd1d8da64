"""Line deduplication by a log-template tree, and by runs of tokens where a passage does not keep to lines."""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from sparkloom.llm.common import bounded_batches, drop_materialized, join_counted, materialize

#: Levels of the tree below the token count: leading tokens of which each has a node.
DEPTH = 3
#: Parts of the tokens behind the leading ones; a template leaves one of them variable.
FIELDS = 4
#: Lines of fewer tokens than SHORT count as they are; those under LONG tokens have no variable part. The shorter a line,
#: the more different texts must have it.
SHORT, LONG = 4, 8
MIN_DOCS, MIN_DOCS_SHORT = 2, 10
MIN_DOCS_TINY = {3: 25, 2: 50, 1: 100}
#: Passages are seen by runs of GRAM tokens: of WINDOW runs in a row that of the least hash counts, wherever lines end.
#: A shared passage of 51 tokens has at least 51 - 2 * (WINDOW - 1) in such runs, and shorter stretches stay.
GRAM, WINDOW = 16, 12
PASSAGE = 51 - 2 * (WINDOW - 1)
#: A text of whose tokens more than this share would go is a copy as a whole, and stays. op9_lines and the pipeline set 1:
#: document deduplication, at 3 bits, would not take most such texts.
COPY_SHARE = 0.8
#: Lists of dropped lines are broadcast up to this many bytes, else joined by a shuffle.
BROADCAST_BYTES = 32 << 20

_VARIABLE = re.compile(rb"[0-9@]|://")
_TOKEN = re.compile(rb"\S+")


def templates(line: bytes) -> tuple[int, list[int]]:
    """(number of tokens, ids of the templates that the line matches).

    Tokens with a digit, an @ or :// are variable. The way down the tree is the token count, then DEPTH leading
    tokens; at the leaf, a template holds all but one of FIELDS parts of the other tokens. Two lines match one
    template if they differ in variable tokens and one part alone.
    """
    tokens = line.split()
    n = len(tokens)
    if n < SHORT:
        return n, []
    if _VARIABLE.search(line):
        tokens = [b"<*>" if _VARIABLE.search(t) else t for t in tokens]
    digest = xxhash.xxh64_intdigest
    leaf = digest(b"%d " % n + b" ".join(tokens[:DEPTH]))
    if n < LONG:
        found = [struct.pack("<QQ", leaf, digest(b" ".join(tokens[DEPTH:])))]
    else:
        rest = n - DEPTH
        cuts = [DEPTH + rest * k // FIELDS for k in range(FIELDS + 1)]
        parts = [digest(b" ".join(tokens[a:b])) for a, b in zip(cuts, cuts[1:])]
        found = [struct.pack(f"<QB{FIELDS - 1}Q", leaf, k, *parts[:k], *parts[k + 1 :]) for k in range(FIELDS)]
    return n, [_signed(digest(x)) for x in found]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def passages(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(first tokens, ids) of the runs of GRAM tokens that stand for a text; equal stretches have equal runs."""
    m = len(tokens) - GRAM + 1
    if m < WINDOW:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ids = np.fromiter(map(zlib.crc32, tokens), np.uint64, len(tokens))  # of two runs, GRAM tokens would have to collide
    ids = (ids + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    ids ^= ids >> np.uint64(32)
    power = 0x9E3779B97F4A7C15
    for k in (1, 2, 4, 8):  # GRAM is 16: runs of 2, 4, 8 and 16 tokens
        ids = ids[:-k] * np.uint64(power) + ids[k:]
        power = power * power % (1 << 64)
    ids = (ids ^ ids >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9)
    ids ^= ids >> np.uint64(29)
    least = _sliding(np.minimum, ids)
    edge = np.zeros(WINDOW - 1, np.uint64)
    at = np.flatnonzero(_sliding(np.maximum, np.concatenate([edge, least, edge])) == ids)
    return at, ids[at].view(np.int64)


def _sliding(best: np.ufunc, x: np.ndarray) -> np.ndarray:
    """The best of each WINDOW neighbours."""
    size = 1
    while size < WINDOW:
        k = min(size, WINDOW - size)
        x = best(x[:-k], x[k:])
        size += k
    return x


def stretches(starts: list[int]) -> list[tuple[int, int]]:
    """(first token, end) of the stretches of at least PASSAGE tokens that the runs at these starts cover."""
    out: list[list[int]] = []
    for s in sorted(starts):
        if out and s <= out[-1][1]:
            out[-1][1] = s + GRAM
        else:
            out.append([s, s + GRAM])
    return [(a, b) for a, b in out if b - a >= PASSAGE]


def without(text: str, lines: list[int], starts: list[int]) -> tuple[str, list[int], int, int]:
    """(the text without these lines and the stretches of these runs, lines that went whole, tokens gone, tokens).

    A line of which a part stays keeps its place, with one space where a stretch within it went.
    """
    parts = text.encode().split(b"\n")
    sizes = [len(x.split()) for x in parts]
    total = sum(sizes)
    gone = bytearray(total)
    for a, b in stretches(starts):
        gone[a:b] = b"\1" * (b - a)
    whole, out, at, n_gone = set(lines), [], 0, 0
    cut: list[int] = []
    for k, (line, n) in enumerate(zip(parts, sizes)):
        lost = sum(gone[at : at + n])
        if k in whole or (n and lost == n):
            cut.append(k)
            n_gone += n
        elif lost:
            own = [m.span() for m in _TOKEN.finditer(line)]
            kept = [i for i in range(n) if not gone[at + i]]
            pieces, first = [], kept[0]
            for i, following in zip(kept, [*kept[1:], None]):
                if following != i + 1:
                    pieces.append(line[own[first][0] if first else 0 : own[i][1] if i < n - 1 else len(line)])
                    first = following
            out.append(b" ".join(pieces))
            n_gone += lost
        else:
            out.append(line)
        at += n
    return b"\n".join(out).decode(), cut, n_gone, total


def line_templates(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, line, start, tokens, template): a row for each template that a line matches and for each
    run of tokens of the whole text. Lines count from 0, a run has its first token as start; the other one is -1."""
    bounded_batches(docs.sparkSession)
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            for at in range(0, len(texts), 64):
                rows, line_no, counts, ids = [], [], [], []
                held = texts.slice(at, 64).to_pylist()
                for k, text in enumerate(held, at):
                    for no, line in enumerate((text or b"").split(b"\n")):
                        n, found = templates(line)
                        if 0 < n < SHORT:
                            found = [_signed(xxhash.xxh64_intdigest(b"%d " % n + b" ".join(line.split())))]
                        for t in found:
                            rows.append(k)
                            line_no.append(no)
                            counts.append(n)
                            ids.append(t)
                yield made(batch, rows, line_no, [-1] * len(rows), counts, ids)
                runs = [passages((text or b"").split()) for text in held]
                rows = np.repeat(np.arange(at, at + len(held)), [len(x) for x, _ in runs])
                fixed = np.full(len(rows), -1, np.int32)
                yield made(batch, rows, fixed, np.concatenate([x for x, _ in runs]), fixed + GRAM + 1, np.concatenate([x for _, x in runs]))

    def made(batch: pa.RecordBatch, rows, *columns) -> pa.RecordBatch:
        taken = pa.array(rows, pa.int64())
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(taken), batch.column(1).take(taken), *(pa.array(x, t) for x, t in zip(columns, kinds))],
            ["doc_id", "text_key", "line", "start", "tokens", "template"],
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return keyed.mapInArrow(run, f"doc_id {kind}, text_key long, line int, start int, tokens int, template long")


def recurring(found: DataFrame, min_docs: int = MIN_DOCS, min_docs_short: int = MIN_DOCS_SHORT) -> DataFrame:
    """(template, n): those in at least as many different texts, and their rows; exact copies of a text count once.

    Counts are combined before each shuffle, so a line that a third of all documents share is no single task's work.
    """

    def often(rows: DataFrame, least: int | Column) -> DataFrame:
        if isinstance(least, int) and least == 2:  # two different keys: the smallest and the largest differ
            ends = rows.groupBy("template").agg(F.min("text_key").alias("a"), F.max("text_key").alias("b"), F.count("*").alias("n"))
            return ends.where("a <> b").select("template", "n")
        texts = rows.groupBy("template", "text_key", "tokens").agg(F.count("*").alias("k"))
        return texts.groupBy("template", "tokens").agg(F.count("*").alias("texts"), F.sum("k").alias("n")).where(F.col("texts") >= least).select("template", "n")

    needed = F.lit(min_docs_short)
    for n, least in MIN_DOCS_TINY.items():
        needed = F.when(F.col("tokens") == n, F.lit(least)).otherwise(needed)
    return often(found.where(F.col("tokens") >= LONG), min_docs).unionByName(often(found.where(F.col("tokens") < LONG), needed))


def recurring_rows(found: DataFrame, min_docs: int = MIN_DOCS, min_docs_short: int = MIN_DOCS_SHORT) -> DataFrame:
    """The rows of templates that recur, with owner, the text of the smallest doc_id that has the template.

    Exact copies of a text own its templates together. Most templates do not recur, so that owners are sought among
    the rows of those alone which do.
    """
    often = materialize(recurring(found, min_docs, min_docs_short), "line-recurring")
    small = often.count() * 24 <= BROADCAST_BYTES
    hits = materialize(found.join(F.broadcast(often), "template") if small else join_counted(found, often, "template", "n").withColumn("n", F.lit(0).cast("long")), "line-hits").drop("n")
    owners = hits.groupBy("template").agg(F.min(F.struct("doc_id", "text_key")).getField("text_key").alias("owner"), F.count("*").alias("n"))
    if small:
        return hits.join(F.broadcast(owners.drop("n")), "template")
    return join_counted(hits, materialize(owners, "line-owners"), "template", "n")


def drop_recurring_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_docs_short: int = MIN_DOCS_SHORT, copy_share: float = COPY_SHARE) -> DataFrame:
    """Drop lines whose template recurs across documents, but for the first document that has it.

    docs: any columns, with doc_id and text. Returns the same rows and columns, with the remaining lines as text,
    and n_lines, n_dropped (int; null texts: 0) and dropped_lines (array<int>, from 0, in order). A line stays in
    the documents whose text is that of the smallest doc_id which has the template; null ids come first. A text of
    which more than copy_share of the tokens would go stays whole: it is a copy, for whoever removes
    those; with 1 there is no such exemption. Lines that recur in one document alone stay. Null texts stay null, rows that are repeated are treated
    alike, columns of docs that are named like the three new ones are replaced. A passage of more than 50 tokens that
    recurs goes likewise, wherever lines begin and end, but for up to WINDOW - 1 tokens at each end; a line counts as
    dropped only if it goes whole. No text is shuffled unless the
    lists of dropped lines exceed BROADCAST_BYTES. An empty table gives no rows; very long texts are read whole.
    """
    bounded_batches(docs.sparkSession)
    found = materialize(line_templates(docs), "line-templates")
    gone = (
        recurring_rows(found, min_docs, min_docs_short)
        .where("text_key <> owner")
        .groupBy("doc_id", "text_key")
        .agg(F.array_sort(F.collect_set(F.when(F.col("line") >= 0, F.col("line")))).alias("_gone"), F.collect_set(F.when(F.col("start") >= 0, F.col("start"))).alias("_runs"))
        .select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "_gone", "_runs")
    )
    gone = materialize(gone, "line-drops")
    drop_materialized(found)
    n_bytes = gone.agg(F.sum((F.size("_gone") + F.size("_runs")) * 4 + 80)).first()[0] or 0
    side = F.broadcast(gone) if n_bytes <= BROADCAST_BYTES else gone
    base = docs.drop("n_lines", "n_dropped", "dropped_lines")
    names = base.columns
    spare = "_" * (1 + max(map(len, names)))  # no column of docs starts like that
    joined = base.join(side, base["doc_id"].eqNullSafe(side["_id"]) & (F.xxhash64(base["text"]) == side["_key"]), "left").select(*[base[c] for c in names], side["_gone"].alias(spare + "g"), side["_runs"].alias(spare + "r"))
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n_lines, dropped = [], [], []
            for text, lines, runs in zip(*(batch.column(k).to_pylist() for k in (at, len(names), len(names) + 1))):
                cut: list[int] = []
                if text is None:
                    n_lines.append(0)
                else:
                    n_lines.append(text.count("\n") + 1)
                    if lines or runs:
                        rest, found, n_gone, n = without(text, lines, runs)
                        if n_gone <= copy_share * n:
                            text, cut = rest, found
                texts.append(text)
                dropped.append(cut)
            columns = [batch.column(k) for k in range(len(names))]
            columns[at] = pa.array(texts, columns[at].type)
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(n_lines, pa.int32()), pa.array([len(x) for x in dropped], pa.int32()), pa.array(dropped, pa.list_(pa.int32()))],
                [*names, "n_lines", "n_dropped", "dropped_lines"],
            )

    out = StructType([*base.schema.fields, StructField("n_lines", IntegerType()), StructField("n_dropped", IntegerType()), StructField("dropped_lines", ArrayType(IntegerType()))])
    return joined.mapInArrow(run, out)
