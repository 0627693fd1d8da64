"""Bounded-space online packing of token sequences into windows of fixed length."""

from __future__ import annotations

import bisect
import zlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.bpe import PRE_TOKEN, ByteBpe
from sparkloom.llm.common import bounded_batches, materialize

WINDOW = 1024
OPEN = 128
#: Partitions whose leftover windows are merged in one task: at most MERGED * OPEN windows.
MERGED = 64

#: Texts of more code points are encoded by the segment tree, whose time does not grow with the square of a run.
LONG_TEXT = 200_000

_coders: dict[str, tuple[ByteBpe, tiktoken.Encoding]] = {}


def _ids(path: str, text: str) -> bytes:
    """The text's ids as little-endian unsigned 32-bit numbers; strings of special tokens become their ids."""
    if path not in _coders:
        bpe = ByteBpe(path)
        special = set(bpe.special.values())
        ranks = {b: i for i, b in bpe.token_bytes.items() if i not in special}
        _coders[path] = bpe, tiktoken.Encoding(path, pat_str=PRE_TOKEN, mergeable_ranks=ranks, special_tokens=bpe.special)
    bpe, library = _coders[path]
    ids = bpe.encode(text) if len(text) > LONG_TEXT else library.encode(text, allowed_special="all")
    return array("I", ids).tobytes()


class OpenWindows:
    """At most `most` windows of `size`, with best-fit placing.

    place() puts a piece into the fullest window that holds it, else opens a new one; if `most` are open, the
    fullest is emitted first. Windows are (free, number) pairs in order, so each step is a binary search.
    """

    def __init__(self, size: int, most: int):
        self.size, self.most, self.open, self.opened = size, most, [], 0

    def place(self, length: int) -> tuple[int, int, int | None]:
        """(window, offset, emitted window or None)."""
        gone = None
        at = bisect.bisect_left(self.open, (length, -1))
        if at < len(self.open):
            free, window = self.open.pop(at)
        else:
            if len(self.open) >= self.most:
                gone = self.open.pop(0)[1]
            free, window = self.size, self.opened
            self.opened += 1
        if free > length:
            bisect.insort(self.open, (free - length, window))
        return window, self.size - free, gone


def pack(docs: DataFrame, vocabulary: str, window: int = WINDOW, most_open: int = OPEN, end_id: int = 0) -> DataFrame:
    """Pack the ids of each text, followed by end_id, into sequences of at most `window` ids.

    Texts of a window or more are cut: the full parts each fill a sequence, the rest is placed. Each partition
    keeps most_open windows; what is still open at its end is merged with other partitions' windows, MERGED
    partitions at a time, by the same rule.

    docs: doc_id, text, further columns are not read. Returns a row for each piece: doc_id, start, length,
    ids_crc32, doc_tokens, sequence_id, offset (all long but doc_id). A null or empty text has one id, end_id.
    Rows with equal or null ids are packed each on its own. An empty table gives no rows. The pieces are written
    once to the shared folder, so that the merge never tokenises again.
    """
    spark = docs.sparkSession
    bounded_batches(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid = TaskContext.get().partitionId()
        end = end_id.to_bytes(4, "little")
        held = OpenWindows(window, most_open)
        full = 0
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "full_no", "window_no", "offset", "pid"]
        for batch in batches:
            cols: list[list] = [[] for _ in names]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = _ids(vocabulary, text or "") + end
                total = len(data) // 4
                for start in range(0, total, window):
                    length = min(window, total - start)
                    crc = zlib.crc32(data[4 * start : 4 * (start + length)])
                    if length == window:
                        row = (doc_id, start, length, crc, total, full, None, 0, pid)
                        full += 1
                    else:
                        w, offset, _ = held.place(length)
                        row = (doc_id, start, length, crc, total, None, w, offset, pid)
                    for c, v in zip(cols, row):
                        c.append(v)
            id_type = batch.schema.field(0).type
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], id_type), *(pa.array(c, pa.int64()) for c in cols[1:])], names)
        if held.open:  # a row for each window that is left: start -1, its fill as length
            rows = [(None, -1, window - free, 0, 0, None, w, 0, pid) for free, w in held.open]
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], id_type), *(pa.array(c, pa.int64()) for c in cols[1:])], names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    pieces = materialize(
        docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, full_no long, window_no long, offset long, pid long"),
        "pack-pieces",
    )
    left = pieces.where("start = -1").select("pid", "window_no", F.col("length").alias("fill"))
    moved = merge_windows(left, window, most_open)
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    own = lambda n: F.col("pid") * F.lit(1 << 32) + F.col(n)
    whole = pieces.where("full_no IS NOT NULL").select(*columns, (own("full_no") * 4).alias("sequence_id"), "offset")
    placed = pieces.where("window_no IS NOT NULL AND start >= 0").join(moved, ["pid", "window_no"], "left")
    shared = placed.select(
        *columns,
        F.coalesce(F.col("merged_id") * 4 + 2, own("window_no") * 4 + 1).alias("sequence_id"),
        (F.coalesce("base", F.lit(0)) + F.col("offset")).cast("long").alias("offset"),
    )
    return whole.unionByName(shared)


def merge_windows(fills: DataFrame, window: int, most_open: int) -> DataFrame:
    """Join left windows (pid, window_no, fill) that fit together, fullest first; gives pid, window_no, merged_id, base.

    A group of MERGED partitions is one task's share, at most MERGED * most_open windows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, group = None, None
        for batch in batches:
            g, pid, no, fill = (batch.column(i).to_pylist() for i in range(4))
            ids, bases = [], []
            for k in range(len(g)):
                if g[k] != group:
                    group, held = g[k], OpenWindows(window, most_open)
                w, offset, _ = held.place(fill[k])
                ids.append(group << 40 | w)
                bases.append(offset)
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(ids, pa.int64()), pa.array(bases, pa.int64())], ["pid", "window_no", "merged_id", "base"])

    grouped = fills.select((F.floor(F.col("pid") / MERGED)).cast("long").alias("g"), "pid", "window_no", "fill")
    dealt = grouped.repartition("g").sortWithinPartitions("g", F.desc("fill"), "pid", "window_no")
    return dealt.mapInArrow(run, "pid long, window_no long, merged_id long, base long")
