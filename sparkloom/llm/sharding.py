"""Minimax contiguous partition of atomic groups into shards."""

from __future__ import annotations

import bisect

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import materialize

SHARDS = 24
ROW_BYTES = 8
#: Most cells of the key range that the driver holds after one refinement, beside those it already has.
CELLS = 1 << 16
_BITS = 64


class Cells:
    """Consecutive ranges of the group key with the bytes in each; the driver's view of the ordered groups.

    Positions are bytes before a place. Boundaries between groups are known at the ends of cells; inside a cell of
    more than one group they are not, and a cell of which one is asked for is put down in `wanted`.
    """

    def __init__(self, rows: list[tuple[int, int, int, int]]):
        """rows: (first key, bits, bytes, groups) in key order; `bits` is the length of the range's prefix."""
        self.rows = rows
        self.ends, total = [], 0
        for r in rows:
            total += r[2]
            self.ends.append(total)
        self.total = total
        self.wanted: set[int] = set()

    def floor(self, x: int) -> int:
        """The last known boundary at or before x."""
        if x >= self.total:
            return self.total
        k = bisect.bisect_right(self.ends, x)
        start = self.ends[k] - self.rows[k][2]
        if start < x and self.rows[k][3] > 1:
            self.wanted.add(k)
        return start

    def ceil(self, x: int) -> int:
        """The first known boundary at or after x."""
        if x <= 0:
            return 0
        k = bisect.bisect_left(self.ends, x)
        if self.ends[k] > x and self.rows[k][3] > 1:
            self.wanted.add(k)
        return self.ends[k]

    def reach(self, capacity: int, shards: int) -> list[int]:
        """Greedy check: the boundary after each shard if all take as many groups as the capacity allows."""
        at, out = 0, []
        for _ in range(shards):
            at = self.floor(at + capacity)
            out.append(at)
        return out

    def smallest_capacity(self, shards: int) -> int:
        """Binary search for the smallest capacity whose greedy check places all groups."""
        low, high = -(-self.total // shards), self.total
        while low < high:
            mid = (low + high) // 2
            if self.reach(mid, shards)[-1] == self.total:
                high = mid
            else:
                low = mid + 1
        return low

    def cuts(self, shards: int) -> tuple[int, list[int]]:
        """The capacity and the boundary after each shard: within the capacity, as near to equal parts as can be."""
        capacity = self.smallest_capacity(shards)
        latest = self.reach(capacity, shards)
        earliest, at = [self.total] * shards, self.total
        for k in range(shards - 2, -1, -1):
            at = earliest[k] = self.ceil(at - capacity)
        out, at = [], 0
        for k in range(shards - 1):
            most = min(latest[k], self.floor(at + capacity))
            want = min(max(self.total * (k + 1) // shards, earliest[k], at), most)
            below, above = max(self.floor(want), min(at, most)), self.ceil(want)
            at = above if above <= most and above - want < want - below or below < earliest[k] else below
            out.append(at)
        return capacity, [*out, self.total]

    def key_after(self, position: int) -> int | None:
        """The first key of the cell that starts at a boundary; None at the end."""
        if position >= self.total:
            return None
        return self.rows[bisect.bisect_right(self.ends, position)][0]


def _prefix(key: Column, bits: int) -> Column:
    return F.shiftrightunsigned(key, _BITS - bits) if bits else F.lit(0).cast("long")


def _unsigned(x: int) -> int:
    return x & (1 << _BITS) - 1


def plan_shards(groups: DataFrame, shards: int) -> tuple[int, list[int]]:
    """(capacity, first unsigned key of shards 1, 2, ...) for groups(key long, bytes long, in key order unsigned).

    The driver first sees the bytes of CELLS prefix ranges of the key. The search runs on those; where it needs a
    boundary inside a range of more than one group, those ranges are split further by one aggregation, and it
    runs again. The result is that of a search over all groups, while the driver holds a bounded number of sums.
    """
    bits = CELLS.bit_length() - 1
    first = groups.groupBy(_prefix(F.col("key"), bits).alias("p")).agg(F.sum("bytes").alias("b"), F.count("*").alias("n")).collect()
    rows = sorted((_unsigned(r.p) << (_BITS - bits), bits, r.b, r.n) for r in first)
    if not rows:
        return 0, []
    while True:
        cells = Cells(rows)
        capacity, ends = cells.cuts(shards)
        wanted = sorted(cells.wanted)
        if not wanted:
            return capacity, [k for k in (cells.key_after(e) for e in ends[:-1]) if k is not None]
        more = max(1, (CELLS // len(wanted)).bit_length() - 1)
        spark = groups.sparkSession
        split = None
        for depth in sorted({rows[k][1] for k in wanted}):
            own = [rows[k][0] >> (_BITS - depth) for k in wanted if rows[k][1] == depth]
            finer = min(_BITS, depth + more)
            signed = [(p - (1 << _BITS) if p >> (_BITS - 1) else p,) for p in own]
            part = (
                groups.withColumn("p0", _prefix(F.col("key"), depth))
                .join(F.broadcast(spark.createDataFrame(signed, "p0 long")), "p0", "left_semi")
                .groupBy(_prefix(F.col("key"), finer).alias("p"))
                .agg(F.sum("bytes").alias("b"), F.count("*").alias("n"))
                .withColumn("bits", F.lit(finer))
            )
            split = part if split is None else split.unionByName(part)
        gone = set(wanted)
        rows = [r for k, r in enumerate(rows) if k not in gone]
        rows += [(_unsigned(r.p) << (_BITS - r.bits), r.bits, r.b, r.n) for r in split.collect()]
        rows.sort()


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Put documents into contiguous shards of nearly equal bytes, equal texts together.

    docs: doc_id, text, further columns are not read. The size of a row is its text's UTF-8 bytes (null: none)
    plus ROW_BYTES. Groups are the rows of equal text, null counting as empty, in the order of a 64-bit hash
    of the text (texts of one hash share a group). The smallest capacity for which `shards` contiguous runs of
    groups suffice is found by binary search; the cuts keep to it and lie as near to equal parts as they can, so a
    shard exceeds it never, and only a group that is itself larger than an equal part makes shards uneven.

    Returns doc_id, size long, text_crc32 long, law 'bytes', shard int, slot long (gapless from 0 in each shard),
    grown_shard int (null): a row for each row of docs, repeated rows and null ids included. An empty table gives
    no rows. The plan needs sums of key ranges on the driver, whose number is bounded; no text is shuffled.
    """
    text = F.coalesce("text", F.lit(""))
    rows = materialize(
        docs.select(
            "doc_id",
            (F.octet_length(text) + F.lit(ROW_BYTES)).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("key"),
        ),
        "shard-rows",
    )
    groups = materialize(rows.groupBy("key").agg(F.sum("size").alias("bytes"), F.count("*").alias("copies")), "shard-groups")
    _, keys = plan_shards(groups, shards)
    # Unsigned order is signed order with the top bit flipped.
    flip = lambda k: k ^ (1 << 63)
    top = -(1 << 63)
    place = F.lit(0)
    for k in keys:
        first = flip(k)
        first = first - (1 << 64) if first >> 63 else first
        place = place + F.when(F.col("key").bitwiseXOR(F.lit(top)) >= F.lit(first), 1).otherwise(0)
    total = groups.agg(F.sum("copies")).first()[0] or 0
    parts = max(8, min(4096, -(-total // (shards * 20_000))))
    # A slot is the rank in a part of the shard, dealt by a hash of the row and so evenly, after all parts before.
    dealt = rows.withColumn("shard", place.cast("int")).withColumn("part", F.pmod(F.xxhash64("doc_id", "key"), F.lit(parts)).cast("int"))
    counts = dealt.groupBy("shard", "part").agg(F.count("*").alias("n")).collect()  # at most shards * parts rows
    before: dict[int, int] = {}
    starts = []
    for r in sorted(counts, key=lambda r: (r.shard, r.part)):
        starts.append((r.shard, r.part, before.get(r.shard, 0)))
        before[r.shard] = before.get(r.shard, 0) + r.n
    offsets = F.broadcast(docs.sparkSession.createDataFrame(starts, "shard int, part int, base long"))
    from pyspark.sql import Window

    order = Window.partitionBy("shard", "part").orderBy("key", "doc_id")
    return (
        dealt.withColumn("rank", F.row_number().over(order))
        .join(offsets, ["shard", "part"])
        .select(
            "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
            (F.col("base") + F.col("rank") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        )
    )
