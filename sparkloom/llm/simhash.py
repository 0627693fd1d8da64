"""SimHash near-duplicates: fingerprints, segment-popcount candidates, exact links, components.

A 64-bit fingerprint is embedded as the bit counts of its 32 two-bit segments, written as a thermometer code
(00, 01, 11), so that the Manhattan distance of two embeddings is the number of bits in which their codes differ.
It never exceeds the Hamming distance. The segments are dealt to blocks; of fingerprints at Hamming distance 3 or
less, all counts agree but in three blocks at most. The grid has a cell for each choice of three blocks that are
left out and each value of the other counts; fingerprints that share a cell are compared, first by Manhattan
distance, then exactly. The more fingerprints there are, the more blocks the segments are dealt to, so that a cell
holds fewer segments' worth of chance neighbours: the number of compared pairs grows about as the input does.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import bounded_batches, drop_materialized, join_counted, materialize
from sparkloom.llm.components import components

SHINGLE = 3
DISTANCE = 3
#: Cells with more fingerprints are not paired; their members are linked through balls, which no size limits.
CELL_MOST = 2048
#: (blocks, fingerprints up to which they are used): the cells then hold a quarter of another fingerprint each by chance, as
#: a two-bit segment's count has 1.4 bits of collision entropy.
BLOCKS = [(6, 1_500_000), (8, 80_000_000), (12, 1_500_000_000), (16, 1 << 62)]
SEGMENTS = 32

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(data: bytes, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a UTF-8 text: words lower-cased in A-Z only, shingles hashed by XXH64 with seed 42.

    Bit counts are summed 8192 shingles at a time, so that a very long text needs little memory.
    """
    words = data.translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    if n == 1:
        return digest(joined, 42)
    starts, at = [], 0
    for w in words:
        starts.append(at)
        at += len(w) + 1
    ends = [s - 1 for s in starts[shingle:]] + [len(joined)]
    counts = np.zeros(64, np.int64)
    for k in range(0, n, 8192):
        hashes = np.array([digest(joined[s:e], 42) for s, e in zip(starts[k : k + 8192], ends[k : k + 8192])], ">u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and fp (the fingerprint's 64 bits as a signed long) for each row; a null text counts as empty: 0."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            found = [fingerprint(t or b"", shingle) for at in range(0, len(texts), 64) for t in texts.slice(at, 64).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(found, np.uint64).view(np.int64))], ["doc_id", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fp long")


_ODD = 0x5555555555555555


def thermometer(fp: Column) -> Column:
    """The embedding: each two-bit segment's count as 00, 01 or 11."""
    high = F.shiftrightunsigned(fp, 1)
    any_bit = fp.bitwiseOR(high).bitwiseAND(F.lit(_ODD))
    both = fp.bitwiseAND(high).bitwiseAND(F.lit(_ODD))
    return any_bit.bitwiseOR(F.shiftleft(both, 1))


def block_masks(blocks: int) -> list[int]:
    """The bits of each block's segments; sizes differ by one at most."""
    cuts = [SEGMENTS * k // blocks for k in range(blocks + 1)]
    return [sum(3 << (2 * j) for j in range(a, b)) for a, b in zip(cuts, cuts[1:])]


def cells(distinct: DataFrame, blocks: int, distance: int = DISTANCE) -> DataFrame:
    """(fp, code, cell, gaps): the grid cells of each fingerprint; gaps has a bit for each block that is left out."""
    masks = block_masks(blocks)
    every = []
    for left in combinations(range(blocks), distance):
        gaps = sum(1 << k for k in left)
        kept = ((1 << 64) - 1) ^ sum(masks[k] for k in left)
        cell = F.xxhash64(F.col("code").bitwiseAND(F.lit(_signed(kept))), F.lit(gaps))
        every.append(F.struct(cell.alias("cell"), F.lit(gaps).alias("gaps")))
    embedded = distinct.select("fp", thermometer(F.col("fp")).alias("code"))
    return embedded.select("fp", "code", F.explode(F.array(*every)).alias("c")).select("fp", "code", "c.cell", "c.gaps")


def _first_gaps(diff: Column, blocks: int, distance: int) -> Column:
    """The gaps of one of the cells that two fingerprints with code difference `diff` share: the blocks in which they
    differ, and the first others."""
    gaps = reduce(lambda x, y: x.bitwiseOR(y), [F.when(diff.bitwiseAND(F.lit(_signed(m))) != 0, 1 << k).otherwise(0) for k, m in enumerate(block_masks(blocks))])
    for _ in range(distance):
        gaps = F.when(F.bit_count(gaps) < distance, gaps.bitwiseOR(gaps + 1)).otherwise(gaps)
    return gaps


def links(distinct: DataFrame, distance: int = DISTANCE, cell_most: int = CELL_MOST, blocks: int | None = None) -> DataFrame:
    """Edges (a, b) between different fingerprints whose components are those of all pairs within `distance`.

    Pairs of a cell with at most cell_most members are compared in a self-join that returns each true pair once.
    Members of fuller cells are, instead, linked through the balls of radius 1 and 2 around them: two fingerprints
    are within 3 exactly if a point lies in one's ball of radius 1 and the other's of radius 2, so linking all that
    meet at such a point to one of them gives the same components with a number of rows in proportion. blocks: of
    the segments, by default as the number of fingerprints asks for; the links are the same for any.
    """
    if not 0 <= distance <= 3:
        raise ValueError("the balls are exact up to a distance of 3")
    if blocks is None:
        n = distinct.count()
        blocks = next(b for b, most in BLOCKS if n <= most)
    emitted = cells(distinct, blocks, distance)
    counted = materialize(emitted.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1"), "simhash-cells")
    shared = materialize(emitted.join(counted, "cell"), "simhash-shared")
    usual = shared.where(F.col("n") <= cell_most)
    x, y = usual.alias("x"), usual.alias("y")
    diff = F.col("x.code").bitwiseXOR(F.col("y.code"))
    near = (
        (F.col("x.cell") == F.col("y.cell"))
        & (F.col("x.gaps") == F.col("y.gaps"))
        & (F.col("x.fp") < F.col("y.fp"))
        & (F.bit_count(diff) <= distance)
        & (F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp"))) <= distance)
        & (_first_gaps(diff, blocks, distance) == F.col("x.gaps"))
    )
    pairs = x.join(y, near).select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))
    if counted.where(F.col("n") > cell_most).head(1):
        dense = materialize(shared.where(F.col("n") > cell_most).select("fp").distinct(), "simhash-dense")
        pairs = pairs.unionByName(ball_links(dense, distance))
    found = materialize(pairs, "simhash-links")
    drop_materialized(counted, shared)
    return found


def ball_links(dense: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Star edges (a, b) that connect all fingerprints of `dense` within `distance`, without pairing them."""
    inner = distance // 2
    flips = [F.lit(0).cast("long")] + [F.lit(_signed(1 << i)) for i in range(64)]
    one = F.explode(F.array(*flips))
    near = dense.select("fp", one.alias("f1")).select("fp", F.col("fp").bitwiseXOR(F.col("f1")).alias("point"), (F.col("f1") != 0).cast("int").alias("d"))
    points = near if distance < 3 else near.unionByName(
        dense.select("fp", F.posexplode(F.array(*flips[1:])).alias("i", "f1"))
        .select("fp", "i", "f1", F.posexplode(F.array(*flips[1:])).alias("j", "f2"))
        .where("i < j")
        .select("fp", F.col("fp").bitwiseXOR(F.col("f1")).bitwiseXOR(F.col("f2")).alias("point"), F.lit(2).alias("d"))
    )
    if distance == 0:
        return dense.select(F.col("fp").alias("a"), F.col("fp").alias("b")).where("a <> b")
    if distance == 1:  # both ends of a pair one bit apart meet at either end
        at = near.groupBy("point").agg(F.min("fp").alias("least"), F.max(F.when(F.col("d") == 0, F.col("fp"))).alias("centre"))
        return near.join(at.where("centre IS NOT NULL"), "point").where("fp <> centre").select(F.col("fp").alias("a"), F.col("centre").alias("b"))
    centre = points.groupBy("point").agg(F.min(F.when(F.col("d") <= inner, F.col("fp"))).alias("centre"), F.count("*").alias("n"))
    return points.join(centre.where("centre IS NOT NULL AND n > 1"), "point").where("fp <> centre").select(F.col("fp").alias("a"), F.col("centre").alias("b"))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, cell_most: int = CELL_MOST) -> DataFrame:
    """The near-duplicate class of each document.

    docs: doc_id, text, further columns are not read. Returns doc_id, fp long, component_id: one row for each row
    of docs; component_id is the smallest doc_id of the class (null if all its ids are null). Null, empty and
    blank texts have fingerprint 0, linked like any other. Exact copies are one fingerprint before any pairing;
    repeated rows are rows of one class. Very long texts are hashed whole.
    An empty table gives no rows. Fingerprints and links are written to the shared folder.
    """
    prints = materialize(fingerprints(docs, shingle), "simhash-prints")
    own = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("own"), F.count("*").alias("n")), "simhash-distinct")
    near = links(own.select("fp"), distance, cell_most)
    comps = components(near, "a", "b")
    linked = materialize(comps.withColumnRenamed("node", "fp").join(own, "fp"), "simhash-linked")
    drop_materialized(near)
    smallest = materialize(linked.groupBy("root").agg(F.min("own").alias("component"), F.count("*").alias("m")), "simhash-smallest")
    named = join_counted(linked, smallest, "root", "m").select("fp", "component")
    classes = materialize(own.join(named, "fp", "left").select("fp", F.coalesce("component", "own").alias("component_id"), "n"), "simhash-classes")
    drop_materialized(linked, smallest, own)
    return join_counted(prints, classes, "fp", "n").select("doc_id", "fp", "component_id")
