import random
import zlib

import pytest

from sparkloom.llm import sharding
from sparkloom.llm.sharding import Cells, plan_shards, shard


def brute_capacity(sizes, shards):
    def fits(cap):
        used, now = 1, 0
        for s in sizes:
            if s > cap:
                return False
            if now + s > cap:
                used, now = used + 1, 0
            now += s
        return used <= shards

    low = 0
    high = sum(sizes)
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if fits(mid) else (mid + 1, high)
    return low


@pytest.mark.parametrize("seed", range(6))
def test_cells_give_the_minimax(seed):
    rng = random.Random(seed)
    sizes = [rng.randint(1, 2000 if rng.random() < 0.05 else 60) for _ in range(rng.randint(1, 400))]
    cells = Cells([(k, 64, s, 1) for k, s in enumerate(sizes)])
    for shards in (1, 2, 7, 24):
        capacity, ends = cells.cuts(shards)
        assert capacity == brute_capacity(sizes, shards)
        loads = [b - a for a, b in zip([0, *ends], ends)]
        assert ends[-1] == sum(sizes) and min(loads) >= 0 and max(loads) == capacity or max(loads) <= capacity
        assert set(ends) <= {0, *cells.ends}


@pytest.mark.parametrize("cells", [4, 64, 1 << 16])
def test_plan_refines_to_the_exact_result(spark, monkeypatch, cells):
    monkeypatch.setattr(sharding, "CELLS", cells)
    rng = random.Random(cells)
    keys = sorted(rng.getrandbits(64) for _ in range(150)) + [(1 << 64) - 1]
    sizes = [rng.randint(8, 300) if k % 9 else 4000 for k in range(len(keys))]
    frame = spark.createDataFrame([(k - (1 << 64) if k >> 63 else k, s) for k, s in zip(keys, sizes)], "key long, bytes long")
    capacity, firsts = plan_shards(frame, 7)
    assert capacity == brute_capacity(sizes, 7)
    loads = [0] * 7
    for k, s in zip(keys, sizes):
        loads[sum(f <= k for f in firsts)] += s
    assert max(loads) <= capacity


def check(rows, out, shards=24):
    assert len(out) == len(rows)
    by, texts = {}, {}
    for r in out:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values()) and all(0 <= s < shards for s in by)
    want = sorted(((i is None, i or 0), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    assert want == sorted(((r.doc_id is None, r.doc_id or 0), r.size, r.text_crc32) for r in out)
    for r in out:
        texts.setdefault((r.size, r.text_crc32), set()).add(r.shard)
    return by, texts


def test_shard(spark):
    rng = random.Random(1)
    rows = [(i, "".join(rng.choice("abç d") for _ in range(rng.randint(0, 80)))) for i in range(600)]
    rows += [(1000 + i, "the same text " * 3) for i in range(300)] + [(3, "again"), (3, "again"), (None, "x"), (7, ""), (8, "y" * 3000)]
    frame = spark.createDataFrame([(i, t, "c", 1) for i, t in rows], "doc_id long, text string, shard string, size int").repartition(3)
    out = shard(frame).collect()
    by, texts = check(rows, out)
    assert all(len(v) == 1 for v in texts.values())
    small = shard(frame.where("doc_id < 600 AND length(text) < 100")).collect()
    load = {}
    for r in small:
        load[r.shard] = load.get(r.shard, 0) + r.size
    assert len(load) == 24 and max(load.values()) < 1.2 * sum(load.values()) / 24
    assert {r.law for r in out} == {"bytes"} and {r.grown_shard for r in out} == {None}


def test_cases(spark):
    kind = "doc_id long, text string"
    assert shard(spark.createDataFrame([], kind)).count() == 0
    rows = [(1, None), (2, None), (3, "")]
    by, _ = check(rows, shard(spark.createDataFrame(rows, kind)).collect())
    shards = {r.doc_id: r.shard for r in shard(spark.createDataFrame(rows, kind)).collect()}
    assert shards[1] == shards[2] == shards[3]
