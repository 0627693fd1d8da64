"""Queries without SQL against brute force over every row of their table."""

import os
import random
from collections import defaultdict

import duckdb
import pytest

from sparkloom.plans.join_queries import cosine_topk, monotone_run, nms_boxes
from sparkloom.plans.registry import ORACLE

FOLDER = "/root/testdata/sf0.001"

@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no data folder")
def test_nms_boxes_reads_every_line_item(spark):
    lines = duckdb.sql(f"SELECT l_orderkey, l_linenumber, l_quantity, l_tax, l_extendedprice FROM '{FOLDER}/lineitem.parquet'").fetchall()
    images = defaultdict(list)
    for k, n, q, t, p in lines:
        images[k // 100].append((-float(p), k * 10 + n, float(q) * 4, float(t) * 1000))
    want = set()
    for image, boxes in images.items():
        kept = []
        for _, box, x, y in sorted(boxes):
            sides = [(min(x + 60, c + 60) - max(x, c), min(y + 40, d + 40) - max(y, d), min((x + 60 - x) * (y + 40 - y), (c + 60 - c) * (d + 40 - d))) for _, c, d in kept]
            if not any(w > 0 and h > 0 and w * h / area >= 0.65 for w, h, area in sides):
                kept.append((box, x, y))
        want |= {(image, box) for box, _, _ in kept}
    got = {(r.image, r.box_id) for r in nms_boxes(spark, FOLDER).collect()}
    assert got == want


def test_monotone_run_reads_every_user(spark, tmp_path):
    rng = random.Random(1)
    events = [(u, 100 * u + k, float(rng.randrange(30))) for u in range(40) for k in range(30)]
    spark.createDataFrame(events, "user_id long, event_id long, value double").write.parquet(f"{tmp_path}/events.parquet")
    want = {}
    for u in range(40):
        best = []
        for _, _, v in (e for e in events if e[0] == u):
            best.append((1 + max((n for n, w in best if w < v), default=0), v))
        want[u] = max(n for n, _ in best)
    assert {r.user_id: r.n for r in monotone_run(spark, str(tmp_path)).collect()} == want


def against_sql(name, query, spark, folder, table):
    """The query's rows and those of its SQL, over the one table in folder."""
    df = query(spark, str(folder))
    con = duckdb.connect()
    con.execute(f"create view {table} as select * from '{folder}/{table}.parquet/*.parquet'")
    return sorted(map(tuple, df.collect())), sorted(con.execute(f"select {', '.join(df.columns)} from ({ORACLE[name]})").fetchall())


def test_cosine_topk_of_vectors_that_are_multiples(spark, tmp_path):
    rng = random.Random(5)
    base = [[rng.uniform(-1, 1) for _ in range(8)] for _ in range(5)]
    rows = [(i, [(1 + i // 5) * v for v in base[i % 5]], 0) for i in range(400)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    got, want = against_sql("cosine_topk", cosine_topk, spark, tmp_path, "embeddings")
    assert got == want and len(got) == 240
