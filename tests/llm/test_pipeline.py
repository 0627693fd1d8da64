import random

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from tests.llm.test_classifiers import junk, prose, toxic  # noqa: E402


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(1)
    path = str(tmp_path_factory.mktemp("data"))
    rows, labels = [], []
    for i in range(400):
        kind = i % 8
        text = toxic(rng) if kind == 0 else junk(rng) if kind == 1 else "\n".join(prose(rng, 40) for _ in range(4))
        rows.append((i, text))
        labels.append((i, int(kind != 1), int(kind == 0)))
    rows += [(1000 + i, rows[2][1]) for i in range(5)] + [(2000, None), (2001, ""), (None, rows[3][1])]
    docs = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, dict(rows[:400]), {i: (q, t) for i, q, t in labels}


def test_stages_take_effect(spark, folder):
    path, texts, labels = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, path)
        assert out.columns == columns
        out.write.parquet(f"{path}/out-{name}")
        docs = spark.read.parquet(f"{path}/out-{name}")
        seen[name] = {r.doc_id: r for r in docs.collect() if r.doc_id is not None}
    clean = [i for i, (q, t) in labels.items() if q and not t]
    assert not [i for i in seen["toxicity"] if i in labels and labels[i][1]]
    assert set(clean) <= set(seen["toxicity"])
    assert not [i for i in seen["quality_classifier"] if i in labels and not labels[i][0]]
    assert len(set(clean) - set(seen["quality_classifier"])) <= 3
    assert all(r.n_chars == len(r.text) for r in seen["line_dedup"].values() if r.text is not None)
    last = seen["simhash_near_dedup"]
    assert 2 in last and not [i for i in last if 1000 <= i < 2000]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, path).collect()
    assert {r.doc_id for r in packed if r.doc_id is not None} == set(last)


def test_run(spark, folder):
    out = corpus_pipeline.run(spark, folder[0])
    assert out.count() > 0 and "sequence_id" in out.columns


def test_rows_of_one_id_and_without_id_have_their_own_classes(spark):
    rng = random.Random(2)
    a, b, c, d = (prose(rng, 60) for _ in range(4))
    rows = [(1, a), (2, b), (2, c), (3, c), (None, d), (None, d), (None, a), (4, None), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(((r.doc_id, r.text) for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()), key=repr)
    assert kept == sorted([(1, a), (2, b), (2, c), (None, d), (4, None)], key=repr)


def test_near_copies_match_brute_force(spark):
    from tests.llm.test_simhash import brute_print, classes

    rng = random.Random(3)
    base = [prose(rng, 300) for _ in range(6)]
    rows = [(rng.choice([None, *range(12)]), base[i % 6] + rng.choice(["", " end", " of"]), {"k": i % 2}, i % 3) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, extra map<string,int>, _row int")
    out = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert out.columns == docs.columns
    root = classes({brute_print(t) for _, t, _, _ in rows}, lambda a, b: (a ^ b).bit_count() <= 3)
    groups = {}
    for i, t, _, _ in rows:
        groups.setdefault(root[brute_print(t)], []).append((i is None, i))
    kept = {}
    for r in out.collect():
        assert (r.doc_id, r.text, r.extra, r._row) in [tuple(x) for x in rows]
        assert kept.setdefault(root[brute_print(r.text)], (r.doc_id is None, r.doc_id)) == (r.doc_id is None, r.doc_id)
    assert {g: min(v, key=lambda x: (x[0], x[1] or 0)) for g, v in groups.items()} == kept and out.count() == len(groups)


def test_stages_on_odd_tables(spark, tmp_path):
    rng = random.Random(4)
    long = "\n".join(prose(rng, 200) for _ in range(300))
    rows = [(1, None, {"a": 1}), (2, "", None), (3, long, {"b": 2}), (3, long, {"b": 2}), (None, " \n ", None), (4, prose(rng, 80), None)]
    schema = "doc_id long, text string, _gone map<string,int>"
    spark.createDataFrame([(i, 1, 0) for i in range(1, 5)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, data in (("odd", rows), ("none", [])):
        docs = spark.createDataFrame(data, schema)
        for step, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, str(tmp_path))
            assert out.columns == docs.columns
            out.write.parquet(f"{tmp_path}/{name}-{step}")
            docs = spark.read.parquet(f"{tmp_path}/{name}-{step}")
        assert (docs.count() > 0) == bool(data)
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
        assert (packed.count() > 0) == bool(data)


def test_plain_session_needs_no_setting(tmp_path):
    import subprocess
    import sys

    code = """
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").getOrCreate()
from sparkloom.llm.sharding import shard
from sparkloom.operators.graphs import clusters
docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
print("rows", shard(docs).count(), clusters(spark.createDataFrame([(1, 2)], "a int, b int"), "a", "b").count())
"""
    import os

    root = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=tmp_path, env={**os.environ, "PYTHONPATH": root}, timeout=300)
    assert "rows 2 2" in run.stdout, run.stderr[-2000:]
