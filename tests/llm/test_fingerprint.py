import hashlib
import random
import re
from collections import Counter

from sparkloom.llm.fingerprint import fingerprint_with_neighbours, sample_words

SCHEMA = "doc_id long, text string, fingerprint string, k int"


def jaccard(a, b):
    x, y = (Counter(w for w in re.split("[ \t-\r]+", t or "") if w) for t in (a, b))
    low, high = sum((x & y).values()), sum((x | y).values())
    return low / high if high else 1.0


def run(spark, rows, **kw):
    frame = spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], SCHEMA).repartition(3)
    return fingerprint_with_neighbours(frame, **kw).collect()


def check(rows, out, tolerance=None):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want, errors = {}, []
    for k, (i, t) in enumerate(order):
        after = order[(k + 1) % len(order)][1] or ""
        t = t or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        want.setdefault(i, []).append((len(t), hashlib.sha256(edited.encode()).hexdigest(), jaccard(t, edited), jaccard(t, after)))
    assert len(out) == len(rows)
    for r in out:
        found = [w for w in want[r.doc_id] if w[:2] == (r.n_chars, r.edited_sha256)]
        assert found, (r, want[r.doc_id])
        errors += [min(abs(r.near_edited - w[2]) for w in found), min(abs(r.near_next - w[3]) for w in found)]
    return errors


def test_likeness_estimates_generalised_jaccard(spark):
    rng = random.Random(1)
    words = [f"w{k}" for k in range(60)]
    text = lambda: " ".join(rng.choice(words) if rng.random() < 0.7 else "the" for _ in range(rng.randint(30, 200)))
    rows = [(i * 7, text()) for i in range(300)]
    errors = check(rows, run(spark, rows))
    assert sum(errors) / len(errors) < 0.06 and max(errors) < 0.3


def test_cases(spark):
    rng = random.Random(2)
    words = "á b c d the 日本 x\x1cy".split(" ")
    rows = [(i, " \n\t\r"[i % 4].join(rng.choice(words) for _ in range(rng.randint(0, 9)))) for i in range(40)]
    rows += [(50, None), (51, ""), (52, "  \n "), (53, "same text"), (54, "same text"), (54, "same text"), (54, "other"), (None, "first"), (None, None), (60, "long " * 50000 + "end")]
    out = run(spark, rows)
    check(rows, out)
    prints = {}
    for r in out:
        prints.setdefault(r.doc_id, set()).add(r.fingerprint)
    assert prints[53] <= prints[54] and prints[50] == prints[51] == prints[52]
    assert all(len(r.fingerprint) == len(r.edited_fingerprint) == 256 for r in out)
    assert run(spark, []) == []
    (only,) = run(spark, [(3, "all alone here")])
    assert only.near_next == 1.0


def test_no_python_on_the_main_path(spark):
    frame = spark.createDataFrame([(1, "a b", "x", 1)], SCHEMA)
    plan = fingerprint_with_neighbours(frame)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_weights_count(spark):
    rows = [(1, "a " * 10 + "b"), (2, "a b"), (3, "a " * 10 + "b b"), (4, "a " * 20 + "b b")]
    frame = spark.createDataFrame(rows, "id long, text string")
    got = {r.id: [r.fingerprint[k : k + 4] for k in range(0, 256, 4)] for r in sample_words(frame, ["id"]).collect()}
    like = lambda a, b: sum(x == y for x, y in zip(got[a], got[b])) / 64
    assert abs(like(1, 2) - 2 / 11) < 0.2 and abs(like(1, 3) - 11 / 12) < 0.2 and abs(like(3, 4) - 12 / 22) < 0.25


def test_pruned_samples_are_those_of_the_whole_sampler(spark):
    rng = random.Random(4)
    words = [f"w{k}" for k in range(400)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 600)))) for i in range(60)]
    frame = spark.createDataFrame(rows, "id long, text string")
    got = lambda bound: {r.id: r.fingerprint for r in sample_words(frame, ["id"], bound=bound).collect()}
    assert got(20.0) == got(None)
