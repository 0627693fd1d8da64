import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from sparkloom.llm import quality as Q
from sparkloom.llm import rules as R
from sparkloom.llm import toxicity as X

WORDS = "the of and a to in that it is was river stone light garden window letter morning paper street music".split()
BAD = ["grobnik", "slurtag", "vexhole"]
SCHEMA = "doc_id long, text string, score double, quality int"


def prose(rng, n=None):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "er", "ing", ","]) for _ in range(n or rng.randint(40, 120)))


def toxic(rng):
    words = prose(rng).split()
    for _ in range(rng.randint(2, 4)):
        words.insert(rng.randrange(len(words)), rng.choice(BAD))
    return " ".join(words)


def junk(rng):
    return " ".join(w + "***" for w in prose(rng).split()) if rng.random() < 0.5 else " ".join([prose(rng, 12).upper() + "!!"] * 6)


def frames(spark, rows, label):
    docs = spark.createDataFrame([(i, t, 0.5, 7) for i, t, _ in rows], SCHEMA).repartition(3)
    labels = spark.createDataFrame([(i, y, "x") for i, _, y in rows if y is not None], f"doc_id long, {label} int, text string")
    return docs, labels


def auc(pairs):
    pos, neg = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / len(pos) / len(neg)


ODD = [(9001, None, None), (9002, "", None), (9003, " \n", None), (None, "no id", None), (9004, "x" * 200_000, None), (9005, "same", None), (9005, "same", None)]


def test_toxicity_on_held_out_rows(spark):
    rng = random.Random(1)
    rows = [(i, toxic(rng) if i % 4 == 0 else prose(rng), int(i % 4 == 0)) for i in range(500)]
    docs, labels = frames(spark, [*rows, *ODD], "toxic")
    out = X.toxicity(docs, labels).collect()
    truth = {i: y for i, _, y in rows}
    assert len(out) == len(rows) + len(ODD) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    held = [(r.score, truth[r.doc_id]) for r in out if r.held_out and r.doc_id in truth]
    assert len(held) > 50 and auc(held) > 0.97 and not any(s >= 0.5 for s, y in held if not y)
    kept = {r.doc_id for r in X.reject_toxic(docs, labels).collect()}
    assert kept == {r.doc_id for r in out if not r.predicted}
    assert X.reject_toxic(docs, labels).columns == docs.columns


def test_toxicity_does_not_learn_held_out_labels(spark):
    rng = random.Random(2)
    rows = [(i, toxic(rng) if i % 4 == 0 else prose(rng), int(i % 4 == 0)) for i in range(200)]
    docs, labels = frames(spark, rows, "toxic")
    from sparkloom.llm.common import id_crc
    from pyspark.sql import functions as F

    flipped = labels.withColumn("toxic", F.when(id_crc("doc_id") % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    key = lambda df: sorted((r.doc_id, r.score) for r in df.collect())
    assert key(X.toxicity(docs, labels)) == key(X.toxicity(docs, flipped))


def test_quality_on_held_out_rows(spark):
    rng = random.Random(3)
    rows = [(i, junk(rng) if i % 5 == 0 else prose(rng), int(i % 5 > 0)) for i in range(500)]
    docs, labels = frames(spark, [*rows, *ODD], "quality")
    out = Q.quality(docs, labels).collect()
    truth = {i: y for i, _, y in rows}
    assert len(out) == len(rows) + len(ODD) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in out)
    held = [(r.score, truth[r.doc_id]) for r in out if r.held_out and r.doc_id in truth]
    assert len(held) > 80 and auc(held) > 0.97
    kept = {r.doc_id for r in Q.keep_good(docs, labels).collect()}
    assert len(kept ^ {r.doc_id for r in out if r.predicted}) <= 3


@pytest.mark.parametrize("labels", [[], [(1, 1), (2, 1), (3, 1)], [(1, None), (2, 0), (3, 1), (3, 0)]])
def test_few_labels(spark, labels):
    docs = spark.createDataFrame([(1, "a b c", 0.0, 1), (2, "d", 0.0, 1), (3, None, 0.0, 1)], SCHEMA)
    lab = spark.createDataFrame(labels, "doc_id long, quality int")
    assert all(0 <= r.score <= 1 for r in Q.quality(docs, lab).collect())
    assert all(0 <= r.score <= 1 for r in X.toxicity(docs, lab.withColumnRenamed("quality", "toxic")).collect())
    assert R.quality_rules(docs, lab).count() == 3
    empty = docs.limit(0)
    assert Q.quality(empty, lab).count() == X.toxicity(empty, lab.withColumnRenamed("quality", "toxic")).count() == R.quality_rules(empty, lab).count() == 0


def test_isotonic_and_fourier():
    points, values = Q.isotonic([(0, 1, 0), (1, 1, 1), (2, 1, 0), (3, 2, 2)])
    assert values == [0.0, 0.5, 1.0] and points == [0, 1.5, 3]
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, Q.STATISTICS)) / 2
    model = Q.QualityModel([0.0] * Q.STATISTICS, [1.0] * Q.STATISTICS)
    phi = model.fourier(x)[:, :-1]
    want = np.exp(-Q.GAMMA * ((x[:, None] - x[None]) ** 2).sum(axis=2))
    assert np.abs(phi @ phi.T - want).mean() < 0.1


def brute_counts(text):
    words = [w for w in re.split("[ \t-\r]+", text) if w]
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search("[^ \t-\r]", line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), dup, len(covered)


def test_base_counts_match_brute_force():
    rng = random.Random(5)
    parts = ["a", "bé", "日本", "#", "<x>", " ", "\n", "\t", "\x0b", "\xa0", "\x1c", "a a a ", "\n\n", "a\n"]
    for _ in range(400):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 60)))
        assert R.base_counts(text.encode()) == brute_counts(text), text


def test_rules_verdict(spark):
    rng = random.Random(6)
    rows = [(i, junk(rng) if i % 3 == 0 else prose(rng, 80), int(i % 3 > 0)) for i in range(300)]
    docs, labels = frames(spark, [*rows, *ODD], "quality")
    out = R.quality_rules(docs, labels).collect()
    truth = {i: y for i, _, y in rows}
    for r in out:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)
    assert all(r.kept == bool(truth[r.doc_id]) for r in out if r.doc_id in truth and not r.base_failed)
    assert len(out) == len(rows) + len(ODD)


def test_word_hashes_do_not_depend_on_place():
    one, two = R.ngram_features(b"alpha beta alpha"), R.ngram_features(b"  alpha  beta   alpha")
    words = slice(3 * R.BUCKETS, 5 * R.BUCKETS)
    assert np.allclose(one[words], two[words])


def brute_features(model, data):
    """Every window compressed or passed over by itself."""
    words = data.lower().split()
    words = [w[k : k + 64] for w in words for k in range(0, len(w), 64)]
    last = max(0, len(words) - X.SPAN)
    starts = [*range(0, last, X.STEP), last] if words else []
    found = []
    for k in starts:
        w = b" " + b" ".join(words[k : k + X.SPAN]) + b" "
        lacks = any(w[i:j] in model.toxic and w[i:j] not in model.ordinary for i in range(len(w)) for j in range(i + X.GRAM, len(w) + 1))
        found.append(len(X.compressor(model.ordinary).compress(X.FRAME + w)) - len(X.compressor(model.toxic + model.ordinary).compress(X.FRAME + w)) if lacks else 0)
    large = [d for d in found if d >= X.SAVED]
    return [max(large, default=0), np.log1p(len(large)), np.log1p(sum(large)), np.log1p(len(found))]


def test_toxic_features_match_brute_force():
    rng = random.Random(7)
    model = X.ToxicModel(b" grobnik  slurtag o vexhole", b" the of and that grob nik slur low er iot" * 2)
    vocabulary = "the of and that grobnik SLURTAG vexhole grob niks x slur tag".split() + ["é" * 50]
    for n in [0, 1, 2, 3, 4, 5, 6, 7, 9, 20] * 6:
        text = " ".join(rng.choice(vocabulary) for _ in range(n)).encode()
        assert np.allclose(model.features(text), brute_features(model, text)), text


def test_long_and_equal_texts_and_ties(spark):
    rng = random.Random(8)
    rows = [(i, toxic(rng) if i % 4 == 0 else prose(rng), int(i % 4 == 0)) for i in range(200)]
    long = (prose(rng, 200_000), "x" * 3_000_000, prose(rng, 3000) + " grobnik slurtag vexhole " * 40)
    rows += [(1000 + i, t, None) for i, t in enumerate(long)] + [(2000, rows[0][1], None)]
    docs, labels = frames(spark, rows, "toxic")
    out = {r.doc_id: r for r in X.toxicity(docs, labels).collect()}
    assert len(out) == len(rows) and out[0].score == out[2000].score
    least = out[0].score
    assert {r.predicted for r in X.toxicity(docs, labels, threshold=least).collect() if r.doc_id in (0, 2000)} == {1}


def test_quality_weights_solve_the_normal_equations(spark):
    rng = random.Random(9)
    rows = [(i, junk(rng) if i % 5 == 0 else prose(rng), int(i % 5 > 0)) for i in range(240)]
    docs, labels = frames(spark, rows, "quality")
    model = Q.train(Q.document_statistics(docs), labels)
    used = [(t, y) for i, t, y in rows if zlib.crc32(str(i).encode()) % 4 != 2]
    x, y = np.array([Q.statistics(t.encode()) for t, _ in used]), np.array([v for _, v in used], float)
    assert np.allclose(model.mean, x.mean(axis=0)) and np.allclose(model.scale, np.maximum(x.std(axis=0), 1e-3))
    phi = model.fourier(x)
    penalty = np.eye(phi.shape[1]) * Q.RIDGE * len(x) / Q.FEATURES
    penalty[-1, -1] = 1e-9 * len(x)
    assert np.allclose(phi @ np.array(model.weights), phi @ np.linalg.solve(phi.T @ phi + penalty, phi.T @ y), atol=1e-6)
    scores = {r.doc_id: r.score for r in Q.quality(docs, labels).collect()}
    want = np.interp(model.raw(np.array([Q.statistics(t.encode()) for _, t, _ in rows])), model.points, model.values)
    assert np.allclose([scores[i] for i, _, _ in rows], np.clip(want, 0, 1))


def brute_ngrams(data):
    """Shares of hashed n-grams, one n-gram at a time."""
    out = np.zeros((R.FAMILIES, R.BUCKETS))
    mask = (1 << 32) - 1

    def put(k, places):
        for p in places:
            out[k, p] += 1 / len(places)

    put(0, list(data))
    put(1, [(int.from_bytes(data[i : i + 3], "little") * 2654435761 & mask) >> 22 for i in range(len(data) - 2)])
    put(2, [(int.from_bytes(data[i : i + 4], "little") * 2654435761 & mask) >> 22 for i in range(len(data) - 3)])
    words = [sum((b + 1) * pow(R._BASE, j, 1 << 64) for j, b in enumerate(w)) * 0x9E3779B97F4A7C15 % (1 << 64) for w in data.split()]
    put(3, [w >> 54 for w in words])
    put(4, [((a ^ b >> 7) * 0x9E3779B97F4A7C15 % (1 << 64)) >> 54 for a, b in zip(words, words[1:])])
    return np.sqrt(out).reshape(-1)


def test_rule_verdicts_match_brute_force(spark):
    rng = random.Random(10)
    rows = [(i, junk(rng) if i % 3 == 0 else prose(rng, 80), int(i % 3 > 0)) for i in range(120)]
    docs, labels = frames(spark, [*rows, *ODD[:3]], "quality")
    model = R.train(docs, labels)
    for r in R.quality_rules(docs, labels, model=model).collect():
        data = dict((i, t) for i, t, _ in [*rows, *ODD[:3]])[r.doc_id] or ""
        x = model.intercept + float(brute_ngrams(data.encode()) @ np.array(model.weights))
        p = 1 / (1 + np.exp(-np.clip(model.slope * x + model.shift, -30, 30)))
        n, _, _, _, repeated = brute_counts(data)
        failed = n < 50 or 100 * repeated > 50 * n
        assert r.base_failed == failed and abs(r.probability - p) < 1e-3 and r.kept == (not failed and r.probability >= R.KEEP_AT)


def test_sample_thins_long_texts_and_skips_absent_rows(spark):
    from sparkloom.llm.common import labelled_sample

    docs = spark.createDataFrame([(1, "a" * 100), (2, "".join(chr(97 + k % 26) for k in range(4000))), (3, ""), (4, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(1, 50)], "doc_id long, y int")
    got = labelled_sample(docs, labels, (0, 4), 320)
    assert sorted(len(t.replace("\n", "")) for t, _ in got) == [100, 320]
    assert max((t for t, _ in got), key=len).split("\n")[0] == "abcdefghijklmnopqrst" and max((t for t, _ in got), key=len).endswith(chr(97 + 3999 % 26))
