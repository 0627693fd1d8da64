"""Quality classifier: random Fourier features of document statistics, ridge scores, isotonic calibration."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import bounded_batches, id_crc, materialize, one_label

FEATURES = 192
GAMMA = 0.08
RIDGE = 1e-2
SEED = 20240901
THRESHOLD = 0.7
#: Labelled rows that are learned from: all up to this many, else those of smallest hash, as large a share.
MOST_LABELLED = 400_000
#: Width of the score bins whose counts the driver calibrates on; scores lie in [-LOW, HIGH].
BINS, LOW, HIGH = 3000, 1.0, 2.0

_CLASS = np.zeros((6, 256), np.float64)
_CLASS[0, ord("A") : ord("Z") + 1] = 1  # capitals
_CLASS[1, ord("a") : ord("z") + 1] = 1  # small letters
_CLASS[2, ord("0") : ord("9") + 1] = 1  # digits
_CLASS[3, [ord(c) for c in ".,;:!?'\"()-"]] = 1  # punctuation
_CLASS[4, [ord(c) for c in "#*$%&|<>@=_/\\^~+{}[]"]] = 1  # symbols
_CLASS[5, 128:] = 1  # other scripts and accents
STATISTICS = 18


def statistics(data: bytes) -> list[float]:
    """STATISTICS numbers of a UTF-8 text; for an empty text, all are 0."""
    words = data.split()
    n = len(words)
    if not n:
        return [0.0] * STATISTICS
    shares = _CLASS @ np.bincount(np.frombuffer(data, np.uint8), minlength=256) / len(data)
    counts = Counter(words)
    sizes = np.fromiter(map(len, words), np.int64, n)
    lines = data.split(b"\n")
    filled = [x for x in lines if x.strip()]
    pairs = len(set(zip(words, words[1:])))
    triples = len(set(zip(words, words[1:], words[2:])))
    same = sum(a == b for a, b in zip(words, words[1:]))
    p = np.fromiter(counts.values(), np.float64, len(counts)) / n
    return [
        math.log1p(n), math.log1p(len(data)), float(sizes.mean()), float(sizes.std()), float(sizes.max() ** 0.5),
        *map(float, shares),
        len(counts) / n, float(p.max()), pairs / max(1, n - 1), triples / max(1, n - 2), same / max(1, n - 1),
        len(set(filled)) / max(1, len(filled)), math.log1p(n / max(1, len(filled))),
    ]


@dataclass
class QualityModel:
    mean: list[float] = field(default_factory=list)
    scale: list[float] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)
    points: list[float] = field(default_factory=list)
    values: list[float] = field(default_factory=list)
    base: float = 0.5

    def fourier(self, x: np.ndarray) -> np.ndarray:
        """Random Fourier features of standardised statistics, with a constant: their products approximate
        exp(-GAMMA * distance^2)."""
        rng = np.random.default_rng(SEED)
        w = rng.normal(0, math.sqrt(2 * GAMMA), (x.shape[1], FEATURES))
        b = rng.uniform(0, 2 * math.pi, FEATURES)
        z = np.clip((x - np.array(self.mean)) / np.array(self.scale), -6, 6)
        return np.hstack([np.cos(z @ w + b) * math.sqrt(2 / FEATURES), np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.fourier(x) @ np.array(self.weights)

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.weights:
            return np.full(len(x), self.base)
        s = self.raw(x)
        return np.clip(np.interp(s, self.points, self.values), 0, 1) if self.points else np.clip(s, 0, 1)


def isotonic(counts: list[tuple[float, float, float]]) -> tuple[list[float], list[float]]:
    """Pool adjacent violators over (place, rows, sum of labels) in order of place; (places, values) of the blocks."""
    blocks: list[list[float]] = []
    for x, n, y in counts:
        blocks.append([x * n, n, y])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return [b[0] / b[1] for b in blocks], [b[2] / b[1] for b in blocks]


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and x (array<double>), a row for each row of docs."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            x = [statistics(t or b"") for at in range(0, len(texts), 64) for t in texts.slice(at, 64).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "x"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, x array<double>")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.flatten()).reshape(-1, STATISTICS)


def learned(labels: DataFrame) -> DataFrame:
    """(doc_id, y) of the labelled rows that are learned from: about MOST_LABELLED at most, those of smallest hash."""
    y = one_label(labels, "quality").where(id_crc("doc_id") % 4 != 2)
    n = y.count()
    if n > MOST_LABELLED:
        y = y.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.lit(int(1_000_000 * MOST_LABELLED / n)))
    return y


def train(stats: DataFrame, labels: DataFrame) -> QualityModel:
    """Ridge weights from normal equations that each partition sums, and an isotonic calibration of their scores.

    Only labelled rows whose id is not held out (CRC-32 mod 4 is not 2) count. Each partition sends FEATURES + 1
    rows of the normal equations, which are summed by row number; the driver solves one system of that size. Rows
    are dealt to two folds by a hash of the id: weights from one fold score the other, and these scores, counted
    in BINS bins, are what the calibration is fitted to. The final weights come from both folds.
    """
    rows = materialize(stats.join(learned(labels), "doc_id").select("x", "y", F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(2)).cast("int").alias("fold")), "quality-rows")
    moments = rows.select(F.posexplode("x").alias("i", "v"), "y").groupBy("i").agg(F.avg("v").alias("m"), F.stddev_pop("v").alias("s"), F.avg("y").alias("y"), F.count("*").alias("n")).orderBy("i").collect()
    if not moments:
        return QualityModel()
    if moments[0].y in (0.0, 1.0) or moments[0].n < 4:
        return QualityModel(base=moments[0].y)
    model = QualityModel([r.m for r in moments], [max(r.s, 1e-3) for r in moments], base=moments[0].y)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = FEATURES + 1
        total = np.zeros((2, size, size + 1))
        for batch in batches:
            phi = model.fourier(_matrix(batch.column(0)))
            labels_ = np.array(batch.column(1), np.float64)
            folds = np.array(batch.column(2))
            for k in (0, 1):
                own = phi[folds == k]
                total[k, :, :size] += own.T @ own
                total[k, :, size] += own.T @ labels_[folds == k]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(2 * size), pa.int32()), pa.array(list(total.reshape(2 * size, size + 1)), pa.list_(pa.float64()))], ["row", "v"]
        )

    width = FEATURES + 2
    parts = rows.mapInArrow(sums, "row int, v array<double>")
    added = parts.groupBy("row").agg(F.array(*[F.sum(F.col("v")[k]) for k in range(width)]).alias("v")).collect()
    total = np.zeros((2 * (FEATURES + 1), width))
    for r in added:
        total[r.row] = r.v
    folds = total.reshape(2, FEATURES + 1, width)

    def solve(t: np.ndarray) -> list[float]:
        count = max(1.0, t[-1, FEATURES])
        penalty = np.eye(FEATURES + 1) * RIDGE * count / FEATURES
        penalty[-1, -1] = 1e-9 * count
        return [float(w) for w in np.linalg.solve(t[:, : FEATURES + 1] + penalty, t[:, FEATURES + 1])]

    held = [QualityModel(model.mean, model.scale, solve(folds[1 - k])) if folds[1 - k][-1, FEATURES] else None for k in (0, 1)]
    model.weights = solve(folds.sum(axis=0))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, fold = _matrix(batch.column(0)), np.array(batch.column(2))
            s = np.zeros(len(x))
            for k in (0, 1):
                if (fold == k).any():
                    s[fold == k] = (held[k] or model).raw(x[fold == k])
            at = np.clip(((s + LOW) / (LOW + HIGH) * BINS).astype(np.int64), 0, BINS - 1)
            yield pa.RecordBatch.from_arrays([pa.array(at), batch.column(1)], ["bin", "y"])

    bins = rows.mapInArrow(scored, "bin long, y int").groupBy("bin").agg(F.count("*").alias("n"), F.sum("y").alias("y")).orderBy("bin").collect()
    model.points, model.values = isotonic([((r.bin + 0.5) / BINS * (LOW + HIGH) - LOW, r.n, r.y) for r in bins])
    return model


def _scored(stats: DataFrame, model: QualityModel) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(_matrix(batch.column(1))), pa.float64())], ["doc_id", "score"])

    kind = stats.schema["doc_id"].dataType.simpleString()
    return stats.mapInArrow(run, f"doc_id {kind}, score double")


def quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Score each whole text by its statistics alone.

    docs: doc_id, text; labels: doc_id, quality (null and conflicting labels: see one_label). Further columns are
    not read. Returns doc_id, held_out boolean, score double (0 to 1), predicted int: a row for each row of docs.
    Null and empty texts have statistics 0 and are scored like any other; equal texts have equal scores. Without
    labels every score is 0.5, with labels of one class it is that class. The statistics are written once to the
    shared folder, and are all that is joined to labels; no text is shuffled.
    """
    stats = materialize(document_statistics(docs), "quality-statistics")
    scored = _scored(stats, train(stats, labels))
    return scored.select("doc_id", (id_crc("doc_id") % 4 == 2).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, with all their columns, whose text scores at least the threshold (see quality()).

    The model is trained on the statistics of the rows that are learned from, whose ids, about MOST_LABELLED at
    most, are broadcast; then all rows are scored as they are read.
    """
    bounded_batches(docs.sparkSession)
    ids = F.broadcast(learned(labels).select("doc_id"))
    model = train(document_statistics(docs.select("doc_id", "text").join(ids, "doc_id", "left_semi")), labels)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).cast(pa.binary())
            x = [statistics(t or b"") for k in range(0, len(texts), 64) for t in texts.slice(k, 64).to_pylist()]
            keep = model.score(np.array(x).reshape(-1, STATISTICS)) >= threshold
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
