"""Quality rules: fixed base rules, and a hashed n-gram logistic regression scored in Arrow batches."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sparkloom.llm.common import bounded_batches, labelled_sample, one_label

#: Base rules (fixed values).
LEAST_WORDS, MOST_REPEATED_PERCENT = 50, 50
SYMBOLS = re.compile(rb"[#*$%&|<>]")
#: The classifier's verdict: a text is kept at this probability of quality or more.
KEEP_AT = 0.5
#: Hash buckets of each n-gram family: character 1-, 3- and 4-grams, word 1- and 2-grams.
BUCKETS, FAMILIES = 1024, 5
#: Bounds of the labelled sample: texts of each class, and code points of a text; longer texts give evenly spread pieces.
PER_CLASS, MAX_CHARS = (1500, 1500), 32768
_BASE = 0x100000001B3
_CONTINUES = bytes(range(0x80, 0xC0))


def base_counts(data: bytes) -> tuple[int, int, int, int, int]:
    """(words, code points in words, symbols, repeated lines, words in 3-word windows found twice or more)."""
    words = data.split()
    n = len(words)
    word_chars = len(data.translate(None, _CONTINUES + b" \t\n\x0b\x0c\r"))
    lines = [x for x in data.split(b"\n") if x.split()]
    repeated = 0
    if n > 3:
        grams = list(zip(words, words[1:], words[2:]))
        if len(set(grams)) < len(grams):
            often = {g for g, k in Counter(grams).items() if k > 1}
            end = 0
            for k, g in enumerate(grams):
                if g in often:
                    repeated += k + 3 - max(end, k)
                    end = k + 3
    return n, word_chars, len(SYMBOLS.findall(data)), len(lines) - len(set(lines)), repeated


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_INVERSE = pow(_BASE, -1, 1 << 64)


def ngram_features(data: bytes) -> np.ndarray:
    """FAMILIES * BUCKETS square roots of hashed n-gram shares; a family without n-grams is 0."""
    out = np.zeros((FAMILIES, BUCKETS), np.float32)
    b = np.frombuffer(data, np.uint8).astype(np.uint32)
    mix = np.uint32(2654435761)
    shift = np.uint32(22)

    def put(k: int, at: np.ndarray) -> None:
        if len(at):
            out[k] = np.sqrt(np.bincount(at, minlength=BUCKETS) / len(at))

    put(0, b)
    if len(b) >= 3:
        three = b[:-2] | b[1:-1] << np.uint32(8) | b[2:] << np.uint32(16)
        put(1, three * mix >> shift)
        if len(b) >= 4:
            put(2, (three[:-1] | b[3:] << np.uint32(24)) * mix >> shift)
    gap = np.isin(b, (32, 9, 10, 11, 12, 13))
    edges = np.flatnonzero(np.diff(np.concatenate([[True], gap, [True]]).astype(np.int8)))
    if len(edges):
        starts, ends = edges[::2], edges[1::2]
        with np.errstate(over="ignore"):
            n = len(b)
            prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum((b.astype(np.uint64) + np.uint64(1)) * _powers(n), dtype=np.uint64)])
            back = np.full(n, _INVERSE, np.uint64)
            back[0] = 1
            back = np.multiply.accumulate(back)
            words = (prefix[ends] - prefix[starts]) * back[starts]
            words *= np.uint64(0x9E3779B97F4A7C15)
            put(3, (words >> np.uint64(54)).astype(np.int64))
            pairs = (words[:-1] ^ (words[1:] >> np.uint64(7))) * np.uint64(0x9E3779B97F4A7C15)
            put(4, (pairs >> np.uint64(54)).astype(np.int64))
    return out.reshape(-1)


@dataclass
class RuleModel:
    weights: list[float] = field(default_factory=list)
    intercept: float = 0.0
    slope: float = 1.0
    shift: float = 0.0

    def probability(self, data: bytes) -> float:
        x = self.intercept
        if self.weights:
            if getattr(self, "_w", None) is None:
                self._w = np.array(self.weights, np.float32)
            x += float(ngram_features(data) @ self._w)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.slope * x + self.shift))))

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_w"}


def _descend(x: np.ndarray, y: np.ndarray, ridge: float, rounds: int) -> tuple[np.ndarray, float]:
    """Ridge logistic regression by accelerated gradient descent; rows weigh so that both classes count alike."""
    share = y.mean()
    weight = np.where(y > 0, 0.5 / share, 0.5 / (1 - share)) / len(y)
    w = v = np.zeros(x.shape[1], np.float32)
    b = c = 0.0
    step = 1 / (0.25 * (FAMILIES + 1) * 2 + ridge)
    for k in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ v + c, -30, 30)))
        g = ((p - y) * weight).astype(np.float32)
        w_next = v - step * (x.T @ g + ridge * v)
        b_next = c - step * float(g.sum())
        m = k / (k + 3)
        v, c = w_next + m * (w_next - w), b_next + m * (b_next - b)
        w, b = w_next, b_next
    return w, b


def fit(sample: list[tuple[str, int]], ridge: float = 1e-4, rounds: int = 200) -> RuleModel:
    """A model of (text, label) pairs: weights from four of five rows, probabilities calibrated on the fifth.

    The calibration is a logistic function of the score with smoothed targets. One class alone gives a constant.
    """
    y = np.array([v for _, v in sample], np.float32)
    if len(y) < 10 or y.min() == y.max():
        return RuleModel(intercept=0.0 if not len(y) else 4.0 * (2 * float(y.mean()) - 1))
    x = np.array([ngram_features(t.encode()) for t, _ in sample])
    apart = np.arange(len(y)) % 5 == 4
    if y[apart].min() == y[apart].max() or y[~apart].min() == y[~apart].max():
        apart = np.zeros(len(y), bool)
    w, b = _descend(x[~apart], y[~apart], ridge, rounds)
    use = apart if apart.any() else ~apart
    s = x[use] @ w + b
    n1, n0 = y[use].sum(), (1 - y[use]).sum()
    target = np.where(y[use] > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.where(y[use] > 0, 0.5 / n1, 0.5 / n0)
    slope, shift = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(slope * s + shift, -30, 30)))
        r, h = (p - target) * weight, p * (1 - p) * weight
        grad = np.array([(r * s).sum(), r.sum()])
        hess = np.array([[(h * s * s).sum(), (h * s).sum()], [(h * s).sum(), h.sum()]]) + 1e-6 * np.eye(2)
        move = np.clip(np.linalg.solve(hess, grad), -2, 2)
        slope, shift = slope - move[0], shift - move[1]
        if abs(move).max() < 1e-7:
            break
    return RuleModel([float(v) for v in w], float(b), float(slope), float(shift))


def train(docs: DataFrame, labels: DataFrame, per_class: tuple[int, int] = PER_CLASS, max_chars: int = MAX_CHARS) -> RuleModel:
    """fit() on at most per_class[y] labelled texts of class y, of which max_chars code points count."""
    return fit(labelled_sample(docs, one_label(labels, "quality"), per_class, max_chars))


def quality_rules(docs: DataFrame, labels: DataFrame, keep_at: float = KEEP_AT, model: RuleModel | None = None) -> DataFrame:
    """Base rules and the classifier's verdict for each whole text.

    docs: doc_id, text; labels: doc_id, quality (null and conflicting labels: see one_label). Further columns are
    not read. Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long), base_failed
    boolean, probability double, kept boolean: a row for each row of docs. A null text has no words and fails the
    base rules, as an empty one does. Without labels the verdict is that of the base rules. One pass without a
    shuffle beside the drawing of the bounded sample.
    """
    bounded_batches(docs.sparkSession)
    fitted = train(docs, labels) if model is None else model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            rows = []
            for at in range(0, len(texts), 64):
                for text in texts.slice(at, 64).to_pylist():
                    data = text or b""
                    counts = base_counts(data)
                    failed = counts[0] < LEAST_WORDS or 100 * counts[4] > MOST_REPEATED_PERCENT * counts[0]
                    p = fitted.probability(data)
                    rows.append((*counts, failed, p, not failed and p >= keep_at))
            cols = list(zip(*rows)) if rows else [()] * 8
            kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "probability", "kept"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, probability double, kept boolean"
    return docs.select("doc_id", "text").mapInArrow(run, out)
