"""Toxicity by compression distance: windows of a text under a toxic and an ordinary zstandard dictionary.

zstandard's trainer makes one dictionary of windows of ordinary texts and one of windows of toxic texts. As most of a toxic text is
ordinary language, the toxic dictionary is trained in rounds: first on the windows which the ordinary dictionary
compresses worst, then on those which the toxic dictionary of the round before shortens. Two halves of the toxic
texts take turns: what is trained on one is held against the windows of the other, and only parts of a dictionary by
which windows of toxic texts are shortened far more often than those of ordinary texts are kept.

A window's difference is its length under the ordinary dictionary less that under the toxic one in front of the
ordinary one, so a window without anything toxic compresses alike under both. Windows that hold no run of bytes which
the toxic dictionary has and the ordinary one lacks cannot be shorter and are not compressed. The differences of a text are
weighed by a logistic function that is calibrated on labelled texts which the dictionaries have not seen.
"""

from __future__ import annotations

import math
import re
import zlib
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import bounded_batches, id_crc, labelled_sample, one_label

#: Words of a window, and from the start of one to that of the next; the last one ends at the text's end.
SPAN, STEP = 4, 2
#: Bytes that no UTF-8 text has: they end both dictionaries and start each window, so that a window with a single match
#: is already shorter than itself and never stored uncompressed.
FRAME = bytes(range(0xF8, 0x100)) * 4
LEVEL, MIN_MATCH = 12, 4
#: Differences of that many bytes or more count.
SAVED = 2
#: Bytes of the trained dictionaries; zstandard's header, of 256 bytes at most, is cut off.
TOXIC_BYTES, ORDINARY_BYTES, HEADER = 16384, 131072, 256
ROUNDS = 2
#: Of the windows of toxic texts, one in so many is trained on at first.
NOVEL = 2
#: A part of the toxic dictionary stays if its runs of GRAM bytes shorten windows in LEAST toxic texts at least, LIFT times as
#: often as in ordinary ones, and if no more than this share of the ordinary texts has them at all.
GRAM, LEAST, LIFT, USUAL = 5, 3, 6.0, 0.1
#: Runs of GRAM bytes leave the ordinary dictionary if so many times as large a share of the toxic texts has them, and by so
#: many standard deviations.
TELLING, DEVIATIONS = 3.0, 4.0
#: Bounds of the labelled sample: ordinary and toxic texts, and code points of a text; longer texts give evenly spread pieces.
PER_CLASS, MAX_CHARS = (2000, 1000), 16384
THRESHOLD = 0.5
#: A missed toxic text counts as so many false alarms: scores are calibrated for classes weighed like that.
COST = 1.5
#: Bytes of a text that are cut into words at once.
PIECE = 1 << 20
#: Runs of three words by which near copies in the sample are told: those of least hash.
SKETCH = 24

_SPACE = re.compile(rb"\s")


def word_lists(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text in order, in lower case for A-Z, at most about PIECE bytes at once; words of over 64 bytes are cut.

    A text of more than PIECE bytes is cut at white space, or after another PIECE bytes.
    """
    at = 0
    while at < len(data):
        end = len(data)
        if end - at > PIECE:
            found = _SPACE.search(data, at + PIECE, at + 2 * PIECE)
            end = found.start() if found else min(end, at + 2 * PIECE)
        words = data[at:end].lower().split()
        if words and max(map(len, words)) > 64:
            words = [w[k : k + 64] for w in words for k in range(0, len(w), 64)]
        if words:
            yield words
        at = end


def window_starts(n: int) -> list[int]:
    """The first words of the windows over n words."""
    last = max(0, n - SPAN)
    return [*range(0, last, STEP), last]


def window(words: list[bytes], start: int) -> bytes:
    return b" %b " % b" ".join(words[start : start + SPAN])


def windows(data: bytes) -> Iterator[bytes]:
    """All windows of a text; none crosses a cut of word_lists()."""
    for words in word_lists(data):
        for k in window_starts(len(words)):
            yield window(words, k)


def _apart(texts: list[bytes]) -> list[bytes]:
    """The texts without near copies of earlier ones, which would make chance words look frequent."""
    seen: dict[int, list[int]] = defaultdict(list)
    out: list[bytes] = []
    for text in texts:
        words = text.split()
        runs = {zlib.crc32(b" ".join(words[k : k + 3])) for k in range(max(1, len(words) - 2))}
        least = sorted(runs)[:SKETCH]
        hits = Counter(j for h in least for j in seen[h])
        if hits and 3 * max(hits.values()) >= len(least):
            continue
        for h in least:
            seen[h].append(len(out))
        out.append(text)
    return out


def trained(samples: list[bytes], size: int, segment: int) -> bytes:
    """The content of a dictionary that zstandard trains on samples; of too few, the samples themselves."""
    try:
        return zstandard.train_dictionary(size, samples, k=segment, d=6 if segment < 32 else 8, f=20, accel=1, split_point=1.0).as_bytes()[HEADER:]
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[-size:]


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    kind = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, source_size=64, dict_size=TOXIC_BYTES + ORDINARY_BYTES, min_match=MIN_MATCH, write_content_size=False,
        write_checksum=False, write_dict_id=False, format=zstandard.FORMAT_ZSTD1_MAGICLESS,
    )
    dictionary = zstandard.ZstdCompressionDict(content + FRAME, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(compression_params=kind)
    return zstandard.ZstdCompressor(compression_params=kind, dict_data=dictionary)


def lacking(toxic: bytes, ordinary: bytes) -> set[bytes]:
    """The shortest runs of GRAM bytes or more, of each place in `toxic`, that `ordinary` does not have."""
    out: set[bytes] = set()
    left = range(len(toxic) - GRAM + 1)
    for n in range(GRAM, 65):
        known = {ordinary[k : k + n] for k in range(len(ordinary) - n + 1)}
        still = []
        for k in left:
            run = toxic[k : k + n]
            if len(run) == n:
                if run in known:
                    still.append(k)
                else:
                    out.add(run)
        left = still
        if not left:
            break
    return out


@dataclass
class ToxicModel:
    toxic: bytes = b""
    ordinary: bytes = b""
    weights: list[float] = field(default_factory=lambda: [0.0, 0.0, 0.0, 0.0, 0.0])

    def __post_init__(self) -> None:
        self._pair = self._marks = None

    def __getstate__(self) -> dict:
        return {"toxic": self.toxic, "ordinary": self.ordinary, "weights": self.weights}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.__post_init__()

    def marks(self, data: bytes) -> Iterator[tuple[int, int]]:
        """(last place, length) of the runs in data that the toxic dictionary has and the ordinary one lacks."""
        if self._marks is None:
            self._marks = ahocorasick.Automaton()
            for run in lacking(self.toxic, self.ordinary):
                self._marks.add_word(run.decode("latin-1"), len(run))
            self._marks.make_automaton()
        return self._marks.iter(data.decode("latin-1")) if len(self._marks) else iter(())

    def difference(self, window: bytes) -> int:
        """The bytes that a window is shorter under the toxic dictionary."""
        if self._pair is None:
            self._pair = [compressor(front + self.ordinary).compress for front in (b"", self.toxic)]
        framed = FRAME + window
        return len(self._pair[0](framed)) - len(self._pair[1](framed))

    def saved(self, window: bytes) -> int:
        """difference(), 0 for a window without a mark."""
        return self.difference(window) if next(self.marks(window), None) else 0

    def features(self, data: bytes) -> tuple[float, float, float, float]:
        """The largest difference over the windows; logarithms of how many are large, of their sum and of all windows."""
        if not self.toxic:
            return 0.0, 0.0, 0.0, 0.0
        most, large, total, n = 0, 0, 0, 0
        for words in word_lists(data):
            starts = window_starts(len(words))
            n += len(starts)
            marked: set[int] = set()
            places = None
            for end, size in self.marks(b" %b " % b" ".join(words)):
                if places is None:  # of each word, with the space before it
                    places = list(accumulate((len(w) + 1 for w in words), initial=0))
                first = bisect_right(places, end - size + 1) - 1
                if first == len(words):
                    first -= 1
                k = max(0, -((SPAN - 1 - first) // STEP))
                while k < len(starts) and starts[k] <= first:
                    marked.add(starts[k])
                    k += 1
                if starts[-1] <= first:
                    marked.add(starts[-1])
            for k in marked:
                d = self.saved(window(words, k))
                if d >= SAVED:
                    large += 1
                    total += d
                    most = max(most, d)
        return float(most), math.log1p(large), math.log1p(total), math.log1p(n)

    def score(self, data: bytes) -> float:
        x = self.weights[0] + sum(w * v for w, v in zip(self.weights[1:], self.features(data)))
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, x))))


def _grams(run: bytes) -> list[bytes]:
    return [run[k : k + GRAM] for k in range(len(run) - GRAM + 1)]


class TextCounts:
    """The number of texts that hold each run of GRAM bytes."""

    def __init__(self, texts: list[bytes]) -> None:
        self.texts = len(texts)
        found = [self._ids(b" %b " % b" ".join(t.lower().split())) for t in texts]
        self.ids, self.counts = np.unique(np.concatenate([np.zeros(0, np.uint64), *found]), return_counts=True)

    @staticmethod
    def _ids(data: bytes) -> np.ndarray:
        b = np.frombuffer(data, np.uint8).astype(np.uint64)
        n = max(0, len(b) - GRAM + 1)
        return np.unique(sum(b[k : k + n] << np.uint64(8 * k) for k in range(GRAM)))

    def __getitem__(self, gram: bytes) -> int:
        key = np.uint64(int.from_bytes(gram, "little"))
        at = int(np.searchsorted(self.ids, key))
        return int(self.counts[at]) if at < len(self.ids) and self.ids[at] == key else 0


def _telling(content: bytes, ordinary: bytes, toxic_texts: list[list[bytes]], other_texts: list[list[bytes]], usual: TextCounts) -> Counter:
    """Parts of a trained dictionary's content by which windows of toxic texts are shortened, with the number of texts.

    Each shortened window gives the longest run of bytes that it shares with content and that `ordinary` lacks. Of
    these runs, what stays are the stretches whose grams shorten windows of LEAST toxic texts, LIFT times as often as
    those of other texts, and are not usual by themselves.
    """
    places: dict[bytes, list[int]] = defaultdict(list)
    for k, g in enumerate(_grams(content)):
        places[g].append(k)
    saved = ToxicModel(content, ordinary).saved

    def run(w: bytes) -> bytes:
        best = b""
        if saved(w) >= SAVED:
            for j in range(len(w) - GRAM + 1):
                for i in places.get(w[j : j + GRAM], ()):
                    n = GRAM
                    while j + n < len(w) and i + n < len(content) and w[j + n] == content[i + n]:
                        n += 1
                    if n > len(best) and content[i : i + n] not in ordinary:
                        best = content[i : i + n]
        return best

    def credited(texts: list[list[bytes]]) -> tuple[Counter, Counter]:
        runs: Counter = Counter()
        for t in texts:
            runs.update({r for w in t if (r := run(w))})
        grams: Counter = Counter()
        for r, n in runs.items():
            for g in set(_grams(r)):
                grams[g] += n
        return runs, grams

    found, here = credited(toxic_texts)
    _, there = credited(other_texts)
    ratio = len(toxic_texts) / max(1, len(other_texts))
    good = {g for g, n in here.items() if n >= LEAST and n >= LIFT * ratio * (there[g] + 0.5) and usual[g] <= USUAL * usual.texts}
    parts: Counter = Counter()
    for r, n in found.items():
        at = 0
        while at <= len(r) - GRAM:
            end = at
            while r[end : end + GRAM] in good:
                end += 1
            if end > at:
                parts[r[at : end - 1 + GRAM]] += n
            at = end + 1
    return parts


def _without_telling(content: bytes, own: TextCounts, usual: TextCounts) -> bytes:
    """The ordinary dictionary's content without runs that are far more frequent in toxic texts: they tell these apart."""
    ratio = own.texts / max(1, usual.texts)
    covered = bytearray(len(content))
    for k, g in enumerate(_grams(content)):
        n = own[g]
        expected = (usual[g] + 0.5) * ratio
        if n >= TELLING * expected and n - expected >= DEVIATIONS * math.sqrt(expected + 1):
            covered[k : k + GRAM] = b"\1" * GRAM
    return bytes(0xFF if c else b for b, c in zip(content, covered))


def dictionaries(toxic: list[bytes], other: list[bytes]) -> ToxicModel:
    """The two dictionaries, without weights."""
    toxic, other = _apart(toxic), _apart(other)
    toxic_texts = [list(dict.fromkeys(windows(t))) for t in toxic]
    other_texts = [list(dict.fromkeys(windows(t))) for t in other]
    ordinary = trained(list(dict.fromkeys(w for t in other_texts for w in t)), ORDINARY_BYTES, 32)
    usual = TextCounts(other)
    ordinary = _without_telling(ordinary, TextCounts(toxic), usual)
    halves = [(toxic_texts[k::2], other_texts[k::2]) for k in (0, 1)]
    plain = compressor(ordinary).compress
    chosen = []
    for own, _ in halves:
        ranked = sorted(((len(plain(FRAME + w)) / len(w), w) for t in own for w in t), reverse=True)
        chosen.append([w for _, w in ranked[: -(-len(ranked) // NOVEL)]])
    content = b""
    for _ in range(ROUNDS):
        parts: Counter = Counter()
        for k in (0, 1):
            if chosen[1 - k]:
                parts += _telling(trained(chosen[1 - k], TOXIC_BYTES, 16), ordinary, *halves[k], usual)
        content = b""
        for part, _ in sorted(parts.items(), key=lambda x: (-x[1], -len(x[0]), x[0])):
            if part not in content and len(content) + len(part) <= TOXIC_BYTES:
                content = part + content
        saved = ToxicModel(content, ordinary).saved
        chosen = [[w for t in own for w in t if content and saved(w) >= SAVED] for own, _ in halves]
    return ToxicModel(content, ordinary)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton's method; the intercept comes first."""
    design = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(design.shape[1])
    penalty = np.diag([1e-6] + [ridge] * x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        grad = design.T @ (p - y) + penalty @ w
        step = np.linalg.solve(design.T @ (design * (p * (1 - p))[:, None]) + penalty, grad)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(sample: list[tuple[str, int]], share: float | None = None) -> ToxicModel:
    """A model of (text, label) pairs. share: of label 1 among all labelled rows, if the sample is not drawn evenly.

    Four of five texts of each class make the dictionaries, the fifth calibrates the weights of the differences. One
    class alone, or fewer than five texts of one, gives a model whose score is constant.
    """
    rows = [(t.encode(), y) for t, y in sample]
    by = [[t for t, y in rows if y == label] for label in (0, 1)]
    share = len(by[1]) / max(1, len(rows)) if share is None else share
    prior = math.log((share + 1e-3) / (1 - share + 1e-3))
    if min(map(len, by)) < 5:
        return ToxicModel(weights=[prior if rows else 0.0, 0.0, 0.0, 0.0, 0.0])
    model = dictionaries(*([t for k, t in enumerate(by[label]) if k % 5 != 4] for label in (1, 0)))
    held = [(t, label) for label in (0, 1) for t in by[label][4::5]]
    weights = _logistic(np.array([model.features(t) for t, _ in held]), np.array([y for _, y in held], float))
    weights[0] += prior + math.log(COST) - math.log(len(by[1][4::5]) / len(by[0][4::5]))
    model.weights = [float(w) for w in weights]
    return model


def train(docs: DataFrame, labels: DataFrame, per_class: tuple[int, int] = PER_CLASS, max_chars: int = MAX_CHARS) -> ToxicModel:
    """fit() on at most per_class[y] labelled texts of class y whose id is not held out (CRC-32 mod 5 is not 0)."""
    y = one_label(labels, "toxic").where(id_crc("doc_id") % 5 != 0)
    n = {r.y: r.n for r in y.groupBy("y").agg(F.count("*").alias("n")).collect()}
    share = n.get(1, 0) / max(1, sum(n.values()))
    return fit(labelled_sample(docs, y, per_class, max_chars), share)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, model: ToxicModel | None = None) -> DataFrame:
    """Score each whole text by its windows; equal texts have equal scores.

    docs: doc_id, text; labels: doc_id, toxic (null and conflicting labels: see one_label). Further columns are not
    read. Returns doc_id, held_out boolean, score double (0 to 1), predicted int: a row for each row of docs,
    repeated rows and null ids included; an empty table gives none. Null and empty texts have no window and get the
    score of no difference; a score equal to the threshold counts as toxic. Without labels the score is 0.5. Very long
    texts are scored whole, PIECE bytes at a time. The sample is bounded, and so are the dictionaries; the driver
    holds at most sum(PER_CLASS) * MAX_CHARS code points of text. Scoring is one pass without a shuffle.
    """
    bounded_batches(docs.sparkSession)
    fitted = train(docs, labels) if model is None else model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            scores = [fitted.score(t or b"") for at in range(0, len(texts), 64) for t in texts.slice(at, 64).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select("doc_id", (id_crc("doc_id") % 5 == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def reject_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, with all their columns, whose text scores below the threshold (see toxicity()).

    Null and empty texts have the score of no difference, repeated rows are treated alike, an empty table stays empty.
    """
    bounded_batches(docs.sparkSession)
    fitted = train(docs, labels)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).cast(pa.binary())
            keep = [fitted.score(t or b"") < threshold for k in range(0, len(texts), 64) for t in texts.slice(k, 64).to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
