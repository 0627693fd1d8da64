"""BPE encoding and decoding of whole texts, and token counts that never form ids."""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from sparkloom.llm.bpe import ByteBpe, UnitCache
from sparkloom.llm.common import bounded_batches

_coders: dict[str, tuple[ByteBpe, UnitCache]] = {}


def _coder(path: str) -> tuple[ByteBpe, UnitCache]:
    """One encoder and one cache for each worker process and vocabulary."""
    if path not in _coders:
        bpe = ByteBpe(path)

        def both(unit: str) -> tuple[bytes, bytes]:
            ids = bpe.encode_unit(unit)
            return ",".join(map(str, ids)).encode(), bpe.decode_bytes(ids)

        _coders[path] = bpe, UnitCache(both)
    return _coders[path]


def encode_decode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Encode each text with the byte-level BPE of a vocabulary file and decode the ids again.

    docs: doc_id, text, further columns are not read. Returns doc_id, n_tokens long, ids string (decimal, joined
    by commas), decoded string: one row for each row of docs, repeated rows and ids included. A null text counts
    as the empty one, which has no ids; a null doc_id stays null. Special tokens' strings in a text become their
    ids, as is the library's default. One pass without a shuffle; a worker holds one batch and its unit cache.
    """
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, cache = _coder(vocabulary)
        for batch in batches:
            counts, ids, decoded = [], [], []
            for text in batch.column(1).to_pylist():
                id_parts, byte_parts = [], []
                for part, special in bpe.segments(text or ""):
                    for a, b in cache.of(part):
                        id_parts.append(a)
                        byte_parts.append(b)
                    if special is not None:
                        id_parts.append(b"%d" % special)
                        byte_parts.append(bpe.token_bytes[special])
                joined = b",".join(id_parts)
                counts.append(joined.count(b",") + 1 if id_parts else 0)
                ids.append(joined)
                decoded.append(b"".join(byte_parts).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.binary()).cast(pa.string()), pa.array(decoded, pa.string())],
                ["doc_id", "n_tokens", "ids", "decoded"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long, ids string, decoded string")


def encode_digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """encode_decode() with SHA-256 digests in place of the ids and the decoded text, taken where they arise.

    Returns doc_id, n_tokens long, ids_sha256 string, decoded_sha256 string. Same cases as encode_decode().
    """
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, cache = _coder(vocabulary)
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                id_parts, byte_parts = [], []
                for part, special in bpe.segments(text or ""):
                    if found := cache.of(part):
                        a, b = zip(*found)
                        id_parts += a
                        byte_parts += b
                    if special is not None:
                        id_parts.append(b"%d" % special)
                        byte_parts.append(bpe.token_bytes[special])
                joined = b",".join(id_parts)
                decoded = b"".join(byte_parts)
                try:
                    decoded.decode("utf-8")
                except UnicodeDecodeError:
                    decoded = decoded.decode("utf-8", "replace").encode()
                rows.append((joined.count(b",") + 1 if id_parts else 0, hashlib.sha256(joined).hexdigest(), hashlib.sha256(decoded).hexdigest()))
            counts, ids, texts = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


_counters: dict[str, tuple[object, dict[bytes, int]]] = {}
_REMEMBERED = 500_000
_LONGEST = 256


def _counter(path: str):
    if path not in _counters:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        tok.no_truncation()
        tok.no_padding()
        _counters[path] = tok, {}
    return _counters[path]


def token_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Tokens of each text under a word-piece-like BPE file, without its ids.

    Texts are cut at ASCII white space, at which this vocabulary's normalizer and pre-tokenizer always cut and
    which yields no tokens. For each batch the distinct pre-tokens that are not yet known are counted once, then
    the per-document frequencies are joined to those counts and summed.

    docs: doc_id, text, further columns are not read. Returns doc_id, n_bytes long (UTF-8), n_tokens long: one row
    for each row of docs. Null texts count as empty: 0 bytes, 0 tokens. Null ids stay null. One pass without a
    shuffle; the table of known pre-tokens is bounded and starts anew when full.
    """
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, known = _counter(vocabulary)
        for batch in batches:
            n_bytes, n_tokens = [], []
            texts = batch.column(1).cast(pa.binary())
            for at in range(0, len(texts), 128):
                freqs = []
                distinct: set[bytes] = set()
                for data in texts.slice(at, 128).to_pylist():
                    data = data or b""
                    n_bytes.append(len(data))
                    freq = Counter(data.split())
                    freqs.append(freq)
                    distinct.update(freq)
                if len(known) > _REMEMBERED:
                    known.clear()
                fresh = [p for p in distinct if p not in known]
                pieces = dict(zip(fresh, (len(e) for e in tok.encode_batch_fast([p.decode("utf-8", "replace") for p in fresh], add_special_tokens=False))))
                known.update((p, n) for p, n in pieces.items() if len(p) <= _LONGEST)
                for freq in freqs:
                    n_tokens.append(sum(n * (known[p] if p in known else pieces[p]) for p, n in freq.items()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long")
