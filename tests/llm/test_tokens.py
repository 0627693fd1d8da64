import hashlib
import random
import zlib
from array import array

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from sparkloom.llm.bpe import ByteBpe, PairTree, UnitCache, units  # noqa: E402
from sparkloom.llm.packing import OpenWindows, merge_windows, pack  # noqa: E402
from sparkloom.llm.tokenise import encode_decode, encode_digests, token_counts  # noqa: E402

BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
PARTS = [" ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", " ", "a", "Bee", "é", "'s", "9", "²", "中文", "́", "_", "<|endoftext|>", "<|startoftext|>", "!!", "😀", "İ", "Σ", " the", "."]
SCHEMA = "extra string, doc_id long, text string, ids string, pid long"


def texts(n=400, seed=3):
    rng = random.Random(seed)
    some = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 30))) for _ in range(n)]
    return [*some, "", None, "x" * 5000, "the " * 3000, " " * 70, some[0], some[0]]


def frame(spark, rows):
    return spark.createDataFrame([("e", i, t, "clash", 7) for i, t in rows], SCHEMA).repartition(3)


def test_encode_matches_library():
    bpe, lib = ByteBpe(BYTE), Tokenizer.from_file(BYTE)
    for text in texts():
        ids = lib.encode(text or "", add_special_tokens=False).ids
        assert bpe.encode(text or "") == ids
        assert bpe.decode(ids) == lib.decode(ids, skip_special_tokens=False)


def test_tree_and_short_form_agree():
    bpe = ByteBpe(BYTE)
    rng = random.Random(5)
    for _ in range(200):
        data = bytes(rng.choice(b"theanos ing") for _ in range(rng.randint(33, 3000)))
        width, PairTree.WIDTH = PairTree.WIDTH, 4
        small = bpe.merge(data)
        PairTree.WIDTH = 1 << 20
        flat = bpe.merge(data)
        PairTree.WIDTH = width
        assert small == flat == bpe.merge(data)


def test_units_join_to_text_and_cache_forgets():
    for text in texts():
        assert "".join(units(text or "")) == (text or "")
    cache = UnitCache(lambda u: u, most=3)
    for text in texts():
        assert "".join(cache.of(text or "")) == (text or "")


def test_encode_decode_frame(spark):
    lib = Tokenizer.from_file(BYTE)
    rows = [*enumerate(texts(100)), (None, "no id"), (3, "twice"), (3, "twice")]
    want = []
    for i, t in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        back = lib.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), ",".join(map(str, ids)), back))
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(map(tuple, encode_decode(frame(spark, rows), BYTE).collect()), key=key) == sorted(want, key=key)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert sorted(map(tuple, encode_digests(frame(spark, rows), BYTE).collect()), key=key) == sorted([(i, n, sha(a), sha(b)) for i, n, a, b in want], key=key)
    assert encode_digests(frame(spark, []), BYTE).count() == 0


def test_token_counts(spark):
    lib = Tokenizer.from_file(WORD)
    rows = [*enumerate(texts()), (None, "no id")]
    want = [(i, len((t or "").encode()), len(lib.encode(t or "", add_special_tokens=False).ids)) for i, t in rows]
    key = lambda r: (r[0] is None, r)
    assert sorted(map(tuple, token_counts(frame(spark, rows), WORD).collect()), key=key) == sorted(want, key=key)
    assert token_counts(frame(spark, []), WORD).count() == 0


def check_pack(rows, out, window):
    lib = Tokenizer.from_file(BYTE)
    want = {i: [*lib.encode(t or "", add_special_tokens=False).ids, 0] for i, t in rows}
    seqs, got = {}, {}
    for r in out:
        ids = want[r.doc_id][r.start : r.start + r.length]
        assert len(ids) == r.length and zlib.crc32(array("I", ids).tobytes()) == r.ids_crc32
        assert r.doc_tokens == len(want[r.doc_id])
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
        got.setdefault(r.doc_id, []).append((r.start, r.length))
    for parts in (*seqs.values(), *got.values()):
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
    assert all(sum(n for _, n in v) <= window for v in seqs.values())
    assert {i: sum(n for _, n in v) for i, v in got.items()} == {i: len(v) for i, v in want.items()}
    return sum(map(len, want.values())) / window / len(seqs)


@pytest.mark.parametrize("window,most", [(64, 2), (64, 16), (1024, 128)])
def test_pack(spark, window, most):
    rows = list(enumerate(texts()))
    share = check_pack(rows, pack(frame(spark, rows), BYTE, window, most).collect(), window)
    assert share > (0.9 if most == 16 else 0.7)


def test_pack_cases(spark):
    assert pack(frame(spark, []), BYTE).count() == 0
    out = pack(frame(spark, [(None, "a b"), (5, "x"), (5, "x"), (6, None)]), BYTE).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.length) for r in out) == [(False, 5, 2), (False, 5, 2), (False, 6, 1), (True, 0, 3)]


def test_open_windows_emit_the_fullest():
    held = OpenWindows(10, 2)
    assert [held.place(n) for n in (6, 7, 3, 8)] == [(0, 0, None), (1, 0, None), (1, 7, None), (2, 0, None)]
    assert held.place(5) == (3, 0, 2)


def test_merge_windows(spark):
    rows = [(p, w, f) for p in range(130) for w, f in enumerate((3, 6, 9))]
    out = merge_windows(spark.createDataFrame(rows, "pid long, window_no long, fill long"), 10, 4).collect()
    fill = {(p, w): f for p, w, f in rows}
    seqs = {}
    for r in out:
        seqs.setdefault(r.merged_id, []).append((r.base, fill[r.pid, r.window_no]))
    assert len(out) == len(rows) and len(seqs) < len(rows)
    for parts in seqs.values():
        at = 0
        for base, f in sorted(parts):
            assert base == at
            at += f
        assert at <= 10


def test_long_texts_have_the_same_ids(monkeypatch):
    from sparkloom.llm import packing

    lib = Tokenizer.from_file(BYTE)
    long = " ".join(t or "" for t in texts(600)) + "x" * 300_000
    for most in (packing.LONG_TEXT, 10):
        monkeypatch.setattr(packing, "LONG_TEXT", most)
        for text in [*texts(60), long]:
            assert packing._ids(BYTE, text or "") == array("I", lib.encode(text or "", add_special_tokens=False).ids).tobytes()
