import random

import pytest
import xxhash

from sparkloom.llm.components import components
from sparkloom.llm.common import join_counted
from sparkloom.llm.simhash import ball_links, fingerprint, fingerprints, links, near_duplicates


def brute_print(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(nodes, near):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    nodes = list(nodes)
    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if near(a, b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {n: find(n) for n in nodes}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def flock(rng, n, flips, around=None):
    centre = rng.getrandbits(64) if around is None else around
    out = []
    for _ in range(n):
        x = centre
        for _ in range(rng.randint(0, flips)):
            x ^= 1 << rng.randrange(64)
        out.append(x)
    return out


def test_fingerprint():
    rng = random.Random(1)
    words = ["The", "of", "ÉTÉ", "x\x0by", "a\x1cb", "\xa0", "and", "THAT"]
    texts = [" \n\t\r"[rng.randrange(4)].join(rng.choice(words) for _ in range(n)) for n in range(40)]
    for t in [*texts, "", "  \n", "one", "one two", "word " * 20000]:
        assert fingerprint(t.encode()) == brute_print(t)


@pytest.mark.parametrize("most", [2048, 3])
def test_links_lose_none(spark, most):
    rng = random.Random(2)
    prints = {0, (1 << 64) - 1, 7, *flock(rng, 60, 4), *flock(rng, 60, 8), *(rng.getrandbits(64) for _ in range(200))}
    for _ in range(40):
        prints |= set(flock(rng, 3, 3))
    frame = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    want = classes({signed(p) for p in prints}, lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 3)
    got = {r.node: r.root for r in components(links(frame, 3, most), "a", "b").collect()}
    groups = {}
    for n, r in want.items():
        groups.setdefault(r, set()).add(n)
    found = {}
    for n in want:
        found.setdefault(got.get(n, n), set()).add(n)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, found.values()))


def test_pairs_come_once(spark):
    rng = random.Random(4)
    prints = {signed(p) for p in flock(rng, 80, 4)}
    pairs = [tuple(r) for r in links(spark.createDataFrame([(p,) for p in prints], "fp long")).collect()]
    want = {(a, b) for a in prints for b in prints if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 3}
    assert len(pairs) == len(want) and set(pairs) == want


@pytest.mark.parametrize("distance", [1, 2, 3])
def test_balls(spark, distance):
    rng = random.Random(distance)
    prints = {signed(p) for p in flock(rng, 50, 6)}
    edges = ball_links(spark.createDataFrame([(p,) for p in prints], "fp long"), distance)
    got = {r.node: r.root for r in components(edges, "a", "b").collect()}
    want = classes(prints, lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= distance)
    a, b = {}, {}
    for n in prints:
        a.setdefault(want[n], set()).add(n)
        b.setdefault(got.get(n, n), set()).add(n)
    assert sorted(map(sorted, a.values())) == sorted(map(sorted, b.values()))


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(50)}}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_near_duplicates(spark):
    rng = random.Random(8)
    base = [" ".join(rng.choice("abcdefghij") * rng.randint(1, 6) for _ in range(300)) for _ in range(5)]
    rows = [(i, base[i % 5] + (" tail" if i > 15 else "")) for i in range(30)]
    rows += [(40, None), (41, ""), (42, " \n"), (None, base[0]), (7, base[2]), (50, "short"), (51, "SHORT"), (52, "two words")]
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, component_id string, fp int").repartition(3)
    prints = {brute_print(t) for _, t in rows}
    root = classes(prints, lambda a, b: (a ^ b).bit_count() <= 3)
    least = {}
    for i, t in rows:
        if i is not None:
            r = root[brute_print(t)]
            least[r] = min(i, least.get(r, i))
    want = [(i, signed(brute_print(t)), least[root[brute_print(t)]]) for i, t in rows]
    key = lambda r: (r[0] is None, r[0] or 0, r)
    assert sorted(map(tuple, near_duplicates(frame).collect()), key=key) == sorted(want, key=key)
    assert near_duplicates(frame.limit(0)).count() == 0
    assert fingerprints(frame.limit(0)).count() == 0


@pytest.mark.parametrize("blocks", [6, 8, 12, 16])
def test_links_are_the_same_for_any_number_of_blocks(spark, blocks):
    rng = random.Random(9)
    prints = {signed(p) for p in [*flock(rng, 60, 5), *flock(rng, 40, 3), *(rng.getrandbits(64) for _ in range(50))]}
    pairs = [tuple(r) for r in links(spark.createDataFrame([(p,) for p in prints], "fp long"), blocks=blocks).collect()]
    want = {(a, b) for a in prints for b in prints if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 3}
    assert len(pairs) == len(want) and set(pairs) == want


def test_hot_keys_are_joined_alike(spark, monkeypatch):
    rows = spark.createDataFrame([(1, i) for i in range(40)] + [(2, 0), (3, 0)], "k int, v int")
    side = spark.createDataFrame([(1, "a", 40), (2, "b", 1), (4, "c", 0)], "k int, name string, n int")
    want = sorted([(1, i, "a") for i in range(40)] + [(2, 0, "b")])
    for heavy in (10, 100):
        got = join_counted(rows, side, "k", "n", heavy).select("k", "v", "name")
        assert sorted(map(tuple, got.collect())) == want
    monkeypatch.setattr("sparkloom.llm.common.HEAVY", 3)
    test_components_of_a_chain_and_a_star(spark)
    test_near_duplicates(spark)
