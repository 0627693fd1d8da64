import random

from sparkloom.llm.lines import drop_recurring_lines, templates

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()
SCHEMA = "doc_id long, text string, n_dropped string, line int, template long"


def sentence(rng, n=14):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def body(rng, lines=6):
    return [sentence(rng, 20) for _ in range(lines)]


def run(spark, rows, **kw):
    frame = spark.createDataFrame([(i, t, "clash", 1, 2) for i, t in rows], SCHEMA).repartition(3)
    return {(r.doc_id, r.text): r for r in drop_recurring_lines(frame, **kw).collect()}


def test_templates_leave_one_part_open():
    rng = random.Random(1)
    line = sentence(rng, 23).split()
    n, mine = templates(" ".join(line).encode())
    assert n == 23 and len(set(mine)) == 4
    for k in range(23):
        other = list(line)
        other[k] = "changed"
        shared = set(mine) & set(templates(" ".join(other).encode())[1])
        assert bool(shared) == (k >= 3), k
    other = list(line)
    other[4], other[22] = "changed", "changed"
    assert not set(mine) & set(templates(" ".join(other).encode())[1])
    assert templates(b"id 17 of the build was made at noon today") == templates(b"id 99 of the build was made at noon today")
    assert templates(b"one two three") == (3, [])
    assert templates(b"  \t ") == (0, [])


def test_recurring_lines_go_but_for_the_first(spark):
    rng = random.Random(2)
    shared = sentence(rng, 55)
    changed = " ".join("other" if k == 20 else w for k, w in enumerate(shared.split()))
    docs = {i: body(rng) for i in range(8)}
    clean = {i: "\n".join(b) for i, b in docs.items() if i > 4}
    rows = [(i, "\n".join([*b[:2], shared if i != 3 else changed, *b[2:]])) if i <= 4 else (i, clean[i]) for i, b in docs.items()]
    got = run(spark, rows)
    assert {k[0]: k[1] for k in got} == {0: rows[0][1], **{i: "\n".join(docs[i]) for i in range(1, 8)}}
    assert {k[0]: r.dropped_lines for k, r in got.items()} == {0: [], **{i: [2] for i in range(1, 5)}, 5: [], 6: [], 7: []}
    assert {r.n_lines for k, r in got.items() if k[0] <= 4} == {7}


def test_copies_stay_whole_and_own_together(spark):
    rng = random.Random(3)
    first, second, shared = body(rng), body(rng), sentence(rng, 60)
    text = "\n".join([*first, shared])
    near = "\n".join([*first[:-1], sentence(rng, 20), shared])
    rows = [(1, text), (9, text), (9, text), (4, near), (5, "\n".join([*second, shared]))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.text, r.n_dropped) for r in drop_recurring_lines(frame).collect())
    assert got == sorted([(1, text, 0), (9, text, 0), (9, text, 0), (4, near, 0), (5, "\n".join(second), 1)])


def test_short_lines_need_more_documents(spark):
    rng = random.Random(4)
    rows = [(i, "\n".join([*body(rng), "all rights reserved here"])) for i in range(12)]
    assert all(r.n_dropped == 0 for r in run(spark, rows[:9]).values())
    assert sum(r.n_dropped for r in run(spark, rows).values()) == 11
    few = [(i, "\n".join([*body(rng), "thanks a lot"])) for i in range(20)]
    assert all(r.n_dropped == 0 for r in run(spark, few).values())


def test_cases(spark):
    rng = random.Random(5)
    shared = sentence(rng, 30)
    rows = [(None, None), (1, None), (2, ""), (None, shared + "\n" + sentence(rng, 30)), (3, shared + "\n" + sentence(rng, 30)), (3, "x"), (4, "\n".join(body(rng, 2000)))]
    got = run(spark, rows)
    assert len(got) == len(rows)
    assert got[None, None].n_lines == 0 and got[2, ""].n_lines == 1
    assert sum(r.n_dropped for r in got.values()) == 1 and got[None, rows[3][1]].n_dropped == 0
    assert run(spark, []) == {}


def test_shuffled_join_gives_the_same(spark, monkeypatch):
    rng = random.Random(6)
    shared = sentence(rng, 50)
    rows = [(i, "\n".join([*body(rng), shared])) for i in range(6)]
    want = run(spark, rows)
    monkeypatch.setattr("sparkloom.llm.lines.BROADCAST_BYTES", -1)
    assert run(spark, rows) == want


def longest_shared(a, b):
    """Tokens of the longest run that both texts have."""
    a, b = a.split(), b.split()
    best, last = 0, {}
    for x in a:
        now = {j: last.get(j - 1, 0) + 1 for j, y in enumerate(b) if x == y}
        best = max(best, *now.values()) if now else best
        last = now
    return best


def test_passages_within_lines_go(spark):
    rng = random.Random(7)
    shared = sentence(rng, 52)
    wrapped = shared.split()
    rows = [(i, "\n".join([*body(rng, 3), sentence(rng, 10 * i + 7) + " " + shared + " " + sentence(rng, 60), *body(rng, 3)])) for i in range(4)]
    rows.append((8, "\n".join([*body(rng, 3), *(" ".join(wrapped[k : k + 13]) for k in range(0, 52, 13)), *body(rng, 3)])))
    rows.append((9, "\n".join([*body(rng, 3), *(" ".join(["x", *wrapped][k : k + 11]) for k in range(0, 53, 11)), *body(rng, 3)])))
    got = {k[0]: k[1] for k in run(spark, rows)}
    assert got[0] == rows[0][1]
    for i, text in rows[1:]:
        assert longest_shared(rows[0][1], text) >= 52 and longest_shared(got[0], got[i]) <= 11, i
        kept = iter(text.split())
        assert all(w in kept for w in got[i].split())
        assert len(text.split()) - 52 <= len(got[i].split()) <= len(text.split()) - 29


def test_shorter_stretches_stay(spark):
    rng = random.Random(8)
    shared = sentence(rng, 25)
    rows = [(i, sentence(rng, 60) + " " + shared + " " + sentence(rng, 60)) for i in range(4)]
    assert {k[0]: k[1] for k in run(spark, rows)} == dict(rows)


def test_query_and_pipeline_leave_no_loose_copies(spark, tmp_path):
    import corpus_pipeline
    from sparkloom.llm.queries import op9_lines

    rng = random.Random(9)
    shared = sentence(rng, 60)
    rows = [(i, f"{sentence(rng, 4)}\n{shared}") for i in range(12)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = {i: t if i == 0 else t.split("\n")[0] for i, t in rows}
    assert {r.doc_id: r.text for r in op9_lines(spark, str(tmp_path)).collect()} == want
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert {r.doc_id: r.text for r in corpus_pipeline.drop_lines(spark, docs, str(tmp_path)).collect()} == want


def test_shortest_lines_go_when_many_texts_have_them(spark):
    rng = random.Random(10)
    lines = {"thanks a lot": 25, "read more": 50, "Menu": 100}
    for least in (0, 1):
        rows = [(i, "\n".join([sentence(rng, 20), *(x for x, n in lines.items() if i < n - 1 + least)])) for i in range(120)]
        got = run(spark, rows)
        for x, n in lines.items():
            assert sum(x in r.text.split("\n") for r in got.values()) == (1 if least else n - 1), x


def brute_drops(rows):
    """Whole lines of LONG tokens or more that go by the template rule, found by comparing all pairs of lines."""
    texts = {t for _, t in rows if t}
    lines = [(t, k, templates(x.encode())) for t in texts for k, x in enumerate(t.split("\n"))]
    first = {t: min((i is not None, i or 0) for i, u in rows if u == t) for t in texts}
    gone = {}
    for t, k, (n, ids) in lines:
        if n >= 8:
            for x in ids:
                having = {u for u, _, (m, other) in lines if m >= 8 and x in other}
                if len(having) > 1 and min(having, key=lambda u: (first[u], u)) != t:
                    gone.setdefault(t, set()).add(k)
    return {t: sorted(gone.get(t, ())) for t in texts}


def test_dropped_lines_match_brute_force(spark):
    rng = random.Random(11)
    pool = [sentence(rng, rng.randint(8, 14)) for _ in range(30)]
    pool += [" ".join("9x" if k == 5 else w for k, w in enumerate(p.split())) for p in pool[:10]]
    rows = [(i if i != 7 else None, "\n".join([*rng.sample(pool, 3), *(sentence(rng, 9) for _ in range(3))])) for i in range(40)]
    rows += [(100, rows[3][1]), (-1, rows[5][1])]
    want = brute_drops(rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = drop_recurring_lines(frame, copy_share=1.0).collect()
    assert len(out) == len(rows)
    left = {t: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in want[t]) for t in want}
    assert sorted(r.text for r in out) == sorted(left[t] for _, t in rows)


def test_clashing_names(spark):
    rows = [(i, sentence(random.Random(12), 30), 1, 2, 3) for i in range(3)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, _gone int, _runs int, _id int")
    out = drop_recurring_lines(frame)
    assert out.columns == ["doc_id", "text", "_gone", "_runs", "_id", "n_lines", "n_dropped", "dropped_lines"] and out.count() == 3
