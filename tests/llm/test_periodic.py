"""Periodic runs against a scan of all periods."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from almanac.llm import periodic as P
from almanac.llm import queries as Q
from hypothesis import given
from hypothesis import strategies as st


def brute(w, shortest=6, exponent=4):
    out = {}
    for q in range(1, len(w) // exponent + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(shortest, exponent * q):
                out.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


def symbols(rng, most):
    n, k = rng.choice([0, 1, 3, 5, 6, 8, 20, 60, most]), rng.choice([1, 2, 3, 30])
    t = [rng.randrange(k) for _ in range(n)]
    if n > 3 and rng.random() < 0.5:
        a = rng.randrange(n)
        p = 1 + (n - a) // rng.randint(3, 10)
        t = t[:a] + [t[a + i % p] for i in range(n - a)]
    return np.array(t, np.int32)


def expanded(g):
    rule = {first + k: (int(x), int(y), block) for (first, left, right), block in zip(g.rules, g.block) for k, (x, y) in enumerate(zip(left, right))}

    def of(s):
        if s not in rule:
            return [s]
        x, y, block = rule[s]
        return of(x) * y if block else of(x) + of(y)
    return [x for s in g.strings[-1].tolist() for x in of(s)]


@pytest.mark.parametrize("shortest,exponent", [(6, 4), (2, 2), (6, 3)])
def test_runs_equal_a_scan_of_all_periods(shortest, exponent):
    rng = random.Random(exponent)
    for _ in range(60):
        texts = [symbols(rng, 200) for _ in range(rng.randint(1, 8))]
        found = P.find(texts, 30, shortest, exponent)
        assert [list(map(tuple, f.tolist())) for f in found] == [brute(t.tolist(), shortest, exponent) for t in texts]


@given(st.lists(st.lists(st.integers(0, 2), max_size=40), min_size=1, max_size=4))
def test_grammar_gives_the_texts_back_and_extends_exactly(texts):
    arrays = [np.array(t, np.int32) for t in texts]
    g = P.Grammar(arrays, 3)
    assert expanded(g) == g.strings[0].tolist()
    for b, t in zip(g.begin, texts):
        i, j = (x.ravel() for x in np.triu_indices(len(t), 1))
        if len(i):
            ahead, behind = g.extend(b + i, b + j), g.extend(b + i, b + j, back=True)
            for x, y, m, k in zip(i.tolist(), j.tolist(), ahead.tolist(), behind.tolist()):
                assert t[x:x + m] == t[y:y + m] and (y + m == len(t) or t[x + m] != t[y + m])
                assert t[x - k:x] == t[y - k:y] and (x == k or t[x - k - 1] != t[y - k - 1])


def test_one_word_a_text_long_is_one_run_and_grid_parts_join(monkeypatch):
    monkeypatch.setattr(P, "GRID", 7)
    rng = random.Random(5)
    texts = [np.zeros(5000, np.int32)] + [symbols(rng, 300) for _ in range(6)]
    found = P.find(texts, 30)
    assert found[0].tolist() == [[0, 5000, 1]]
    assert [list(map(tuple, f.tolist())) for f in found[1:]] == [brute(t.tolist()) for t in texts[1:]]


def altered(i, w):
    h = zlib.crc32(str(i).encode())
    if h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]


def expected(i, text):
    w = altered(i, (text or "").encode().split())
    runs = brute(w)
    keep = [k for k in range(len(w)) if not any(s + q <= k < s + n for s, n, q in runs)]
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (i, len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2],
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(b" ".join(w[k] for k in keep)).hexdigest())


def test_op13_equals_brute_force_on_the_tables_shorter_texts(spark):
    docs = Q.table(spark, "/root/testdata/sf0.001", "documents")
    rows = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: tuple(r) for r in Q.op13_periodic(spark, "/root/testdata/sf0.001").collect()}
    assert set(got) == set(rows)
    short = [i for i, t in rows.items() if len(t or "") < 6000]
    assert len(short) > 150 and any(got[i][1] for i in short)
    assert [got[i] for i in short] == [expected(i, rows[i]) for i in short]


def test_op13_edges(spark):
    texts = [None, "", " \t\n", "a " * 6, "a " * 5, "a b " * 4, "x a b a b a b a b a y y y y y y", "é\x1cé " * 7, "A a " * 5, "w" * 50_000 + " " + "u v w " * 3000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, "b " * 9)]
    docs = spark.createDataFrame([(i, t, 1, "n") for i, t in rows], "doc_id long, text string, n_words int, runs string")
    found = P.scan(docs).collect()
    assert len(found) == len(rows)
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in found)
    want = []
    for i, t in rows:
        w = (t or "").encode().split()
        runs = brute(w) if len(w) < 1000 else [(1, 9000, 3)]
        keep = [k for k in range(len(w)) if not any(s + q <= k < s + n for s, n, q in runs)]
        want.append((i if i is not None else -1, len(w), runs, b" ".join(w[k] for k in keep).decode()))
    assert got == sorted(want)
    assert P.digests(P.scan(docs.limit(0))).collect() == []
    empty = P.digests(P.scan(docs.where("doc_id = 0"))).first()
    none = hashlib.sha256(b"").hexdigest()
    assert tuple(empty) == (0, 0, None, None, None, None, none, none)
    with pytest.raises(ValueError):
        P.find([np.zeros(4, np.int32)], 1, exponent=1)
