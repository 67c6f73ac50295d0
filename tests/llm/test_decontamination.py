"""Benchmark passages against a search for every window."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from almanac.llm import common
from almanac.llm import decontamination as D
from almanac.llm.common import NO_ALNUM, Words


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(text, items, window):
    d, hit, names = words(text), set(), set()
    for name, t in items:
        w = words(t)
        for x in [w[i:i + window] for i in range(len(w) - window + 1)] if len(w) >= window else [w] * bool(w):
            for i in range(len(d) - len(x) + 1):
                if d[i:i + len(x)] == x:
                    hit.update(range(i, i + len(x)))
                    names.add("" if name is None else str(name))
    return len(d), hit, names


def made(rng, letters, sizes):
    return " ".join(rng.choice("abcdefgh"[:letters]) for _ in range(rng.choice(sizes)))


def case(rng):
    letters, window = rng.choice([1, 2, 3, 6]), rng.choice([2, 3, 4, 10])
    items = [(rng.randrange(8), made(rng, letters, [0, 1, 2, 3, 5, 12, 20])) for _ in range(rng.randint(0, 5))]
    docs = [made(rng, letters, [0, 1, 3, 8, 30]) + rng.choice(["", " zz "]) + made(rng, letters, [0, 5, 20]) for _ in range(6)]
    for _, t in items:
        if rng.random() < 0.5:
            docs[rng.randrange(6)] += " x " + t.upper() + "! y"
    return items, docs, window


def automaton(items, window):
    w = Words(pa.array([t for _, t in items], pa.string()), NO_ALNUM)
    cut = [(str(items[k][0]), w.hash[a:b], bool(b - a < window)) for k, (a, b) in enumerate(zip(w.starts, w.starts[1:])) if b > a]
    return D.Automaton(cut, window)


def test_hits_and_items_equal_a_search_for_every_window():
    rng = random.Random(1)
    for _ in range(300):
        items, docs, window = case(rng)
        a, w = automaton(items, window), Words(pa.array(docs), NO_ALNUM)
        first, behind, state = a.hits(w.hash, w.starts)
        text = np.searchsorted(w.starts, first, side="right") - 1
        for k, doc in enumerate(docs):
            own = text == k
            _, hit, names = brute(doc, items, window)
            assert {i for x, y in zip(first[own], behind[own]) for i in range(x - w.starts[k], y - w.starts[k])} == hit
            assert a.items(np.unique(state[own])) == names


def test_longest_matches_equal_a_search():
    rng = random.Random(2)
    for _ in range(100):
        items = [(k, made(rng, 3, [1, 5, 20])) for k in range(3)]
        a = automaton(items, 10)
        assert len(a.link) <= 2 * sum(len(words(t)) for _, t in items) + 1 and len(a.keys) <= 3 * sum(len(words(t)) for _, t in items) + 1
        h = Words(pa.array([t := made(rng, 3, [40])])).hash
        known = np.isin(h, a.words)
        if known.all():
            _, match = a.stream(np.searchsorted(a.words, h), np.array([0]), np.array([len(h)]))
            held = [" " + " ".join(words(x)) + " " for _, x in items]
            w = words(t)
            for i in range(len(w)):
                longest = max(k for k in range(i + 2) if any(" " + " ".join(w[i + 1 - k:i + 1]) + " " in x for x in held) or not k)
                assert match[i] == longest


@pytest.mark.parametrize("block", [D.BLOCK, 15])
def test_scan_in_one_or_many_blocks_equals_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(D, "PIECE", 12)
    rng = random.Random(block)
    items = [(k % 9, made(rng, 4, [0, 1, 3, 5, 12, 30])) for k in range(14)] + [(None, "e e"), (3, None), (0, "c c"), (0, "c c")]
    docs = [made(rng, 5, [0, 4, 30, 80]) + ", " + rng.choice(items[:14])[1] + "." for _ in range(25)] + [None, "", "!", "e e"]
    table = spark.createDataFrame([(k, t, "x", 1) for k, t in enumerate(docs)], "doc_id long, text string, items string, n_hit int")
    bench = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, hits int")
    got = {r.doc_id: r for r in D.scan(table, bench, window=4, block=block).collect()}
    assert len(got) == len(docs)
    for k, t in enumerate(docs):
        n, hit, names = brute(t, items, 4)
        r = got[k]
        assert (r.n_words, r.n_hit, list(r["items"]), r.rejected) == (n, len(hit), sorted(names), len(hit) > n / 2)
        assert {i for s in r.spans for i in range(s.start, s.start + s.length)} == hit
        assert words(r.text) == [x for i, x in enumerate(words(t)) if i not in hit]
        assert (r.text is None) == (t is None) and (hit or r.text == t)


def test_only_long_stretches_go_and_digests(spark):
    bench = spark.createDataFrame([(7, "one two three"), (10, "two three four five")], "item_id int, text string")
    docs = spark.createDataFrame([(1, "X one two three y, two three FOUR five; z"), (1, "one two"), (None, None)], "doc_id int, text string")
    rows = sorted(D.scan(docs, bench, window=3, max_span=3, max_coverage=0.9).collect(), key=lambda r: -r.n_words)
    assert rows[0].text == "X one two three y, ; z" and not rows[0].rejected and rows[0]["items"] == ["10", "7"]
    digest = {r.n_words: tuple(r) for r in D.digests(D.scan(docs, bench, window=3)).collect()}
    assert digest[10] == (1, 10, 7, 2, hashlib.sha256(b"10,7").hexdigest(), True)
    assert digest[2] == (1, 2, 0, 0, hashlib.sha256(b"").hexdigest(), False) and digest[0][:4] == (None, 0, 0, 0)


def test_empty_tables(spark):
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert D.scan(docs.limit(0), bench).collect() == []
    r = D.scan(docs, bench.limit(0)).first()
    assert (r.n_words, r.n_hit, r["items"], r.text) == (3, 0, [], "a b c")
    assert D.scan(docs, bench).first().n_hit == 3
    common.sweep(spark)
    with pytest.raises(ValueError):
        D.scan(docs, bench, window=1)


def test_a_very_long_text_of_one_passage(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    docs = spark.createDataFrame([(1, (passage + " ") * 2000 + "end")], "doc_id long, text string")
    r = D.scan(docs, bench).first()
    assert (r.n_words, r.n_hit, r.rejected) == (120_001, 120_000, True) and r.text.strip() == "end"
