"""N-gram Jaccard join and Katz backoff against brute force."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from almanac.llm import components, jaccard, katz

SF = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_components(rows, k, percent):
    """(doc_id, set size, component) of each row, all pairs."""
    sets = []
    for _, t in rows:
        w = words(t)
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    for i, s in enumerate(sets):
        for j, both in Counter(j for x in s for j in holders[x] if j < i).items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                up[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        low[root(i)] = min(low.get(root(i), d), d)
    return sorted((d, len(s), low[root(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def ours(df, k, percent):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.components(df, k, percent).collect())


def near_copies(seed, groups=6, each=14):
    """Groups of edited copies, chains of growing edits, passages many rows share."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocab) for _ in range(30)]
    rows, n = [], 0
    for _ in range(groups):
        base = [rng.choice(vocab) for _ in range(rng.randint(5, 120))] + passage * rng.randint(0, 2)
        chain = list(base)
        for _ in range(each):
            own = list(base)
            for _ in range(rng.randint(0, 6)):
                own[rng.randrange(len(own))] = rng.choice(vocab)
            chain[rng.randrange(len(chain))] = rng.choice(vocab)
            rows += [(n, " ".join(own)), (n + 1, " ".join(chain))]
            n += 2
    rows += [(n + i, " ".join(passage)) for i in range(4)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,k,percent", [(1, 4, 85), (2, 5, 80), (3, 2, 60)])
def test_components_equal_brute_force(spark, seed, k, percent):
    rows = near_copies(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert ours(df, k, percent) == brute_components(rows, k, percent)


@pytest.mark.parametrize("k,percent", [(4, 85), (2, 60)])
def test_many_unlike_documents_with_the_same_shingles(spark, monkeypatch, k, percent):
    """Long lists of many components, in small parts and small buckets."""
    monkeypatch.setattr(jaccard, "LIST", 7)
    monkeypatch.setattr(jaccard, "BUCKET", 60)
    rng = random.Random(11)
    phrases = [" ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") * 2 for _ in range(9)) for _ in range(9)]
    rows = [(i, " ".join(rng.choice(phrases) for _ in range(rng.randint(1, 4)))) for i in range(400)]
    want = brute_components(rows, k, percent)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert ours(df, k, percent) == want
    assert 5 < len({c for _, _, c in want}) < 350      # neither one component nor none
    table = jaccard.set_table(jaccard.columns(df), k)
    assert jaccard.bucket_bits(table) >= 6


@pytest.mark.parametrize("seed,k,percent,most", [(1, 4, 85, 1024), (3, 2, 60, 5)])
def test_links_equal_brute_force(spark, monkeypatch, seed, k, percent, most):
    monkeypatch.setattr(jaccard, "LIST", most)
    rows = near_copies(seed)
    rows += [(1000 + d, t) for d, t in rows[:9]] + [(2000, None), (2001, ""), (2002, "alone"), (2003, "Alone"), (2004, "apart")]
    sets = []
    for _, t in rows:
        w = words(t)
        sets.append(frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else []))
    count, apart = Counter(), set()
    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                count[rows[i][0]] += 1
                count[rows[j][0]] += 1
                apart |= {frozenset((x, y))} if x != y else set()
    pairs, members = jaccard.links(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), k, percent)
    fp = {}
    for r in members.collect():
        assert r.n_links == count[r.doc_id]
        fp[r.doc_id] = r.fp
    own = {fp[d]: s for (d, _), s in zip(rows, sets)}
    got = [(r.a, r.b) for r in pairs.collect()]
    assert len(members.collect()) == len(rows) and len(got) == len(apart) > 50
    assert {frozenset((own[a], own[b])) for a, b in got} == apart and all(a < b for a, b in got)


def test_frequent_shingles_take_salted_buckets(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "FREQUENT_LEAST", 3)
    rows = near_copies(7)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    table = jaccard.set_table(df, 4)
    assert len(jaccard.frequent(table)[0]) > 10
    assert ours(df, 4, 85) == brute_components(rows, 4, 85)


def test_op1_on_documents(spark):
    from almanac.llm.queries import op1_jaccard
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in op1_jaccard(spark, SF).collect())
    assert got == brute_components(rows, 4, 85)


def test_jaccard_edges(spark):
    rows = [(5, None), (6, ""), (7, " \t "), (8, "a b"), (9, "A  b"), (3, "a b c"), (10, "x y z w v u"), (10, "x y z w v u"), (2, "q " * 30000)]
    df = spark.createDataFrame([(d, t, "extra", 1) for d, t in rows], "doc_id long, text string, fp string, n int")
    assert ours(df, 4, 85) == brute_components(rows, 4, 85)
    kept = jaccard.one_of_each(df, 5, 80)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 5, 6, 7, 8, 10, 10]
    assert jaccard.components(df.limit(0)).count() == 0


def test_suffix_bound_and_decision():
    rng = np.random.default_rng(4)
    for _ in range(400):
        x, y = (np.unique(rng.integers(0, 60, rng.integers(1, 50)).astype(np.uint64)) for _ in "xy")
        assert jaccard.suffix_bound(x, y) <= len(np.setxor1d(x, y))
        both = len(np.intersect1d(x, y))
        assert jaccard.linked(x, len(x) + 2, y, len(y) + 1, 50) == (100 * both >= 50 * (len(x) + len(y) + 3 - both))


def test_connected_chain_and_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 201), (200, 201)]
    got = {r.node: r.component for r in components.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 140), 100), 200: 200, 201: 200}


# -- Katz -------------------------------------------------------------------
def brute_katz(rows, mod, rest):
    """The model by dictionaries; also its conditional distributions."""
    def out(d):
        return d is None or zlib.crc32(str(d).encode()) % mod == rest
    toks = [(d, [*words(t), None]) for d, t in rows]
    uni, big, ctx, texts = Counter(), Counter(), Counter(), 0
    for d, t in toks:
        if not out(d):
            texts += 1
            uni.update(t)
            for h, w in zip(["<s>", *t], t):
                big[h, w] += 1
                ctx[h] += 1
    n, v = sum(uni.values()), len(uni)

    def of(c):
        return np.array([sum(x == r for x in c.values()) for r in range(1, katz.TOP + 2)])
    alone = katz.Alone.of(n, v, of(uni))
    d = katz.good_turing(of(big))
    p1 = {w: float(alone.p(np.array([c]))[0]) for w, c in uni.items()}
    followers = defaultdict(dict)
    for (h, w), r in big.items():
        followers[h][w] = r
    seen, alpha = {}, {}
    for h, fs in followers.items():
        pr = {w: d[min(r, katz.TOP + 1)] * r / ctx[h] for w, r in fs.items()}
        if sum(pr.values()) >= 1 - 1e-12:
            pr = {w: r / (ctx[h] + 1) for w, r in fs.items()}
        seen[h] = pr
        alpha[h] = (1 - sum(pr.values())) / max(1 - sum(p1[w] for w in fs), 1e-300)

    def prob(h, w):
        if w in seen.get(h, {}):
            return seen[h][w]
        return alpha.get(h, 1.0) * p1.get(w, alone.unknown)

    scores = [(d_, out(d_), len(t), sum(w in uni for w in t), n, sum(math.log10((uni[w] + 1) / (n + v + 1)) for w in t),
               sum(math.log10(prob(h, w)) for h, w in zip(["<s>", *t], t))) for d_, t in toks]
    return scores, prob, uni, followers, alone


def close(a, b):
    return a[:5] == b[:5] and math.isclose(a[5], b[5], rel_tol=1e-9, abs_tol=1e-9) and math.isclose(a[6], b[6], rel_tol=1e-8, abs_tol=1e-8)


def same_scores(got, want):
    def order(r):
        return (r[0] is None, r[0] or 0, r[2], r[6])
    got, want = sorted((tuple(r) for r in got), key=order), sorted(want, key=order)
    assert len(got) == len(want)
    assert [(a, b) for a, b in zip(got, want) if not close(a, b)] == []


def test_op7_equals_brute_force(spark):
    from almanac.llm.queries import op7_katz
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    same_scores(op7_katz(spark, SF).collect(), brute_katz(rows, 7, 2)[0])


def test_katz_edges_and_small_slices(spark, monkeypatch):
    monkeypatch.setattr(katz, "SLICE", 40)
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice("abcdefghij") for _ in range(rng.randint(0, 30)))) for i in range(60)]
    rows += [(60, None), (61, ""), (None, "a b zz"), (3, "A b"), (3, "A b"), (70, "new words " * 50), (71, "x" * 5000)]
    df = spark.createDataFrame([(d, t, 0.5) for d, t in rows], "doc_id long, text string, score double")
    same_scores(katz.score(df, 3, 1).collect(), brute_katz(rows, 3, 1)[0])
    assert katz.score(df.limit(0)).count() == 0


def test_katz_without_training_texts(spark):
    df = spark.createDataFrame([(None, "a b"), (None, None)], "doc_id long, text string")
    assert sorted((r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in katz.score(df).collect()) == [
        (1, 0, 0, 0.0, 0.0), (3, 0, 0, 0.0, 0.0)]


def test_distributions_are_normalised():
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice("aabbbcdefgh") for _ in range(rng.randint(1, 40)))) for i in range(50)]
    _, prob, uni, followers, alone = brute_katz(rows, 7, 2)
    for h in [*followers, "never"]:
        assert math.isclose(sum(prob(h, w) for w in uni) + prob(h, "unknown word"), 1, rel_tol=1e-9)


def test_good_turing_falls_back():
    for counts in ([0] * 6, [5, 0, 0, 0, 0, 0], [10, 20, 30, 40, 50, 60], [100, 40, 20, 12, 8, 6]):
        d = katz.good_turing(np.array(counts))
        assert len(d) == katz.TOP + 2 and (d[1:] > 0).all() and (d[1:] <= 1).all()


def test_held_out_text_scores_above_the_base(spark):
    rows = [r for r in katz.score(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)
