"""Toxicity, neighbours and fingerprints: held-out accuracy, recall, exact re-computation."""

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest

from almanac.llm import fingerprints, neighbours, toxicity

SF, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


# -- toxicity -------------------------------------------------------------------
def test_op2_on_held_out_documents(spark):
    from almanac.llm.queries import op2_toxicity
    rows = {r.doc_id: r for r in op2_toxicity(spark, SF01).collect()}
    assert len(rows) == 1000 and all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows.values())
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    held = [(rows[d].predicted, t) for d, t in truth.items() if rows[d].held_out]
    majority = max(np.mean([t for _, t in held]), 1 - np.mean([t for _, t in held]))
    assert np.mean([p == t for p, t in held]) >= max(0.9, majority + 0.01)


def toxic_corpus(n, rng):
    rows = []
    for i in range(n):
        bad = i % 8 == 0
        text = " ".join(rng.choice(["tree", "house", "river", "stone", "field"], rng.integers(3, 60))) + f" n{i}"
        if i % 3 == 0:
            text += " you see"
        if bad:
            text += " you " + rng.choice(["blarg", "skronk", "fnordish"])
        rows.append((i, text, int(bad)))
    return rows


def test_lexicon_obfuscation_and_clean_text(spark):
    rows = toxic_corpus(600, np.random.default_rng(0))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    s = model.score(pa.array(["river stone house tree field you blarg", "the tree by the house", "you sKr0nk house river tree stone", "", None,
                              "calm words about fields and rivers, you see"]))
    assert s[0] >= 0.5 and s[1] < 0.5 and s[3] == s[4] < 0.5 and s[5] < 0.5
    x = toxicity.features(pa.array(["you skr0nk house river tree stone"]), model.lexicon)
    assert x[0, toxicity.FEATURES.index("hidden hits")] > 0
    kept = toxicity.keep_clean(docs.withColumn("toxic", docs.doc_id), model)
    assert kept.columns == ["doc_id", "text", "toxic"]
    assert {r.doc_id for r in kept.collect()} == {i for i, _, y in rows if not y}


def test_toxicity_edges(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "a" * 300000, "x"), (3, "b", "x"), (None, "c", "x")], "doc_id long, text string, score string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score(docs, toxicity.fit(docs, none)).collect()} == {0.0}
    one = spark.createDataFrame([(1, 1), (3, 1), (99, 1)], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score(docs, toxicity.fit(docs, one)).collect()} == {1.0}
    both = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, 0), (None, 1), (99, None)], "doc_id long, toxic int")
    rows = toxicity.score(docs, toxicity.fit(docs, both)).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score(docs.limit(0), toxicity.fit(docs, both)).count() == 0


def test_features_do_not_depend_on_neighbours():
    texts = ["Ends with a sign.", "you 1d10t!", None, "", "it's", "3 x?", "!start", "A", "AA", "é", ".", "A"]
    lexicon = toxicity.Lexicon(np.array([int.from_bytes(b"idiot ", "little")], np.uint64), np.ones(1))
    together = toxicity.features(pa.array(texts), lexicon)
    assert (together == np.vstack([toxicity.features(pa.array([t], pa.string()), lexicon) for t in texts])).all()
    assert together[1, toxicity.FEATURES.index("hidden hits")] > 0


def plain_features(text, units):
    """The features of one text, a byte and a word at a time."""
    t = (text or "").encode()
    alnum = lambda c: chr(c).isalnum() and c < 128 or c > 127
    letter = lambda c: chr(c).isalpha() and c < 128
    upper = lambda c: 65 <= c <= 90
    sign = lambda c: 32 < c < 127 and not alnum(c)

    def words(b):
        out, w = [], b""
        for c in [*b, 32]:
            if alnum(c):
                w += bytes([c + 32 if upper(c) else c])
            elif w:
                out.append(w)
                w = b""
        return out

    def found(w):
        best = (0.0, None)
        for k in [*range(3, 9)]:
            cut = (w + b" ")[:8][:k]
            if units.get(cut, 0) > best[0]:
                best = (units[cut], cut)
        return best

    read = bytearray(t)
    for i, c in enumerate(t):
        if chr(c) in "0134578":
            read[i] = ord(toxicity.LOOK_ALIKE.get(chr(c), chr(c)))
        elif chr(c) in "@$!|":
            k = i
            while k < len(t) and chr(t[k]) in "@$!|":
                k += 1
            if k < len(t) and alnum(t[k]):
                read[i] = ord(toxicity.LOOK_ALIKE[chr(c)])
    w = words(t)
    hits = [(i, *found(x)) for i, x in enumerate(w) if found(x)[0] > 0]
    address = [i for i, x in enumerate(w) if x in [a.encode() for a in toxicity.ADDRESS]]
    near = 0
    for a in address:
        before = [i for i, _, _ in hits if i < a]
        after = [i for i, _, _ in hits if i >= a]
        near += (bool(before) and a - before[-1] <= 5) + (bool(after) and after[0] - a <= 5)
    pairs = list(zip([0, *t], t, [*t[1:], 0]))
    inside = [(x, c, y) for x, c, y in pairs if letter(x) and letter(y)]
    per, chars, letters = max(len(w), 1), max(len(t), 1), max(sum(map(letter, t)), 1)
    return [np.log1p(len(hits)), sum(v for _, v, _ in hits) / per, np.log1p(len({u for _, _, u in hits})), max((v for _, v, _ in hits), default=0),
            np.log1p(max(sum(found(x)[0] > 0 for x in words(bytes(read))) - len(hits), 0)), len(address) / per, np.log1p(near),
            sum(map(upper, t)) / letters, sum(upper(x) and upper(c) and upper(y) for x, c, y in pairs) / letters, t.count(b"!") / chars,
            t.count(b"?") / chars, sum(x == c and sign(c) for x, c, _ in pairs) / chars, sum(48 <= c <= 57 for _, c, _ in inside) / per,
            sum(sign(c) for _, c, _ in inside) / per, letters / per, np.log1p(len(w))]


def test_every_feature_equals_a_plain_count(monkeypatch):
    units = {b"idiot ": 1.5, b"blar": 2.0, b"skronk ": 0.7, b"blargist": 3.0, "éx".encode() + b" ": 1.0}
    lexicon = toxicity.Lexicon(np.array([int.from_bytes(u, "little") for u in units], np.uint64), np.array(list(units.values())))
    rng = np.random.default_rng(3)
    parts = ["you", "U", "Idiot", "1d10t!", "bl4rg", "blargistan", "BLAR", "skr0nk", "$kronk", "@@x", "a$$", "it's", "3x4y", "?!?!", "--", "éx", "tu", ".", "HELLO",
             "tree", "b!!ar", "!", "\n", "x" * 40]
    texts = ["".join(rng.choice([" ", "", "\t", " ", " "]) + rng.choice(parts) for _ in range(rng.integers(0, 60))) for _ in range(150)] + [None, ""]
    want = np.array([plain_features(t, units) for t in texts])
    assert np.allclose(toxicity.features(pa.array(texts), lexicon), want, rtol=1e-12) and (want[:, 4] > 0).any() and (want[:, 6] > 0).any()
    monkeypatch.setattr(toxicity, "SLICE", 50)                 # texts in several pieces
    assert np.allclose(toxicity.features(pa.array(texts), lexicon), want, rtol=1e-12)


def test_a_long_text_takes_memory_by_its_hits():
    import tracemalloc
    lexicon = toxicity.Lexicon(np.array([int.from_bytes(b"idiot ", "little")], np.uint64), np.ones(1))
    short, long = (pa.array(["calm words of a field by the river " * k]) for k in (30_000, 600_000))
    peak = []
    for t in (short, long):
        tracemalloc.start()
        toxicity.features(t, lexicon)
        peak.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peak[1] < 1.5 * peak[0] + 2 * 8 * 600_000 // 10


def test_first_split_has_the_greatest_gain():
    rng = np.random.default_rng(7)
    x = np.round(rng.normal(size=(60, 3)), 1)
    y = (x[:, 1] + rng.normal(size=60) > 0.2).astype(int)
    tree = toxicity.boost(x, y, trees=1, depth=1, bins=200)
    p = y.mean()
    g, h, best = y - p, np.full(60, p * (1 - p)), []
    for j in range(3):
        for cut in np.unique(x[:, j])[:-1]:
            left = x[:, j] <= cut
            if min(h[left].sum(), h[~left].sum()) >= 0.3:
                gain = g[left].sum()**2 / (h[left].sum() + 1) + g[~left].sum()**2 / (h[~left].sum() + 1) - g.sum()**2 / (h.sum() + 1)
                best.append((gain, j, cut))
    gain, j, cut = max(best)
    left = x[:, j] <= cut
    assert tree.features[0, 0] == j and ((x[:, j] <= tree.thresholds[0, 0]) == left).all()
    assert np.allclose(tree.leaves[0], [toxicity.RATE * g[m].sum() / (h[m].sum() + 1) for m in (left, ~left)])


def test_pooling_equals_the_least_squares_formula():
    rng = np.random.default_rng(8)
    m, y = np.round(rng.normal(size=40), 1), rng.integers(0, 2, 40)
    xs = np.unique(m)
    knots, values = toxicity.isotonic(m, y)
    for i, v in enumerate(xs):                                 # min over ends of max over starts of the mean between
        mean = lambda a, b: y[(m >= xs[a]) & (m <= xs[b])].mean()
        fit = min(max(mean(a, b) for a in range(i + 1)) for b in range(i, len(xs)))
        block = [k for k in range(len(xs)) if np.isclose(min(max(mean(a, b) for a in range(k + 1)) for b in range(k, len(xs))), fit)]
        own = y[np.isin(m, xs[block])]
        assert np.isclose(np.interp(v, knots, values), (own.sum() + 0.5) / (len(own) + 1), atol=0.02)


def test_isotonic_never_falls_and_trees_learn():
    rng = np.random.default_rng(1)
    m = rng.normal(size=500)
    y = (rng.random(500) < 1 / (1 + np.exp(-2 * m))).astype(int)
    knots, values = toxicity.isotonic(m, y)
    assert (np.diff(knots) >= 0).all() and (np.diff(values) >= 0).all()
    x = rng.normal(size=(800, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0)).astype(int)
    assert ((toxicity.boost(x, y).margin(x) > 0) == y).mean() > 0.95


# -- neighbours -------------------------------------------------------------------
def brute_nearest(ids, x, k):
    out = {}
    for i, q in zip(ids, x):
        if i % 20 == 0:
            s = neighbours.products(x, q)
            out[i] = sorted(((-v, j) for v, j in zip(s, ids) if j != i))[:k]
    return out


def vectors_of(spark, path):
    rows = spark.read.parquet(path).orderBy("vec_id").collect()
    return np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float64)


def test_op5_small_table_is_exact(spark):
    from almanac.llm.queries import op5_neighbours
    want = brute_nearest(*vectors_of(spark, f"{SF01}/embeddings.parquet"), 20)
    got = {}
    for r in op5_neighbours(spark, SF01).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((-r.score, r.vec_id))
        assert r["rank"] == len(got[r.query_id])
    assert got == want


@pytest.mark.parametrize("copies", [False, True])
def test_tables_reach_recall(spark, copies):
    ids, x = vectors_of(spark, "/root/testdata/sf0.1/embeddings.parquet")
    if copies:                          # a third of all rows are one vector
        x[::3] = x[1]
    found = total = 0
    t = neighbours.Tables(x, float(np.linalg.norm(x, axis=1).max()))
    pick = np.flatnonzero(ids % 20 == 0)
    met = t.candidates(x[pick])
    assert met.mean() < 0.9
    for i, row in zip(pick, met):
        exact = neighbours.best(x, ids, x[i], ids[i], np.arange(len(ids)), 20)[0]
        near = neighbours.best(x, ids, x[i], ids[i], np.flatnonzero(row), 20)[0]
        found += len(set(exact) & set(near))
        total += len(exact)
    assert found / total >= 0.9


def test_blocks_and_tables_through_spark(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    ids, x = vectors_of(spark, "/root/testdata/sf0.1/embeddings.parquet")
    want = brute_nearest(ids, x, 10)
    from pyspark.sql import functions as F
    got = {}
    for r in neighbours.nearest(vectors, F.col("vec_id") % 20 == 0, k=10, block=1500, chunk=60, whole=500).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert set(got) == set(want) and all(len(v) == 10 for v in got.values())
    assert np.mean([len(got[q] & {j for _, j in w}) / 10 for q, w in want.items()]) >= 0.9


@pytest.mark.parametrize("norms", ["one of 2", "one of 5", "one of 50", "lognormal"])
def test_tables_reach_recall_on_mixed_norms(spark, norms):
    ids, x = vectors_of(spark, "/root/testdata/sf0.1/embeddings.parquet")
    if norms == "lognormal":
        x *= np.exp(np.random.default_rng(1).normal(size=(len(x), 1)))
    else:
        x[77] *= int(norms.split()[-1])
    want = brute_nearest(ids, x, 20)
    from pyspark.sql import functions as F
    df = spark.createDataFrame(list(zip(ids.tolist(), x.tolist())), "vec_id long, embedding array<double>")
    got = {}
    for r in neighbours.nearest(df, F.col("vec_id") % 20 == 0, k=20, whole=0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    assert np.mean([len(got[q] & {j for _, j in w}) / 20 for q, w in want.items()]) >= 0.98


def test_small_tables_are_hashed_too(spark):
    from pyspark.sql import functions as F
    ids, x = vectors_of(spark, f"{SF01}/embeddings.parquet")
    df = spark.read.parquet(f"{SF01}/embeddings.parquet")
    got = {}
    for r in neighbours.nearest(df, F.col("vec_id") % 20 == 0, k=20, miss=2.0).collect():   # no query is compared with all rows
        got.setdefault(r.query_id, set()).add(r.vec_id)
    want = brute_nearest(ids, x, 20)
    shares = [len(got[q] & {j for _, j in w}) / 20 for q, w in want.items()]
    assert 0.8 < np.mean(shares) < 1


def test_chance_of_a_missed_row_is_what_happens():
    rng = np.random.default_rng(4)
    q = rng.normal(size=(1, 16))
    unit = q / np.linalg.norm(q)
    for c in (0.5, 0.7, 0.9):
        away = rng.normal(size=(400, 16))
        away -= (away @ unit.T) * unit
        x = c * unit + np.sqrt(1 - c * c) * away / np.linalg.norm(away, axis=1, keepdims=True)   # products of c
        told, was = [], []
        for seed in range(40):
            t = neighbours.Tables(x, 1.0, tables=2, probes=30, seed=seed)
            told.append(t.missed(q, np.array([c]))[0])
            was.append(1 - t.candidates(q).mean())
        assert abs(np.mean(told) - np.mean(was)) < 0.03


def test_bands_without_better_rows_are_left_out_and_sure_ones_not_scanned():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(50, 32))
    x = np.repeat(centres / np.linalg.norm(centres, axis=1, keepdims=True), 40, axis=0) + 0.002 * rng.normal(size=(2000, 32))
    x[1::2] *= 0.01
    ids = np.arange(len(x))
    b = neighbours.Block(x, ids, 10, neighbours.RATIO, neighbours.MISS, (7,))
    got = b.search(x[::40], ids[::40])
    assert len(b.parts) == 2 and list(b.tables) == [0] and b.scans == 0
    for i, (found, _) in zip(ids[::40], got):
        assert found.tolist() == neighbours.best(x, ids, x[i], i, ids, 10)[0].tolist()


def test_neighbour_edges(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [float("nan"), 1.0]), (6, [None, 1.0]),
            (7, []), (20, [float("inf"), 1.0]), (40, [1.0, 2.0, 3.0]), (60, [-1.0, 5.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, score string")
    from pyspark.sql import functions as F
    df = df.unionByName(df).unionByName(df.where("vec_id = 60").selectExpr("vec_id", "array(float(3), float(3)) embedding", "score"))
    got = [tuple(r) for r in neighbours.nearest(df, F.col("vec_id") % 20 == 0, k=2).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (60, 1, 0, -1.0), (60, 2, 1, -1.0)]
    assert neighbours.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


# -- fingerprints -------------------------------------------------------------------
def brute_edits(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    for i, (d, t) in enumerate(rows):
        t, u = t or "", rows[(i + 1) % len(rows)][1] or ""
        h = len(t) // 2
        yield d, t, t[:len(t) - h] + u[:h], u


def check_edits(spark, rows, got):
    maker = fingerprints.Minhash()
    want = list(brute_edits(rows))
    codes = {t: maker.packed(*maker.codes(pa.array([t])))[0] for _, *ts in want for t in ts}
    def key(r):
        return (r[0] is None, r[0] or 0, r[1], r[2])
    got = sorted(((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) for r in got), key=key)
    want = sorted(((d, len(t), hashlib.sha256(e.encode()).hexdigest(), codes[t], codes[e], fingerprints.likeness(codes[t], codes[e]),
                    fingerprints.likeness(codes[t], codes[u])) for d, t, e, u in want), key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want])


def test_op6_equals_brute_force(spark):
    from almanac.llm.queries import op6_fingerprints
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    check_edits(spark, rows, op6_fingerprints(spark, SF).collect())


def test_fingerprint_edges(spark):
    rows = [(3, "a b c d e f g h"), (1, None), (2, ""), (9, "x"), (9, "x"), (9, "aé🙂b"), (None, "n o"), (5, "k " * 100000)]
    for some in (rows, rows[:1]):
        df = spark.createDataFrame([(d, t, 1) for d, t in some], "doc_id long, text string, part int")
        check_edits(spark, some, fingerprints.with_edits(df.repartition(3)).collect())
    df = spark.createDataFrame([(3, "a", 1)], "doc_id long, text string, part int")
    assert fingerprints.with_edits(df.limit(0)).count() == 0
    assert fingerprints.fingerprint(df).columns == ["doc_id", "fingerprint"]


def test_estimates_follow_jaccard():
    rng = np.random.default_rng(3)
    maker = fingerprints.Minhash()
    for share in (0.2, 0.5, 0.8):
        errors = []
        for _ in range(30):
            a = rng.integers(0, 10**9, 600).astype(str).tolist()
            b = a[:int(600 * share)] + rng.integers(0, 10**9, 600 - int(600 * share)).astype(str).tolist()
            sets = [{tuple(x[i:i + 5]) for i in range(596)} for x in (a, b)]
            codes, some = maker.codes(pa.array([" ".join(a), " ".join(b)]))
            errors.append(maker.likeness(codes[:1], some[:1], codes[1:], some[1:])[0] - len(sets[0] & sets[1]) / len(sets[0] | sets[1]))
        assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.08
