"""BPE against the tokenizers library, packing against its own rules."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from almanac.llm import bpe, packing

PATH = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def lib():
    return Tokenizer.from_file(PATH)


def odd_texts(n=3000):
    rng = random.Random(5)
    pool = [*"abA BZ'stremvlld.,!?  \t\n\x1c\x1f\x85\xa0ßẞİıΣσςéñ̃한글日本語١٢½²🙂0123", "<|endoftext|>", "<|startoftext|>", "'LL", "é", "é"]
    return ["".join(rng.choice(pool) for _ in range(rng.randint(0, 25))) for _ in range(n)] + [
        "", None, "ab" * 5000, "x" * 3000, "<|endoftext|><|endoftext|>", "   "]


def test_scalar_and_batch_encoders_equal_the_library(lib):
    texts = odd_texts()
    want = [lib.encode(t, add_special_tokens=False).ids if t else [] for t in texts]
    one, many = bpe.load(PATH), bpe.load_batch(PATH)
    assert [one.encode(t) for t in texts] == want
    ids, starts = many.encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(starts, starts[1:])] == want
    assert [one.decode(w) for w in want] == [lib.decode(w, skip_special_tokens=False) for w in want]


def test_merge_takes_the_leftmost_lowest_rank():
    spec = {"model": {"vocab": {c: i for i, c in enumerate(["a", "b", "aa", "ab", "aab"])},
                      "merges": ["a a", "a b", "aa b"]}}
    b = bpe.Bpe.__new__(bpe.Bpe)
    b.merges = {}
    v = spec["model"]["vocab"]
    for rank, m in enumerate(spec["model"]["merges"]):
        x, y = m.split()
        b.merges[v[x], v[y]] = (rank, v[x + y])
    assert b.merge([0, 0, 0]) == [2, 0]            # aaa: leftmost pair first
    assert b.merge([0, 0, 0, 1]) == [2, 3]
    assert b.merge([0, 0, 1]) == [4]
    assert b.merge([0]) == [0] and b.merge([]) == []


def test_decode_text_round_trip():
    b = bpe.load(PATH)
    assert b.decode_text(b.encode("Hello, wörld")) == "hello , wörld "
    assert b.decode_text(b.encode("a<|endoftext|>b")) == "a <|endoftext|>b "


def test_op8_equals_the_library_on_documents(spark, lib):
    from almanac.llm.queries import op8_bpe
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op8_bpe(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = lib.encode(docs[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_bpe_edge_rows(spark):
    df = spark.createDataFrame([(1, None, 9), (2, "", 9), (3, "a b", 9), (3, "a b", 9), (None, "x", 9)],
                               "doc_id long, text string, ids int")
    rows = sorted(bpe.encode_documents(df, PATH).collect(), key=lambda r: (r.doc_id or 0))
    assert [(r.doc_id, len(r.ids)) for r in rows] == [(None, 1), (1, 0), (2, 0), (3, 2), (3, 2)]
    assert bpe.digest_documents(df.limit(0), PATH).count() == 0


def check_packing(rows, limit):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for spans in by.values():
        at = 0
        for o, n in sorted(spans):
            assert o == at and n > 0
            at += n
        assert at <= limit
    return len(by)


def test_op9_places_every_piece_once(spark, lib):
    from almanac.llm.queries import op9_packing
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op9_packing(spark, SF).collect()
    n = check_packing(rows, 4096)
    got, total = defaultdict(dict), 0
    for r in rows:
        assert r.piece not in got[r.doc_id]
        got[r.doc_id][r.piece] = r
        total += r.length
    assert set(got) == set(docs)
    for k, t in docs.items():
        ids = np.array([*lib.encode(t, add_special_tokens=False).ids, 1], "<u4")
        assert sorted(got[k]) == list(range(-(-len(ids) // 4096)))
        for p, r in got[k].items():
            part = ids[p * 4096:(p + 1) * 4096]
            assert (r.start, r.length, r.ids_crc32) == (p * 4096, len(part), zlib.crc32(part.tobytes()))
    assert n <= -(-total // 4096) + 1


def test_packing_edge_rows(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "a b c d e f g", "x"), (3, "a b c d e f g", "x")],
                               "doc_id long, text string, offset string")
    rows = packing.pack(df, PATH, limit=4).collect()
    check_packing(rows, 4)
    assert Counter((r.doc_id, r.piece, r.length) for r in rows) == Counter(
        {(1, 0, 1): 1, (2, 0, 1): 1, (3, 0, 4): 2, (3, 1, 4): 2})
    assert packing.pack(df.limit(0), PATH).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_plan_conserves_pieces(seed):
    rng = random.Random(seed)
    limit = rng.choice([7, 64, 500])
    hist = {n: rng.randint(1, 40) for n in rng.sample(range(1, limit + 1), min(limit, 30))}
    p = packing.plan(hist, limit, grain=max(1, limit // 16))
    fill = defaultdict(list)
    for n, count in hist.items():
        mine = np.flatnonzero(p["length"] == n)
        first = np.append(p["first"][mine], count)
        for i, j in enumerate(mine):
            for d in range(first[i + 1] - first[i]):
                c = p["copies"][j]
                fill[p["sequence"][j] + d // c].append((p["offset"][j] + d % c * n, n))
    assert sum(map(len, fill.values())) == sum(hist.values())
    for spans in fill.values():
        at = 0
        for o, n in sorted(spans):
            assert o == at
            at += n
        assert at <= limit
    assert len(fill) <= -(-sum(n * c for n, c in hist.items()) // limit) * 1.5 + 1


def test_nnls_recovers_a_non_negative_solution():
    rng = np.random.default_rng(1)
    a, x = rng.random((12, 6)), np.array([0, 2.0, 0, 1, 0.5, 0])
    assert np.allclose(packing.nnls(a, a @ x), x, atol=1e-8)
    assert (packing.nnls(a, -np.ones(12)) == 0).all()
