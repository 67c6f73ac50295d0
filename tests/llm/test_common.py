"""Word cutting and hashing against plain Python."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from almanac.llm import common


@pytest.mark.parametrize("separators,pattern", [(common.BLANK, r"[^\x20\x09-\x0D]+"), (common.NO_ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")])
def test_words_equal_the_pattern(separators, pattern):
    rng = random.Random(1)
    texts = ["".join(rng.choice("abAZ09 .@[`{~\x7fé日\t\n\x1c") for _ in range(rng.randint(0, 60))) for _ in range(2000)] + [None, "", "x" * 700]
    w = common.Words(pa.array(texts), separators)
    seen = {}
    for i, t in enumerate(texts):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        own = [(bytes(w.low[a:b]).decode(), int(h)) for a, b, h in zip(*(x[w.starts[i]:w.starts[i + 1]] for x in (w.begin, w.end, w.hash)))]
        assert [x for x, _ in own] == re.findall(pattern, low)
        assert all(seen.setdefault(x, h) == h for x, h in own)
    assert len(set(seen.values())) == len(seen)
    part = common.Words(pa.array(texts)[500:700], separators)       # a slice of an array gives the same
    assert (part.hash == w.hash[w.starts[500]:w.starts[700]]).all()


def test_rolling_and_sets():
    h = common.Words(pa.array(["a b c a b c a"])).hash
    r = common.rolling(h, 3)
    assert len(r) == 5 and r[0] == r[3] and r[1] == r[4] and len(set(r.tolist())) == 3
    assert len(common.rolling(h, 8)) == 0


def test_slices_bound_the_text():
    b = pa.record_batch({"doc_id": list(range(50)), "text": ["x" * (i * 10) if i % 7 else None for i in range(50)]})
    cut = list(common.slices(b, 1000))
    assert pa.Table.from_batches(cut).to_pylist() == pa.Table.from_batches([b]).to_pylist()
    assert len(cut) > 5 and all(sum(len(t or "") for t in c["text"].to_pylist()) <= 1500 for c in cut)


def test_stored_tables_come_back_and_go(spark):
    df = common.store(spark.range(10).withColumnRenamed("id", "n"), "t")
    by = common.store_by(spark.range(10), "t", "id")
    assert df.count() == 10 and by.count() == 10
    common.sweep(spark)
    with pytest.raises(Exception):
        by.count()
    assert not common._STORED


def test_mix_is_a_bijection_on_a_sample():
    x = np.arange(100_000, dtype=np.uint64)
    assert len(np.unique(common.mix64(x))) == len(x)
