"""The pipeline's stages, each against a brute-force version on its own input."""

import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

import corpus_pipeline as P
from almanac.llm import pii, toxicity
from test_bpe_packing import check_packing
from test_jaccard_katz import brute_components

SF = "/root/testdata/sf0.001"


def test_stages_equal_brute_force(spark):
    names = [n for n, _ in P.STAGES]
    assert names == ["toxicity", "n-gram Jaccard join", "PII", "best-fit packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    columns, texts = docs.columns, {r.doc_id: r.text for r in docs.collect()}

    kept = P.drop_toxic(spark, docs, SF).cache()
    model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    want = {d for d, t in texts.items() if model.score(pa.array([t]))[0] < 0.5}
    assert kept.columns == columns and {r.doc_id for r in kept.collect()} == want

    one = P.drop_near_copies(spark, kept, SF).cache()
    groups = brute_components([(d, texts[d]) for d in want], 5, 80)
    assert one.columns == columns and sorted(r.doc_id for r in one.collect()) == sorted({c for _, _, c in groups})

    clean = P.hide_personal_data(spark, one, SF).cache()
    field = pii.learn(one)
    rows = {r.doc_id: r for r in clean.collect()}
    assert clean.columns == columns and set(rows) == {c for _, _, c in groups}
    for d, r in rows.items():
        assert r.text == pii.redacted(texts[d], pii.all_spans(texts[d], field)[1]) and r.n_chars == len(r.text)
        assert pii.base_spans(r.text) == []

    packed = P.pack_documents(spark, clean, SF).collect()
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    sizes = {d: len(lib.encode(r.text, add_special_tokens=False).ids) + 1 for d, r in rows.items()}
    total = {}
    for r in packed:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
    assert total == sizes and check_packing(packed, 4096) <= -(-sum(sizes.values()) // 4096) + 1


def test_run_and_empty_input(spark):
    rows = P.run(spark, SF)
    assert rows.columns[:3] == ["doc_id", "piece", "start"] and rows.count() > 100
    empty = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in P.STAGES:
        empty = stage(spark, empty, SF)
        assert empty.count() == 0
