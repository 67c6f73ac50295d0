"""A training corpus from raw documents, in four stages.

``STAGES`` lists (name, function).  Every function takes ``(spark, docs,
sf_dir)``; all but the last return the documents they keep, in the columns of
``documents``: toxic documents go, one document of each group of near copies
stays (its smallest doc_id), personal data is replaced in the texts.  The last
returns where every piece of every document lies in the packed sequences.  Each
result is written as Parquet and read back as the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from almanac.llm import jaccard, packing, pii, toxicity
from almanac.llm.common import store
from almanac.llm.queries import table, word_bpe_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score under 0.5, by a model fitted on the
    labelled ones among them."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard similarity of at least
    0.8 of five-word shingles."""
    return jaccard.one_of_each(docs, k=5, percent=80)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with e-mail, IP, card and phone spans replaced."""
    return pii.redact(docs)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of 4096 tokens."""
    return packing.pack(docs, word_bpe_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_copies),
    ("PII", hide_personal_data),
    ("best-fit packing", pack_documents),
]

#: The fitted models and the packing are outside SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = store(docs, f"stage{i}")
    return docs
