"""Registered queries of the subpackage: each operator over its whole table,
with production parameters.  ``ORACLE_SQL`` has the DuckDB SQL of those that
SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.llm import (bpe, chat, decontamination, fingerprints, jaccard, katz, licenses, neighbours, packing, periodic, pii, toxicity,
                         whitening)


def word_bpe_path() -> str:
    """Path of the public 49k word BPE, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.components(table(spark, sf_dir, "documents"), k=4, percent=85)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, rest = table(spark, sf_dir, "documents"), toxicity.crc_rest(F.col("doc_id"), 5)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), learn_from=rest != 0)
    return toxicity.score(docs, model).select("doc_id", F.coalesce(rest == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("spans")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    return found.withColumn("base_sha256", F.sha2("base_spans", 256)).drop("base_spans")


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.with_edits(table(spark, sf_dir, "documents"))


def op7_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score(table(spark, sf_dir, "documents"), mod=7, rest=2)


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest_documents(table(spark, sf_dir, "documents"), word_bpe_path())


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), word_bpe_path())


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    hard = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", hard), (-1, 1, "assistant", hard)],
                                  "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.read_back(chat.format_conversations(rows))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=16)


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    return decontamination.digests(found)


def op13_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.scan(table(spark, sf_dir, "documents"), shortest=6, exponent=4, edit=periodic.repeat_tail)
    return periodic.digests(found)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_jaccard": op1_jaccard,
    "op2_toxicity": op2_toxicity,
    "op3_licenses": op3_licenses,
    "op4_pii": op4_pii,
    "op5_neighbours": op5_neighbours,
    "op6_fingerprints": op6_fingerprints,
    "op7_katz": op7_katz,
    "op8_bpe": op8_bpe,
    "op9_packing": op9_packing,
    "op10_chat": op10_chat,
    "op11_whitening": op11_whitening,
    "op12_decontamination": op12_decontamination,
    "op13_periodic": op13_periodic,
}

ORACLE_SQL: dict[str, str] = {
    # All pairs of documents that share a shingle, then reachability.
    "op1_jaccard": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\v\f\r]+'), lambda x: x <> '') AS a FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(a) = 0 THEN [] WHEN len(a) < 4 THEN [array_to_string(a, ' ')]
           ELSE list_distinct(list_transform(range(1, len(a) - 2), lambda i: array_to_string(a[i:i + 3], ' '))) END AS sh FROM w),
u AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS x FROM s),
p AS (
  SELECT a.doc_id AS i, b.doc_id AS j, count(*) AS c, any_value(a.n) AS na, any_value(b.n) AS nb
  FROM u a JOIN u b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT i, j FROM p WHERE 100 * c >= 85 * (na + nb - c)),
r(i, j) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.i, e.j FROM r JOIN e ON r.j = e.i)
SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, m.c AS component_id
FROM s JOIN (SELECT i, min(j) AS c FROM r GROUP BY 1) m ON m.i = s.doc_id""",
    # The turns themselves; what formatting adds is three markers, a line end and an escape a control string.
    "op10_chat": r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
d AS (
  SELECT *, (length(role || text) - length(regexp_replace(role || text, '<(\\*\|im_(start|sep|end)\|>)', '\1', 'g'))) AS escapes FROM c)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(role) + length(text) + escapes + length('<|im_start|><|im_sep|><|im_end|>') + 1) AS BIGINT) AS formatted_chars
FROM d GROUP BY conv_id""",
    # Every window joined to the words of every document that begin with it.
    "op12_decontamination": r"""
WITH w AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS a FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS a FROM benchmark),
v AS (
  SELECT DISTINCT item, least(len(a), 10) AS k, unnest(list_transform(range(1, greatest(len(a) - 8, 2)), lambda i: array_to_string(a[i:i + 9], ' '))) AS x
  FROM b WHERE len(a) > 0),
s AS (SELECT DISTINCT k FROM v),
g AS (
  SELECT r, k, unnest(range(1, len(a) - k + 2)) AS i, unnest(list_transform(range(1, len(a) - k + 2), lambda i: array_to_string(a[i:i + k - 1], ' '))) AS x
  FROM w, s WHERE len(a) >= k),
o AS (SELECT r, i, k, item FROM g JOIN v USING (k, x)),
h AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest(range(i, i + k)) AS j FROM o) GROUP BY 1),
t AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM o) GROUP BY 1)
SELECT doc_id, CAST(len(a) AS BIGINT) AS n_words, CAST(coalesce(h.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(t.n, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, h.n IS NOT NULL AS contaminated
FROM w LEFT JOIN h USING (r) LEFT JOIN t USING (r)""",
}
