"""Document fingerprints by one-permutation MinHash.

Every shingle is hashed once; its high bits name one of ``bins`` bins and the
rest competes for the bin's minimum.  An empty bin takes the minimum of a bin
chosen by a second hash of (bin, attempt) until that one is filled (optimal
densification: each empty bin draws on its own).  Of every minimum the low
``bits`` bits are kept, packed.  Two fingerprints agree in a bin by chance with
probability 2**-bits, so likeness is ``(agreeing share - c) / (1 - c)`` with c =
2**-bits, not below 0.

Shingles are runs of ``k`` words; a text of fewer words is one shingle, and one
without words has the empty fingerprint, like itself (1) and nothing else (0).

Each document also meets its successor by doc_id.  Rows are dealt to parts by
known id borders and sorted inside them (one shuffle); the first row of each
part is copied to the part before, so nothing is gathered and no task holds more
than a few texts.

Defined results: a null text is empty; equal ids go by text, a null id comes
first; a table of one row is its own successor; no rows give no rows; extra
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.llm.common import Words, columns, mix64, partitions, rolling, slices

BINS, BITS, K = 256, 4, 5
_EMPTY = np.uint64(2**64 - 1)


class Minhash:
    def __init__(self, bins: int = BINS, bits: int = BITS, k: int = K):
        if bins & (bins - 1) or bits not in (1, 2, 4, 8):
            raise ValueError("bins must be a power of two, bits 1, 2, 4 or 8")
        self.bins, self.bits, self.k = bins, bits, k
        self.shift = np.uint64(64 - bins.bit_length() + 1)

    def minima(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Minimum of each bin of each text, filled; and which texts have words."""
        w = Words(texts)
        n, k = np.diff(w.starts), self.k
        long = n >= k
        runs = rolling(w.hash, k)
        count = np.where(long, n - k + 1, 0)
        doc = np.repeat(np.arange(len(n)), count)
        at = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(w.starts[:-1], count)
        docs, shingles = [doc], [runs[at]]
        for size in range(1, k):       # shorter texts are one shingle
            few = np.flatnonzero(n == size)
            if len(few):
                docs.append(few)
                shingles.append(rolling(w.hash, size)[w.starts[few]])
        doc, h = np.concatenate(docs), np.concatenate(shingles)
        out = np.full(len(n) * self.bins, _EMPTY)
        np.minimum.at(out, doc * self.bins + (h >> self.shift).astype(np.int64), h)
        return self.densified(out.reshape(len(n), self.bins), n > 0), n > 0

    def densified(self, low: np.ndarray, some: np.ndarray) -> np.ndarray:
        filled = low != _EMPTY
        rows, bins = np.nonzero(~filled & some[:, None])
        attempt = 0
        out = low.copy()
        while len(rows):
            attempt += 1
            draw = mix64((bins.astype(np.uint64) << np.uint64(32)) + np.uint64(attempt)) % np.uint64(self.bins)
            ok = filled[rows, draw.astype(np.int64)]
            out[rows[ok], bins[ok]] = low[rows[ok], draw.astype(np.int64)[ok]]
            rows, bins = rows[~ok], bins[~ok]
        return out

    def codes(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        low, some = self.minima(texts)
        return (low & np.uint64((1 << self.bits) - 1)).astype(np.uint8), some

    def packed(self, codes: np.ndarray, some: np.ndarray) -> list[str]:
        per = 8 // self.bits
        parts = codes.reshape(len(codes), -1, per)
        packed = np.zeros(parts.shape[:2], np.uint8)
        for i in range(per):
            packed |= parts[:, :, i] << np.uint8(self.bits * i)
        return [p.tobytes().hex() if s else "" for p, s in zip(packed, some)]

    def likeness(self, a, some_a, b, some_b) -> np.ndarray:
        chance = 2.0 ** -self.bits
        share = (a == b).mean(axis=1) if len(a) else np.empty(0)
        return np.where(some_a & some_b, np.clip((share - chance) / (1 - chance), 0, 1), (some_a == some_b).astype(float))


def likeness(a: str, b: str, bits: int = BITS) -> float:
    """Likeness of two packed fingerprints."""
    if not a or not b:
        return float(a == b)
    chance = 2.0 ** -bits
    x = np.frombuffer(bytes.fromhex(a), np.uint8) ^ np.frombuffer(bytes.fromhex(b), np.uint8)
    mask = np.uint8((1 << bits) - 1)
    share = np.mean([((x >> np.uint8(s)) & mask) == 0 for s in range(0, 8, bits)])
    return float(np.clip((share - chance) / (1 - chance), 0, 1))


def fingerprint(docs: DataFrame, bins: int = BINS, bits: int = BITS, k: int = K) -> DataFrame:
    """``doc_id, fingerprint`` of every document; no shuffle."""
    maker = Minhash(bins, bits, k)

    def run(batches):
        for b in (s for b in batches for s in slices(b, 16 << 20)):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(maker.packed(*maker.codes(b.column(1))), pa.string())],
                                             names=["doc_id", "fingerprint"])

    return columns(docs).mapInArrow(run, "doc_id long, fingerprint string")


def edited_text(text: str, following: str) -> str:
    """The last half (rounded down, in code points) replaced by as many first
    ones of the following text, or all of it."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


# -- successors ---------------------------------------------------------------
def in_parts(docs: DataFrame) -> DataFrame:
    """``part, ahead, doc_id, text``: sorted parts by ranges of doc_id, each
    closed by a copy (``ahead`` 1) of the row that follows its last."""
    spark = docs.sparkSession
    lowest = -(2**63)
    rows = columns(docs).select(F.coalesce("doc_id", F.lit(lowest)).alias("key"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    want = 4 * partitions(spark)
    found = rows.approxQuantile("key", [i / want for i in range(1, want)], 1 / (4 * want))
    borders = np.array(sorted({int(q) for q in found}), np.int64)

    def part_of(keys: np.ndarray) -> np.ndarray:
        return np.searchsorted(borders, keys, side="right")

    def ids(batches):
        for b in batches:
            keys = b.column(0).to_numpy()
            part = part_of(keys)
            for p in np.unique(part):
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([keys[part == p].min()])], names=["part", "key"])

    firsts = {r.part: r.key for r in rows.select("key").mapInArrow(ids, "part int, key long")
              .groupBy("part").agg(F.min("key").alias("key")).collect()}    # one row a part
    order = sorted(firsts)
    before = {firsts[p]: order[i - 1] for i, p in enumerate(order)}         # the first one's goes to the last part

    def deal(batches):
        heads = np.array(sorted(before), np.int64)
        for b in batches:
            keys = b.column(0).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(part_of(keys).astype(np.int32)), pa.array(np.zeros(len(keys), np.int8)), *b.columns],
                names=["part", "ahead", "key", "doc_id", "text"])
            lead: dict[int, int] = {}  # of rows with a part's first id, the one with the smallest text
            for i in np.flatnonzero(np.isin(keys, heads)).tolist():
                k = int(keys[i])
                if k not in lead or b.column(2)[i].as_py() < b.column(2)[lead[k]].as_py():
                    lead[k] = i
            if lead:
                c = b.take(pa.array(list(lead.values())))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([before[k] for k in lead], pa.int32()), pa.array(np.ones(len(lead), np.int8)), *c.columns],
                    names=["part", "ahead", "key", "doc_id", "text"])

    dealt = rows.mapInArrow(deal, "part int, ahead byte, key long, doc_id long, text string")
    return dealt.repartition(partitions(spark), "part").sortWithinPartitions("part", "ahead", "key", "text")


def with_edits(docs: DataFrame, bins: int = BINS, bits: int = BITS, k: int = K) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next`` (see :func:`edited_text`)."""
    maker = Minhash(bins, bits, k)

    def runs(batches) -> Iterator[tuple[list, list[str]]]:
        """Consecutive ids with their texts and one text more, a few MB at a time."""
        rows = (r for b in batches for r in zip(b.column("part").to_pylist(), b.column("ahead").to_pylist(),
                                                b.column("doc_id").to_pylist(), b.column("text").to_pylist()))
        for _, own in groupby(rows, key=lambda r: r[0]):
            names, texts, held, closed = [], [], 0, False
            for _, ahead, name, text in own:
                if closed:
                    continue           # further copies of the row ahead
                texts.append(text)
                held += len(text)
                closed = bool(ahead)
                if not ahead:
                    names.append(name)
                if len(texts) > 1 and (held > 6_000_000 or closed):
                    n = len(texts) - 1
                    yield names[:n], texts
                    names, texts, held = names[n:], texts[-1:], len(texts[-1])

    def run(batches):
        for names, texts in runs(batches):
            edits = [edited_text(t, u) for t, u in zip(texts, texts[1:])]
            codes, some = maker.codes(pa.array(texts, pa.large_string()))
            codes2, some2 = maker.codes(pa.array(edits, pa.large_string()))
            own, own_some = codes[:-1], some[:-1]
            yield pa.RecordBatch.from_arrays([
                pa.array(names, pa.int64()), pa.array([len(t) for t in texts[:-1]], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edits], pa.string()),
                pa.array(maker.packed(own, own_some), pa.string()), pa.array(maker.packed(codes2, some2), pa.string()),
                pa.array(maker.likeness(own, own_some, codes2, some2)),
                pa.array(maker.likeness(own, own_some, codes[1:], some[1:]))],
                names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    return in_parts(docs).mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double")
