"""Best-fit packing by patterns and non-negative least squares.

1. Documents are tokenised where they lie; each gives one row per piece of at
   most ``limit`` tokens.  No ids leave the task, only lengths and checksums.
2. The histogram of lengths (at most ``limit`` rows, whatever the input) goes
   to the driver.  Lengths are rounded up to ``grain`` tokens, patterns of at
   most ``depth`` rounded lengths that fill a sequence are enumerated, and
   non-negative least squares fits how often each is repeated.
3. Repeat counts are rounded down and filled with actual lengths, the last of a
   pattern being the longest that still fits.  What is left over goes, longest first, into the fullest sequence that still has room
   (best fit), new ones opening when none has.  All of this works on runs of
   equal lengths, so its cost follows the number of lengths, not of documents.
4. Each piece is numbered within its length, in parallel over salted groups,
   and looks its place up in the table of runs (bounded by lengths and
   patterns, never by documents).

Defined results: a null or empty text is a document of the closing id alone;
repeated rows are packed once each; no documents give no rows; extra columns
are not read.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from almanac.llm import bpe
from almanac.llm.common import columns, partitions, slices, store

LIMIT, END_ID = 4096, 1
GRAIN, DEPTH = 32, 3
#: Share of all tokens, in the shortest documents, kept back from the patterns.
FILLER = 0.02


# -- pieces ---------------------------------------------------------------
def pieces(docs: DataFrame, tokenizer: str, limit: int = LIMIT, end_id: int = END_ID) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every document's ids
    followed by ``end_id``, cut after every ``limit`` ids."""

    def run(batches):
        tok = bpe.load_batch(tokenizer)
        for b in (s for b in batches for s in slices(b, 6 << 20)):
            ids, starts = tok.encode(b.column(1))
            names, nth, begin, length, crc = [], [], [], [], []
            for name, x, y in zip(b.column(0).to_pylist(), starts.tolist(), starts[1:].tolist()):
                own = np.append(ids[x:y], end_id).astype("<u4")
                for p, at in enumerate(range(0, len(own), limit)):
                    part = own[at:at + limit]
                    names.append(name)
                    nth.append(p)
                    begin.append(at)
                    length.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int64()), pa.array(nth, pa.int32()), pa.array(begin, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return columns(docs).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


# -- plan -----------------------------------------------------------------
def patterns(total: int, depth: int) -> list[tuple[int, ...]]:
    """Descending tuples of 1 to ``depth`` positive integers that sum to ``total``."""
    out: list[tuple[int, ...]] = []

    def extend(head: tuple[int, ...], rest: int) -> None:
        if rest == 0:
            out.append(head)
        elif len(head) < depth:
            for x in range(min(rest, head[-1] if head else rest), 0, -1):
                if x * (depth - len(head)) < rest:
                    break
                extend((*head, x), rest - x)

    extend((), total)
    return out


def nnls(a: np.ndarray, b: np.ndarray, rounds: int | None = None) -> np.ndarray:
    """Least squares ``a x = b`` with ``x >= 0`` (active set: the column whose
    gradient is largest enters, columns that would turn negative leave)."""
    n = a.shape[1]
    x, on = np.zeros(n), np.zeros(n, bool)
    tiny = 1e-10 * max(1.0, np.abs(a.T @ b).max(initial=0.0))
    for _ in range(rounds or 3 * a.shape[0]):
        slope = a.T @ (b - a @ x)
        slope[on] = -np.inf
        enter = int(np.argmax(slope))
        if slope[enter] <= tiny:
            break
        on[enter] = True
        while True:
            cols = np.flatnonzero(on)
            z = np.linalg.lstsq(a[:, cols], b, rcond=None)[0]
            if (z > 0).all():
                break
            low = z <= 0
            step = np.min(x[cols][low] / np.maximum(x[cols][low] - z[low], 1e-300))
            x[cols] += step * (z - x[cols])
            on[cols[low & (x[cols] <= 1e-9)]] = False
            x[~on] = 0
            if not on.any():
                break
        x[:] = 0
        if not on.any():
            break
        x[cols] = z
    return x


@dataclass
class Group:
    """``count`` sequences that hold the same lengths; ``slots`` lists them as
    (length, copies, number of the first piece of that length, offset)."""
    count: int
    free: int
    slots: tuple[tuple[int, int, int, int], ...] = ()


class Packer:
    def __init__(self, histogram: dict[int, int], limit: int):
        self.limit = limit
        self.left = {n: c for n, c in histogram.items() if c > 0}
        self.used = dict.fromkeys(self.left, 0)
        self.open: list[list[Group]] = [[] for _ in range(limit + 1)]   # by free space
        self.room = np.zeros(limit + 1, bool)

    def add(self, g: Group) -> None:
        self.open[g.free].append(g)
        self.room[g.free] = True

    def put(self, g: Group, length: int, copies: int) -> Group:
        """``copies`` pieces of ``length`` into every sequence of the group."""
        first, n = self.used[length], g.count * copies
        self.used[length] += n
        self.left[length] -= n
        return Group(g.count, g.free - length * copies,
                     (*g.slots, (length, copies, first, self.limit - g.free)))

    def fill_patterns(self, grain: int, depth: int, filler: float) -> None:
        top = -(-self.limit // grain)
        bins: dict[int, list[int]] = {}
        tokens, spare = sum(n * c for n, c in self.left.items()), 0.0
        for n in sorted(self.left):    # the shortest stay out, to fill what rounding leaves free
            spare += n * self.left[n]
            if spare > filler * tokens:
                bins.setdefault(-(-n // grain), []).insert(0, n)
        shapes = [p for p in patterns(top, depth) if all(x in bins for x in p)]
        if not shapes:
            return
        have = np.array([sum(self.left[n] for n in bins.get(x, ())) for x in range(1, top + 1)], float)
        a = np.zeros((top, len(shapes)))
        for j, p in enumerate(shapes):
            for x in p:
                a[x - 1, j] += 1
        times = np.floor(nnls(a, have) + 1e-6).astype(int)
        stock = np.zeros(self.limit + 1, bool)
        stock[[n for lengths in bins.values() for n in lengths]] = True
        for j in np.argsort(-times, kind="stable"):
            todo = int(times[j])
            while todo > 0:
                lengths: list[int] = []    # the longest length left in each bin of the pattern;
                for x in shapes[j][:-1]:
                    lengths += [n for n in bins[x] if self.left[n] > lengths.count(n)][:1]
                room = self.limit - sum(lengths)
                for n in np.flatnonzero(stock[:room + 1])[::-1].tolist():   # for the last, what fits best
                    if self.left[n] > lengths.count(n):
                        lengths.append(n)
                        break
                if len(lengths) < len(shapes[j]):
                    break
                m = min(todo, *(self.left[n] // lengths.count(n) for n in lengths))
                g = Group(m, self.limit)
                for n in dict.fromkeys(lengths):
                    g = self.put(g, n, lengths.count(n))
                    stock[n] = self.left[n] > 0
                self.add(g)
                todo -= m

    def best_fit(self) -> None:
        for n in sorted(self.left, reverse=True):
            while self.left[n]:
                fits = np.flatnonzero(self.room[n:])
                if len(fits) == 0:
                    k = self.limit // n
                    self.add(Group(max(1, self.left[n] // k), self.limit))
                    continue
                free = n + int(fits[0])
                g = self.open[free].pop()
                self.room[free] = bool(self.open[free])
                k = min(free // n, self.left[n])
                m = min(g.count, self.left[n] // k)
                if m < g.count:
                    self.add(Group(g.count - m, g.free, tuple(
                        (length, c, first + m * c, at) for length, c, first, at in g.slots)))
                self.add(self.put(Group(m, g.free, g.slots), n, k))


def plan(histogram: dict[int, int], limit: int = LIMIT, grain: int = GRAIN, depth: int = DEPTH,
         filler: float = FILLER) -> dict[str, np.ndarray]:
    """Where pieces go, from ``{length: pieces}`` alone.  The run that holds
    number ``r`` of length ``n`` is the last with ``(length, first) <= (n, r)``;
    with ``d = r - first``, its sequence is ``sequence + d // copies`` and its
    offset ``offset + (d % copies) * n``."""
    p = Packer(histogram, limit)
    p.fill_patterns(grain, depth, filler)
    p.best_fit()
    rows, sequences = [], 0
    for groups in p.open:
        for g in groups:
            rows += [(length, first, copies, sequences, at) for length, copies, first, at in g.slots]
            sequences += g.count
    rows.sort()
    cols = np.array(rows, np.int64).reshape(-1, 5).T
    return dict(zip(("length", "first", "copies", "sequence", "offset"), cols)) | {"sequences": np.int64(sequences)}


# -- places ---------------------------------------------------------------
def numbered(rows: DataFrame, groups: int) -> DataFrame:
    """``number``: 0, 1, ... within each length.  A length that most rows share
    is numbered in ``groups`` salted groups side by side."""
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(groups)).cast("int"))
    w = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    before = (salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
              .select("length", "_salt", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_before")))
    within = F.row_number().over(Window.partitionBy("length", "_salt").orderBy("doc_id", "piece"))
    return (salted.withColumn("_row", within).join(before, ["length", "_salt"])
            .withColumn("number", F.col("_before") + F.col("_row") - 1).drop("_salt", "_row", "_before"))


def pack(docs: DataFrame, tokenizer: str, limit: int = LIMIT, end_id: int = END_ID,
         grain: int = GRAIN, depth: int = DEPTH) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset``: every
    piece's place in sequences of at most ``limit`` tokens."""
    spark = docs.sparkSession
    rows = store(pieces(docs, tokenizer, limit, end_id), "pieces")
    histogram = {r[0]: r[1] for r in rows.groupBy("length").count().collect()}   # at most `limit` rows
    runs = plan(histogram, limit, grain, depth)
    wide = 1 << 44

    def place(batches):
        keys = runs["length"] * wide + runs["first"]
        for b in batches:
            t = pa.Table.from_batches([b])
            n, r = t["length"].to_numpy(), t["number"].to_numpy()
            at = np.searchsorted(keys, n * wide + r, side="right") - 1
            d, c = r - runs["first"][at], runs["copies"][at]
            out = t.drop_columns(["number"]).append_column(
                "sequence_id", pa.array(runs["sequence"][at] + d // c)).append_column(
                "offset", pa.array(runs["offset"][at] + d % c * n))
            yield from out.to_batches()

    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    return numbered(rows, 2 * partitions(spark)).select(*columns, "number").mapInArrow(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
