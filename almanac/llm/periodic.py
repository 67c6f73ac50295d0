"""Periodic runs of words, found by recompression.

A run is a stretch of consecutive words with smallest period q that no
neighbouring word extends, at least ``exponent`` periods and ``shortest`` words
long.  Texts are compressed into a run-length grammar: rounds of block
compression (a maximal repetition of one symbol becomes one symbol) and of pair
compression (symbols are split into left and right ones, and every left symbol
followed by a right one becomes one symbol) until each text is one symbol.  Both
rules look at neighbouring symbols alone, so equal stretches are compressed
alike but for their ends.  Two places are extended by climbing the rounds while
their symbols agree and climbing down where they stop to: the exact longest
common extension, in at most one move a round and direction.

Candidates come from a harmonic grid: a run of period q covers at least
``exponent`` q words, so one of the multiples x of (exponent - 1) q lies in it
together with x + q.  Where these two words agree, both are extended to either
side; the stretch found is the run.  A stretch found for several q has the
smallest as its period: each of them is a multiple of it, because the stretch is
at least two of each long.  Grids of all q are n ln n / (exponent - 1) places.

Rows are independent: no shuffle.  A task holds a few MB of text at a time, or
one longer text; the arrays of a text of n words take about 200 n bytes besides its words.

Defined results: a null text is empty; a text without words has no runs and the
empty collapsed text; rows with equal or null doc_id stand for themselves; no
rows give no rows; extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.llm.common import columns, mix64, slices

SHORTEST, EXPONENT = 6, 4
#: Grid places worked on at a time.
GRID = 1 << 21
RESULT = ("doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, "
          "best struct<start:long,length:long,period:long>, collapsed string")


class Grammar:
    """Run-length grammar of several texts (arrays of symbols from 0 to
    ``size`` - 1).  The texts stand one after the other with marks between them;
    a mark equals nothing else, so no extension leaves its text.

    ``rules`` lists (first symbol, left, right) of every pair round and (first
    symbol, base, power) of every block round.  Round h turns ``strings[h]``
    into ``strings[h + 1]``: ``child[h + 1]`` is where each symbol begins below,
    ``up[h]`` which symbol begins at a place, or -1, and ``block[h]`` whether it
    was a block round."""

    def __init__(self, texts: list[np.ndarray], size: int):
        length = np.array([len(t) for t in texts], np.int64)
        self.begin = np.cumsum(length + 1) - length
        s = np.empty(int(length.sum()) + len(texts) + 1, np.int32)
        marks = np.concatenate([[0], self.begin + length])
        s[marks] = -1 - np.arange(len(marks))
        for b, t in zip(self.begin, texts):
            s[b:b + len(t)] = t
        self.size, self.strings, self.child, self.up, self.block, self.rules = size, [s], [None], [], [], []
        seed = 0
        while (s[:-1] >= 0)[s[1:] >= 0].any():
            if (s[1:] == s[:-1]).any():
                s = self._blocks(s)
            if (s[:-1] >= 0)[s[1:] >= 0].any():
                s, seed = self._pairs(s, seed), seed + 1

    def _blocks(self, s: np.ndarray) -> np.ndarray:
        starts = np.ones(len(s), bool)
        starts[1:] = s[1:] != s[:-1]
        child = np.flatnonzero(starts)
        power = np.diff(np.append(child, len(s)))
        new = s[child]
        pick = np.flatnonzero(power > 1)
        names, keys = pd.factorize((new[pick].astype(np.int64) << 32) | power[pick])
        new[pick] = self.size + names
        self._round(new, child, starts, True, keys >> 32, keys & 0xFFFFFFFF)
        return new

    def _pairs(self, s: np.ndarray, seed: int) -> np.ndarray:
        right = (mix64(s.astype(np.uint64) + np.uint64(seed << 40)) >> np.uint64(17)) & np.uint64(1) == 1
        both = (s[:-1] >= 0) & (s[1:] >= 0)
        merged, swapped = both & ~right[:-1] & right[1:], both & right[:-1] & ~right[1:]
        if np.count_nonzero(swapped) > np.count_nonzero(merged):
            merged = swapped
        starts = np.ones(len(s), bool)
        starts[1:] = ~merged
        child = np.flatnonzero(starts)
        new = s[child]
        at = np.flatnonzero(merged)
        names, keys = pd.factorize((s[at].astype(np.int64) << 32) | s[at + 1])
        new[np.cumsum(starts)[at] - 1] = self.size + names
        self._round(new, child, starts, False, keys >> 32, keys & 0xFFFFFFFF)
        return new

    def _round(self, new, child, starts, block, left, right):
        self.rules.append((self.size, left, right))
        self.size += len(left)
        up = np.cumsum(starts, dtype=np.int32) - 1
        up[~starts] = -1
        self.up.append(up)
        self.block.append(block)
        self.strings.append(new)
        self.child.append(np.append(child, len(starts)).astype(np.int32))

    # -- extensions ---------------------------------------------------------
    def _stretch(self, h: int, at: np.ndarray, back: int) -> np.ndarray:
        """Equal symbols in a row before (``back`` 1) or from ``at`` on, in a
        string that a block round follows."""
        child = self.child[h + 1]
        k = np.searchsorted(child, at - back, side="right") - 1
        return at - child[k] if back else child[k + 1] - at

    def extend(self, i: np.ndarray, j: np.ndarray, back: bool = False) -> np.ndarray:
        """Words from places ``i`` and ``j`` on (counted over the marked texts,
        i < j in one text) that agree; with ``back``, words before them."""
        back, step = int(back), -1 if back else 1
        a, b, own = i.astype(np.int64), j.astype(np.int64), np.arange(len(i))
        left: list[tuple] = []          # by round: the queries whose symbols differ there
        top = len(self.strings) - 1
        for h in range(top):
            s, up = self.strings[h], self.up[h]
            same = s[a - back] == s[b - back]
            left.append((a[~same], b[~same], own[~same]))
            a, b, own = a[same], b[same], own[same]
            if not len(own):
                break
            inside = np.flatnonzero((up[a] < 0) | (up[b] < 0))
            if self.block[h] and len(inside):
                x, y = self._stretch(h, a[inside], back), self._stretch(h, b[inside], back)
                a[inside] += step * np.minimum(x, y)
                b[inside] += step * np.minimum(x, y)
                odd = inside[x != y]
                if len(odd):
                    left[h] = tuple(np.concatenate([u, v[odd]]) for u, v in zip(left[h], (a, b, own)))
                    a, b, own = (np.delete(v, odd) for v in (a, b, own))
            else:
                a[inside] += step
                b[inside] += step
            a, b = up[a].astype(np.int64), up[b].astype(np.int64)
        else:
            s, todo = self.strings[top], np.arange(len(own))
            while len(todo):
                todo = todo[s[a[todo] - back] == s[b[todo] - back]]
                a[todo] += step
                b[todo] += step
            left.append((a, b, own))
        a, b, own = left[-1]
        for h in range(len(left) - 2, -1, -1):
            s, child = self.strings[h], self.child[h + 1]
            a, b = child[a].astype(np.int64), child[b].astype(np.int64)
            same = np.flatnonzero(s[a - back] == s[b - back])
            more = np.minimum(self._stretch(h, a[same], back), self._stretch(h, b[same], back)) if self.block[h] else 1
            a[same] += step * more
            b[same] += step * more
            a, b, own = (np.concatenate(x) for x in zip((a, b, own), left[h]))
        out = np.empty(len(i), np.int64)
        out[own] = (a - i[own]) * step
        return out


def _grid(length: np.ndarray, begin: np.ndarray, exponent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, place, period) of all grid places x with x + period in the text,
    about ``GRID`` at a time."""
    widest = length // exponent
    text = np.repeat(np.arange(len(length)), widest)
    q = np.arange(len(text)) - np.repeat(np.cumsum(widest) - widest, widest) + 1
    count = -(-(length[text] - q) // ((exponent - 1) * q))
    part = (np.cumsum(count) - count) // GRID
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), len(q)]
    for u, v in zip(cuts, cuts[1:]):
        c = count[u:v]
        k = np.repeat(np.arange(u, v), c)
        nth = np.arange(len(k)) - np.repeat(np.cumsum(c) - c, c)
        yield text[k], begin[text[k]] + nth * (exponent - 1) * q[k], q[k]


def find(texts: list[np.ndarray], size: int, shortest: int = SHORTEST, exponent: int = EXPONENT) -> list[np.ndarray]:
    """Runs of each text (symbols from 0 to ``size`` - 1): rows (start, length,
    period) by start, then period."""
    if exponent < 2 or shortest < 2:
        raise ValueError("a run needs at least two periods and two words")
    grammar = Grammar(texts, size)
    s, length = grammar.strings[0], np.array([len(t) for t in texts], np.int64)
    found = [np.empty((0, 4), np.int64)]
    for text, x, q in _grid(length, grammar.begin, exponent):
        same = s[x] == s[x + q]
        text, x, q = text[same], x[same], q[same]
        ahead, behind = grammar.extend(x, x + q), grammar.extend(x, x + q, back=True)
        size_ = behind + q + ahead
        long = size_ >= np.maximum(shortest, exponent * q)
        found.append(np.unique(np.column_stack([text, x - behind - grammar.begin[text], size_, q])[long], axis=0))
    rows = np.unique(np.concatenate(found), axis=0)          # by text, start, length, period
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:, :3] != rows[:-1, :3]).any(axis=1)
    rows = rows[first]
    rows = rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]
    return np.split(rows[:, 1:], np.searchsorted(rows[:, 0], np.arange(1, len(texts)))) if texts else []


def kept(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of ``n`` words stay when every run is cut to its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:-1]) == 0


def strongest(runs: np.ndarray) -> tuple[int, int, int] | None:
    """The run with the greatest length / period; ties: smallest start, then period."""
    return min(map(tuple, runs.tolist()), key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def scan(docs: DataFrame, shortest: int = SHORTEST, exponent: int = EXPONENT,
         edit: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """``doc_id, n_words, runs, best, collapsed`` of every document: its runs by
    start, then period; the strongest of them; its words joined by one space, of
    every run only the first period.  ``edit`` gets (doc_id, words) and gives the
    words to work on."""
    def run(batches):
        for b in (s for b in batches for s in slices(b, 2 << 20)):
            ids = b.column(0).to_pylist()
            words = [(t or "").encode().split() for t in b.column(1).to_pylist()]     # at \x20 and \x09-\x0D
            if edit:
                words = [edit(i, w) for i, w in zip(ids, words)]
            flat = np.empty(sum(map(len, words)), object)
            flat[:] = [x for w in words for x in w]
            symbols, names = pd.factorize(flat)
            symbols = symbols.astype(np.int32)
            del flat
            runs = find(np.split(symbols, np.cumsum([len(w) for w in words])[:-1]), len(names), shortest, exponent)
            texts = [b" ".join(np.array(w, object)[kept(len(w), r)] if len(r) else w).decode() for w, r in zip(words, runs)]
            best = [dict(zip(("start", "length", "period"), x)) if (x := strongest(r)) else None for r in runs]
            kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
            every = np.concatenate(runs)
            ends = np.concatenate([[0], np.cumsum([len(r) for r in runs])])
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array([len(w) for w in words], pa.int64()),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(
                    [pa.array(every[:, i]) for i in range(3)], fields=list(kind))),
                pa.array(best, kind), pa.array(texts, pa.string())],
                names=["doc_id", "n_words", "runs", "best", "collapsed"])

    return columns(docs).mapInArrow(run, RESULT)


def repeat_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of one document in ten, by the CRC-32 h of its decimal doc_id,
    with a periodic tail: with g = h // 10 and a = g % n, word i from a on
    becomes word a + (i - a) % p, p = 1 + (n - a) // (3 + g % 8).  Others, and
    those of a null doc_id, as they are."""
    h, n = zlib.crc32(b"" if doc_id is None else str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def digests(found: DataFrame) -> DataFrame:
    """Of :func:`scan`: ``doc_id, n_runs``, the strongest run's ``start, length,
    period, exponent_milli``, and digests of all runs and of the collapsed text."""
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start.cast("string"), r.length.cast("string"), r.period.cast("string")), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"), F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", line).cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
