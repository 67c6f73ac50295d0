"""Benchmark passages in training texts, by a generalised suffix automaton.

Items and texts are cut into words (A-Z lower-cased, ASCII but letters and digits
apart).  One automaton recognises every stretch of words of the items; a text is
streamed through it, which gives for each word the longest stretch ending there
that some item has.  A window is ``window`` consecutive item words, or the whole
of an item with fewer; the words of a text inside an occurrence of a window are
hit.  Stretches of hit words longer than ``max_span`` are removed from the text,
and a text of which more than ``max_coverage`` is hit is rejected.

The automaton needs no context across a word pair that no item has: the match
after it is that one word.  Texts fall apart there into streams, and all streams
of a few MB of text go through the automaton together, a word of each at a time.
Streams shorter than the shortest window cannot hold one.

Automata have a proven size: the items are cut into pieces of at most ``PIECE``
words (overlapping by a window less one word, so every window stays whole) and
dealt by hash to blocks of about ``BLOCK`` words, each built by one task; n words
make at most 2 n states and 3 n transitions, 17 MB a block.  Each block's
automaton is broadcast and meets all texts; with several blocks, what was hit so
far is stored between the passes.  Texts are not shuffled.

Words are compared by 64-bit hashes: two different words meet by chance with
probability 2**-64, and a window has ``window`` of them.

Defined results: a null text, of an item or a document, has no words; items
without words have no window; an item_id given several times counts once, a null
one is named by the empty string; rows with equal or null doc_id stand for
themselves; without items nothing is hit; without documents there are no rows;
extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.llm.common import NO_ALNUM, Words, columns, slices, store

WINDOW = 10
#: Words of an automaton, and of a piece of an item.
BLOCK, PIECE = 250_000, 4096
_FIELDS = "doc_id long, text string, hits binary, items array<string>"
RESULT = ("doc_id long, n_words long, n_hit long, items array<string>, rejected boolean, text string, "
          "spans array<struct<start:long,length:long>>")


class Automaton:
    """Suffix automaton of word sequences, as arrays.

    ``pieces`` lists (item, word hashes, whole): ``whole`` if the piece is the
    whole of an item shorter than the window.  State 0 is the start; a state
    stands for all stretches that end at the same places, ``length`` of the
    longest, ``link`` the state of its longest suffix that ends elsewhere too."""

    ARRAYS = ("words", "keys", "to", "link", "length", "full", "short", "named", "names")

    def __init__(self, pieces: list[tuple[str, np.ndarray, bool]], window: int = WINDOW):
        self.window = window
        flat = np.concatenate([np.empty(0, np.uint64), *(p[1] for p in pieces)])
        self.words, code = np.unique(flat, return_inverse=True)
        code = np.split(code, np.cumsum([len(p[1]) for p in pieces])[:-1]) if pieces else []
        step: list[dict[int, int]] = [{}]
        link, length = [-1], [0]

        def state(moves: dict, size: int, suffix: int) -> int:
            step.append(moves)
            length.append(size)
            link.append(suffix)
            return len(link) - 1

        def split(p: int, q: int, c: int) -> int:
            """The state of the stretches up to one word longer than p's, apart from q's longer ones."""
            if length[q] == length[p] + 1:
                return q
            new = state(dict(step[q]), length[p] + 1, link[q])
            link[q] = new
            while p >= 0 and step[p].get(c) == q:
                step[p][c] = new
                p = link[p]
            return new

        for sequence in code:
            last = 0
            for c in sequence.tolist():
                q = step[last].get(c)
                if q is not None:
                    last = split(last, q, c)
                    continue
                new, p = state({}, length[last] + 1, 0), last
                while p >= 0 and c not in step[p]:
                    step[p][c] = new
                    p = link[p]
                if p >= 0:
                    link[new] = split(p, step[p][c], c)
                last = new
        self.link, self.length = np.array(link, np.int32), np.array(length, np.int32)
        pairs = np.array([(s * (len(self.words) + 1) + c, t) for s, moves in enumerate(step) for c, t in moves.items()], np.int64).reshape(-1, 2)
        order = np.argsort(pairs[:, 0])
        self.keys, self.to = pairs[order, 0], pairs[order, 1].astype(np.int32)
        self._name(code, pieces)

    def _name(self, code: list[np.ndarray], pieces: list[tuple[str, np.ndarray, bool]]) -> None:
        """``full``: of each state, the suffix state of the last ``window`` words; ``short``: the
        longest suffix that is a whole short item; -1 without.  ``named``, ``names``: (state, item)
        pairs of both kinds, by state."""
        n = len(self.link)
        self.full, self.short = np.full(n, -1, np.int32), np.full(n, -1, np.int32)
        flat = np.concatenate([np.empty(0, np.int64), *code])
        starts = np.cumsum([0, *(len(c) for c in code)])
        reached, matched = self.stream(flat, starts[:-1], np.diff(starts))
        ends = starts[1:][[w for _, _, w in pieces]] - 1
        whole = np.zeros(n, bool)
        whole[reached[ends]] = True
        for v in np.argsort(self.length, kind="stable")[1:].tolist():
            u = self.link[v]
            if self.length[v] >= self.window:
                self.full[v] = v if self.length[u] < self.window else self.full[u]
            self.short[v] = v if whole[v] else self.short[u]
        item = np.repeat(np.arange(len(code)), np.diff(starts))
        here = np.flatnonzero(matched >= self.window)
        at = np.concatenate([self.full[reached[here]], reached[ends]])
        ids = np.array([i for i, _, _ in pieces], object)
        of = ids[np.concatenate([item[here], item[ends]])] if len(at) else np.empty(0, object)
        distinct = sorted(set(zip(at.tolist(), of.tolist())))
        self.named = np.array([s for s, _ in distinct], np.int32)
        self.names = np.array([i for _, i in distinct], object)

    def next(self, state: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Where a word leads from each state, or -1."""
        key = state.astype(np.int64) * (len(self.words) + 1) + word
        k = np.minimum(np.searchsorted(self.keys, key), max(len(self.keys) - 1, 0))
        return np.where(self.keys[k] == key, self.to[k], -1) if len(self.keys) else np.full(len(key), -1, np.int32)

    def stream(self, word: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """State and longest match after every word of streams of known words
        ``word[start:start + size]``, each read from the start state on."""
        reached, matched = np.zeros(len(word), np.int32), np.zeros(len(word), np.int32)
        order = np.argsort(-size, kind="stable")
        start, size = start[order], size[order]
        state, match = np.zeros(len(start), np.int32), np.zeros(len(start), np.int32)
        for t in range(int(size[0]) if len(size) else 0):
            m = int(np.searchsorted(-size, -t))            # streams longer than t
            state, match, at = state[:m], match[:m], start[:m] + t
            to = self.next(state, word[at])
            lost = np.flatnonzero(to < 0)
            while len(lost):                                # a word alone is known: this ends at the start state
                state[lost] = self.link[state[lost]]
                match[lost] = self.length[state[lost]]
                to[lost] = self.next(state[lost], word[at[lost]])
                lost = lost[to[lost] < 0]
            state, match = to.astype(np.int32), match + 1
            reached[at], matched[at] = state, match
        return reached, matched

    def hits(self, h: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of texts' word hashes, text k from ``starts[k]`` on: (first word, word behind the last) of
        each occurrence of a window, the state that names its items, and the shorter windows inside it as rows of their own."""
        empty = np.empty(0, np.int64)
        if not len(self.words) or not len(h):
            return empty, empty, empty
        k = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
        known = self.words[k] == h
        single = self.next(np.zeros(len(self.words), np.int32), np.arange(len(self.words)))
        joined = known.copy()                               # to the word before
        joined[0] = False
        joined[starts[starts < len(h)]] = False
        joined[1:] &= known[:-1]
        at = np.flatnonzero(joined)
        joined[at] = self.next(single[k[at - 1]], k[at]) >= 0
        first = np.flatnonzero(known & ~joined)
        others = np.flatnonzero(~joined)                    # a stream ends before the next word that is not joined
        size = np.append(others, len(h))[np.searchsorted(others, first) + 1] - first
        shortest = min(self.window, int(self.length[self.short[self.short >= 0]].min(initial=self.window)))
        pick = size >= shortest
        reached, matched = self.stream(k, first[pick], size[pick])
        end = np.flatnonzero(matched)
        state, match = reached[end], matched[end]
        long = match >= self.window
        found = [(end[long] + 1 - self.window, end[long] + 1, self.full[state[long]])]
        part = self.short[state]                            # the match may be shorter than its state's longest stretch
        part = np.where((part >= 0) & (self.length[part] > match), self.short[self.link[part]], part)
        while (pick := part >= 0).any():
            end, part = end[pick], part[pick]
            found.append((end + 1 - self.length[part], end + 1, part))
            part = self.short[self.link[part]]
        return tuple(np.concatenate(x).astype(np.int64) for x in zip(*found))

    def items(self, states: np.ndarray) -> set[str]:
        """Items named by these states."""
        a, b = np.searchsorted(self.named, states), np.searchsorted(self.named, states, side="right")
        return {i for u, v in zip(a, b) for i in self.names[u:v]}


def _pieces(items: DataFrame, window: int) -> DataFrame:
    """``item_id, words, whole`` of all items, cut, each once."""
    def run(batches):
        for b in (s for b in batches for s in slices(b, 4 << 20)):
            w = Words(b.column(1), NO_ALNUM)
            ids, words, whole = [], [], []
            for k, name in enumerate(b.column(0).to_pylist()):
                h = w.hash[w.starts[k]:w.starts[k + 1]]
                for at in range(0, max(len(h) - window + 1, min(len(h), 1)), PIECE - window + 1):
                    ids.append(name or "")
                    words.append(h[at:at + PIECE].tobytes())
                    whole.append(len(h) < window)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(words, pa.binary()), pa.array(whole, pa.bool_())],
                                             names=["item_id", "words", "whole"])

    named = items.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    return named.mapInArrow(run, "item_id string, words binary, whole boolean").distinct()


def automata(items: DataFrame, window: int = WINDOW, block: int = BLOCK) -> Iterator[Automaton]:
    """An automaton for each block of about ``block`` words of the items, one in
    the driver at a time."""
    if not 2 <= window <= PIECE:
        raise ValueError(f"a window has 2 to {PIECE} words")
    spark = items.sparkSession
    pieces = store(_pieces(items, window), "pieces")
    blocks = -(-(pieces.agg(F.sum(F.length("words"))).first()[0] or 0) // (8 * block))

    def build(key, rows):
        rows = rows.to_pylist()
        made = Automaton([(r["item_id"], np.frombuffer(r["words"], np.uint64), r["whole"]) for r in rows], window)
        return pa.Table.from_arrays([pa.array([key[0].as_py()], pa.int64()), *(
            pa.array([v.tolist()]) if name == "names" else pa.array([v.tobytes()]) for name in Automaton.ARRAYS for v in [getattr(made, name)])],
            schema=schema)

    schema = pa.schema([("block", pa.int64()), *((n, pa.list_(pa.string()) if n == "names" else pa.binary()) for n in Automaton.ARRAYS)])
    if not blocks:
        return
    dealt = pieces.withColumn("block", F.pmod(F.xxhash64("item_id", "words"), F.lit(blocks)))
    made = store(dealt.groupBy("block").applyInArrow(build, "block long, " + ", ".join(
        f"{n} {'array<string>' if n == 'names' else 'binary'}" for n in Automaton.ARRAYS)), "automata")
    kinds = {"words": np.uint64, "keys": np.int64}
    for b in range(blocks):
        for row in made.where(F.col("block") == b).collect():        # at most one, of a proven size
            a = Automaton.__new__(Automaton)
            a.window = window
            for n in Automaton.ARRAYS:
                setattr(a, n, np.array(row[n], object) if n == "names" else np.frombuffer(row[n], kinds.get(n, np.int32)))
            yield a


def _spans(n: int, hits: np.ndarray) -> np.ndarray:
    """(start, length) of the stretches of hit words among ``n``."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, hits[:, 0], 1)
    np.add.at(change, hits[:, 1], -1)
    edge = np.diff((np.cumsum(change) > 0).astype(np.int8), prepend=0)
    start = np.flatnonzero(edge == 1)
    return np.column_stack([start, np.flatnonzero(edge == -1) - start])


def scan(docs: DataFrame, items: DataFrame, window: int = WINDOW, max_span: int | None = None, max_coverage: float = 0.5,
         block: int = BLOCK) -> DataFrame:
    """``doc_id, n_words, n_hit, items, rejected, text, spans`` of every document:
    the items with windows in it, by name; whether more than ``max_coverage`` of
    its words are hit; its text without the stretches of more than ``max_span``
    hit words (none given: all go); and all stretches, in words of the whole text."""
    spark = docs.sparkSession
    limit = 0 if max_span is None else max_span

    def meet(shared, last: bool):
        def run(batches):
            automaton = shared and shared.value
            for b in (s for b in batches for s in slices(b, 2 << 20)):
                w = Words(b.column(1), NO_ALNUM)
                hits, names = b.column(2).to_pylist(), b.column(3).to_pylist()
                if automaton:
                    first, behind, state = automaton.hits(w.hash, w.starts)
                    text = np.searchsorted(w.starts, first, side="right") - 1
                    order = np.argsort(text, kind="stable")
                    cuts = np.searchsorted(text[order], np.arange(len(b) + 1))
                    for k in np.unique(text).tolist():
                        own = order[cuts[k]:cuts[k + 1]]
                        pair = np.column_stack([first[own], behind[own]]) - w.starts[k]
                        before = np.frombuffer(hits[k], np.int64).reshape(-1, 2)
                        merged = _spans(w.starts[k + 1] - w.starts[k], np.concatenate([before, pair]))
                        hits[k] = np.column_stack([merged[:, 0], merged.sum(axis=1)]).tobytes()
                        names[k] = sorted({*names[k], *automaton.items(np.unique(state[own]))})
                found = pa.array(names, pa.list_(pa.string()))
                yield finished(b, w, hits, found) if last else pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array(hits, pa.binary()), found], names=["doc_id", "text", "hits", "items"])
        return run

    def finished(b, w, hits, items):
        size = pc.fill_null(pc.binary_length(b.column(1)), 0).to_numpy()
        total, offset = np.diff(w.starts).astype(np.int64), np.cumsum(size) - size
        hit, spans, texts = np.zeros(len(b), np.int64), [[] for _ in hits], b.column(1)
        changed = {}
        for k, raw in enumerate(hits):
            if not raw:
                continue
            pair = np.frombuffer(raw, np.int64).reshape(-1, 2)
            spans[k] = [{"start": x, "length": y - x} for x, y in pair.tolist()]
            hit[k] = (pair[:, 1] - pair[:, 0]).sum()
            data, edge = texts[k].as_py().encode(), [0]
            for x, y in (pair[pair[:, 1] - pair[:, 0] > limit] + w.starts[k]).tolist():
                edge += [int(w.begin[x] - offset[k]), int(w.end[y - 1] - offset[k])]
            edge.append(len(data))
            changed[k] = b"".join(data[x:y] for x, y in zip(edge[::2], edge[1::2])).decode()
        if changed:
            texts = pa.array([changed.get(k, t) for k, t in enumerate(texts.to_pylist())], pa.string())
        return pa.RecordBatch.from_arrays([
            b.column(0), pa.array(total), pa.array(hit), items, pa.array(hit > max_coverage * total), texts,
            pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())])))],
            names=["doc_id", "n_words", "n_hit", "items", "rejected", "text", "spans"])

    rows = columns(docs).select("doc_id", "text", F.lit(b"").alias("hits"), F.array().cast("array<string>").alias("items"))
    held = None
    for automaton in automata(items, window, block):
        if held:
            rows = store(rows.mapInArrow(meet(held, False), _FIELDS), "hits")
        held = spark.sparkContext.broadcast(automaton)
    return rows.mapInArrow(meet(held, True), RESULT)


def digests(found: DataFrame) -> DataFrame:
    """Of :func:`scan`: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``."""
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
