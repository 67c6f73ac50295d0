"""Language model scoring by Katz backoff.

Tokens are words and one end per text.  The model gives a word after a word
``d(r) * r / c(h)`` when the pair was seen r times in training, ``d`` being the
Good-Turing discount (counts above ``TOP`` are trusted), and otherwise
``alpha(h) * P(w)``, alpha normalised exactly over the words not seen after h.
``P(w)`` is the discounted share of the word alone, and what discounting leaves
belongs to the unknown word: the recursion ends there.

The corpus is cut into slices (some MB of text), each stored once as packed word
hashes and tokens.  A table of n-grams is partitioned by hash: every slice sends
each of its distinct n-grams once, with its count, to the n-gram's partition,
which adds up and sends the total back, aligned with what was asked.  So a
word that a third of all tokens are crosses the network once a slice.  Word
pairs are partitioned by their first word, where alpha needs them together;
pairs after words that are more than ``FREQUENT`` of all tokens (at most
1 / FREQUENT words) are partitioned by both words instead, and their sums, a few
rows, are added up apart.  Totals cover all training texts; the stored tables
grow with the corpus, and nothing but counts of counts and those few rows
reaches the driver.

Defined results: a null or empty text is its end alone; without training texts
every word is unknown and has probability 1; repeated rows count and are
scored each; a null id is held out; no rows give no rows; extra columns are not read.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.llm.common import Words, columns, partitions, slices, store, store_by

TOP, FREQUENT, SLICE = 5, 1 / 128, 16 << 20
END = np.uint64(0x9AE16A3B2F90404F)


def held_out(doc_id: int | None, mod: int, rest: int) -> bool:
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % mod == rest


# -- discounting ----------------------------------------------------------
def good_turing(counts: np.ndarray, top: int = TOP) -> np.ndarray:
    """d(0 .. top) and d of all larger counts, from counts of counts n(1 .. top + 1):
    Katz's discounts for the largest k up to ``top`` for which all lie in (0, 1];
    1 above k.  When no k will do, absolute discounting with n1 / (n1 + 2 n2)."""
    n = np.concatenate(([0.0], counts.astype(float)))
    for k in range(min(top, len(counts) - 1), 0, -1):
        if (n[1:k + 2] <= 0).any():
            continue
        r = np.arange(1, k + 1)
        cut = (k + 1) * n[k + 1] / n[1]
        d = ((r + 1) * n[2:k + 2] / n[1:k + 1] / r - cut) / (1 - cut) if cut < 1 else np.zeros(k)
        if (d > 0).all() and (d <= 1).all():
            return np.concatenate(([0], d, np.ones(top + 1 - k)))
    much = n[1] / (n[1] + 2 * n[2]) if n[1] > 0 else 0.0
    return np.concatenate(([0], 1 - min(much, 0.95) / np.arange(1, top + 1), [1]))


@dataclass
class Alone:
    """P(w) from a word's training count."""
    tokens: int
    words: int
    discount: np.ndarray
    unknown: float

    @classmethod
    def of(cls, tokens: int, words: int, counts: np.ndarray) -> Alone:
        d = good_turing(counts)
        left = float((np.arange(1, TOP + 1) * counts[:TOP] * (1 - d[1:TOP + 1])).sum()) / tokens if tokens else 1.0
        if left <= 0:                  # every word is frequent: one more token, unknown
            return cls(tokens, words, np.ones(len(d)) * tokens / (tokens + 1), 1 / (tokens + 1))
        return cls(tokens, words, d, left)

    def p(self, count: np.ndarray) -> np.ndarray:
        share = count / max(self.tokens, 1) * self.discount[np.minimum(count, TOP + 1)]
        return np.where(count > 0, share, self.unknown)


@dataclass
class After:
    """Discounts of pairs, and what is left for pairs not seen."""
    discount: np.ndarray

    def left(self, total: np.ndarray, few: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scale of the seen probabilities and the mass left, of contexts with
        ``total`` tokens: ``few[:, r - 1]`` followers seen r times, and ``many``
        tokens of followers seen more often."""
        r = np.arange(1, few.shape[1] + 1)
        mass = (few @ (r * self.discount[1:TOP + 1]) + many) / np.maximum(total, 1)
        none = mass >= 1 - 1e-12       # nothing was discounted: one more token, not seen
        scale = np.where(none, total / (total + 1), 1.0)
        return scale, np.where(none, 1 / (total + 1), 1 - mass)


# -- slices -------------------------------------------------------------------
def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, ends included, and where each text's tokens begin."""
    w = Words(texts)
    n = len(w.starts) - 1
    starts = w.starts + np.arange(n + 1)
    out = np.empty(starts[-1], np.uint64)
    ends = starts[1:] - 1
    word = np.ones(len(out), bool)
    word[ends] = False
    out[word], out[ends] = w.hash, END
    return out, starts


def slice_table(docs: DataFrame, mod: int, rest: int) -> DataFrame:
    """A row a slice: ``sid``, its ids, which of them are learnt from, where their
    tokens begin, the sorted distinct token hashes and each token's place there."""

    def run(batches):
        part, seq = TaskContext.get().partitionId(), 0
        for b in (s for b in batches for s in slices(b, SLICE)):
            h, starts = tokens_of(b.column(1))
            vocab, tokens = np.unique(h, return_inverse=True)
            ids = b.column(0).to_pylist()
            learn = np.array([not held_out(i, mod, rest) for i in ids], np.uint8)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part << 32 | seq]), pa.array([ids], pa.list_(pa.int64())),
                 *(pa.array([x.tobytes()], pa.binary()) for x in (learn, starts.astype(np.int64), vocab, tokens.astype(np.uint32)))],
                names=["sid", "ids", "learn", "starts", "vocab", "tokens"])
            seq += 1

    return docs.mapInArrow(run, "sid long, ids array<long>, learn binary, starts binary, vocab binary, tokens binary")


class Slice:
    def __init__(self, row: dict):
        self.sid = row["sid"]
        self.ids = row["ids"]
        self.learn = np.frombuffer(row["learn"], np.uint8).astype(bool)
        self.starts = np.frombuffer(row["starts"], np.int64)
        self.vocab = np.frombuffer(row["vocab"], np.uint64)
        self.tokens = np.frombuffer(row["tokens"], np.uint32).astype(np.int64)
        self.learnt = np.repeat(self.learn, np.diff(self.starts))   # of each token

    def counts(self) -> np.ndarray:
        return np.bincount(self.tokens[self.learnt], minlength=len(self.vocab))

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (context, token) pairs by context, then token; the pair of
        each token; context 0 is the beginning, i + 1 the i-th word."""
        before = np.empty(len(self.tokens), np.int64)
        before[1:] = self.tokens[:-1] + 1
        before[self.starts[:-1]] = 0
        code, which = np.unique(before * len(self.vocab) + self.tokens, return_inverse=True)
        return code // len(self.vocab), code % len(self.vocab), which


def cuts_of(bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal values begin and end."""
    head = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.empty(0, np.int64)
    return head, np.append(head[1:], len(bucket)).astype(np.int64) if len(head) else np.empty(0, np.int64)


# -- words alone --------------------------------------------------------------
_ANSWER = pa.schema([("sid", pa.int64()), ("kind", pa.int32()), ("bucket", pa.int32()), ("a", pa.binary()), ("b", pa.binary())])
_ANSWER_SQL = "sid long, kind int, bucket int, a binary, b binary"
WORDS, PAIRS, TOTALS, SUMS = 0, 1, 2, 3      # kinds of answers


def _answers(rows: list[tuple]) -> pa.Table:
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), _ANSWER)], schema=_ANSWER) if rows else _ANSWER.empty_table()


def ask_words(table: DataFrame, bits: int) -> DataFrame:
    """``bucket, sid, words, counts``: every slice's distinct words by the high
    bits of their hash, with their training counts there."""
    shift = np.uint64(64 - bits)

    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                s = Slice(row)
                bucket, count = (s.vocab >> shift).astype(np.int64), s.counts()
                rows = [(int(bucket[x]), s.sid, s.vocab[x:y].tobytes(), count[x:y].astype(np.uint32).tobytes()) for x, y in zip(*cuts_of(bucket))]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int32(), pa.int64(), pa.binary(), pa.binary()))],
                                                 names=["bucket", "sid", "words", "counts"])

    return table.mapInArrow(run, "bucket int, sid long, words binary, counts binary")


def count_words(asked: DataFrame) -> DataFrame:
    """Answers: totals of the words asked and their numbers in the partition, and
    a row of its sizes and counts of counts."""

    def reduce(key, t):
        words = [np.frombuffer(x, np.uint64) for x in t["words"].to_pylist()]
        every, which = np.unique(np.concatenate(words), return_inverse=True)
        total = np.bincount(which, weights=np.concatenate([np.frombuffer(x, np.uint32) for x in t["counts"].to_pylist()]), minlength=len(every))
        total = total.astype(np.int64)
        bucket = key[0].as_py()
        few = np.bincount(np.minimum(total, TOP + 2), minlength=TOP + 3)[1:TOP + 2]
        stats = np.concatenate(([len(every), total.sum(), (total > 0).sum()], few))
        return _answers([(sid, WORDS, bucket, total[x].tobytes(), x.astype(np.uint32).tobytes())
                         for sid, x in zip(t["sid"].to_pylist(), np.split(which, np.cumsum([len(w) for w in words])[:-1]))]
                        + [(-1, TOTALS, bucket, stats.astype(np.int64).tobytes(), None)])

    return asked.groupBy("bucket").applyInArrow(reduce, _ANSWER_SQL)


def totals(answers: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The rows of kind TOTALS, one a partition: their buckets, and them."""
    got = sorted((r.bucket, r.a) for r in answers.where(F.col("kind") == TOTALS).select("bucket", "a").collect())
    return np.array([b for b, _ in got], np.int64), np.array([np.frombuffer(a, np.int64) for _, a in got]).reshape(-1, TOP + 4)


def in_slice(answers: list[dict], kind: int) -> list[dict]:
    return sorted((a for a in answers if a["kind"] == kind), key=lambda a: a["bucket"])


def joined(rows: list[dict], name: str, dtype) -> np.ndarray:
    return np.concatenate([np.frombuffer(r[name], dtype) for r in rows]) if rows else np.empty(0, dtype)


# -- pairs ----------------------------------------------------------------------
@dataclass
class Plan:
    """What every task knows: partition bits, model of words alone, texts learnt
    from, and the number of each partition's first word."""
    bits: int
    alone: Alone
    texts: int
    first: np.ndarray

    @property
    def begin(self) -> int:
        """The number of the beginning, after all words'."""
        return int(self.first[-1])

    def kinds(self) -> tuple[type, type]:
        """Integer types of word numbers and of counts."""
        return np.uint32 if self.begin < 2**32 - 1 else np.int64, np.uint32 if self.alone.tokens < 2**32 else np.int64

    def numbers(self, s: Slice, answers: list[dict]) -> tuple[np.ndarray, np.ndarray]:
        """Training count and number of each word of a slice."""
        bucket = (s.vocab >> np.uint64(64 - self.bits)).astype(np.int64)
        return joined(answers, "a", np.int64), self.first[bucket] + joined(answers, "b", np.uint32)

    def order(self, s: Slice, count: np.ndarray, context: np.ndarray, token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bucket of each pair, and the pairs' order by bucket."""
        shift, extra = np.uint64(64 - self.bits), 1 << self.bits
        often = np.append(True, count >= max(2, FREQUENT * self.alone.tokens))
        by_word = (s.vocab >> shift).astype(np.int64)
        bucket = np.where(often[context], extra + by_word[token], np.append(0, by_word)[context])
        return bucket, np.argsort(bucket, kind="stable")


_ASK = "bucket int, sid long, contexts binary, sizes binary, words binary, counts binary, alone binary"


def ask_pairs(table: DataFrame, answers: DataFrame, plan: Plan) -> DataFrame:
    """Every slice's distinct pairs by bucket: contexts with how many pairs each
    has, the pairs' words, training counts there, and the words' totals."""

    def run(key, left, right):
        rows = []
        for row in left.to_pylist():
            s = Slice(row)
            count, number = plan.numbers(s, in_slice(right.to_pylist(), WORDS))
            context, token, which = s.pairs()
            here = np.bincount(which[s.learnt], minlength=len(context))
            bucket, order = plan.order(s, count, context, token)
            bucket, context, token, here = bucket[order], context[order], token[order], here[order]
            number_kind, count_kind = plan.kinds()
            of = np.append(plan.begin, number).astype(number_kind)
            count = count.astype(count_kind)
            for x, y in zip(*cuts_of(bucket)):
                a, b = cuts_of(context[x:y])
                rows.append((int(bucket[x]), s.sid, of[context[x:y][a]].tobytes(), (b - a).astype(np.uint32).tobytes(),
                             of[token[x:y] + 1].tobytes(), here[x:y].astype(np.uint32).tobytes(), count[token[x:y]].tobytes()))
        kinds = (pa.int32(), pa.int64(), *[pa.binary()] * 5)
        return pa.table([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 7, kinds)],
                        names=["bucket", "sid", "contexts", "sizes", "words", "counts", "alone"])

    words = answers.where(F.col("kind") == WORDS)
    return table.groupBy("sid").cogroup(words.groupBy("sid")).applyInArrow(run, _ASK)


def count_pairs(asked: DataFrame, plan: Plan) -> DataFrame:
    """Answers: how often each pair was seen, and of its context the followers
    seen 1 .. TOP times, tokens of those seen more often, and the sum of P(w) over
    followers seen; contexts spread over buckets give these sums as rows."""
    extra = 1 << plan.bits

    def reduce(key, t):
        bucket = key[0].as_py()
        sizes = [np.frombuffer(x, np.uint32) for x in t["sizes"].to_pylist()]
        number_kind, count_kind = plan.kinds()
        heads = [np.frombuffer(x, number_kind) for x in t["contexts"].to_pylist()]
        word, here, count = (np.concatenate([np.frombuffer(x, k) for x in t[c].to_pylist()])
                             for c, k in (("words", number_kind), ("counts", np.uint32), ("alone", count_kind)))
        names, head_no = np.unique(np.concatenate(heads), return_inverse=True)
        context = np.repeat(head_no, np.concatenate(sizes))
        order = np.lexsort((word, context))
        c, w = context[order], word[order]
        new = np.ones(len(c), bool)
        new[1:] = (c[1:] != c[:-1]) | (w[1:] != w[:-1])
        pair = np.cumsum(new) - 1
        seen = np.bincount(pair, weights=here[order]).astype(np.int64)
        back = np.empty(len(c), np.int64)
        back[order] = seen[pair]
        of, p = c[new], plan.alone.p(count[order][new])
        on = seen > 0
        few = np.zeros((len(names), TOP), np.int64)
        low = on & (seen <= TOP)
        np.add.at(few, (of[low], seen[low] - 1), 1)
        many = np.bincount(of[seen > TOP], weights=seen[seen > TOP], minlength=len(names))
        mass = np.bincount(of[on], weights=p[on], minlength=len(names))
        sums = np.column_stack([few, many, mass])
        stats = np.concatenate(([0, 0, 0], np.bincount(np.minimum(seen, TOP + 2), minlength=TOP + 3)[1:TOP + 2]))
        rows = [(-1, TOTALS, bucket, stats.astype(np.int64).tobytes(), None)]
        ends, head_ends = np.cumsum([x.sum() for x in sizes]), np.cumsum([len(x) for x in heads])
        for sid, e, n, he, hn in zip(t["sid"].to_pylist(), ends, [int(x.sum()) for x in sizes], head_ends, map(len, heads)):
            b = None if bucket >= extra else packed_sums(sums[head_no[he - hn:he]])
            rows.append((sid, PAIRS, bucket, back[e - n:e].astype(count_kind).tobytes(), b))
        if bucket >= extra:
            rows += [(int(h), SUMS, bucket, x.astype(np.float64).tobytes(), None) for h, x in zip(names, sums)]
        return _answers(rows)

    return asked.groupBy("bucket").applyInArrow(reduce, _ANSWER_SQL)


def packed_sums(sums: np.ndarray) -> bytes:
    return np.ascontiguousarray(sums.T, np.float64).tobytes()       # column by column: long runs of zeros


def frequent_sums(answers: DataFrame) -> dict[int, np.ndarray]:
    """Sums of the contexts that are spread over buckets: at most 1 / FREQUENT + 1 rows."""

    def spread(batches):
        for b in batches:
            x = np.frombuffer(b"".join(b.column(1).to_pylist()), np.float64).reshape(-1, TOP + 2)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c) for c in x.T)], names=["h", *(f"s{i}" for i in range(TOP + 2))])

    kinds = ", ".join(f"s{i} double" for i in range(TOP + 2))
    got = (answers.where(F.col("kind") == SUMS).select("sid", "a").mapInArrow(spread, f"h long, {kinds}")
           .groupBy("h").agg(*[F.sum(f"s{i}").alias(f"s{i}") for i in range(TOP + 2)]).collect())
    return {r.h: np.array(r[1:]) for r in got}


# -- scores ---------------------------------------------------------------------
def scored(table: DataFrame, answers: DataFrame, plan: Plan, after: After, often: dict[int, np.ndarray]) -> DataFrame:
    alone = plan.alone
    often_number = np.array(sorted(often), np.int64)
    often_sums = np.array([often[h] for h in sorted(often)]).reshape(-1, TOP + 2)

    def run(key, left, right):
        out = []
        for row in left.to_pylist():
            s = Slice(row)
            got = right.to_pylist()
            count, number = plan.numbers(s, in_slice(got, WORDS))
            context, token, which = s.pairs()
            _, order = plan.order(s, count, context, token)
            answered = in_slice(got, PAIRS)
            seen = np.empty(len(context), np.int64)
            seen[order] = joined(answered, "a", plan.kinds()[1])
            # sums of each context: from its bucket, or from the few spread ones
            sums = np.zeros((len(s.vocab) + 1, TOP + 2))
            cold = [np.frombuffer(a["b"], np.float64).reshape(TOP + 2, -1).T for a in answered if a["b"] is not None]
            of = np.append(plan.begin, number)
            spread = np.zeros(len(of), bool)
            if len(often_number):
                at = np.minimum(np.searchsorted(often_number, of), len(often_number) - 1)
                spread = often_number[at] == of
                sums[spread] = often_sums[at[spread]]
            used = np.unique(context)
            if cold:
                sums[used[~spread[used]]] = np.concatenate(cold)
            total = np.append(plan.texts, count)
            scale, left_mass = after.left(total, sums[:, :TOP], sums[:, TOP])
            rest = np.maximum(1 - sums[:, TOP + 1], 1e-300)
            p = alone.p(count)
            with np.errstate(divide="ignore", invalid="ignore"):
                log_alpha = np.where(total > 0, np.log10(left_mass / rest), 0.0)
                d = after.discount[np.minimum(seen, TOP + 1)]
                log_seen = np.log10(d * seen * scale[context] / np.maximum(total[context], 1))
            log_pair = np.where(seen > 0, log_seen, log_alpha[context] + np.log10(p)[token])
            n = np.diff(s.starts)
            base = np.log10((count + 1) / (alone.tokens + alone.words + 1))
            known = (count > 0)[s.tokens]
            at = s.starts[:-1]
            out.append(pa.table({
                "doc_id": pa.array(s.ids, pa.int64()), "held_out": pa.array(~s.learn), "n_tokens": pa.array(n),
                "n_known": pa.array(np.add.reduceat(known.astype(np.int64), at)), "train_tokens": pa.array(np.full(len(n), alone.tokens)),
                "base_score": pa.array(np.add.reduceat(base[s.tokens], at)), "score": pa.array(np.add.reduceat(log_pair[which], at))}))
        return pa.concat_tables(out) if out else _SCORES.empty_table()

    return (table.groupBy("sid").cogroup(answers.where(F.col("kind").isin(WORDS, PAIRS)).groupBy("sid"))
            .applyInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"))


_SCORES = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                     ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])


def score(docs: DataFrame, mod: int = 7, rest: int = 2) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of
    every text; learns from those whose crc32(doc_id) mod ``mod`` is not ``rest``."""
    spark = docs.sparkSession
    bits = max(4, (partitions(spark) - 1).bit_length())
    table = store_by(slice_table(columns(docs), mod, rest), "slices", "sid")
    words = store(count_words(ask_words(table, bits)), "words")
    buckets, stats = totals(words)
    size = np.zeros(1 << bits, np.int64)
    size[buckets] = stats[:, 0]
    got = stats.sum(axis=0)
    key = F.col("doc_id").cast("string").cast("binary")
    texts = columns(docs).where(F.pmod(F.crc32(key), F.lit(mod)) != rest).count()
    plan = Plan(bits, Alone.of(int(got[1]), int(got[2]), got[3:]), texts, np.concatenate(([0], np.cumsum(size))))
    pairs = store(count_pairs(ask_pairs(table, words, plan), plan), "pairs")
    after = After(good_turing(totals(pairs)[1].sum(axis=0)[3:]))
    return scored(table, words.unionByName(pairs), plan, after, frequent_sums(pairs))
