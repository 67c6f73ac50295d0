"""N-gram Jaccard join with rare-first prefix filtering.

A document's set is its distinct ``k``-word shingles (64-bit hashes).  Two
documents link when ``100 * |x & y| >= percent * |x | y|``.

1. One pass gives each document's set size and the fingerprint of its set;
   equal sets are one node from here on.  It also reports shingles that many
   documents of a slice share, and those that many documents of the corpus do
   become a small table.
2. A second pass sends every shingle with its set's fingerprint to the bucket of
   the shingle's hash, as packed arrays.  There shingles of one set alone drop
   out; the others return to their sets with their document frequency.  The many
   entries of very frequent shingles go to salted buckets instead of one.
3. A set's tokens are ordered rarest first (unshared ones lead).  Only sets with
   enough shared tokens for any link stay: they keep the shared tokens, all that
   an intersection can hold.  The prefix is the first ``n - ceil(t n) + 1``.
4. Candidates share a prefix token.  Each set is first compared with one centre
   of the lists it is on, which joins the members of a large group of near
   copies without listing their pairs.  Then every pair
   of *different* components that shares a prefix token and passes the length
   and positional filters and a parity-bitmap bound on the difference is
   compared: no link between different components goes unseen.
5. A pair is compared once, on its two token lists: the suffix filter bounds the
   difference by halving the lists, then the intersection decides.

Defined results: a null or empty text, or one without words, has no shingles and
is a component of its own; a text of fewer than ``k`` words is one shingle;
repeated rows are alike and share a component; a null id never is a component's
smallest unless it is alone; no rows give no rows; extra columns are not read by
:func:`components` and kept by :func:`one_of_each`.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.llm.common import Words, columns, mix64, rolling, slices, store
from almanac.llm.components import connected

#: A shingle of more than this share of documents, and at least so many, goes to salted buckets.
FREQUENT, FREQUENT_LEAST = 1 / 256, 1000
#: 64-bit words of a bitmap.
MAPS = 8
#: Bytes of text worked on at once in a task.
SLICE = 4 << 20
#: Sets on a list, above which :func:`all_pairs` and :func:`other_pairs` cut it into parts.
LIST = 1024
#: Shingles that a bucket of hashes holds, about.
BUCKET = 1 << 20

_BLOB = "fps binary, ns binary, counts binary, hashes binary"


# -- sets -----------------------------------------------------------------
def sets_of(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, joined, and where each begins."""
    w = Words(texts)
    runs = rolling(w.hash, k)
    parts, size = [], np.zeros(len(w.starts), np.int64)
    for i, (a, b) in enumerate(zip(w.starts.tolist(), w.starts[1:].tolist())):
        if b - a >= k:
            own = np.unique(runs[a:b - k + 1])
        elif b > a:
            own = rolling(w.hash[a:b], b - a)
        else:
            continue
        parts.append(own)
        size[i + 1] = len(own)
    return (np.concatenate(parts) if parts else np.empty(0, np.uint64)), np.cumsum(size)


def set_prints(h: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each set (0 for empty ones)."""
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix64(h ^ np.uint64(0x5851F42D4C957F2D)))))
    n = np.diff(starts).astype(np.uint64)
    out = mix64((total[starts[1:]] - total[starts[:-1]]) + n)
    out[n == 0] = 0
    return out


def set_table(docs: DataFrame, k: int) -> DataFrame:
    """``doc_id, n, fp`` of every row; one row of each slice also carries the
    slice's repeated shingles and their counts."""

    def run(batches):
        for b in (s for b in batches for s in slices(b, SLICE)):
            h, starts = sets_of(b.column(1), k)
            fps, n = set_prints(h, starts), np.diff(starts)
            keep = np.zeros(len(n), bool)
            keep[np.unique(fps, return_index=True)[1]] = True
            own, count = np.unique(h[np.repeat(keep, n)], return_counts=True)
            many = count >= max(2, FREQUENT * keep.sum())
            first = [own[many].tobytes()] + [None] * (len(n) - 1), [count[many].astype(np.int64).tobytes()] + [None] * (len(n) - 1)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n), pa.array(fps.view(np.int64)), *(pa.array(x, pa.binary()) for x in first)],
                names=["doc_id", "n", "fp", "common", "counts"])

    return docs.mapInArrow(run, "doc_id long, n long, fp long, common binary, counts binary")


def frequent(table: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of shingles of at least FREQUENT of all documents, and
    their (reported) counts: no more than mean set size / FREQUENT."""

    def rows(batches):
        for b in batches:
            for h, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(h, np.int64)), pa.array(np.frombuffer(c, np.int64))], names=["h", "c"])

    least = max(FREQUENT_LEAST, int(FREQUENT * table.count()))
    found = (table.where("common is not null").select("common", "counts").mapInArrow(rows, "h long, c long")
             .groupBy("h").agg(F.sum("c").alias("c")).where(F.col("c") >= least).collect())
    h = np.array([r.h for r in found], np.int64).view(np.uint64)
    order = np.argsort(h)
    return h[order], np.array([r.c for r in found], np.int64)[order]


# -- shared tokens ----------------------------------------------------------
def _blob(fps, ns, counts, hashes) -> list[bytes]:
    return [fps.tobytes(), ns.astype(np.uint32).tobytes(), counts.astype(np.uint32).tobytes(), hashes.tobytes()]


def _unblob(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(fingerprint, set size) of each owner, the owner of each entry, the entries' hashes."""
    def joined(name, kind):
        return np.concatenate([np.frombuffer(x, kind) for x in t[name].to_pylist()])
    fps, ns, counts = joined("fps", np.uint64), joined("ns", np.uint32), joined("counts", np.uint32)
    return fps, ns, np.repeat(np.arange(len(fps)), counts), joined("hashes", np.uint64)


def to_buckets(docs: DataFrame, k: int, bits: int, common: np.ndarray) -> DataFrame:
    """Every set's shingles by the high bits of their hash, packed by set; those
    of ``common`` go to as many further buckets, by the set's fingerprint."""
    shift, extra = np.uint64(64 - bits), 1 << bits

    def run(batches):
        for b in (s for b in batches for s in slices(b, SLICE)):
            h, starts = sets_of(b.column(1), k)
            fps, n = set_prints(h, starts), np.diff(starts)
            keep = np.zeros(len(n), bool)
            keep[np.unique(fps, return_index=True)[1]] = True
            keep &= n > 0
            doc = np.repeat(np.arange(len(n)), n)
            used = keep[doc]
            h, doc = h[used], doc[used]
            bucket = (h >> shift).astype(np.int64)
            if len(common) and len(h):
                at = np.minimum(np.searchsorted(common, h), len(common) - 1)
                often = common[at] == h
                bucket[often] = extra + (fps[doc[often]] >> shift).astype(np.int64)
            order = np.argsort(bucket, kind="stable")   # within a bucket by document, as before
            h, doc, bucket = h[order], doc[order], bucket[order]
            head = np.flatnonzero(np.append(True, (bucket[1:] != bucket[:-1]) | (doc[1:] != doc[:-1]))) if len(h) else np.empty(0, np.int64)
            counts = np.diff(np.append(head, len(h)))
            owner = doc[head]
            cut = np.flatnonzero(np.append(True, np.diff(bucket[head]) != 0)) if len(head) else np.empty(0, np.int64)
            rows = []
            for x, y in zip(cut, np.append(cut[1:], len(head))):
                end = head[y] if y < len(head) else len(h)
                rows.append([int(bucket[head[x]]), *_blob(fps[owner[x:y]], n[owner[x:y]], counts[x:y], h[head[x]:end])])
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows), (pa.int32(), *[pa.binary()] * 4))],
                                                 names=["bucket", "fps", "ns", "counts", "hashes"])

    return docs.mapInArrow(run, f"bucket int, {_BLOB}")


_BACK = pa.schema([("owner", pa.int32()), *[(c, pa.binary()) for c in ("fps", "ns", "counts", "hashes", "dfs")]])


def shared(buckets: DataFrame, bits: int, common: np.ndarray, counted: np.ndarray) -> DataFrame:
    """Entries of shingles that at least two sets hold, with the number of those
    sets, dealt by fingerprint."""
    shift, extra = np.uint64(64 - bits), 1 << bits

    def reduce(key, t):
        fps, ns, owner, h = _unblob(t)
        ids, first, same = np.unique(fps, return_index=True, return_inverse=True)
        ns, owner = ns[first], same[owner]
        order = np.lexsort((owner, h))
        h, owner = h[order], owner[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])   # copies of a set came from several slices
        h, owner = h[new], owner[new]
        if key[0].as_py() >= extra:
            df = counted[np.searchsorted(common, h)]
        else:
            head = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
            count = np.diff(np.append(head, len(h)))
            df = np.repeat(count, count)
            many = df > 1
            h, owner, df = h[many], owner[many], df[many]
        order = np.argsort(owner, kind="stable")                  # ids are sorted, so by fingerprint
        h, owner, df = h[order], owner[order], df[order]
        if not len(h):
            return _BACK.empty_table()
        head = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        who = owner[head]
        to = (ids[who] >> shift).astype(np.int64)
        cut = np.flatnonzero(np.append(True, to[1:] != to[:-1]))
        ends = np.append(head, len(h))
        rows = [[int(to[x]), *_blob(ids[who[x:y]], ns[who[x:y]], np.diff(ends[x:y + 1]), h[ends[x]:ends[y]]),
                 np.minimum(df[ends[x]:ends[y]], 2**32 - 1).astype(np.uint32).tobytes()]
                for x, y in zip(cut, np.append(cut[1:], len(head)))]
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), _BACK)], schema=_BACK)

    return buckets.repartition(extra, "bucket").groupBy("bucket").applyInArrow(reduce, f"owner int, {_BLOB}, dfs binary")


def needed(n, percent: int):
    """Least intersection of a set of n with any that it links with."""
    return -(-percent * n // 100)


def records(back: DataFrame, bits: int, percent: int) -> DataFrame:
    """``fp, n, u, tokens`` and bitmaps ``m0..`` of sets with enough shared
    tokens for a link: ``tokens`` rarest first, ``u`` the number unshared."""
    names = [f"m{i}" for i in range(MAPS)]
    schema = pa.schema([("fp", pa.int64()), ("n", pa.int64()), ("u", pa.int64()), ("tokens", pa.binary()), *[(m, pa.int64()) for m in names]])

    def assemble(key, t):
        fps, ns, owner, h = _unblob(t)
        df = np.concatenate([np.frombuffer(x, np.uint32) for x in t["dfs"].to_pylist()])
        ids, first, same = np.unique(fps, return_index=True, return_inverse=True)
        ns, owner = ns[first].astype(np.int64), same[owner]
        order = np.lexsort((h, df, owner))
        h, owner = h[order], owner[order]
        have = np.bincount(owner, minlength=len(ids))
        stays = have >= needed(ns, percent)
        starts = np.concatenate(([0], np.cumsum(have)))
        bit = mix64(h ^ np.uint64(0x2545F4914F6CDD1D)) % np.uint64(64 * MAPS)
        maps = np.zeros((len(ids), MAPS), np.uint64)
        np.bitwise_xor.at(maps, (owner, (bit >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (bit & np.uint64(63)))
        pick = np.flatnonzero(stays)
        return pa.table([pa.array(ids[pick].view(np.int64)), pa.array(ns[pick]), pa.array((ns - have)[pick]),
                         pa.array([h[starts[i]:starts[i + 1]].tobytes() for i in pick], pa.binary()),
                         *(pa.array(maps[pick, j].view(np.int64)) for j in range(MAPS))], schema=schema)

    return back.repartition(1 << bits, "owner").groupBy("owner").applyInArrow(assemble, "fp long, n long, u long, tokens binary, " + ", ".join(f"{m} long" for m in names))


# -- candidates ---------------------------------------------------------------
def postings(recs: DataFrame, percent: int) -> DataFrame:
    """``h, fp, pos, u`` of every prefix token of every set (pos: its place in the
    set's order; u: the set's unshared tokens)."""

    def run(batches):
        for b in batches:
            out = [[], [], [], []]
            for fp, n, u, tokens in zip(*(c.to_pylist() for c in b.columns)):
                own = np.frombuffer(tokens, np.int64)[:n - needed(n, percent) + 1 - u]
                out[0].append(own)
                out[1].append(np.full(len(own), fp, np.int64))
                out[2].append(np.arange(u, u + len(own)))
                out[3].append(np.full(len(own), u, np.int64))
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], names=["h", "fp", "pos", "u"])

    return recs.select("fp", "n", "u", "tokens").mapInArrow(run, "h long, fp long, pos long, u long")


def overlap_needed(nx: Column, ny: Column, percent: int) -> Column:
    return F.ceil(percent * (nx + ny) / F.lit(100.0 + percent) - 1e-9)


def may_link(x: str, y: str, percent: int) -> Column:
    """Length and positional filters."""
    nx, ny, px, py = (F.col(f"{s}.{c}") for c in ("n", "pos") for s in (x, y))
    length = (100 * nx >= percent * ny) & (100 * ny >= percent * nx)
    return length & (1 + F.least(nx - px - 1, ny - py - 1) >= overlap_needed(nx, ny, percent))


def may_differ_little(x: str, y: str, percent: int) -> Column:
    """The parity bitmaps differ in no more places than the sets may."""
    differ = F.col(f"{x}.u") + F.col(f"{y}.u")
    for i in range(MAPS):
        differ = differ + F.bit_count(F.col(f"{x}.m{i}").bitwiseXOR(F.col(f"{y}.m{i}")))
    nx, ny = F.col(f"{x}.n"), F.col(f"{y}.n")
    return differ <= nx + ny - 2 * overlap_needed(nx, ny, percent)


def suffix_bound(x: np.ndarray, y: np.ndarray, depth: int = 3) -> int:
    """A lower bound of the symmetric difference of two sorted arrays: cut both
    at the middle of one, and add up what the halves differ in length."""
    if depth == 0 or len(x) == 0 or len(y) == 0:
        return abs(len(x) - len(y))
    mid = len(y) // 2
    at = int(np.searchsorted(x, y[mid]))
    found = at < len(x) and x[at] == y[mid]
    return (suffix_bound(x[:at], y[:mid], depth - 1) + suffix_bound(x[at + found:], y[mid + 1:], depth - 1) + (not found))


def linked(x: np.ndarray, nx: int, y: np.ndarray, ny: int, percent: int) -> bool:
    """Exact decision on the shared tokens of two sets of nx and ny shingles."""
    least = -(-percent * (nx + ny) // (100 + percent))
    if min(len(x), len(y)) < least:
        return False
    x, y = np.sort(x), np.sort(y)
    if (nx - len(x)) + (ny - len(y)) + suffix_bound(x, y) > nx + ny - 2 * least:
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (nx + ny - both)


def verify(pairs: DataFrame, recs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link, with the pairs' other (long) columns."""
    kept = pairs.columns
    side = recs.select("fp", "n", "tokens")
    full = (pairs.join(side.select(F.col("fp").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta")), "a")
            .join(side.select(F.col("fp").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb")), "b")
            .select("na", "ta", "nb", "tb", *kept))

    def run(batches):
        for b in batches:
            ok = [linked(np.frombuffer(ta, np.uint64), na, np.frombuffer(tb, np.uint64), nb, percent)
                  for na, ta, nb, tb in zip(*(c.to_pylist() for c in b.columns[:4]))]
            yield b.select(kept).filter(pa.array(ok, pa.bool_()))

    return full.mapInArrow(run, ", ".join(f"{c} long" for c in kept))


def centre_pairs(lists: DataFrame) -> DataFrame:
    """Each set with the centre it shares most tokens with (a < b, each pair
    once).  A list's centre is its set with the fewest unshared tokens: of a
    group of near copies, the text they were made from."""
    top = (lists.groupBy("h").agg(F.min(F.struct("u", "fp")).alias("top"), F.count("*").alias("many"))
           .where("many > 1").select("h", F.col("top.fp").alias("centre")))
    met = lists.join(top, "h").where("fp <> centre").select("fp", "centre").repartition("fp")
    best = (met.groupBy("fp", "centre").agg(F.count("*").alias("c"))
            .groupBy("fp").agg(F.max(F.struct("c", "centre")).alias("m")))
    return best.select(F.least("fp", "m.centre").alias("a"), F.greatest("fp", "m.centre").alias("b")).distinct()


def other_pairs(lists: DataFrame, recs: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Every pair of sets of different components (ca, cb) that share a prefix
    token and pass the filters.  A list is entered from the sets that are not
    in its largest component, so a list of one component yields nothing."""
    entry = lists.join(labels, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    main = (entry.groupBy("h", "component").agg(F.count("*").alias("members"))
            .groupBy("h").agg(F.max(F.struct("members", "component")).alias("top"), F.count("*").alias("many"))
            .where("many > 1").select("h", F.col("top.component").alias("main")))
    full = entry.drop("u").join(main, "h").join(recs.select("fp", "n", "u", *[f"m{i}" for i in range(MAPS)]), "fp")
    # A long list is cut into parts of its left sides.
    parts = full.where("component <> main").groupBy("h").agg(F.ceil(F.count("*") / F.lit(LIST)).cast("int").alias("parts"))
    full = full.join(parts, "h")
    x = full.where("component <> main").withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")).alias("x")
    y = full.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).alias("y")
    once = (F.col("y.component") == F.col("y.main")) | (F.col("x.fp") < F.col("y.fp"))
    met = x.join(y, (F.col("x.h") == F.col("y.h")) & (F.col("x.part") == F.col("y.part")) & (F.col("x.component") != F.col("y.component")) & once
                 & may_link("x", "y", percent) & may_differ_little("x", "y", percent))
    swap = F.col("x.fp") > F.col("y.fp")
    return met.select(F.least("x.fp", "y.fp").alias("a"), F.greatest("x.fp", "y.fp").alias("b"),
                      F.when(swap, F.col("y.component")).otherwise(F.col("x.component")).alias("ca"),
                      F.when(swap, F.col("x.component")).otherwise(F.col("y.component")).alias("cb")).distinct()


def all_pairs(lists: DataFrame, recs: DataFrame, percent: int) -> DataFrame:
    """Every pair of sets (a < b) that share a prefix token and pass the filters,
    those of one component too.  A long list is cut into parts of its left sides."""
    parts = lists.groupBy("h").agg(F.ceil(F.count("*") / F.lit(LIST)).cast("int").alias("parts"), F.count("*").alias("many")).where("many > 1")
    full = lists.drop("u").join(parts.drop("many"), "h").join(recs.select("fp", "n", "u", *[f"m{i}" for i in range(MAPS)]), "fp")
    x = full.withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")).alias("x")
    y = full.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).alias("y")
    met = x.join(y, (F.col("x.h") == F.col("y.h")) & (F.col("x.part") == F.col("y.part")) & (F.col("x.fp") < F.col("y.fp"))
                 & may_link("x", "y", percent) & may_differ_little("x", "y", percent))
    return met.select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b")).distinct()


def classes(recs: DataFrame, percent: int) -> DataFrame:
    """``fp, component`` of every set that links with another."""
    lists = store(postings(recs, percent), "postings")
    tested = store(centre_pairs(lists), "pairs")
    links = store(verify(tested, recs, percent), "links")
    labels = connected(links).select(F.col("node").alias("fp"), "component")
    pairs = other_pairs(lists, recs, labels, percent).join(tested, ["a", "b"], "left_anti")
    more = store(verify(store(pairs, "pairs"), recs, percent), "links")
    if more.isEmpty():
        return labels
    merged = connected(more.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    now = merged.select(F.col("node").alias("component"), F.col("component").alias("now"))
    # Components joined to others, and sets that had no link before.
    fresh = now.select(F.col("component").alias("fp"), F.col("now").alias("component"))
    old = labels.join(now, "component", "left").select("fp", F.coalesce("now", "component").alias("component"))
    return old.unionByName(fresh).groupBy("fp").agg(F.min("component").alias("component"))


# -- the operator -------------------------------------------------------------
def sets_and_records(docs: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    rows = columns(docs)
    table = store(set_table(rows, k), "sets")
    common, counted = frequent(table)
    bits = bucket_bits(table)
    back = shared(to_buckets(rows, k, bits, common), bits, common, counted)
    return table, store(records(back, bits, percent), "records")


def bucket_bits(table: DataFrame) -> int:
    """Bits of a bucket's number: buckets of about BUCKET shingles, 16 at least."""
    shingles = table.agg(F.sum("n")).first()[0] or 0
    return max(4, (-(-shingles // BUCKET) - 1).bit_length())


def links(docs: DataFrame, k: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """All links: the verified pairs ``a, b`` (a < b) of different sets, and
    ``doc_id, fp, n_links`` of every row: its set (null without shingles; rows of
    one set all link) and the number of other rows that it links with.  The pairs
    grow with the square of a group of near copies; :func:`components` needs none
    of them inside a group."""
    table, recs = sets_and_records(docs, k, percent)
    lists = store(postings(recs, percent), "postings")
    pairs = store(verify(store(all_pairs(lists, recs, percent), "pairs"), recs, percent), "links")
    copies = table.where("n > 0").groupBy("fp").agg(F.count("*").alias("copies"))
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    beside = both.join(copies, F.col("b") == F.col("fp")).groupBy(F.col("a").alias("fp")).agg(F.sum("copies").alias("beside"))
    known = copies.join(beside, "fp", "left").select("fp", (F.col("copies") - 1 + F.coalesce("beside", F.lit(0))).alias("n_links"))
    own = table.select("doc_id", F.when(F.col("n") > 0, F.col("fp")).alias("fp"))
    return pairs, own.join(known, "fp", "left").select("doc_id", "fp", F.coalesce("n_links", F.lit(0)).alias("n_links"))


def components(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id`` (smallest doc_id reachable by
    links) of every row."""
    table, recs = sets_and_records(docs, k, percent)
    labels = classes(recs, percent)
    # Equal sets and linked ones get their smallest id; the others are their own.
    of = table.where("n > 0").groupBy("fp").agg(F.min("doc_id").alias("low"), F.count("*").alias("copies"))
    joined = of.join(labels, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    lows = joined.groupBy("component").agg(F.min("low").alias("component_id"), F.sum("copies").alias("members")).where("members > 1")
    salt = 16                          # a fingerprint of a third of all rows meets its label in 16 places
    known = store(joined.join(lows, "component").select("fp", "component_id"), "smallest")
    known = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    own = table.select("doc_id", "n", F.when(F.col("n") > 0, F.col("fp")).alias("fp"),
                       F.pmod(F.xxhash64("doc_id"), F.lit(salt)).cast("int").alias("salt"))
    return own.join(known, ["fp", "salt"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The documents, same columns, without those of a component but its
    smallest doc_id (of equal ids, every row; a null id stays if it is alone)."""
    keep = components(docs, k, percent).where("doc_id <=> component_id").select(F.col("doc_id").alias("_kept")).distinct()
    return docs.join(keep, F.col("doc_id").cast("long").eqNullSafe(F.col("_kept")), "left_semi")
