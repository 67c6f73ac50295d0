"""Approximate nearest neighbours by multiprobe p-stable hashing.

A table hashes a vector to ``hashes`` numbers floor((a . x + b) / width) with
normal a: near vectors share many.  A query looks into its own bucket and into
buckets a step away in one or more of these numbers, in the order of their
expected squared distance from the query's place (the boundaries nearest to it
first), ``probes`` buckets a table; what the ``tables`` tables give is merged and
ranked by the exact inner product.

Largest inner product becomes smallest distance by one more coordinate: rows are
scaled by the largest norm M of their band and get sqrt(1 - |x|^2), queries are
scaled to length 1 and get 0.  A band holds the rows of a block whose norms are
more than ``ratio`` times its largest, so that rows of other norms do not shrink
them towards one point; every band has its own tables.

Bands are searched from the largest norm down.  A band whose norm cannot reach
the k-th product found so far is left out, which loses nothing.  For the others
the chance is computed that the probes of this query missed a row as good as the
k-th found: given a . q, a . (x - q) is normal, so each probed bucket has a known
chance, and tables are independent.  If it is above ``miss``, or fewer than k
rows are found, the query is compared with the whole band.

Rows are dealt by a hash of their id into blocks of at most ``block`` rows, the
stated queries into chunks, and every chunk meets every block in one cogroup:
even tasks whatever the buckets' sizes, so a vector that a third of all rows
share fills no task.  A block gives the best k of each query, and these are
merged.  Every block goes through the tables, whatever its size; a caller can have
blocks of at most ``whole`` rows compared without them.

Defined results: vectors that are null, empty, zero or hold a null or a
non-finite number take no part; only vectors of a query's length are compared
with it; rows of the query's own id are left out; rows of one id count once,
the one with the smallest components; equal products go to the smaller id;
without queries or rows there is no result; extra columns are not
read.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almanac.llm.common import partitions

TABLES, HASHES, WIDTH, PROBES = 24, 12, 2.4, 100
BLOCK, CHUNK, WHOLE = 16384, 4096, 0
#: Smallest norm in a band as a share of its largest; chance of a missed row above which a band is compared whole.
RATIO, MISS = 0.8, 0.01
#: The normal distribution function on a grid.
_AT = np.linspace(-9, 9, 36001)
_BELOW = np.array([0.5 * math.erfc(-z / math.sqrt(2)) for z in _AT])


def probe_sets(hashes: int, probes: int) -> np.ndarray:
    """0/1 rows over the 2 * hashes boundaries sorted by distance: which are
    crossed, in the order of the expected sum of squared distances."""
    m = hashes
    z = [j * (j + 1) / (4 * (m + 1) * (m + 2)) if j <= m else
         1 - (2 * m + 1 - j) / (m + 1) + (2 * m + 1 - j) * (2 * m + 2 - j) / (4 * (m + 1) * (m + 2)) for j in range(1, 2 * m + 1)]
    out = [np.zeros(2 * m, np.uint64)]
    heap = [(z[0], (0,))]
    while heap and len(out) < probes:
        cost, crossed = heapq.heappop(heap)
        if not any(2 * m - 1 - j in crossed for j in crossed):   # not both sides of one number
            row = np.zeros(2 * m, np.uint64)
            row[list(crossed)] = 1
            out.append(row)
        last = crossed[-1]
        if last + 1 < 2 * m:
            heapq.heappush(heap, (cost - z[last] + z[last + 1], (*crossed[:-1], last + 1)))
            heapq.heappush(heap, (cost + z[last + 1], (*crossed, last + 1)))
    return np.array(out)


class Tables:
    """The hash tables of one band of a block."""

    def __init__(self, rows: np.ndarray, norm: float, tables: int = TABLES, hashes: int = HASHES, width: float = WIDTH,
                 probes: int = PROBES, seed: int | tuple[int, ...] = 7):
        rng = np.random.default_rng(seed)    # the same numbers whenever a task runs again
        dim = rows.shape[1] + 1
        self.hashes, self.width = hashes, width
        self.a = rng.normal(size=(tables, dim, hashes))
        self.b = rng.uniform(0, width, (tables, hashes))
        self.r = rng.integers(1, 2**63, (tables, hashes), dtype=np.uint64) | np.uint64(1)
        self.sets = probe_sets(hashes, probes)
        x = rows / norm
        x = np.column_stack([x, np.sqrt(np.maximum(0, 1 - np.einsum("ij,ij->i", x, x)))])
        self.n, self.parts = len(rows), []
        for a, b, r in zip(self.a, self.b, self.r):
            code = np.floor((x @ a + b) / width).astype(np.int64).astype(np.uint64)
            key = (code * r).sum(axis=1, dtype=np.uint64)
            order = np.argsort(key, kind="stable")
            buckets, first, count = np.unique(key[order], return_index=True, return_counts=True)
            self.parts.append((order, buckets, first, count))

    def candidates(self, queries: np.ndarray) -> np.ndarray:
        """Which rows each query's probes meet: a boolean matrix."""
        q = queries / np.linalg.norm(queries, axis=1, keepdims=True)
        q = np.column_stack([q, np.zeros(len(q))])
        met = np.zeros((len(q), self.n), bool)
        flat = met.reshape(-1)
        for a, b, r, (order, buckets, first, count) in zip(self.a, self.b, self.r, self.parts):
            place = (q @ a + b) / self.width
            code = np.floor(place)
            inside = place - code
            near = np.argsort(np.concatenate([inside, 1 - inside], axis=1), axis=1, kind="stable")
            step = np.concatenate([np.uint64(0) - r, r])[near]           # what crossing a boundary adds to the key
            key = (code.astype(np.int64).astype(np.uint64) * r).sum(axis=1, dtype=np.uint64)
            keys = key[:, None] + step @ self.sets.T
            at = np.minimum(np.searchsorted(buckets, keys), len(buckets) - 1)
            who, which = np.nonzero(buckets[at] == keys)
            bucket = at[who, which]
            size = count[bucket]
            ends = np.cumsum(size)
            if len(ends) and ends[-1]:
                member = order[np.arange(ends[-1]) + np.repeat(first[bucket] - (ends - size), size)]
                flat[np.repeat(who, size) * self.n + member] = True
        return met

    def missed(self, queries: np.ndarray, product: np.ndarray) -> np.ndarray:
        """The chance that no probe of a query meets a row whose product with it,
        both scaled, is the one given."""
        q = queries / np.linalg.norm(queries, axis=1, keepdims=True)
        c = np.clip(product, -1, 1)[:, None]
        spread = np.maximum(np.sqrt(1 - c * c), 1e-9) / self.width
        sets = self.sets.T.astype(float)
        out = np.ones(len(q))
        for a, b in zip(self.a, self.b):
            along = q @ a[:-1]
            place = (along + b) / self.width
            inside = place - np.floor(place)
            middle = inside - (1 - c) * along / self.width       # where such a row's place is expected
            edges = [np.interp((e - middle) / spread, _AT, _BELOW) for e in (-1, 0, 1, 2)]
            down, stay, up = (np.log(np.maximum(y - x, 1e-30)) for x, y in zip(edges, edges[1:]))
            near = np.argsort(np.concatenate([inside, 1 - inside], axis=1), axis=1, kind="stable")
            step = np.take_along_axis(np.concatenate([down - stay, up - stay], axis=1), near, axis=1)
            met = np.exp(stay.sum(axis=1, keepdims=True) + step @ sets).sum(axis=1)
            out *= np.clip(1 - met, 0, 1)
        return out


def bands(rows: np.ndarray, ratio: float) -> list[tuple[np.ndarray, float]]:
    """The rows' places by norm, largest first, cut where a norm falls to
    ``ratio`` times the band's largest; with that largest norm."""
    norm = np.linalg.norm(rows, axis=1)
    order = np.argsort(-norm, kind="stable")
    falling = -norm[order]
    out, a = [], 0
    while a < len(order):
        b = max(a + 1, int(np.searchsorted(falling, ratio * falling[a], side="left")))
        out.append((order[a:b], float(-falling[a])))
        a = b
    return out


class Block:
    """One block of rows: its bands, with tables made when first asked for."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, k: int, ratio: float, miss: float, seed: tuple[int, ...], *shape):
        self.k, self.miss, self.seed, self.shape = k, miss, seed, shape
        self.parts = [(np.ascontiguousarray(rows[p]), ids[p], top) for p, top in bands(rows, ratio)]
        self.tables: dict[int, Tables] = {}
        self.scans = 0      # bands compared whole, over all queries

    def search(self, queries: np.ndarray, names: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids and products of the best rows of each query."""
        none = (np.empty(0, np.int64), np.empty(0))
        found, length = [none] * len(queries), np.linalg.norm(queries, axis=1)
        least = np.full(len(queries), -np.inf)       # the k-th product found
        for n, (rows, ids, top) in enumerate(self.parts):
            live = np.flatnonzero(length * top * (1 + 1e-9) >= least)
            if not len(live):
                break
            if n not in self.tables:
                self.tables[n] = Tables(rows, top, *self.shape, seed=(*self.seed, n))
            met = self.tables[n].candidates(queries[live])
            before = [found[i] for i in live]
            for i, old, row in zip(live, before, met):
                found[i] = merged(old, best(rows, ids, queries[i], names[i], np.flatnonzero(row), self.k), self.k)
                least[i] = found[i][1][-1] if len(found[i][1]) == self.k else -np.inf
            chance = self.tables[n].missed(queries[live], least[live] / (length[live] * top))
            part = (chance > self.miss) & ~met.all(axis=1) | np.isinf(least[live])
            rough = rows @ queries[live[part]].T
            for i, old, r in zip(live[part], [x for x, y in zip(before, part) if y], rough.T):
                found[i] = merged(old, best(rows, ids, queries[i], names[i], np.arange(len(ids)), self.k, r), self.k)
                least[i] = found[i][1][-1] if len(found[i][1]) == self.k else -np.inf
            self.scans += int(part.sum())
        return found


def merged(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best of two results over different rows."""
    if not len(a[0]):
        return b
    ids, score = np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]])
    order = np.lexsort((ids, -score))[:k]
    return ids[order], score[order]


def products(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products added up from the first component on, so that equal
    vectors have equal products wherever they stand."""
    return np.cumsum(rows * query, axis=1)[:, -1]


def best(rows: np.ndarray, ids: np.ndarray, query: np.ndarray, own: int, pick: np.ndarray, k: int,
         rough: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best of the picked rows: ids and exact products, best first.
    ``rough``: the products of the picked rows, where they are known."""
    other = ids[pick] != own
    pick = pick[other]
    rough = rows[pick] @ query if rough is None else rough[other]
    if len(rough) > k:
        edge = np.partition(rough, len(rough) - k)[len(rough) - k]
        pick = pick[rough >= edge - 1e-9 * max(1.0, abs(edge)) - 1e-12 * np.abs(rough).max()]
    exact = products(rows[pick], query)
    order = np.lexsort((ids[pick], -exact))[:k]
    return ids[pick][order], exact[order]


def one_each(ids: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One row an id.  All rows of an id are in one block and chunk."""
    if len(np.unique(ids)) == len(ids):
        return ids, rows
    order = np.lexsort((*rows.T[::-1], ids))
    keep = order[np.append(True, np.diff(ids[order]) != 0)]
    return ids[keep], rows[keep]


def matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def usable(vector: str) -> Column:
    """Not null, and only finite numbers, not all zero."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0)


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, block: int = BLOCK, chunk: int = CHUNK, whole: int = WHOLE,
            tables: int = TABLES, hashes: int = HASHES, width: float = WIDTH, probes: int = PROBES,
            ratio: float = RATIO, miss: float = MISS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows found with the largest
    inner product for every row that ``is_query`` (a condition on ``vec_id``)."""
    spark = vectors.sparkSession
    rows = (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
            .where(F.col("vec_id").isNotNull() & usable("embedding")).withColumn("dim", F.size("embedding")))
    sizes = {r.dim: r for r in rows.groupBy("dim").agg(
        F.count("*").alias("n"), F.sum(F.coalesce(is_query, F.lit(False)).cast("long")).alias("q")).collect()}   # a row a length
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")

    def split(n: int, most: int) -> int:
        return max(1, math.ceil(n / most))

    blocks = {d: split(r.n, block) for d, r in sizes.items()}
    tasks = partitions(spark)
    chunks = {d: max(split(r.q, chunk), min(split(tasks, blocks[d]), split(r.q, 256))) for d, r in sizes.items()}

    def number(of: dict[int, int]) -> Column:
        return F.element_at(F.create_map(*[x for d, n in of.items() for x in (F.lit(d), F.lit(n))]), F.col("dim"))

    dealt = F.pmod(F.xxhash64("vec_id"), number(blocks)).cast("int")
    data = rows.select("dim", dealt.alias("block"), F.explode(F.sequence(F.lit(0), number(chunks) - 1)).alias("chunk"), "vec_id", "embedding")
    ask = (rows.where(is_query)
           .select("dim", F.explode(F.sequence(F.lit(0), number(blocks) - 1)).alias("block"),
                   F.pmod(F.xxhash64("vec_id", F.lit(1)), number(chunks)).cast("int").alias("chunk"), "vec_id", "embedding"))
    out = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def search(key, left, right):
        if left.num_rows == 0 or right.num_rows == 0:
            return out.empty_table()
        dim = key[0].as_py()
        ids, x = one_each(left["vec_id"].to_numpy(), matrix(left["embedding"], dim))
        names, q = one_each(right["vec_id"].to_numpy(), matrix(right["embedding"], dim))
        rows = Block(x, ids, k, ratio, miss, (7, dim, key[1].as_py()), tables, hashes, width, probes) if len(x) > whole else None
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for a in range(0, len(q), 256):
            y = slice(a, a + 256)
            found += rows.search(q[y], names[y]) if rows else [
                best(x, ids, v, own, np.arange(len(ids)), k) for v, own in zip(q[y], names[y])]
        n = [len(f[0]) for f in found]
        return pa.table([pa.array(np.repeat(names, n)), pa.array(np.concatenate([f[0] for f in found])),
                         pa.array(np.concatenate([f[1] for f in found]))], schema=out)

    near = (data.groupBy("dim", "block", "chunk").cogroup(ask.groupBy("dim", "block", "chunk"))
            .applyInArrow(search, "query_id long, vec_id long, score double"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
