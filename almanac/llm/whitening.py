"""Whitening of embeddings by the exact characteristic polynomial.

Entries become whole numbers (:func:`whole`, 64ths), so the scatter matrix
``n * sum(x x') - S S'`` of the distinct vectors is a matrix of integers, exact
at any number of rows: tasks sum products exactly, Spark adds them as decimals.
Its characteristic polynomial comes from residues: for as many primes as a bound
on its coefficients asks for, the matrix is brought to Hessenberg form modulo the
prime (one task a few primes) and the residues are put together by Chinese
remainders.  All its roots are real, so the sign changes of its coefficients,
shifted to a point, count the roots above that point exactly (Descartes); halving
separates the roots, and halving by exact signs goes on to ``BITS`` bits.
Repeated roots are found by square-free factors beforehand.  A component spans
the null space of the scatter less its root: inverse iteration in decimals of
that precision, so it is right to the last bits of a double.

Size: only the d x d scatter, the residues and the components reach the driver
(d: entries of a vector), nothing that grows with the rows.  The work for the
polynomial grows like the fourth power of d, two seconds at 64.

Defined results: a vector that is null or holds a null, non-finite or too large
entry (64 times it reaches 2**53) is left out; of vectors of several lengths only
those of the length with most distinct vectors (ties: the shortest) are kept;
repeated vectors count once for the fit and all get results; rows with equal or
null vec_id stand for themselves; components whose eigenvalue is 0 are not
returned, so a table of one distinct vector, or an empty one, gives no rows; a
deviation too large for a long is null; extra columns are not read.
"""

from __future__ import annotations

import decimal
import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.llm.common import store

COMPONENTS = 16
#: Bits of a root behind the binary point, at least.
BITS = 192
_LIMB = 60


# -- vectors --------------------------------------------------------------------
def whole(values: np.ndarray) -> np.ndarray:
    """floor(64 c) of doubles.  The contract's numbers are larger by 1000000,
    which no covariance and no centred value depends on."""
    return np.floor(64.0 * values).astype(np.int64)


def usable(batch: pa.RecordBatch, column: int = 1) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """By length of vector: rows of the batch and their whole numbers."""
    vectors = batch.column(column)
    size = pc.fill_null(pc.list_value_length(vectors), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    for d in np.unique(size[size > 0]).tolist():
        rows = np.flatnonzero(size == d)
        flat = pc.list_flatten(vectors.take(pa.array(rows)))
        c = pc.fill_null(flat.cast(pa.float64()), math.nan).to_numpy(zero_copy_only=False).reshape(-1, d)
        ok = (np.abs(c) < 2.0**47).all(axis=1)              # false for NaN
        if ok.any():
            yield rows[ok], whole(c[ok])


def _pack(x: np.ndarray) -> list[bytes]:
    """Each row as bytes of its narrowest width, so equal rows are equal bytes."""
    top = np.abs(x).max(axis=1)
    return [r.astype("<i2" if t < 2**15 else "<i4" if t < 2**31 else "<i8").tobytes() for r, t in zip(x, top.tolist())]


def _unpack(batch: pa.RecordBatch, d: int) -> np.ndarray:
    raw = batch.column(0)
    width = pc.binary_length(raw).to_numpy() // d
    out = np.empty((len(raw), d), np.int64)
    for w in np.unique(width).tolist():
        rows = np.flatnonzero(width == w)
        out[rows] = np.frombuffer(b"".join(raw.take(pa.array(rows)).to_pylist()), f"<i{w}").reshape(-1, d)
    return out


def distinct_vectors(embeddings: DataFrame, vector: Column) -> DataFrame:
    """``d, x``: every distinct vector once, packed."""
    def run(batches):
        for b in batches:
            for _, x in usable(b, 0):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), x.shape[1], np.int32)), pa.array(_pack(x), pa.binary())],
                                                 names=["d", "x"])

    return embeddings.select(vector.alias("v")).mapInArrow(run, "d int, x binary").distinct()


# -- scatter --------------------------------------------------------------------
def _products(x: np.ndarray) -> np.ndarray:
    """x' x as exact integers."""
    total = np.zeros((x.shape[1], x.shape[1]), object)
    top = np.abs(x).max(axis=1)
    plain = x[top < 2**20].astype(float)                     # 2**13 such products stay exact in a double
    for at in range(0, len(plain), 2**13):
        part = plain[at:at + 2**13]
        total += (part.T @ part).astype(np.int64).astype(object)
    for r in x[top >= 2**20].astype(object):
        total += np.outer(r, r)
    return total


def _exact_sums(fit: DataFrame, d: int) -> tuple[int, list[int], list[list[int]]]:
    """n, sums and sums of products over the distinct vectors of length d."""
    def run(batches):
        n, s, p = 0, np.zeros(d, object), np.zeros((d, d), object)
        for b in batches:
            x = _unpack(b, d)
            n, s, p = n + len(x), s + x.astype(object).sum(axis=0) if len(x) else s, p + _products(x)
        if n:
            cells = [(-1, -1, n), *((-1, j, v) for j, v in enumerate(s)), *((i, j, p[i, j]) for i in range(d) for j in range(i, d))]
            yield pa.RecordBatch.from_arrays([
                pa.array([i for i, _, _ in cells], pa.int32()), pa.array([j for _, j, _ in cells], pa.int32()),
                pa.array([int(v) >> _LIMB for _, _, v in cells], pa.int64()),
                pa.array([int(v) & ((1 << _LIMB) - 1) for _, _, v in cells], pa.int64())], names=["i", "j", "high", "low"])

    parts = fit.where(F.col("d") == d).select("x").mapInArrow(run, "i int, j int, high long, low long")
    sums = {(r.i, r.j): (int(r.high) << _LIMB) + int(r.low) for r in parts.groupBy("i", "j").agg(
        *(F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low"))).collect()}     # d (d + 3) / 2 + 1 rows
    return sums[-1, -1], [sums[-1, j] for j in range(d)], [[sums[min(i, j), max(i, j)] for j in range(d)] for i in range(d)]


# -- characteristic polynomial ----------------------------------------------------
def polynomial_mod(matrix: np.ndarray, p: int) -> np.ndarray:
    """Coefficients, lowest first, of det(t - matrix) modulo a prime below
    2**31, by Hessenberg form."""
    a, n = matrix % p, len(matrix)
    for k in range(n - 2):
        below = np.flatnonzero(a[k + 1:, k])
        if not len(below):
            continue
        r = k + 1 + below[0]
        if r != k + 1:
            a[[r, k + 1]] = a[[k + 1, r]]
            a[:, [r, k + 1]] = a[:, [k + 1, r]]
        u = a[k + 2:, k] * pow(int(a[k + 1, k]), -1, p) % p
        a[k + 2:, k:] = (a[k + 2:, k:] - u[:, None] * a[k + 1, k:] % p) % p
        a[:, k + 1] = (a[:, k + 1] + (a[:, k + 2:] * u % p).sum(axis=1)) % p
    h, poly = a.tolist(), np.zeros((n + 1, n + 1), np.int64)
    poly[0, 0] = 1
    for m in range(1, n + 1):
        new = np.roll(poly[m - 1], 1) - poly[m - 1] * h[m - 1][m - 1] % p
        weight, t = np.zeros(m - 1, np.int64), 1
        for i in range(m - 2, -1, -1):
            t = t * h[i + 1][i] % p
            weight[i] = t * h[i][m - 1] % p
        poly[m] = (new - (weight[:, None] * poly[:m - 1] % p).sum(axis=0)) % p
    return poly[n]


def primes(count: int) -> list[int]:
    """The ``count`` largest primes below 2**31."""
    small = np.arange(2, 46341)
    for q in range(2, 216):
        small = small[(small == q) | (small % q != 0)]
    out, p = [], 2**31 - 1
    while len(out) < count:
        if (p % small != 0).all():
            out.append(p)
        p -= 2
    return out


def remainders(residues: list[tuple[int, list[int]]]) -> list[int]:
    """The numbers nearest 0 that have these residues, by prime."""
    value, modulus = [0] * len(residues[0][1]), 1
    for p, rest in residues:
        inverse = pow(modulus, -1, p)
        value = [v + modulus * ((r - v) * inverse % p) for v, r in zip(value, rest)]
        modulus *= p
    return [v - modulus if 2 * v > modulus else v for v in value]


def polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Characteristic polynomial of a symmetric integer matrix without negative
    eigenvalues, lowest coefficient first."""
    d = len(matrix)
    mean = -(-sum(matrix[i][i] for i in range(d)) // d)
    bound = max(math.comb(d, k) * mean**k for k in range(d + 1))           # symmetric means fall (Maclaurin)
    wanted = primes((2 * bound).bit_length() // 30 + 1)
    cells = np.array(matrix, object)

    def run(batches):
        for b in batches:
            for p in (wanted[i] for i in b.column(0).to_pylist()):
                yield pa.RecordBatch.from_arrays([pa.array([p]), pa.array([polynomial_mod((cells % p).astype(np.int64), p).tolist()])],
                                                 names=["p", "rest"])

    parts = min(len(wanted), max(1, spark.sparkContext.defaultParallelism))
    rows = spark.range(0, len(wanted), 1, parts).mapInArrow(run, "p long, rest array<long>").collect()
    return remainders(sorted((r.p, r.rest) for r in rows))


# -- roots ------------------------------------------------------------------------
def _trim(f: list[int]) -> list[int]:
    while f and not f[-1]:
        f = f[:-1]
    g = math.gcd(*f) if f else 1
    return [c // g for c in f] if g > 1 else f


def _common(f: list[int], g: list[int]) -> list[int]:
    """Greatest common divisor of integer polynomials, primitive."""
    while g:
        r = f
        while len(r) >= len(g):
            lead, shift = r[-1], len(r) - len(g)
            r = [c * g[-1] for c in r]
            for i, c in enumerate(g):
                r[i + shift] -= c * lead
            r = _trim(r[:-1])
        f, g = g, r
    return [-c for c in f] if f[-1] < 0 else f


def _divided(f: list[int], g: list[int]) -> list[int]:
    """f / g, which leaves nothing, up to a factor that is a number."""
    out, r = [], f
    scale = g[-1] ** (len(f) - len(g) + 1)
    r = [c * scale for c in f]
    for shift in range(len(f) - len(g), -1, -1):
        q = r[shift + len(g) - 1] // g[-1]
        out.append(q)
        for i, c in enumerate(g):
            r[i + shift] -= c * q
    return _trim(out[::-1])


def _coprime_mod(f: list[int], g: list[int], p: int) -> bool:
    f, g = [c % p for c in f], [c % p for c in g]
    while f and not f[-1]:
        f.pop()
    while g and not g[-1]:
        g.pop()
    while g:
        inverse = pow(g[-1], -1, p)
        while len(f) >= len(g):
            q, shift = f[-1] * inverse % p, len(f) - len(g)
            for i, c in enumerate(g):
                f[i + shift] = (f[i + shift] - c * q) % p
            while f and not f[-1]:
                f.pop()
        f, g = g, f
    return len(f) == 1


def square_free(f: list[int]) -> list[tuple[list[int], int]]:
    """Factors without repeated roots, each with the multiplicity of its roots in f."""
    slope = [i * c for i, c in enumerate(f)][1:]
    if len(f) < 3 or any(f[-1] % p and _coprime_mod(f, slope, p) for p in primes(3)):
        return [(f, 1)]
    out, k = [], 0
    shared = _common(_trim(f), _trim(slope))
    rest = _divided(f, shared)                       # every root once
    while len(rest) > 1:
        k += 1
        both = _common(rest, shared) if len(shared) > 1 else [1]
        if len(both) < len(rest):
            out.append((_divided(rest, both), k))
        rest, shared = both, _divided(shared, both) if len(both) > 1 else shared
    return out


def _above(f: list[int], at: int) -> int:
    """Roots of f above a whole number: sign changes of f(t + at), exact as all roots are real."""
    c = list(f)
    for i in range(len(c) - 1):
        for j in range(len(c) - 2, i - 1, -1):
            c[j] += at * c[j + 1]
    signs = [x > 0 for x in c if x]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def _scaled(f: list[int], bits: int) -> list[int]:
    """The polynomial whose roots are 2**bits times those of f."""
    return [c << (bits * (len(f) - 1 - i)) for i, c in enumerate(f)]


def isolate(f: list[int], top: int) -> list[tuple[int, int, int]]:
    """(low, high, bits) for each root of f, all real, simple and in (0, top], from
    the largest down: the root alone is in (low, high] / 2**bits."""
    found, todo = [], [(0, top, 0, f, len(f) - 1, 0)]
    while todo:
        low, high, bits, g, above_low, above_high = todo.pop()
        if above_low == above_high:
            continue
        if above_low - above_high == 1:
            found.append((low, high, bits))
            continue
        if high - low == 1:
            low, high, bits, g = low << 16, high << 16, bits + 16, _scaled(g, 16)
        middle = (low + high) // 2
        above = _above(g, middle)
        todo += [(low, middle, bits, g, above_low, above), (middle, high, bits, g, above, above_high)]
    return found


def refine(f: list[int], root: tuple[int, int, int], bits: int) -> int:
    """A root alone in its interval, times 2**bits and rounded down; the interval
    has at most these bits."""
    low, high, have = root
    low, high = low << (bits - have), high << (bits - have)
    g = _scaled(f, bits)

    def sign(x: int) -> int:
        value = 0
        for c in reversed(g):
            value = value * x + c
        return (value > 0) - (value < 0)

    end = sign(high)
    while end and high - low > 1:
        middle = (low + high) // 2
        s = sign(middle)
        if s in (0, end):
            high, end = middle, s
        else:
            low = middle
    return low if end else high


def largest_roots(f: list[int], count: int, top: int) -> tuple[list[tuple[int, int]], int]:
    """The largest positive roots, all at most ``top``, as (numerator,
    multiplicity) over 2**bits, at least ``count`` of them if there are so many,
    and bits: twice as many as it takes to tell neighbours apart."""
    while len(f) > 1 and not f[0]:
        f = f[1:]
    factors = square_free(f) if len(f) > 1 else []
    held = [(g, r, m) for g, m in factors for r in (isolate(g, top)[:count + 1] if len(factors) == 1 else isolate(g, top))]
    bits = max([BITS, *(r[2] for _, r, _ in held)])
    while True:
        out = sorted(((refine(g, r, bits), m) for g, r, m in held), reverse=True)
        if all(a[0] - b[0] >= 1 << (bits // 2) for a, b in zip(out, out[1:])):
            return out, bits
        bits *= 2


# -- components -------------------------------------------------------------------
def null_vectors(matrix: list[list[int]], root: Decimal, count: int) -> list[np.ndarray]:
    """``count`` orthogonal unit vectors that matrix - root sends next to 0, by
    inverse iteration in the current decimal precision."""
    d = len(matrix)
    a = np.array([[Decimal(c) for c in row] for row in matrix], object)
    a[range(d), range(d)] -= root
    tiny = max(abs(c) for row in matrix for c in row) * Decimal(10) ** -decimal.getcontext().prec
    order = np.arange(d)
    for k in range(d):                                        # triangles, rows swapped
        r = k + int(np.argmax(np.abs(a[k:, k])))
        a[[k, r]], order[[k, r]] = a[[r, k]], order[[r, k]]
        if abs(a[k, k]) < tiny:
            a[k, k] = tiny
        a[k + 1:, k] = a[k + 1:, k] / a[k, k]
        a[k + 1:, k + 1:] = a[k + 1:, k + 1:] - np.outer(a[k + 1:, k], a[k, k + 1:])
    out: list[np.ndarray] = []
    for c in range(count):
        v = np.array([Decimal(pow(3, i + 1 + c * d, 1009) - 504) for i in range(d)], object)
        for _ in range(3):
            v = v[order]
            for k in range(d):
                v[k + 1:] = v[k + 1:] - a[k + 1:, k] * v[k]
            for k in range(d - 1, -1, -1):
                v[k] = v[k] / a[k, k]
                v[:k] = v[:k] - a[:k, k] * v[k]
            for u in out:
                v = v - u * (u @ v)
            v = v / (v @ v).sqrt()
        out.append(v)
    return out


@dataclass(frozen=True)
class Whitening:
    """``n`` distinct vectors of ``d`` entries with ``sums``; eigenvalues of their
    covariance (divisor n), unit eigenvectors as columns, and its trace."""
    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def d(self) -> int:
        return len(self.sums)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exact (of Python's integers if it takes them)."""
        if len(x) and self.n * int(np.abs(x).max()) + max(map(abs, self.sums)) >= 2**62:
            return self.n * x.astype(object) - np.array(self.sums, object)
        return self.n * x - np.array(self.sums, np.int64)

    def apply(self, centred: np.ndarray) -> np.ndarray:
        return (centred.astype(float) / self.n) @ (self.vectors / np.sqrt(self.values))


def components(spark: SparkSession, scatter: list[list[int]], count: int) -> tuple[list[Decimal], list[np.ndarray]]:
    """The largest positive eigenvalues of a symmetric integer matrix without
    negative ones, and their unit eigenvectors, in decimals."""
    shared = math.gcd(*(c for row in scatter for c in row))
    if not shared:
        return [], []
    matrix = [[c // shared for c in row] for row in scatter]
    roots, bits = largest_roots(polynomial(spark, matrix), count, sum(matrix[i][i] for i in range(len(matrix))))
    values, vectors = [], []
    with decimal.localcontext() as context:
        context.prec = (bits + max(c for row in matrix for c in row).bit_length()) * 4 // 13 + 20     # digits of all bits, and some
        for numerator, times in roots:
            if len(values) >= count:
                break
            root = Decimal(numerator) / 2**bits
            values += [root * shared] * times
            vectors += null_vectors(matrix, root, times)
    return values[:count], vectors[:count]


def fit(fitted: DataFrame, count: int = COMPONENTS) -> Whitening | None:
    """From :func:`distinct_vectors`; None if there is none, no component if all
    are alike."""
    length = fitted.groupBy("d").count().orderBy(F.desc("count"), "d").first()
    if length is None:
        return None
    n, sums, products = _exact_sums(fitted, length.d)
    d = length.d
    scatter = [[n * products[i][j] - sums[i] * sums[j] for j in range(d)] for i in range(d)]
    values, vectors = components(fitted.sparkSession, scatter, count)
    return Whitening(n, tuple(sums), np.array([float(v / n**2) for v in values]),
                     np.array([[float(c) for c in v] for v in vectors]).reshape(-1, d).T,
                     float(Decimal(sum(scatter[i][i] for i in range(d))) / n**2))


def identity_error(fitted: DataFrame, model: Whitening) -> float:
    """Largest entry of |covariance of the whitened distinct vectors - identity|."""
    k = len(model.values)

    def run(batches):
        total = np.zeros((k + 1, k + 1))
        for b in batches:
            z = model.apply(model.centred(_unpack(b, model.d)))
            z = np.column_stack([z, np.ones(len(z))])
            total += z.T @ z
        i, j = np.triu_indices(k + 1)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], names=["i", "j", "v"])

    rows = fitted.where(F.col("d") == model.d).select("x").mapInArrow(run, "i int, j int, v double")
    total = np.zeros((k + 1, k + 1))
    for r in rows.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        total[r.i, r.j] = total[r.j, r.i] = r.v
    mean = total[k, :k] / model.n
    return float(np.abs(total[:k, :k] / model.n - np.outer(mean, mean) - np.eye(k)).max(initial=0))


def transform(embeddings: DataFrame, model: Whitening, key: Column | None = None, vector: Column | None = None) -> DataFrame:
    """``vec_id, deviation, whitened``: of every usable vector of the model's
    length the sum of (n x - S)^2 and its components, scaled to unit variance."""
    def run(batches):
        for b in batches:
            for rows, x in usable(b):
                if x.shape[1] != model.d:
                    continue
                y = model.centred(x)
                if y.dtype == object or int(np.abs(y).max())**2 * model.d >= 2**63:
                    squares = [v if v < 2**63 else None for v in (y.astype(object)**2).sum(axis=1)]
                else:
                    squares = (y * y).sum(axis=1)
                z = model.apply(y)
                ends = np.arange(len(z) + 1, dtype=np.int32) * z.shape[1]
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows)), pa.array(squares, pa.int64()),
                                                  pa.ListArray.from_arrays(pa.array(ends), pa.array(z.ravel()))], names=["vec_id", "deviation", "whitened"])

    return embeddings.select((F.col("vec_id") if key is None else key).cast("long").alias("vec_id"),
                             (F.col("embedding") if vector is None else vector).alias("v")).mapInArrow(
        run, "vec_id long, deviation long, whitened array<double>")


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of
    every usable vector and component, fitted on the distinct vectors."""
    spark = embeddings.sparkSession
    fitted = store(distinct_vectors(embeddings, F.col("embedding")), "distinct-vectors")
    model = fit(fitted, components)
    if model is None or not len(model.values):
        return spark.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    share = F.array(*(F.lit(float(v / model.trace)) for v in model.values))
    return (transform(embeddings, model)
            .select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
            .select("vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
                    share[F.col("at")].alias("explained"), F.lit(identity_error(fitted, model)).alias("identity_error")))
