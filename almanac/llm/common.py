"""Helpers the operators share: stored tables, hashing, word splitting."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.session import shared_dir

#: Folders written by :func:`store` in this driver process, for :func:`sweep`.
_STORED: list[str] = []
_TABLES: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor shares (``spark.checkpoint.dir``); a temporary
    one only for a local session that names none, an error on a cluster."""
    return shared_dir(spark)


def store(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: the
    plan is cut there, and a lost executor loses none of it."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/almanac-llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    _STORED.append(path)
    return spark.read.schema(df.schema).parquet(path)


def store_by(df: DataFrame, name: str, key: str, codec: str = "zstd") -> DataFrame:
    """:func:`store`, bucketed by ``key``: later groupings by it move only the
    other side."""
    spark = df.sparkSession
    label = f"almanac_llm_{name}_{uuid.uuid4().hex}"
    path = f"{shared_folder(spark)}/almanac-llm/{label}"
    (df.write.option("compression", codec).option("path", path).bucketBy(partitions(spark), key).saveAsTable(label))
    _STORED.append(path)
    _TABLES.append(label)
    return spark.table(label)


def sweep(spark: SparkSession) -> None:
    """Delete the folders :func:`store` wrote.  Call it once the results that
    read them have been written."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while _TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {_TABLES.pop()}")
    while _STORED:
        path = jvm.org.apache.hadoop.fs.Path(_STORED.pop())
        path.getFileSystem(conf).delete(path, True)


def partitions(spark: SparkSession) -> int:
    return max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))


def slices(batch: pa.RecordBatch, limit: int = 24 << 20, column: int = 1) -> Iterator[pa.RecordBatch]:
    """Cuts of a batch with at most about ``limit`` bytes of text each, or one
    row: the memory a task needs does not follow the rows in an Arrow batch."""
    size = pc.fill_null(pc.binary_length(batch.column(column).cast(pa.large_string())), 0).to_numpy()
    group = (np.cumsum(size) - size) // limit
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1), len(size)]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(int(a), int(b - a))


def columns(docs: DataFrame, key: Column | None = None, text: Column | None = None) -> DataFrame:
    """Only ``doc_id`` and ``text``, as long and string."""
    return docs.select((F.col("doc_id") if key is None else key).cast("long").alias("doc_id"),
                       (F.col("text") if text is None else text).cast("string").alias("text"))


# -- words ----------------------------------------------------------------
_CODES = np.arange(256)
LOWER = np.where((_CODES >= 0x41) & (_CODES <= 0x5A), _CODES + 32, _CODES).astype(np.uint8)
#: Bytes that separate words: space and \\t \\n \\v \\f \\r; or all ASCII but digits and letters.
BLANK = (_CODES == 0x20) | ((_CODES >= 9) & (_CODES <= 13))
NO_ALNUM = (_CODES < 0x80) & ~np.isin(_CODES, [*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)])
_MASK = np.array([2 ** (8 * i) - 1 for i in range(8)] + [2**64 - 1], np.uint64)
_LONG = 256


class Words:
    """The words of many texts, A-Z lower-cased: ``hash`` (64 bits each, in
    order) and ``starts`` (where each text's words begin; one more at the
    end), ``begin`` and ``end`` (bytes of ``low``)."""

    def __init__(self, texts: pa.Array, separators: np.ndarray = BLANK):
        arr = texts.cast(pa.large_string()).fill_null("")
        n = len(arr)
        bounds = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset:arr.offset + n + 1] if n else np.zeros(1, np.int64)
        raw = np.frombuffer(arr.buffers()[2] or b"", np.uint8)[bounds[0]:bounds[-1]]
        bounds = bounds - bounds[0]
        low = np.zeros(len(raw) + 8, np.uint8)
        low[:len(raw)] = LOWER[raw]
        word = ~separators[raw]
        before, after = np.zeros_like(word), np.zeros_like(word)
        before[1:], after[:-1] = word[:-1], word[1:]
        cuts = bounds[(bounds > 0) & (bounds < len(raw))]
        before[cuts], after[cuts - 1] = False, False
        self.low = low
        self.begin, self.end = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
        self.starts = np.searchsorted(self.begin, bounds)
        self.hash = self._hash()

    def _hash(self) -> np.ndarray:
        size = self.end - self.begin
        acc = size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        lanes = np.ndarray(max(0, len(self.low) - 7), "<u8", self.low, strides=(1,))
        pick = np.flatnonzero(size <= _LONG)
        lane = 0
        while len(pick):
            left = size[pick] - 8 * lane
            x = lanes[self.begin[pick] + 8 * lane] & _MASK[np.minimum(left, 8)]
            acc[pick] = mix64((acc[pick] ^ x) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(lane + 1))
            pick = pick[left > 8]
            lane += 1
        for i in np.flatnonzero(size > _LONG):
            acc[i] = xxhash.xxh3_64_intdigest(self.low[self.begin[i]:self.end[i]].tobytes())
        return acc


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed bijective scramble of 64-bit integers (splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rolling(h: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of each run of ``k`` consecutive word hashes; empty when
    there are fewer than ``k``."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    acc = np.full(n, k, np.uint64)
    for i in range(k):
        acc = mix64(acc * np.uint64(0x9E3779B97F4A7C15) + h[i:i + n])
    return acc
