"""Typed rows — a report's fixed schema, and loading rows into it.

Dimensions are text (the year stays a string), counts ``long``, money and
rates ``double``.  ``conform`` casts each column to its declared type; with
ANSI mode on, a value that does not parse raises (like ``int('x')``), and
``lenient=True`` gives NULL instead (``try_cast``).  An empty input keeps the
schema.  ``load_rows`` keeps what cannot be read: one pass writes the good rows
and, with the reason, the others, and counts both.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType


def _schema(*cols: tuple[str, type]) -> StructType:
    return StructType([StructField(n, t(), True) for n, t in cols])


REPORT_SCHEMAS = {
    "web": _schema(("month", StringType), ("year", StringType), ("sessions", LongType), ("revenue", DoubleType)),
    "app": _schema(("month", StringType), ("year", StringType), ("active_users", LongType),
                   ("sessions", LongType), ("revenue", DoubleType)),
    "organic": _schema(("month", StringType), ("year", StringType), ("sessions", LongType),
                       ("active_users", LongType), ("engagement_pct", DoubleType), ("revenue", DoubleType)),
    "app_year": _schema(("month", StringType), ("year", StringType), ("app_users_total", LongType),
                        ("app_sessions_total", LongType), ("app_revenue_total", DoubleType)),
}


def conform(df: DataFrame, schema: StructType, lenient: bool = False) -> DataFrame:
    """Select the schema's columns in its order, each cast to its type."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing for the schema: {missing}")
    cols = []
    for f in schema.fields:
        c = F.col(f.name)
        cols.append((c.try_cast(f.dataType) if lenient else c.cast(f.dataType)).alias(f.name))
    return df.select(*cols)


@dataclass(frozen=True)
class LoadedRows:
    """Rows of the schema; the rows as they came with ``reason``; and how many."""
    good: DataFrame
    rejects: DataFrame
    n_good: int
    n_rejected: int


def load_rows(df: DataFrame, schema: StructType, path: str, amounts: Sequence[str] = (), mode: str = "errorifexists") -> LoadedRows:
    """Read every row as ``schema`` and store it under ``path``, good rows apart
    from rejects.  A row is rejected if a value that is there does not parse, or
    is, in a column of ``amounts``, no number that a sum can take (NaN, infinite
    or beyond ``decimal(28,6)``); ``reason`` names every such column.  The input is
    read once, and good and rejected rows together are the rows read."""
    from ..operators.metrics import money

    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing for the schema: {missing}")
    reasons, typed = [], []
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        read = c.try_cast(f.dataType)
        text = c.cast("string")
        reasons.append(F.when(c.isNotNull() & read.isNull(), F.concat(F.lit(f"{f.name}: "), text, F.lit(f" is no {f.dataType.simpleString()}"))))
        if f.name in amounts:
            reasons.append(F.when(read.isNotNull() & money(read).isNull(), F.concat(F.lit(f"{f.name}: "), text, F.lit(" is no amount"))))
        typed.append(read.alias(f.name))
    raw = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    rows = df.select(F.struct(*typed).alias("row"), raw.alias("raw"), F.array_join(F.array_compact(F.array(*reasons)), "; ").alias("reason"))
    bad = F.col("reason") != F.lit("")
    rows = rows.select(F.when(~bad, F.col("row")).alias("row"), F.when(bad, F.col("raw")).alias("raw"), "reason", bad.alias("rejected"))
    seen = Observation()
    (rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col("rejected"), F.lit(1))).alias("rejected"))
     .write.mode(mode).partitionBy("rejected").parquet(path))
    n, n_bad = seen.get.get("rows", 0), seen.get.get("rejected", 0)
    stored = df.sparkSession.read.schema(rows.schema).parquet(path)
    return LoadedRows(stored.where(~F.col("rejected")).select("row.*"), stored.where("rejected").select("raw.*", "reason"), n - n_bad, n_bad)
