"""V4: calendar completion — every month of the range, empty ones with zeros.

Both sides of the join are bounded by the request, not by the data: the
month table has one row per calendar month of the range, the report at most
one row per month of the range.  The report is the broadcast side (a left
outer join keeps the streamed month table whole).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ..functions.dims import month_code, year_code
from ..plans.spec import DateRange


def month_table(spark: SparkSession, rng: DateRange, keys: Sequence[str] = ("year", "month")) -> DataFrame:
    """(year, month) codes of the range, made by ``sequence`` + ``explode``."""
    first = rng.start.replace(day=1).isoformat()
    last = rng.end.replace(day=1).isoformat()
    months = spark.range(1).select(
        F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"),
                             F.expr("INTERVAL 1 MONTH"))).alias("d"))
    months = months.select(year_code("d").alias("year"), month_code("d").alias("month"))
    return months.select(*keys).distinct() if list(keys) != ["year", "month"] else months


def complete_months(spark: SparkSession, report: DataFrame, rng: DateRange,
                    keys: Sequence[str] = ("year", "month")) -> DataFrame:
    """Left-join the report onto the month table; counts and revenue of an
    empty month become 0, a rate stays NULL (0 of 0 sessions)."""
    keys = list(keys)
    cal = month_table(spark, rng, keys)
    out = cal.join(F.broadcast(report), keys, "left")
    fills = {}
    for f in report.schema.fields:
        if f.name in keys or f.name.startswith("engagement"):
            continue
        zero = F.lit(0).cast(f.dataType) if isinstance(f.dataType, LongType) else F.lit(0.0).cast(f.dataType)
        fills[f.name] = F.coalesce(F.col(f.name), zero)
    return out.withColumns(fills).select(*report.columns)


def complete_report_months(spark: SparkSession, counts: DataFrame, rng: DateRange,
                           reports: Sequence[str]) -> DataFrame:
    """V4 for several reports at once: every (report, year, month) of the
    range, counts of an empty month 0.  The scaffold explodes the report
    names onto each calendar month (no cross join); the counts, at most one
    row per report and month of the range, are the broadcast side."""
    cal = month_table(spark, rng).withColumn(
        "report", F.explode(F.array(*[F.lit(n) for n in reports])))
    keys = ["report", "year", "month"]
    out = cal.join(F.broadcast(counts), keys, "left")
    fills = {f.name: F.coalesce(F.col(f.name), F.lit(0).cast(f.dataType))
             for f in counts.schema.fields if f.name not in keys}
    return out.withColumns(fills).select(*counts.columns)

