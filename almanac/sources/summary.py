"""Daily summaries: reports over any range without reading an event.

Made from stored sessions (``sources.session_store``) for a fixed set of report
filters, by report and day:

* ``<path>/counts``: sessions and engaged sessions as (day, previous day)
  pairs, and revenue.  A session counts on every day it has an event that passes
  the filter; with it goes the latest earlier such day.  The distinct sessions
  of days s to e are those rows whose previous day is none or before s, so any
  range, month or part of one is a sum.
* ``<path>/users``: the day's users as bitmaps (exact; 4 KB for 32,768
  consecutive ids, so meant for dense ids) and as a sketch (a few KB whatever
  the ids).  Both merge over days: users of a range are no sum of daily users.

A refresh overwrites the partitions of the days that were rewritten in the
store, and of the days behind them that their sessions reach.  A report takes
whole days from the summary; days of its range that the store has and the
summary has not yet are computed from their stored events.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import filters, metrics
from ..plans.report import _codes, _resolver, finish_report
from ..plans.spec import DIMENSIONS, DateRange, ReportSpec, filter_fields
from .session_store import DAY, _micros, _overwrite, events_path, stored_days

#: Base-2 logarithm of the registers of a sketch.
REGISTERS = 12
COUNTS = "report string, event_date date, kind string, previous date, n long, amount decimal(38,6)"


def sketch_error(lg_k: int = REGISTERS) -> float:
    """Relative error that a sketch's estimate stays within in 997 of 1000 cases."""
    return 3 * 1.04 / math.sqrt(2**lg_k)


def _tagged(ev: DataFrame, specs: Sequence[ReportSpec]) -> DataFrame:
    """Stored events, once for each report whose filter they pass."""
    tags = []
    for sp in specs:
        if filter_fields(sp.filter) & set(DIMENSIONS):
            raise ValueError(f"report {sp.name!r}: a summary's filter has no dates; they come with the request")
        p = filters.compile_filter(sp.filter, _resolver())
        tags.append(F.lit(sp.name) if p is None else F.when(p, F.lit(sp.name)))
    return (ev.withColumn("report", F.explode(F.array(*tags))).where(F.col("report").isNotNull())
            .select("report", "event_date", "user_id", "session_id", F.col("engaged").cast("int").alias("engaged"),
                    metrics.money("revenue").alias("amount")))


def _day_tables(spark: SparkSession, store: str, specs: Sequence[ReportSpec], days: Sequence[dt.date]) -> tuple[DataFrame, DataFrame]:
    """Counts and users of these days."""
    ev = spark.read.parquet(events_path(store))
    mine = F.col("event_date").isin(*days)
    own = _tagged(ev.where(mine), specs)
    level = own.groupBy("report", "event_date", "user_id", "session_id").agg(F.max("engaged").alias("engaged"), F.sum("amount").alias("amount"))
    # Sessions that began before a day of these: their earlier days, as far back as the first of them began.
    started = (F.unix_date("event_date").cast("long") * 86_400_000_000)
    over = ev.where(mine & (F.col("session_id") < started)).select("user_id", "session_id").distinct()
    low = over.agg(F.min("session_id")).first()[0]
    if low is not None:
        first = dt.date(1970, 1, 1) + low // 86_400_000_000 * DAY
        back = ev.where(F.col("event_date").between(F.lit(first), F.lit(max(days))) & ~mine).join(over, ["user_id", "session_id"], "left_semi")
        earlier = _tagged(back, specs).groupBy("report", "event_date", "user_id", "session_id").agg(F.max("engaged").alias("engaged"))
        level = level.unionByName(earlier, allowMissingColumns=True)
    by = Window.partitionBy("report", "user_id", "session_id").orderBy("event_date")
    sess = (level.where(F.col("session_id").isNotNull())
            .withColumns({"previous": F.lag("event_date").over(by),
                          "engaged_before": F.max(F.when(F.col("engaged") == 1, F.col("event_date"))).over(by.rowsBetween(Window.unboundedPreceding, -1))})
            .where(mine))
    none = F.lit(None)

    def counted(rows: DataFrame, kind: str, previous: str) -> DataFrame:
        return (rows.groupBy("report", "event_date", F.col(previous).alias("previous")).agg(F.count(F.lit(1)).alias("n"))
                .select("report", "event_date", F.lit(kind).alias("kind"), "previous", "n", none.cast("decimal(38,6)").alias("amount")))

    money = (own.groupBy("report", "event_date").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").cast("decimal(38,6)").alias("amount"))
             .select("report", "event_date", F.lit("revenue").alias("kind"), none.cast("date").alias("previous"), "n", "amount"))
    counts = counted(sess, "sessions", "previous").unionByName(counted(sess.where("engaged = 1"), "engaged", "engaged_before")).unionByName(money)
    users = own.where(F.col("user_id").isNotNull()).select("report", "event_date", F.col("user_id").cast("long").alias("user_id")).distinct()
    bitmaps = (users.groupBy("report", "event_date", F.bitmap_bucket_number("user_id").alias("bucket"))
               .agg(F.bitmap_construct_agg(F.bitmap_bit_position("user_id")).alias("users")))
    sketches = users.groupBy("report", "event_date").agg(F.hll_sketch_agg("user_id", REGISTERS).alias("users"))
    return counts, bitmaps.unionByName(sketches, allowMissingColumns=True)


def _write(spark: SparkSession, store: str, path: str, specs: Sequence[ReportSpec], days: Sequence[dt.date]) -> None:
    counts, users = _day_tables(spark, store, specs, days)
    seen = spark.createDataFrame([(d, sp.name) for d in days for sp in specs], "event_date date, report string").withColumn("kind", F.lit("day"))
    # Of a day without users nothing would be overwritten: every day has a row of its own in both tables.
    _overwrite(users.unionByName(seen.drop("kind"), allowMissingColumns=True), f"{path}/users")
    _overwrite(counts.unionByName(seen, allowMissingColumns=True), f"{path}/counts")


def make_summary(spark: SparkSession, store: str, path: str, specs: Sequence[ReportSpec], days: Iterable[dt.date] | None = None) -> str:
    """Summarise all days of the store, or these."""
    _write(spark, store, path, specs, sorted(stored_days(spark, store) if days is None else days))
    return path


def refresh_summary(spark: SparkSession, store: str, path: str, specs: Sequence[ReportSpec], days: Iterable[dt.date]) -> list[dt.date]:
    """Summarise again the days that ``refresh_store`` returned, and those behind
    them with sessions that reach back to them.  Returns all of them."""
    wanted, known = set(days), stored_days(spark, store)
    reach = {d + DAY: d for d in wanted}                     # by day, the last rewritten one before it
    while reach := {z: d for z, d in reach.items() if z in known and z not in wanted}:
        borders = spark.createDataFrame([(z, _micros(d + DAY)) for z, d in reach.items()], "event_date date, border long")
        ev = spark.read.parquet(events_path(store)).where(F.col("event_date").isin(*reach))
        found = ev.join(F.broadcast(borders), "event_date").where("session_id < border").select("event_date").distinct().collect()
        wanted |= {r.event_date for r in found}
        reach = {r.event_date + DAY: reach[r.event_date] for r in found}
    if wanted:
        _write(spark, store, path, specs, sorted(wanted))
    return sorted(wanted)


def _read(spark: SparkSession, store: str, path: str, spec: ReportSpec, rng: DateRange) -> tuple[DataFrame, DataFrame]:
    """Counts and users of the report's days; days the summary lacks from the store."""
    inside = F.col("event_date").between(F.lit(rng.start), F.lit(rng.end)) & (F.col("report") == F.lit(spec.name))
    counts, users = spark.read.parquet(f"{path}/counts").where(inside), spark.read.parquet(f"{path}/users").where(inside)
    have = {r.event_date for r in counts.where("kind = 'day'").select("event_date").collect()}
    if lacking := sorted(d for d in stored_days(spark, store) - have if rng.start <= d <= rng.end):
        more, more_users = _day_tables(spark, store, [spec], lacking)
        counts, users = counts.unionByName(more, allowMissingColumns=True), users.unionByName(more_users, allowMissingColumns=True)
    return counts, users.where(F.col("users").isNotNull())


def _users(users: DataFrame, keys: list[str], approx: bool) -> DataFrame:
    if approx:
        return (users.where(F.col("bucket").isNull()).groupBy(*keys)
                .agg(F.hll_sketch_estimate(F.hll_union_agg("users")).alias("active_users")))
    merged = users.where(F.col("bucket").isNotNull()).groupBy(*keys, "bucket").agg(F.bitmap_or_agg("users").alias("users"))
    return merged.groupBy(*keys).agg(F.sum(F.bitmap_count("users")).alias("active_users"))


def users_between(spark: SparkSession, store: str, path: str, spec: ReportSpec, approx: bool = False) -> DataFrame:
    """``report, active_users``: distinct users of the spec's whole range, exact
    or, with ``approx``, within :func:`sketch_error`."""
    _, users = _read(spark, store, path, spec, spec.date_range)
    found = _users(users, ["report"], approx)
    one = spark.createDataFrame([(spec.name,)], "report string")
    return one.join(found, "report", "left").select("report", F.coalesce("active_users", F.lit(0)).cast("long").alias("active_users"))


def summary_counts(spark: SparkSession, store: str, path: str, spec: ReportSpec, approx: bool = False) -> DataFrame:
    """The counts of ``plans.report.monthly_counts``, from the summary."""
    rng = spec.date_range
    keys = [k for k in ("year", "month") if k in spec.dimensions]
    with_keys = {"year": F.year("event_date"), "month": F.month("event_date")}
    counts, users = _read(spark, store, path, spec, rng)
    counts = counts.where("kind <> 'day'").withColumns(with_keys)
    since: Column = F.greatest(F.lit(rng.start), F.trunc("event_date", "month"))
    new = F.col("previous").isNull() | (F.col("previous") < since)

    def total(kind: str) -> Column:
        return F.coalesce(F.sum(F.when((F.col("kind") == kind) & new, F.col("n"))), F.lit(0)).cast("long")

    out = counts.groupBy(*keys).agg(total("sessions").alias("sessions"), total("engaged").alias("engaged_sessions"),
                                    F.sum("amount").alias("revenue_amount"))
    if "activeUsers" in spec.metrics:
        found = _users(users.withColumns(with_keys), keys, approx)
        out = out.join(found, keys, "left").withColumn("active_users", F.coalesce("active_users", F.lit(0)))
    return _codes(out)


def report_from_summary(spark: SparkSession, store: str, path: str, spec: ReportSpec, approx: bool = False,
                        rate_as_percent: bool = False, month_names: str = "null") -> DataFrame:
    """R8 from the summary: what ``run_report`` gives over the stored sessions."""
    return finish_report(spark, summary_counts(spark, store, path, spec, approx), spec, rate_as_percent, month_names)
