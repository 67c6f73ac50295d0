"""A table of sessionized events that is refreshed by day.

``<path>/events`` holds every event with its session (partitioned by
``event_date``, columns of ``sources.stored``).  ``<path>/open`` holds, for each
day, the sessions that may go on after midnight: user, last event, session
start, and the first channel known so far.  A refresh of some days reads

* those days of the source and the sessions open before them, and
* the next day, only if the sessions open at its start are no longer the same.

It writes the days read, by dynamic partition overwrite, so a late or corrected
day costs that day and, where sessions cross midnight differently than before,
the days after it until they agree again.  A session's channel is its first one
known, which may lie behind midnight: earlier days of such sessions are brought
up to date where their events still carry another channel.

A refresh that was stopped is run again with the same days: the events of a day
depend on the source and the open sessions alone, and the open sessions are
replaced last.  Only the list of days is collected.

Defined results: events without a user are stored without a session; a day whose
events are all gone from the source loses its partition; events without a time
belong to no day and are stored when the table is made; the gap is a day at most.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable
from functools import reduce
from itertools import count

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import filters
from ..operators.sessions import _order_key, bucket_of, epoch_micros, gap_micros, sessionize_groups, with_bucket
from ..plans.spec import DateRange
from ..session import remove
from .bindings import CONTRACT, Binding
from .stored import STORED_COLUMNS, sessionized_binding

DAY = dt.timedelta(days=1)
_OPEN = ("user_id", "last_ts", "session_start", "channel", "event_date")


def events_path(path: str) -> str:
    return f"{path}/events"


def _open_path(path: str) -> str:
    return f"{path}/open"


def store_binding(path: str, name: str = "session_store") -> Binding:
    """Reports over the stored events."""
    return sessionized_binding(events_path(path), name)


def _micros(day: dt.date) -> int:
    return (day - dt.date(1970, 1, 1)).days * 86_400_000_000


def _overwrite(df: DataFrame, path: str) -> None:
    """Replace the partitions ``df`` has rows for, and no others."""
    (df.hint("rebalance", "event_date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("event_date").parquet(path))


def _source(spark: SparkSession, binding: Binding, runs: list[tuple[dt.date, dt.date]] | None) -> DataFrame:
    """All events of the binding, or those of these runs of days."""
    ev = binding.frame(spark, CONTRACT).drop("session_id")
    if runs is not None:
        inside = []
        for first, last in runs:
            p = filters.date_range_predicate("ts", DateRange(first, last), ev.schema["ts"].dataType)
            if "_part_date" in ev.columns:       # the table's day may be another zone's
                p = p & F.col("_part_date").between(F.lit(first - DAY), F.lit(last + DAY))
            inside.append(p)
        ev = ev.where(reduce(lambda a, b: a | b, inside))
    return ev.select(*[c for c in ev.columns if not c.startswith("_")]).withColumn("event_date", F.to_date("ts"))


def _session_rows(ev: DataFrame, carry: DataFrame | None, gap: dt.timedelta) -> DataFrame:
    """Rows per (user, bucket, day, channel) with ``session_start`` and the
    session's channel, going on from the open sessions ``carry``.  ``ev`` and
    ``carry`` name a ``block``: days in a row whose sessions are made together.
    ``user_id`` becomes (user_id, block), the key of the windows."""
    g = with_bucket(ev.where(F.col("user_id").isNotNull() & F.col("ts").isNotNull()), gap)
    g = (g.withColumn("order_key", _order_key(g, gap)).groupBy("user_id", "block", "bucket", "event_date", "channel")
         .agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.min("order_key").alias("order_key")))
    if carry is not None:
        g = g.unionByName(carry.select(
            "user_id", "block", bucket_of(carry, gap, "last_ts").alias("bucket"), "channel", F.col("last_ts").alias("first_ts"), "last_ts",
            F.lit(-1).cast("decimal(38,0)").alias("order_key"), F.col("session_start").alias("carried")), allowMissingColumns=True)
    else:
        g = g.withColumn("carried", F.lit(None).cast("long"))
    rows = sessionize_groups(g.withColumn("user_id", F.struct("user_id", "block")).drop("block"), gap, with_channel=True)
    start = F.coalesce("carried", epoch_micros(rows, "first_ts"))       # a carried row comes first and began earlier
    return rows.withColumn("session_start", F.min(start).over(Window.partitionBy("user_id", "session_id")))


def _with_sessions(ev: DataFrame, rows: DataFrame, gap: dt.timedelta) -> DataFrame:
    """Events with their session, by an equi-join on (user, bucket); those that
    belong to none stay out of it.  No bucket has days of two blocks: between
    them lies a day, and a bucket is no longer."""
    some = F.col("user_id").isNotNull() & F.col("ts").isNotNull()
    m = rows.where(F.col("event_date").isNotNull()).select(F.col("user_id.user_id"), "bucket", "session_start", "session_channel").distinct()
    out = with_bucket(ev.where(some), gap).join(m, ["user_id", "bucket"]).drop("bucket")
    out = out.unionByName(ev.where(~some), allowMissingColumns=True)
    return out.withColumnsRenamed({"session_start": "session_id", "channel": "event_channel"}).select(*STORED_COLUMNS)


def _open_sessions(rows: DataFrame, gap: dt.timedelta) -> DataFrame:
    """By day, the sessions with an event within the gap of its end (one a user
    at most), their last event so far and first channel so far."""
    by = Window.partitionBy("user_id", "session_id").orderBy("bucket", "order_key").rowsBetween(Window.unboundedPreceding, 0)
    out = (rows.withColumn("so_far", F.first("channel", ignorenulls=True).over(by)).where(F.col("event_date").isNotNull())
           .groupBy("user_id", "session_id", "session_start", "event_date")
           .agg(F.max("last_ts").alias("last_ts"), F.max_by("so_far", F.struct("bucket", "order_key")).alias("channel")))
    midnight = (F.unix_date("event_date") + 1).cast("long") * 86_400_000_000
    out = out.where(epoch_micros(out, "last_ts") >= midnight - gap_micros(gap))
    return out.withColumn("user_id", F.col("user_id.user_id")).select(*_OPEN)


def _days_seen(df: DataFrame) -> DataFrame:
    """A row without a user for each day: the day has been stored."""
    return df.where(F.col("event_date").isNotNull()).select("event_date").distinct()


def make_store(spark: SparkSession, binding: Binding, path: str) -> str:
    """Store all events of ``binding`` and the sessions open after each day."""
    gap = _checked(binding)
    ev = _source(spark, binding, None).withColumn("block", F.lit(None).cast("date"))
    rows = _session_rows(ev, None, gap)
    (_with_sessions(ev, rows, gap).hint("rebalance", "event_date").write.mode("errorifexists").partitionBy("event_date")
     .parquet(events_path(path)))
    opened = _open_sessions(rows, gap).unionByName(_days_seen(ev), allowMissingColumns=True)
    opened.hint("rebalance", "event_date").write.mode("errorifexists").partitionBy("event_date").parquet(_open_path(path))
    return path


def _checked(binding: Binding) -> dt.timedelta:
    if binding.session_gap > DAY:
        raise ValueError("a store by day takes session gaps of a day at most")
    return binding.session_gap


def stored_days(spark: SparkSession, path: str) -> set[dt.date]:
    """The days the store has seen (with events or without)."""
    rows = spark.read.parquet(_open_path(path)).where(F.col("user_id").isNull()).select("event_date").distinct().collect()
    return {r.event_date for r in rows}


def _runs(days: Iterable[dt.date]) -> list[tuple[dt.date, dt.date]]:
    """Days in a row, as (first, last)."""
    out: list[tuple[dt.date, dt.date]] = []
    for d in sorted(days):
        if out and out[-1][1] + DAY == d:
            out[-1] = (out[-1][0], d)
        else:
            out.append((d, d))
    return out


class _States:
    """Open sessions by day, as a refresh sees them: its own, staged, where it
    has been, else the store's."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.folder = spark, _open_path(path), {}
        self.schema = spark.read.parquet(self.path).schema

    def of(self, days: Iterable[dt.date], staged: bool = True) -> DataFrame:
        by: dict[str, list[dt.date]] = {}
        for d in days:
            by.setdefault(self.folder.get(d, self.path) if staged else self.path, []).append(d)
        parts = [self.spark.read.schema(self.schema).parquet(f).where(F.col("event_date").isin(*own)) for f, own in by.items()]
        return reduce(DataFrame.unionByName, parts).select(*_OPEN)


def refresh_store(spark: SparkSession, binding: Binding, path: str, days: Iterable[dt.date | str]) -> list[dt.date]:
    """Bring the days, new, late or corrected in the source, up to date.
    Returns the days whose events were rewritten.

    All days go in one pass; a further pass takes the days behind those whose
    open sessions have changed, as long as there are any."""
    gap = _checked(binding)
    todo = {dt.date.fromisoformat(d) if isinstance(d, str) else d for d in days}
    if not todo:
        return []
    known, done, states = stored_days(spark, path), set(), _States(spark, path)
    stage = f"{path}/_next/{uuid.uuid4().hex}"
    for nth in count():
        runs = _runs(todo)
        blocks = spark.createDataFrame([(first + i * DAY, first) for first, last in runs for i in range((last - first).days + 1)],
                                       "event_date date, block date")
        ev = _source(spark, binding, runs).join(F.broadcast(blocks), "event_date")              # a row a day
        carry = states.of([first - DAY for first, _ in runs]).where("user_id IS NOT NULL").withColumn("block", F.date_add("event_date", 1))
        rows = _session_rows(ev, carry, gap)
        folder = f"{stage}/{nth}"
        (_open_sessions(rows, gap).unionByName(blocks.select("event_date"), allowMissingColumns=True)
         .write.partitionBy("event_date").parquet(folder))
        _overwrite(_with_sessions(ev, rows, gap), events_path(path))
        if emptied := todo & known:
            for d in emptied - {r.event_date for r in _days_seen(ev).collect()}:                 # at most the days of this pass
                remove(spark, f"{events_path(path)}/event_date={d}")
        ends = [last for _, last in runs if last + DAY in known | done]
        before = states.of(ends).where("user_id IS NOT NULL") if ends else None
        states.folder.update(dict.fromkeys(todo, folder))
        done |= todo
        todo = set()
        if ends:
            after = states.of(ends).where("user_id IS NOT NULL")
            moved = before.exceptAll(after).unionByName(after.exceptAll(before)).select("event_date").distinct()
            todo = {r.event_date + DAY for r in moved.collect()}
        if not todo:
            break
    settled = _settle_channels(spark, path, _runs(done), states, known | done)
    _overwrite(states.of(done), _open_path(path))
    remove(spark, stage)
    return sorted(done | settled)


def _settle_channels(spark: SparkSession, path: str, runs: list[tuple[dt.date, dt.date]], states: _States, known: set[dt.date]) -> set[dt.date]:
    """Sessions without a channel at a border of the runs of days get the one
    known behind it, in all days of theirs that are stored with another.  Of
    several borders the last one knows best."""
    def events(days: Iterable[dt.date]) -> DataFrame:
        return spark.read.parquet(events_path(path)).where(F.col("event_date").isin(*days))

    def waiting(days: list[dt.date]) -> DataFrame:
        return states.of(days).where("user_id IS NOT NULL AND channel IS NULL").select(
            "user_id", F.col("session_start").alias("session_id"), F.date_add("event_date", 1).alias("border"))

    behind = [last + DAY for _, last in runs if last + DAY in known]
    next_day = events(behind).select("user_id", "session_id", "session_channel", F.col("event_date").alias("border")).distinct()
    after = waiting([last for _, last in runs]).join(next_day, ["user_id", "session_id", "border"], "left")
    inside = [first + i * DAY for first, last in runs for i in range((last - first).days + 1)]
    midnight = F.unix_date("event_date").cast("long") * 86_400_000_000
    own = (events(inside).where(F.col("session_id") < midnight).groupBy("user_id", "session_id")
           .agg(F.max("session_channel").alias("own")))                                          # a session has one channel inside a run
    later = after.groupBy("user_id", "session_id").agg(F.max_by("session_channel", "border").alias("later"))
    before = (waiting([first - DAY for first, _ in runs]).join(own, ["user_id", "session_id"], "left").join(later, ["user_id", "session_id"], "left")
              .select("user_id", "session_id", "border", F.coalesce("own", "later").alias("session_channel")))
    stage = f"{path}/_next/{uuid.uuid4().hex}"
    (after.unionByName(before).groupBy("user_id", "session_id").agg(F.max_by("session_channel", "border").alias("settled"))
     .write.parquet(stage))
    fixes = spark.read.parquet(stage).withColumn("found", F.lit(True))
    low, changed = fixes.agg(F.min("session_id")).first()[0], set()
    if low is not None:
        start = dt.date(1970, 1, 1) + low // 86_400_000_000 * DAY
        span = spark.read.parquet(events_path(path)).where(F.col("event_date").between(F.lit(start), F.lit(runs[-1][1])))
        both = span.join(fixes, ["user_id", "session_id"], "left")
        wrong = both.where(F.col("found") & ~F.col("session_channel").eqNullSafe(F.col("settled")))
        changed = {r.event_date for r in wrong.select("event_date").distinct().collect()}        # days of sessions over midnight
        if changed:
            fixed = both.where(F.col("event_date").isin(*changed)).withColumn(
                "session_channel", F.when(F.col("found"), F.col("settled")).otherwise(F.col("session_channel")))
            _overwrite(fixed.select(*STORED_COLUMNS), events_path(path))
    remove(spark, stage)
    return changed
