"""Sessions with their channel from an event stream, one state per user.

``session_parts`` gives a row per session and month, as ``streaming.sessions``
does, and adds what a session window cannot hold: the session's start and its
first known channel (P4), both carried across months.

1. Each Arrow batch of events is reduced to a row per (user, bucket of the gap's
   width, month) before the shuffle, so a user with a third of all events sends a
   row per batch and bucket.  Events of one bucket are of one session.
2. ``transformWithState`` keeps, per user, the month parts of the sessions that
   may still grow.  Parts no more than the gap apart are one session, in whatever
   order they arrive, so a session takes a row of state a month, however long.
3. A timer per user fires when its earliest session is closed: its last event lies
   more than two gaps before the watermark.  (One gap would do for single events;
   a reduced row passes the watermark by its latest event, and the earliest may
   lie up to a gap before that.)

``open_parts`` reads from the state what has not been given out yet, so the
written table and the open tail together are all sessions of the events so far.
``closed_before`` is the first day that may still change; a binding over the
written table alone refuses reports that reach it.

Events later than the watermark are dropped, except that one in the same batch,
bucket and month as an event in time is kept.  Events without a user or a time
belong to no session.  The readers of the state want the query stopped, or
between two ``availableNow`` runs.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import json
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery
from pyspark.sql.types import TimestampNTZType

from ..functions import dims
from ..operators.metrics import money
from ..operators.sessions import bucket_of, epoch_micros, gap_micros
from ..sources.bindings import CONTRACT, Binding
from .sessions import write_session_rows

GAP = dt.timedelta(minutes=30)
#: A month's part of a session: what the reduction gives and the state holds.
PART = ("ym int, first_us long, last_us long, n_events long, engaged int, amount decimal(38,6), "
        "channel string, channel_us long, channel_id long")
_PART = tuple(c.split()[0] for c in PART.split(", "))
_CLOSED = "session_us long, ym int, first_us long, last_us long, n_events long, engaged int, amount decimal(38,6), channel string"
_ROW = Row("user_id", *(c.split()[0] for c in _CLOSED.split(", ")))
_LAST_ID = 2**63 - 1          # events without an id come last among those of one time
_STATE = "parts"
_PROVIDER = ("spark.sql.streaming.stateStore.providerClass",
             "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def _reduced(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per (user, bucket, month) of each batch; the channel is the first
    known one by time and event id."""
    for batch in batches:
        rows = pa.Table.from_batches([batch]).sort_by([("us", "ascending"), ("event_id", "ascending")])
        out = rows.group_by(["user_id", "bucket", "ym"], use_threads=False).aggregate(
            [("us", "min"), ("us", "max"), ("us", "count"), ("engaged", "max"), ("amount", "sum"),
             ("channel", "first"), ("channel_us", "first"), ("channel_id", "first")])
        cols = [out[c] for c in ("user_id", "ym", "us_min", "us_max", "us_count", "engaged_max")]
        cols += [out["amount_sum"].cast(pa.decimal128(38, 6)), *(out[f"{c}_first"] for c in ("channel", "channel_us", "channel_id"))]
        yield from pa.table(cols, names=["user_id", *_PART]).to_batches()


def _parts_of(events: DataFrame, gap: dt.timedelta) -> DataFrame:
    ev = events.where(F.col("user_id").isNotNull() & F.col("ts").isNotNull())
    known = F.col("channel").isNotNull()
    event_id = F.coalesce("event_id", F.lit(_LAST_ID))
    rows = ev.select(
        "user_id", bucket_of(ev, gap).alias("bucket"), (F.year("ts") * 100 + F.month("ts")).alias("ym"), epoch_micros(ev).alias("us"),
        event_id.alias("event_id"), F.col("engaged").cast("int").alias("engaged"), money("revenue").alias("amount"), "channel",
        F.when(known, epoch_micros(ev)).alias("channel_us"), F.when(known, event_id).alias("channel_id"))
    return rows.mapInArrow(_reduced, f"user_id {ev.schema['user_id'].dataType.simpleString()}, {PART}")


def merged(parts: Iterable[tuple], gap_us: int) -> list[list[tuple]]:
    """Sessions, in time order, each the list of its month parts."""
    sessions: list[list[tuple]] = []
    end = None
    for p in sorted(parts, key=lambda p: (p[1], p[2], p[0])):
        if end is None or p[1] > end + gap_us:
            sessions.append([p])
            end = p[2]
            continue
        own, end = sessions[-1], max(end, p[2])
        at = next((i for i, q in enumerate(own) if q[0] == p[0]), None)
        if at is None:
            own.append(p)
        else:
            own[at] = _joined(own[at], p)
    return sessions


def _joined(a: tuple, b: tuple) -> tuple:
    def both(x, y, f):
        return y if x is None else x if y is None else f(x, y)

    channel = min((p for p in (a, b) if p[6] is not None), key=lambda p: p[7:], default=a)
    return (a[0], min(a[1], b[1]), max(a[2], b[2]), a[3] + b[3], both(a[4], b[4], max), both(a[5], b[5], lambda x, y: x + y), *channel[6:])


class _Sessions(StatefulProcessor):
    """The open sessions of one user, as month parts."""

    def __init__(self, gap_us: int):
        self.gap_us = gap_us

    def init(self, handle) -> None:
        self.handle = handle
        self.parts = handle.getListState(_STATE, PART)

    def handleInputRows(self, key, rows, timerValues):
        new = [tuple(r[c] for c in _PART) for r in rows]
        return self._go_on(key, [*self._stored(), *new], timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        return self._go_on(key, self._stored(), timerValues)

    def _stored(self) -> list[tuple]:
        return [tuple(p) for p in self.parts.get()]

    def _go_on(self, key, parts: list[tuple], timers) -> Iterator[Row]:
        """Give out the sessions closed by the watermark, keep the others."""
        sessions = merged(parts, self.gap_us)
        now = timers.getCurrentWatermarkInMs() * 1000
        ends = [max(p[2] for p in s) + 2 * self.gap_us for s in sessions]
        kept = [p for s, end in zip(sessions, ends) if end >= now for p in s]
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if kept:
            self.parts.put(kept)
            self.handle.registerTimer(min(e for e in ends if e >= now) // 1000 + 1)
        else:
            self.parts.clear()
        for s, end in zip(sessions, ends):
            if end < now:
                channel = min((p for p in s if p[6] is not None), key=lambda p: p[7:], default=s[0])[6]
                for p in s:
                    yield _ROW(*key, s[0][1], *p[:6], channel)

    def close(self) -> None:
        pass


def _named(rows: DataFrame, ntz: bool) -> DataFrame:
    """The columns of ``streaming.sessions.session_rows`` with the session's id
    (its start in microseconds) and channel."""
    def time(c: str) -> Column:
        if not ntz:
            return F.timestamp_micros(c)
        secs = F.make_dt_interval(secs=(F.col(c).cast("decimal(38,0)") / 1_000_000).cast("decimal(18,6)"))
        return F.lit(dt.datetime(1970, 1, 1)).cast("timestamp_ntz") + secs

    out = rows.select(
        "user_id", (F.col("ym") / 100).cast("int").alias("year"), F.pmod("ym", F.lit(100)).alias("month"), "n_events",
        time("first_us").alias("session_start"), time("last_us").alias("session_end"), "engaged",
        F.col("amount").alias("revenue_amount"), F.col("session_us").alias("session_id"), F.col("channel").alias("session_channel"))
    return out.withColumns({"year": dims.code("year", 4), "month": dims.code("month", 2)})


def session_parts(events: DataFrame, gap: dt.timedelta = GAP, watermark: str = "2 hours") -> DataFrame:
    """``user_id, year, month, n_events, session_start, session_end, engaged,
    revenue_amount, session_id, session_channel`` of every closed session of a
    stream of contract columns; ``session_start`` and ``session_end`` are the
    month part's first and last event."""
    if not events.isStreaming:
        raise ValueError("session_parts takes a stream; for a batch use operators.sessions")
    user = events.schema["user_id"].dataType.simpleString()
    parts = _parts_of(events, gap).withColumn("event_time", F.timestamp_micros("last_us")).withWatermark("event_time", watermark)
    closed = parts.groupBy("user_id").transformWithState(
        _Sessions(gap_micros(gap)), f"user_id {user}, {_CLOSED}", "Append", "EventTime")
    return _named(closed, isinstance(events.schema["ts"].dataType, TimestampNTZType))


@contextlib.contextmanager
def state_store(spark: SparkSession):
    """``transformWithState`` keeps its state in RocksDB; a query takes the
    setting when it starts."""
    name, value = _PROVIDER
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def write_session_parts(rows: DataFrame, path: str, checkpoint: str, trigger_available_now: bool = True) -> StreamingQuery:
    """Append closed sessions to a Parquet table partitioned by month."""
    with state_store(rows.sparkSession):
        return write_session_rows(rows, path, checkpoint, trigger_available_now)


def open_parts(spark: SparkSession, checkpoint: str, gap: dt.timedelta = GAP, ntz: bool = True) -> DataFrame:
    """The sessions the state still holds, as rows of :func:`session_parts`;
    ``ntz`` says whether the stream's times are ``timestamp_ntz``."""
    state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", _STATE).load()
    parts = state.select("key.user_id", "list_element.*")
    by_user = Window.partitionBy("user_id").orderBy("first_us", "ym")
    start = F.lag("last_us").over(by_user)
    begins = F.when(start.isNull() | (F.col("first_us") > start + gap_micros(gap)), F.col("first_us"))
    own = parts.withColumn("begins", begins).withColumn("session_us", F.max("begins").over(by_user))
    whole = Window.partitionBy("user_id", "session_us").orderBy("channel_us", "channel_id").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    return _named(own.withColumn("channel", F.first("channel", ignorenulls=True).over(whole)), ntz)


def closed_parts(spark: SparkSession, path: str, checkpoint: str, gap: dt.timedelta = GAP, ntz: bool = True) -> DataFrame:
    """The written table, also while no session has been closed."""
    return spark.read.schema(open_parts(spark, checkpoint, gap, ntz).schema).parquet(path)


def closed_before(spark: SparkSession, checkpoint: str, gap: dt.timedelta = GAP) -> dt.date | None:
    """The first day that sessions may still be added to or change in: all
    sessions of earlier days are in the written table.  None: no batch has
    moved the watermark yet."""
    batch = spark.read.format("state-metadata").load(checkpoint).agg(F.max("maxBatchId")).first()[0]
    if batch is None:
        return None
    lines = [r.value for r in spark.read.text(f"{checkpoint}/offsets/{batch}").collect()]      # a few lines a batch
    mark = next(json.loads(x)["batchWatermarkMs"] for x in lines if x.startswith("{") and "batchWatermarkMs" in x)
    if not mark:
        return None
    state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", _STATE).load()
    first = state.agg(F.min("list_element.first_us")).first()[0]
    until = min(mark * 1000 - gap_micros(gap), _LAST_ID if first is None else first)
    return dt.date(1970, 1, 1) + dt.timedelta(days=until // 86_400_000_000)


def session_parts_binding(spark: SparkSession, path: str, checkpoint: str, with_open: bool = False, gap: dt.timedelta = GAP,
                          ntz: bool = True, name: str = "session_parts") -> Binding:
    """Reports over the table :func:`write_session_parts` fills.

    Every row is one session's part in one month, with the session's channel.  A
    report that reaches days not yet closed is refused; ``with_open`` adds the
    open sessions from the state instead, as they stand.  A range that starts or
    ends inside a month counts a part by its first event.  The platform is not
    kept at this grain."""
    def build(spark_: SparkSession, need: frozenset) -> DataFrame:
        df = closed_parts(spark_, path, checkpoint, gap, ntz)
        if with_open:
            df = df.unionByName(open_parts(spark_, checkpoint, gap, ntz))
        cols = {
            "event_id": F.lit(None).cast("long"), "ts": F.col("session_start"), "user_id": F.col("user_id"),
            "session_id": F.col("session_id"), "platform": F.lit(None).cast("string"), "channel": F.col("session_channel"),
            "engaged": F.col("engaged") == F.lit(1), "revenue": F.col("revenue_amount"),
        }
        return df.select(*[cols[c].alias(c) for c in CONTRACT if c in need])

    closed = None if with_open else closed_before(spark, checkpoint, gap) or dt.date.min
    return Binding(name=name, build=build, session_ids=True, rows_are_sessions=True, session_gap=gap, closed_before=closed)
