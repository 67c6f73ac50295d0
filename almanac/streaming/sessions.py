"""Structured Streaming form of X1/X2: session rows from an event stream.

``session_rows`` works on a streaming (or batch) DataFrame of contract
columns.  A stream is grouped by user and calendar month with Spark's native
``session_window`` (gap semantics equal to X1: a gap of exactly ``gap``
stays in the session), so each output row is one session's part inside one
month — the grain the monthly reports count ("a session with events in two
months counts in both").  Per row: engaged flag, revenue, event
count, first and last timestamp.

State is bounded by the watermark: a session is emitted (append mode) once
the watermark passes its end, then dropped from state.  The checkpoint goes
to the shared folder named by ``spark.checkpoint.dir``.

The session-scope channel is not computed here: a session that began in an
earlier month would need that month's first event.  Reports that filter on
the channel use the batch session map.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import dims
from ..operators.metrics import money
from ..operators.sessions import epoch_micros, sessionize_groups, with_bucket
from ..sources.bindings import CONTRACT, Binding


def _interval(gap: dt.timedelta) -> str:
    return f"{gap // dt.timedelta(microseconds=1)} microseconds"


def session_rows(events: DataFrame, gap: dt.timedelta = dt.timedelta(minutes=30),
                 watermark: str | None = "2 hours") -> DataFrame:
    """(user_id, year, month, n_events, session_start, session_end, engaged,
    revenue_amount) per session part in a month.

    A stream goes through ``session_window`` with a watermark (state per user
    bounded by it).  A batch frame goes through the bucket sessionizer of
    ``operators.sessions`` instead — same rows, but no task ever holds all
    of one user's events (``session_window`` on a batch sorts each
    user-month in one task).
    """
    ev = events.where(F.col("user_id").isNotNull() & F.col("ts").isNotNull())
    aggs = [F.min("ts").alias("session_start"), F.max("ts").alias("session_end"),
            F.max(F.col("engaged").cast("int")).alias("engaged")]
    if not events.isStreaming:
        g = (with_bucket(ev, gap)
             .withColumns({"year": F.year("ts"), "month": F.month("ts"), "revenue_amount": money("revenue")})
             .groupBy("user_id", "bucket", "year", "month")
             .agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
                  F.count(F.lit(1)).alias("n_events"),
                  F.max(F.col("engaged").cast("int")).alias("engaged"),
                  F.sum("revenue_amount").alias("revenue_amount")))
        rows = sessionize_groups(g, gap)
        out = rows.groupBy("user_id", "session_id", "year", "month").agg(
            F.sum("n_events").alias("n_events"), F.min("first_ts").alias("session_start"),
            F.max("last_ts").alias("session_end"), F.max("engaged").alias("engaged"),
            F.sum("revenue_amount").alias("revenue_amount")).drop("session_id")
        return out.withColumns({"year": dims.code("year", 4), "month": dims.code("month", 2)})
    # Watermarks and session windows need an instant; a timestamp_ntz wall
    # clock is read as UTC (zone-free, so gaps stay exact).
    ev = ev.withColumns({"event_time": F.timestamp_micros(epoch_micros(ev)),
                         "year": F.year("ts"), "month": F.month("ts")})
    if watermark:
        ev = ev.withWatermark("event_time", watermark)
    g = ev.groupBy("user_id", "year", "month", F.session_window("event_time", _interval(gap)).alias("s"))
    out = g.agg(
        F.count(F.lit(1)).alias("n_events"),
        *aggs,
        F.sum(money("revenue")).alias("revenue_amount"),
    ).drop("s")
    return out.withColumns({"year": dims.code("year", 4), "month": dims.code("month", 2)})


def read_event_stream(spark: SparkSession, folder: str, schema, file_glob: str | None = None,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream the Parquet files of ``folder`` (optionally only those matching
    ``file_glob``) with a fixed schema — streaming file sources need it up
    front; take it from a batch read of the same table."""
    r = spark.readStream.schema(schema)
    if file_glob:
        r = r.option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(folder)


def checkpoint_location(spark: SparkSession, name: str) -> str:
    """A fresh folder for a stream's state under ``spark.checkpoint.dir``."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a shared folder for stream checkpoints")
    return os.path.join(base, "streams", f"{name}-{uuid.uuid4().hex}")


def write_session_rows(rows: DataFrame, path: str, checkpoint: str,
                       trigger_available_now: bool = True) -> StreamingQuery:
    """Append closed session rows to a Parquet table partitioned by month."""
    w = (rows.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint).partitionBy("year", "month"))
    w = w.trigger(availableNow=True) if trigger_available_now else w.trigger(processingTime="1 minute")
    return w.start(path)


def session_rows_binding(path: str, name: str = "session_rows") -> Binding:
    """Reports over the table :func:`write_session_rows` fills.

    Each row is one session's part in one month, so the binding declares
    ``rows_are_sessions`` and monthly sessions, users, engagement and revenue
    come out exactly, by month.  The row's time is the part's first event, so
    a range that starts or ends inside a month counts a session part by that
    time.  Platform and channel are not kept at this grain.
    """

    def build(spark: SparkSession, need: frozenset) -> DataFrame:
        df = spark.read.parquet(path)
        cols = {
            "event_id": F.lit(None).cast("long"),
            "ts": F.col("session_start"),
            "user_id": F.col("user_id"),
            "session_id": epoch_micros(df, "session_start"),
            "platform": F.lit(None).cast("string"),
            "channel": F.lit(None).cast("string"),
            "engaged": F.col("engaged") == F.lit(1),
            "revenue": F.col("revenue_amount"),
        }
        return df.select(*[cols[c].alias(c) for c in CONTRACT if c in need])

    return Binding(name=name, build=build, session_ids=True, rows_are_sessions=True)
