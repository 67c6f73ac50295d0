"""Sessionize once and store: events with their session, by day.

Sessions by gap depend on each user's whole history, so a report that makes
them on the fly reads every earlier event.  Stored once — partitioned by
event date — the table has session ids and the session-scope channel, and a
report over it reads only the days of its range (partition pruning) with its
filters pushed into the scan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sessions import assign_sessions
from .bindings import CONTRACT, Binding

STORED_COLUMNS = ("event_id", "ts", "user_id", "session_id", "platform", "event_channel", "session_channel",
                  "engaged", "revenue", "event_date")


def sessionized_events(spark: SparkSession, binding: Binding, gap: dt.timedelta | None = None) -> DataFrame:
    """Every event of ``binding`` with ``session_id`` — the session's start as
    epoch microseconds, stable when the table is rebuilt — and the session's
    channel."""
    gap = gap or binding.session_gap
    ev = binding.frame(spark, CONTRACT).drop("session_id")
    ev = ev.select(*[c for c in ev.columns if not c.startswith("_")])
    s = assign_sessions(ev, gap, with_channel=True, with_start=True, block=binding.session_block)
    from ..operators.sessions import epoch_micros
    return s.select(
        "event_id", "ts", "user_id",
        epoch_micros(s, "session_start").alias("session_id"),
        "platform", F.col("channel").alias("event_channel"), "session_channel",
        "engaged", "revenue", F.to_date("ts").alias("event_date"))


def write_sessionized(spark: SparkSession, binding: Binding, path: str, gap: dt.timedelta | None = None,
                      mode: str = "errorifexists") -> str:
    """Write the sessionized events partitioned by ``event_date``.

    The ``rebalance`` hint lets AQE cut each day into files of the advisory
    size — a busy day is split across tasks, small days are merged — instead
    of one task per day (skew) or one file per task and day (small files).
    """
    df = sessionized_events(spark, binding, gap).hint("rebalance", "event_date")
    df.write.mode(mode).partitionBy("event_date").parquet(path)
    return path


def sessionized_binding(path: str, name: str = "stored_sessions") -> Binding:
    """A binding over a table written by :func:`write_sessionized`: it has
    session ids (one user each) and the channel at session scope."""

    def build(spark: SparkSession, need: frozenset) -> DataFrame:
        df = spark.read.parquet(path)
        cols = {c: F.col(c) for c in CONTRACT}
        cols["channel"] = F.col("session_channel")
        return df.select(*[cols[c].alias(c) for c in CONTRACT if c in need], "event_date")

    return Binding(name=name, build=build, session_ids=True, partition_date="event_date")
