"""Sessions by inactivity gap, without one task per user.

A new session starts at an event whose gap to the user's previous event is
greater than ``gap`` (a gap of exactly ``gap`` stays in the session).

The plain form is a window ``partitionBy(user).orderBy(ts)`` with ``lag`` and
a running sum.  It puts every event of a user into one task, so a single
heavy user (a bot, a shared test account) can hold a third of all rows in one
partition.  This module uses a shape that is bounded per task instead:

1. Cut time into buckets of width ``gap``: ``bucket = floor(ts / gap)``.  Two
   events in one bucket are less than ``gap`` apart, so **a session can only
   start at the first event of a bucket**.
2. Aggregate events to a few rows per (user, bucket) — first ts, last ts,
   counts; a report adds its day and filter fields, the session channel adds
   the channel — with a hash aggregate whose map-side partial step reduces a
   hot user before the shuffle.
3. One window per user over those rows (``sessionize_groups``): a bucket
   starts a session when its first ts is more than ``gap`` after the last ts
   of all earlier buckets.  A user has at most ``time span / gap`` buckets
   (17,520 a year at 30 min) whatever the number of events, so the window's
   per-user partition has a proven bound.

``sessionize_blocks`` bounds step 3 by a block of time instead of a user's
history: sessions inside each (user, block) first, then one window per user over
the pieces at block borders only (two a block at most), whose sessions go back
to the rows of those blocks.  Same sessions; a binding asks for it by
``session_block``.

Reports use the rows of step 3 directly (metrics are summed per row), so raw
events are scanned once, aggregated once and never joined.  ``session_map``
gives the (user, bucket) → session mapping; ``assign_sessions`` puts session
ids on events by an equi-join on (user, bucket), where AQE's skew-join
handling splits a hot key on the event side (the map side has one row per
key).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

SESSION_MAP_COLUMNS = ("user_id", "bucket", "session_id", "session_start", "first_ts", "last_ts", "n_events")


# Session zone names that mean UTC.
UTC_ZONES = {"UTC", "GMT", "Z", "+00:00", "UCT", "Universal", "Zulu",
             "Etc/UTC", "Etc/GMT", "Etc/UCT", "Etc/Universal", "Etc/Zulu"}


def epoch_micros(df: DataFrame, ts: str = "ts") -> Column:
    """Microseconds since 1970-01-01 without depending on the session zone:
    wall-clock micros for ``timestamp_ntz``, instant micros for ``timestamp``.

    For ``timestamp_ntz`` under a UTC session the cast to ``timestamp`` is
    the identity on the stored micros (Spark fixes the zone into the cast
    when the plan is analysed), so the cheap ``unix_micros`` form is exact;
    under any other zone the value is built from the fields."""
    c = F.col(ts)
    if isinstance(df.schema[ts].dataType, TimestampNTZType):
        if df.sparkSession.conf.get("spark.sql.session.timeZone", None) in UTC_ZONES:
            return F.unix_micros(c.cast("timestamp"))
        # Built from fields: any cast of timestamp_ntz to timestamp (which
        # unix_micros and timestampdiff do) goes through the session zone.
        day = F.unix_date(c.cast("date")).cast("long")
        secs = F.extract(F.lit("SECOND"), c)  # decimal(8,6), with the fraction
        return (day * F.lit(86_400_000_000) + F.hour(c).cast("long") * F.lit(3_600_000_000)
                + F.minute(c).cast("long") * F.lit(60_000_000) + (secs * F.lit(1_000_000)).cast("long"))
    return F.unix_micros(c)


def gap_micros(gap: dt.timedelta) -> int:
    us = int(gap / dt.timedelta(microseconds=1))
    if us <= 0:
        raise ValueError("session gap must be positive")
    return us


def bucket_of(df: DataFrame, gap: dt.timedelta, ts: str = "ts") -> Column:
    """``floor(micros / gap)``, exact (also before 1970): the dividend is made
    a multiple of the gap first, so the quotient is a whole number and
    ``rint`` removes any rounding of the double division (micros pass 2^53
    after the year 2255)."""
    us = epoch_micros(df, ts)
    g = F.lit(gap_micros(gap))
    return F.rint((us - F.pmod(us, g)) / g).cast("long")


def _gap_interval(gap: dt.timedelta) -> Column:
    return F.make_dt_interval(secs=F.lit(gap.total_seconds()).cast("decimal(18,6)"))


def _order_key(ev: DataFrame, gap: dt.timedelta) -> Column:
    """Exact (ts, event_id) order inside one bucket as one ``decimal(38,0)``
    (a type a hash aggregate can keep): offset in the bucket (< gap) times
    2^64 plus the event id shifted to be non-negative.  A NULL event id sorts
    last."""
    us = epoch_micros(ev)
    offset = F.pmod(us, F.lit(gap_micros(gap))).cast("decimal(38,0)")
    eid = F.coalesce(F.col("event_id"), F.lit(2**63 - 1)).cast("decimal(38,0)")
    shift = F.lit(str(2**63)).cast("decimal(38,0)")
    return offset * F.lit(str(2**64)).cast("decimal(38,0)") + eid + shift


def with_bucket(events: DataFrame, gap: dt.timedelta, ts: str = "ts") -> DataFrame:
    return events.withColumn("bucket", bucket_of(events, gap, ts))


def session_map(events: DataFrame, gap: dt.timedelta = dt.timedelta(minutes=30),
                with_channel: bool = False, block: dt.timedelta | None = None) -> DataFrame:
    """(user_id, bucket) → session_id (1, 2, ... per user in time order),
    session_start [, session_channel], with the bucket's first_ts, last_ts
    and n_events.

    With ``block`` no task follows a user's history (``sessionize_blocks``);
    counting a user's sessions would, so ``session_id`` is then the start in
    epoch microseconds, which a later event does not change.

    ``events`` needs ``user_id`` and ``ts`` (and ``channel`` and ``event_id``
    when ``with_channel``).  Rows with a NULL user or ts belong to no session.
    """
    ev = events.where(F.col("user_id").isNotNull() & F.col("ts").isNotNull())
    ev = with_bucket(ev, gap)
    keys = ["user_id", "bucket"]
    aggs = [F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.count(F.lit(1)).alias("n_events")]
    if with_channel:
        # First non-null channel in (ts, event_id) order.  A string-valued
        # min_by cannot live in a hash-aggregate buffer, so the channel is a
        # grouping key here, with an exact numeric (ts, event_id) order key;
        # the window picks the first one.
        ev = ev.withColumn("order_key", _order_key(ev, gap))
        keys.append("channel")
        aggs.append(F.min("order_key").alias("order_key"))
    groups = ev.groupBy(*keys).agg(*aggs)
    cols = list(SESSION_MAP_COLUMNS) + (["session_channel"] if with_channel else [])
    if block is not None:
        rows = sessionize_blocks(groups, gap, block, with_channel)
        m = rows.groupBy("user_id", "bucket", "session_start", *cols[len(SESSION_MAP_COLUMNS):]).agg(
            F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"), F.sum("n_events").alias("n_events"))
        return m.withColumn("session_id", epoch_micros(m, "session_start")).select(*cols)
    rows = sessionize_groups(groups, gap, with_channel)
    # Back to one row per (user, bucket); still partitioned by user, so
    # neither this aggregate nor the numbering window shuffles.
    out_keys = ["user_id", "bucket", "session_id"] + (["session_channel"] if with_channel else [])
    m = rows.groupBy(*out_keys).agg(F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"),
                                    F.sum("n_events").alias("n_events"))
    m = (m.withColumn("session_start", F.min("first_ts").over(Window.partitionBy("user_id", "session_id")))
          .withColumn("session_id", F.dense_rank().over(Window.partitionBy("user_id").orderBy("session_id"))
                      .cast("long")))
    return m.select(*cols)


def sessionize_groups(groups: DataFrame, gap: dt.timedelta = dt.timedelta(minutes=30),
                      with_channel: bool = False) -> DataFrame:
    """Add ``session_id`` (and ``session_channel``) to rows reduced below
    (user, bucket) — several rows per bucket are allowed (e.g. one per day,
    platform and channel) — with one window pass per user and no join.

    Rows carry ``first_ts`` and ``last_ts`` (and ``channel``, ``order_key``).
    A bucket starts a session when its first ts is more than ``gap`` after
    the last ts of all earlier buckets (a RANGE frame over the bucket number);
    ``session_id`` is the starting bucket's number, unique within the user.
    The per-user partition holds at most (time span / gap) buckets times the
    few rows per bucket, whatever the number of events.
    """
    by_user = Window.partitionBy("user_id").orderBy("bucket")
    earlier = by_user.rangeBetween(Window.unboundedPreceding, -1)
    same = by_user.rangeBetween(0, 0)  # the rows of this bucket
    upto = by_user.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    out = (groups
           .withColumns({"_bucket_first": F.min("first_ts").over(same),
                         "_prev_last": F.max("last_ts").over(earlier)})
           .withColumn("_start", F.col("_prev_last").isNull()
                       | (F.col("_bucket_first") > F.col("_prev_last") + _gap_interval(gap)))
           .withColumn("session_id", F.max(F.when(F.col("_start"), F.col("bucket"))).over(upto))
           .drop("_bucket_first", "_prev_last", "_start"))
    if with_channel:
        ws = (Window.partitionBy("user_id", "session_id").orderBy("bucket", "order_key")
              .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        out = out.withColumn("session_channel", F.first("channel", ignorenulls=True).over(ws))
    return out


def sessionize_blocks(groups: DataFrame, gap: dt.timedelta = dt.timedelta(minutes=30), block: dt.timedelta = dt.timedelta(days=31),
                      with_channel: bool = False) -> DataFrame:
    """The columns of :func:`sessionize_groups`, the same values, and
    ``session_start``, by a scan on two levels: no task holds more of one user
    than the rows of a block and the pieces of sessions that touch a border.

    1. Inside (user, block): a window as in ``sessionize_groups`` cuts pieces.
       Whether a bucket starts a session depends on the bucket before it alone
       (an earlier one ends more than ``gap`` before it), so only a piece from
       the block's first bucket can go on from another, and only one up to its
       last bucket can go on in another.
    2. Over the pieces at borders, per user: which belong together, the start
       and the first channel of the whole.  At most two pieces a block, and
       none for users who are not active right at a border.
    3. Pieces that turned out to be parts of longer sessions are joined back on
       (user, block), one row each, in the partitioning of step 1.

    The reduced rows are read twice, once for each level.
    """
    size = max(1, gap_micros(block) // gap_micros(gap))
    by_block = ["user_id", "block"]
    rows = groups.withColumn("block", F.col("bucket") - F.pmod(F.col("bucket"), F.lit(size).cast("long")))
    order = Window.partitionBy(*by_block).orderBy("bucket")
    rows = (rows
            .withColumns({"_bucket_first": F.min("first_ts").over(order.rangeBetween(0, 0)),
                          "_prev_last": F.max("last_ts").over(order.rangeBetween(Window.unboundedPreceding, -1))})
            .withColumn("_start", F.col("_prev_last").isNull() | (F.col("_bucket_first") > F.col("_prev_last") + _gap_interval(gap)))
            .withColumn("session_id", F.max(F.when(F.col("_start"), F.col("bucket")))
                        .over(order.rangeBetween(Window.unboundedPreceding, Window.currentRow)))
            .drop("_bucket_first", "_prev_last", "_start"))
    piece = Window.partitionBy(*by_block, "session_id")
    rows = rows.withColumn("session_start", F.min("first_ts").over(piece))
    if with_channel:
        rows = rows.withColumn("session_channel", F.first("channel", ignorenulls=True).over(
            piece.orderBy("bucket", "order_key").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    channel = ["session_channel"] if with_channel else []

    pieces = (rows.groupBy(*by_block, "session_id", "session_start", *channel)
              .agg(F.max("last_ts").alias("last_ts"), F.max("bucket").alias("last_bucket"))
              .where((F.col("session_id") == F.col("block")) | (F.col("last_bucket") == F.col("block") + F.lit(size - 1))))
    per_user = Window.partitionBy("user_id").orderBy("session_id")
    before = F.max("last_ts").over(per_user.rowsBetween(Window.unboundedPreceding, -1))
    starts = ((F.col("session_id") != F.col("block")) | F.col("_before").isNull()
              | (F.col("session_start") > F.col("_before") + _gap_interval(gap)))
    whole = Window.partitionBy("user_id", "whole")
    pieces = (pieces.withColumn("_before", before)
              .withColumn("whole", F.max(F.when(starts, F.col("session_id"))).over(
                  per_user.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
              .withColumns({"_many": F.count(F.lit(1)).over(whole), "whole_start": F.min("session_start").over(whole)}))
    if with_channel:
        pieces = pieces.withColumn("whole_channel", F.first("session_channel", ignorenulls=True).over(
            whole.orderBy("session_id").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    pieces = pieces.where(F.col("_many") > 1)
    # One row a (user, block): its head piece (from the first bucket on) and its tail piece.
    head = F.col("session_id") == F.col("block")
    joined = pieces.groupBy(*by_block).agg(
        F.max(F.when(head, F.col("whole"))).alias("_head"), F.max(F.when(head, F.col("whole_start"))).alias("_head_start"),
        F.max(F.when(~head, F.col("session_id"))).alias("_tail"),
        *([F.max(F.when(head, F.col("whole_channel"))).alias("_head_channel"),
           F.max(F.when(~head, F.col("whole_channel"))).alias("_tail_channel")] if with_channel else []))
    rows = rows.join(joined, by_block, "left")
    at_head, at_tail = head & F.col("_head").isNotNull(), F.col("session_id") == F.col("_tail")
    new = {"session_id": F.when(at_head, F.col("_head")).otherwise(F.col("session_id")),
           "session_start": F.when(at_head, F.col("_head_start")).otherwise(F.col("session_start"))}
    if with_channel:
        new["session_channel"] = (F.when(at_head, F.col("_head_channel")).when(at_tail, F.col("_tail_channel"))
                                  .otherwise(F.col("session_channel")))
    return rows.withColumns(new).drop("block", *joined.columns[2:])


def with_sessions(groups: DataFrame, gap: dt.timedelta, block: dt.timedelta | None, with_channel: bool = False) -> DataFrame:
    """``groups`` with the sessions of either form, without ``session_start``."""
    if block is None:
        return sessionize_groups(groups, gap, with_channel)
    return sessionize_blocks(groups, gap, block, with_channel).drop("session_start")


def session_rollup(events: DataFrame, gap: dt.timedelta = dt.timedelta(minutes=30)) -> DataFrame:
    """X2 at one row per (year, month, user, session): ``engaged`` (any engaged
    event, 0/1) and ``revenue_amount``.  One scan, one hash aggregate to
    (user, bucket, month) rows, the user window, then aggregates that stay in
    the user partitioning; ``session_id`` is 1, 2, ... per user."""
    from ..functions.dims import code
    from .metrics import money

    ev = with_bucket(events.where(F.col("user_id").isNotNull() & F.col("ts").isNotNull()), gap)
    g = (ev.withColumns({"year": F.year("ts"), "month": F.month("ts"), "revenue_amount": money("revenue")})
         .groupBy("user_id", "bucket", "year", "month")
         .agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
              F.max(F.col("engaged").cast("int")).alias("engaged"),
              F.sum("revenue_amount").alias("revenue_amount")))
    rows = sessionize_groups(g, gap)
    out = rows.groupBy("year", "month", "user_id", "session_id").agg(
        F.max("engaged").alias("engaged"), F.sum("revenue_amount").alias("revenue_amount"))
    seq = F.dense_rank().over(Window.partitionBy("user_id").orderBy("session_id")).cast("long")
    return out.withColumns({"session_id": seq, "year": code("year", 4), "month": code("month", 2)})


def sessions_table(events: DataFrame, gap: dt.timedelta = dt.timedelta(minutes=30),
                   with_channel: bool = False, block: dt.timedelta | None = None) -> DataFrame:
    """One row per session: user_id, session_id, session_start, session_end,
    n_events [, session_channel].  Built from bucket rows only; the events
    are never joined back.  ``block`` as in :func:`session_map`."""
    m = session_map(events, gap, with_channel, block)
    # the channel is constant per session: a key, not a string aggregate
    keys = ["user_id", "session_id"] + (["session_channel"] if with_channel else [])
    aggs = [F.min("first_ts").alias("session_start"), F.max("last_ts").alias("session_end"),
            F.sum("n_events").alias("n_events")]
    return m.groupBy(*keys).agg(*aggs)


def assign_sessions(events: DataFrame, gap: dt.timedelta = dt.timedelta(minutes=30),
                    with_channel: bool = False, with_start: bool = False, block: dt.timedelta | None = None) -> DataFrame:
    """Events with ``session_id`` (and ``session_channel``) filled in.

    Equi-join on (user_id, bucket).  Events without a user or a time match
    nothing; a third key spreads them, so those of one bucket (or all without a
    time) do not meet in one task.  To sessionize once and store, write the
    result partitioned by day; reports over the stored table then keep full
    predicate pushdown.  ``block`` as in :func:`session_map`.
    """
    m = session_map(events, gap, with_channel, block)
    keep = (["user_id", "bucket", "session_id"] + (["session_channel"] if with_channel else [])
            + (["session_start"] if with_start else []))
    ev = with_bucket(events, gap)
    if "session_id" in ev.columns:
        ev = ev.drop("session_id")
    alone = F.col("user_id").isNull() | F.col("ts").isNull()
    ev = ev.withColumn("_spread", F.when(alone, F.xxhash64(*ev.columns)).otherwise(F.lit(0)))
    return ev.join(m.select(*keep, F.lit(0).cast("long").alias("_spread")), ["user_id", "bucket", "_spread"], "left").drop("bucket", "_spread")
