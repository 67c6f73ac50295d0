"""The report metrics as levels of hash aggregation.


* ``sessions``        distinct (user_id, session_id) in the group
* ``activeUsers``     distinct user_id in the group
* ``totalRevenue``    sum of revenue, 0 when no row has revenue
* ``engagementRate``  sessions with an engaged event / sessions

Several distinct counts in one ``agg`` make Spark plan an ``Expand`` that
copies every input row once per distinct expression.  Instead the metrics are
computed level by level, each level a plain hash aggregate with a map-side
partial step:

    events --(keys, user, session)--> sessions --(keys, user)--> users --(keys)--> months

and levels that a metric set does not need are skipped (revenue alone is one
aggregate; a binding whose rows are sessions skips the session level).

Revenue is summed as ``decimal(38,6)`` and rounded to cents once per result
row: exact, independent of the order of addition, and small amounts are not
lost one by one.  An amount that is no number (NaN), infinite or beyond
``decimal(28,6)`` counts as no revenue.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def money(revenue: Column | str) -> Column:
    """Revenue as ``decimal(28,6)``; NULL for NaN, infinities and amounts too
    large for it.  Decimal columns do not pass through double."""
    c = F.col(revenue) if isinstance(revenue, str) else revenue
    return c.try_cast("decimal(28,6)")


def rounded(amount: Column | str) -> Column:
    """A sum of :func:`money` as double, rounded to cents; 0 for NULL."""
    c = F.col(amount) if isinstance(amount, str) else amount
    return F.coalesce(F.round(c, 2), F.lit(0)).cast("double")


def needs(metrics: Sequence[str]) -> dict[str, bool]:
    m = set(metrics)
    return {
        "sessions": bool(m & {"sessions", "engagementRate"}),
        "users": "activeUsers" in m,
        "engaged": "engagementRate" in m,
        "revenue": "totalRevenue" in m,
    }


def aggregate_levels(df: DataFrame, keys: Sequence[str], metrics: Sequence[str],
                     rows_are_sessions: bool = False, approx_users: float | None = None) -> DataFrame:
    """Group ``df`` by ``keys`` and compute the count columns behind
    ``metrics``: ``sessions``, ``active_users``, ``engaged_sessions``,
    ``revenue_amount`` (only those needed).

    ``df`` holds ``user_id``, ``session_id``, ``engaged`` (boolean) and
    ``revenue_amount`` (decimal) besides ``keys``.  ``approx_users`` counts users
    approximately (relative standard deviation), skipping the user level.
    """
    need = needs(metrics)
    keys = list(keys)
    cur = df
    # Session level (X2): one row per (keys, user, session).
    if need["sessions"]:
        if rows_are_sessions:
            cur = cur.select(*keys, "user_id", "session_id",
                             F.col("engaged").cast("int").alias("engaged"), "revenue_amount")
        else:
            aggs = [F.max(F.col("engaged").cast("int")).alias("engaged")]
            if need["revenue"]:
                aggs.append(F.sum("revenue_amount").alias("revenue_amount"))
            cur = cur.groupBy(*keys, "user_id", "session_id").agg(*aggs)
        # count(session_id) skips NULL ids, as a distinct count would
        sess = F.count("session_id")
        eng = F.sum(F.when(F.col("session_id").isNotNull(), F.col("engaged")))
    # User level: one row per (keys, user) — or, with ``approx_users``, a
    # HyperLogLog++ sketch at the last level instead (fixed-size buffer, so
    # still a hash aggregate).
    if need["users"] and approx_users:
        final = [F.approx_count_distinct("user_id", approx_users).alias("active_users")]
        if need["sessions"]:
            final += [sess.alias("sessions"), eng.alias("engaged_sessions")]
    elif need["users"]:
        aggs = []
        if need["sessions"]:
            aggs += [sess.alias("sessions"), eng.alias("engaged_sessions")]
        if need["revenue"]:
            aggs.append(F.sum("revenue_amount").alias("revenue_amount"))
        if not aggs:
            aggs = [F.count(F.lit(1)).alias("_rows")]
        cur = cur.groupBy(*keys, "user_id").agg(*aggs)
        final = [F.count("user_id").alias("active_users")]
        if need["sessions"]:
            final += [F.sum("sessions").alias("sessions"), F.sum("engaged_sessions").alias("engaged_sessions")]
    else:
        final = []
        if need["sessions"]:
            final += [sess.alias("sessions"), eng.alias("engaged_sessions")]
    if need["revenue"]:
        final.append(F.sum("revenue_amount").alias("revenue_amount"))
    out = cur.groupBy(*keys).agg(*final)
    fix = {}
    if need["sessions"]:
        fix["engaged_sessions"] = F.coalesce(F.col("engaged_sessions"), F.lit(0)).cast("long")
    return out.withColumns(fix) if fix else out


def metric_columns(metrics: Sequence[str], rate_as_percent: bool = False) -> list[Column]:
    """Final metric columns from the counts of :func:`aggregate_levels`, in
    request order."""
    from ..functions.dims import percent_2dp

    out = []
    for m in metrics:
        if m == "sessions":
            out.append(F.col("sessions").cast("long").alias("sessions"))
        elif m == "activeUsers":
            out.append(F.col("active_users").cast("long").alias("active_users"))
        elif m == "totalRevenue":
            out.append(rounded("revenue_amount").alias("revenue"))
        elif m == "engagementRate":
            if rate_as_percent:
                out.append(percent_2dp("engaged_sessions", "sessions").alias("engagement_pct"))
            else:
                out.append(F.when(F.col("sessions") > 0, F.col("engaged_sessions") / F.col("sessions"))
                           .alias("engagement_rate"))
    return out
