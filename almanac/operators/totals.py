"""Totals over the monthly rows of a report.

Kept on purpose from the reports' summaries: the user total **adds monthly
distinct users** (someone active in two months counts twice), and the rate is
the plain mean of the monthly percents, not engaged over all sessions.  The
names say so: ``sum_monthly_users``, ``avg_monthly_engagement_pct``.

Sums of money go through decimals and the mean through basis points, so
the totals are exact and independent of row order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fmt
from .metrics import money, rounded


def _sum_money(col: str) -> Column:
    return rounded(F.sum(money(col)))


def _avg_pct(col: str) -> Column:
    bp = F.floor(F.col(col) * F.lit(100.0) + F.lit(0.5)).cast("long")
    return F.sum(bp).cast("double") / (F.count(col) * F.lit(100.0))


def report_totals(report: DataFrame, by: Sequence[str] = (), display: bool = True) -> DataFrame:
    """``months`` and, for the columns the report has, ``sessions``,
    ``sum_monthly_users``, ``revenue``, ``avg_monthly_engagement_pct``; with
    ``display``, Brazilian-style strings (``*_display``) as the summary prints
    them (T1–T3)."""
    cols = set(report.columns)
    aggs = [F.count(F.lit(1)).alias("months")]
    disp = {}
    if "sessions" in cols:
        aggs.append(F.sum("sessions").cast("long").alias("sessions"))
        disp["sessions_display"] = fmt.int_br("sessions")
    if "active_users" in cols:
        aggs.append(F.sum("active_users").cast("long").alias("sum_monthly_users"))
        disp["sum_monthly_users_display"] = fmt.int_br("sum_monthly_users")
    if "engagement_pct" in cols:
        aggs.append(_avg_pct("engagement_pct").alias("avg_monthly_engagement_pct"))
        disp["avg_monthly_engagement_pct_display"] = fmt.percent("avg_monthly_engagement_pct")
    if "revenue" in cols:
        aggs.append(_sum_money("revenue").alias("revenue"))
        disp["revenue_display"] = fmt.money_br("revenue")
    out = report.groupBy(*by).agg(*aggs) if by else report.agg(*aggs)
    return out.withColumns(disp) if display and disp else out


def app_year_totals(report: DataFrame, display: bool = True) -> DataFrame:
    """Yearly totals of the month-only app report, US-style strings (T4)."""
    out = report.agg(
        F.count(F.lit(1)).alias("months"),
        F.sum("app_users_total").cast("long").alias("users_total"),
        F.sum("app_sessions_total").cast("long").alias("sessions_total"),
        _sum_money("app_revenue_total").alias("revenue_total"),
    )
    if not display:
        return out
    return out.withColumns({
        "users_total_display": fmt.int_us("users_total"),
        "sessions_total_display": fmt.int_us("sessions_total"),
        "revenue_total_display": fmt.money_us("revenue_total"),
    })
