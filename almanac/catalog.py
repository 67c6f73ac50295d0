"""
DuckDB oracles.

Each query is a callable ``(spark, data_dir) -> DataFrame`` over the driver's
tables through the bindings of FIXTURES.md §4.  Each oracle is hand-written
SQL over the same tables (views ``orders``, ``customer``, ``events``, ...),
computing the same figures by the direct route (``count(DISTINCT ...)``,
window-function sessions) so that it checks the Spark plan rather than
repeating it.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import uuid
from functools import lru_cache
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import dims as D
from .functions import fmt as T
from .functions.dims import MONTH_NAMES_PT
from .functions.labels import HEADINGS, headings, labelled
from .operators import filters as FL
from .operators import sessions as X
from .operators import totals as TO
from .operators.metrics import money, rounded
from .plans import bundle as BU
from .plans import report as R
from .plans.spec import AnyOf, DateRange, Exact, ReportSpec
from .session import shared_dir
from .sources import session_store as SS
from .sources import summary as SU
from .sources import bindings as BI
from .sources import typed
from .sources.bindings import events_contract
from .sources.properties import ECOMMERCE, SECOND, default_registry, events_registry
from .streaming import sessions as ST
from .streaming import stateful as SF

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

# The whole span of the driver's tables: orders 1995-01 .. 2001-08 (reports
# run by whole years, so the last months of 2001 are empty), events 2024-01.
ORDERS_SPAN = DateRange("1995-01-01", "2001-12-31")
EVENTS_SPAN = DateRange("2024-01-01", "2024-12-31")


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


# --------------------------------------------------------------------------
# SQL building blocks for the oracles
# --------------------------------------------------------------------------

ORDERS_CTE = """
ob AS (
  SELECT o.o_orderkey AS event_id, o.o_orderdate AS ts, o.o_custkey AS user_id,
         o.o_orderkey AS session_id,
         CASE o.o_orderpriority WHEN '1-URGENT' THEN 'Android' WHEN '2-HIGH' THEN 'iOS' ELSE 'web' END AS platform,
         CASE WHEN c.c_mktsegment = 'BUILDING' THEN 'Organic Search' ELSE 'Other' END AS channel,
         o.o_orderstatus = 'F' AS engaged,
         o.o_totalprice AS revenue
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
)"""

EVENTS_CTE = """
e0 AS (
  SELECT event_id, ts, user_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events
),
e1 AS (
  SELECT event_id, ts, user_id,
         CASE ((k % 3) + 3) % 3 WHEN 0 THEN 'web' WHEN 1 THEN 'Android' WHEN 2 THEN 'iOS' END AS platform,
         CASE WHEN k IS NULL THEN NULL WHEN k < 25 THEN 'Organic Search' ELSE 'Other' END AS channel,
         coalesce(event_type IN ('click', 'purchase'), false) AS engaged,
         CASE WHEN event_type = 'purchase' THEN value END AS revenue
  FROM e0
  WHERE ts IS NOT NULL
),
e2 AS (
  SELECT *,
         CASE WHEN lag(ts) OVER w IS NULL OR ts > lag(ts) OVER w + INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS is_start
  FROM e1
  WHERE user_id IS NOT NULL
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
),
e3 AS (
  SELECT *, CAST(sum(is_start) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS session_id
  FROM e2
),
eb AS (
  SELECT *, first_value(channel IGNORE NULLS) OVER (
              PARTITION BY user_id, session_id ORDER BY ts, event_id
              ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS session_channel,
         CAST(user_id AS VARCHAR) || ':' || CAST(session_id AS VARCHAR) AS skey
  FROM e3
  UNION ALL  -- events without a user: revenue, but no session
  SELECT *, NULL, NULL, NULL, NULL FROM e1 WHERE user_id IS NULL
)"""


def month_name_sql(code: str, keep: bool = False) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in MONTH_NAMES_PT.items())
    return f"CASE {code} {whens} ELSE {code if keep else 'NULL'} END"


def month_rank_sql(name: str) -> str:
    whens = " ".join(f"WHEN '{v}' THEN {i}" for i, v in enumerate(MONTH_NAMES_PT.values()))
    return f"CASE {name} {whens} END"


def range_sql(rng: DateRange, ts: str = "ts") -> str:
    return f"{ts} >= TIMESTAMP '{rng.start} 00:00:00' AND {ts} < TIMESTAMP '{rng.end_exclusive} 00:00:00'"


REVENUE_SQL = "CAST(coalesce(round(sum(CAST(revenue AS DECIMAL(38, 6))), 2), 0) AS DOUBLE)"
PCT_SQL = ("CASE WHEN {s} > 0 THEN CAST((CAST({e} AS BIGINT) * 20000 + {s}) // (2 * {s}) AS DOUBLE) / 100 END")


def pct_sql(engaged: str, sessions: str) -> str:
    return PCT_SQL.format(e=engaged, s=sessions)


def orders_report_sql(metrics_sql: str, where: str, rng: DateRange = ORDERS_SPAN,
                      names: bool = True) -> str:
    month = month_name_sql("month") if names else "month"
    return f"""
WITH {ORDERS_CTE},
g AS (
  SELECT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, {metrics_sql}
  FROM ob WHERE {range_sql(rng)} AND ({where})
  GROUP BY 1, 2
)
SELECT {month} AS month, year, * EXCLUDE (year, month) FROM g"""


# --------------------------------------------------------------------------
# Reports R1–R4 (orders binding, whole span)
# --------------------------------------------------------------------------

@lru_cache(maxsize=None)
def _orders(d: str):
    return default_registry(d)


@lru_cache(maxsize=None)
def _events(d: str):
    return events_registry(d)


@register("web_report", orders_report_sql(
    f"CAST(count(DISTINCT session_id) AS BIGINT) AS sessions, {REVENUE_SQL} AS revenue", "platform = 'web'"))
def q_web_report(spark, d):
    return R.web_report(spark, _orders(d), ORDERS_SPAN)


@register("app_report", orders_report_sql(
    "CAST(count(DISTINCT user_id) AS BIGINT) AS active_users, "
    f"CAST(count(DISTINCT session_id) AS BIGINT) AS sessions, {REVENUE_SQL} AS revenue",
    "platform IN ('Android', 'iOS')"))
def q_app_report(spark, d):
    return R.app_report(spark, _orders(d), ORDERS_SPAN)


@register("organic_report", orders_report_sql(
    "CAST(count(DISTINCT session_id) AS BIGINT) AS sessions, "
    "CAST(count(DISTINCT user_id) AS BIGINT) AS active_users, "
    + pct_sql("count(DISTINCT CASE WHEN engaged THEN session_id END)", "count(DISTINCT session_id)")
    + f" AS engagement_pct, {REVENUE_SQL} AS revenue",
    "channel = 'Organic Search'"))
def q_organic_report(spark, d):
    return R.organic_report(spark, _orders(d), ORDERS_SPAN)


@register("app_year_report", f"""
WITH {ORDERS_CTE},
g AS (
  SELECT strftime(ts, '%m') AS month,
         CAST(count(DISTINCT user_id) AS BIGINT) AS app_users_total,
         CAST(count(DISTINCT session_id) AS BIGINT) AS app_sessions_total,
         {REVENUE_SQL} AS app_revenue_total
  FROM ob WHERE {range_sql(ORDERS_SPAN)} AND platform IN ('Android', 'iOS')
  GROUP BY 1
)
SELECT {month_name_sql('month', keep=True)} AS month, '1995-2001' AS year,
       app_users_total, app_sessions_total, app_revenue_total
FROM g""")
def q_app_year_report(spark, d):
    return R.app_year_report(spark, _orders(d), ORDERS_SPAN)


# --------------------------------------------------------------------------
# Reports on the events binding: sessions made by gap (X1), session channel
# --------------------------------------------------------------------------

def events_report_sql(metrics_sql: str, where: str, rng: DateRange = EVENTS_SPAN) -> str:
    return f"""
WITH {EVENTS_CTE},
g AS (
  SELECT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, {metrics_sql}
  FROM eb WHERE {range_sql(rng)} AND ({where})
  GROUP BY 1, 2
)
SELECT {month_name_sql('month')} AS month, year, * EXCLUDE (year, month) FROM g"""


@register("organic_report_events", events_report_sql(
    "CAST(count(DISTINCT skey) AS BIGINT) AS sessions, "
    "CAST(count(DISTINCT user_id) AS BIGINT) AS active_users, "
    + pct_sql("count(DISTINCT CASE WHEN engaged THEN skey END)", "count(DISTINCT skey)")
    + f" AS engagement_pct, {REVENUE_SQL} AS revenue",
    "session_channel = 'Organic Search'"))
def q_organic_report_events(spark, d):
    return R.organic_report(spark, _events(d), EVENTS_SPAN)


MID_JANUARY = DateRange("2024-01-10", "2024-01-20")


@register("organic_report_events_range", events_report_sql(
    "CAST(count(DISTINCT skey) AS BIGINT) AS sessions, "
    "CAST(count(DISTINCT user_id) AS BIGINT) AS active_users, "
    + pct_sql("count(DISTINCT CASE WHEN engaged THEN skey END)", "count(DISTINCT skey)")
    + f" AS engagement_pct, {REVENUE_SQL} AS revenue",
    "session_channel = 'Organic Search'", MID_JANUARY))
def q_organic_report_events_range(spark, d):
    """F1 with P4: a range inside the data, sessions and their channel from all events."""
    return R.organic_report(spark, _events(d), MID_JANUARY)


@register("app_report_events", events_report_sql(
    "CAST(count(DISTINCT user_id) AS BIGINT) AS active_users, "
    f"CAST(count(DISTINCT skey) AS BIGINT) AS sessions, {REVENUE_SQL} AS revenue",
    "platform IN ('Android', 'iOS')"))
def q_app_report_events(spark, d):
    return R.app_report(spark, _events(d), EVENTS_SPAN)


@register("app_year_report_events", f"""
WITH {EVENTS_CTE},
g AS (
  SELECT strftime(ts, '%m') AS month,
         CAST(count(DISTINCT user_id) AS BIGINT) AS app_users_total,
         CAST(count(DISTINCT skey) AS BIGINT) AS app_sessions_total,
         {REVENUE_SQL} AS app_revenue_total
  FROM eb WHERE {range_sql(EVENTS_SPAN)} AND platform IN ('Android', 'iOS')
  GROUP BY 1
)
SELECT {month_name_sql('month', keep=True)} AS month, '2024' AS year,
       app_users_total, app_sessions_total, app_revenue_total
FROM g""")
def q_app_year_report_events(spark, d):
    """R4 on the sessionized events: month-only grouping, constant year."""
    return R.app_year_report(spark, _events(d), EVENTS_SPAN)


@register("web_report_events", events_report_sql(
    f"CAST(count(DISTINCT skey) AS BIGINT) AS sessions, {REVENUE_SQL} AS revenue", "platform = 'web'"))
def q_web_report_events(spark, d):
    return R.web_report(spark, _events(d), EVENTS_SPAN)


# --------------------------------------------------------------------------
# Building blocks on the orders binding
# --------------------------------------------------------------------------


def _orders_rows(spark, d, cols, rng: DateRange = ORDERS_SPAN, flt=None):
    """Contract rows of the orders property in a range, with year/month codes."""
    b = _orders(d)[ECOMMERCE]
    ev = b.frame(spark, set(cols) | {"ts"})
    ev = FL.where_date_range(ev, rng)
    if "channel" in ev.columns:
        ev = ev.withColumnRenamed("channel", "session_channel")
    ev = ev.withColumns({"year": F.year("ts"), "month": F.month("ts")})
    leaf = R._source_leaf(b, ev.columns)
    ev = FL.where_filter(ev, flt, R._resolver(), leaf)
    return ev.withColumns({"year": D.code("year", 4), "month": D.code("month", 2)})


RANGE_1996 = DateRange("1996-03-01", "1997-02-28")


@register("date_range", f"""
WITH {ORDERS_CTE}
SELECT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, count(*) AS n_rows,
       strftime(min(ts), '%Y-%m-%d') AS first_day, strftime(max(ts), '%Y-%m-%d') AS last_day
FROM ob WHERE {range_sql(RANGE_1996)}
GROUP BY 1, 2""")
def q_date_range(spark, d):
    """both ends included (orders sit at midnight, so the last day counts)."""
    rows = _orders_rows(spark, d, {"ts"}, RANGE_1996)
    return rows.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.to_date(F.min("ts")).cast("string").alias("first_day"),
        F.to_date(F.max("ts")).cast("string").alias("last_day"))


@register("filter_exact", f"""
WITH {ORDERS_CTE}
SELECT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, count(*) AS n_rows, {REVENUE_SQL} AS revenue
FROM ob WHERE {range_sql(ORDERS_SPAN)} AND platform = 'web'
GROUP BY 1, 2""")
def q_filter_exact(spark, d):
    """platform = web."""
    rows = _orders_rows(spark, d, {"platform", "revenue"}, flt=Exact("platform", "web"))
    return rows.groupBy("year", "month").agg(F.count(F.lit(1)).alias("n_rows"),
                                             rounded(F.sum(money("revenue"))).alias("revenue"))


@register("filter_exact_ci", f"""
WITH {ORDERS_CTE}
SELECT platform, count(*) AS n_rows
FROM ob WHERE {range_sql(ORDERS_SPAN)} AND lower(platform) = 'ios'
GROUP BY 1""")
def q_filter_exact_ci(spark, d):
    """F2 with the case-insensitive option: 'IOS' matches iOS."""
    rows = _orders_rows(spark, d, {"platform"}, flt=Exact("platform", "IOS", case_sensitive=False))
    return rows.groupBy("platform").agg(F.count(F.lit(1)).alias("n_rows"))


@register("filter_or", f"""
WITH {ORDERS_CTE}
SELECT strftime(ts, '%Y') AS year, platform, count(*) AS n_rows
FROM ob WHERE {range_sql(ORDERS_SPAN)} AND (platform = 'Android' OR platform = 'iOS')
GROUP BY 1, 2""")
def q_filter_or(spark, d):
    """an OR group of EXACT leaves (one IN on the source column)."""
    rows = _orders_rows(spark, d, {"platform"}, flt=R.APP_FILTER)
    return rows.groupBy("year", "platform").agg(F.count(F.lit(1)).alias("n_rows"))


TREE = AnyOf(Exact("platform", "web"), AnyOf(Exact("platform", "iOS"),
                                             Exact("sessionDefaultChannelGroup", "Organic Search")))


@register("filter_tree", f"""
WITH {ORDERS_CTE}
SELECT strftime(ts, '%Y') AS year, platform, channel, count(*) AS n_rows
FROM ob WHERE {range_sql(ORDERS_SPAN)}
  AND (platform = 'web' OR (platform = 'iOS' OR channel = 'Organic Search'))
GROUP BY 1, 2, 3""")
def q_filter_tree(spark, d):
    """a nested tree — web OR (iOS OR channel Organic Search)."""
    rows = _orders_rows(spark, d, {"platform", "channel"}, flt=TREE)
    return rows.groupBy("year", "platform", F.col("session_channel").alias("channel")).agg(
        F.count(F.lit(1)).alias("n_rows"))


@register("dim_month_year", f"""
WITH {ORDERS_CTE}
SELECT DISTINCT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month FROM ob""")
def q_dim_month_year(spark, d):
    """The (year, month) codes present in the table."""
    b = _orders(d)[ECOMMERCE]
    ev = b.frame(spark, {"ts"})
    return ev.select(D.year_code("ts").alias("year"), D.month_code("ts").alias("month")).distinct()


@register("month_name_null", f"""
WITH {ORDERS_CTE}
SELECT month, {month_name_sql('month')} AS month_name, count(*) AS n_rows
FROM (SELECT strftime(ts, '%m') AS month FROM ob) GROUP BY 1""")
def q_month_name_null(spark, d):
    """P5: month names; an unknown code would give NULL."""
    rows = _orders_rows(spark, d, {"ts"}, DateRange("1900-01-01", "2999-12-31"))
    return rows.groupBy("month").agg(F.count(F.lit(1)).alias("n_rows")).select(
        "month", D.month_name("month").alias("month_name"), "n_rows")


@register("month_name_keep", f"""
WITH {ORDERS_CTE}
SELECT {month_name_sql("strftime(ts, '%m')", keep=True)} AS month_name, count(*) AS n_rows
FROM ob GROUP BY 1""")
def q_month_name_keep(spark, d):
    """Month names; an unknown code would be kept."""
    rows = _orders_rows(spark, d, {"ts"}, DateRange("1900-01-01", "2999-12-31"))
    return rows.groupBy(D.month_name_or_code("month").alias("month_name")).agg(
        F.count(F.lit(1)).alias("n_rows"))


_ALL_METRICS_SQL = (
    "CAST(count(DISTINCT session_id) AS BIGINT) AS sessions, "
    "CAST(count(DISTINCT user_id) AS BIGINT) AS active_users, "
    "CASE WHEN count(DISTINCT session_id) > 0 THEN "
    "count(DISTINCT CASE WHEN engaged THEN session_id END) / count(DISTINCT session_id) END AS engagement_rate, "
    f"{REVENUE_SQL} AS revenue")


@register("group_month_year", f"""
WITH {ORDERS_CTE}
SELECT strftime(ts, '%m') AS month, strftime(ts, '%Y') AS year, {_ALL_METRICS_SQL}
FROM ob WHERE {range_sql(ORDERS_SPAN)} GROUP BY 1, 2""")
def q_group_month_year(spark, d):
    """Every metric by (year, month) in one request (codes kept)."""
    spec = ReportSpec(ECOMMERCE, ("sessions", "activeUsers", "engagementRate", "totalRevenue"), ORDERS_SPAN)
    return R.run_report(spark, spec, _orders(d), month_names="codes")


@register("group_month", f"""
WITH {ORDERS_CTE}
SELECT strftime(ts, '%m') AS month, '1995-2001' AS year,
       CAST(count(DISTINCT session_id) AS BIGINT) AS sessions,
       CAST(count(DISTINCT user_id) AS BIGINT) AS active_users, {REVENUE_SQL} AS revenue
FROM ob WHERE {range_sql(ORDERS_SPAN)} GROUP BY 1""")
def q_group_month(spark, d):
    """A2: month only — the years of the range fall together."""
    spec = ReportSpec(ECOMMERCE, ("sessions", "activeUsers", "totalRevenue"), ORDERS_SPAN, dimensions=("month",))
    return R.run_report(spark, spec, _orders(d), month_names="codes")


def _single_metric(metric: str, sql_expr: str, col: str):
    sql = f"""
WITH {ORDERS_CTE}
SELECT strftime(ts, '%m') AS month, strftime(ts, '%Y') AS year, {sql_expr} AS {col}
FROM ob WHERE {range_sql(ORDERS_SPAN)} GROUP BY 1, 2"""

    def q(spark, d):
        spec = ReportSpec(ECOMMERCE, (metric,), ORDERS_SPAN)
        return R.run_report(spark, spec, _orders(d), month_names="codes")
    return sql, q


for _name, _metric, _sql, _col in [
    ("sessions", "sessions", "CAST(count(DISTINCT session_id) AS BIGINT)", "sessions"),
    ("active_users", "activeUsers", "CAST(count(DISTINCT user_id) AS BIGINT)", "active_users"),
    ("revenue", "totalRevenue", REVENUE_SQL, "revenue"),
    ("engagement_rate", "engagementRate",
     "CASE WHEN count(DISTINCT session_id) > 0 THEN "
     "count(DISTINCT CASE WHEN engaged THEN session_id END) / count(DISTINCT session_id) END",
     "engagement_rate"),
]:
    _s, _q = _single_metric(_metric, _sql, _col)
    _q.__doc__ = f"A3–A6: {_metric} alone."
    register(_name, _s)(_q)


@register("percent_round", f"""
WITH {ORDERS_CTE}
SELECT year, month, engaged_sessions, sessions, {pct_sql('engaged_sessions', 'sessions')} AS engagement_pct
FROM (SELECT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month,
             CAST(count(DISTINCT CASE WHEN engaged THEN session_id END) AS BIGINT) AS engaged_sessions,
             CAST(count(DISTINCT session_id) AS BIGINT) AS sessions
      FROM ob WHERE {range_sql(ORDERS_SPAN)} AND platform = 'web' GROUP BY 1, 2)""")
def q_percent_round(spark, d):
    """Rate → percent with 2 decimals, half-up, in integers."""
    spec = ReportSpec(ECOMMERCE, ("engagementRate",), ORDERS_SPAN, filter=R.WEB_FILTER)
    c = R.monthly_counts(spark, spec, _orders(d))
    return c.select("year", "month", "engaged_sessions", F.col("sessions").cast("long").alias("sessions"),
                    D.percent_2dp("engaged_sessions", "sessions").alias("engagement_pct"))


# --------------------------------------------------------------------------
# Totals, sort, scaffold
# --------------------------------------------------------------------------

def _report_sql(kind: str) -> str:
    return {"web": ORACLE_SQL["web_report"], "app": ORACLE_SQL["app_report"],
            "organic": ORACLE_SQL["organic_report"], "app_year": ORACLE_SQL["app_year_report"]}[kind]


def _sub(sql: str) -> str:
    return f"({sql.strip()})"


@register("totals", f"""
SELECT CAST(count(*) AS BIGINT) AS months,
       CAST(sum(sessions) AS BIGINT) AS sessions,
       CAST(sum(active_users) AS BIGINT) AS sum_monthly_users,
       CAST(sum(CAST(floor(engagement_pct * 100 + 0.5) AS BIGINT)) AS DOUBLE) / (count(engagement_pct) * 100.0)
         AS avg_monthly_engagement_pct,
       CAST(sum(CAST(floor(revenue * 100 + 0.5) AS BIGINT)) AS DOUBLE) / 100 AS revenue
FROM {_sub(_report_sql('organic'))} r""")
def q_totals(spark, d):
    """Months, summed sessions and monthly users, revenue, mean rate."""
    return TO.report_totals(q_organic_report(spark, d), display=False)


@register("avg_rate", f"""
SELECT CAST(sum(CAST(floor(engagement_pct * 100 + 0.5) AS BIGINT)) AS DOUBLE) / (count(engagement_pct) * 100.0)
         AS avg_monthly_engagement_pct
FROM {_sub(_report_sql('organic'))} r""")
def q_avg_rate(spark, d):
    """Plain mean of the monthly percents."""
    return TO.report_totals(q_organic_report(spark, d), display=False).select("avg_monthly_engagement_pct")


@register("app_year_totals", f"""
SELECT CAST(count(*) AS BIGINT) AS months,
       CAST(sum(app_users_total) AS BIGINT) AS users_total,
       CAST(sum(app_sessions_total) AS BIGINT) AS sessions_total,
       CAST(sum(CAST(floor(app_revenue_total * 100 + 0.5) AS BIGINT)) AS DOUBLE) / 100 AS revenue_total,
       format('{{:,}}', CAST(sum(app_users_total) AS BIGINT)) AS users_total_display,
       format('{{:,}}', CAST(sum(app_sessions_total) AS BIGINT)) AS sessions_total_display,
       'R$ ' || format('{{:,.2f}}', CAST(sum(CAST(floor(app_revenue_total * 100 + 0.5) AS BIGINT)) AS DOUBLE) / 100)
         AS revenue_total_display
FROM {_sub(_report_sql('app_year'))} r""")
def q_app_year_totals(spark, d):
    """Yearly totals of the month-only app report, US style."""
    return TO.app_year_totals(q_app_year_report(spark, d))


@register("report_totals", f"""
SELECT months, sessions, sum_monthly_users, avg_monthly_engagement_pct, revenue,
       translate(format('{{:,}}', sessions), ',', '.') AS sessions_display,
       translate(format('{{:,}}', sum_monthly_users), ',', '.') AS sum_monthly_users_display,
       format('{{:.2f}}', avg_monthly_engagement_pct) || '%' AS avg_monthly_engagement_pct_display,
       'R$ ' || translate(format('{{:,.2f}}', revenue), ',.', '.,') AS revenue_display
FROM {_sub(ORACLE_SQL['totals'])} t""")
def q_report_totals(spark, d):
    """R6 with the summary strings."""
    return TO.report_totals(q_organic_report(spark, d))


@register("sort_calendar", f"""
SELECT month, {month_rank_sql('month')} AS calendar_rank FROM {_sub(_report_sql('app_year'))} r""")
def q_sort_calendar(spark, d):
    """O2: calendar rank of the month names (the report is sorted by it)."""
    return q_app_year_report(spark, d).select("month", D.month_rank("month").alias("calendar_rank"))


@register("scaffold", f"""
WITH {ORDERS_CTE},
cal AS (
  SELECT strftime(m, '%Y') AS year, strftime(m, '%m') AS month
  FROM (SELECT unnest(generate_series(DATE '1995-01-01', DATE '2001-12-01', INTERVAL 1 MONTH)) AS m)
),
g AS (
  SELECT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month,
         CAST(count(DISTINCT session_id) AS BIGINT) AS sessions, {REVENUE_SQL} AS revenue
  FROM ob WHERE {range_sql(ORDERS_SPAN)} AND platform = 'web' GROUP BY 1, 2
)
SELECT {month_name_sql('cal.month')} AS month, cal.year,
       coalesce(g.sessions, 0) AS sessions, coalesce(g.revenue, 0.0) AS revenue
FROM cal LEFT JOIN g ON cal.year = g.year AND cal.month = g.month""")
def q_scaffold(spark, d):
    """V4: the web report over whole years; months without orders get zeros."""
    return R.run_report(spark, R.web_spec(ORDERS_SPAN, fill_months=True), _orders(d))


# --------------------------------------------------------------------------
# Formats (T1–T7) and headings
# --------------------------------------------------------------------------

@register("fmt_int_br", f"""
SELECT month, year, translate(format('{{:,}}', sessions), ',', '.') AS sessions_br
FROM {_sub(_report_sql('web'))} r""")
def q_fmt_int_br(spark, d):
    """1.234.567."""
    return q_web_report(spark, d).select("month", "year", T.int_br("sessions").alias("sessions_br"))


@register("fmt_money_br", f"""
SELECT month, year, 'R$ ' || translate(format('{{:,.2f}}', revenue), ',.', '.,') AS revenue_br
FROM {_sub(_report_sql('web'))} r""")
def q_fmt_money_br(spark, d):
    """R$ 1.234.567,90."""
    return q_web_report(spark, d).select("month", "year", T.money_br("revenue").alias("revenue_br"))


@register("fmt_percent", f"""
SELECT month, year, format('{{:.2f}}', engagement_pct) || '%' AS engagement_pct_text
FROM {_sub(_report_sql('organic'))} r""")
def q_fmt_percent(spark, d):
    """75.50%."""
    return q_organic_report(spark, d).select("month", "year", T.percent("engagement_pct").alias("engagement_pct_text"))


@register("fmt_us", f"""
SELECT month, format('{{:,}}', app_users_total) AS users_us, 'R$ ' || format('{{:,.2f}}', app_revenue_total) AS revenue_us
FROM {_sub(_report_sql('app_year'))} r""")
def q_fmt_us(spark, d):
    """T4: 1,234 and R$ 1,234.50."""
    return q_app_year_report(spark, d).select(
        "month", T.int_us("app_users_total").alias("users_us"), T.money_us("app_revenue_total").alias("revenue_us"))


@register("row_line", f"""
SELECT month, month || '/' || year || ': ' || format('{{:,}}', app_users_total) || ' usuários | '
       || format('{{:,}}', app_sessions_total) || ' sessões | R$ ' || format('{{:,.2f}}', app_revenue_total) AS line
FROM {_sub(_report_sql('app_year'))} r""")
def q_row_line(spark, d):
    """T5: one text line per month."""
    r = q_app_year_report(spark, d)
    return r.select("month", T.row_line("month", "year", "app_users_total", "app_sessions_total",
                                        "app_revenue_total").alias("line"))


@register("display_format", f"""
SELECT month, year, sessions, active_users, engagement_pct, revenue,
       month AS month_display, year AS year_display,
       translate(format('{{:,}}', sessions), ',', '.') AS sessions_display,
       translate(format('{{:,}}', active_users), ',', '.') AS active_users_display,
       format('{{:.2f}}', engagement_pct) || '%' AS engagement_pct_display,
       'R$ ' || translate(format('{{:,.2f}}', revenue), ',.', '.,') AS revenue_display
FROM {_sub(_report_sql('organic'))} r""")
def q_display_format(spark, d):
    """Display strings chosen by heading (money / percent / count)."""
    return T.with_display(q_organic_report(spark, d), headings("organic"))


def _width_sql(kind: str, cols: list[tuple[str, str]]) -> str:
    parts = []
    for i, (c, typ) in enumerate(cols):
        h = HEADINGS[kind][c]
        if typ == "str":
            cell = f"CASE WHEN {c} IS NOT NULL AND {c} <> '' THEN length({c}) END"
        else:
            # a spreadsheet keeps a whole number without its fraction
            text = f"CASE WHEN {c} = floor({c}) THEN CAST(CAST({c} AS HUGEINT) AS VARCHAR) ELSE CAST({c} AS VARCHAR) END"
            cell = f"CASE WHEN {c} IS NOT NULL AND {c} <> 0 THEN length({text}) END"
        parts.append(f"SELECT '{c}' AS \"column\", '{h}' AS heading, "
                     f"CAST(least(greatest(coalesce(max({cell}), 0), length('{h}')) + 2, 30) AS INTEGER) AS width, "
                     f"{i} AS position FROM r")
    return " UNION ALL ".join(parts)


@register("display_width", f"""
WITH r AS {_sub(_report_sql('organic'))}
{_width_sql('organic', [('month', 'str'), ('year', 'str'), ('sessions', 'num'), ('active_users', 'num'),
                        ('engagement_pct', 'num'), ('revenue', 'num')])}""")
def q_display_width(spark, d):
    """Column widths — longest printed value or heading, + 2, at most 30."""
    return T.display_widths(q_organic_report(spark, d), headings("organic"))


def _labelled_sql() -> str:
    h = HEADINGS["web"]
    return (f"SELECT month AS \"{h['month']}\", year AS \"{h['year']}\", sessions AS \"{h['sessions']}\", "
            f"revenue AS \"{h['revenue']}\" FROM {_sub(_report_sql('web'))} r")


@register("labelled_report", _labelled_sql())
def q_labelled_report(spark, d):
    """The web report under its written headings."""
    return labelled(q_web_report(spark, d), "web")


# --------------------------------------------------------------------------
# Bundle (R5, K4) and sources
# --------------------------------------------------------------------------

def _bundle_sql() -> str:
    web = _report_sql("web")
    app = _report_sql("app")
    org = _report_sql("organic")
    return f"""
SELECT 'web' AS report, month, year, sessions, CAST(NULL AS BIGINT) AS active_users,
       CAST(NULL AS DOUBLE) AS engagement_pct, revenue FROM {_sub(web)} w
UNION ALL
SELECT 'app', month, year, sessions, active_users, CAST(NULL AS DOUBLE), revenue FROM {_sub(app)} a
UNION ALL
SELECT 'organic', month, year, sessions, active_users, engagement_pct, revenue FROM {_sub(org)} o"""


@register("bundle_long", _bundle_sql())
def q_bundle_long(spark, d):
    """R5 + K4: web, app and organic from one shared scan, as one long table."""
    return BU.run_bundle(spark, _orders(d), ORDERS_SPAN, persist=False).long


@register("bundle_tidy", f"""
SELECT report, month, year, metric, value FROM (
  UNPIVOT (SELECT report, month, year, CAST(sessions AS DOUBLE) AS sessions,
                  CAST(active_users AS DOUBLE) AS active_users, engagement_pct, revenue
           FROM {_sub(_bundle_sql())} b)
  ON sessions, active_users, engagement_pct, revenue INTO NAME metric VALUE value)""")
def q_bundle_tidy(spark, d):
    """K4 tidy form: one row per (report, month, metric)."""
    return BU.run_bundle(spark, _orders(d), ORDERS_SPAN, persist=False).tidy()


def _bundle_filled_sql() -> str:
    code = "strftime(m, '%m')"
    cal = (f"SELECT strftime(m, '%Y') AS year, {month_name_sql(code)} AS month "
           "FROM (SELECT unnest(generate_series(DATE '1995-01-01', DATE '2001-12-01', INTERVAL 1 MONTH)) AS m)")
    web, app, org = _report_sql("web"), _report_sql("app"), _report_sql("organic")
    return f"""
WITH cal AS ({cal}),
w AS {_sub(web)}, a AS {_sub(app)}, o AS {_sub(org)}
SELECT 'web' AS report, cal.month, cal.year, coalesce(w.sessions, 0) AS sessions,
       CAST(NULL AS BIGINT) AS active_users, CAST(NULL AS DOUBLE) AS engagement_pct,
       coalesce(w.revenue, 0.0) AS revenue
FROM cal LEFT JOIN w ON cal.year = w.year AND cal.month = w.month
UNION ALL
SELECT 'app', cal.month, cal.year, coalesce(a.sessions, 0), coalesce(a.active_users, 0), CAST(NULL AS DOUBLE),
       coalesce(a.revenue, 0.0)
FROM cal LEFT JOIN a ON cal.year = a.year AND cal.month = a.month
UNION ALL
SELECT 'organic', cal.month, cal.year, coalesce(o.sessions, 0), coalesce(o.active_users, 0), o.engagement_pct,
       coalesce(o.revenue, 0.0)
FROM cal LEFT JOIN o ON cal.year = o.year AND cal.month = o.month"""


@register("bundle_filled", _bundle_filled_sql())
def q_bundle_filled(spark, d):
    """R5 + V4: the bundle with every month of the range for every report."""
    return BU.run_bundle(spark, _orders(d), ORDERS_SPAN, persist=False, fill_months=True).long


@register("bundle_presence", f"""
WITH n AS (SELECT unnest(['web', 'app', 'organic', 'none']) AS report),
m AS (SELECT report, CAST(count(*) AS BIGINT) AS months FROM {_sub(_bundle_sql())} b GROUP BY 1)
SELECT n.report, m.months IS NOT NULL AS has_rows, coalesce(m.months, 0) AS months FROM n LEFT JOIN m USING (report)""")
def q_bundle_presence(spark, d):
    """V1/V2: which reports of a bundle have rows; one has a platform no hit carries."""
    none = ReportSpec(ECOMMERCE, ("sessions",), ORDERS_SPAN, filter=Exact("platform", "tablet"), name="none")
    specs = [R.web_spec(ORDERS_SPAN), R.app_spec(ORDERS_SPAN), R.organic_spec(ORDERS_SPAN), none]
    return BU.run_bundle(spark, _orders(d), ORDERS_SPAN, specs=specs, persist=False).presence()


@register("bundle_totals", f"""
SELECT report, CAST(count(*) AS BIGINT) AS months,
       CAST(sum(sessions) AS BIGINT) AS sessions,
       CAST(sum(active_users) AS BIGINT) AS sum_monthly_users,
       CAST(sum(CAST(floor(engagement_pct * 100 + 0.5) AS BIGINT)) AS DOUBLE) / (count(engagement_pct) * 100.0)
         AS avg_monthly_engagement_pct,
       CAST(sum(CAST(floor(revenue * 100 + 0.5) AS BIGINT)) AS DOUBLE) / 100 AS revenue
FROM {_sub(_bundle_sql())} b GROUP BY report""")
def q_bundle_totals(spark, d):
    """R6 per report of the bundle (the run summary)."""
    return TO.report_totals(q_bundle_long(spark, d), by=("report",), display=False)


@register("property_rows", f"""
WITH {ORDERS_CTE}
SELECT platform, channel, CAST(count(*) AS BIGINT) AS n_rows,
       CAST(count(DISTINCT user_id) AS BIGINT) AS users,
       CAST(sum(CASE WHEN engaged THEN 1 ELSE 0 END) AS BIGINT) AS engaged_rows,
       {REVENUE_SQL} AS revenue
FROM ob GROUP BY 1, 2""")
def q_property_rows(spark, d):
    """The second property (by key) and its contract columns, whole table."""
    ev = _orders(d)[SECOND].frame(spark, {"user_id", "platform", "channel", "engaged", "revenue"})
    return ev.groupBy("platform", "channel").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("user_id").alias("users"),
        F.sum(F.col("engaged").cast("long")).alias("engaged_rows"),
        rounded(F.sum(money("revenue"))).alias("revenue"))


@register("typed_rows", _report_sql("app"))
def q_typed_rows(spark, d):
    """Report rows as text (the wire form of a remote report), loaded
    back into the report's fixed schema with checked casts."""
    app = q_app_report(spark, d)
    wire = app.select(*[F.col(c).cast("string").alias(c) for c in app.columns])
    return typed.conform(wire, typed.REPORT_SCHEMAS["app"])


# --------------------------------------------------------------------------
# Sessions (X1, X2, P4) on the events binding — whole table
# --------------------------------------------------------------------------

_TS_FMT_SQL = "'%Y-%m-%d %H:%M:%S.%f'"


def _events_frame(spark, d, cols):
    return _events(d)["events"].frame(spark, set(cols) | {"ts"})


@register("sessionize", f"""
WITH {EVENTS_CTE}
SELECT user_id, session_id, strftime(min(ts), {_TS_FMT_SQL}) AS session_start,
       strftime(max(ts), {_TS_FMT_SQL}) AS session_end, CAST(count(*) AS BIGINT) AS n_events,
       min(session_channel) AS session_channel
FROM eb WHERE user_id IS NOT NULL GROUP BY user_id, session_id""")
def q_sessionize(spark, d):
    """X1 + P4: one row per session (gap 30 min), from bucket rows only."""
    ev = _events_frame(spark, d, {"event_id", "user_id", "channel"})
    s = X.sessions_table(ev, with_channel=True)
    return s.select("user_id", "session_id",
                    D.ts_text("session_start").alias("session_start"),
                    D.ts_text("session_end").alias("session_end"),
                    F.col("n_events").cast("long").alias("n_events"), "session_channel")


@register("session_events", f"""
WITH {EVENTS_CTE}
SELECT event_id, user_id, session_id, session_channel FROM eb""")
def q_session_events(spark, d):
    """X1 at event level: every event with its session (equi-join on
    (user, bucket) with the session map)."""
    ev = _events_frame(spark, d, {"event_id", "user_id", "channel"})
    return X.assign_sessions(ev, with_channel=True).select("event_id", "user_id", "session_id", "session_channel")


@register("session_rollup", f"""
WITH {EVENTS_CTE}
SELECT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, user_id, session_id,
       CAST(max(CASE WHEN engaged THEN 1 ELSE 0 END) AS INTEGER) AS engaged,
       CAST(sum(CAST(revenue AS DECIMAL(38, 6))) AS DOUBLE) AS revenue
FROM eb WHERE user_id IS NOT NULL GROUP BY 1, 2, 3, 4""")
def q_session_rollup(spark, d):
    """Events rolled up to one row per (year, month, session)."""
    ev = _events_frame(spark, d, {"user_id", "engaged", "revenue"})
    return X.session_rollup(ev).select("year", "month", "user_id", "session_id", "engaged", F.col("revenue_amount").cast("double").alias("revenue"))


@register("session_channel", f"""
WITH {EVENTS_CTE},
s AS (SELECT DISTINCT user_id, session_id, session_channel FROM eb WHERE user_id IS NOT NULL)
SELECT session_channel, CAST(count(*) AS BIGINT) AS sessions FROM s GROUP BY 1""")
def q_session_channel(spark, d):
    """Sessions by their session-scope channel (first non-null channel)."""
    ev = _events_frame(spark, d, {"event_id", "user_id", "channel"})
    m = X.session_map(ev, with_channel=True)
    return (m.select("user_id", "session_id", "session_channel").distinct()
            .groupBy("session_channel").agg(F.count(F.lit(1)).alias("sessions")))


@register("bundle_long_events", f"""
SELECT 'web' AS report, month, year, sessions, CAST(NULL AS BIGINT) AS active_users,
       CAST(NULL AS DOUBLE) AS engagement_pct, revenue FROM {_sub(ORACLE_SQL['web_report_events'])} w
UNION ALL
SELECT 'app', month, year, sessions, active_users, CAST(NULL AS DOUBLE), revenue
FROM {_sub(ORACLE_SQL['app_report_events'])} a
UNION ALL
SELECT 'organic', month, year, sessions, active_users, engagement_pct, revenue
FROM {_sub(ORACLE_SQL['organic_report_events'])} o""")
def q_bundle_long_events(spark, d):
    """R5 on the sessionized events: one session map and one tagged scan for
    all three reports."""
    return BU.run_bundle(spark, _events(d), EVENTS_SPAN, persist=False).long


# --------------------------------------------------------------------------
# Streaming operator (run here in batch form over the whole table; the
# streaming run is in the tests)
# --------------------------------------------------------------------------


@register("session_rows", f"""
WITH {EVENTS_CTE}
SELECT user_id, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, CAST(count(*) AS BIGINT) AS n_events,
       strftime(min(ts), {_TS_FMT_SQL}) AS session_start, strftime(max(ts), {_TS_FMT_SQL}) AS session_end,
       CAST(max(CASE WHEN engaged THEN 1 ELSE 0 END) AS INTEGER) AS engaged,
       CAST(sum(CAST(revenue AS DECIMAL(38, 6))) AS DOUBLE) AS revenue
FROM eb WHERE user_id IS NOT NULL GROUP BY user_id, session_id, 2, 3""")
def q_session_rows(spark, d):
    """Session parts per month as the streaming sessionizer emits them
    (session_window, gap 30 min)."""
    raw = spark.read.parquet(f"{d}/events.parquet")
    rows = ST.session_rows(events_contract(raw))
    return rows.select("user_id", "year", "month", "n_events",
                       D.ts_text("session_start").alias("session_start"),
                       D.ts_text("session_end").alias("session_end"),
                       "engaged", F.col("revenue_amount").cast("double").alias("revenue"))


@register("stream_session_parts", f"""
WITH {EVENTS_CTE}
SELECT user_id, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, CAST(count(*) AS BIGINT) AS n_events,
       strftime(min(ts), {_TS_FMT_SQL}) AS session_start, strftime(max(ts), {_TS_FMT_SQL}) AS session_end,
       CAST(max(CASE WHEN engaged THEN 1 ELSE 0 END) AS INTEGER) AS engaged,
       CAST(sum(CAST(revenue AS DECIMAL(38, 6))) AS DOUBLE) AS revenue, session_channel
FROM eb WHERE user_id IS NOT NULL GROUP BY user_id, session_id, session_channel, 2, 3""")
def q_stream_session_parts(spark, d):
    """The events table as a stream: closed sessions as the stream wrote them and
    those still open in its state."""
    base = f"{shared_dir(spark)}/almanac/{uuid.uuid4().hex}"
    out, ckpt = f"{base}/rows", f"{base}/state"
    stream = ST.read_event_stream(spark, f"{d}/events.parquet*", spark.read.parquet(f"{d}/events.parquet").schema)   # a file or a folder
    q = SF.write_session_parts(SF.session_parts(events_contract(stream)), out, ckpt)
    q.awaitTermination()                   # raises what the stream raised
    rows = SF.closed_parts(spark, out, ckpt).unionByName(SF.open_parts(spark, ckpt))
    return rows.select("user_id", "year", "month", "n_events", D.ts_text("session_start").alias("session_start"),
                       D.ts_text("session_end").alias("session_end"), "engaged",
                       F.col("revenue_amount").cast("double").alias("revenue"), "session_channel")


# --------------------------------------------------------------------------
# Stored sessions refreshed by day, and the summaries made from them
# --------------------------------------------------------------------------


def _refreshed_store(spark, d) -> tuple[str, str, list[ReportSpec]]:
    """A store of sessions and its summary under the shared folder: made from
    two days in three, the other days added late, in two refreshes."""
    base = f"{shared_dir(spark)}/almanac/{uuid.uuid4().hex}"
    store, path = f"{base}/sessions", f"{base}/summary"
    whole = _events(d)["events"]
    specs = [R.web_spec(EVENTS_SPAN), R.app_spec(EVENTS_SPAN), R.organic_spec(EVENTS_SPAN)]
    days = sorted(r[0] for r in whole.frame(spark, {"ts"}).select(F.to_date("ts")).where("ts IS NOT NULL").distinct().collect())
    late = [days[1::6], days[4::6]]

    def without(missing: list[dt.date]) -> BI.Binding:
        def build(spark_, need):
            return whole.build(spark_, need).where(~F.to_date("ts").isin(*missing) | F.col("ts").isNull())
        return BI.Binding("arrived", build, session_ids=False, session_gap=whole.session_gap)

    SS.make_store(spark, without(late[0] + late[1]) if late[0] else whole, store)
    SU.make_summary(spark, store, path, specs)
    for k, part in enumerate(late):
        if part:
            SU.refresh_summary(spark, store, path, specs, SS.refresh_store(spark, without(late[1]) if k == 0 and late[1] else whole, store, part))
    return store, path, specs


@register("stored_sessions_refreshed", f"""
WITH {EVENTS_CTE}
SELECT event_id, user_id,
       CASE WHEN user_id IS NOT NULL THEN strftime(min(ts) OVER (PARTITION BY user_id, session_id), {_TS_FMT_SQL}) END AS session_start,
       session_channel FROM eb""")
def q_stored_sessions_refreshed(spark, d):
    """X1 stored and refreshed by day, a third of the days late: every event with its session."""
    store, _, _ = _refreshed_store(spark, d)
    ev = spark.read.parquet(SS.events_path(store))
    # the session id is its start in microseconds of the zone-free clock
    start = F.lit(dt.datetime(1970, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(secs=(F.col("session_id") / 1_000_000).cast("decimal(18,6)"))
    return ev.select("event_id", "user_id", start.alias("start"), "session_channel").select(
        "event_id", "user_id", D.ts_text("start").alias("session_start"), "session_channel")


@register("range_users", f"""
WITH {EVENTS_CTE}
SELECT 'web' AS report, CAST(count(DISTINCT user_id) FILTER (platform = 'web') AS BIGINT) AS active_users, true AS sketch_in_bound FROM eb
UNION ALL
SELECT 'app', CAST(count(DISTINCT user_id) FILTER (platform IN ('Android', 'iOS')) AS BIGINT), true FROM eb
UNION ALL
SELECT 'organic', CAST(count(DISTINCT user_id) FILTER (session_channel = 'Organic Search') AS BIGINT), true FROM eb""")
def q_range_users(spark, d):
    """A4 over the whole range from daily bitmaps (exact) and sketches (inside
    their stated error); no event is read."""
    store, path, specs = _refreshed_store(spark, d)
    out = None
    for sp in specs:
        near = SU.users_between(spark, store, path, sp, approx=True).withColumnRenamed("active_users", "near")
        one = SU.users_between(spark, store, path, sp).join(near, "report").select(
            "report", "active_users", (F.abs(F.col("near") - F.col("active_users")) <= SU.sketch_error() * F.col("active_users")).alias("sketch_in_bound"))
        out = one if out is None else out.unionByName(one)
    return out


@register("bundle_long_summary", ORACLE_SQL["bundle_long_events"])
def q_bundle_long_summary(spark, d):
    """R1–R3 from daily summaries that were refreshed with late days."""
    store, path, specs = _refreshed_store(spark, d)
    out = None
    for sp in specs:
        one = SU.report_from_summary(spark, store, path, sp, rate_as_percent=True).withColumn("report", F.lit(sp.name))
        for name, kind in (("active_users", "bigint"), ("engagement_pct", "double")):
            if name not in one.columns:
                one = one.withColumn(name, F.lit(None).cast(kind))
        one = one.select("report", "month", "year", "sessions", "active_users", "engagement_pct", "revenue")
        out = one if out is None else out.unionByName(one)
    return out


# --------------------------------------------------------------------------
# Sessions by blocks of time: tasks that do not grow with a user's history.
# Days here (a month by default), so that sessions of these tables cross them.
# --------------------------------------------------------------------------

BLOCK = dt.timedelta(days=1)


@register("session_events_blocks", ORACLE_SQL["stored_sessions_refreshed"])
def q_session_events_blocks(spark, d):
    """X1 at event level by the two-level scan: every event with its session."""
    ev = _events_frame(spark, d, {"event_id", "user_id", "channel"})
    s = X.assign_sessions(ev, with_channel=True, with_start=True, block=BLOCK)
    return s.select("event_id", "user_id", D.ts_text("session_start").alias("session_start"), "session_channel")


@register("organic_report_events_blocks", ORACLE_SQL["organic_report_events"])
def q_organic_report_events_blocks(spark, d):
    """R3 over sessions made by the two-level scan."""
    b = dataclasses.replace(_events(d)["events"], session_block=BLOCK)
    return R.organic_report(spark, b, EVENTS_SPAN, prop="x")
