"""R8 ``run_report``: compile a ReportSpec into one DataFrame plan, and the
ready-made reports R1–R4 built on it.

Plan shape (all lazy; Catalyst sees one plan per report, or one per
binding for a bundle of reports):

    Binding.frame (only the contract columns the specs read)
      -> date range + filter                   (pushed into the Parquet scan)
      -> tag rows with the reports they pass   (one scan for several reports)
      -> aggregation levels                    (operators.metrics)
      -> [calendar scaffold]                   (operators.scaffold)
      -> sort on codes, then month names

For a table without session ids the middle is different: one hash aggregate
reduces events to (user, bucket, day, filter fields) rows, a window per user
marks sessions on them (operators.sessions), and the filters apply after it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dims
from ..operators import filters, metrics, sessions
from ..operators.scaffold import complete_months
from ..sources.bindings import Binding
from ..sources.properties import ECOMMERCE, SECOND
from .spec import DIMENSIONS, AnyOf, DateRange, Exact, ReportSpec, filter_fields

# Filter fields whose value belongs to the session rather than the event.
SESSION_FIELDS = {"sessionDefaultChannelGroup"}


def _binding(registry: Mapping[str, Binding] | Binding, prop: str) -> Binding:
    return registry if isinstance(registry, Binding) else registry[prop]


def _resolver(channel_col: str = "session_channel"):
    """Filter field → Column.  ``year``/``month`` are integers while rows are
    aggregated; a filter on them compares their text codes."""
    def resolve(field: str) -> Column:
        return {
            "platform": F.col("platform"),
            "sessionDefaultChannelGroup": F.col(channel_col),
            "month": dims.code("month", 2),
            "year": dims.code("year", 4),
        }[field]
    return resolve


def _codes(counts: DataFrame) -> DataFrame:
    """Integer year/month keys → the text codes of the result (after the
    aggregation, so once per result row rather than once per event)."""
    fix = {}
    if "year" in counts.columns:
        fix["year"] = dims.code("year", 4)
    if "month" in counts.columns:
        fix["month"] = dims.code("month", 2)
    return counts.withColumns(fix)


# Contract column behind each filter field.
FIELD_COLUMN = {"platform": "platform", "sessionDefaultChannelGroup": "channel"}


def _source_leaf(b: Binding, columns: Sequence[str]):
    """Filter leaves on a field derived by a code table become predicates on
    the source column (pushable), when the rows still carry it."""
    def leaf(field: str, values: list, case_sensitive: bool):
        col = FIELD_COLUMN.get(field)
        cm = b.code_map(col) if col else None
        if cm is None or f"_src_{col}" not in columns:
            return None
        return cm.predicate(values, F.col(f"_src_{col}"), case_sensitive)
    return leaf


def _in_range(rng: DateRange, ts_type, columns: Sequence[str]) -> Column:
    """F1 on ``ts``; when the binding has a date partition column, a range on
    it too, so whole partitions are pruned."""
    p = filters.date_range_predicate("ts", rng, ts_type)
    return p & _part_between(rng.start, rng.end) if "_part_date" in columns else p


def _part_between(start: dt.date, end: dt.date) -> Column:
    """Partition dates that may hold rows of these days.  The table's day may
    be another zone's than the session's, so a day more on both sides; ``ts``
    itself decides."""
    day = dt.timedelta(days=1)
    return F.col("_part_date").between(F.lit(start - day), F.lit(end + day))


def monthly_counts(spark: SparkSession, spec: ReportSpec,
                   registry: Mapping[str, Binding] | Binding) -> DataFrame:
    """Grouping keys (``year``?, ``month`` as codes) and the count columns of
    ``operators.metrics.aggregate_levels``.  No order, no names."""
    return shared_counts(spark, [spec], _binding(registry, spec.property)).drop("report")


def shared_counts(spark: SparkSession, specs: Sequence[ReportSpec], b: Binding) -> DataFrame:
    """Counts of several reports over one binding from **one scan**.

    Each row is tagged with the names of the reports whose date range and
    filter it passes, the tags are exploded (a row passing two overlapping
    filters is counted for both), and ``report`` becomes the first grouping
    key.  The scan gets the OR of the reports' predicates, which Catalyst
    factors and pushes down.  All specs must share their dimensions.
    """
    specs = list(specs)
    names = [sp.name for sp in specs]
    if len(set(names)) != len(names):
        raise ValueError(f"report names must differ: {names}")
    dims_ = {sp.dimensions for sp in specs}
    if len(dims_) != 1:
        raise ValueError("reports sharing a scan must have the same dimensions")
    keys = ["report"] + [k for k in ("year", "month") if k in specs[0].dimensions]
    all_metrics = tuple(dict.fromkeys(m for sp in specs for m in sp.metrics))
    if b.closed_before is not None:
        for sp in specs:
            if sp.date_range.end >= b.closed_before:
                raise ValueError(f"report {sp.name!r} reaches {sp.date_range.end}, but {b.name!r} is complete only before {b.closed_before}")
    approx_set = {sp.approx_users for sp in specs}
    if len(approx_set) != 1:
        raise ValueError("reports sharing a scan must agree on approx_users")
    approx = approx_set.pop()
    need = metrics.needs(all_metrics)
    fields = set().union(*(filter_fields(sp.filter) for sp in specs))
    by_session = need["sessions"] or bool(fields & SESSION_FIELDS)
    make_sessions = by_session and not b.session_ids

    cols = {"ts", "user_id", "engaged", "revenue"}
    if "platform" in fields:
        cols.add("platform")
    if "sessionDefaultChannelGroup" in fields:
        cols.add("channel")
    if by_session and b.session_ids:
        cols.add("session_id")
    if make_sessions:
        cols.add("event_id")
    ev = b.frame(spark, cols)
    ts_type = ev.schema["ts"].dataType
    # Group on integer year and month; text codes come after the aggregation.
    with_dims = {"year": F.year("ts"), "month": F.month("ts"), "revenue_amount": metrics.money("revenue")}

    def tag(rows: DataFrame, preds: list[tuple[str, Column]]) -> DataFrame:
        """Keep rows passing any report's predicate; ``report`` = each name it passes."""
        rows = rows.where(reduce(lambda x, y: x | y, [p for _, p in preds]))
        if len(preds) == 1:
            return rows.withColumn("report", F.lit(preds[0][0]))
        # explode the array of CASE WHENs and drop the NULL tags: unlike a
        # filter() lambda on the array, this stays in whole-stage codegen
        tags = F.array(*[F.when(p, F.lit(n)) for n, p in preds])
        return rows.withColumn("report", F.explode(tags)).where(F.col("report").isNotNull())

    if not make_sessions:
        rows = ev.withColumnRenamed("channel", "session_channel") if "channel" in cols else ev
        rows = rows.withColumns(with_dims)
        leaf = _source_leaf(b, rows.columns)
        preds = []
        for sp in specs:
            p = _in_range(sp.date_range, ts_type, rows.columns)
            f = filters.compile_filter(sp.filter, _resolver(), leaf)
            preds.append((sp.name, p if f is None else p & f))
        rows = tag(rows, preds)
        counts_users = [sp.name for sp in specs if "activeUsers" in sp.metrics]
        if b.rows_are_sessions and 0 < len(counts_users) < len(specs):
            # Reports that count no users fold to a row a month in the map-side step.
            rows = rows.withColumn("user_id", F.when(F.col("report").isin(*counts_users), F.col("user_id")))
        if "session_id" not in rows.columns:
            rows = rows.withColumn("session_id", F.lit(None).cast("long"))
        return _codes(metrics.aggregate_levels(rows, keys, all_metrics, b.rows_are_sessions, approx))

    # Sessions by gap: raw events pass exactly one hash aggregate (per part of
    # the table read, see below) and are never joined.
    #
    # Raw events are reduced to G: one row per (user, bucket, day, event-level
    # filter fields[, channel]).  A window per user over G rows marks the
    # buckets that start a session and gives every row its session (and the
    # session-scope channel); the reports' day ranges and filters then apply
    # to those rows.  Everything after the first aggregate works on reduced
    # rows, and nothing joins back.
    #
    # Which events to read: whether two events of the range share a session
    # depends only on the events between them, which are in the range too;
    # so without a session-scope field the range alone is read.  The
    # session-scope channel is the first one known in the session, which may
    # lie before the range, or after it when the events before carry none.
    # Only users with an event within the gap of a border can have a session
    # across it: the earlier and later events of those users (found in the
    # days next to the border) are read as well, and only the four columns that
    # place them in sessions (user, ts, event id, channel).
    with_channel = "channel" in cols
    first = min((sp.date_range for sp in specs), key=lambda r: r.start)
    last = max((sp.date_range for sp in specs), key=lambda r: r.end)
    span = DateRange(first.start, last.end)
    usable = F.col("user_id").isNotNull()
    within = ev.where(_in_range(span, ts_type, ev.columns))
    recent = within.where(usable)
    recent = sessions.with_bucket(recent, b.session_gap).withColumns({
        "event_date": F.to_date("ts"), "revenue_amount": metrics.money("revenue")})
    event_fields = sorted(fields - SESSION_FIELDS - set(DIMENSIONS))
    # Event-level filters cannot move below the sessionization (session
    # borders depend on all events), so their fields become keys of G.
    gkeys = ["user_id", "bucket", "event_date", *[FIELD_COLUMN[f] for f in event_fields]]
    gaggs = [F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
             F.max(F.col("engaged").cast("int")).alias("engaged"),
             F.sum("revenue_amount").alias("revenue_amount")]
    if with_channel:
        recent = recent.withColumn("order_key", sessions._order_key(recent, b.session_gap))
        gaggs.append(F.min("order_key").alias("order_key"))
        gkeys.append("channel")
    g = recent.groupBy(*gkeys).agg(*gaggs)
    if with_channel:
        for outside in _across_borders(ev.where(usable), span, ts_type, b.session_gap):
            outside = sessions.with_bucket(outside.select("user_id", "ts", "event_id", "channel"), b.session_gap)
            outside = outside.withColumn("order_key", sessions._order_key(outside, b.session_gap))
            # no event_date: these rows place sessions but never pass a report's range
            g = g.unionByName(outside.groupBy("user_id", "bucket", "channel").agg(
                F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.min("order_key").alias("order_key")),
                allowMissingColumns=True)
    rows = sessions.with_sessions(g, b.session_gap, b.session_block, with_channel)
    # An event without a user belongs to no session; its revenue counts.  These
    # rows stay out of the user window (one partition would hold them all).
    alone = (within.where(~usable).withColumns({"event_date": F.to_date("ts"), "revenue_amount": metrics.money("revenue")})
             .groupBy("event_date", *[FIELD_COLUMN[f] for f in event_fields])
             .agg(F.sum("revenue_amount").alias("revenue_amount")))
    rows = rows.unionByName(alone, allowMissingColumns=True)

    rows = rows.withColumns({"year": F.year("event_date"), "month": F.month("event_date")})
    pre, post = [], []
    for sp in specs:
        p = F.col("event_date").between(F.lit(sp.date_range.start), F.lit(sp.date_range.end))
        if filter_fields(sp.filter) & SESSION_FIELDS:
            pre.append((sp.name, p))  # the whole filter waits for the session channel
            post.append((sp.name, filters.compile_filter(sp.filter, _resolver())))
        else:
            f = filters.compile_filter(sp.filter, _resolver())
            pre.append((sp.name, p if f is None else p & f))
    rows = tag(rows, pre)
    if post:
        keep_rows = [(F.col("report") == F.lit(n)) & p for n, p in post]
        others = [n for n in names if n not in {n for n, _ in post}]
        if others:
            keep_rows.append(F.col("report").isin(*others))
        rows = rows.where(reduce(lambda x, y: x | y, keep_rows))
    return _codes(metrics.aggregate_levels(rows, keys, all_metrics, rows_are_sessions=False, approx_users=approx))


def _across_borders(ev: DataFrame, span: DateRange, ts_type, gap: dt.timedelta) -> list[DataFrame]:
    """The events before and after ``span`` of users who may have a session
    across that border: those with an event beyond it, within the gap of it.
    Exact whatever a session's length — it has such an event if it crosses."""
    start, end = filters.ts_literal(span.start, ts_type), filters.ts_literal(span.end_exclusive, ts_type)
    step = sessions._gap_interval(gap)
    days = gap + dt.timedelta(days=1)
    out = []
    for beyond, near, parts, near_parts in (
            (F.col("ts") < start, F.col("ts") >= start - step, (None, span.start), (span.start - days, span.start)),
            (F.col("ts") >= end, F.col("ts") <= end + step, (span.end, None), (span.end, span.end + days))):
        rows = ev.where(beyond)
        users = rows.where(near)
        if "_part_date" in ev.columns:
            low, high = parts
            bound = F.col("_part_date") >= F.lit(low - dt.timedelta(days=1)) if low else F.col("_part_date") <= F.lit(high + dt.timedelta(days=1))
            rows, users = rows.where(bound), users.where(_part_between(*near_parts))
        out.append(rows.join(users.select("user_id").distinct(), "user_id", "left_semi"))
    return out


def run_report(spark: SparkSession, spec: ReportSpec, registry: Mapping[str, Binding] | Binding,
               rate_as_percent: bool = False, month_names: str = "null") -> DataFrame:
    """The general report.  Columns: ``month``, ``year``, then the metric
    columns in request order (``sessions``, ``active_users``, ``revenue``,
    ``engagement_rate`` or ``engagement_pct``).

    ``month_names``: ``"null"`` maps codes to names with unknown codes as NULL
    (P5), ``"keep"`` keeps an unknown code (P6), ``"codes"`` leaves codes.
    Month+year reports are sorted by (year, month) codes before naming (O1);
    month-only reports by calendar rank of the name, unknown last (O2).
    """
    return finish_report(spark, monthly_counts(spark, spec, registry), spec, rate_as_percent, month_names)


def finish_report(spark: SparkSession, counts: DataFrame, spec: ReportSpec,
                  rate_as_percent: bool = False, month_names: str = "null") -> DataFrame:
    """Metric columns, calendar completion, order and month names on the
    counts of one report."""
    keys = [k for k in ("year", "month") if k in spec.dimensions]
    out = counts.select(*keys, *metrics.metric_columns(spec.metrics, rate_as_percent))
    if spec.fill_months:
        out = complete_months(spark, out, spec.date_range, keys)
    name = {"null": dims.month_name, "keep": dims.month_name_or_code}.get(month_names)
    metric_names = [c for c in out.columns if c not in keys]
    if "year" in keys:
        ordered = bounded_sort(out, "year", "month")
        month = name(F.col("month")) if name else F.col("month")
        return ordered.select(month.alias("month"), "year", *metric_names)
    month = name(F.col("month")) if name else F.col("month")
    label = spec.year_label or _year_label(spec.date_range)
    named = out.select(month.alias("month"), dims.constant(label).alias("year"), *metric_names)
    return sort_calendar(named)


def bounded_sort(df: DataFrame, *cols) -> DataFrame:
    """O1 for a result with one row per calendar month of the range (a bound
    set by the request, not the data): gathered into one partition and
    sorted there, which avoids the sampling job and range shuffle of a global
    ``orderBy``.

    ``repartition(1)``, not ``coalesce(1)``: coalesce is a narrow dependency
    and would pull the final aggregation itself into one task (which, on a
    large cluster, reads one partial aggregate per map task); the shuffle
    keeps that step parallel and moves only the result rows."""
    return df.repartition(1).sortWithinPartitions(*cols)


def sort_calendar(df: DataFrame, col: str = "month") -> DataFrame:
    """O2: order by calendar rank of the month name, unknown names last."""
    rank = dims.month_rank(F.col(col))
    return bounded_sort(df.withColumn("_rank", rank), F.asc_nulls_last("_rank")).drop("_rank")


def _year_label(rng: DateRange) -> str:
    a, b = rng.start.year, rng.end.year
    return f"{a}" if a == b else f"{a}-{b}"


# --------------------------------------------------------------------------
# Ready-made reports
# --------------------------------------------------------------------------

# The filters of the ready-made reports.
WEB_FILTER = Exact("platform", "web")
APP_FILTER = AnyOf(Exact("platform", "Android"), Exact("platform", "iOS"))
ORGANIC_FILTER = Exact("sessionDefaultChannelGroup", "Organic Search")


def web_spec(rng: DateRange, prop: str = ECOMMERCE, **kw) -> ReportSpec:
    return ReportSpec(prop, ("sessions", "totalRevenue"), rng, filter=WEB_FILTER, name="web", **kw)


def app_spec(rng: DateRange, prop: str = ECOMMERCE, **kw) -> ReportSpec:
    return ReportSpec(prop, ("activeUsers", "sessions", "totalRevenue"), rng, filter=APP_FILTER, name="app", **kw)


def organic_spec(rng: DateRange, prop: str = SECOND, **kw) -> ReportSpec:
    return ReportSpec(prop, ("sessions", "activeUsers", "engagementRate", "totalRevenue"), rng,
                      filter=ORGANIC_FILTER, name="organic", **kw)


def app_year_spec(rng: DateRange, prop: str = ECOMMERCE, **kw) -> ReportSpec:
    return ReportSpec(prop, ("activeUsers", "sessions", "totalRevenue"), rng, dimensions=("month",),
                      filter=APP_FILTER, name="app_year", **kw)


def web_report(spark, registry, rng: DateRange, **kw) -> DataFrame:
    """platform = web; month, year, sessions, revenue."""
    return run_report(spark, web_spec(rng, **kw), registry)


def app_report(spark, registry, rng: DateRange, **kw) -> DataFrame:
    """R2: platform Android or iOS; month, year, active_users, sessions, revenue."""
    return run_report(spark, app_spec(rng, **kw), registry)


def organic_report(spark, registry, rng: DateRange, **kw) -> DataFrame:
    """Session channel Organic Search; month, year, sessions,
    active_users, engagement_pct (2 decimals), revenue."""
    return run_report(spark, organic_spec(rng, **kw), registry, rate_as_percent=True)


def app_year_report(spark, registry, rng: DateRange, year_label: str | None = None, **kw) -> DataFrame:
    """R2's filter grouped by month only, a constant year label, calendar
    order.  Columns month, year, app_users_total, app_sessions_total,
    app_revenue_total."""
    spec = app_year_spec(rng, year_label=year_label, **kw)
    df = run_report(spark, spec, registry, month_names="keep")
    return df.select("month", "year",
                     F.col("active_users").alias("app_users_total"),
                     F.col("sessions").alias("app_sessions_total"),
                     F.col("revenue").alias("app_revenue_total"))


REPORTS = {"web": web_report, "app": app_report, "organic": organic_report}
