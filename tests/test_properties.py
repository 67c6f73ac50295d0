"""Randomized checks: the bucket sessionizer against the plain lag form, and
the filter compiler against a direct evaluation in Python."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import events_df

from almanac.operators import filters as FL
from almanac.operators import sessions as X
from almanac.plans.spec import AnyOf, Exact

T0 = dt.datetime(2025, 3, 31, 22, 0, 0)
# gaps around the 30-minute border, in microseconds
GAPS = st.sampled_from([0, 1, 59_999_999, 1_799_999_999, 1_800_000_000, 1_800_000_001, 3_600_000_000,
                        86_400_000_000]) | st.integers(0, 7_200_000_000)


@st.composite
def event_lists(draw):
    rows, eid = [], 0
    for user in range(draw(st.integers(1, 3))):
        t = T0 + dt.timedelta(microseconds=draw(st.integers(0, 3_600_000_000)))
        for _ in range(draw(st.integers(1, 12))):
            t += dt.timedelta(microseconds=draw(GAPS))
            rows.append((eid, t, user, None, "web", draw(st.sampled_from([None, "A", "B"])), False, None))
            eid += 1
    return rows


def _lag_sessions(df, gap_s):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    prev = F.lag("ts").over(w)
    start = prev.isNull() | (F.col("ts") > prev + F.make_dt_interval(secs=F.lit(gap_s)))
    df = df.withColumn("sid", F.sum(start.cast("long")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    ws = (Window.partitionBy("user_id", "sid").orderBy("ts", "event_id")
          .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return df.withColumn("ch", F.first("channel", ignorenulls=True).over(ws))


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=event_lists(), gap_min=st.sampled_from([30, 7, 45]))
def test_bucket_sessions_equal_lag_form(spark, rows, gap_min):
    df = events_df(spark, rows)
    gap = dt.timedelta(minutes=gap_min)
    ours = X.assign_sessions(df, gap, with_channel=True).select("event_id", "session_id", "session_channel")
    ref = _lag_sessions(df, gap_min * 60).select("event_id", "sid", "ch")
    assert sorted(tuple(r) for r in ours.collect()) == sorted(tuple(r) for r in ref.collect())


VALUES = ["web", "WEB", "Android", "iOS", "", None]
LEAVES = st.builds(Exact, st.just("platform"), st.sampled_from(["web", "WEB", "Android", "iOS", ""]),
                   st.booleans())
TREES = st.recursive(LEAVES, lambda inner: st.lists(inner, min_size=1, max_size=3).map(lambda xs: AnyOf(*xs)),
                     max_leaves=6)


def _py_eval(expr, value):
    if isinstance(expr, Exact):
        if value is None:
            return None
        return value == expr.value if expr.case_sensitive else value.lower() == expr.value.lower()
    results = [_py_eval(e, value) for e in expr.expressions]
    if any(r is True for r in results):
        return True
    return None if any(r is None for r in results) else False


@settings(max_examples=30, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(tree=TREES)
def test_filter_tree_matches_python(spark, tree):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(VALUES)], "i int, platform string")
    got = {r.i for r in FL.where_filter(df, tree, lambda f: F.col("platform")).collect()}
    want = {i for i, v in enumerate(VALUES) if _py_eval(tree, v) is True}
    assert got == want


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=event_lists(), gap_min=st.sampled_from([30, 45]), engaged_mod=st.integers(1, 4))
def test_report_sessions_equal_lag_form(spark, rows, gap_min, engaged_mod):
    """Monthly sessions, users and engaged sessions of the compiled report
    (one aggregate + user window, buckets split by day) equal the lag form."""
    from almanac.plans import report as R
    from almanac.plans.spec import DateRange, ReportSpec
    from conftest import binding_of
    rows = [(r[0], r[1], r[2], None, "web" if r[0] % 2 else "iOS", r[5], r[0] % engaged_mod == 0, None)
            for r in rows]
    df = events_df(spark, rows)
    b = binding_of(df, session_ids=False, session_gap=dt.timedelta(minutes=gap_min))
    spec = ReportSpec("x", ("sessions", "activeUsers", "engagementRate"), DateRange("2025-01-01", "2025-12-31"),
                      filter=Exact("platform", "web"))
    got = sorted((r.year, r.month, r.sessions, r.active_users, r.engagement_rate)
                 for r in R.run_report(spark, spec, b, month_names="codes").collect())
    ref = _lag_sessions(df, gap_min * 60).where("platform = 'web'").withColumns(
        {"year": F.date_format("ts", "yyyy"), "month": F.date_format("ts", "MM")})
    ref = ref.groupBy("year", "month").agg(
        F.countDistinct("user_id", "sid").alias("s"), F.countDistinct("user_id").alias("u"),
        F.countDistinct(F.when(F.col("engaged"), F.struct("user_id", "sid"))).alias("e"))
    want = sorted((r.year, r.month, r.s, r.u, r.e / r.s) for r in ref.collect())
    assert got == want


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.one_of(
    st.floats(min_value=-1e12, max_value=1e12, allow_nan=False, allow_infinity=False),
    st.integers(-10**9, 10**9).map(lambda c: c / 100),            # whole cents
    st.integers(-10**6, 10**6).map(lambda c: c / 1000 + 0.0005),   # near ties at the cent
    st.sampled_from([0.0, -0.0, 0.125, 2.675, 1.005, 1234567.895, -1234.5, 0.5, 1.5, 2.5])),
    min_size=40, max_size=60))
def test_number_formats_match_python(spark, values):
    from almanac.functions import fmt as T
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
    rows = df.select("i", T.int_br("x").alias("a"), T.money_br("x").alias("b"), T.percent("x").alias("c"),
                     T.int_us("x").alias("d"), T.money_us("x").alias("e")).collect()
    for r in rows:
        v = values[r.i]
        assert r.d == f"{v:,.0f}", v
        assert r.a == f"{v:,.0f}".replace(",", "."), v
        assert r.e == "R$ " + f"{v:,.2f}", v
        assert r.b == "R$ " + f"{v:,.2f}".replace(",", "X").replace(".", ",").replace("X", "."), v
        assert r.c == f"{v:.2f}%", v


# ---------------------------------------------------------------------------
# Random report specs on the orders tables against DuckDB SQL built from the
# same spec (a test oracle: direct count(DISTINCT ...) over a CASE-mapped view).
# ---------------------------------------------------------------------------

FIELD_SQL = {"platform": "platform", "sessionDefaultChannelGroup": "channel"}
FIELD_VALUES = {"platform": ["web", "Android", "iOS", "WEB", "ios", "Desktop"],
                "sessionDefaultChannelGroup": ["Organic Search", "Other", "organic search", "Paid"]}


@st.composite
def specs(draw):
    from almanac.plans.spec import DateRange, ReportSpec
    metrics = draw(st.lists(st.sampled_from(["sessions", "activeUsers", "totalRevenue", "engagementRate"]),
                            min_size=1, max_size=4, unique=True))
    start = dt.date(1995, 1, 1) + dt.timedelta(days=draw(st.integers(0, 2300)))
    end = start + dt.timedelta(days=draw(st.integers(0, 900)))
    leaf = st.builds(lambda f, i, cs: Exact(f, FIELD_VALUES[f][i % len(FIELD_VALUES[f])], cs),
                     st.sampled_from(list(FIELD_SQL)), st.integers(0, 5), st.booleans())
    tree = st.recursive(leaf, lambda inner: st.lists(inner, min_size=1, max_size=3).map(lambda xs: AnyOf(*xs)),
                        max_leaves=4)
    flt = draw(st.none() | tree)
    dims = draw(st.sampled_from([("month", "year"), ("month",)]))
    return ReportSpec("ecommerce", tuple(metrics), DateRange(start, end), dimensions=dims, filter=flt,
                      year_label="y")


def _sql_filter(expr):
    if isinstance(expr, Exact):
        col = FIELD_SQL[expr.field]
        v = expr.value.replace("'", "''")
        return f"{col} = '{v}'" if expr.case_sensitive else f"lower({col}) = lower('{v}')"
    return "(" + " OR ".join(_sql_filter(e) for e in expr.expressions) + ")"


def _spec_sql(spec):
    from almanac.catalog import ORDERS_CTE, REVENUE_SQL, pct_sql, range_sql
    cols = []
    for m in spec.metrics:
        cols.append({"sessions": "CAST(count(DISTINCT session_id) AS BIGINT) AS sessions",
                     "activeUsers": "CAST(count(DISTINCT user_id) AS BIGINT) AS active_users",
                     "totalRevenue": f"{REVENUE_SQL} AS revenue",
                     "engagementRate": "CASE WHEN count(DISTINCT session_id) > 0 THEN "
                                       "count(DISTINCT CASE WHEN engaged THEN session_id END) / "
                                       "count(DISTINCT session_id) END AS engagement_rate"}[m])
    where = range_sql(spec.date_range) + (f" AND {_sql_filter(spec.filter)}" if spec.filter else "")
    keys = ["strftime(ts, '%m') AS month"] + (["strftime(ts, '%Y') AS year"] if "year" in spec.dimensions else [])
    group = ", ".join(str(i + 1) for i in range(len(keys)))
    return f"WITH {ORDERS_CTE} SELECT {', '.join(keys + cols)} FROM ob WHERE {where} GROUP BY {group}"


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(spec=specs())
def test_random_specs_match_sql(spark, spec):
    import compare as C
    from almanac.plans import report as R
    from almanac.sources.properties import default_registry
    from conftest import SF01
    df = R.run_report(spark, spec, default_registry(SF01), month_names="codes")
    if "year" not in spec.dimensions:
        df = df.drop("year")
    got = [tuple(r) for r in df.collect()]
    con = _duck()
    res = con.execute(_spec_sql(spec))
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert C.rows_of(df.columns, got) == C.rows_of(dcols, res.fetchall())


_DUCK = {}


def _duck():
    import compare as C
    from conftest import SF01
    if "con" not in _DUCK:
        _DUCK["con"] = C.duck(SF01)
    return _DUCK["con"]


@st.composite
def event_specs(draw):
    from almanac.plans.spec import DateRange, ReportSpec
    metrics = draw(st.lists(st.sampled_from(["sessions", "activeUsers", "totalRevenue", "engagementRate"]),
                            min_size=1, max_size=4, unique=True))
    start = dt.date(2023, 12, 25) + dt.timedelta(days=draw(st.integers(0, 40)))
    end = start + dt.timedelta(days=draw(st.integers(0, 30)))
    leaf = st.builds(lambda f, i, cs: Exact(f, FIELD_VALUES[f][i % len(FIELD_VALUES[f])], cs),
                     st.sampled_from(list(FIELD_SQL)), st.integers(0, 5), st.booleans())
    tree = st.recursive(leaf, lambda inner: st.lists(inner, min_size=1, max_size=3).map(lambda xs: AnyOf(*xs)),
                        max_leaves=4)
    return ReportSpec("events", tuple(metrics), DateRange(start, end), filter=draw(st.none() | tree))


def _event_spec_sql(spec):
    from almanac.catalog import EVENTS_CTE, REVENUE_SQL, range_sql
    cols = []
    for m in spec.metrics:
        cols.append({"sessions": "CAST(count(DISTINCT skey) AS BIGINT) AS sessions",
                     "activeUsers": "CAST(count(DISTINCT user_id) AS BIGINT) AS active_users",
                     "totalRevenue": f"{REVENUE_SQL} AS revenue",
                     "engagementRate": "CASE WHEN count(DISTINCT skey) > 0 THEN "
                                       "count(DISTINCT CASE WHEN engaged THEN skey END) / "
                                       "count(DISTINCT skey) END AS engagement_rate"}[m])
    flt = _sql_filter(spec.filter).replace("channel", "session_channel") if spec.filter else None
    where = range_sql(spec.date_range) + (f" AND {flt}" if flt else "")
    return (f"WITH {EVENTS_CTE} SELECT strftime(ts, '%m') AS month, strftime(ts, '%Y') AS year, "
            f"{', '.join(cols)} FROM eb WHERE {where} GROUP BY 1, 2")


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(spec=event_specs())
def test_random_event_specs_match_sql(spark, spec):
    """Sessions by gap, session-scope channel and event-level platform in one
    filter tree, random ranges (sessions reaching back before them)."""
    import compare as C
    from almanac.plans import report as R
    from almanac.sources.properties import events_registry
    from conftest import SF01
    df = R.run_report(spark, spec, events_registry(SF01), month_names="codes")
    got = [tuple(r) for r in df.collect()]
    res = _duck().execute(_event_spec_sql(spec))
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert C.rows_of(df.columns, got) == C.rows_of(dcols, res.fetchall())


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(picked=st.lists(st.tuples(specs(), event_specs()), min_size=2, max_size=3), on_events=st.booleans())
def test_random_bundles_equal_separate_reports(spark, picked, on_events):
    """A bundle of random (possibly overlapping) month+year specs over one
    binding — one shared scan — gives each report exactly as it runs alone."""
    import dataclasses
    from almanac.plans import bundle as BU
    from almanac.plans import report as R
    from almanac.sources.properties import default_registry, events_registry
    from conftest import SF01
    reg = events_registry(SF01) if on_events else default_registry(SF01)
    chosen = [(ev if on_events else o) for o, ev in picked]
    specs_ = [dataclasses.replace(sp, name=f"r{i}", dimensions=("month", "year"), property="ecommerce")
              for i, sp in enumerate(chosen)]
    b = BU.run_bundle(spark, reg, specs_[0].date_range, specs=specs_, persist=False)
    long = {(r.report, r.year, r.month): r for r in b.long.collect()}
    for sp in specs_:
        alone = R.run_report(spark, sp, reg, rate_as_percent=True).collect()
        assert len(alone) == sum(1 for k in long if k[0] == sp.name)
        for r in alone:
            row = long[(sp.name, r.year, r.month)]
            for c in ("sessions", "active_users", "engagement_pct", "revenue"):
                if c in r.asDict():
                    assert row[c] == r[c], (sp, c)

