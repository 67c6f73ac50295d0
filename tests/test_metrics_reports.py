"""A1–A10, R1–R8, V4 on hand-made tables (FIXTURES.md §5) and invariants."""

import pytest
from pyspark.sql import functions as F

from conftest import SF01, binding_of, events_df, plan_of

from almanac.operators import totals as TO
from almanac.operators.metrics import aggregate_levels, money
from almanac.plans import report as R
from almanac.plans.spec import DateRange, Exact, ReportSpec
from almanac.sources.properties import default_registry

Y25 = DateRange("2025-01-01", "2025-12-31")


def two_months_one_user(spark):
    return events_df(spark, [
        (1, "2025-01-10 10:00:00", 7, 1, "iOS", "Other", True, 10.0),
        (2, "2025-01-20 10:00:00", 7, 2, "iOS", "Other", False, 5.5),
        (3, "2025-02-10 10:00:00", 7, 3, "Android", "Other", True, None),
        (4, "2025-02-10 10:05:00", 7, 3, "Android", "Other", False, 1.25),
    ])


def test_app_report_and_monthly_users_add_up(spark):
    b = binding_of(two_months_one_user(spark))
    rep = R.app_report(spark, b, Y25, prop="x")
    rows = [tuple(r) for r in rep.collect()]
    assert rows == [("janeiro", "2025", 1, 2, 15.5), ("fevereiro", "2025", 1, 1, 1.25)]
    tot = TO.report_totals(rep).first()
    assert tot.months == 2 and tot.sum_monthly_users == 2 and tot.sessions == 3   # A8: monthly users add up
    assert tot.revenue == 16.75 and tot.revenue_display == "R$ 16,75"
    # the true distinct count over the period is 1
    spec = ReportSpec("x", ("activeUsers",), Y25, dimensions=("month",), year_label="2025")
    assert R.run_report(spark, spec, b).agg(F.sum("active_users")).first()[0] == 2


def test_two_years_fall_together_month_only(spark):
    df = events_df(spark, [
        (1, "2024-01-10 10:00:00", 1, 1, "iOS", "Other", True, 1.0),
        (2, "2025-01-10 10:00:00", 2, 2, "iOS", "Other", True, 2.0),
        (3, "2025-01-11 10:00:00", 1, 3, "Android", "Other", True, 4.0),
        (4, "2025-03-11 10:00:00", 1, 4, "web", "Other", True, 8.0),
    ])
    b = binding_of(df)
    rep = R.app_year_report(spark, b, DateRange("2024-01-01", "2025-12-31"), prop="x")
    assert [tuple(r) for r in rep.collect()] == [("janeiro", "2024-2025", 2, 3, 7.0)]
    rep2 = R.app_report(spark, b, DateRange("2024-01-01", "2025-12-31"), prop="x")
    assert [(r.month, r.year, r.sessions) for r in rep2.collect()] == [("janeiro", "2024", 1), ("janeiro", "2025", 2)]


def test_engagement_and_zero_sessions(spark):
    df = events_df(spark, [
        (1, "2025-05-01 10:00:00", 1, 1, "web", "Organic Search", True, None),
        (2, "2025-05-01 10:01:00", 1, 1, "web", "Organic Search", False, None),
        (3, "2025-05-02 10:00:00", 2, 2, "web", "Organic Search", False, None),
        (4, "2025-05-03 10:00:00", 3, 3, "web", "Organic Search", False, None),
        (5, "2025-06-03 10:00:00", 3, None, "web", "Organic Search", True, 3.0),  # no session id
    ])
    rep = R.organic_report(spark, binding_of(df), Y25, prop="x")
    rows = {r.month: r for r in rep.collect()}
    assert rows["maio"].sessions == 3 and rows["maio"].engagement_pct == 33.33
    assert rows["maio"].revenue == 0.0                       # no revenue → 0
    assert rows["junho"].sessions == 0 and rows["junho"].engagement_pct is None
    assert rows["junho"].active_users == 1


def test_no_rows_keeps_schema(spark):
    b = binding_of(two_months_one_user(spark))
    rep = R.organic_report(spark, b, DateRange("2030-01-01", "2030-12-31"), prop="x")
    assert rep.isEmpty()
    assert rep.columns == ["month", "year", "sessions", "active_users", "engagement_pct", "revenue"]
    assert [f.dataType.simpleString() for f in rep.schema.fields] == [
        "string", "string", "bigint", "bigint", "double", "double"]


def test_scaffold_adds_only_zero_rows(spark):
    b = binding_of(two_months_one_user(spark))
    plain = R.web_report(spark, b, Y25, prop="x")
    full = R.run_report(spark, R.web_spec(Y25, prop="x", fill_months=True), b)
    rows = full.collect()
    assert [r.month for r in rows][:3] == ["janeiro", "fevereiro", "março"] and len(rows) == 12
    extra = full.subtract(plain).collect()
    assert all(r.sessions == 0 and r.revenue == 0.0 for r in extra) and len(extra) == 12 - plain.count()


def test_levels_equal_direct_distinct_counts(spark):
    """X2 path = count(DISTINCT ...) path, and its plan has no Expand."""
    ev = default_registry(SF01)["ecommerce"].frame(spark, {"user_id", "session_id", "engaged", "revenue"})
    ev = ev.withColumns({"y": F.year("ts"), "revenue_amount": money("revenue")})
    lv = aggregate_levels(ev, ["y"], ["sessions", "activeUsers", "engagementRate", "totalRevenue"])
    direct = ev.groupBy("y").agg(
        F.countDistinct("session_id").alias("sessions"), F.countDistinct("user_id").alias("active_users"),
        F.countDistinct(F.when(F.col("engaged"), F.col("session_id"))).alias("engaged_sessions"),
        F.sum("revenue_amount").alias("revenue_amount"))
    a = sorted(tuple(r) for r in lv.select("y", "sessions", "active_users", "engaged_sessions", "revenue_amount").collect())
    b = sorted(tuple(r) for r in direct.select("y", "sessions", "active_users", "engaged_sessions", "revenue_amount").collect())
    assert a == b
    assert "Expand" not in plan_of(lv)
    assert "Expand" in plan_of(direct)


def test_rows_are_sessions_flag_matches_generic_path(spark):
    reg = default_registry(SF01)
    fast = R.app_report(spark, reg, DateRange("1996-01-01", "1997-12-31"))
    import dataclasses
    slow_b = dataclasses.replace(reg["ecommerce"], rows_are_sessions=False)
    slow = R.app_report(spark, slow_b, DateRange("1996-01-01", "1997-12-31"))
    assert fast.collect() == slow.collect()


def test_web_report_is_one_aggregation(spark):
    """Sessions + revenue on a binding whose rows are sessions: one hash
    shuffle (the month aggregate, final step parallel), then only the result
    rows are gathered into one partition for the sort — no range shuffle, no
    sampling job, no coalesce pulling the aggregate into one task."""
    df = R.web_report(spark, default_registry(SF01), DateRange("1997-01-01", "1997-12-31"))
    import re
    plan = plan_of(df)
    assert len(re.findall(r"^Arguments: hashpartitioning", plan, re.M)) == 1
    assert len(re.findall(r"^Arguments: SinglePartition", plan, re.M)) == 1
    assert "rangepartitioning" not in plan and "Coalesce" not in plan


def test_unknown_metric_and_dimension_rejected():
    with pytest.raises(ValueError):
        ReportSpec("x", ("pageViews",), Y25)
    with pytest.raises(ValueError):
        ReportSpec("x", ("sessions",), Y25, dimensions=("year",))
    with pytest.raises(ValueError):
        DateRange("2025-02-01", "2025-01-01")
    with pytest.raises(ValueError):
        Exact("country", "BR")


def test_unknown_property_is_clear_error(spark):
    with pytest.raises(KeyError, match="unknown property"):
        R.web_report(spark, default_registry(SF01), Y25, prop="nope")


def test_approx_users_close_to_exact_and_one_level_less(spark):
    import re
    reg = default_registry(SF01)
    rng = DateRange("1995-01-01", "2001-12-31")
    exact = R.run_report(spark, ReportSpec("ecommerce", ("activeUsers", "sessions"), rng), reg)
    approx_df = R.run_report(spark, ReportSpec("ecommerce", ("activeUsers", "sessions"), rng, approx_users=0.01), reg)
    e = {(r.year, r.month): r for r in exact.collect()}
    for r in approx_df.collect():
        x = e[(r.year, r.month)]
        assert r.sessions == x.sessions
        assert abs(r.active_users - x.active_users) <= max(2, 0.05 * x.active_users)
    def shuffles(df):
        return len(set(re.findall(r"hashpartitioning\(.*\[plan_id=(\d+)\]", plan_of(df))))
    # fresh frames: after execution the adaptive plan lists initial and final plans
    fresh_exact = R.run_report(spark, ReportSpec("ecommerce", ("activeUsers", "sessions"), rng), reg)
    fresh_approx = R.run_report(spark, ReportSpec("ecommerce", ("activeUsers", "sessions"), rng,
                                                  approx_users=0.01), reg)
    assert shuffles(fresh_exact) == 2 and shuffles(fresh_approx) == 1


def test_spec_from_request_literal(spark):
    req = {
        "property": "properties/ecommerce",
        "dimensions": [{"name": "month"}, {"name": "year"}],
        "metrics": [{"name": "activeUsers"}, {"name": "sessions"}, {"name": "totalRevenue"}],
        "date_ranges": [{"start_date": "1997-01-01", "end_date": "1997-12-31"}],
        "dimension_filter": {"or_group": {"expressions": [
            {"filter": {"field_name": "platform", "string_filter": {"match_type": "EXACT", "value": "Android"}}},
            {"filter": {"field_name": "platform", "string_filter": {"match_type": "EXACT", "value": "iOS"}}},
        ]}},
        "order_bys": [{"dimension": {"dimension_name": "year"}}, {"dimension": {"dimension_name": "month"}}],
    }
    spec = ReportSpec.from_request(req, name="app")
    assert spec == R.app_spec(DateRange("1997-01-01", "1997-12-31"))
    reg = default_registry(SF01)
    assert R.run_report(spark, spec, reg).collect() == R.app_report(spark, reg, DateRange("1997-01-01", "1997-12-31")).collect()
    bad = dict(req, dimension_filter={"filter": {"field_name": "platform",
                                                 "string_filter": {"match_type": "CONTAINS", "value": "And"}}})
    with pytest.raises(ValueError, match="EXACT"):
        ReportSpec.from_request(bad)
    with pytest.raises(ValueError, match="one date range"):
        ReportSpec.from_request(dict(req, date_ranges=[]))


def test_totals_of_an_empty_report(spark):
    b = binding_of(two_months_one_user(spark))
    rep = R.organic_report(spark, b, DateRange("2030-01-01", "2030-12-31"), prop="x")
    t = TO.report_totals(rep).first()
    assert t.months == 0 and t.sessions is None and t.sum_monthly_users is None
    assert t.revenue == 0.0 and t.avg_monthly_engagement_pct is None
