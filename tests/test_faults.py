"""Revenue as one figure, channels across borders, other zones' partition dates,
refused requests and failing reports."""

import datetime as dt
import os
import tempfile

import pytest

from conftest import binding_of, events_df
from almanac.plans import bundle as BU
from almanac.plans import report as R
from almanac.plans.spec import DateRange, ReportSpec
from almanac.sources import sinks
from almanac.sources.bindings import table_binding
from almanac.sources.properties import PropertyRegistry
from almanac.sources.stored import sessionized_binding, write_sessionized

Y25 = DateRange("2025-01-01", "2025-12-31")


def report(spark, b, metrics, rng=Y25):
    return R.run_report(spark, ReportSpec("x", metrics, rng), b).collect()


def test_revenue_is_one_figure(spark):
    df = events_df(spark, [(1, "2025-01-10 10:00:00", None, None, "web", "Other", True, 100.0),
                           (2, "2025-01-10 10:05:00", 7, 1, "web", "Other", True, 5.0),
                           (3, "2025-01-11 10:05:00", 7, 2, "web", None, True, float("inf"))])
    gap, own = binding_of(df, session_ids=False), binding_of(df)
    path = tempfile.mkdtemp(prefix="almanac-faults-") + "/stored"
    write_sessionized(spark, gap, path)
    for b in (gap, own, sessionized_binding(path)):
        for more in ((), ("activeUsers",), ("sessions",), ("sessions", "activeUsers", "engagementRate")):
            rows = report(spark, b, ("totalRevenue", *more))
            assert [r.revenue for r in rows] == [105.0], (b.name, more)
        r = report(spark, b, ("sessions", "activeUsers", "totalRevenue"))[0]
        assert (r.sessions, r.active_users) == (2, 1)


def test_small_amounts_add_up(spark):
    df = events_df(spark, [(i, "2025-01-10 10:00:00", i, i, "web", "Other", True, 0.004) for i in range(1000)])
    for b in (binding_of(df), binding_of(df, session_ids=False)):
        assert [r.revenue for r in report(spark, b, ("totalRevenue", "sessions"))] == [4.0]


CHANNELS = [(1, "2025-01-31 23:50:00", 1, None, "web", None, True, 1.0), (2, "2025-02-01 00:05:00", 1, None, "web", "Organic Search", True, 2.0),
            (3, "2025-01-01 00:10:00", 2, None, "web", "Other", True, 4.0), (4, "2024-12-31 23:55:00", 2, None, "web", "Organic Search", True, 8.0),
            (5, "2025-01-15 10:00:00", 3, None, "web", "Organic Search", True, 16.0), (6, "2025-02-01 00:20:00", 4, None, "web", "Other", True, 32.0),
            (7, "2025-01-31 23:49:00", 4, None, "web", None, True, 64.0)]


def test_channel_from_beyond_either_border(spark):
    b = binding_of(events_df(spark, CHANNELS), session_ids=False)
    january = DateRange("2025-01-01", "2025-01-31")
    alone = R.organic_report(spark, b, january, prop="x").collect()
    wide = R.organic_report(spark, b, DateRange("2024-12-01", "2025-02-28"), prop="x").where("month = 'janeiro'").collect()
    assert alone == wide and [(r.sessions, r.revenue) for r in alone] == [(3, 21.0)]
    path = tempfile.mkdtemp(prefix="almanac-faults-") + "/stored"
    write_sessionized(spark, b, path)
    assert R.organic_report(spark, sessionized_binding(path), january, prop="x").collect() == alone


@pytest.mark.parametrize("zone", ["America/Sao_Paulo", "Asia/Kolkata", "UTC"])
def test_partition_dates_of_another_zone(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    rows = [(i, h) for i, h in enumerate(["2025-01-01 01:00:00", "2025-01-31 20:00:00", "2025-02-01 01:00:00", "2025-01-15 12:00:00", "2024-12-31 20:00:00"])]
    path = tempfile.mkdtemp(prefix="almanac-faults-") + "/by_day"
    try:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        df = spark.createDataFrame(rows, "i long, t string").selectExpr("i", "cast(t as timestamp) ts", "to_date(t) day")
        df.write.partitionBy("day").parquet(path)
        spark.conf.set("spark.sql.session.timeZone", zone)
        for ids in (False, True):
            cols = {"event_id": "i", "user_id": "i", "ts": "ts", "session_id": "i"}
            plain = table_binding("p", lambda s: s.read.parquet(path), ids, **cols)
            parts = table_binding("p", lambda s: s.read.parquet(path), ids, partition_date="day", **cols)
            rng = DateRange("2025-01-01", "2025-01-31")
            got = report(spark, parts, ("sessions", "activeUsers"), rng)
            assert got == report(spark, plain, ("sessions", "activeUsers"), rng) and got[0].sessions >= 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


GOOD = {"property": "properties/x", "dimensions": [{"name": "month"}, {"name": "year"}], "metrics": [{"name": "sessions"}],
        "date_ranges": [{"start_date": "2025-01-01", "end_date": "2025-12-31"}]}


@pytest.mark.parametrize("change", [
    {"dimensions": [{"name": "month"}, {"name": "year"}, {"name": "platform"}]}, {"dimensions": [{"name": "month"}, {"name": "month"}]},
    {"limit": 5}, {"metric_filter": {}}, {"metrics": [{"name": "sessions", "expression": "x"}]},
    {"dimension_filter": {"filter": {"field_name": "platform", "string_filter": {"value": "web", "regex": 1}}}},
    {"dimension_filter": {"filter": {}, "or_group": {}}}, {"order_bys": [{"metric": {"metric_name": "sessions"}}]}])
def test_requests_are_whole_or_refused(change):
    assert ReportSpec.from_request(GOOD).dimensions == ("month", "year")
    with pytest.raises(ValueError):
        ReportSpec.from_request(GOOD | change)


def failing(kind):
    def load(spark):
        if kind == "missing":
            return spark.read.parquet("/tmp/no such table")
        return spark.range(3).selectExpr("id event_id", "id user_id", "id session_id", "timestamp'2025-01-05 10:00:00' ts",
                                         "'Organic Search' channel", "true engaged", "cast(concat('x', id) as double) revenue")
    return table_binding("bad", load, **{c: c for c in ("event_id", "user_id", "session_id", "ts", "channel", "engaged", "revenue")})


@pytest.mark.parametrize("kind", ["missing", "cast"])
def test_a_failing_report_leaves_the_others(spark, kind):
    good = binding_of(events_df(spark, [(1, "2025-01-10 10:00:00", 7, 1, "web", "Other", True, 10.0)]))
    b = BU.run_bundle(spark, PropertyRegistry({"ecommerce": good, "second": failing(kind)}), Y25)
    assert set(b.errors) == {"organic"} and set(b.reports) == {"web", "app"}
    path = sinks.write_bundle(b, tempfile.mkdtemp(prefix="almanac-faults-"), "t", 2025)
    assert os.listdir(path) == ["web"]
    b.release()
    with pytest.raises(Exception):
        BU.run_bundle(spark, PropertyRegistry({"ecommerce": good, "second": failing(kind)}), Y25, on_error="raise")


def test_a_failing_write_is_named_and_removed(spark, caplog):
    good = R.web_report(spark, binding_of(events_df(spark, [(1, "2025-01-10 10:00:00", 7, 1, "web", "Other", True, 10.0)])), Y25, prop="x")
    bad = spark.range(2000).selectExpr("case when id < 1500 then id else raise_error('broken') end AS id")
    out = tempfile.mkdtemp(prefix="almanac-faults-")
    with pytest.raises(sinks.ReportsFailed, match="bad") as e:
        sinks.write_reports({"bad": bad, "web": good, "none": good.limit(0)}, out, "t", 2025, now=dt.datetime(2026, 1, 1))
    assert os.listdir(e.value.path) == ["web"] and set(e.value.failed) == {"bad"}
    assert "report none has no rows" in caplog.text


def test_presence_lists_empty_reports(spark):
    good = binding_of(events_df(spark, [(1, "2025-01-10 10:00:00", 7, 1, "web", "Other", True, 10.0)]))
    b = BU.run_bundle(spark, PropertyRegistry({"ecommerce": good, "second": good}), Y25)
    assert {tuple(r) for r in b.presence().collect()} == {("web", True, 1), ("app", False, 0), ("organic", False, 0)}
    b.release()


