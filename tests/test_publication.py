"""Runs are published whole; rows that cannot be read are kept apart."""

import datetime as dt
import os
import tempfile

import pytest
from conftest import binding_of, events_df

from almanac.plans import report as R
from almanac.plans.spec import DateRange
from almanac.sources import sinks, typed

Y25 = DateRange("2025-01-01", "2025-12-31")


def web(spark):
    return R.web_report(spark, binding_of(events_df(spark, [(1, "2025-01-10 10:00:00", 7, 1, "web", "Other", True, 10.0)])), Y25, prop="x")


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_a_run_is_read_by_its_manifest(spark, fmt):
    out, now = tempfile.mkdtemp(prefix="almanac-out-"), dt.datetime(2026, 1, 1)
    rep = web(spark)
    base = sinks.write_reports({"web": rep, "none": rep.limit(0)}, out, "t", 2025, fmt, now=now)
    run = os.path.basename(base)
    assert sinks.read_manifest(spark, out, run) == {"run": run, "format": fmt, "reports": {"web": 1}, "failed": []}
    got = sinks.read_run(spark, out, run)
    assert set(got) == {"web"} and got["web"].first().sessions == 1
    assert sorted(os.listdir(out)) == ["_runs", run]           # nothing left aside
    with pytest.raises(FileNotFoundError):
        sinks.read_run(spark, out, "t_2025_20000101_000000")


def test_a_run_stopped_midway_shows_nothing(spark, monkeypatch):
    out = tempfile.mkdtemp(prefix="almanac-out-")
    rep = web(spark)
    real = sinks.write_report

    def stop_at_second(df, path, *a, **k):
        if path.endswith("second"):
            assert not [d for d in os.listdir(out) if d != "_writing"]
            raise KeyboardInterrupt
        return real(df, path, *a, **k)

    monkeypatch.setattr(sinks, "write_report", stop_at_second)
    with pytest.raises(KeyboardInterrupt):
        sinks.write_reports({"first": rep, "second": rep}, out, "t", 2025)
    assert os.listdir(out) == []
    bad = spark.range(10).selectExpr("raise_error('broken') AS id")
    with pytest.raises(Exception, match="broken"):
        sinks.write_reports({"web": rep, "bad": bad}, out, "t", 2025, on_error="raise")
    assert os.listdir(out) == []


def test_each_report_runs_once(spark):
    def executions():
        return spark._jsparkSession.sharedState().statusStore().executionsCount()

    reports = {n: web(spark) for n in ("a", "b", "c")}
    before = executions()
    sinks.write_reports(reports, tempfile.mkdtemp(prefix="almanac-out-"), "t", 2025)
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    assert executions() - before == 3


def test_good_and_rejected_rows_are_the_rows_read(spark):
    rows = [("janeiro", "2025", "12", "3.5"), ("maio", "2025", "doze", "x"), (None, None, None, None), ("abril", "2025", "1", "NaN"),
            ("abril", "2025", "1", "1e300"), ("julho", "2025", "7.5", "1")]
    df = spark.createDataFrame([(*r, "extra") for r in rows], "month string, year string, sessions string, revenue string, reason string")
    path = tempfile.mkdtemp(prefix="almanac-rows-") + "/t"
    got = typed.load_rows(df.drop("reason"), typed.REPORT_SCHEMAS["web"], path, amounts=("revenue",))
    assert got.good.schema == typed.REPORT_SCHEMAS["web"] and (got.n_good, got.n_rejected) == (got.good.count(), got.rejects.count()) and got.n_good + got.n_rejected == 6
    assert {tuple(r) for r in got.good.collect()} >= {("janeiro", "2025", 12, 3.5), (None, None, None, None)}
    reasons = {r.reason for r in got.rejects.collect()}
    assert reasons >= {"sessions: doze is no bigint; revenue: x is no double", "revenue: NaN is no amount", "revenue: 1e300 is no amount"}
    assert got.rejects.columns == ["month", "year", "sessions", "revenue", "reason"]
    none = typed.load_rows(df.limit(0), typed.REPORT_SCHEMAS["web"], path + "2")
    assert (none.n_good, none.n_rejected) == (0, 0) and none.good.schema == typed.REPORT_SCHEMAS["web"] and none.good.isEmpty()
    with pytest.raises(ValueError):
        typed.load_rows(df.drop("year"), typed.REPORT_SCHEMAS["web"], path + "3")
