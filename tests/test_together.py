"""Reports that run at the same time: time, errors and cancellation apart."""

import os
import tempfile
import time

import pytest
from conftest import binding_of, events_df
from pyspark.sql import functions as F

from almanac.plans import bundle as BU
from almanac.plans.spec import DateRange, ReportSpec
from almanac.session import TimeLimit, together
from almanac.sources import sinks
from almanac.sources.properties import PropertyRegistry

Y25 = DateRange("2025-01-01", "2025-12-31")
METRICS = ("sessions", "activeUsers", "totalRevenue")



def sleeping(df, seconds):
    """``df`` with a task that sleeps first."""
    def run(batches):
        time.sleep(seconds)
        yield from batches
    return df.coalesce(1).mapInArrow(run, df.schema)


def registry(spark, seconds):
    df = events_df(spark, [(1, "2025-01-10 10:00:00", 7, 1, "web", "Other", True, 5.0), (2, "2025-03-10 10:00:00", 8, 2, "web", "Other", False, 1.0)])
    return PropertyRegistry({f"p{k}": binding_of(sleeping(df, s)) for k, s in enumerate(seconds)})


def specs(n):
    return [ReportSpec(f"p{k}", METRICS, Y25, name=f"r{k}") for k in range(n)]


def test_three_slow_reports_take_about_the_longest(spark):
    BU.run_bundle(spark, registry(spark, [0]), Y25, specs=specs(1)).release()                # workers are up
    t = time.perf_counter()
    b = BU.run_bundle(spark, registry(spark, [5, 5, 5]), Y25, specs=specs(3))
    assert 5 <= time.perf_counter() - t < 12
    got = {n: [tuple(r) for r in df.collect()] for n, df in b.reports.items()}
    assert list(got) == ["r0", "r1", "r2"] and got["r0"] == got["r1"] == got["r2"] and len(got["r0"]) == 2
    b.release()


def test_one_is_cancelled_without_the_others(spark):
    t = time.perf_counter()
    b = BU.run_bundle(spark, registry(spark, [0, 25, 0]), Y25, specs=specs(3), limit=8)
    assert time.perf_counter() - t < 22
    assert set(b.reports) == {"r0", "r2"} and set(b.errors) == {"r1"} and isinstance(b.errors["r1"], TimeLimit)
    assert b.reports["r2"].count() == 2
    b.release()
    with pytest.raises(TimeLimit):
        BU.run_bundle(spark, registry(spark, [0, 25]), Y25, specs=specs(2), on_error="raise", limit=3)


def test_reports_are_written_at_the_same_time_and_fail_apart(spark):
    out = tempfile.mkdtemp(prefix="almanac-together-")
    good = events_df(spark, [(1, "2025-01-10 10:00:00", 7, 1, "web", "Other", True, 5.0)])
    bad = good.select(F.raise_error(F.lit("no")).alias("x"))
    with pytest.raises(sinks.ReportsFailed) as e:
        sinks.write_reports({"a": good, "hang": sleeping(good, 25), "bad": bad, "none": good.where("user_id < 0"), "z": good}, out, "x", 2025, limit=8)
    assert set(e.value.failed) == {"hang", "bad"} and isinstance(e.value.failed["hang"], TimeLimit)
    run = os.path.basename(e.value.path)
    assert {n: df.count() for n, df in sinks.read_run(spark, out, run).items()} == {"a": 1, "z": 1}
    assert sorted(os.listdir(out)) == ["_runs", run]


def test_job_group_and_errors_of_the_caller_stay(spark):
    sc = spark.sparkContext
    before = sc.getLocalProperty("spark.jobGroup.id")
    done, errors = together(spark, {"a": lambda: spark.range(3).count(), "b": lambda: 1 // 0, "c": lambda: None})
    assert done == {"a": 3, "c": None} and isinstance(errors["b"], ZeroDivisionError)
    assert sc.getLocalProperty("spark.jobGroup.id") == before
