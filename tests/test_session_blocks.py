"""X1/P4 by blocks of time: the sessions of the one-window form, tasks bounded by a block."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF001, events_df, plan_of

from almanac.operators import sessions as X
from almanac.plans import report as R
from almanac.plans.spec import DateRange
from almanac.sources.bindings import table_binding

GAP = dt.timedelta(minutes=30)
T0 = dt.datetime(2025, 1, 1)


def random_events(spark, seed):
    """Users of every habit: sparse, steady across many blocks, at block borders
    exactly, several events at one time, some without a user or a time."""
    rng = random.Random(seed)
    rows = []
    for user in range(24):
        t = T0 + dt.timedelta(minutes=rng.choice([0, 29, 59]))
        for _ in range(rng.choice([1, 30, 90])):
            channel = rng.choice([None, None, None, "Organic Search", "Other"])
            rows.append((len(rows), t, user, None, rng.choice(["web", "iOS"]), channel, rng.random() < 0.3, 1.0))
            t += rng.choice([dt.timedelta(0), dt.timedelta(minutes=7), GAP, GAP, GAP, GAP + dt.timedelta(microseconds=1), dt.timedelta(hours=2, seconds=1)])
    rows += [(len(rows), T0, None, None, "web", "Other", True, 2.0), (len(rows) + 1, None, 3, None, "web", None, False, 1.0)]
    return events_df(spark, rows)


@pytest.mark.parametrize("seed,block", [(1, GAP), (2, dt.timedelta(hours=1)), (3, dt.timedelta(hours=5)), (4, dt.timedelta(days=31)), (5, dt.timedelta(minutes=1))])
def test_blocks_equal_one_window(spark, seed, block):
    ev = random_events(spark, seed).cache()
    one = X.sessions_table(ev, with_channel=True).select("user_id", "session_start", "session_end", "n_events", "session_channel")
    two = X.sessions_table(ev, with_channel=True, block=block)
    assert sorted(map(str, one.collect())) == sorted(map(str, two.select(*one.columns).collect()))
    cols = ["event_id", "user_id", "session_start", "session_channel"]
    one = X.assign_sessions(ev, with_channel=True, with_start=True).select(*cols)
    two = X.assign_sessions(ev, with_channel=True, with_start=True, block=block).select(*cols)
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))
    plain = X.sessions_table(ev, block=block)
    assert plain.columns == ["user_id", "session_id", "session_start", "session_end", "n_events"]
    assert plain.count() == one.where("user_id IS NOT NULL AND session_start IS NOT NULL").select("user_id", "session_start").distinct().count()


def test_channel_from_a_later_block(spark):
    """One session over five blocks: the only channel is in its last one."""
    rows = [(i, T0 + i * dt.timedelta(minutes=20), 1, None, "web", "Other" if i == 14 else None, False, None) for i in range(15)]
    got = X.assign_sessions(events_df(spark, rows), with_channel=True, with_start=True, block=dt.timedelta(hours=1)).collect()
    assert {(r.session_start, r.session_channel) for r in got} == {(T0, "Other")}


def test_tables_without_rows(spark):
    ev = events_df(spark, [(1, T0, None, None, "web", None, False, None)])
    assert X.sessions_table(ev, with_channel=True, block=GAP).count() == 0
    assert [r.session_start for r in X.assign_sessions(ev, with_start=True, block=GAP).collect()] == [None]


def test_reports_and_bindings(spark):
    ev = random_events(spark, 6).where("ts IS NOT NULL").cache()
    y = DateRange("2025-01-01", "2025-01-02")
    cols = {c: c for c in ev.columns if c != "session_id"}
    plain = table_binding("p", lambda s: ev, False, **cols)
    blocks = table_binding("p", lambda s: ev, False, session_block=dt.timedelta(hours=2), **cols)
    for rep in (R.organic_report, R.app_report, R.web_report):
        want = rep(spark, plain, y, prop="x").collect()
        assert want and rep(spark, blocks, y, prop="x").collect() == want


def test_tasks_do_not_follow_the_years_of_a_user(spark):
    """A user active in every bucket for four years, one session: the rows are
    dealt over tasks by block; the one-window form has them in one task."""
    days = 4 * 365
    rows = spark.range(days * 48).select(
        (F.col("id") * 0).alias("user_id"), F.col("id").alias("bucket"),
        *[(F.lit(T0) + F.make_dt_interval(mins=F.col("id").cast("int") * 30)).cast("timestamp_ntz").alias(c) for c in ("first_ts", "last_ts")])
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "64")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        most = {}
        for name, df in (("one", X.sessionize_groups(rows, GAP)), ("blocks", X.sessionize_blocks(rows, GAP, dt.timedelta(days=31)))):
            got = df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.min("session_id").alias("a"), F.max("session_id").alias("b")).collect()
            assert sum(r.n for r in got) == days * 48 and {r.a for r in got} == {r.b for r in got} == {0}
            most[name] = max(r.n for r in got)
        assert most["one"] == days * 48 and most["blocks"] < days * 48 / 6
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    # the one user is a constant to the optimiser; the rows of either level are dealt by block
    dealt = re.findall(r"hashpartitioning\(([^)]*), \d+\)", plan_of(df))
    assert dealt and all(re.search(r"\bblock#\d+L", d) for d in dealt)


def test_bindings_file_takes_blocks(spark, tmp_path):
    import json

    from almanac.sources.bindings import bindings_from_file
    from almanac.sources.properties import events_registry

    path = tmp_path / "tables.json"
    columns = {c: c for c in ("event_id", "ts", "user_id")}
    path.write_text(json.dumps({"a": {"path": f"{SF001}/events.parquet", "columns": columns, "block_days": 7},
                                "b": {"path": f"{SF001}/events.parquet", "columns": columns}}))
    got = bindings_from_file(str(path))
    assert got["a"].session_block == dt.timedelta(days=7) and got["b"].session_block is None
    assert events_registry(SF001)["events"].session_block is None
