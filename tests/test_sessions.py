"""Sessions by gap (FIXTURES.md §5: session_gaps)."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF01, events_df, plan_of

from almanac.operators import sessions as X
from almanac.sources.properties import events_registry


def session_gaps(spark):
    return events_df(spark, [
        (1, "2025-01-31 23:00:00", 1, None, "web", "Organic Search", False, None),
        (2, "2025-01-31 23:29:59", 1, None, "web", "Other", False, None),        # gap 29:59 → same
        (3, "2025-01-31 23:59:59", 1, None, "web", "Other", False, None),        # gap 30:00 exactly → same
        (4, "2025-02-01 00:30:00", 1, None, "web", "Other", False, None),        # 30:01 → new, over midnight + month
        (5, "2025-02-01 00:30:00", 1, None, "web", "Organic Search", False, None),  # equal ts → same
        (6, "2025-02-01 01:00:00.000001", 1, None, "web", None, False, None),    # 30 min + 1 µs → new
        (7, "2025-02-01 01:00:00.000001", 2, None, None, None, False, None),     # other user
    ])


def _lag_form(df, gap_min=30):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    start = F.lag("ts").over(w).isNull() | (F.col("ts") > F.lag("ts").over(w) + F.expr(f"INTERVAL {gap_min} MINUTES"))
    return df.withColumn("sid", F.sum(start.cast("long")).over(w.rowsBetween(Window.unboundedPreceding, 0)))


def test_gap_rules(spark):
    df = X.assign_sessions(session_gaps(spark), with_channel=True)
    got = {r.event_id: (r.session_id, r.session_channel) for r in df.collect()}
    assert got[1][0] == got[2][0] == got[3][0] == 1
    assert got[4][0] == got[5][0] == 2
    assert got[6][0] == 3
    assert got[7][0] == 1
    assert got[1][1] == "Organic Search"        # first channel of session 1
    assert got[4][1] == "Other"                 # equal ts: event_id 4 is first
    assert got[6][1] is None                    # no channel in session 3


def test_sessions_table(spark):
    t = X.sessions_table(session_gaps(spark)).orderBy("user_id", "session_id").collect()
    assert [(r.user_id, r.session_id, r.n_events) for r in t] == [(1, 1, 3), (1, 2, 2), (1, 3, 1), (2, 1, 1)]
    assert t[0].session_end == dt.datetime(2025, 1, 31, 23, 59, 59)


def test_bucket_form_equals_lag_form_on_events(spark):
    ev = events_registry(SF01)["events"].frame(spark, {"event_id", "user_id"})
    ours = X.assign_sessions(ev).select("event_id", "session_id")
    lag = _lag_form(ev).select("event_id", F.col("sid").alias("session_id"))
    assert ours.exceptAll(lag).isEmpty() and lag.exceptAll(ours).isEmpty()
    assert X.sessions_table(ev).count() == 9549


def test_session_window_agrees(spark):
    """Spark's own session_window gives the same session count (it also keeps
    a gap of exactly 30 min in the session)."""
    ev = events_registry(SF01)["events"].frame(spark, {"event_id", "user_id"})
    n = ev.groupBy("user_id", F.session_window("ts", "30 minutes")).count().count()
    assert n == 9549


def test_other_gap(spark):
    df = session_gaps(spark)
    ours = X.assign_sessions(df, gap=dt.timedelta(minutes=10)).select("event_id", "session_id")
    lag = _lag_form(df, 10).select("event_id", F.col("sid").alias("session_id"))
    assert sorted(ours.collect()) == sorted(lag.collect())


def test_zone_does_not_move_buckets(spark):
    df = session_gaps(spark)
    before = sorted(X.assign_sessions(df).select("event_id", "session_id").collect())
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        after = sorted(X.assign_sessions(df).select("event_id", "session_id").collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert before == after


def test_hot_user_is_reduced_before_the_window(spark):
    """One user with most of the rows: the per-user window sees one row per
    30-min bucket, not one per event."""
    base = spark.range(0, 200_000).select(
        F.col("id").alias("event_id"),
        (F.lit(dt.datetime(2025, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id") % 86400))
        .alias("ts"),
        F.when(F.col("id") % 10 < 8, F.lit(1)).otherwise(F.col("id") % 1000).cast("long").alias("user_id"))
    m = X.session_map(base)
    hot = m.where("user_id = 1")
    assert hot.count() <= 48          # 24 h of 30-min buckets
    assert "HashAggregate" in plan_of(m)


def test_sessionized_report_plan_shape(spark):
    """Raw events pass one hash aggregate each — the range with the report's
    columns, events beyond either border with the four session columns, only of
    users with an event next to it — then one shuffle by user for the window, and
    the month total.  No join but these semi-joins, no sort aggregate."""
    import re
    from almanac.plans import report as R
    from almanac.plans.spec import DateRange
    df = R.organic_report(spark, events_registry(SF01), DateRange("2024-01-01", "2024-12-31"))
    plan = plan_of(df)
    assert len(re.findall(r"^\(\d+\) Scan parquet", plan, re.M)) == 1 + 2 * 2
    joins = re.findall(r"^Join type: (\w+)", plan, re.M)
    assert joins == ["LeftSemi"] * 2 and "SortAggregate" not in plan
    exchanges = re.findall(r"^Arguments: (hashpartitioning\([^)]*\))", plan, re.M)
    assert any(re.match(r"hashpartitioning\(user_id#\d+L, \d+\)", e) for e in exchanges)


def test_report_without_channel_is_one_scan(spark):
    """One scan of events with a user; those without one (revenue only) are
    another, which the scan's own statistics mostly skip."""
    import re
    from almanac.plans import report as R
    from almanac.plans.spec import DateRange
    plan = plan_of(R.app_report(spark, events_registry(SF01), DateRange("2024-01-01", "2024-12-31")))
    pushed = re.findall(r"^PushedFilters: \[(.*)\]$", plan, re.M)
    assert len(pushed) == 2 and "IsNotNull(user_id)" in pushed[0] and "IsNull(user_id)" in pushed[1]
    assert "Join" not in plan


def test_report_without_channel_reads_only_the_range(spark):
    from almanac.plans import report as R
    from almanac.plans.spec import DateRange
    df = R.app_report(spark, events_registry(SF01), DateRange("2024-01-10", "2024-01-20"))
    plan = plan_of(df)
    assert "GreaterThanOrEqual(ts,2024-01-10T00:00)" in plan and "LessThan(ts,2024-01-21T00:00)" in plan


def test_epoch_micros_both_forms_exact(spark):
    vals = ["2018-11-04 00:30:00.123456", "1969-12-31 23:59:59.5", "2024-03-10 02:30:00", "0999-01-01 00:00:00.000001"]
    df = spark.createDataFrame([(dt.datetime.fromisoformat(v),) for v in vals], "ts timestamp_ntz")
    e = dt.datetime(1970, 1, 1)
    want = [(dt.datetime.fromisoformat(v) - e) // dt.timedelta(microseconds=1) for v in vals]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York"):          # fast form, field form
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = [r.us for r in df.select(X.epoch_micros(df).alias("us")).collect()]
            assert got == want, zone
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_channel_report_on_a_sub_range_uses_earlier_events(spark):
    """Organic report for 10–20 January: sessions that began before the 10th
    keep the channel of their first event (read from the earlier events)."""
    from almanac.plans import report as R
    from almanac.plans.spec import DateRange
    reg = events_registry(SF01)
    rng = DateRange("2024-01-10", "2024-01-20")
    got = [tuple(r) for r in R.organic_report(spark, reg, rng).collect()]
    ev = reg["events"].frame(spark)
    ref = _lag_form(ev)
    ws = (Window.partitionBy("user_id", "sid").orderBy("ts", "event_id")
          .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ref = ref.withColumn("sch", F.first("channel", ignorenulls=True).over(ws))
    ref = ref.where((F.col("ts") >= "2024-01-10") & (F.col("ts") < "2024-01-21") & (F.col("sch") == "Organic Search"))
    r = ref.agg(F.countDistinct("user_id", "sid").alias("s"), F.countDistinct("user_id").alias("u"),
                F.countDistinct(F.when(F.col("engaged"), F.struct("user_id", "sid"))).alias("e"),
                F.sum(F.floor(F.col("revenue") * 100 + 0.5)).alias("c")).first()
    pct = (r.e * 20000 + r.s) // (2 * r.s) / 100
    assert got == [("janeiro", "2024", r.s, r.u, pct, r.c / 100)]
    # and the plan reads the events beyond the borders with four columns only
    import re
    plan = plan_of(R.organic_report(spark, reg, rng))
    schemas = re.findall(r"^ReadSchema: (.*)$", plan, re.M)
    assert sorted(s.count(":") for s in schemas) == [2, 2, 4, 4, 6]   # users at a border, their events, the range


def test_buckets_exact_far_from_epoch(spark):
    """Bucket numbers stay exact where micros exceed 2^53 (after 2255)."""
    vals = ["9999-12-31 23:59:59.999999", "5000-06-15 12:00:00", "0001-01-01 00:00:00", "2024-01-01 00:30:00"]
    df = spark.createDataFrame([(dt.datetime.fromisoformat(v),) for v in vals], "ts timestamp_ntz")
    gap = dt.timedelta(minutes=30)
    got = [r.b for r in df.select(X.bucket_of(df, gap).alias("b")).collect()]
    e = dt.datetime(1970, 1, 1)
    want = [((dt.datetime.fromisoformat(v) - e) // dt.timedelta(microseconds=1)) // 1_800_000_000 for v in vals]
    assert got == want


def test_zoned_timestamp_table_gives_the_same_reports(spark):
    """A table whose ts is a zoned `timestamp` (instants) reports like its
    `timestamp_ntz` twin under a UTC session: bounds, months, buckets and gaps."""
    from almanac.plans import report as R
    from almanac.plans.spec import DateRange
    from almanac.sources.bindings import table_binding
    reg = events_registry(SF01)
    src = reg["events"].frame(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    zoned = src.withColumn("ts", F.col("ts").cast("timestamp"))
    b = table_binding("zoned", lambda s: zoned, session_ids=False,
                      **{c: c for c in ("event_id", "ts", "user_id", "platform", "channel", "engaged", "revenue")})
    rng = DateRange("2024-01-08", "2024-01-22")
    for rep in (R.web_report, R.app_report, R.organic_report):
        assert rep(spark, b, rng, prop="x").collect() == rep(spark, reg, rng).collect()


def test_events_without_a_user_spread_over_tasks(spark):
    from pyspark.sql import functions as F

    rows = [(i, "2025-01-10 10:00:00", None if i % 3 else 7, None, "web", None, True, 1.0) for i in range(3000)]
    old = spark.conf.get("spark.sql.adaptive.enabled")
    join = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = X.assign_sessions(events_df(spark, rows))
        per = [r["count"] for r in out.where("user_id IS NULL").groupBy(F.spark_partition_id()).count().collect()]
        assert sum(per) == 2000 and len(per) == 8 and max(per) < 500
        assert out.where("user_id = 7 AND session_id = 1").count() == 1000 and out.where("user_id IS NULL AND session_id IS NOT NULL").isEmpty()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", join)
