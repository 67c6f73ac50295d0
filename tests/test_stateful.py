"""Sessions with their channel from a stream: equal to the batch form."""

import datetime as dt
import random
import tempfile
from decimal import Decimal

import pytest
from conftest import SF01, events_df
from pyspark.sql import functions as F

from almanac.operators.sessions import assign_sessions, epoch_micros
from almanac.plans import report as R
from almanac.plans.spec import DateRange, ReportSpec
from almanac.sources.bindings import events_contract
from almanac.sources.properties import events_registry
from almanac.streaming import sessions as ST
from almanac.streaming import stateful as SF

COLUMNS = ["user_id", "year", "month", "n_events", "session_start", "session_end", "engaged", "revenue_amount", "session_id", "session_channel"]


def batch_parts(events):
    """The same rows from the event-level batch sessions."""
    s = assign_sessions(events.where("user_id IS NOT NULL AND ts IS NOT NULL"), with_channel=True, with_start=True)
    s = s.withColumn("session_id", epoch_micros(s, "session_start"))
    out = s.groupBy("user_id", "session_id", "session_channel", F.date_format("ts", "yyyy").alias("year"), F.date_format("ts", "MM").alias("month")).agg(
        F.count("*").alias("n_events"), F.min("ts").alias("session_start"), F.max("ts").alias("session_end"),
        F.max(F.col("engaged").cast("int")).alias("engaged"), F.sum(F.col("revenue").cast("decimal(28,6)")).alias("revenue_amount"))
    return out.select(*COLUMNS)


def run(spark, src, schema, out, ckpt, contract=lambda e: e, watermark="2 hours"):
    stream = ST.read_event_stream(spark, src, schema, max_files_per_trigger=1)
    q = SF.write_session_parts(SF.session_parts(contract(stream), watermark=watermark), out, ckpt)
    q.awaitTermination(300)
    assert q.exception() is None


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


@pytest.fixture(scope="module")
def events_run(spark):
    raw = spark.read.parquet(f"{SF01}/events.parquet")
    base = tempfile.mkdtemp(prefix="almanac-stateful-")
    cut = dt.datetime(2024, 1, 16)
    for k, p in enumerate((F.col("ts") < cut, F.col("ts") >= cut)):
        raw.where(p).coalesce(1).write.parquet(f"{base}/src/part{k}")
        run(spark, f"{base}/src/*", raw.schema, f"{base}/rows", f"{base}/ckpt", events_contract)      # goes on where it stopped
    return events_contract(raw), f"{base}/rows", f"{base}/ckpt"


def test_closed_and_open_together_equal_the_batch(spark, events_run):
    events, out, ckpt = events_run
    closed, tail = SF.closed_parts(spark, out, ckpt), SF.open_parts(spark, ckpt)
    assert closed.count() > 0 and tail.count() > 0
    assert rows_of(closed.unionByName(tail)) == rows_of(batch_parts(events))


def test_reports(spark, events_run):
    events, out, ckpt = events_run
    y = DateRange("2024-01-01", "2024-12-31")
    whole = SF.session_parts_binding(spark, out, ckpt, with_open=True)
    spec = R.organic_spec(y)
    assert R.run_report(spark, spec, whole).collect() == R.run_report(spark, spec, events_registry(SF01)).collect()
    closed = SF.session_parts_binding(spark, out, ckpt)
    assert dt.date(2024, 1, 28) < closed.closed_before <= dt.date(2024, 1, 31)
    with pytest.raises(ValueError, match="complete only before"):
        R.run_report(spark, spec, closed)
    metrics = ("sessions", "activeUsers", "totalRevenue")
    part = ReportSpec("x", metrics, DateRange("2024-01-01", closed.closed_before - dt.timedelta(days=1)))
    assert R.run_report(spark, part, closed).count() == 1


def test_channel_and_start_across_months_late_events_and_users_without_a_name(spark):
    base = tempfile.mkdtemp(prefix="almanac-stateful-")
    first = [
        (1, "2025-01-31 23:50:00", 1, None, "web", None, True, 1.25),
        (2, "2025-02-01 00:10:00", 1, None, "web", "Organic Search", False, None),      # known behind the border
        (3, "2025-02-01 00:20:00", 1, None, "web", "Other", False, 2.0),
        (4, "2025-01-31 20:00:00", None, None, "web", "Other", True, 3.0),               # no user
        (5, "2025-02-01 00:15:00", 2, None, "web", None, None, float("nan")),
        (7, "2025-02-01 00:45:00.000001", 2, None, "web", "Other", None, None),          # a microsecond more than the gap
    ]
    second = [(8, "2025-02-03 00:00:00", 3, None, "web", "Other", False, 0.5), (None, "2025-02-03 00:00:00", 3, None, "web", "Zero", False, 0.5)]
    third = [(9, "2025-02-01 00:30:00", 1, None, "web", "Other", True, 9.0),             # later than the watermark: dropped
             (10, "2025-02-03 00:30:00", 3, None, "web", "Other", True, 1.0)]
    schema = events_df(spark, first).schema
    for k, rows in enumerate((first, second, third)):
        events_df(spark, rows).coalesce(1).write.parquet(f"{base}/src/part{k}")
        run(spark, f"{base}/src/*", schema, f"{base}/rows", f"{base}/ckpt")
        if k == 0:
            assert SF.closed_before(spark, f"{base}/ckpt") == dt.date(2025, 1, 31)      # a session of that day is open
    kept = events_df(spark, first + second + third[1:])
    tail = SF.open_parts(spark, f"{base}/ckpt")
    closed = SF.closed_parts(spark, f"{base}/rows", f"{base}/ckpt")
    assert closed.count() == 4 and tail.count() == 1
    got = rows_of(closed.unionByName(tail))
    assert got == rows_of(batch_parts(kept))
    mine = [r for r in got if r[0] == 1]
    assert [(r[2], r[3], r[9]) for r in mine] == [("01", 1, "Organic Search"), ("02", 2, "Organic Search")]
    assert len({r[8] for r in mine}) == 1 and mine[0][7] == Decimal("1.25")


def test_parts_merge_in_any_order():
    rng = random.Random(5)
    for _ in range(200):
        times = sorted(rng.sample(range(400), rng.randint(1, 30)))
        parts = [(t // 100, t, t, 1, rng.choice((None, 0, 1)), rng.choice((None, Decimal(t))), *rng.choice(((None, None, None), ("c", t, t)))) for t in times]
        plain = []
        for p in parts:
            if plain and p[1] - plain[-1][-1][1] <= 7:
                plain[-1].append(p)
            else:
                plain.append([p])
        rng.shuffle(parts)
        state = []
        while parts:
            n = rng.randint(1, 5)
            state = [p for s in SF.merged(state + parts[:n], 7) for p in s]
            parts = parts[n:]
        got = SF.merged(state, 7)
        assert [(s[0][1], sum(p[3] for p in s), max(p[2] for p in s)) for s in got] == [(s[0][1], len(s), s[-1][1]) for s in plain]
        assert [sorted(p[0] for p in s) for s in got] == [sorted({p[0] for p in s}) for s in plain]


def test_a_batch_is_refused(spark):
    with pytest.raises(ValueError, match="takes a stream"):
        SF.session_parts(events_df(spark, []))
