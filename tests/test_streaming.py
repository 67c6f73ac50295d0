"""Streaming sessionizer: a file stream over the events table, memory sink."""

from conftest import SF01, events_df

from almanac.sources.bindings import events_contract
from almanac.streaming import sessions as ST


def _run(spark, mode, name):
    raw = spark.read.parquet(f"{SF01}/events.parquet")
    stream = ST.read_event_stream(spark, SF01, raw.schema, file_glob="events.parquet")
    assert stream.isStreaming
    rows = ST.session_rows(events_contract(stream), watermark="2 hours")
    q = (rows.writeStream.format("memory").queryName(name).outputMode(mode)
         .option("checkpointLocation", ST.checkpoint_location(spark, name))
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    return spark.table(name)


def test_complete_mode_equals_batch(spark):
    out = _run(spark, "complete", "sess_complete")
    batch = ST.session_rows(events_contract(spark.read.parquet(f"{SF01}/events.parquet")))
    assert out.count() == batch.count() == 9549
    assert out.exceptAll(batch.select(*out.columns)).isEmpty()


def test_append_mode_emits_closed_sessions_only(spark):
    out = _run(spark, "append", "sess_append")
    batch = ST.session_rows(events_contract(spark.read.parquet(f"{SF01}/events.parquet")))
    n = out.count()
    assert 0 < n < 9549                                   # open sessions wait for the watermark
    assert out.exceptAll(batch.select(*out.columns)).isEmpty()


def test_month_split(spark):
    df = events_df(spark, [
        (1, "2025-01-31 23:50:00", 1, None, "web", None, True, 1.0),
        (2, "2025-02-01 00:10:00", 1, None, "web", None, False, 2.0),
    ])
    rows = sorted((r.month, r.n_events, r.engaged, int(r.revenue_amount * 100)) for r in ST.session_rows(df).collect())
    assert rows == [("01", 1, 1, 100), ("02", 1, 0, 200)]       # one session, counted in both months


def test_reports_from_session_rows(spark):
    """Session rows (as the stream writes them) give the same monthly report
    as sessionizing the events."""
    import tempfile
    from almanac.plans import report as R
    from almanac.plans.spec import DateRange, ReportSpec
    from almanac.sources.properties import events_registry
    path = tempfile.mkdtemp(prefix="almanac-sessrows-") + "/rows"
    batch = ST.session_rows(events_contract(spark.read.parquet(f"{SF01}/events.parquet")))
    batch.write.partitionBy("year", "month").parquet(path)
    b = ST.session_rows_binding(path)
    y = DateRange("2024-01-01", "2024-12-31")
    metrics = ("sessions", "activeUsers", "engagementRate", "totalRevenue")
    a = R.run_report(spark, ReportSpec("x", metrics, y), b).collect()
    e = R.run_report(spark, ReportSpec("events", metrics, y), events_registry(SF01)).collect()
    assert a == e


def test_stream_to_parquet_sink(spark):
    import os
    import tempfile
    raw = spark.read.parquet(f"{SF01}/events.parquet")
    stream = ST.read_event_stream(spark, SF01, raw.schema, file_glob="events.parquet")
    out = tempfile.mkdtemp(prefix="almanac-sink-") + "/rows"
    q = ST.write_session_rows(ST.session_rows(events_contract(stream)), out,
                              ST.checkpoint_location(spark, "sink_test"))
    q.awaitTermination(300)
    n = spark.read.parquet(out).count()
    assert 0 < n <= 9549
    assert any(d.startswith("year=") for d in os.listdir(out))


def test_restart_on_the_same_checkpoint_is_incremental(spark):
    """Two availableNow runs on one checkpoint, with new event files arriving
    in between: the second run reads only the new files, emits the sessions
    its watermark has closed, and no session part is written twice."""
    import tempfile
    from pyspark.sql import functions as F
    raw = spark.read.parquet(f"{SF01}/events.parquet")
    src = tempfile.mkdtemp(prefix="almanac-src-")
    out = tempfile.mkdtemp(prefix="almanac-rows-") + "/rows"
    ckpt = ST.checkpoint_location(spark, "restart_test")
    raw.where(F.col("ts") < "2024-01-16").write.parquet(src + "/part1")

    def run_once():
        stream = ST.read_event_stream(spark, src + "/*", raw.schema)
        q = ST.write_session_rows(ST.session_rows(events_contract(stream)), out, ckpt)
        q.awaitTermination(300)
        return spark.read.parquet(out)

    first = run_once().count()
    raw.where(F.col("ts") >= "2024-01-16").write.parquet(src + "/part2")
    second_df = run_once()
    second = second_df.count()
    batch = ST.session_rows(events_contract(raw))
    key = ["user_id", "year", "month", "session_start"]
    assert 0 < first < second <= 9549
    assert second_df.groupBy(*key).count().where("count > 1").isEmpty()        # written once
    cols = [c for c in batch.columns]
    assert second_df.select(*cols).exceptAll(batch.select(*cols)).isEmpty()   # every row is a true session part
