"""The stored sessions, refreshed by day, against one full write."""

import datetime as dt
import os
import random
import tempfile

import pytest
from conftest import SF01, binding_of, events_df

from almanac.plans import report as R
from almanac.plans.spec import DateRange
from almanac.sources import session_store as S
from almanac.sources.properties import events_registry
from almanac.sources.stored import STORED_COLUMNS, write_sessionized

DAY = dt.timedelta(days=1)


def new_dir():
    return tempfile.mkdtemp(prefix="almanac-store-") + "/t"


def stored(spark, path):
    return sorted(map(tuple, spark.read.parquet(path).select(*STORED_COLUMNS).collect()), key=repr)


def opened(spark, path):
    return sorted((tuple(r) for r in spark.read.parquet(path + "/open").select(*S._OPEN).collect()), key=repr)


def files(path):
    return {d: sorted(f for f in os.listdir(f"{path}/events/{d}") if f.endswith(".parquet")) for d in os.listdir(f"{path}/events") if "=" in d}


def equal_to_a_full_write(spark, path, binding):
    full, again = new_dir(), new_dir()
    write_sessionized(spark, binding, full)
    assert stored(spark, S.events_path(path)) == stored(spark, full)
    S.make_store(spark, binding, again)
    keep = lambda rows: [r for r in rows if r[0] is not None]
    assert keep(opened(spark, path)) == keep(opened(spark, again))


def test_ten_daily_refreshes_one_late_equal_one_full_write(spark):
    whole = events_registry(SF01)["events"]
    all_events = whole.frame(spark)
    first = dt.date(2024, 1, 1)

    def upto(days):                          # the source as it stands with these days in it
        return binding_of(all_events.where(all_events.ts.cast("date").isin(*days)), session_ids=False)

    have = [first + i * DAY for i in range(10)]
    path = new_dir()
    S.make_store(spark, upto(have), path)
    late = first + 14 * DAY
    for i in range(10, 20):
        day = first + i * DAY
        if day == late:
            continue
        have.append(day)
        before = files(path)
        touched = S.refresh_store(spark, upto(have), path, [day])
        after = files(path)
        assert day in touched and {f"event_date={d}" for d in touched} == {d for d in after if after[d] != before.get(d)}
        assert len(touched) <= 2
    have.append(late)
    before = files(path)
    touched = S.refresh_store(spark, upto(have), path, [late.isoformat()])
    assert late in touched and len(touched) <= 4
    assert all(files(path)[f"event_date={d}"] == before[f"event_date={d}"] for d in have if d not in touched)
    binding = upto(have)
    equal_to_a_full_write(spark, path, binding)
    y = DateRange("2024-01-01", "2024-01-20")
    assert R.organic_report(spark, S.store_binding(path), y, prop="x").collect() == R.organic_report(spark, binding, y, prop="x").collect()
    assert not os.listdir(path + "/_next")


def made(rng, days):
    """Few users, events close to midnight, channels often missing."""
    rows = []
    for i in range(rng.randint(10, 60)):
        minute = rng.choice([rng.randrange(0, 40), rng.randrange(1400, 1440), rng.randrange(0, 1440)])
        ts = dt.datetime(2024, 1, 1) + rng.randrange(days) * DAY + dt.timedelta(minutes=minute)
        rows.append((i, ts, rng.choice([1, 2, 2, None]), None, "web", rng.choice([None, None, None, "a", "b"]), True, 1.0))
    return rows


@pytest.mark.parametrize("gap,runs", [(30, 1), (24 * 60, 1)])
def test_random_corrections_of_days_equal_a_full_write(spark, gap, runs):
    rng = random.Random(gap)
    for _ in range(runs):
        days, rows = 5, made(rng, 5)
        bind = lambda r: binding_of(events_df(spark, r), session_ids=False, session_gap=dt.timedelta(minutes=gap))
        path = new_dir()
        S.make_store(spark, bind(rows), path)
        for _ in range(2):                   # some days are replaced, emptied or come anew
            changed = sorted(rng.sample(range(days + 1), rng.randint(1, 3)))
            keep = [r for r in rows if (r[1].date() - dt.date(2024, 1, 1)).days not in changed]
            fresh = [(1000 + k, *r[1:]) for k, r in enumerate(made(rng, days + 1))
                     if (r[1].date() - dt.date(2024, 1, 1)).days in changed and rng.random() < 0.8]
            rows = keep + fresh
            S.refresh_store(spark, bind(rows), path, [dt.date(2024, 1, 1) + d * DAY for d in changed])
            equal_to_a_full_write(spark, path, bind(rows))


def test_channel_known_behind_midnight_reaches_the_day_before(spark):
    night = [(1, "2024-01-01 23:50:00", 1, None, "web", None, True, 1.0)]
    morning = [(2, "2024-01-02 00:10:00", 1, None, "web", "Organic Search", True, 1.0)]
    bind = lambda r: binding_of(events_df(spark, r), session_ids=False)
    path = new_dir()
    S.make_store(spark, bind(night), path)
    assert S.refresh_store(spark, bind(night + morning), path, ["2024-01-02"]) == [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
    equal_to_a_full_write(spark, path, bind(night + morning))
    assert {r.session_channel for r in spark.read.parquet(S.events_path(path)).collect()} == {"Organic Search"}
    S.refresh_store(spark, bind(night), path, ["2024-01-02"])             # taken back
    equal_to_a_full_write(spark, path, bind(night))
    with pytest.raises(ValueError):
        S.make_store(spark, binding_of(events_df(spark, night), session_ids=False, session_gap=2 * DAY), new_dir())
