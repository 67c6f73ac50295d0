"""Daily summaries against reports over the events."""

import datetime as dt
import random
import tempfile

import pytest
from conftest import SF01, binding_of, events_df, plan_of

from almanac.plans import report as R
from almanac.plans.spec import DateRange, Exact, ReportSpec
from almanac.sources import session_store as S
from almanac.sources import summary as M
from almanac.sources.properties import events_registry

DAY = dt.timedelta(days=1)
ALL = ("sessions", "activeUsers", "engagementRate", "totalRevenue")


def new_dir():
    return tempfile.mkdtemp(prefix="almanac-summary-") + "/t"


def specs(rng):
    return [ReportSpec("x", ALL, rng, filter=f, name=n) for n, f in
            (("web", R.WEB_FILTER), ("app", R.APP_FILTER), ("organic", R.ORGANIC_FILTER), ("all", None))]


@pytest.fixture(scope="module")
def january(spark):
    binding = events_registry(SF01)["events"]
    store, path = new_dir(), new_dir()
    S.make_store(spark, binding, store)
    M.make_summary(spark, store, path, specs(DateRange("2024-01-01", "2024-01-31")), [d for d in S.stored_days(spark, store) if d.day % 9])
    return binding, store, path


@pytest.mark.parametrize("first,last", [(1, 31), (8, 20)])
def test_reports_of_any_range_equal_those_over_the_events(spark, january, first, last):
    binding, store, path = january               # a ninth of the days is not summarised: from the stored events
    rng = DateRange(f"2024-01-{first:02d}", f"2024-01-{last:02d}")
    for sp in specs(rng):
        got = M.report_from_summary(spark, store, path, sp, rate_as_percent=True).collect()
        assert got == R.run_report(spark, sp, binding, rate_as_percent=True).collect()
        users = binding.frame(spark).where(f"ts >= '{rng.start}' AND ts < '{rng.end_exclusive}'")
        if sp.name == "app":
            users = users.where("platform IN ('Android', 'iOS')")
        if sp.name == "app":
            exact = users.select("user_id").distinct().where("user_id IS NOT NULL").count()
            assert M.users_between(spark, store, path, sp).first().active_users == exact
            near = M.users_between(spark, store, path, sp, approx=True).first().active_users
            assert abs(near - exact) <= M.sketch_error() * exact


def test_no_event_is_read_for_summarised_days(spark, january):
    _, store, path = january
    sp = specs(DateRange("2024-01-01", "2024-01-08"))[0]
    for df in (M.users_between(spark, store, path, sp), M.summary_counts(spark, store, path, sp)):
        assert "/events" not in plan_of(df)


def test_summaries_follow_late_and_corrected_days(spark):
    rng = random.Random(5)

    def made(k, days):
        rows = []
        for i in range(60):
            minute = rng.choice([rng.randrange(0, 40), rng.randrange(1400, 1440), rng.randrange(0, 1440)])
            ts = dt.datetime(2024, 1, 29) + rng.choice(days) * DAY + dt.timedelta(minutes=minute)
            rows.append((k + i, ts, rng.choice([1, 2, 3, -70000, None]), None, rng.choice(["web", "iOS", None]),
                         rng.choice([None, "Organic Search", "Other"]), rng.random() < 0.3, rng.choice([None, 1.5, 2.25])))
        return rows

    bind = lambda r: binding_of(events_df(spark, r), session_ids=False)
    rows, every = made(0, range(5)), specs(DateRange("2024-01-29", "2024-02-04"))
    store, path = new_dir(), new_dir()
    S.make_store(spark, bind(rows), store)
    M.make_summary(spark, store, path, every)
    for k in (1, 2):
        changed = sorted(rng.sample(range(6), 2))
        rows = [r for r in rows if (r[1].date() - dt.date(2024, 1, 29)).days not in changed]
        if k == 1:                               # the second time these days lose their events
            rows += made(1000 * k, changed)
        touched = S.refresh_store(spark, bind(rows), store, [dt.date(2024, 1, 29) + d * DAY for d in changed])
        again = M.refresh_summary(spark, store, path, every, touched)
        assert set(touched) <= set(again)
        for sp in every:
            assert M.report_from_summary(spark, store, path, sp).collect() == R.run_report(spark, sp, bind(rows)).collect()


def test_months_of_several_years_and_empty_ranges(spark, january):
    binding, store, path = january
    sp = ReportSpec("x", ALL, DateRange("2023-01-01", "2024-12-31"), dimensions=("month",), filter=R.WEB_FILTER, name="web")
    assert M.report_from_summary(spark, store, path, sp).collect() == R.run_report(spark, sp, binding).collect()
    nothing = ReportSpec("x", ALL, DateRange("2020-01-01", "2020-12-31"), name="all")
    assert M.report_from_summary(spark, store, path, nothing).collect() == []
    assert M.users_between(spark, store, path, nothing).first().active_users == 0
    with pytest.raises(ValueError):
        M.make_summary(spark, store, new_dir(), [ReportSpec("x", ALL, DateRange("2024-01-01", "2024-01-31"), filter=Exact("year", "2024"), name="y")])
