"""Sessionize once, store by day, report from the stored table."""

import re
import tempfile

from conftest import SF01, plan_of

from almanac.plans import report as R
from almanac.plans.spec import DateRange
from almanac.sources.properties import events_registry
from almanac.sources.stored import sessionized_binding, write_sessionized


def test_stored_sessions_give_the_same_reports(spark):
    reg = events_registry(SF01)
    path = tempfile.mkdtemp(prefix="almanac-stored-") + "/events_by_day"
    write_sessionized(spark, reg["events"], path)
    stored = sessionized_binding(path)
    y = DateRange("2024-01-01", "2024-12-31")
    for rep in (R.organic_report, R.app_report, R.web_report):
        assert rep(spark, stored, y, prop="x").collect() == rep(spark, reg, y).collect()
    # days of the range only: the date partition column is pruned
    half = DateRange("2024-01-10", "2024-01-20")
    df = R.app_report(spark, stored, half, prop="x")
    plan = plan_of(df)
    assert re.search(r"PartitionFilters: \[[^\]]*event_date", plan)
    assert df.collect() == R.app_report(spark, reg, half).collect()
