"""Command line: run the monthly reports for a period, write them, print a summary.

    python -m almanac --data DIR --year 2025 --out OUT [--format parquet|csv]
    python -m almanac --data DIR --start 2025-01-01 --end 2025-06-30 --out OUT
    python -m almanac --data DIR --year 2025 --out OUT --app-year
    python -m almanac --data DIR --out OUT --request requests.json
    python -m almanac --bindings tables.json --year 2025 --out OUT

The default run is the bundle (web, app and organic reports from shared
scans); ``--app-year`` runs the month-only app report with yearly totals.
``--bindings`` maps property names to one's own tables (see
``sources.bindings.bindings_from_file``).  Reports are written under their
headings.  An option that a route does not use is an error.
On a cluster, launch it with ``spark-submit`` so the session comes
configured; ``--data`` and ``--out`` are shared paths.  Only the totals
(one row per report) come back to the driver, for the summary.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from .operators import totals as TO
from .plans import bundle as BU
from .plans import report as R
from .plans.spec import DateRange
from .session import DEFAULTS
from .functions.fmt import row_line
from .sources import sinks
from .sources.bindings import bindings_from_file
from .sources.properties import PropertyRegistry, default_registry, events_registry

# Summary labels per report (what each summary line shows).
SUMMARY = {
    "web": [("Sessões Totais", "sessions_display"), ("Receita Total", "revenue_display")],
    "app": [("Usuários Ativos", "sum_monthly_users_display"), ("Sessões", "sessions_display"),
            ("Receita", "revenue_display")],
    "organic": [("Sessões Orgânicas", "sessions_display"), ("Usuários Orgânicos", "sum_monthly_users_display"),
                ("Taxa Engajamento Média", "avg_monthly_engagement_pct_display"),
                ("Receita Orgânica", "revenue_display")],
}


def _range(a) -> DateRange:
    if a.year:
        return DateRange(f"{a.year}-01-01", f"{a.year}-12-31")
    if not (a.start and a.end):
        raise SystemExit("give --year, or --start and --end")
    return DateRange(a.start, a.end)


def _session() -> SparkSession:
    b = SparkSession.builder.appName("almanac")
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    return b.getOrCreate()


def summary_lines(totals_rows) -> list[str]:
    """Text of the run summary from the totals rows (one per report)."""
    out = []
    for r in totals_rows:
        d = r.asDict()
        out.append(f"{d['report']}: {d['months']} meses")
        for label, col in SUMMARY.get(d["report"], []):
            if d.get(col) is not None:
                out.append(f"   {label}: {d[col]}")
    return out


def run(argv: list[str] | None = None, spark: SparkSession | None = None) -> str:
    p = argparse.ArgumentParser(prog="python -m almanac", description=__doc__.split("\n\n")[0])
    p.add_argument("--data", help="folder with the event tables")
    p.add_argument("--bindings", help="JSON file: property names and the tables behind them")
    p.add_argument("--year", type=int)
    p.add_argument("--start")
    p.add_argument("--end")
    p.add_argument("--out", required=True, help="output folder (shared storage on a cluster)")
    p.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    p.add_argument("--prefix", default="monthly_reports")
    p.add_argument("--events", action="store_true", help="read the events table (sessions by gap)")
    p.add_argument("--app-year", action="store_true", help="month-only app report with yearly totals")
    p.add_argument("--fill-months", action="store_true", help="list every month of the range, empty ones as 0")
    p.add_argument("--approx-users", type=float, default=None,
                   help="count active users approximately (relative standard deviation, e.g. 0.01)")
    p.add_argument("--request", help="JSON file with report requests ({name: request}); runs those instead")
    p.add_argument("--internal-names", action="store_true", help="write internal column names, not headings")
    p.add_argument("--display", action="store_true", help="write numbers as display strings")
    a = p.parse_args(argv)
    if bool(a.data) == bool(a.bindings):
        p.error("give --data or --bindings")
    if a.bindings and a.events:
        p.error("--events belongs to --data; a bindings file says how sessions are made")
    if a.year and (a.start or a.end):
        p.error("give --year, or --start and --end, not both")
    if a.request and (a.year or a.start or a.end or a.app_year):
        p.error("a request file has its own ranges: no --year, --start, --end or --app-year with --request")
    spark = spark or _session()
    if a.bindings:
        reg = PropertyRegistry(bindings_from_file(a.bindings))
    else:
        reg = events_registry(a.data) if a.events else default_registry(a.data)
    if a.request:
        return _run_requests(a, spark, reg)
    rng = _range(a)
    label = str(a.year) if a.year else f"{rng.start}_{rng.end}"
    if a.app_year:
        return _run_app_year(a, spark, reg, rng, label)

    bundle = BU.run_bundle(spark, reg, rng, fill_months=a.fill_months, approx_users=a.approx_users)
    try:
        path = _write(a, bundle.non_empty(), a.prefix, label)
        tot = TO.report_totals(bundle.long, by=("report",)).collect()   # one row per report
    except BU.NoReportData as e:
        _nothing(e)
    finally:
        bundle.release()
    order = {n: i for i, n in enumerate(bundle.reports)}
    for line in summary_lines(sorted(tot, key=lambda r: order.get(r.report, 99))):
        print(line)
    for name, err in bundle.errors.items():
        print(f"{name}: skipped ({str(err)[:300]})", file=sys.stderr)
    return path


def _nothing(why: Exception) -> None:
    print(f"no report has rows for this period and these filters; nothing written ({why})", file=sys.stderr)
    raise SystemExit(1)


def _write(a, reports: dict, prefix: str, label: str) -> str:
    """Write the reports; those that fail are named, the others stay written."""
    try:
        path = sinks.write_reports(reports, a.out, prefix, label, a.format, headings=not a.internal_names, display=a.display)
    except sinks.ReportsFailed as e:
        print(e, file=sys.stderr)
        path = e.path
    print(f"written: {path}")
    return path


def _run_app_year(a, spark: SparkSession, reg, rng: DateRange, label: str) -> str:
    rep = R.app_year_report(spark, reg, rng, year_label=str(a.year) if a.year else None,
                            fill_months=a.fill_months, approx_users=a.approx_users).persist()   # at most a row a month
    try:
        path = _write(a, {"app_year": rep}, a.prefix + "_app", label)
        line = row_line("month", "year", "app_users_total", "app_sessions_total", "app_revenue_total")
        for r in rep.select(line.alias("line")).collect():
            print(r.line)
        t = TO.app_year_totals(rep).first()
    except BU.NoReportData as e:
        _nothing(e)
    finally:
        rep.unpersist()
    print(f"   months: {t.months}  users: {t.users_total_display}  sessions: {t.sessions_total_display}"
          f"  revenue: {t.revenue_total_display}")
    return path


def _run_requests(a, spark: SparkSession, reg) -> str:
    """Each named request (plain-data request literal) becomes a report;
    requests on one property share its scan."""
    import json

    from .plans.spec import ReportSpec

    with open(a.request) as f:
        requests = json.load(f)
    specs = [ReportSpec.from_request(req, name=name, fill_months=a.fill_months, approx_users=a.approx_users)
             for name, req in requests.items()]
    reports, held, errors = BU.run_specs(spark, reg, specs)
    try:
        for name, err in errors.items():
            print(f"{name}: skipped ({str(err)[:300]})", file=sys.stderr)
        return _write(a, reports, a.prefix, "requests")
    except BU.NoReportData as e:
        _nothing(e)
    finally:
        for df in held:
            df.unpersist()


if __name__ == "__main__":
    run()
