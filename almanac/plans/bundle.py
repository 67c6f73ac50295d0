"""Several reports run together, with presence checks (V1–V5) and the
long form of K4.

Reports over the same binding share one scan (``report.shared_counts``) as
long as sharing adds no join: a report whose filter needs a column that the
binding joins in has its own scan, with its filter pushed down, and the others
read the fact table alone.  Each such group is planned, executed and persisted
by itself, at the same time as the others, so a table that is missing or a value that cannot be read costs only
its own reports.  The bundle's long table has one row per (report, month) —
bounded by the calendar — and the per-report frames, the presence checks and
the sinks read the persisted groups.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dims
from ..operators.metrics import rounded
from ..operators.scaffold import complete_report_months
from ..session import checkpoint_dir, together
from ..sources.bindings import Binding
from . import report as R
from .spec import DateRange, ReportSpec, filter_fields

log = logging.getLogger(__name__)

# Column order of each ready-made report (internal names).
REPORT_COLUMNS = {
    "web": ("month", "year", "sessions", "revenue"),
    "app": ("month", "year", "active_users", "sessions", "revenue"),
    "organic": ("month", "year", "sessions", "active_users", "engagement_pct", "revenue"),
}
LONG_COLUMNS = ("report", "month", "year", "sessions", "active_users", "engagement_pct", "revenue")

SPEC_FACTORIES = {"web": R.web_spec, "app": R.app_spec, "organic": R.organic_spec}


class NoReportData(RuntimeError):
    """V3: every report of the bundle is empty (or failed); nothing to write."""


@dataclass
class Bundle:
    """The outcome of a bundle run.

    ``long``: report, month, year and every metric column (NULL where a
    report does not have the metric), ordered by report then calendar.
    ``reports``: one frame per report with its own columns.
    ``errors``: reports that failed, by name (V5).
    """

    long: DataFrame
    reports: dict[str, DataFrame]
    errors: dict[str, BaseException] = field(default_factory=dict)
    held: list[DataFrame] = field(default_factory=list, repr=False)

    def present(self) -> list[str]:
        """V1/V2: names of the reports that have rows (one small job on the
        persisted long table)."""
        have = {r["report"] for r in self.long.select("report").distinct().collect()}
        return [n for n in self.reports if n in have]

    def tidy(self) -> DataFrame:
        """K4, tidy form: (report, month, year, metric, value) — one row per
        metric a report has, values as double (``DataFrame.unpivot``)."""
        metric_cols = ["sessions", "active_users", "engagement_pct", "revenue"]
        wide = self.long.select("report", "month", "year",
                                *[F.col(c).cast("double").alias(c) for c in metric_cols])
        out = wide.unpivot(["report", "month", "year"], metric_cols, "metric", "value")
        return out.where(F.col("value").isNotNull())

    def release(self) -> None:
        """Drop what the bundle persisted."""
        for df in [self.long, *self.held]:
            df.unpersist()

    def presence(self) -> DataFrame:
        """V1/V2 as a table: ``report, has_rows, months`` for every report, the
        empty ones too."""
        spark = self.long.sparkSession
        names = spark.createDataFrame([(n,) for n in self.reports], "report string")
        months = self.long.groupBy("report").agg(F.count(F.lit(1)).alias("months"))
        return (names.join(months, "report", "left")
                .select("report", F.col("months").isNotNull().alias("has_rows"), F.coalesce("months", F.lit(0)).alias("months")))

    def non_empty(self) -> dict[str, DataFrame]:
        """V2: the reports with rows; V3: raise when there are none."""
        names = self.present()
        for n in self.reports:
            if n not in names:
                log.warning("report %s has no rows for the requested range and filters", n)
        if not names:
            raise NoReportData("no report has rows for the requested range and filters")
        return {n: self.reports[n] for n in names}


def is_empty(df: DataFrame) -> bool:
    """V1."""
    return df.isEmpty()


def _long_from_counts(counts: DataFrame, specs: Sequence[ReportSpec]) -> DataFrame:
    """Shared counts → the long table; a metric a report did not ask for is NULL."""
    has = {sp.name: set(sp.metrics) for sp in specs}

    def masked(metric: str, expr, typ: str):
        names = [n for n, ms in has.items() if metric in ms]
        if not names:
            return F.lit(None).cast(typ)
        return F.when(F.col("report").isin(*names), expr)

    out = counts.select(
        "report", "year", "month",
        masked("sessions", F.col("sessions").cast("long"), "long").alias("sessions"),
        masked("activeUsers", F.col("active_users").cast("long"), "long").alias("active_users"),
        masked("engagementRate", dims.percent_2dp("engaged_sessions", "sessions"), "double").alias("engagement_pct"),
        masked("totalRevenue", rounded("revenue_amount"), "double").alias("revenue"),
    )
    order = F.create_map(*[x for i, sp in enumerate(specs) for x in (F.lit(sp.name), F.lit(i))])
    ordered = R.bounded_sort(out.withColumn("_o", F.element_at(order, F.col("report"))), "_o", "year", "month")
    named = ordered.withColumn("month", dims.month_name(F.col("month")))
    return named.select(*LONG_COLUMNS)


def group_counts(spark: SparkSession, registry: Mapping[str, Binding], specs: Sequence[ReportSpec], on_error: str = "skip",
                 persist: bool = True, checkpoint: bool = False, limit: float | None = None,
                 ) -> tuple[list[tuple[DataFrame, list[ReportSpec]]], list[DataFrame], dict[str, BaseException]]:
    """Counts of the specs, one shared scan for those with the same binding,
    joins, dimensions and way of counting users; the persisted frames; and what
    failed, by report.  Scans that run here run at the same time, each with
    ``limit`` seconds if that is given."""
    groups: dict[tuple, tuple[Binding, list[ReportSpec]]] = {}
    errors: dict[str, BaseException] = {}
    found, held = [], []
    for sp in specs:
        try:
            b = registry[sp.property]
        except Exception as e:  # noqa: BLE001
            if on_error != "skip":
                raise
            log.warning("report %s skipped: %s", sp.name, e)
            errors[sp.name] = e
            continue
        joins = b.joined & {R.FIELD_COLUMN.get(f) for f in filter_fields(sp.filter)}
        groups.setdefault((id(b), joins, sp.dimensions, sp.approx_users), (b, []))[1].append(sp)
    def made(b: Binding, sps: list[ReportSpec]) -> DataFrame:
        part = R.shared_counts(spark, sps, b)
        if checkpoint:
            return part.checkpoint(eager=True)
        if persist:
            part = part.persist(StorageLevel.MEMORY_AND_DISK)
            held.append(part)
            part.count()               # runs the scan: a failure is this group's alone
        return part

    tasks = {", ".join(sp.name for sp in sps): partial(made, b, sps) for b, sps in groups.values()}
    parts, failed = together(spark, tasks, limit)
    for (name, _), (_, sps) in zip(tasks.items(), groups.values()):
        if name in parts:
            found.append((parts[name], sps))
            continue
        if on_error != "skip":
            raise failed[name]
        for sp in sps:
            log.warning("report %s skipped: %s", sp.name, str(failed[name])[:500])
            errors[sp.name] = failed[name]
    return found, held, errors


def run_specs(spark: SparkSession, registry: Mapping[str, Binding], specs: Sequence[ReportSpec], on_error: str = "skip",
              rate_as_percent: bool = False) -> tuple[dict[str, DataFrame], list[DataFrame], dict[str, BaseException]]:
    """Any reports (by name), scans shared as in a bundle; the frames to
    unpersist; and the reports that failed."""
    found, held, errors = group_counts(spark, registry, specs, on_error)
    out = {}
    for counts, sps in found:
        for sp in sps:
            own = counts.where(F.col("report") == F.lit(sp.name)).drop("report")
            out[sp.name] = R.finish_report(spark, own, sp, rate_as_percent, "null" if "year" in sp.dimensions else "keep")
    return {sp.name: out[sp.name] for sp in specs if sp.name in out}, held, errors


def run_bundle(spark: SparkSession, registry: Mapping[str, Binding], rng: DateRange,
               names: Sequence[str] = ("web", "app", "organic"), on_error: str = "skip",
               persist: bool = True, specs: Sequence[ReportSpec] | None = None,
               checkpoint: bool = False, fill_months: bool = False,
               approx_users: float | None = None, limit: float | None = None) -> Bundle:
    """Run the reports together.

    ``on_error="skip"`` drops a report that cannot be planned or executed
    (unknown property, missing table, a value that cannot be read) and keeps
    the others (V5); ``"raise"`` re-raises.  Execution is tried here when the
    result is kept (``persist`` or ``checkpoint``); a lazy bundle fails where it
    is used.  Reports are grouped by binding and by the joins they need; each
    group is one shared scan, and the groups run at the same time.  A group that
    takes more than ``limit`` seconds is cancelled and counts as failed.

    ``fill_months`` lists every month of ``rng`` for every report, empty
    months with zero counts (V4).  ``approx_users`` (a relative standard
    deviation) counts active users with HyperLogLog++ in the ready-made
    reports.

    The long table is reused by every report frame, the presence checks and
    the sinks.  ``persist`` keeps it on the executors (recomputed from
    lineage if one is lost); ``checkpoint`` instead writes it once to the
    shared folder the session names in ``spark.checkpoint.dir`` and cuts the
    lineage there.
    """
    errors: dict[str, BaseException] = {}
    if specs is not None and any("year" not in sp.dimensions for sp in specs):
        raise ValueError("a bundle holds (year, month) reports; run month-only reports with run_report")
    if specs is None:
        specs = []
        for n in names:
            try:
                specs.append(SPEC_FACTORIES[n](rng, approx_users=approx_users))
            except Exception as e:  # noqa: BLE001
                if on_error != "skip":
                    raise
                errors[n] = e
    if checkpoint and not checkpoint_dir(spark):
        raise RuntimeError("checkpoint=True needs spark.checkpoint.dir set to a shared folder")
    found, held, failed = group_counts(spark, registry, specs, on_error, persist, checkpoint, limit)
    errors |= failed
    parts, done = [c for c, _ in found], [sp.name for _, sps in found for sp in sps]
    kept = [sp for sp in specs if sp.name in done]
    if not kept:
        raise NoReportData(f"no report could be made: { {k: str(e)[:200] for k, e in errors.items()} }")
    counts = parts[0]
    for p in parts[1:]:
        counts = counts.unionByName(p, allowMissingColumns=True)
    for c, kind in (("sessions", "long"), ("active_users", "long"), ("engaged_sessions", "long"), ("revenue_amount", "decimal(38,6)")):
        if c not in counts.columns:    # no report that is left asks for it
            counts = counts.withColumn(c, F.lit(None).cast(kind))
    if fill_months:
        counts = complete_report_months(spark, counts, rng, [sp.name for sp in kept])
    long = _long_from_counts(counts, kept)
    if checkpoint:
        long = long.checkpoint(eager=True)
    reports = {}
    for sp in kept:
        cols = REPORT_COLUMNS.get(sp.name) or ("month", "year") + tuple(
            c for c in ("sessions", "active_users", "engagement_pct", "revenue") if c in long.columns)
        reports[sp.name] = long.where(F.col("report") == F.lit(sp.name)).select(*cols)
    return Bundle(long=long, reports=reports, errors=errors, held=held)
