"""K1–K3: writing reports.

The output folder is the caller's (a shared filesystem or object store on a
cluster).  A run id — prefix, year, ``YYYYmmdd_HHMMSS`` — is made once on the
driver and names the run's folder, so reruns never overwrite each other.
"""

from __future__ import annotations

import datetime as dt
import json
import logging
import os
import uuid
from collections.abc import Mapping
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.fmt import with_display
from ..functions.labels import HEADINGS, labelled
from ..plans.bundle import Bundle, NoReportData
from ..session import remove, together

log = logging.getLogger(__name__)


class ReportsFailed(RuntimeError):
    """Some reports could not be written; the others were.  ``path`` is the
    run's folder, ``failed`` the errors by report."""

    def __init__(self, path: str, failed: dict[str, BaseException]):
        super().__init__(f"reports not written to {path}: " + "; ".join(f"{k}: {str(e)[:200]}" for k, e in sorted(failed.items())))
        self.path, self.failed = path, failed


def as_written(df: DataFrame, name: str, headings: bool = False, display: bool = False) -> DataFrame:
    """The report as its readers see it: ``display`` turns numbers into
    their display strings, ``headings`` renames the columns of a ready-made
    report (others keep their names)."""
    if display:
        shown = with_display(df, HEADINGS.get(name))
        df = shown.select(*[F.col(f"{c}_display").alias(c) for c in df.columns])
    return labelled(df, name) if headings and name in HEADINGS else df


def _fs(spark: SparkSession, path: str):
    """The file system of a path, and the path for it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _remove_if_empty(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p) and not len(fs.listStatus(p)):
        fs.delete(p, False)


def _publish(spark: SparkSession, stage: str, base: str) -> None:
    fs, target = _fs(spark, base)
    fs.mkdirs(target.getParent())
    if fs.exists(target) or not fs.rename(_fs(spark, stage)[1], target):
        raise FileExistsError(f"run folder {base} cannot be made")


def manifest_path(out_dir: str, run: str) -> str:
    return os.path.join(out_dir, "_runs", f"{run}.json")


def _write_manifest(spark: SparkSession, out_dir: str, run: str, content: dict) -> None:
    fs, p = _fs(spark, manifest_path(out_dir, run))
    out = fs.create(p, False)
    try:
        out.write(bytearray(json.dumps(content, sort_keys=True).encode()))
    finally:
        out.close()


def read_manifest(spark: SparkSession, out_dir: str, run: str) -> dict:
    """``{"run", "format", "reports": {name: rows}, "failed": [names]}`` of a
    published run."""
    fs, p = _fs(spark, manifest_path(out_dir, run))
    if not fs.exists(p):
        raise FileNotFoundError(f"run {run} has not been published in {out_dir}")
    stream = fs.open(p)
    try:
        return json.loads(bytes(stream.readAllBytes()))
    finally:
        stream.close()


def read_run(spark: SparkSession, out_dir: str, run: str) -> dict[str, DataFrame]:
    """The reports of a published run, by name: those its manifest lists."""
    m = read_manifest(spark, out_dir, run)
    r = spark.read.format(m["format"])
    if m["format"] == "csv":
        r = r.option("header", "true").option("inferSchema", "true")
    return {name: r.load(os.path.join(out_dir, run, name)) for name in m["reports"]}


def run_id(prefix: str, year: str | int, now: dt.datetime | None = None) -> str:
    """K3: ``<prefix>_<year>_<YYYYmmdd_HHMMSS>``."""
    now = now or dt.datetime.now()
    return f"{prefix}_{year}_{now.strftime('%Y%m%d_%H%M%S')}"


def write_report(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> str:
    """K2: one report to ``path`` (Parquet, or CSV with a header line)."""
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", "true")
    w.save(path)
    return path


def _write_counted(df: DataFrame, path: str, base: str, name: str, fmt: str, headings: bool, display: bool) -> int:
    """Write one report; the number of its rows."""
    if _exists(df.sparkSession, base):
        raise FileExistsError(f"run folder {base} is there already")
    seen = Observation()
    write_report(as_written(df.observe(seen, F.count(F.lit(1)).alias("rows")), name, headings, display), path, fmt)
    return seen.get.get("rows", 0)                  # none: the plan was found to be empty


def write_reports(reports: Mapping[str, DataFrame], out_dir: str, prefix: str, year: str | int,
                  fmt: str = "parquet", on_error: str = "skip", now: dt.datetime | None = None,
                  headings: bool = False, display: bool = False, limit: float | None = None) -> str:
    """K1: every non-empty report to ``<out>/<run id>/<name>``; returns the
    run folder.  Empty reports are left out with a warning (V1, V2); if none
    has rows, nothing is written and :class:`NoReportData` is raised (V3).  A
    report that fails leaves the others (V5): they are written, what the failed
    one left is removed, and :class:`ReportsFailed` names it at the end
    (``on_error="raise"``: its own error, and nothing is published).  Reports are
    written at the same time; one that takes more than ``limit`` seconds is
    cancelled and counts as failed.
    ``headings``, ``display``: see :func:`as_written`.

    The reports are written aside and the run folder is made by one rename, then
    listed with its row counts in a manifest (:func:`read_manifest`): a run that is
    stopped midway shows neither.  Each report's plan runs once; its rows are
    counted while they are written."""
    run = run_id(prefix, year, now)
    base, aside = os.path.join(out_dir, run), os.path.join(out_dir, "_writing")
    stage = os.path.join(aside, f"{run}-{uuid.uuid4().hex}")
    written, spark = {}, None
    try:
        tasks = {}
        for name, df in reports.items():
            spark = df.sparkSession
            tasks[name] = partial(_write_counted, df, os.path.join(stage, name), base, name, fmt, headings, display)
        rows, failed = together(spark, tasks, limit) if tasks else ({}, {})
        for name in reports:
            if name in failed:
                if on_error != "skip":
                    raise failed[name]
                remove(spark, os.path.join(stage, name))
                log.warning("report %s not written: %s", name, str(failed[name])[:500])
            elif rows[name]:
                written[name] = rows[name]
            else:
                remove(spark, os.path.join(stage, name))
                log.warning("report %s has no rows for the requested range and filters", name)
        if not written:
            why = f"; failed: {sorted(failed)}" if failed else ""
            raise NoReportData(f"no report has rows; nothing written{why}")
        _publish(spark, stage, base)
        _write_manifest(spark, out_dir, run, {"run": run, "format": fmt, "reports": written, "failed": sorted(failed)})
    finally:
        if spark is not None:
            remove(spark, stage)
            _remove_if_empty(spark, aside)
    if failed:
        raise ReportsFailed(base, failed)
    return base


def write_bundle(bundle: Bundle, out_dir: str, prefix: str, year: str | int, fmt: str = "parquet",
                 now: dt.datetime | None = None, headings: bool = False, display: bool = False) -> str:
    """K1 over a bundle: each report with rows gets its own folder."""
    return write_reports(bundle.non_empty(), out_dir, prefix, year, fmt, now=now, headings=headings, display=display)


def write_long(bundle: Bundle, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> str:
    """K4: the bundle's long table in one job, partitioned by ``report``."""
    if bundle.long.isEmpty():
        raise NoReportData("no report has rows; nothing written")
    w = bundle.long.write.mode(mode).format(fmt).partitionBy("report")
    if fmt == "csv":
        w = w.option("header", "true")
    w.save(path)
    return path
