"""Spark session settings the library is tuned for."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor, wait

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Settings that matter for these plans at any scale:
# * AQE re-plans at run time: coalesces small shuffle partitions, turns a
#   sort-merge join into a broadcast one when a side proves small, and splits
#   skewed join partitions.
# * The session zone is pinned: month borders of `timestamp` columns depend on it.
# * Streaming session windows merge sessions inside each partition before the
#   shuffle (a partial aggregate for a busy user).
DEFAULTS = {
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Starting points for a large cluster scanning ~100 TB (set at submit time;
# the library does not set them):
# * spark.sql.files.maxPartitionBytes 512m — a split counts file bytes, and the
#   reports read 3–6 columns, so a task reads far less than the split; fewer,
#   larger splits cut scheduling overhead (100 TB / 512 MB ≈ 200k tasks).
# * spark.sql.shuffle.partitions 2–3 × total cores, with AQE coalescing and
#   spark.sql.adaptive.advisoryPartitionSizeInBytes 128m; every shuffle here
#   carries partial aggregates, so the volumes are a fraction of the scan.
# * spark.sql.adaptive.skewJoin.enabled true (also the default) for the
#   event-level session join and the lookup join.
CLUSTER_HINTS = {
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}


def get_spark(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "almanac",
              extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULTS)
    conf.update({"spark.sql.shuffle.partitions": str(shuffle_partitions), "spark.ui.enabled": "false"})
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``
    (None when unset).  Read from the session, never chosen here; a context
    that already has a checkpoint folder keeps it."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        spark.sparkContext.setCheckpointDir(d)
    return d


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or
    the context's checkpoint folder.  A local session that names none gets a
    temporary one (tests); on a cluster that is an error, because every
    executor would write to its own disk."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if d:
        return d
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    import tempfile

    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="almanac-"))
    return spark.sparkContext.getCheckpointDir()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, on whatever file system it lies."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


class TimeLimit(RuntimeError):
    """A task's jobs were cancelled at its time limit."""


def together(spark: SparkSession, tasks: Mapping[str, Callable[[], object]], limit: float | None = None,
             width: int = 8) -> tuple[dict[str, object], dict[str, BaseException]]:
    """Run the tasks at the same time, at most ``width`` of them; what each
    returned, and the errors of those that failed.

    Each has a thread, a job group and a scheduler pool of its own: where the
    session's ``spark.scheduler.mode`` is FAIR a short task is not kept waiting by
    a long one.  A task that takes more than ``limit`` seconds of its own has its
    jobs cancelled; the others go on.  Local properties of the calling thread hold
    in the tasks; its own job group is left as it is."""
    sc, run = spark.sparkContext, uuid.uuid4().hex
    late: set[str] = set()

    def one(k: int, name: str, task: Callable[[], object]) -> object:
        group = f"almanac-{run}-{name}"
        sc.setJobGroup(group, name, interruptOnCancel=True)
        sc.setLocalProperty("spark.scheduler.pool", f"almanac-{k}")
        timer = None
        if limit is not None:
            def stop() -> None:
                late.add(name)
                sc.cancelJobGroup(group)
            timer = threading.Timer(limit, stop)
            timer.daemon = True
            timer.start()
        try:
            out = task()
        except Exception as e:
            if name in late:
                raise TimeLimit(f"{name}: cancelled after {limit} s") from e
            raise
        finally:
            if timer is not None:
                timer.cancel()
        return out

    done, errors = {}, {}
    with ThreadPoolExecutor(max(1, min(width, len(tasks)))) as pool:
        running = {name: pool.submit(inheritable_thread_target(spark)(one), k, name, task) for k, (name, task) in enumerate(tasks.items())}
        wait(running.values())
    for name, f in running.items():
        e = f.exception()
        if e is None:
            done[name] = f.result()
        elif isinstance(e, Exception):
            errors[name] = e
        else:
            raise e
    return done, errors
