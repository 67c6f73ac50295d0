import datetime as dt
import os
import sys
import tempfile

import pytest
from hypothesis import settings as _hsettings

# Property tests draw the same examples on every run (checked locally with
# several seeds); a run in CI is then reproducible.
_hsettings.register_profile("almanac", derandomize=True)
_hsettings.load_profile("almanac")

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    b = (SparkSession.builder.master("local[*]").appName("almanac-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true"))
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    # Tests only: a checkpoint folder when the session names none.
    if not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="almanac-ckpt-"))
    yield s


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


EVENT_SCHEMA = ("event_id long, ts timestamp_ntz, user_id long, session_id long, platform string, "
                "channel string, engaged boolean, revenue double")


def events_df(spark, rows):
    """Hand-made contract rows: (event_id, ts, user_id, session_id, platform, channel, engaged, revenue)."""
    fixed = [(r[0], ts(r[1]) if isinstance(r[1], str) else r[1], *r[2:]) for r in rows]
    return spark.createDataFrame(fixed, EVENT_SCHEMA)


def binding_of(df, **kw):
    from almanac.sources.bindings import table_binding

    return table_binding("fixture", lambda spark: df, **{c: c for c in df.columns}, **kw)


def plan_of(df, mode: str = "formatted") -> str:
    """The physical plan as ``df.explain(mode)`` prints it."""
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()
