"""S2 typed rows and P8 headings."""

import pytest

from almanac.functions.labels import HEADINGS, labelled
from almanac.sources import typed


def _wire(spark, rows):
    return spark.createDataFrame(rows, "month string, year string, sessions string, revenue string")


def test_conform_casts_to_the_report_schema(spark):
    df = typed.conform(_wire(spark, [("janeiro", "2025", "12", "3.5")]), typed.REPORT_SCHEMAS["web"])
    assert df.schema == typed.REPORT_SCHEMAS["web"]
    assert tuple(df.first()) == ("janeiro", "2025", 12, 3.5)


def test_bad_value_raises_or_is_null_when_lenient(spark):
    bad = _wire(spark, [("janeiro", "2025", "doze", "3.5")])
    with pytest.raises(Exception):
        typed.conform(bad, typed.REPORT_SCHEMAS["web"]).collect()
    r = typed.conform(bad, typed.REPORT_SCHEMAS["web"], lenient=True).first()
    assert r.sessions is None and r.revenue == 3.5


def test_empty_input_keeps_schema(spark):
    df = typed.conform(_wire(spark, []), typed.REPORT_SCHEMAS["web"])
    assert df.isEmpty() and df.schema == typed.REPORT_SCHEMAS["web"]


def test_missing_column_is_an_error(spark):
    with pytest.raises(ValueError):
        typed.conform(_wire(spark, []).drop("revenue"), typed.REPORT_SCHEMAS["web"])


def test_headings_applied_last(spark):
    df = spark.createDataFrame([("março", "2025", 1, 2, 33.33, 4.0)],
                               "month string, year string, sessions long, active_users long, "
                               "engagement_pct double, revenue double")
    out = labelled(df, "organic")
    assert out.columns == [HEADINGS["organic"][c] for c in df.columns]
    assert "Taxa de engajamento (%)" in out.columns
