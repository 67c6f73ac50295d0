"""P1–P9 and T1–T7 on hand-made values (FIXTURES.md §5: unknown_month,
rates, format_values)."""

from pyspark.sql import functions as F

from almanac.functions import dims as D
from almanac.functions import fmt as T
from almanac.plans import report as R


def test_month_and_year_codes(spark):
    df = spark.sql("select TIMESTAMP_NTZ'2025-03-05 10:00:00' ts, TIMESTAMP_NTZ'0999-12-31 00:00:00' t2")
    r = df.select(D.month_code("ts").alias("m"), D.year_code("ts").alias("y"), D.year_code("t2").alias("y2")).first()
    assert (r.m, r.y, r.y2) == ("03", "2025", "0999")


def test_unknown_month_null_vs_keep(spark):
    df = spark.createDataFrame([("01",), ("13",), (None,)], "m string")
    rows = df.select("m", D.month_name("m").alias("null_form"), D.month_name_or_code("m").alias("keep")).collect()
    got = {r.m: (r.null_form, r.keep) for r in rows}
    assert got["01"] == ("janeiro", "janeiro")
    assert got["13"] == (None, "13")
    assert got[None] == (None, None)


def test_calendar_sort_unknown_last(spark):
    df = spark.createDataFrame([("março",), ("13",), ("janeiro",), ("dezembro",)], "month string")
    assert [r.month for r in R.sort_calendar(df).collect()] == ["janeiro", "março", "dezembro", "13"]


def test_percent_rounding_in_integers(spark):
    rates = [(0, 0), (0, 5), (1, 3), (57, 200), (1, 8)]   # 1/8 = 12.5 % exactly; 1/3 = 33.33 %
    df = spark.createDataFrame(rates, "e long, s long")
    got = [r.p for r in df.select(D.percent_2dp("e", "s").alias("p")).collect()]
    assert got == [None, 0.0, 33.33, 28.5, 12.5]
    # an exact half at the third decimal rounds up: 1/16 = 6.25 % , 1/1600 = 0.0625 % -> 0.06 ; 3/1600 = 0.1875 -> 0.19
    df2 = spark.createDataFrame([(1, 1600), (3, 1600), (1, 400), (1, 800)], "e long, s long")
    # 1/800 = 0.125 % exactly: half-up gives 0.13 (binary rounding would give 0.12)
    assert [r.p for r in df2.select(D.percent_2dp("e", "s").alias("p")).collect()] == [0.06, 0.19, 0.25, 0.13]


def test_formats_match_python(spark):
    vals = [0.0, 1234567.0, 1234567.895, -1234.5, None]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    rows = df.select(T.int_br("x").alias("i"), T.money_br("x").alias("m"), T.percent("x").alias("p"),
                     T.int_us("x").alias("iu"), T.money_us("x").alias("mu")).collect()
    for v, r in zip(vals, rows):
        if v is None:
            assert r.i is None and r.m is None and r.p is None
            continue
        us0 = f"{v:,.0f}"
        assert r.iu == us0
        assert r.i == us0.replace(",", ".")
        assert r.m == "R$ " + f"{v:,.2f}".replace(",", "X").replace(".", ",").replace("X", ".")
        assert r.p == f"{v:.2f}%"
        assert r.mu == "R$ " + f"{v:,.2f}"


def test_row_line(spark):
    df = spark.createDataFrame([("março", "2025", 1234, 5678, 9876.5)], "m string, y string, u long, s long, r double")
    line = df.select(T.row_line("m", "y", "u", "s", "r").alias("l")).first().l
    assert line == "março/2025: 1,234 usuários | 5,678 sessões | R$ 9,876.50"


def test_display_kind_by_heading():
    assert T.display_kind("Mês", 0) == "plain"
    assert T.display_kind("Receita orgânica", 5) == "money"
    assert T.display_kind("Taxa de engajamento (%)", 4) == "percent"
    assert T.display_kind("Sessões", 3) == "count"


def test_display_widths_follow_python_str(spark):
    vals = [("janeiro", "2025", 0, 12345678.9), ("fevereiro", "2025", 7, 1.5e16)]
    df = spark.createDataFrame(vals, "month string, year string, n long, revenue double")
    w = {r.column: r.width for r in T.display_widths(df, {"month": "Mês", "revenue": "Receita"}).collect()}
    assert w["month"] == len("fevereiro") + 2
    assert w["year"] == 6
    assert w["n"] == 3                      # heading "n"; the 0 cell is skipped, "7" has length 1
    assert w["revenue"] == min(max(len(str(12345678.9)), len(str(1.5e16))) + 2, 30)


def test_py_str_length_all_ranges(spark):
    vals = [12345678.9, 1.5e16, 1e16, 1e22, 1.5e-5, 1e-5, 0.00015, 0.001, 1234.5, 10000000.0, -2.5e7, 1e300]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    from pyspark.sql.types import DoubleType
    got = [r.n for r in df.select(T.py_str_length(F.col("x"), DoubleType()).alias("n")).collect()]
    # a cell keeps a whole number without its fraction
    assert got == [len(str(int(v)) if v.is_integer() and abs(v) < 1e16 else str(v)) for v in vals]


def test_ts_text_is_zone_free(spark):
    df = spark.sql("select TIMESTAMP_NTZ'2018-11-04 00:30:00.000120' ts union all "
                   "select TIMESTAMP_NTZ'0999-01-02 03:04:05' union all select TIMESTAMP_NTZ'2024-03-10 02:30:00.5'")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")   # 2024-03-10 02:30 does not exist there
        got = [r.t for r in df.select(D.ts_text("ts").alias("t")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == ["2018-11-04 00:30:00.000120", "0999-01-02 03:04:05.000000", "2024-03-10 02:30:00.500000"]
