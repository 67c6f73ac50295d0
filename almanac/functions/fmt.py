"""Number formats for display, as JVM-side string expressions.

``format_number`` formats the exact binary value of a double, ties to even —
the same rounding as Python's ``format`` — so the strings equal the ones the
report summaries print.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType, StringType

# Currency prefix and the words of the one-line row summary.
CURRENCY = "R$ "
USERS_WORD = "usuários"
SESSIONS_WORD = "sessões"
# Heading markers that choose a display format.
MONEY_MARKER = "Receita"
PERCENT_MARKER = "%"
MAX_WIDTH = 30


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def int_br(x: Column | str) -> Column:
    """``1.234.567`` (point groups thousands)."""
    return F.translate(F.format_number(_c(x), 0), ",", ".")


def money_br(x: Column | str) -> Column:
    """``R$ 1.234.567,90`` (point groups thousands, comma for decimals)."""
    return F.concat(F.lit(CURRENCY), F.translate(F.format_number(_c(x), 2), ",.", ".,"))


def percent(x: Column | str) -> Column:
    """``75.50%`` — two decimals, point as separator, no grouping."""
    return F.concat(F.call_function("format_number", _c(x), F.lit("0.00")), F.lit("%"))


def int_us(x: Column | str) -> Column:
    """T4: ``1,234,567``."""
    return F.format_number(_c(x), 0)


def money_us(x: Column | str) -> Column:
    """T4: ``R$ 1,234,567.90``."""
    return F.concat(F.lit(CURRENCY), F.format_number(_c(x), 2))


def row_line(month: Column | str, year: Column | str, users: Column | str,
             sessions: Column | str, revenue: Column | str) -> Column:
    """T5: ``março/2025: 1,234 usuários | 5,678 sessões | R$ 9,876.50``."""
    return F.concat(_c(month), F.lit("/"), _c(year), F.lit(": "),
                    int_us(users), F.lit(f" {USERS_WORD} | "),
                    int_us(sessions), F.lit(f" {SESSIONS_WORD} | "),
                    money_us(revenue))


def display_kind(heading: str, position: int) -> str:
    """T6 rule: the first two columns stay plain; a heading with the money
    marker is money, with ``%`` a percent, any other a count."""
    if position < 2:
        return "plain"
    if MONEY_MARKER in heading:
        return "money"
    if PERCENT_MARKER in heading:
        return "percent"
    return "count"


def with_display(df: DataFrame, headings: Mapping[str, str] | None = None) -> DataFrame:
    """Add ``<col>_display`` strings chosen by each column's heading.

    ``headings`` maps column → heading (default: the column name).  Zero is
    formatted like any other number; NULL stays NULL.
    """
    headings = dict(headings or {})
    out = []
    for i, f in enumerate(df.schema.fields):
        kind = display_kind(headings.get(f.name, f.name), i)
        c = F.col(f.name)
        if kind == "plain" or not isinstance(f.dataType, NumericType):
            e = c.cast("string")
        elif kind == "money":
            e = money_br(c)
        elif kind == "percent":
            e = percent(c)
        else:
            e = int_br(c)
        out.append(e.alias(f"{f.name}_display"))
    return df.select("*", *out)


def py_str_length(c: Column, dtype) -> Column:
    """Length of the text a spreadsheet cell with a value of ``dtype`` reads back as.

    Strings and integers print alike.  A whole double is stored without its
    fraction (``1200``, not ``1200.0``); other doubles print as Python's
    ``str()``.  For doubles, Spark and Python agree
    between 1e-3 and 1e7; outside it Spark writes ``1.23456789E7`` where
    Python writes ``12345678.9`` (fixed notation from 1e-4 up to 1e16, then
    ``1.5e+16`` with at least two exponent digits).  The length is rebuilt
    from the mantissa digits and the exponent.  Exact for |x| < 1e16 (checked
    on random values); above that the JVM's digit string is sometimes one
    digit longer than Python's shortest form.
    """
    s = c.cast("string")
    if not isinstance(dtype, (DoubleType, FloatType)):
        return F.length(s)
    pat = r"^(-?)(\d)\.(\d+)E(-?\d+)$"
    sign = F.length(F.regexp_extract(s, pat, 1))
    digits = F.regexp_replace(F.concat(F.regexp_extract(s, pat, 2), F.regexp_extract(s, pat, 3)), "0+$", "")
    n = F.greatest(F.length(digits), F.lit(1))
    exp = F.regexp_extract(s, pat, 4).cast("int")
    mantissa = F.when(n == 1, F.lit(1)).otherwise(n + 1)
    sci = mantissa + 2 + F.greatest(F.length(F.abs(exp).cast("string")), F.lit(2))
    py = (F.when(exp >= 16, sci)
          .when(exp >= 0, F.when(n - 1 <= exp, exp + 1).otherwise(n + 1))
          .when(exp >= -4, 2 + (-exp - 1) + n)
          .otherwise(sci))
    return F.when(s.rlike(pat), sign + py).otherwise(F.length(F.regexp_replace(s, r"\.0$", "")))


def _truthy(c: Column, dtype) -> Column:
    if isinstance(dtype, StringType):
        return c.isNotNull() & (c != F.lit(""))
    if isinstance(dtype, (NumericType,)):
        return c.isNotNull() & (c != F.lit(0))
    return c.isNotNull()


def display_widths(df: DataFrame, headings: Mapping[str, str] | None = None) -> DataFrame:
    """One row per column — ``column``, ``heading``, ``width`` — where
    width is the longest printed value or heading, plus 2, at most 30.  Empty
    cells (NULL, 0, empty text) do not count, as in the spreadsheet rule.

    One aggregation pass over the table (``max`` of lengths, partial
    aggregates per task), then an unpivot of the single result row.
    """
    headings = dict(headings or {})
    aggs = []
    for f in df.schema.fields:
        c = F.col(f.name)
        aggs.append(F.max(F.when(_truthy(c, f.dataType), py_str_length(c, f.dataType))).alias(f.name))
    longest = df.agg(*aggs) if aggs else df.limit(0)
    rows = F.explode(F.array(*[
        F.struct(F.lit(f.name).alias("column"), F.lit(headings.get(f.name, f.name)).alias("heading"),
                 F.col(f.name).cast("int").alias("longest"), F.lit(i).alias("position"))
        for i, f in enumerate(df.schema.fields)]))
    w = longest.select(rows.alias("r")).select("r.*")
    width = F.least(F.greatest(F.coalesce(F.col("longest"), F.lit(0)), F.length("heading")) + 2, F.lit(MAX_WIDTH))
    return w.select("column", "heading", width.cast("int").alias("width"), "position")
