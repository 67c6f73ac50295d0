"""Dimension expressions (month, year), month names, constant columns and
percent rounding.  All of them are plain Column expressions, so they stay
inside whole-stage codegen."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month codes and the Portuguese month names the reports show,
# in calendar order.
MONTH_NAMES_PT = {
    "01": "janeiro",
    "02": "fevereiro",
    "03": "março",
    "04": "abril",
    "05": "maio",
    "06": "junho",
    "07": "julho",
    "08": "agosto",
    "09": "setembro",
    "10": "outubro",
    "11": "novembro",
    "12": "dezembro",
}


def month_code(ts: Column | str) -> Column:
    """Two-digit month string ``01``..``12``.  Read from the field itself
    (no formatter, and zone-free on ``timestamp_ntz``)."""
    return F.lpad(F.month(_col(ts)).cast("string"), 2, "0")


def year_code(ts: Column | str) -> Column:
    """Four-digit year string."""
    return F.lpad(F.year(_col(ts)).cast("string"), 4, "0")


def _name_map(names: dict[str, str] = MONTH_NAMES_PT) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(names.items())])


def code(n: Column | str, width: int) -> Column:
    """Zero-padded text of an integer field (``3`` → ``"03"``): the month or
    year code from the integer a report groups by."""
    return F.lpad(_col(n).cast("string"), width, "0")


def ts_text(ts: Column | str, ntz: bool = True) -> Column:
    """``yyyy-MM-dd HH:mm:ss.SSSSSS`` text of a timestamp.  For
    ``timestamp_ntz`` it is built from the fields, so no session zone is
    involved (``date_format`` would cast to a zoned timestamp first)."""
    c = _col(ts)
    if not ntz:
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    secs = F.extract(F.lit("SECOND"), c)  # decimal(8,6)
    whole = F.floor(secs).cast("long")
    micros = ((secs - whole) * F.lit(1_000_000)).cast("long")

    def pad(x: Column, n: int) -> Column:
        return F.lpad(x.cast("string"), n, "0")
    return F.concat(pad(F.year(c), 4), F.lit("-"), pad(F.month(c), 2), F.lit("-"), pad(F.dayofmonth(c), 2),
                    F.lit(" "), pad(F.hour(c), 2), F.lit(":"), pad(F.minute(c), 2), F.lit(":"),
                    pad(whole, 2), F.lit("."), pad(micros, 6))


def month_name(code: Column | str, names: dict[str, str] = MONTH_NAMES_PT) -> Column:
    """P5: month name; an unknown code gives NULL (like a dict ``map``)."""
    return F.element_at(_name_map(names), _col(code))


def month_name_or_code(code: Column | str, names: dict[str, str] = MONTH_NAMES_PT) -> Column:
    """Month name; an unknown code is kept as it is (``dict.get(k, k)``)."""
    c = _col(code)
    return F.coalesce(F.element_at(_name_map(names), c), c)


def month_rank(name: Column | str, names: dict[str, str] = MONTH_NAMES_PT) -> Column:
    """Calendar rank (0..11) of a month name; unknown names give NULL."""
    ranks = F.create_map(
        *[F.lit(x) for x in chain.from_iterable((n, i) for i, n in enumerate(names.values()))]
    )
    return F.element_at(ranks, _col(name))


def constant(value: str) -> Column:
    """A literal text column, e.g. a fixed year label."""
    return F.lit(value).cast("string")


def percent_2dp(numerator: Column | str, denominator: Column | str) -> Column:
    """``numerator / denominator * 100`` rounded half-up to 2 decimals.

    Done in integers so the result does not depend on binary floating point:
    ``(n * 20000 + d) div (2 * d) / 100``.  A zero denominator gives NULL.
    """
    return percent_basis_points(numerator, denominator) / F.lit(100.0)


def percent_basis_points(numerator: Column | str, denominator: Column | str) -> Column:
    """Same rounding as :func:`percent_2dp`, as an integer count of 1/100 %."""
    n = _col(numerator).cast("long")
    d = _col(denominator).cast("long")
    return F.when(d > 0, int_div(n * 20000 + d, d * 2))


def int_div(a: Column, b: Column) -> Column:
    """Integral division of non-negative longs, exact: the dividend is first
    made a multiple of the divisor, so the quotient is a whole number and
    ``rint`` removes any rounding of the double division."""
    return F.rint((a - F.pmod(a, b)) / b).cast("long")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
