"""Date range and filter-tree predicates.

Predicates are built on bare columns so Catalyst can push them into the
Parquet scan (``PushedFilters``) and prune date partitions.
"""

from __future__ import annotations

from collections import defaultdict
from functools import reduce
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampNTZType

from ..plans.spec import AnyOf, DateRange, Exact, FilterExpr


def ts_literal(day, ts_type: DataType | None) -> Column:
    """Midnight of ``day`` as a literal of the timestamp column's own type
    (``timestamp_ntz`` stays zone-free)."""
    target = "timestamp_ntz" if isinstance(ts_type, TimestampNTZType) else "timestamp"
    return F.lit(day.isoformat()).cast("date").cast(target)


def date_range_predicate(ts: str, rng: DateRange, ts_type: DataType | None = None) -> Column:
    """``start <= ts < end + 1 day`` — both ends of the range included.

    The comparison is on the bare column, so it pushes into the scan.
    """
    c = F.col(ts)
    return (c >= ts_literal(rng.start, ts_type)) & (c < ts_literal(rng.end_exclusive, ts_type))


def where_date_range(df: DataFrame, rng: DateRange, ts: str = "ts") -> DataFrame:
    return df.where(date_range_predicate(ts, rng, df.schema[ts].dataType))


Leaf = Callable[[str, list, bool], "Column | None"]


def _leaf(field: str, values: list[str], case_sensitive: bool,
          resolve: Callable[[str], Column], leaf: Leaf | None) -> Column:
    if leaf is not None:
        p = leaf(field, values, case_sensitive)
        if p is not None:
            return p
    c = resolve(field)
    if not case_sensitive:
        c, values = F.lower(c), [v.lower() for v in values]
    return c == F.lit(values[0]) if len(values) == 1 else c.isin(*values)


def compile_filter(expr: FilterExpr | None, resolve: Callable[[str], Column],
                   leaf: Leaf | None = None) -> Column | None:
    """Filter tree → boolean Column.

    ``resolve`` maps a filter field name to a Column.  In an OR group, EXACT
    leaves on one field become a single ``IN`` (one pushed filter for
    Parquet); the rest are OR-ed.  ``leaf(field, values, case_sensitive)``
    may return a better predicate for "field in values" — a binding uses it
    to put the test on the source column, where the scan can take it.
    """
    if expr is None:
        return None
    if isinstance(expr, Exact):
        return _leaf(expr.field, [expr.value], expr.case_sensitive, resolve, leaf)
    if isinstance(expr, AnyOf):
        same_field: dict[tuple[str, bool], list[str]] = defaultdict(list)
        parts: list[Column] = []
        for sub in expr.expressions:
            if isinstance(sub, Exact):
                same_field[(sub.field, sub.case_sensitive)].append(sub.value)
            else:
                parts.append(compile_filter(sub, resolve, leaf))
        grouped = [_leaf(f, vals, cs, resolve, leaf) for (f, cs), vals in same_field.items()]
        return reduce(lambda a, b: a | b, grouped + parts)
    raise TypeError(f"not a filter expression: {expr!r}")


def where_filter(df: DataFrame, expr: FilterExpr | None, resolve: Callable[[str], Column],
                 leaf: Leaf | None = None) -> DataFrame:
    """filter on fields that need not be in the output."""
    p = compile_filter(expr, resolve, leaf)
    return df if p is None else df.where(p)
