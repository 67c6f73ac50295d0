"""Report specifications: the declarative request a report is built from.

A :class:`ReportSpec` names a property (a registered event table), the
dimensions, the metrics, one inclusive date range, an optional filter tree
and whether the calendar is completed.  ``plans.report.run_report`` compiles
it into a single DataFrame plan.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from typing import Union

# Dimension and metric names a request may use.
DIMENSIONS = ("month", "year")
FILTER_FIELDS = ("platform", "sessionDefaultChannelGroup")
METRICS = ("sessions", "activeUsers", "totalRevenue", "engagementRate")


def _as_date(d: dt.date | str) -> dt.date:
    if isinstance(d, dt.datetime):
        return d.date()
    if isinstance(d, dt.date):
        return d
    return dt.date.fromisoformat(d)


@dataclass(frozen=True)
class DateRange:
    """Inclusive on both ends, as ISO dates: ``DateRange('2025-01-01', '2025-12-31')``."""

    start: dt.date | str
    end: dt.date | str

    def __post_init__(self):
        object.__setattr__(self, "start", _as_date(self.start))
        object.__setattr__(self, "end", _as_date(self.end))
        if self.end < self.start:
            raise ValueError(f"date range ends before it starts: {self.start} .. {self.end}")

    @property
    def end_exclusive(self) -> dt.date:
        return self.end + dt.timedelta(days=1)


@dataclass(frozen=True)
class Exact:
    """Leaf filter: ``field`` equals ``value`` (string match type EXACT)."""

    field: str
    value: str
    case_sensitive: bool = True

    def __post_init__(self):
        if self.field not in FILTER_FIELDS + DIMENSIONS:
            raise ValueError(f"unknown filter field {self.field!r}")


@dataclass(frozen=True)
class AnyOf:
    """OR group: true when any of its expressions is true."""

    expressions: tuple["FilterExpr", ...]

    def __init__(self, *expressions: "FilterExpr"):
        if len(expressions) == 1 and isinstance(expressions[0], (list, tuple)):
            expressions = tuple(expressions[0])
        if not expressions:
            raise ValueError("an OR group needs at least one expression")
        object.__setattr__(self, "expressions", tuple(expressions))


FilterExpr = Union[Exact, AnyOf]


def filter_fields(expr: FilterExpr | None) -> set[str]:
    """Names of the fields a filter tree reads."""
    if expr is None:
        return set()
    if isinstance(expr, Exact):
        return {expr.field}
    return set().union(*(filter_fields(e) for e in expr.expressions))


@dataclass(frozen=True)
class ReportSpec:
    """One report request (the general form, R8).

    ``dimensions`` is ``("month", "year")`` or ``("month",)``; with month only,
    the years inside the range fall together.  ``year_label`` sets a constant
    year column for month-only reports.  ``fill_months`` adds the months of the
    range that have no rows, with zero counts.  ``approx_users`` (a relative
    standard deviation such as 0.01) counts active users with HyperLogLog++
    instead of exactly: one aggregation level (and one shuffle) less.
    """

    property: str
    metrics: tuple[str, ...]
    date_range: DateRange
    dimensions: tuple[str, ...] = ("month", "year")
    filter: FilterExpr | None = None
    fill_months: bool = False
    year_label: str | None = None
    name: str = field(default="report")
    approx_users: float | None = None  # max relative error; None = exact distinct users

    def __post_init__(self):
        object.__setattr__(self, "metrics", tuple(self.metrics))
        object.__setattr__(self, "dimensions", tuple(self.dimensions))
        for m in self.metrics:
            if m not in METRICS:
                raise ValueError(f"unknown metric {m!r}; known: {METRICS}")
        if not self.metrics:
            raise ValueError("a report needs at least one metric")
        if "month" not in self.dimensions or not set(self.dimensions) <= set(DIMENSIONS):
            raise ValueError(f"dimensions must be ('month', 'year') or ('month',), got {self.dimensions}")

    # ------------------------------------------------------------------
    @classmethod
    def from_request(cls, request: dict, name: str = "report", **kw) -> "ReportSpec":
        """A spec from a report request written as plain data, in the shape
        of a request literal::

            {"property": "properties/ecommerce",
             "dimensions": [{"name": "month"}, {"name": "year"}],
             "metrics": [{"name": "activeUsers"}, {"name": "sessions"}],
             "date_ranges": [{"start_date": "2025-01-01", "end_date": "2025-12-31"}],
             "dimension_filter": {"or_group": {"expressions": [
                 {"filter": {"field_name": "platform",
                             "string_filter": {"match_type": "EXACT", "value": "Android"}}},
                 ...]}},
             "order_bys": [{"dimension": {"dimension_name": "year"}},
                           {"dimension": {"dimension_name": "month"}}]}

        One date range, EXACT string filters, OR groups and ascending orders
        by year then month are what reports use; anything else, an unknown key
        included, is refused with a clear error rather than half-applied.  A
        filter without ``case_sensitive`` is read as sensitive.
        """
        _only(request, "request", "property", "dimensions", "metrics", "date_ranges", "dimension_filter", "order_bys")
        for part, keys in (("dimensions", ("name",)), ("metrics", ("name",)), ("date_ranges", ("start_date", "end_date", "name"))):
            for item in request.get(part, []):
                _only(item, part, *keys)
        prop = str(request["property"]).split("/")[-1]
        dims = tuple(d["name"] for d in request.get("dimensions", []))
        mets = tuple(m["name"] for m in request.get("metrics", []))
        for what, names, known in (("dimension", dims, DIMENSIONS), ("metric", mets, METRICS)):
            if set(names) - set(known) or len(set(names)) < len(names):
                raise ValueError(f"unknown or repeated {what} in {list(names)}; known: {known}")
        ranges = request.get("date_ranges", [])
        if len(ranges) != 1:
            raise ValueError(f"exactly one date range is supported, got {len(ranges)}")
        rng = DateRange(ranges[0]["start_date"], ranges[0]["end_date"])
        flt = _filter_from_request(request["dimension_filter"]) if request.get("dimension_filter") else None
        for o in request.get("order_bys", []):
            _only(o, "order_bys", "dimension", "desc")
            _only(o.get("dimension", {}), "order_bys dimension", "dimension_name", "order_type")
        orders = [o.get("dimension", {}).get("dimension_name") for o in request.get("order_bys", [])]
        if any(o.get("desc") for o in request.get("order_bys", [])) or \
                orders not in ([], ["year", "month"], ["month"]):
            raise ValueError(f"reports are ordered by year then month (ascending), got {orders}")
        return cls(prop, mets, rng, dimensions=tuple(d for d in DIMENSIONS if d in dims),
                   filter=flt, name=name, **kw)


def _only(part: dict, what: str, *keys: str) -> None:
    unknown = sorted(set(part) - set(keys))
    if unknown:
        raise ValueError(f"{what}: {unknown} not supported; known: {list(keys)}")


def _filter_from_request(expr: dict) -> FilterExpr:
    """Filter expression in request shape → Exact / AnyOf."""
    if len(expr) != 1:
        raise ValueError(f"a filter expression has one key, got {sorted(expr)}")
    if "filter" in expr:
        f = expr["filter"]
        _only(f, "filter", "field_name", "string_filter")
        _only(f.get("string_filter") or {}, "string_filter", "match_type", "value", "case_sensitive")
        sf = f.get("string_filter")
        if sf is None:
            raise ValueError(f"only string filters are supported: {f}")
        match = str(sf.get("match_type", "EXACT")).upper().split(".")[-1]
        if match != "EXACT":
            raise ValueError(f"only EXACT string matches are supported, got {match}")
        return Exact(f["field_name"], sf["value"], bool(sf.get("case_sensitive", True)))
    if "or_group" in expr:
        _only(expr["or_group"], "or_group", "expressions")
        return AnyOf(*[_filter_from_request(e) for e in expr["or_group"]["expressions"]])
    raise ValueError(f"unsupported filter expression (EXACT leaves and OR groups only): {sorted(expr)}")

