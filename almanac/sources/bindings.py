"""Bindings: map a physical table onto the event contract.

Every report reads events with these columns (FIXTURES.md §2):

    event_id long   ordering tie-break inside one user
    ts       timestamp / timestamp_ntz
    user_id  long
    session_id long (nullable when the table has no sessions)
    platform string
    channel  string
    engaged  boolean
    revenue  double

A :class:`Binding` builds only the contract columns a report asks for, so a
report that never reads ``channel`` never plans the lookup join that makes it.
"""

from __future__ import annotations

import datetime as dt
import os
from dataclasses import dataclass, field
from typing import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CONTRACT = ("event_id", "ts", "user_id", "session_id", "platform", "channel", "engaged", "revenue")

Builder = Callable[[SparkSession, frozenset], DataFrame]


@dataclass(frozen=True)
class CodeMap:
    """A contract field derived from one source column by a code table:
    ``value = mapping.get(source, default)`` (NULL source gives ``default``).

    Besides the CASE expression it gives the inverse predicate for a set of
    values, on the source column itself, so a filter such as
    ``platform IN ('Android', 'iOS')`` reaches the Parquet scan as
    ``source IN (...)``.
    """

    source: str
    mapping: tuple[tuple[str, str], ...]
    default: str

    def expr(self, src: Column | None = None) -> Column:
        src = F.col(self.source) if src is None else src
        out = None
        for code, value in self.mapping:
            out = (F.when(src == F.lit(code), F.lit(value)) if out is None
                   else out.when(src == F.lit(code), F.lit(value)))
        return F.lit(self.default) if out is None else out.otherwise(F.lit(self.default))

    def predicate(self, values: Iterable[str], src: Column | None = None,
                  case_sensitive: bool = True) -> Column:
        src = F.col(self.source) if src is None else src
        values = set(values)
        if case_sensitive:
            match = lambda v: v in values
        else:
            low = {v.lower() for v in values}
            match = lambda v: v.lower() in low
        codes = [c for c, v in self.mapping if match(v)]
        others = [c for c, _ in self.mapping]
        pos = src.isin(*codes) if codes else F.lit(False)
        if match(self.default):
            # the default covers NULL and every code outside the table
            return pos | src.isNull() | ~src.isin(*others) if others else F.lit(True)
        return pos


@dataclass(frozen=True)
class Binding:
    """A named event source.

    ``build(spark, need)`` returns a DataFrame holding at least the contract
    columns in ``need``.  ``session_ids`` says whether the table carries its
    own session ids; if not, sessions are made by inactivity gap
    (``session_gap``).  ``rows_are_sessions`` declares that every row is a
    different session (a key, e.g. one order per row): the engine then counts
    rows instead of distinct ids and skips one aggregation level.  A binding
    with its own ids must keep every id inside one user, and gives ``channel``
    already at session scope.
    """

    name: str
    build: Builder = field(compare=False)
    session_ids: bool = True
    rows_are_sessions: bool = False
    session_gap: dt.timedelta = dt.timedelta(minutes=30)
    session_block: dt.timedelta | None = None  # sessions made block by block of time, whatever a user's history
    derived: tuple[tuple[str, CodeMap], ...] = ()
    partition_date: str | None = None  # a date partition column of the table, for pruning
    joined: frozenset = frozenset()  # contract columns whose building joins another table
    closed_before: dt.date | None = None  # days from this one on are not complete yet; reports that reach them are refused

    def code_map(self, contract_col: str) -> CodeMap | None:
        return dict(self.derived).get(contract_col)

    def frame(self, spark: SparkSession, need: Iterable[str] = CONTRACT) -> DataFrame:
        """The contract columns in ``need``; for a derived column the source
        column comes along too (as ``_src_<name>``) for pushable filters.
        Catalyst prunes it when no filter reads it."""
        need = frozenset(need) | {"ts"}
        unknown = need - set(CONTRACT)
        if unknown:
            raise ValueError(f"not contract columns: {sorted(unknown)}")
        df = self.build(spark, need)
        srcs = [F.col(cm.source).alias(f"_src_{c}") for c, cm in self.derived if c in need]
        if self.partition_date:
            srcs.append(F.col(self.partition_date).alias("_part_date"))
        return df.select(*[c for c in CONTRACT if c in need], *srcs)


def _read(spark: SparkSession, data_dir: str, table: str, schemas: dict | None = None) -> DataFrame:
    """Read one table; with ``schemas`` (a binding's own cache) the footer-based
    schema inference runs once per binding, later reads pass the schema."""
    path = os.path.join(data_dir, f"{table}.parquet")
    if schemas is None:
        return spark.read.parquet(path)
    if path in schemas:
        return spark.read.schema(schemas[path]).parquet(path)
    df = spark.read.parquet(path)
    schemas[path] = df.schema
    return df


# --------------------------------------------------------------------------
# Bindings of the driver's tables (FIXTURES.md §4)
# --------------------------------------------------------------------------

# How the orders table stands in for hits of a web/app property.
ORDERS_PLATFORM_BY_PRIORITY = {"1-URGENT": "Android", "2-HIGH": "iOS"}  # any other priority: web
ORDERS_ORGANIC_SEGMENT = "BUILDING"  # customer segment read as channel Organic Search
ORDERS_ENGAGED_STATUS = "F"

# How the events table stands in for app/web hits.
EVENTS_PLATFORMS = ("web", "Android", "iOS")  # by props.k % 3
EVENTS_ORGANIC_BELOW_K = 25  # props.k < 25 is channel Organic Search
EVENTS_ENGAGED_TYPES = ("click", "purchase")
EVENTS_REVENUE_TYPE = "purchase"

ORGANIC = "Organic Search"
OTHER = "Other"


ORDERS_PLATFORM = CodeMap("o_orderpriority", tuple(ORDERS_PLATFORM_BY_PRIORITY.items()), "web")
ORDERS_CHANNEL = CodeMap("c_mktsegment", ((ORDERS_ORGANIC_SEGMENT, ORGANIC),), OTHER)


def orders_binding(data_dir: str, name: str = "orders") -> Binding:
    """Orders as hits: one order is one session of its customer."""

    schemas: dict = {}

    def build(spark: SparkSession, need: frozenset) -> DataFrame:
        o = _read(spark, data_dir, "orders", schemas)
        cols: dict[str, Column] = {
            "event_id": F.col("o_orderkey"),
            "ts": F.col("o_orderdate"),
            "user_id": F.col("o_custkey"),
            "session_id": F.col("o_orderkey"),
            "platform": ORDERS_PLATFORM.expr(),
            "engaged": F.col("o_orderstatus") == F.lit(ORDERS_ENGAGED_STATUS),
            "revenue": F.col("o_totalprice"),
        }
        keep = [F.col("o_orderpriority")] if "platform" in need else []
        if "channel" in need:
            # Lookup join on the customer key (a customer has one segment).
            # No broadcast hint: Catalyst broadcasts the customer side only
            # while its estimated size is under
            # spark.sql.autoBroadcastJoinThreshold, and AQE re-checks at run
            # time; beyond that it is a sort-merge join.  An unmatched order
            # has a NULL segment, hence channel Other.
            c = _read(spark, data_dir, "customer", schemas).select("c_custkey", "c_mktsegment")
            o = o.join(c, o["o_custkey"] == c["c_custkey"], "left")
            cols["channel"] = ORDERS_CHANNEL.expr()
            keep.append(F.col("c_mktsegment"))
        return o.select(*[cols[k].alias(k) for k in CONTRACT if k in need], *keep)

    return Binding(name=name, build=build, session_ids=True, rows_are_sessions=True,
                   derived=(("platform", ORDERS_PLATFORM), ("channel", ORDERS_CHANNEL)),
                   joined=frozenset({"channel"}))


def events_contract(e: DataFrame, need: Iterable[str] = CONTRACT) -> DataFrame:
    """Contract columns over the events table's own columns; works on a batch
    or a streaming DataFrame."""
    need = frozenset(need)
    k = F.get_json_object(F.col("props"), "$.k").cast("int")
    platforms = F.array(*[F.lit(p) for p in EVENTS_PLATFORMS])
    cols: dict[str, Column] = {
        "event_id": F.col("event_id"),
        "ts": F.col("ts"),
        "user_id": F.col("user_id"),
        "session_id": F.lit(None).cast("long"),
        "platform": F.element_at(platforms, (F.pmod(k, F.lit(3)) + 1).cast("int")),
        "channel": F.when(k.isNull(), F.lit(None).cast("string"))
        .when(k < F.lit(EVENTS_ORGANIC_BELOW_K), F.lit(ORGANIC))
        .otherwise(F.lit(OTHER)),
        "engaged": F.coalesce(F.col("event_type").isin(*EVENTS_ENGAGED_TYPES), F.lit(False)),
        "revenue": F.when(F.col("event_type") == F.lit(EVENTS_REVENUE_TYPE), F.col("value")),
    }
    return e.select(*[cols[c].alias(c) for c in CONTRACT if c in need])


def events_binding(data_dir: str, name: str = "events", gap: dt.timedelta = dt.timedelta(minutes=30)) -> Binding:
    """The events table as hits; it has no session ids, so sessions are made
    by inactivity gap."""

    schemas: dict = {}

    def build(spark: SparkSession, need: frozenset) -> DataFrame:
        return events_contract(_read(spark, data_dir, "events", schemas), need)

    return Binding(name=name, build=build, session_ids=False, session_gap=gap)


def bindings_from_file(path: str, spark_format: str = "parquet") -> dict[str, Binding]:
    """Bindings of one's own tables, from a JSON file: ``{property: {"path": ...,
    "columns": {contract name: column or SQL expression}, "format"?,
    "session_ids"?, "rows_are_sessions"?, "gap_minutes"?, "partition_date"?,
    "block_days"?}}``.
    Unknown keys are refused.  Properties with the same entry share a binding,
    so their reports share scans."""
    import json

    known = {"path", "columns", "format", "session_ids", "rows_are_sessions", "gap_minutes", "partition_date", "block_days"}
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    made: dict[str, Binding] = {}
    out = {}
    for name, d in spec.items():
        if set(d) - known or not {"path", "columns"} <= set(d) or set(d["columns"]) - set(CONTRACT):
            raise ValueError(f"binding {name!r}: needs path and columns ({', '.join(CONTRACT)}), may have {sorted(known)}; got {sorted(d)}")
        key = json.dumps(d, sort_keys=True)
        if key not in made:
            def load(spark: SparkSession, d=d) -> DataFrame:
                return spark.read.format(d.get("format", spark_format)).load(d["path"])
            made[key] = table_binding(
                name, load, d.get("session_ids", "session_id" in d["columns"]), d.get("rows_are_sessions", False),
                dt.timedelta(minutes=d.get("gap_minutes", 30)), d.get("partition_date"),
                dt.timedelta(days=d["block_days"]) if "block_days" in d else None, **{c: F.expr(e) for c, e in d["columns"].items()})
        out[name] = made[key]
    return out


def table_binding(
    name: str,
    load: Callable[[SparkSession], DataFrame],
    session_ids: bool = True,
    rows_are_sessions: bool = False,
    session_gap: dt.timedelta = dt.timedelta(minutes=30),
    partition_date: str | None = None,
    session_block: dt.timedelta | None = None,
    **exprs: str | Column,
) -> Binding:
    """A binding for any table: ``exprs`` maps contract names to a column name
    or a Column over the loaded table; missing contract columns become NULL.
    ``partition_date`` names a date partition column of the table (the day
    of ``ts``): report date ranges then prune partitions."""

    def build(spark: SparkSession, need: frozenset) -> DataFrame:
        df = load(spark)
        out = []
        for c in CONTRACT:
            if c not in need:
                continue
            e = exprs.get(c)
            if e is None:
                e = F.lit(None)
            elif isinstance(e, str):
                e = F.col(e)
            out.append(e.alias(c))
        if partition_date:
            out.append(F.col(partition_date))
        return df.select(*out)

    return Binding(name=name, build=build, session_ids=session_ids,
                   rows_are_sessions=rows_are_sessions, session_gap=session_gap, session_block=session_block,
                   partition_date=partition_date)
