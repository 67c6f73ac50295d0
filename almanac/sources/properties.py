"""Properties are registered event sources, chosen by key."""

from __future__ import annotations

from .bindings import events_binding, orders_binding

# The property keys the ready-made reports read.
ECOMMERCE = "ecommerce"  # web and app reports
SECOND = "second"  # organic-traffic report (a second property)
EVENTS = "events"


class PropertyRegistry(dict):
    """``{property key: Binding}``; a missing key is a clear error."""

    def __missing__(self, key):
        raise KeyError(f"unknown property {key!r}; registered: {sorted(self)}")


def default_registry(data_dir: str) -> PropertyRegistry:
    """Properties over the driver's tables (FIXTURES.md §4).  Both web/app and
    the organic property read the orders binding (one shared Binding object,
    so a bundle scans it once); ``events`` is the sessionized events table."""
    orders = orders_binding(data_dir)
    return PropertyRegistry({ECOMMERCE: orders, SECOND: orders, EVENTS: events_binding(data_dir)})


def events_registry(data_dir: str) -> PropertyRegistry:
    """All properties on the events binding (sessions made by gap)."""
    ev = events_binding(data_dir)
    return PropertyRegistry({ECOMMERCE: ev, SECOND: ev, EVENTS: ev})

