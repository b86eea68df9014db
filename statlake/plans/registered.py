"""Collects the registered queries and the SQL each is checked with."""

from __future__ import annotations

from collections.abc import Callable

from statlake.plans.views import with_views

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, views: str = "", sql: str | None = None):
    """Register a query; ``sql`` may use the named views."""
    def keep(fn):
        assert name not in QUERIES, name
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_views(views, sql)
        return fn
    return keep
