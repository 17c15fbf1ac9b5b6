"""Queries of this package: name, Spark callable, and the SQL that must give the same rows."""

from __future__ import annotations

from docloom.plans.registry import QueryFn

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
