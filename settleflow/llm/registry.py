"""Queries of the training-data operators, each with its SQL where SQL can express it."""

from __future__ import annotations

from settleflow.queries.registry import Tables

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(tables)`` under ``name``."""

    def add(fn):
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql:
            ORACLES[name] = sql
        return fn

    return add
