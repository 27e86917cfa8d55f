"""Query registry."""

from __future__ import annotations

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(inputs)`` as a query, with its SQL where there is one."""
    from workload.inputs import Inputs

    def register(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(Inputs(spark, sf_dir))
        if sql is not None:
            SQL[name] = sql
        return fn

    return register
