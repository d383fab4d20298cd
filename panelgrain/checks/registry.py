"""Registry of queries over the driver tables, each with its SQL oracle where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, ctes: tuple[str, ...] = ()):
    """Register a query; `ctes` are the panel views its oracle starts from."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} exists")
        QUERIES[name] = fn
        if sql is not None:
            head = f"WITH {', '.join(ctes)} " if ctes else ""
            body = sql.strip()
            if ctes and body.upper().startswith("WITH "):
                body = ", " + body[5:]
                head = head.rstrip()
            ORACLES[name] = head + body
        return fn

    return add
