"""Registered queries: a Spark function over the stand-in views and, where SQL can say it, a check."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clipstat.plans import standins

QUERIES: dict[str, Callable[[standins.Views], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under the inventory id it implements."""

    def add(fn: Callable[[standins.Views], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} registered twice")
        QUERIES[name] = fn
        if sql:
            CHECKS[name] = _with_views(sql)
        return fn

    return add


def _with_views(sql: str) -> str:
    """Put the stand-in views a check mentions in front of it."""
    used = [n for n in standins.VIEWS if re.search(rf"\b(FROM|JOIN)\s+{n}\b", sql)]
    ctes = [f"{n} AS ({standins.duck_view(n)})" for n in used]
    body = sql.strip()
    if not ctes:
        return body
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(ctes) + ",\n" + body[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + body


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {n: _bind(fn) for n, fn in QUERIES.items()}


def _bind(fn):
    return lambda spark, sf_dir: fn(standins.Views(spark, sf_dir))
