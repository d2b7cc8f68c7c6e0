"""Registry of the queries the driver runs: a Spark builder and, where SQL can say it, a DuckDB twin."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    doc: str = ""


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in REGISTRY:
            raise KeyError(f"query {name!r} registered twice")
        REGISTRY[name] = Query(name, fn, sql, (fn.__doc__ or "").strip())
        return fn
    return deco
