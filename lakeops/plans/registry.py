"""Registry of named queries: each has a Spark builder ``(spark, sf_dir) -> DataFrame`` and, where SQL can
express it, an equivalent DuckDB query over the same tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    oracle: str | None
    operators: tuple[str, ...]


_REGISTRY: dict[str, Query] = {}


def query(name: str, operators: str, oracle: str | None = None) -> Callable[[Builder], Builder]:
    """Register ``fn`` as query ``name``; ``operators`` lists the SURVEY ids it covers."""

    def wrap(fn: Builder) -> Builder:
        if name in _REGISTRY:
            raise ValueError(f"query {name!r} registered twice")
        _REGISTRY[name] = Query(name, fn, oracle, tuple(operators.split()))
        return fn

    return wrap


def all_queries() -> dict[str, Query]:
    from lakeops.plans import load_all

    load_all()
    return dict(_REGISTRY)
