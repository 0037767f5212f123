"""Registry of the named queries run by ``__spark_entry__`` and ``bench.py``.

Each query is a callable ``(spark, sf_dir) -> DataFrame`` over the given
tables; ``oracle`` is the same result written as DuckDB SQL over the
pre-registered views (omitted for learned operators, whose results depend
on a fitted model).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    fn: QueryFn
    oracle: str | None


_REGISTRY: dict[str, Query] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in _REGISTRY:
            raise ValueError(f"duplicate query name {name}")
        _REGISTRY[name] = Query(name, fn, oracle)
        return fn

    return deco


def _load_all() -> None:
    # Importing the modules fills the registry.
    from . import (  # noqa: F401
        cluster_queries,
        discovery_queries,
        model_queries,
        pattern_queries,
        similarity_queries,
        source_queries,
        text_queries,
    )


def all_queries() -> dict[str, Query]:
    _load_all()
    return dict(_REGISTRY)
