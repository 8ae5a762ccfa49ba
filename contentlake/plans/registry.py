"""Registry of named queries (one per operator) and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from contentlake.plans.oracle_views import with_views

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None,
          same_oracle_as: str | None = None) -> Callable[[QueryFn], QueryFn]:
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``.

    ``oracle`` is DuckDB SQL over the driver tables; role views (``v_docs``,
    ``v_requests`` …) it mentions are added as CTEs. Omitted for operators
    SQL cannot express; those are checked against brute force in tests.
    ``same_oracle_as`` reuses the oracle of an already registered query
    (e.g. a streaming twin of a batch operator).
    """
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = with_views(oracle)
        elif same_oracle_as is not None:
            ORACLES[name] = ORACLES[same_oracle_as]
        return fn
    return deco
