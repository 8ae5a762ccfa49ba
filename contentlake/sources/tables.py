"""Readers for the driver tables (one parquet file or folder per table)."""

from __future__ import annotations

import os
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from contentlake.functions.joins import row_count_at_most

# (table path, bound) -> whether the table has at most ``bound`` rows; the
# input files do not change during a run, so each check runs once
_BOUND_CHECKS: dict[tuple[str, int], bool] = {}
_RELATIONS: dict[tuple[SparkSession, str], DataFrame] = {}

TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


class Tables:
    """Lazy access to the parquet tables of one scale-factor folder.

    Each access returns a fresh scan; Catalyst prunes columns and pushes
    filters into it, so callers select what they need and nothing more.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def path(self, name: str) -> str:
        p = os.path.join(self.root, f"{name}.parquet")
        return p if os.path.exists(p) or "://" in p else os.path.join(self.root, name)

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLE_NAMES:
            # one relation per (session, file): the file listing and footer
            # schema read happen once; plans built on it stay independent
            key = (self.spark, self.path(name))
            if key not in _RELATIONS:
                _RELATIONS[key] = self.spark.read.parquet(self.path(name))
            return _RELATIONS[key]
        raise AttributeError(name)

    def at_most(self, name: str, bound: int) -> bool:
        """Checked (once per table and bound) row-count bound of a table."""
        key = (self.path(name), bound)
        if key not in _BOUND_CHECKS:
            _BOUND_CHECKS[key] = row_count_at_most(getattr(self, name), bound)
        return _BOUND_CHECKS[key]

    @cached_property
    def names(self) -> tuple[str, ...]:
        return TABLE_NAMES


def tables(spark: SparkSession, root: str) -> Tables:
    return Tables(spark, root)
