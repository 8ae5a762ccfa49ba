"""All registered queries: importing this module fills the registry."""

from __future__ import annotations

from contentlake.plans import (  # noqa: F401
    catalog_args, catalog_lookup, catalog_mutate, catalog_operations, catalog_paths, catalog_query,
    catalog_relations, catalog_streams,
)
from contentlake.plans.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
