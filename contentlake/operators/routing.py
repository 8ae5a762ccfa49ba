"""Outputs: every row goes to success, failure, original or next_page.

A processor's named outputs become one ``route`` column (plus ``error`` on
failures); per-output DataFrames are filters on it, and a physical split is
``write.partitionBy("route")``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SUCCESS, FAILURE, ORIGINAL, NEXT_PAGE = "success", "failure", "original", "next_page"
ROUTES = (SUCCESS, FAILURE, ORIGINAL, NEXT_PAGE)


def routed(df: DataFrame, route: str | Column, error: str | Column | None = None) -> DataFrame:
    r = F.lit(route) if isinstance(route, str) else route
    e = (F.lit(error) if isinstance(error, str) else error) if error is not None \
        else F.lit(None).cast("string")
    return df.withColumns({"route": r, "error": e.cast("string")})


def union_routes(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def emit_original(results: DataFrame, requests: DataFrame) -> DataFrame:
    """Pass every input row through unchanged on the ``original`` output."""
    return union_routes(results, routed(requests, ORIGINAL))


def outputs(results: DataFrame) -> dict[str, DataFrame]:
    return {r: results.where(F.col("route") == r) for r in ROUTES}


def route_counts(results: DataFrame) -> DataFrame:
    """Rows per output: the figure every reference integration test asserts."""
    return results.groupBy("route").agg(F.count(F.lit(1)).alias("n"))


def write_routes(results: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Physically split the outputs: one folder per route value."""
    results.write.mode("overwrite").partitionBy("route").format(fmt).save(path)
