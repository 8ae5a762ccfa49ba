"""Connected components of an undirected graph by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contentlake.llm.common import stage

#: Neighbours of a vertex are dealt into so many parts before they are reduced.
SALTS = 16


def _least(edges: DataFrame) -> DataFrame:
    """(u, m): the least of every u and its neighbours v; two steps, so that a
    vertex with very many neighbours is reduced in parts."""
    part = edges.groupBy("u", F.pmod(F.xxhash64("v"), F.lit(SALTS)).alias("salt")).agg(F.min("v").alias("m"))
    return part.groupBy("u").agg(F.least(F.col("u"), F.min("m")).alias("m"))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): every id that occurs in ``links`` with the least id it
    can reach. Each round links larger neighbours of a vertex to the least one
    (large star), then the smaller ones (small star), until nothing changes; the
    number of rounds grows with the logarithm of the number of vertices. Edges
    are a table in the shared folder after every step; two numbers reach the driver.
    """
    edges = stage(links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (both.where("v > u").join(_least(both), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v"))
        small_in = stage(large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "large")
        m = _least(small_in)
        small = (small_in.join(m, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(m.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        edges = stage(small, "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    found = edges.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("id"), "component")
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return found.unionByName(roots).groupBy("id").agg(F.min("component").alias("component"))
