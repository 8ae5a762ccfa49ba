"""Persisting repository tables: new snapshots and partitioned sinks.

A write never updates files in place: a changed table is written as a new
snapshot folder (copy-on-write). Within a snapshot, ``repo`` partitions are
replaced with dynamic partition overwrite, so rewriting one repository
leaves the others untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_snapshot(docs: DataFrame, path: str, partition_by: str = "repo") -> None:
    (docs.write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic")
         .partitionBy(partition_by)
         .parquet(path))


def write_clustered(df: DataFrame, path: str, keys: list[str], fmt: str = "parquet") -> None:
    """Write sorted by ``keys`` within files, rows of the first key together
    (hash partitioned: no sampling pass over the payload): lookups by key prune
    row groups from their min/max statistics. Unlike ``partitionBy`` on a
    high-cardinality key (one folder per batch), the file count follows the
    data volume, not the number of keys."""
    (df.repartition(keys[0]).sortWithinPartitions(*keys)
       .write.mode("overwrite").format(fmt).save(path))
