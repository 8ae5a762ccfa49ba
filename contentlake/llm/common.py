"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contentlake.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str, block_bytes: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet to a new folder of the shared checkpoint folder
    and read it back: cuts lineage, survives lost executors, keeps columns
    prunable. Later passes see the same rows in the same files.

    ``block_bytes`` is for rows of megabytes: row groups of about so many bytes, sized row by
    row, without dictionaries (made anew for each). Otherwise the writer looks at sizes
    only after 100 rows, and writer and reader hold all of them at once."""
    spark = df.sparkSession
    path = shared_dir(spark, f"llm-{name}")
    out = df.write.option("compression", "zstd")
    if block_bytes:
        out = out.options(**{"parquet.block.size": block_bytes, "parquet.page.size.row.check.min": 1,
                             "parquet.enable.dictionary": False})
    out.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def worker_batches(spark: SparkSession, most: int) -> Iterator[None]:
    """Jobs that run meanwhile hand their Python workers batches of at most about ``most`` bytes
    (a row at least). A batch is there several times: as vectors and as a message outside the
    heap, as buffers and as objects in the worker. Results don't depend on it."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(most))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def discard(df: DataFrame) -> None:
    """Deletes the files of a table made by :func:`stage` that no later step
    reads (its successor must be written)."""
    files = df.inputFiles()
    if files:
        spark = df.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def ascii_lower(col: Column | str) -> Column:
    """Lower-case A-Z only (other letters stay, unlike ``lower``)."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
