"""Binaries as files of their own: written by tasks, read with ``binaryFile``.

Writing is for exchange with programs that want files; inside the engine blobs stay
rows of a table (:func:`contentlake.sources.snapshots.write_clustered`), since one file
per blob costs an open per blob. Reading gives path, length and modification time from
the listing; filters on them are applied before any content is read, and content is
read only if it is selected.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of an id that a file name holds as they are; all others as _XX.
_PLAIN = re.compile(rb"[a-z0-9-]")


def file_name(key: str) -> str:
    """A name for any text: no separators, dots or signs that a URI escapes, and different
    for different texts also where names ignore case. It begins with a letter, since
    readers skip names that begin with an underscore."""
    return "b" + b"".join(c if _PLAIN.match(c) else b"_%02X" % c[0] for c in (bytes([b]) for b in key.encode("utf-8"))).decode()


def write_blob_files(blobs: DataFrame, folder: str, key_col: str = "doc_id", content_col: str = "content") -> DataFrame:
    """Writes every blob to ``folder/<name of its key>.bin`` and returns (key, length).
    A task that runs again writes the same files again; rows without key or content
    are left out, of rows with one key the last written stays. The files are written when
    the result is."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        has_scheme = re.match(r"[a-z][\w+.-]*:", folder)
        system, top = pafs.FileSystem.from_uri(folder) if has_scheme else (pafs.LocalFileSystem(), folder)
        system.create_dir(top)
        for batch in batches:
            for key, content in zip(batch["key"], batch["content"]):
                with system.open_output_stream(f"{top}/{file_name(key)}.bin") as out:
                    out.write(content)
            yield pd.DataFrame({"key": batch["key"], "length": batch["content"].map(len)})

    rows = blobs.select(F.col(key_col).cast("string").alias("key"), F.col(content_col).cast("binary").alias("content"))
    return rows.where("key IS NOT NULL AND content IS NOT NULL").mapInPandas(write, "key string, length bigint")


def read_blob_files(spark: SparkSession, folder: str, keys: str = "*", most_bytes: int | None = None,
                    written: DataFrame | None = None) -> DataFrame:
    """(key, length, modified, content) of the files of ``folder``. ``keys`` is a glob over
    file names, ``most_bytes`` a bound on the length: what they exclude is not read.

    Spark's readers skip empty files. With ``written``, the list that writing returned,
    its empty blobs are there too (without time)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"{keys}.bin").load(folder)
    if most_bytes is not None:
        files = files.where(F.col("length") <= most_bytes)
    out = files.select(key_of(F.col("path")).alias("key"), "length", F.col("modificationTime").alias("modified"), "content")
    if written is None:
        return out
    empty = written.where("length = 0").select("key", "length", F.lit(None).cast("timestamp").alias("modified"), F.lit(b"").alias("content"))
    return out.unionByName(empty)


def key_of(path: Column) -> Column:
    """The key from a file's URI."""
    return F.url_decode(F.regexp_replace(F.regexp_extract(path, r"b([^/]*)\.bin$", 1), "_([0-9A-F]{2})", "%$1"))

