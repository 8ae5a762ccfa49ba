"""Uploads: store record bytes under (batch, index), optionally in chunks.

Bytes stay out of shuffles: uploads are appends (no join on content), and
chunking is a per-row ``explode`` of byte offsets plus ``substring`` on
BINARY, so a large blob becomes many bounded rows in place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contentlake.functions.args import fill_defaults
from contentlake.operators.routing import ORIGINAL, SUCCESS, routed, union_routes


def new_batch_id(req_key: Column) -> Column:
    """Batch id for a request that names none: derived from the request key,
    so a rerun after a lost executor writes the same batch."""
    return F.concat(F.lit("batch-"), F.md5(req_key.cast("string")))


def upload_blobs(uploads: DataFrame | None, requests: DataFrame, *, req_key: str = "req_id",
                 content_col: str = "content", filename_col: str = "filename",
                 batch_col: str = "batch", index_col: str = "idx",
                 original: bool = True) -> tuple[DataFrame, DataFrame]:
    """Append each request's content to ``uploads``.

    Defaults: batch = new id from the request key, index = ``0``,
    filename = ``data-<request key>``. Results carry batch, index and
    filename on ``success`` plus the request on ``original``."""
    key = F.col(req_key).cast("string")
    rows = fill_defaults(requests.select(
        F.col(req_key),
        F.coalesce(F.col(batch_col), new_batch_id(key)).alias("batch"),
        F.col(index_col).alias("idx"), F.col(filename_col).alias("filename"),
        F.col(content_col).cast("binary").alias("content")), key)
    stored = rows.drop(req_key)
    uploads2 = stored if uploads is None else uploads.unionByName(stored, allowMissingColumns=True)
    results = routed(rows.select(req_key, "batch", "idx", "filename",
                                 F.octet_length("content").cast("long").alias("length")), SUCCESS)
    if original:
        results = union_routes(results, routed(requests, ORIGINAL))
    return uploads2, results


def chunk(df: DataFrame, chunk_size: int, content_col: str = "content") -> DataFrame:
    """One row per fixed-size chunk: ``chunk_no`` (0-based), ``chunk`` bytes.
    Empty content yields one empty chunk."""
    if chunk_size <= 0:
        raise ValueError("chunk size must be positive")
    n = F.octet_length(F.col(content_col))
    count = F.greatest(F.ceil(n / F.lit(chunk_size)), F.lit(1)).cast("int")
    exploded = df.withColumn("chunk_no", F.explode(F.sequence(F.lit(0), count - 1)))
    piece = F.expr(f"substring({content_col}, chunk_no * {chunk_size} + 1, {chunk_size})")
    return exploded.withColumn("chunk", piece).drop(content_col)


def reassembled_matches(chunks: DataFrame, originals: DataFrame, keys: list[str],
                        chunk_size: int, content_col: str = "content") -> DataFrame:
    """Chunk-by-chunk identity check against the original content, without
    gathering a blob's chunks into one row: each chunk is compared with the
    bytes at its offset. Returns the keys of mismatching chunks."""
    rechunked = chunk(originals.select(*keys, content_col), chunk_size, content_col) \
        .withColumnRenamed("chunk", "_expected")
    j = chunks.join(rechunked, [*keys, "chunk_no"], "full_outer")
    return j.where(~F.col("chunk").eqNullSafe(F.col("_expected"))).select(*keys, "chunk_no")
