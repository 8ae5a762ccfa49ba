"""The starting operation registry (the three operations the reference's
tests call) plus batch operations covering every result kind."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contentlake.operators.mutate import update_documents
from contentlake.operators.operations import register_operation


def _get_collections(spark, inputs, params, store) -> DataFrame:
    """User.GetCollections: collections whose name contains ``searchTerm``
    (case-insensitive; empty term = all)."""
    term = params.get("searchTerm", F.lit(""))
    c = store["collections"]
    return c.where(F.lower(F.col("name")).contains(F.lower(term))).select("user", "name")


def _add_to_favorites(spark, inputs, params, store) -> DataFrame:
    """Document.AddToFavorites: returns the document entity per request; the
    favourites table change is :func:`add_to_favorites`."""
    return inputs.select("req_id", F.col("doc_id").alias("uid"), F.lit(True).alias("favorite"))


def add_to_favorites(favorites: DataFrame | None, docs: DataFrame, user) -> DataFrame:
    """Distinct append of (user, doc_id) to the favourites table."""
    u = user if not isinstance(user, str) else F.lit(user)
    new = docs.select(u.alias("user"), F.col("doc_id"))
    both = new if favorites is None else favorites.select("user", "doc_id").unionByName(new)
    return both.distinct()


def attach_records(docs: DataFrame, records: DataFrame, document: Column,
                   xpath: Column) -> tuple[DataFrame, DataFrame]:
    """Attach each record's bytes to ``document`` (id or path) at ``xpath``.

    Returns (docs', results): the property becomes ``{name, length, digest}``
    (the bytes stay with their record; of several records for one property the
    last by ``req_id`` wins), the file name defaults to the record's id, and an
    unknown document is a failure row."""
    named = records.select(
        "req_id", document.cast("string").alias("document"), xpath.cast("string").alias("xpath"),
        F.coalesce("filename", F.col("req_id").cast("string")).alias("filename"),
        F.octet_length("content").cast("long").alias("length"), F.md5("content").alias("digest"))
    by_path = F.col("document").startswith("/")
    blob = F.to_json(F.struct(F.col("filename").alias("name"), "length", "digest"))
    changes = named.select("req_id", F.when(~by_path, F.col("document")).alias("doc_id"),
                           F.when(by_path, F.col("document")).alias("doc_path"),
                           F.col("xpath").alias("prop"), blob.alias("val"))
    docs2, done = update_documents(docs, changes, seq_col="req_id", req_key="req_id", path_col="doc_path")
    return docs2, named.join(done.select("req_id", "route", "error"), "req_id")


def _attach(spark, inputs, params, store) -> DataFrame:
    """Blob.Attach: returns the blob (one row per input), routed; the table
    change is :func:`attach_records`."""
    _, results = attach_records(store["docs"], inputs, params.get("document", F.lit(None)),
                                params.get("xpath", F.lit("file:content")))
    return results


# batch operations over the uploads table, one per result kind
def _batch_list(spark, inputs, params, store):
    u = store["uploads"].select(F.col("batch").alias("req_id"), "idx", "filename")
    return inputs.select("req_id").join(u, "req_id")


def _batch_info(spark, inputs, params, store):
    counts = store["uploads"].groupBy(F.col("batch").alias("req_id")).agg(F.count(F.lit(1)).alias("n_parts"))
    return inputs.select("req_id").join(counts, "req_id")


def _batch_blobs(spark, inputs, params, store):
    u = store["uploads"].select(F.col("batch").alias("req_id"), "idx", "filename",
                                F.octet_length("content").cast("long").alias("length"))
    return inputs.select("req_id").join(u, "req_id")


def _batch_first(spark, inputs, params, store):
    return _batch_blobs(spark, inputs, params, store).where(F.col("idx") == "0")


def _batch_name(spark, inputs, params, store):
    """The file name of the batch's first named part."""
    named = store["uploads"].where(F.col("filename").isNotNull()).groupBy(F.col("batch").alias("req_id")).agg(
        F.min_by("filename", F.struct(F.col("idx").cast("int"), "idx")).alias("content"))
    return inputs.select("req_id").join(named, "req_id")


def drop_batches(uploads: DataFrame, inputs: DataFrame) -> DataFrame:
    """The uploads without the batches that ``inputs`` (``req_id``) name."""
    gone = inputs.select(F.col("req_id").alias("batch")).distinct()
    return uploads.join(gone, "batch", "left_anti")


def _batch_drop(spark, inputs, params, store):
    """Batch.Drop returns nothing; the table after it is :func:`drop_batches`."""
    return inputs.select("req_id")


def register_builtins() -> None:
    register_operation("User.GetCollections", _get_collections, input="none", kind="entries")
    register_operation("Document.AddToFavorites", _add_to_favorites, input="document", kind="entity")
    register_operation("Blob.Attach", _attach, input="blob", kind="blob")
    register_operation("Batch.List", _batch_list, input="blob", kind="entries")
    register_operation("Batch.Info", _batch_info, input="blob", kind="entity")
    register_operation("Batch.Drop", _batch_drop, input="blob", kind="none")
    register_operation("Batch.Blobs", _batch_blobs, input="blob", kind="blobs")
    register_operation("Batch.First", _batch_first, input="blob", kind="blob")
    register_operation("Batch.Name", _batch_name, input="blob", kind="string")


register_builtins()
