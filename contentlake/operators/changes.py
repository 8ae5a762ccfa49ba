"""Streams of mixed changes: the net effect of create, update, trash and delete.

A batch of changes is an ordered list (``seq``) of rows of four kinds, long form:

    create   doc_id, parent_path, name, type, title, props MAP<STRING,STRING>
    update   doc_id, prop, val (one property a row)
    trash    doc_id
    delete   doc_id

:func:`net_changes` finds out what the changes of each document come to when they are
applied one after the other, without applying them: whether the document exists before
a change follows from the last create or delete before it (or, if there is none, from
the table), and everything else is a greatest or last one of the rows that succeed.
All of that is partially aggregated, or ranged over document and order, so a document
that gets a third of all changes is spread over many tasks.

The result is one row per changed document (``put`` with the whole new row, or
``delete``), ready for :meth:`contentlake.sources.versioned.VersionedTable.commit`, and
one result row per change.

Rules: a create of a document that exists fails, an update, trash or delete of one that
doesn't fails; a create after a delete starts anew. Null values are skipped, as in
:func:`contentlake.operators.mutate.update_documents`, but need an existing document.
References to *other* documents are to the table as it stands before the batch: parents
must exist there, and a path that another document holds there, or that an earlier
create of the batch gives to another id, is taken. Deletes don't cascade.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contentlake.functions.joins import LOOKUP_BROADCAST_ROWS, near_keys, row_count_at_most
from contentlake.functions.values import json_or_string
from contentlake.operators.lookup import DEFAULT_REPO, NO_REFERENCE, NOT_FOUND
from contentlake.operators.mutate import (
    ALREADY_EXISTS, DUPLICATE_IN_BATCH, EMPTY_PROPS, NO_NAME, PARENT_NOT_FOUND, child_path,
)
from contentlake.operators.routing import FAILURE, SUCCESS
from contentlake.plans.numbering import last_before
from contentlake.session import materialize
from contentlake.sources.versioned import DELETE, OP, PUT

CREATE, UPDATE, TRASH, DELETED = "create", "update", "trash", "delete"
UNKNOWN_KIND = "unknown kind of change"

#: The columns of a change; missing ones are null.
CHANGE = {"seq": "bigint", "kind": "string", "repo": "string", "doc_id": "string", "parent_path": "string",
          "name": "string", "type": "string", "title": "string", "props": "map<string,string>",
          "prop": "string", "val": "string"}


def _text(c: str) -> Column:
    return F.when(F.trim(c) != "", F.col(c))


def normalised(changes: DataFrame) -> DataFrame:
    """The columns of ``CHANGE`` with the path of creates and an id for each: a create
    without id gets one from its path, as :func:`~contentlake.operators.mutate.create_documents` gives it."""
    have = set(changes.columns)
    ch = changes.select(*[(F.col(c) if c in have else F.lit(None)).cast(t).alias(c) for c, t in CHANGE.items()])
    ch = ch.withColumn("repo", F.coalesce(_text("repo"), F.lit(DEFAULT_REPO)))
    ch = ch.withColumn("path", F.when(F.col("kind") == CREATE, child_path(F.col("parent_path"), F.col("name"))))
    derived = F.concat(F.lit("d-"), F.substring(F.sha2(F.col("path"), 256), 1, 24))
    return ch.withColumn("doc_id", F.coalesce(_text("doc_id"), derived))


def _broadcast(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df


def _judged(docs: DataFrame, ch: DataFrame, small: bool) -> DataFrame:
    """Changes with ``_error`` of what can be told without their order, the parent's
    id and whether the document is there before the batch."""
    creates = ch.where(F.col("kind") == CREATE)
    keys = (ch.select("repo", F.lit("id").alias("_rk"), F.col("doc_id").alias("_r"))
            .unionByName(creates.select("repo", F.lit("path").alias("_rk"), F.explode(F.array("path", "parent_path")).alias("_r")))
            .where(F.col("_r").isNotNull()).distinct())
    # one narrow scan answers all: documents by id, paths taken, parents
    refs = docs.select("repo", "id", F.explode(F.array(
        F.struct(F.lit("id").alias("k"), F.col("id").alias("r")),
        F.struct(F.lit("path").alias("k"), F.col("path").alias("r")))).alias("_x")).select("repo", "id", "_x.k", "_x.r")
    if not small:   # the table streams past the keys' hashes; only what may match is shuffled
        keys = materialize(keys)
        refs = near_keys(refs, ["repo", "k", "r"], keys, ["repo", "_rk", "_r"])
    # the hash first, as in create_documents
    on = (F.xxhash64(refs["repo"], refs["k"], refs["r"]) == F.xxhash64(keys["repo"], keys["_rk"], keys["_r"])) & (refs["repo"] == keys["repo"]) & (refs["k"] == keys["_rk"]) & (refs["r"] == keys["_r"])
    hits = materialize(refs.join(_broadcast(keys, small), on, "left_semi"))
    at = lambda kind, key, out: hits.where(F.col("k") == kind).select("repo", F.col("r").alias(key), F.col("id").alias(out))
    first = creates.where(F.col("path").isNotNull()).groupBy("repo", "path").agg(F.min_by("doc_id", "seq").alias("_owner"))
    out = (ch.join(_broadcast(at("id", "doc_id", "_there"), small), ["repo", "doc_id"], "left")
           .join(_broadcast(at("path", "path", "_holder"), small), ["repo", "path"], "left")
           .join(_broadcast(at("path", "parent_path", "_parent_id"), small), ["repo", "parent_path"], "left")
           .join(_broadcast(first, small), ["repo", "path"], "left"))
    create = F.when(F.col("path").isNull(), NO_NAME).when(F.col("_parent_id").isNull(), PARENT_NOT_FOUND) \
        .when(F.col("_holder") != F.col("doc_id"), ALREADY_EXISTS).when(F.col("_owner") != F.col("doc_id"), DUPLICATE_IN_BATCH)
    error = (F.when(F.col("kind") == CREATE, create).when(~F.coalesce(F.col("kind").isin(UPDATE, TRASH, DELETED), F.lit(False)), UNKNOWN_KIND)
             .when(F.col("doc_id").isNull(), NO_REFERENCE))
    return out.withColumns({"_error": error, "_there": F.col("_there").isNotNull()}).drop("_holder", "_owner")


def net_changes(docs: DataFrame, changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(delta, results) of a batch; see the module text. ``docs`` has a unique ``id``
    within ``repo``. ``delta``: the columns of ``docs`` and ``_op``, one row per document
    that changes. ``results``: ``seq, kind, repo, doc_id, route, error`` per change."""
    small = row_count_at_most(changes, LOOKUP_BROADCAST_ROWS)
    ch = _judged(docs, normalised(changes), small)
    # a valid create or delete decides whether the document exists after it
    after = F.when(F.col("_error").isNull() & F.col("kind").isin(CREATE, DELETED), F.col("kind") == CREATE)
    ch = last_before(ch.withColumn("_after", after), ["repo", "doc_id"], ["seq"], "_after", "_before")
    exists = F.coalesce("_before", "_there")
    error = (F.when(F.col("_error").isNotNull(), F.col("_error"))
             .when((F.col("kind") == CREATE) & exists, ALREADY_EXISTS)
             .when((F.col("kind") != CREATE) & ~exists, NOT_FOUND))
    ch = materialize(ch.withColumn("error", error))
    results = ch.select("seq", "kind", "repo", "doc_id", F.when(F.col("error").isNull(), SUCCESS).otherwise(FAILURE).alias("route"), "error")

    key = ["repo", "doc_id"]
    ok = ch.where(F.col("error").isNull())
    kind = lambda k: F.col("kind") == k
    made = F.struct("path", "parent_path", "name", "type", F.coalesce("title", "name").alias("title"), "props", F.col("_parent_id").alias("parent_id"))
    # the last create or delete that succeeded is where the document's final state begins
    state = ok.groupBy(*key).agg(
        F.max(F.when(kind(CREATE) | kind(DELETED), F.col("seq"))).alias("_reset"),
        F.max_by("kind", F.when(kind(CREATE) | kind(DELETED), F.col("seq"))).alias("_last"),
        F.max_by(made, F.when(kind(CREATE), F.col("seq"))).alias("_made"),
        F.max(F.when(kind(TRASH), F.col("seq"))).alias("_trash"),
        F.first("_there").alias("_there"))
    sets = (ok.where(kind(UPDATE) & F.col("prop").isNotNull() & F.col("val").isNotNull())
              .groupBy(*key, "prop").agg(F.max("seq").alias("_s"), F.max_by("val", "seq").alias("_v")))
    # one row per document and property: a document's properties are one value of its row
    props = (sets.join(state.select(*key, "_reset"), key).where(F.col("_reset").isNull() | (F.col("_s") > F.col("_reset")))
                 .groupBy(*key).agg(F.map_from_entries(F.collect_list(F.struct("prop", json_or_string(F.col("_v"))))).alias("_set")))
    state = state.join(props, key, "left").withColumn("_trashed", F.coalesce(F.col("_trash") > F.coalesce("_reset", F.lit(-(1 << 63))), F.lit(False)))
    state = materialize(state.where(F.coalesce(F.col("_last") != DELETED, F.lit(True)) | F.col("_there")))

    changed = _broadcast(state.where(F.col("_last").isNull()).select(F.col("repo").alias("_repo"), F.col("doc_id").alias("_id"), "_set", "_trashed"), small)
    near = docs if small else near_keys(docs, ["repo", "id"], changed, ["_repo", "_id"])
    old = near.join(changed, (near["repo"] == F.col("_repo")) & (near["id"] == F.col("_id")))
    updated = old.withColumns({"properties": _over(F.col("properties")), "trashed": F.col("trashed") | F.col("_trashed"), OP: F.lit(PUT)})
    return updated.select(*docs.columns, OP).unionByName(_created(docs, state)).unionByName(_deleted(docs, state)), results


def _over(old: Column) -> Column:
    """Properties ``old`` with those of ``_set`` in their place."""
    old = F.coalesce(old, F.create_map().cast(EMPTY_PROPS))
    return F.when(F.col("_set").isNull(), old).otherwise(
        F.map_concat(F.map_filter(old, lambda k, v: ~F.map_contains_key(F.col("_set"), k)), F.col("_set")))


def _as_docs(docs: DataFrame, rows: DataFrame, values: dict[str, Column], op: str) -> DataFrame:
    return rows.select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in docs.schema.fields], F.lit(op).alias(OP))


def _created(docs: DataFrame, state: DataFrame) -> DataFrame:
    new = state.where(F.col("_last") == CREATE)
    given = F.map_filter(F.coalesce(F.col("_made.props"), F.create_map().cast("map<string,string>")), lambda k, v: v.isNotNull())
    titled = F.map_concat(F.map_filter(given, lambda k, v: k != "dc:title"), F.create_map(
        F.lit("dc:title"), F.coalesce(F.col("_made.props")["dc:title"], F.col("_made.title"))))
    properties = _over(F.transform_values(titled, lambda k, v: json_or_string(v)))
    fields = {c: F.col(f"_made.{c}") for c in ("path", "parent_id", "name", "type", "title")}
    return _as_docs(docs, new, {**fields, "repo": F.col("repo"), "id": F.col("doc_id"), "state": F.lit("project"), "entity": F.lit("document"),
                                "locked": F.lit(False), "trashed": F.col("_trashed"), "properties": properties}, PUT)


def _deleted(docs: DataFrame, state: DataFrame) -> DataFrame:
    return _as_docs(docs, state.where(F.col("_last") == DELETED), {"repo": F.col("repo"), "id": F.col("doc_id")}, DELETE)
