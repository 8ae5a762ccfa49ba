"""Create, update, trash, delete, attach; start and cancel workflows.

Every write is a pure function ``(table, requests) -> (table', results)``:
the new table is a DataFrame merge (joins + unions, copy-on-write), and
``results`` holds one terminal row per request (``success`` / ``failure``
with ``error``). Persisting a new snapshot is a separate sink
(:func:`contentlake.sources.snapshots.write_snapshot`).

Plain Spark tables have no ``MERGE INTO``, so merges are expressed as:
``old left join changes on key`` + ``coalesce``; deletes as ``left_anti``.
Several changes to one key are reduced first with an aggregation (partial
per partition), so a hot document never gathers its changes in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contentlake.functions.args import is_blank
from contentlake.functions.joins import (
    bounded_broadcast, is_narrow, keep, preserving_lookup, row_count_at_most,
)
from contentlake.functions.values import json_or_string
from contentlake.operators.lookup import NOT_FOUND, get_document, requests_are_small
from contentlake.operators.relations import NO_BATCH
from contentlake.operators.routing import FAILURE, SUCCESS
from contentlake.session import materialize

PARENT_NOT_FOUND = "parent not found"
ALREADY_EXISTS = "document already exists"
DUPLICATE_IN_BATCH = "another request creates the same path"
NO_NAME = "no parent path or name"
ID_TAKEN = "document id already exists"
DUPLICATE_ID = "another request creates the same id"
MODEL_NOT_FOUND = "workflow model not found"
EMPTY_PROPS = "map<string,variant>"
# change sets (updated / trashed / deleted / cancelled keys) up to this many
# rows are broadcast into the merge, so the table is rewritten in place
# without being shuffled; larger ones use a shuffle join
CHANGE_BROADCAST_ROWS = 1_000_000


def _empty_props() -> Column:
    return F.create_map().cast(EMPTY_PROPS)


def _fill_doc_columns(new: DataFrame, docs: DataFrame) -> DataFrame:
    defaults = {"repo": F.lit("default"), "locked": F.lit(False), "trashed": F.lit(False),
                "entity": F.lit("document"), "properties": _empty_props(),
                "state": F.lit("project")}
    cols = []
    for f in docs.schema.fields:
        if f.name in new.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(defaults.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name))
    return new.select(*cols)


def property_map(props: dict[str, Column]) -> Column:
    """Dynamic properties -> MAP<STRING, VARIANT>; null values are skipped,
    values become JSON when they parse, strings otherwise."""
    if not props:
        return _empty_props()
    entries = F.array(*[F.struct(F.lit(k).alias("key"), json_or_string(v.cast("string")).alias("value"))
                        for k, v in props.items()])
    return F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))


def child_path(parent: Column, name: Column) -> Column:
    return F.when(parent == "/", F.concat(F.lit("/"), name)).otherwise(F.concat(parent, F.lit("/"), name))


def create_documents(docs: DataFrame, requests: DataFrame, *, req_key: str = "req_id",
                     parent_path: str = "parent_path", name: str = "name", doc_type: str = "type",
                     title: str | None = "title", new_id: str | None = None,
                     properties: dict[str, Column] | None = None,
                     blob_ref: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Create one document per request below ``parent_path``.

    ``dc:title`` = title or name; dynamic ``properties`` are JSON-or-string
    (null skipped); ``blob_ref`` = {xpath, batch, index} column names adds an
    ``{upload-batch, upload-fileId}`` reference when all three are set.
    Failures: no parent path or name, missing parent, existing path or id, or
    a second request for the same path or id (the smallest request key that
    has no other failure wins). Every request gives exactly one result row.
    """
    t = F.coalesce(F.col(title), F.col(name)) if title else F.col(name)
    props = dict(properties or {})
    props_col = property_map({"dc:title": t, **props})
    if blob_ref:
        xp, b, i = (F.col(blob_ref[k]) for k in ("xpath", "batch", "index"))
        ref = F.to_json(F.struct(b.alias("upload-batch"), i.alias("upload-fileId")))
        with_ref = F.map_concat(F.map_filter(props_col, lambda k, v: k != xp),
                                F.create_map(xp, F.parse_json(ref)))
        props_col = F.when(xp.isNotNull() & b.isNotNull() & i.isNotNull(), with_ref).otherwise(props_col)
    req = requests.select(
        F.col(req_key).alias("_req"), F.col(parent_path).alias("_pp"), F.col(name).alias("_name"),
        F.col(doc_type).alias("_type"), t.alias("_title"),
        (F.col(new_id) if new_id else F.lit(None).cast("string")).alias("_nid"),
        props_col.alias("_props"))
    req = req.withColumn("_path", child_path(F.col("_pp"), F.col("_name")))  # null if either is
    doc_id = F.coalesce(F.col("_nid"), F.concat(F.lit("d-"), F.substring(F.sha2(F.col("_path"), 256), 1, 24)))
    req = req.withColumn("_id", doc_id)
    # One scan of docs answers all three questions (does the parent exist, is the new
    # path taken, is the new id taken): the distinct references of all requests are
    # matched against the ids and paths of docs. Those of a proven-small batch are
    # broadcast, so docs stream through unshuffled; the few matches are joined back.
    small = requests_are_small(requests)
    kinds = (("path", "_pp"), ("path", "_path"), ("id", "_id"))
    keys = req.select(F.explode(F.array(*[F.struct(F.lit(k).alias("_rk"), F.col(c).alias("_r")) for k, c in kinds])).alias("_k")) \
        .select("_k._rk", "_k._r").where(F.col("_r").isNotNull()).distinct()
    refs = docs.select("id", F.explode(F.array(*[F.struct(F.lit(k).alias("_dk"), F.col(k).alias("_d")) for k in ("path", "id")])).alias("_x")) \
        .select("id", "_x._dk", "_x._d")
    # the hash first: a shuffle join sorts by it, not by kinds and paths that begin alike
    match = (F.xxhash64("_dk", "_d") == F.xxhash64("_rk", "_r")) & (F.col("_dk") == F.col("_rk")) & (F.col("_d") == F.col("_r"))
    hits = refs.join(_maybe_broadcast(keys, small), match).groupBy("_rk", "_r").agg(F.max("id").alias("_at"))
    # at most three rows per request; joined three times, twice more for the owners of
    # ids, and again by every reader of the new table: the scan is not repeated for them
    hits = F.broadcast(keep(hits)) if small else materialize(hits)
    at = lambda kind, key, out: hits.where(F.col("_rk") == kind).select(F.col("_r").alias(key), F.col("_at").alias(out))
    first = req.groupBy("_path").agg(F.min("_req").alias("_first"))
    j = (req.join(at("path", "_pp", "_parent_id"), "_pp", "left").join(at("path", "_path", "_existing_id"), "_path", "left")
            .join(at("id", "_id", "_w"), "_id", "left").join(_maybe_broadcast(first, small), "_path", "left"))
    error = (F.when(F.col("_path").isNull(), F.lit(NO_NAME))
              .when(F.col("_parent_id").isNull(), F.lit(PARENT_NOT_FOUND))
              .when(F.col("_existing_id").isNotNull(), F.lit(ALREADY_EXISTS))
              .when(F.col("_w").isNotNull(), F.lit(ID_TAKEN))
              .when(F.col("_req") != F.col("_first"), F.lit(DUPLICATE_IN_BATCH)))
    j = j.withColumn("_err", error)
    if new_id:   # derived ids are as unique as the paths
        owner = (j.where(F.col("_err").isNull()).groupBy(F.col("_id").alias("_oid"))
                  .agg(F.min("_req").alias("_owner")))
        j = j.join(owner, j["_id"] == owner["_oid"], "left").withColumn(
            "_err", F.when(F.col("_err").isNull() & (F.col("_req") != F.col("_owner")), F.lit(DUPLICATE_ID))
                     .otherwise(F.col("_err")))
    results = j.select(
        F.col("_req").alias(req_key),
        F.when(F.col("_err").isNull(), F.lit(SUCCESS)).otherwise(F.lit(FAILURE)).alias("route"),
        F.col("_err").alias("error"),
        F.when(F.col("_err").isNull(), F.col("_id")).alias("doc_id"),
        F.col("_path").alias("doc_path"))
    created = j.where(F.col("_err").isNull()).select(
        F.col("_id").alias("id"), F.col("_parent_id").alias("parent_id"), F.col("_path").alias("path"),
        F.col("_name").alias("name"), F.col("_type").alias("type"), F.col("_title").alias("title"),
        F.col("_props").alias("properties"))
    return docs.unionByName(_fill_doc_columns(created, docs)), results


def _named(docs: DataFrame, rows: DataFrame, doc_col: str, path_col: str | None,
           inline_col: str | None) -> DataFrame:
    """``rows`` whose ``doc_col`` names the document: an inline document's id, the given
    id, or the id at the given path - in one split, so that rows that know their
    document never meet the table here."""
    if inline_col:
        rows = rows.withColumn(doc_col, F.coalesce(F.col(f"{inline_col}.id"), doc_col)).drop(inline_col)
    if not path_col:
        return rows
    known = ~is_blank(F.col(doc_col)) | is_blank(F.col(path_col))
    found = get_document(rows.where(~known), docs, doc_col, path_col, doc_cols=["id"], prefix="_at_")
    found = found.withColumn(doc_col, F.coalesce("_at_id", doc_col)).select(*rows.columns)
    return rows.where(known).unionByName(found)


def _latest_values(updates: DataFrame, doc_col: str, prop_col: str, val_col: str,
                   seq_col: str | None) -> DataFrame:
    """Last value per (document, property) by request order (without an order:
    the greatest value, so that reruns agree); ``max_by`` is partially
    aggregated, so a hot document is reduced map-side."""
    seq = F.struct(seq_col, val_col) if seq_col else F.col(val_col)
    return (updates.groupBy(doc_col, prop_col)
                   .agg(F.max_by(F.col(val_col), seq).alias("_v")))


def update_documents(docs: DataFrame, updates: DataFrame, *, doc_col: str = "doc_id",
                     prop_col: str = "prop", val_col: str = "val", seq_col: str | None = None,
                     req_key: str | None = None, path_col: str | None = None,
                     inline_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Set dynamic properties (long-form updates) and keep all others.

    The document is named by id, or with ``path_col`` by path where the id is
    blank. ``inline_col`` is a struct of already-parsed document fields (null when the
    record carried no usable document): an inline document's own ``id`` names it and
    needs no lookup; only the rows left with a path are looked up. Values are JSON-or-string; null values are skipped; ``seq_col``
    orders the updates of one property. Results: one row per update row (or
    per ``req_key``) - success when the document exists."""
    updates = _named(docs, updates, doc_col, path_col, inline_col)
    clean = updates.where(F.col(val_col).isNotNull())
    latest = _latest_values(clean, doc_col, prop_col, val_col, seq_col)
    new_props = (latest.groupBy(doc_col)
                       .agg(F.map_from_entries(F.collect_list(F.struct(
                           F.col(prop_col), json_or_string(F.col("_v"))))).alias("_new")))
    # a bounded change set is broadcast: docs stream through (left join,
    # build right), so an update never shuffles the whole table
    small_updates = row_count_at_most(updates, CHANGE_BROADCAST_ROWS)   # checked on the input
    if small_updates:
        new_props = F.broadcast(new_props)
    d = docs.join(new_props, docs["id"] == new_props[doc_col], "left").drop(doc_col)
    old = F.coalesce("properties", _empty_props())
    merged = F.when(F.col("_new").isNull(), F.col("properties")).otherwise(F.map_concat(
        F.map_filter(old, lambda k, v: ~F.map_contains_key(F.col("_new"), k)), F.col("_new")))
    docs2 = d.withColumn("properties", merged).drop("_new")
    keys = [req_key] if req_key else [doc_col, prop_col]
    ids = docs.select(F.col("id").alias("_id"), F.lit(True).alias("_hit"))
    res = preserving_lookup(updates.select(*dict.fromkeys([*keys, doc_col])), ids,
                            [doc_col], ["_id"], small=small_updates)
    results = res.select(*dict.fromkeys([*keys, doc_col]),
                         F.when(F.col("_hit"), F.lit(SUCCESS)).otherwise(F.lit(FAILURE)).alias("route"),
                         F.when(F.col("_hit"), F.lit(None).cast("string")).otherwise(F.lit(NOT_FOUND)).alias("error"))
    return docs2, results


def _resolve(docs: DataFrame, requests: DataFrame, id_col: str,
             path_col: str) -> tuple[DataFrame, bool]:
    """Resolved requests, and whether the request side is proven small (then
    every key set derived from it is small too and is broadcast)."""
    small = requests_are_small(requests)
    return get_document(requests, docs, id_col, path_col, doc_cols=["id"], small=small), small


def _maybe_broadcast(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df


def trash_documents(docs: DataFrame, requests: DataFrame, id_col: str = "req_docid",
                    path_col: str = "req_path") -> tuple[DataFrame, DataFrame]:
    """Move to trash: the document stays, flagged ``trashed``; result rows
    carry ``trashed = true`` (``nx-trashed``)."""
    res, small = _resolve(docs, requests, id_col, path_col)
    hit = res.where(F.col("route") == SUCCESS).select(F.col("doc_id").alias("_t")).distinct()
    hit = _maybe_broadcast(hit, small)
    d = docs.join(hit, docs["id"] == hit["_t"], "left")
    docs2 = d.withColumn("trashed", F.col("trashed") | F.col("_t").isNotNull()).drop("_t")
    results = res.withColumn("trashed", F.when(F.col("route") == SUCCESS, F.lit(True)))
    return docs2, results


def delete_documents(docs: DataFrame, requests: DataFrame, id_col: str = "req_docid",
                     path_col: str = "req_path") -> tuple[DataFrame, DataFrame]:
    """Delete permanently: only the named rows are removed (no cascade)."""
    res, small = _resolve(docs, requests, id_col, path_col)
    hit = res.where(F.col("route") == SUCCESS).select(F.col("doc_id").alias("id")).distinct()
    return docs.join(_maybe_broadcast(hit, small), "id", "left_anti"), res


def attach_blobs(docs: DataFrame, requests: DataFrame, *, req_key: str = "req_id",
                 doc_col: str = "req_docid", xpath_col: str = "xpath", batch_col: str = "batch",
                 index_col: str = "idx", path_col: str | None = None,
                 inline_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Set the property at xpath to ``{upload-batch, upload-fileId}``.
    ``path_col`` names the document where the id is blank, ``inline_col`` holds it
    where the record carries it (see :func:`update_documents`).

    Blank batch or index -> failure ``No upload batch`` (no lookup);
    unknown document -> failure."""
    blank = is_blank(F.col(batch_col)) | is_blank(F.col(index_col))
    guarded = requests.withColumn("_blank", blank)
    ok = guarded.where(~F.col("_blank"))
    ref = F.to_json(F.struct(F.col(batch_col).alias("upload-batch"),
                             F.col(index_col).alias("upload-fileId")))
    upd = ok.select(F.col(req_key), F.col(doc_col).alias("doc_id"),
                    F.coalesce(F.col(xpath_col), F.lit("file:content")).alias("prop"),
                    ref.alias("val"), F.col(req_key).alias("_seq"), *[c for c in (path_col, inline_col) if c])
    docs2, res = update_documents(docs, upd, seq_col="_seq", req_key=req_key, path_col=path_col, inline_col=inline_col)
    failed = guarded.where(F.col("_blank")).select(
        F.col(req_key), F.col(doc_col).alias("doc_id"), F.lit(FAILURE).alias("route"),
        F.lit(NO_BATCH).alias("error"))
    return docs2, res.unionByName(failed)


# ---------------------------------------------------------------- workflows

def start_workflows(docs: DataFrame, workflows: DataFrame, requests: DataFrame,
                    models: DataFrame, *, req_key: str = "req_id", model_col: str = "workflow",
                    id_col: str = "req_docid", path_col: str = "req_path",
                    started: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Start the named model on each requested document.

    Unknown model or document -> failure. The new instance id is derived
    from the request key (``wf-<req>``), so reruns are idempotent."""
    res, _ = _resolve(docs, requests, id_col, path_col)
    m = bounded_broadcast(models.select(F.col("name").alias("_model")).distinct(), 100_000)
    j = res.join(m, res[model_col] == m["_model"], "left")
    err = (F.when(F.col("route") == FAILURE, F.col("error"))
            .when(F.col("_model").isNull(), F.lit(MODEL_NOT_FOUND)))
    j = j.withColumns({"error": err,
                       "route": F.when(err.isNull(), F.lit(SUCCESS)).otherwise(F.lit(FAILURE)),
                       "workflow_id": F.when(err.isNull(), F.concat(F.lit("wf-"), F.col(req_key).cast("string")))})
    results = j.drop("_model")
    new = results.where(F.col("route") == SUCCESS).select(
        "workflow_id", "doc_id", F.col(model_col).alias("name"), F.lit("running").alias("state"),
        (started if started is not None else F.current_timestamp()).alias("started_ts"))
    new = new.select(*[F.col(f.name).cast(f.dataType) for f in workflows.schema.fields])
    return workflows.unionByName(new), results


def cancel_workflows(docs: DataFrame, workflows: DataFrame, requests: DataFrame, *,
                     req_key: str = "req_id", model_col: str = "workflow",
                     id_col: str = "req_docid", path_col: str = "req_path") -> tuple[DataFrame, DataFrame]:
    """Cancel every running instance with the given name on each document:
    one success row per cancelled instance, under the smallest request key that
    asks for it; other requests find it no longer running and get no row, like
    requests that match nothing. Unresolved documents fail."""
    res, small = _resolve(docs, requests, id_col, path_col)
    ok = res.where(F.col("route") == SUCCESS)
    running = workflows.where(F.col("state") == "running").select(
        F.col("doc_id").alias("_wd"), F.col("name").alias("_wn"), "workflow_id")
    # one request per (document, name): instances and requests never multiply
    ok = (ok.groupBy(F.col("doc_id").alias("_od"), F.col(model_col).alias("_om"))
            .agg(F.min_by(F.struct(*ok.columns), F.col(req_key)).alias("_ok")).select("_ok.*"))
    okb = _maybe_broadcast(ok, small and is_narrow(ok))   # workflows stream through
    hits = (running.join(okb, (okb["doc_id"] == running["_wd"]) & (okb[model_col] == running["_wn"]))
                   .drop("_wd", "_wn"))
    failed = res.where(F.col("route") == FAILURE).withColumn("workflow_id", F.lit(None).cast("string"))
    results = hits.unionByName(failed)
    # what is cancelled follows from the (document, name) pairs, which are at most the
    # requests; the instances themselves needn't be counted or joined back
    pairs = _maybe_broadcast(ok.select(F.col("doc_id").alias("_pd"), F.col(model_col).alias("_pn")), small)
    w = workflows.join(pairs, (workflows["doc_id"] == pairs["_pd"]) & (workflows["name"] == pairs["_pn"]), "left")
    gone = F.col("_pd").isNotNull() & (F.col("state") == "running")
    return w.withColumn("state", F.when(gone, F.lit("canceled")).otherwise(F.col("state"))).drop("_pd", "_pn"), results
