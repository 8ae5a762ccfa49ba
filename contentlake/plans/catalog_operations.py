"""Queries: named operations, context parameters, result kinds, blob fan-out."""

from __future__ import annotations

from pyspark.sql import functions as F

from contentlake.functions import args
from contentlake.operators import builtin_operations as ops
from contentlake.operators.lookup import get_children
from contentlake.operators.operations import context_map, gate_empty_input, run_operation
from contentlake.operators.routing import SUCCESS
from contentlake.plans.registry import query
from contentlake.plans.sql_snippets import RESOLVED_REQUESTS
from contentlake.sources import repository as repo
from contentlake.sources.tables import tables

COLLECTIONS_SQL = """
coll as (select distinct c_mktsegment "user", n_name || ' accounts' name
         from customer join nation on c_nationkey = n_nationkey)"""


def _collections(t):
    c = t.customer.select("c_mktsegment", "c_nationkey")
    n = repo.nation_folders(t).select("n_nationkey", "n_name")
    return (c.join(n, c.c_nationkey == n.n_nationkey)
             .select(F.col("c_mktsegment").alias("user"),
                     F.concat("n_name", F.lit(" accounts")).alias("name")).distinct())


@query("op_void", oracle=f"""
with {COLLECTIONS_SQL}
select "user", name, 'success' route, cast(null as varchar) error from coll
where contains(lower(name), 'nation_1')""")
def op_void(spark, sf):
    t = tables(spark, sf)
    return run_operation(spark, "User.GetCollections", params={"searchTerm": "Nation_1"},
                         store={"collections": _collections(t)})


@query("empty_input_gate", oracle="""
select 'allowed' flag, id child_id, 'success' route from v_docs where parent_id = 'root'
union all
select 'given', id, 'success' from v_docs where parent_id = 'root'""")
def empty_input_gate(spark, sf):
    """Children of the configured path. Without any request nothing runs, unless
    the flag allows an empty input: then it runs once. With requests the flag
    changes nothing."""
    t = tables(spark, sf)
    docs, reqs = repo.docs(t), repo.requests(t).select("req_id")
    none = reqs.where("req_id < 0")
    cases = {"default": gate_empty_input(none), "allowed": gate_empty_input(none, allow=True),
             "given": gate_empty_input(reqs.agg(F.min("req_id").alias("req_id")), allow=True)}
    out = None
    for flag, gated in cases.items():
        at_root = gated.withColumns({"req_docid": F.lit(None).cast("string"), "req_path": F.lit("/")})
        kids = get_children(at_root, docs, child_cols=["id"]).select(F.lit(flag).alias("flag"), "child_id", "route")
        out = kids if out is None else out.unionByName(kids)
    return out


@query("op_document", oracle=f"""
with {RESOLVED_REQUESTS}
select distinct 'Administrator' "user", doc_id from r_res where doc_id is not null""")
def op_document(spark, sf):
    t = tables(spark, sf)
    res = run_operation(spark, "Document.AddToFavorites", repo.requests(t),
                        params={"user": "Administrator"}, store={"docs": repo.docs(t)})
    ok = res.where(F.col("route") == SUCCESS).select(
        F.get_json_object("content", "$.uid").alias("doc_id"))
    return ops.add_to_favorites(None, ok, "Administrator")


@query("op_document_results", oracle=f"""
with {RESOLVED_REQUESTS}
select req_id, case when doc_id is null then 'failure' else 'success' end route,
       case when doc_id is null then null else '{{"uid":"' || doc_id || '","favorite":true}}' end content
from r_res
union all select req_id, 'original', null from v_requests""")
def op_document_results(spark, sf):
    t = tables(spark, sf)
    res = run_operation(spark, "Document.AddToFavorites", repo.requests(t),
                        params={"user": "Administrator"}, store={"docs": repo.docs(t)}, original=True)
    return res.select("req_id", "route", "content")


def _blob_records(t):
    u = repo.uploads(t)
    return u.select(F.concat("batch", F.lit("-"), "idx").alias("req_id"), "batch", "filename", "content")


def _attach_to():
    return F.concat(F.lit("c"), F.substring("batch", 2, 100))


@query("op_blob", oracle="""
with u as (select batch || '-' || idx req_id, 'c' || substring(batch, 2) document, filename, length,
                  md5(content) digest from v_uploads)
select req_id, document, 'files:files' xpath, coalesce(filename, req_id) filename, length, digest,
       case when c_custkey is null then 'failure' else 'success' end route,
       case when c_custkey is null then 'document not found' end error
from u left join customer on document = 'c' || cast(c_custkey as varchar)
union all select req_id, null, null, filename, null, null, 'original', null from u""")
def op_blob(spark, sf):
    t = tables(spark, sf)
    res = run_operation(spark, "Blob.Attach", _blob_records(t), original=True,
                        store={"docs": repo.docs_with_properties(t)},
                        params={"document": _attach_to(), "xpath": "files:files"})
    return res.select("req_id", "document", "xpath", "filename", "length", "digest", "route", "error")


@query("op_blob_documents", oracle="""
with u as (select batch, coalesce(filename, batch || '-' || idx) filename, batch || '-' || idx req_id from v_uploads),
last as (select batch, max(req_id) req_id from u group by batch),
f as (select 'c' || substring(u.batch, 2) id, u.filename from u join last using (batch, req_id))
select d.id, f.filename attached from v_docs d left join f on d.id = f.id""")
def op_blob_documents(spark, sf):
    """The whole table after attaching: the last record of a document wins."""
    t = tables(spark, sf)
    docs, _ = ops.attach_records(repo.docs_with_properties(t), _blob_records(t), _attach_to(), F.lit("files:files"))
    blob = F.try_element_at("properties", F.lit("files:files"))
    return docs.select("id", F.try_variant_get(blob, "$.name", "string").alias("attached"))


@query("op_context", oracle="""
with r as (
  select e.event_id req_id, e.event_type,
         case when e.event_type in ('view', 'purchase') then 'c' || cast(e.user_id as varchar)
              when e.event_type = 'error' then 'missing-' || cast(e.event_id as varchar) end docid,
         case when e.event_type = 'view' then cast(cast(floor(e.value) as bigint) as varchar) end page_size
  from events e)
select req_id, 'searchTerm' key, 'type:' || event_type value from r
union all select req_id, 'docRef', docid from r where docid is not null
union all select req_id, 'pageSize', page_size from r where page_size is not null
union all select req_id, 'mode', 'fast' from r""")
def op_context(spark, sf):
    rec = repo.request_records(tables(spark, sf))
    ctx = context_map({"searchTerm": args.template("type:${nx-type}"),
                       "docRef": args.resolve(None, args.ATTR_DOCID),
                       "pageSize": args.resolve(None, args.ATTR_PAGE_SIZE),
                       "mode": "fast", "unset": None})
    return rec.select("req_id", F.explode(ctx).alias("key", "value"))


KIND_OPS = [("Batch.List", True), ("Batch.List", False), ("Batch.Info", True), ("Batch.Drop", True),
            ("Batch.Blobs", True), ("Batch.First", True), ("Batch.Name", True)]


@query("op_result_kind", oracle="""
with u as (select batch, idx, filename, length, row_number() over (partition by batch order by filename nulls first, idx) p from v_uploads),
pages as (select batch, (p - 1) // 10 pg, count(*) n from u group by batch, (p - 1) // 10)
select 'Batch.List/split' op, batch req_id, idx || ' ' || coalesce(filename, '') result from u
union all select 'Batch.List/pages', batch, cast(pg as varchar) || ' ' || cast(n as varchar) from pages
union all select 'Batch.Info/split', batch, '{"n_parts":' || cast(count(*) as varchar) || '}' from u group by batch
union all select 'Batch.Blobs/split', batch, idx || ' ' || cast(length as varchar) from u
union all select 'Batch.First/split', batch, idx || ' ' || cast(length as varchar) from u where idx = '0'
union all select 'Batch.Name/split', batch, arg_min(filename, cast(idx as int)) from u where filename is not null group by batch""")
def op_result_kind(spark, sf):
    """Every row of an operation of each result kind; Batch.Drop returns none."""
    t = tables(spark, sf)
    uploads = repo.uploads(t)
    batches = uploads.select(F.col("batch").alias("req_id")).distinct()
    show = {"Batch.List/split": F.concat_ws(" ", "idx", F.coalesce("filename", F.lit(""))),
            "Batch.List/pages": F.concat_ws(" ", "page_index", "n_entries"), "Batch.Info/split": F.col("content"),
            "Batch.Drop/split": F.lit(None), "Batch.Blobs/split": F.concat_ws(" ", "idx", "length"),
            "Batch.First/split": F.concat_ws(" ", "idx", "length"), "Batch.Name/split": F.col("content")}
    parts = []
    for name, split in KIND_OPS:
        res = run_operation(spark, name, batches, split=split, store={"uploads": uploads})
        label = f"{name}/{'split' if split else 'pages'}"
        parts.append(res.where(F.col("route") == SUCCESS).select(F.lit(label).alias("op"), "req_id", show[label].cast("string").alias("result")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("op_batch_drop", oracle="""
select batch, idx, filename, length from v_uploads where batch not in (select batch from v_uploads where filename is null)""")
def op_batch_drop(spark, sf):
    """The uploads after dropping every batch that has a part without name."""
    uploads = repo.uploads(tables(spark, sf)).withColumn("length", F.octet_length("content").cast("long"))
    unnamed = uploads.where(F.col("filename").isNull()).select(F.col("batch").alias("req_id"))
    return ops.drop_batches(uploads, unnamed).select("batch", "idx", "filename", "length")


@query("split_blobs", oracle="""
select batch req_id, idx, filename, length from v_uploads""")
def split_blobs(spark, sf):
    t = tables(spark, sf)
    uploads = repo.uploads(t)
    batches = uploads.select(F.col("batch").alias("req_id")).distinct()
    res = run_operation(spark, "Batch.Blobs", batches, store={"uploads": uploads})
    return res.select("req_id", "idx", "filename", "length")
