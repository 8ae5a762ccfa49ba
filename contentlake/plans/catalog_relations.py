"""Queries: ACL, audit, workflows, blobs, inline documents, entity JSON."""

from __future__ import annotations

from pyspark.sql import functions as F

from contentlake.functions import args
from contentlake.operators import lookup, relations
from contentlake.plans.registry import query
from contentlake.plans.sql_snippets import ERROR_OF_MISS, RESOLVED_REQUESTS
from contentlake.session import materialize, shared_dir
from contentlake.sources import entity_json as ej
from contentlake.sources import repository as repo
from contentlake.sources.blob_files import read_blob_files, write_blob_files
from contentlake.sources.tables import tables


def _nation_requests(t):
    """One request per nation folder: by path for even keys, by id for odd."""
    nf = repo.nation_folders(t)
    even = (F.col("n_nationkey") % 2) == 0
    return nf.select(F.col("n_nationkey").cast("long").alias("req_id"),
                     F.when(~even, F.col("nation_id")).alias("req_docid"),
                     F.when(even, F.col("nation_path")).alias("req_path"))


@query("get_acl", oracle="""
select n_nationkey req_id, case when n_nationkey % 2 = 1 then nation_id end req_docid,
       case when n_nationkey % 2 = 0 then nation_path end req_path, nation_id doc_id,
       acl_name, pos, principal, permission, granted, 'success' route, cast(null as varchar) error
from v_nation join v_acl on v_acl.doc_id = nation_id""")
def get_acl(spark, sf):
    t = tables(spark, sf)
    return relations.get_related(_nation_requests(t), repo.docs(t), repo.acl(t),
                                 ["acl_name", "pos", "principal", "permission", "granted"])


@query("get_acl_json", oracle="""
with a as (select doc_id, pos, principal, granted from v_acl)
select doc_id, (pos - 1) // 3 chunk, count(*) n_entries,
       to_json(list(struct_pack(principal := principal, granted := granted) order by pos)) content
from a group by doc_id, (pos - 1) // 3""")
def get_acl_json(spark, sf):
    acl = repo.acl(tables(spark, sf))
    return relations.related_json_chunks(acl, "doc_id", ["pos"], ["principal", "granted"], chunk_size=3)


@query("get_audit", oracle=f"""
with {RESOLVED_REQUESTS}
select req_id, req_docid, req_path, r_res.doc_id, entry_id, event_type, epoch_us(ts) ts_us, value,
       'success' route, cast(null as varchar) error
from r_res join v_audit a on a.doc_id = r_res.doc_id
union all
select req_id, req_docid, req_path, null, null, null, null, null, 'failure', {ERROR_OF_MISS}
from r_res where doc_id is null""")
def get_audit(spark, sf):
    t = tables(spark, sf)
    # microseconds since the epoch of the wall-clock (NTZ) value: independent
    # of the session time zone, like DuckDB's epoch_us on a naive timestamp
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    audit = repo.audit(t).withColumn("ts_us", F.timestamp_diff("MICROSECOND", epoch, F.col("ts")))
    return relations.get_related(repo.requests(t), repo.docs(t), audit,
                                 ["entry_id", "event_type", "ts_us", "value"])


def _factored(outcomes, chunks):
    """The two parts of the JSON form in one frame."""
    return outcomes.select("req_id", "doc_id", "route", "error").unionByName(chunks, allowMissingColumns=True)


@query("get_acl_request_json", oracle="""
with a as (select doc_id, pos, principal, granted from v_acl)
select cast(n_nationkey as bigint) req_id, nation_id doc_id, 'success' route, cast(null as varchar) error, null chunk, null n_entries,
       cast(null as varchar) content from v_nation
union all
select null, doc_id, null, null, (pos - 1) // 3, count(*),
       to_json(list(struct_pack(principal := principal, granted := granted) order by pos))
from a join v_nation on doc_id = nation_id group by doc_id, (pos - 1) // 3""")
def get_acl_request_json(spark, sf):
    t = tables(spark, sf)
    return _factored(*relations.get_related_json(_nation_requests(t), repo.docs(t), repo.acl(t), ["pos"],
                                                 ["principal", "granted"], chunk_size=3))


@query("get_audit_request_json", oracle=f"""
with {RESOLVED_REQUESTS},
e as (select a.doc_id, entry_id, event_type, row_number() over (partition by a.doc_id order by entry_id) p
      from v_audit a where a.doc_id in (select doc_id from r_res))
select req_id, doc_id, case when doc_id is null then 'failure' else 'success' end route,
       case when doc_id is null then {ERROR_OF_MISS} end error, null chunk, null n_entries, cast(null as varchar) content from r_res
union all
select null, doc_id, null, null, (p - 1) // 50, count(*),
       to_json(list(struct_pack(entry_id := entry_id, event_type := event_type) order by p))
from e group by doc_id, (p - 1) // 50""")
def get_audit_request_json(spark, sf):
    """Audit logs as JSON by request: every request's outcome, every requested log once."""
    t = tables(spark, sf)
    return _factored(*relations.get_related_json(repo.requests(t), repo.docs(t), repo.audit(t), ["entry_id"],
                                                 ["entry_id", "event_type"], chunk_size=50))


@query("get_workflows", oracle=f"""
with {RESOLVED_REQUESTS}
select req_id, req_docid, req_path, r_res.doc_id, workflow_id, name, state,
       'success' route, cast(null as varchar) error
from r_res join v_workflows w on w.doc_id = r_res.doc_id
union all
select req_id, req_docid, req_path, null, null, null, null, 'failure', {ERROR_OF_MISS}
from r_res where doc_id is null""")
def get_workflows(spark, sf):
    t = tables(spark, sf)
    return relations.get_related(repo.requests(t), repo.docs(t), repo.workflows(t),
                                 ["workflow_id", "name", "state"])


@query("workflow_name_filter", oracle="""
select doc_id, workflow_id from v_workflows where name = 'signup'""")
def workflow_name_filter(spark, sf):
    w = repo.workflows(tables(spark, sf))
    return relations.workflows_named(w, "signup").select("doc_id", "workflow_id")


def _blob_requests(t):
    pg = t.pages.select("page_id", "url")
    return pg.select(F.col("page_id").alias("req_id"),
                     F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("req_docid"),
                     F.when(F.col("url").contains("#"), F.lit("files:missing")).alias("req_xpath"))


@query("get_blob", oracle="""
with r as (select page_id req_id, 'p' || cast(page_id as varchar) req_docid,
                  case when url like '%#%' then 'files:missing' end req_xpath from pages)
select r.req_id, r.req_docid, r.req_xpath, coalesce(r.req_xpath, 'file:content') xpath,
       b.filename, b.mime_type, b.length, b.digest,
       case when b.doc_id is null then 'failure' else 'success' end route,
       case when b.doc_id is null then 'blob not found' end error
from r left join v_blobs b on b.doc_id = r.req_docid and b.xpath = coalesce(r.req_xpath, 'file:content')
union all
select req_id, req_docid, req_xpath, null, null, null, null, null, 'original', null from r""")
def get_blob(spark, sf):
    t = tables(spark, sf)
    blobs = repo.blobs(t).withColumn("length", F.octet_length("content"))
    out = relations.get_blob(_blob_requests(t), blobs,
                             blob_cols=["filename", "mime_type", "length", "digest"])
    return out.select("req_id", "req_docid", "req_xpath", "xpath", "filename", "mime_type",
                      "length", "digest", "route", "error")


@query("src_blobs", oracle="""
select doc_id, xpath, filename, mime_type, length, digest from v_blobs""")
def src_blobs(spark, sf):
    b = repo.blobs(tables(spark, sf))
    return b.select("doc_id", "xpath", "filename", "mime_type",
                    F.octet_length("content").cast("long").alias("length"), "digest")


@query("src_blob_files", oracle="""
select doc_id, length, digest from v_blobs""")
def src_blob_files(spark, sf):
    """Blobs written as files of their own and read back as such."""
    folder = shared_dir(spark, "blob-files")
    written = materialize(write_blob_files(repo.blobs(tables(spark, sf)), folder))
    back = read_blob_files(spark, folder, written=written)
    return back.select(F.col("key").alias("doc_id"), "length", F.md5("content").alias("digest"))


@query("blob_ref_resolve", oracle="""
with r as (select 'cv' || cast(conv_id as varchar) doc_id, 'b' || cast(conv_id as varchar) upload_batch,
                  cast(turn + 1 as varchar) upload_file_id from conversations)
select r.*, u.filename, u.length, case when u.batch is null then 'failure' else 'success' end route,
       case when u.batch is null then 'blob not found' end error
from r left join v_uploads u on u.batch = upload_batch and u.idx = upload_file_id""")
def blob_ref_resolve(spark, sf):
    t = tables(spark, sf)
    # every turn refers to the next one's upload: the last of a conversation to nothing
    refs = t.conversations.select(
        F.concat(F.lit("cv"), F.col("conv_id").cast("string")).alias("doc_id"),
        F.concat(F.lit("b"), F.col("conv_id").cast("string")).alias("upload_batch"),
        (F.col("turn") + 1).cast("string").alias("upload_file_id"))
    uploads = repo.uploads(t).withColumn("length", F.octet_length("content").cast("long"))
    return relations.resolve_blob_refs(refs, uploads)


@query("batch_guard", oracle="""
select batch, idx, case when role = 'system' then '' else batch end attach_batch,
       case when role = 'system' then 'failure' end route,
       case when role = 'system' then 'No upload batch' end error
from (select 'b' || cast(conv_id as varchar) batch, cast(turn as varchar) idx, role from conversations)""")
def batch_guard(spark, sf):
    cv = tables(spark, sf).conversations.select("conv_id", "turn", "role")
    batch = F.concat(F.lit("b"), F.col("conv_id").cast("string"))
    reqs = cv.select(batch.alias("batch"), F.col("turn").cast("string").alias("idx"),
                     F.when(F.col("role") == "system", F.lit("")).otherwise(batch).alias("attach_batch"))
    return relations.batch_guard(reqs, "attach_batch", "idx")


def _note_records(t):
    """Notes as records whose content is their entity JSON, except German
    notes, whose content is the raw note text (not a JSON document)."""
    n = repo.notes(t).withColumn("state", F.lit("project"))
    js = ej.entity_json(n)
    content = F.when(F.col("lang") == "de", F.col("note")).otherwise(js)
    return n.select(F.col("id").alias("rec_id"), "lang", F.encode(content, "UTF-8").alias("content"))


@query("src_entity_json", oracle="""
select id rec_id, case when lang = 'de' then null else id end id,
       case when lang = 'de' then null else path end path,
       case when lang = 'de' then null else type end type,
       case when lang = 'de' then null else title end title
from v_notes""")
def src_entity_json(spark, sf):
    r = _note_records(tables(spark, sf))
    d = ej.parse_document(F.col("content"))
    return r.select("rec_id", d["id"].alias("id"), d["path"].alias("path"),
                    d["type"].alias("type"), d["title"].alias("title"))


@query("sink_entity_json", oracle="""
select json_object('entity-type', 'document', 'uid', id, 'path', path, 'type', type,
                   'title', title, 'state', state, 'parentRef', parent_id)::varchar value
from v_docs where id <> 'root'""")
def sink_entity_json(spark, sf):
    d = repo.docs(tables(spark, sf)).where(F.col("id") != "root")
    out = shared_dir(spark, "entity-json")
    ej.write_json_lines(d, ej.entity_json(d), out)
    return spark.read.text(out)


def _entity_records(t):
    """Records whose ``nx-entity`` attribute and JSON agree (view), disagree
    (click: a document said to be a workflow; signup: no entity-type at all), or
    whose content is no JSON object (error, purchase)."""
    ev = t.events.select("event_id", "event_type", "user_id")
    uid = F.concat(F.lit("c"), F.col("user_id").cast("string"))
    kind, document = F.col("event_type"), F.to_json(F.struct(F.lit("document").alias("entity-type"), uid.alias("uid")))
    content = (F.when(kind.isin("view", "click"), document)
                .when(kind == "signup", F.to_json(F.struct(uid.alias("uid"))))
                .when(kind == "error", F.lit("not json")).otherwise(F.lit("[1]")))
    attribute = F.when(kind == "click", "workflow").otherwise("document")
    return ev.select(F.col("event_id").alias("req_id"), F.encode(content, "UTF-8").alias("content"),
                     F.create_map(F.lit(args.ATTR_ENTITY), attribute).alias("attributes"))


@query("entity_guard", oracle="""
select event_id req_id, event_type in ('view', 'signup') inline_used from events""")
def entity_guard(spark, sf):
    r = _entity_records(tables(spark, sf))
    entity = F.col("attributes")[args.ATTR_ENTITY]
    return r.select("req_id", ej.parse_document(F.col("content"), entity=entity).isNotNull().alias("inline_used"))


@query("inline_or_lookup", oracle=f"""
with {RESOLVED_REQUESTS}
select r_res.req_id, req_docid, req_path,
       case when e.event_type = 'view' then 'c' || cast(e.user_id as varchar) else r_res.doc_id end doc_id,
       case when e.event_type = 'view' then 'Inline ' || cast(e.user_id as varchar) else r_res.doc_title end doc_title,
       case when e.event_type = 'view' or r_res.doc_id is not null then 'success' else 'failure' end route,
       case when e.event_type <> 'view' and r_res.doc_id is null then {ERROR_OF_MISS} end error,
       case when e.event_type = 'view' then 'inline' else 'lookup' end source
from r_res join events e on e.event_id = r_res.req_id""")
def inline_or_lookup(spark, sf):
    t = tables(spark, sf)
    ev = t.events.select(F.col("event_id").alias("req_id"), "event_type", "user_id")
    uid = F.col("user_id").cast("string")
    # every record holds a document; the attribute says which of them are used
    content = F.to_json(F.struct(F.concat(F.lit("c"), uid).alias("uid"), F.concat(F.lit("Inline "), uid).alias("title")))
    entity = F.when(F.col("event_type") == "view", "document").otherwise("workflow")
    records = (repo.requests(t).join(ev, "req_id")
                   .select("req_id", "req_docid", "req_path",
                           ej.parse_document(F.encode(content, "UTF-8"),
                                             {"id": "uid", "title": "title"}, entity).alias("inline")))
    return lookup.inline_or_lookup(records, repo.docs(t), "inline", doc_cols=["id", "title"])
