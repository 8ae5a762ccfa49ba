"""Queries: create / update / trash / delete / attach, uploads, workflows, snapshots."""

from __future__ import annotations

from pyspark.sql import functions as F

from contentlake.operators import blobs, changes, mutate
from contentlake.plans.registry import query
from contentlake.plans.sql_snippets import ERROR_OF_MISS, NUM_TEXT, RESOLVED_REQUESTS
from contentlake.session import materialize, shared_dir
from contentlake.sources import entity_json as ej
from contentlake.sources import repository as repo
from contentlake.sources import snapshots
from contentlake.sources.tables import tables
from contentlake.sources.versioned import versioned_table

# fixed values: the workflow models the repository knows
WORKFLOW_MODELS = ["SerialDocumentReview", "ParallelDocumentReview"]


def _with_notes(t):
    """docs (with properties) after creating one folder per note source and
    the notes below them; German notes target a missing '<source>_de'
    folder and fail."""
    docs = repo.docs_with_properties(t)
    n = repo.notes(t)
    folders = n.select(F.col("parent_path").alias("req_id")).distinct().select(
        "req_id", F.lit("/").alias("parent_path"),
        F.substring(F.col("req_id"), 2, 1000).alias("name"), F.lit("Folder").alias("type"))
    docs, _ = mutate.create_documents(docs, folders, title=None)
    reqs = n.select(F.col("id").alias("req_id"),
                    F.when(F.col("lang") == "de", F.concat("parent_path", F.lit("_de")))
                     .otherwise(F.col("parent_path")).alias("parent_path"),
                    F.regexp_extract("path", "[^/]+$", 0).alias("name"), "type", "title",
                    F.col("id").alias("new_id"), "lang")
    return mutate.create_documents(docs, reqs, new_id="new_id", properties={"note:lang": F.col("lang")})


def _notes_table(t):
    """The table of :func:`_with_notes`, written once: for what reads it more than once."""
    return materialize(_with_notes(t)[0])


NOTES_RESULT_SQL = """
select id req_id, case when lang = 'de' then 'failure' else 'success' end route,
       case when lang = 'de' then 'parent not found' end error,
       case when lang = 'de' then null else id end doc_id,
       case when lang = 'de' then parent_path || '_de/note_' || substring(id, 2) else path end doc_path
from v_notes"""


@query("create_document", oracle=NOTES_RESULT_SQL)
def create_document(spark, sf):
    _, results = _with_notes(tables(spark, sf))
    return results


# ids of everything _with_notes holds: the base tree, a folder per source, the notes
_FOLDERS = """
folders as (select 'd-' || substring(sha256('/' || source), 1, 24) id, '/' || source path, source title
            from (select distinct source from documents))"""
_ALL_DOCS = f"""{_FOLDERS},
every as (select id, path from v_docs union all select id, path from folders
          union all select id, path from v_notes where lang <> 'de')"""


@query("update_document", oracle=f"""
with {_FOLDERS}
select id doc_id, 'dc:title' key, title value from v_notes where lang <> 'de'
union all select id, 'dc:title', title from folders
union all select id, 'note:lang', lang from v_notes where lang <> 'de'
union all select u.doc_id, u.prop, u.val from v_updates u join v_notes n on n.id = u.doc_id
  where n.lang <> 'de'
union all select doc_id, prop,
  case when prop in ('cust:acctbal', 'ord:totalprice') then {NUM_TEXT.format(v='val')} else val end
  from v_props""")
def update_document(spark, sf):
    t = tables(spark, sf)
    docs, _ = _with_notes(t)
    docs2, _ = mutate.update_documents(docs, repo.updates(t))
    return docs2.select(F.col("id").alias("doc_id"), F.explode("properties").alias("key", "v")) \
        .select("doc_id", "key", F.col("v").cast("string").alias("value"))


@query("update_results", oracle="""
select u.doc_id, u.prop, case when n.lang = 'de' then 'failure' else 'success' end route,
       case when n.lang = 'de' then 'document not found' end error
from v_updates u join v_notes n on n.id = u.doc_id""")
def update_results(spark, sf):
    t = tables(spark, sf)
    docs, _ = _with_notes(t)
    _, res = mutate.update_documents(docs, repo.updates(t))
    return res


def _inline_updates(t):
    """Label updates as records: a third hold their document inline, a third name
    it by path, the others by id. An inline document wins over what else is named."""
    n = repo.notes(t).select("id", "path", "lang")
    up = repo.updates(t).join(n, F.col("doc_id") == F.col("id"))
    third = F.pmod(F.substring("doc_id", 2, 20).cast("bigint"), F.lit(3))
    inline = ej.parse_document(F.encode(F.to_json(F.struct(F.lit("document").alias("entity-type"), F.col("doc_id").alias("uid"), "path")), "UTF-8"),
                               {"id": "uid", "path": "path"})
    return up.select("prop", "val", F.concat_ws("-", "doc_id", "prop").alias("req_id"),
                     F.when(third == 0, F.lit("someone-else")).when(third == 1, F.col("doc_id")).alias("doc_id"),
                     F.when(third == 2, F.col("path")).alias("doc_path"), F.when(third == 0, inline).alias("inline"))


@query("update_inline", oracle="""
select u.doc_id || '-' || u.prop req_id,
       case when n.lang = 'de' and cast(substring(u.doc_id, 2) as bigint) % 3 = 2 then null else u.doc_id end doc_id,
       case when n.lang = 'de' then 'failure' else 'success' end route,
       case when n.lang = 'de' then 'document not found' end error
from v_updates u join v_notes n on n.id = u.doc_id""")
def update_inline(spark, sf):
    t = tables(spark, sf)
    docs = _notes_table(t)
    _, res = mutate.update_documents(docs, _inline_updates(t), req_key="req_id", path_col="doc_path", inline_col="inline")
    return res.select("req_id", "doc_id", "route", "error")


@query("update_inline_documents", oracle=f"""
with {_FOLDERS}
select id doc_id, 'dc:title' key, title value from v_notes where lang <> 'de'
union all select id, 'dc:title', title from folders
union all select id, 'note:lang', lang from v_notes where lang <> 'de'
union all select u.doc_id, u.prop, u.val from v_updates u join v_notes n on n.id = u.doc_id
  where n.lang <> 'de'
union all select doc_id, prop,
  case when prop in ('cust:acctbal', 'ord:totalprice') then {NUM_TEXT.format(v='val')} else val end
  from v_props""")
def update_inline_documents(spark, sf):
    """The whole table after updates of inline, looked-up and directly named documents."""
    t = tables(spark, sf)
    docs = _notes_table(t)
    docs2, _ = mutate.update_documents(docs, _inline_updates(t), req_key="req_id", path_col="doc_path", inline_col="inline")
    return docs2.select(F.col("id").alias("doc_id"), F.explode("properties").alias("key", "v")) \
        .select("doc_id", "key", F.col("v").cast("string").alias("value"))


@query("attach_inline", oracle="""
with r as (select cast(conv_id as varchar) || '-' || cast(turn as varchar) req_id, 'c' || cast(conv_id as varchar) doc_id, role, turn from conversations)
select r.req_id, r.doc_id, case when role = 'system' or c.c_custkey is null then 'failure' else 'success' end route,
       case when role = 'system' then 'No upload batch' when c.c_custkey is null then 'document not found' end error
from r left join customer c on r.doc_id = 'c' || cast(c.c_custkey as varchar)""")
def attach_inline(spark, sf):
    """Attachments whose records carry their document, on every second turn."""
    t = tables(spark, sf)
    reqs = _attach_requests(t)
    carried = F.pmod(F.split("req_id", "-")[1].cast("int"), F.lit(2)) == 1
    reqs = reqs.withColumn("inline", F.when(carried & (F.col("batch") != " "), F.struct(F.col("req_docid").alias("id"))))
    reqs = reqs.withColumn("req_docid", F.when(F.col("inline").isNull(), F.col("req_docid")))
    _, res = mutate.attach_blobs(repo.docs_with_properties(t), reqs, inline_col="inline")
    return res.select("req_id", "doc_id", "route", "error")


def _label_requests(t, col, value):
    lb = t.labels.select("doc_id", col).where(F.col(col) == value)
    return lb.select(F.col("doc_id").alias("req_id"),
                     F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("req_docid"),
                     F.lit(None).cast("string").alias("req_path"))


@query("trash_document", oracle=f"""
with {_ALL_DOCS}
select n.id, coalesce(l.toxic = 1, false) trashed
from every n left join labels l on n.id = 'd' || cast(l.doc_id as varchar)""")
def trash_document(spark, sf):
    t = tables(spark, sf)
    docs = _notes_table(t)
    docs2, _ = mutate.trash_documents(docs, _label_requests(t, "toxic", 1))
    return docs2.select("id", "trashed")


@query("trash_results", oracle="""
select l.doc_id req_id, 'd' || cast(l.doc_id as varchar) req_docid, cast(null as varchar) req_path,
       case when n.lang = 'de' then null else n.id end doc_id,
       case when n.lang = 'de' then 'failure' else 'success' end route,
       case when n.lang = 'de' then 'document not found' end error,
       case when n.lang = 'de' then null else true end trashed
from labels l join v_notes n on n.id = 'd' || cast(l.doc_id as varchar) where l.toxic = 1""")
def trash_results(spark, sf):
    t = tables(spark, sf)
    docs = _notes_table(t)
    _, res = mutate.trash_documents(docs, _label_requests(t, "toxic", 1))
    return res


@query("delete_document", oracle=f"""
with {_ALL_DOCS}
select n.id from every n left join labels l on n.id = 'd' || cast(l.doc_id as varchar)
where coalesce(l.quality, 1) <> 0""")
def delete_document(spark, sf):
    t = tables(spark, sf)
    docs = _notes_table(t)
    docs2, _ = mutate.delete_documents(docs, _label_requests(t, "quality", 0))
    return docs2.select("id")


def _attach_requests(t):
    cv = t.conversations.select("conv_id", "turn", "role")
    batch = F.concat(F.lit("b"), F.col("conv_id").cast("string"))
    turn = F.col("turn").cast("string")
    return cv.select(F.concat(F.col("conv_id").cast("string"), F.lit("-"), turn).alias("req_id"),
                     F.concat(F.lit("c"), F.col("conv_id").cast("string")).alias("req_docid"),
                     F.when(F.col("turn") == 0, "file:content").otherwise(F.concat(F.lit("file:turn"), turn)).alias("xpath"),
                     F.when(F.col("role") == "system", F.lit(" ")).otherwise(batch).alias("batch"),
                     turn.alias("idx"))


@query("attach_blob", oracle="""
with r as (select cast(conv_id as varchar) || '-' || cast(turn as varchar) req_id,
                  'c' || cast(conv_id as varchar) doc_id, role, turn,
                  'b' || cast(conv_id as varchar) batch from conversations)
select r.req_id, r.doc_id,
       case when role = 'system' or c.c_custkey is null then 'failure' else 'success' end route,
       case when role = 'system' then 'No upload batch'
            when c.c_custkey is null then 'document not found' end error,
       case when role <> 'system' and c.c_custkey is not null then batch end upload_batch,
       case when role <> 'system' and c.c_custkey is not null then cast(turn as varchar) end upload_file_id
from r left join customer c on r.doc_id = 'c' || cast(c.c_custkey as varchar)""")
def attach_blob(spark, sf):
    t = tables(spark, sf)
    docs = repo.docs_with_properties(t)
    reqs = _attach_requests(t)
    docs2, res = mutate.attach_blobs(docs, reqs)
    held = docs2.select(F.col("id").alias("_id"), F.explode("properties").alias("_x", "v")).select(
        "_id", "_x", F.try_variant_get("v", '$["upload-batch"]', "string").alias("upload_batch"),
        F.try_variant_get("v", '$["upload-fileId"]', "string").alias("upload_file_id"))
    res = res.join(reqs.select("req_id", "xpath"), "req_id")
    out = res.join(held, (res["doc_id"] == held["_id"]) & (res["xpath"] == held["_x"]), "left").drop("_id", "_x")
    return out.select("req_id", "doc_id", "route", "error",
                      F.when(F.col("route") == "success", F.col("upload_batch")).alias("upload_batch"),
                      F.when(F.col("route") == "success", F.col("upload_file_id")).alias("upload_file_id"))


@query("create_with_blob", oracle="""
select 'conv_' || cast(conv_id as varchar) || '_' || cast(turn as varchar) name,
       '/conv_' || cast(conv_id as varchar) || '_' || cast(turn as varchar) path,
       case when role <> 'system' then 'b' || cast(conv_id as varchar) end upload_batch,
       case when role <> 'system' then cast(turn as varchar) end upload_file_id
from conversations
union all select name, path, null, null from v_docs""")
def create_with_blob(spark, sf):
    t = tables(spark, sf)
    cv = t.conversations.select("conv_id", "turn", "role")
    name = F.concat_ws("_", F.lit("conv"), F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    reqs = cv.select(name.alias("req_id"), F.lit("/").alias("parent_path"), name.alias("name"),
                     F.lit("File").alias("type"), F.lit("file:content").alias("xpath"),
                     F.concat(F.lit("b"), F.col("conv_id").cast("string")).alias("batch"),
                     F.when(F.col("role") != "system", F.col("turn").cast("string")).alias("idx"))
    docs2, _ = mutate.create_documents(repo.docs_with_properties(t), reqs, title=None,
                                       blob_ref={"xpath": "xpath", "batch": "batch", "index": "idx"})
    ref = F.try_element_at("properties", F.lit("file:content"))
    return docs2.select("name", "path",
                       F.try_variant_get(ref, '$["upload-batch"]', "string").alias("upload_batch"),
                       F.try_variant_get(ref, '$["upload-fileId"]', "string").alias("upload_file_id"))


def _upload_requests(t):
    cv = t.conversations.select("conv_id", "turn", "role", "text")
    return cv.select(
        F.concat(F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")).alias("req_id"),
        F.when(F.col("role") != "assistant", F.concat(F.lit("b"), F.col("conv_id").cast("string"))).alias("batch"),
        F.when(F.col("turn") > 0, F.col("turn").cast("string")).alias("idx"),
        F.when(F.col("role") != "system", F.concat("role", F.lit(".txt"))).alias("filename"),
        F.encode("text", "UTF-8").alias("content"))


UPLOAD_SQL = """
select cast(conv_id as varchar) || '-' || cast(turn as varchar) req_id,
       case when role <> 'assistant' then 'b' || cast(conv_id as varchar)
            else 'batch-' || md5(cast(conv_id as varchar) || '-' || cast(turn as varchar)) end batch,
       case when turn > 0 then cast(turn as varchar) else '0' end idx,
       case when role <> 'system' then role || '.txt'
            else 'data-' || cast(conv_id as varchar) || '-' || cast(turn as varchar) end filename,
       octet_length(encode(text)) length
from conversations"""


@query("upload_blob", oracle=f"""
with u as ({UPLOAD_SQL})
select req_id, batch, idx, filename, length, 'success' route from u
union all
select cast(conv_id as varchar) || '-' || cast(turn as varchar),
       case when role <> 'assistant' then 'b' || cast(conv_id as varchar) end,
       case when turn > 0 then cast(turn as varchar) end,
       case when role <> 'system' then role || '.txt' end, null, 'original'
from conversations""")
def upload_blob(spark, sf):
    _, res = blobs.upload_blobs(None, _upload_requests(tables(spark, sf)))
    return res.select("req_id", "batch", "idx", "filename", "length", "route")


@query("upload_chunked", oracle=f"""
with u as ({UPLOAD_SQL}),
c as (select batch, idx, length, unnest(generate_series(0, greatest(cast(ceil(length / 256.0) as bigint), 1) - 1)) chunk_no from u)
select c.batch, c.idx, chunk_no, least(256, c.length - chunk_no * 256) chunk_len,
       md5(array_slice(encode(text), chunk_no * 256 + 1, chunk_no * 256 + 256)) chunk_digest
from c join (select case when role <> 'assistant' then 'b' || cast(conv_id as varchar)
                         else 'batch-' || md5(cast(conv_id as varchar) || '-' || cast(turn as varchar)) end batch,
                    case when turn > 0 then cast(turn as varchar) else '0' end idx, text from conversations) v using (batch, idx)""")
def upload_chunked(spark, sf):
    uploads, _ = blobs.upload_blobs(None, _upload_requests(tables(spark, sf)), original=False)
    ch = blobs.chunk(uploads, 256)
    return ch.select("batch", "idx", "chunk_no", F.octet_length("chunk").cast("long").alias("chunk_len"), F.md5("chunk").alias("chunk_digest"))


@query("sink_blobs", oracle="""
select batch, idx, filename, length from v_uploads""")
def sink_blobs(spark, sf):
    u = repo.uploads(tables(spark, sf))
    out = shared_dir(spark, "uploads")
    snapshots.write_clustered(u, out, ["batch", "idx"])
    back = spark.read.parquet(out)
    return back.select("batch", "idx", "filename", F.octet_length("content").cast("long").alias("length"))


@query("sink_repo_snapshot", oracle=f"""
with {_ALL_DOCS}
select n.id, n.path, coalesce(l.toxic = 1, false) trashed, 'default' repo
from every n left join labels l on n.id = 'd' || cast(l.doc_id as varchar)""")
def sink_repo_snapshot(spark, sf):
    t = tables(spark, sf)
    docs, _ = _with_notes(t)
    table = versioned_table(spark)
    table.create(docs)
    trash = _label_requests(t, "toxic", 1).select(
        F.col("req_id").alias("seq"), F.lit(changes.TRASH).alias("kind"), F.col("req_docid").alias("doc_id"))
    delta, _ = changes.net_changes(table.read(), trash)
    table.commit(delta)
    table.compact()
    return table.read().select("id", "path", "trashed", "repo")


def _workflow_requests(t):
    ev = t.events.select("event_id", "event_type")
    return repo.requests(t).join(ev.withColumnRenamed("event_id", "req_id"), "req_id").select(
        "req_id", "req_docid", "req_path",
        F.when(F.col("event_type") == "click", F.lit("UnknownModel"))
         .otherwise(F.lit("SerialDocumentReview")).alias("workflow"))


@query("start_workflow", oracle=f"""
with {RESOLVED_REQUESTS}
select r_res.req_id, req_docid, req_path,
       case when e.event_type = 'click' then 'UnknownModel' else 'SerialDocumentReview' end workflow,
       r_res.doc_id,
       case when r_res.doc_id is null or e.event_type = 'click' then 'failure' else 'success' end route,
       case when r_res.doc_id is null then {ERROR_OF_MISS}
            when e.event_type = 'click' then 'workflow model not found' end error,
       case when r_res.doc_id is not null and e.event_type <> 'click'
            then 'wf-' || cast(r_res.req_id as varchar) end workflow_id
from r_res join events e on e.event_id = r_res.req_id""")
def start_workflow(spark, sf):
    t = tables(spark, sf)
    models = spark.createDataFrame([(m,) for m in WORKFLOW_MODELS], "name string")
    _, res = mutate.start_workflows(repo.docs(t), repo.workflows(t), _workflow_requests(t), models)
    return res


@query("cancel_workflow", oracle=f"""
with {RESOLVED_REQUESTS}, winner as (select doc_id, min(req_id) req_id from r_res where doc_id is not null group by doc_id)
select r.req_id, req_docid, req_path, 'signup' workflow, r.doc_id, w.workflow_id,
       'success' route, cast(null as varchar) error
from r_res r join winner x on r.req_id = x.req_id
join v_workflows w on w.doc_id = r.doc_id and w.name = 'signup'
union all
select req_id, req_docid, req_path, 'signup', null, null, 'failure', {ERROR_OF_MISS}
from r_res where doc_id is null""")
def cancel_workflow(spark, sf):
    t = tables(spark, sf)
    reqs = repo.requests(t).withColumn("workflow", F.lit("signup"))
    _, res = mutate.cancel_workflows(repo.docs(t), repo.workflows(t), reqs)
    return res


@query("workflow_table", oracle=f"""
with {RESOLVED_REQUESTS}, hit as (select distinct doc_id from r_res where doc_id is not null)
select workflow_id, w.doc_id, name, case when name = 'signup' and h.doc_id is not null then 'canceled' else state end state
from v_workflows w left join hit h on w.doc_id = h.doc_id
union all
select 'wf-' || cast(r.req_id as varchar), r.doc_id, 'SerialDocumentReview', 'running'
from r_res r join events e on e.event_id = r.req_id where r.doc_id is not null and e.event_type <> 'click'""")
def workflow_table(spark, sf):
    """The whole workflow table after starting and then cancelling."""
    t = tables(spark, sf)
    models = spark.createDataFrame([(m,) for m in WORKFLOW_MODELS], "name string")
    started, _ = mutate.start_workflows(repo.docs(t), repo.workflows(t), _workflow_requests(t), models)
    after, _ = mutate.cancel_workflows(repo.docs(t), started, repo.requests(t).withColumn("workflow", F.lit("signup")))
    return after.select("workflow_id", "doc_id", "name", "state")
