"""Queries: streaming twins of lookup, routing, upsert and the timer query.

Each runs a Structured Streaming query over the driver table read as a
file stream (``Trigger.AvailableNow``), writes through ``foreachBatch`` into
the shared folder, and returns the sink read back as a batch DataFrame, so
it is compared with the same oracle as its batch twin.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from contentlake.operators import query as q
from contentlake.operators.changes import CHANGE
from contentlake.operators.lookup import get_document
from contentlake.plans import catalog_lookup, catalog_mutate, catalog_query  # noqa: F401
from contentlake.plans.registry import query
from contentlake.session import materialize, shared_dir
from contentlake.sources import repository as repo
from contentlake.sources.tables import tables
from contentlake.sources.versioned import versioned_table
from contentlake.streaming import streams


def _request_stream(spark, t):
    """v_requests as a stream: the events file stream joined (stream-static)
    with the customer folders."""
    ev = streams.read_stream(spark, t.path("events")).select("event_id", "event_type", "user_id")
    cf = repo.customer_folders(t).select("c_custkey", "cust_path")
    et = F.col("event_type")
    cid = F.concat(F.lit("c"), F.col("user_id").cast("string"))
    return (ev.join(cf, ev.user_id == cf.c_custkey)
              .select(F.col("event_id").alias("req_id"),
                      F.when(et.isin("view", "purchase"), cid)
                       .when(et == "error", F.concat(F.lit("missing-"), F.col("event_id").cast("string")))
                       .alias("req_docid"),
                      F.when(et == "click", F.col("cust_path"))
                       .when(et == "purchase", F.lit("/")).alias("req_path")))


@query("stream_lookup", same_oracle_as="get_document")
def stream_lookup(spark, sf):
    t = tables(spark, sf)
    sink = streams.stream_lookup(spark, _request_stream(spark, t), repo.docs(t),
                                 doc_cols=catalog_lookup.DOC_OUT)
    return spark.read.parquet(sink).drop("batch")


@query("stream_route", same_oracle_as="route_outputs")
def stream_route(spark, sf):
    t = tables(spark, sf)
    docs = repo.docs(t)

    def lookup(batch):
        return get_document(batch, docs, doc_cols=["id"], original=True).select("req_id", "route", "error")

    sink = streams.stream_route(spark, _request_stream(spark, t), lookup)
    return spark.read.parquet(sink).select("req_id", "route", "error")


@query("stream_upsert", same_oracle_as="update_document")
def stream_upsert(spark, sf):
    """Label updates as change sets of a versioned table, merged when it is read."""
    t = tables(spark, sf)
    docs, _ = catalog_mutate._with_notes(t)
    table = versioned_table(spark)
    table.create(docs)
    labels = streams.read_stream(spark, t.path("labels")).select("doc_id", "quality", "toxic")
    values = F.array(F.struct(F.lit("lbl:quality").alias("prop"), F.col("quality").cast("string").alias("val")),
                     F.struct(F.lit("lbl:toxic").alias("prop"), F.col("toxic").cast("string").alias("val")))
    changes = labels.select(F.col("doc_id").alias("seq"), F.lit("update").alias("kind"),
                            F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("doc_id"),
                            F.explode(values).alias("u")).select("seq", "kind", "doc_id", "u.prop", "u.val")
    streams.stream_changes(spark, changes, table)
    return table.read().select(F.col("id").alias("doc_id"), F.explode("properties").alias("key", "v")) \
        .select("doc_id", "key", F.col("v").cast("string").alias("value"))


def _change_log(t):
    """Changes of all four kinds in four batches: a folder per source; the notes below
    them (German ones name a missing folder) with the quality in the same batch; toxic
    notes to the trash and poor ones away; and those that are both are made again,
    updated and, in the same batch, every third of them made twice."""
    n = repo.notes(t).select(F.col("id").alias("doc_id"), "parent_path", "lang", F.regexp_extract("path", "[^/]+$", 0).alias("name"), "title")
    lb = t.labels.select(F.col("doc_id").alias("k"), F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("doc_id"), "quality", "toxic")
    number = F.substring("doc_id", 2, 20).cast("bigint") * 10
    row = lambda df, batch, seq, kind, **cols: df.select(
        F.lit(batch).alias("b"), seq.alias("seq"), F.lit(kind).alias("kind"),
        *[cols.get(c, F.lit(None)).cast(CHANGE[c]).alias(c) for c in CHANGE if c not in ("seq", "kind")])
    folders = n.select("parent_path").distinct()
    parent = F.when(F.col("lang") == "de", F.concat("parent_path", F.lit("_de"))).otherwise(F.col("parent_path"))
    doc = {"doc_id": F.col("doc_id")}
    both = lb.where("quality = 0 and toxic = 1").join(n, "doc_id")
    again = {**doc, "parent_path": parent, "name": F.col("name"), "type": F.lit("Note"), "title": F.concat(F.lit("Again "), "name")}
    parts = [
        row(folders, 0, F.crc32(F.col("parent_path").cast("binary")), "create", parent_path=F.lit("/"), name=F.substring("parent_path", 2, 1000), type=F.lit("Folder")),
        row(n, 1, number, "create", **doc, parent_path=parent, name=F.col("name"), type=F.lit("Note"), title=F.col("title"),
            props=F.create_map(F.lit("note:lang"), F.col("lang"))),
        row(lb, 1, F.col("k") * 10 + 1, "update", **doc, prop=F.lit("lbl:quality"), val=F.col("quality")),
        row(lb.where("toxic = 1"), 2, F.col("k") * 10 + 2, "trash", **doc),
        row(lb.where("quality = 0"), 2, F.col("k") * 10 + 3, "delete", **doc),
        row(both, 3, F.col("k") * 10 + 4, "create", **again),
        row(both, 3, F.col("k") * 10 + 5, "update", **doc, prop=F.lit("note:again"), val=F.lit("true")),
        row(both.where("k % 3 = 0"), 3, F.col("k") * 10 + 6, "delete", **doc),
        row(both.where("k % 3 = 0"), 3, F.col("k") * 10 + 7, "create", **again),
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def _changed(spark, sf):
    """The table and the results folder after the batches of the change log, each read by a restart of the stream."""
    t = tables(spark, sf)
    log, source = materialize(_change_log(t)), shared_dir(spark, "change-log")
    table, results, checkpoint = versioned_table(spark), shared_dir(spark, "change-results"), shared_dir(spark, "change-ckpt")
    table.create(repo.docs_with_properties(t))
    for b in range(4):
        log.where(F.col("b") == b).drop("b").write.mode("append").parquet(source)
        streams.stream_changes(spark, streams.read_stream(spark, source), table, results, checkpoint, most=2)
    return table, results


# the notes that stand at the end, and what they hold
_STANDING = """
n as (select v_notes.*, l.quality, l.toxic, l.doc_id k from v_notes left join labels l on v_notes.id = 'd' || cast(l.doc_id as varchar)
      where lang <> 'de'),
made as (select *, coalesce(quality = 0, false) gone from n where not (coalesce(quality = 0, false) and coalesce(toxic = 0, true)))"""


@query("stream_changes", oracle=f"""
with {_STANDING}
select id, path, case when gone then 'Again note_' || substring(id, 2) else title end title,
       not gone and coalesce(toxic = 1, false) trashed,
       case when not gone then cast(quality as varchar) end quality, case when not gone then lang end lang,
       case when gone and k % 3 <> 0 then 'true' end again
from made
union all select 'd-' || substring(sha256('/' || source), 1, 24), '/' || source, source, false, null, null, null
          from (select distinct source from documents)
union all select id, path, title, false, null, null, null from v_docs""")
def stream_changes(spark, sf):
    """The whole table after creates, updates, trash and deletes in four micro-batches."""
    table, _ = _changed(spark, sf)
    prop = lambda k: F.try_element_at("properties", F.lit(k)).cast("string")
    return table.read().select("id", "path", "title", "trashed", prop("lbl:quality").alias("quality"), prop("note:lang").alias("lang"),
                               prop("note:again").alias("again"))


@query("stream_change_results", oracle="""
with n as (select id, lang from v_notes),
l as (select 'd' || cast(doc_id as varchar) id, doc_id k, quality, toxic from labels),
log as (
  select id, 'create' kind, cast(substring(id, 2) as bigint) * 10 seq, lang <> 'de' ok, 'parent not found' miss from n
  union all select l.id, 'update', k * 10 + 1, coalesce(lang <> 'de', false), 'document not found' from l left join n using (id)
  union all select l.id, 'trash', k * 10 + 2, coalesce(lang <> 'de', false), 'document not found' from l left join n using (id) where toxic = 1
  union all select l.id, 'delete', k * 10 + 3, coalesce(lang <> 'de', false), 'document not found' from l left join n using (id) where quality = 0
  union all select id, 'create', k * 10 + 4, lang <> 'de', 'parent not found' from l join n using (id) where quality = 0 and toxic = 1
  union all select id, 'update', k * 10 + 5, lang <> 'de', 'document not found' from l join n using (id) where quality = 0 and toxic = 1
  union all select id, 'delete', k * 10 + 6, lang <> 'de', 'document not found' from l join n using (id) where quality = 0 and toxic = 1 and k % 3 = 0
  union all select id, 'create', k * 10 + 7, lang <> 'de', 'parent not found' from l join n using (id) where quality = 0 and toxic = 1 and k % 3 = 0)
select seq, kind, id doc_id, case when ok then 'success' else 'failure' end route, case when not ok then miss end error from log
union all
select null, 'create', 'd-' || substring(sha256('/' || source), 1, 24), 'success', null from (select distinct source from documents)""")
def stream_change_results(spark, sf):
    """A result for every change, also of documents that other changes make or remove."""
    _, results = _changed(spark, sf)
    return spark.read.parquet(results).select(F.when(F.col("batch") > 0, F.col("seq")).alias("seq"), "kind", "doc_id", "route", "error")


@query("timer_query", same_oracle_as="query_page")
def timer_query(spark, sf):
    t = tables(spark, sf)

    def run(s):
        d = repo.docs(t).where(F.col("type") == "File").select("id", "title")
        return q.page(d, "title", "DESC", page_size=10, page_index=3)

    sink = streams.timer_query(spark, None, run, runs=2)
    return spark.read.parquet(sink).where(F.col("batch") == 1).drop("batch")
