"""Queries: argument resolution, templates, defaults, attribute merge."""

from __future__ import annotations

from pyspark.sql import functions as F

from contentlake.functions import args
from contentlake.operators import lookup
from contentlake.operators.routing import SUCCESS
from contentlake.plans.registry import query
from contentlake.sources import repository as repo
from contentlake.sources.tables import tables

# the attribute maps of request_records(), as a DuckDB relation
RECORDS_SQL = """
rec as (
  select e.event_id req_id, e.event_type,
         case when e.event_type in ('view', 'purchase') then 'c' || cast(e.user_id as varchar)
              when e.event_type = 'error' then 'missing-' || cast(e.event_id as varchar) end docid,
         case when e.event_type = 'click' then '/' || r_name || '/' || n_name || '/' || c_name
              when e.event_type = 'purchase' then '/' end path,
         case when e.event_type = 'view' then cast(cast(floor(e.value) as bigint) as varchar) end page_size
  from events e join customer on e.user_id = c_custkey join nation on c_nationkey = n_nationkey
       join region on n_regionkey = r_regionkey)"""


@query("arg_resolve", oracle=f"""
with {RECORDS_SQL}
select req_id, docid doc_ref, path doc_path, coalesce(page_size, '10') page_size,
       'Folder' doc_type
from rec""")
def arg_resolve(spark, sf):
    r = repo.request_records(tables(spark, sf))
    return r.select("req_id",
                    args.resolve(None, args.ATTR_DOCID).alias("doc_ref"),
                    args.resolve(None, args.ATTR_PATH).alias("doc_path"),
                    args.resolve(None, args.ATTR_PAGE_SIZE, args.DEFAULT_PAGE_SIZE).alias("page_size"),
                    args.resolve("Folder", args.ATTR_TYPE).alias("doc_type"))


@query("arg_template", oracle=f"""
with {RECORDS_SQL}
select req_id, coalesce(path, '') || '/child_' || event_type || '_' || coalesce(docid, '') rendered
from rec""")
def arg_template(spark, sf):
    r = repo.request_records(tables(spark, sf))
    return r.select("req_id", args.resolve("${nx-path}/child_${nx-type}_${ nx-docid }", None)
                    .alias("rendered"))


@query("arg_blank_check", oracle="""
select req_id, coalesce(trim(req_docid), '') = '' and coalesce(trim(req_path), '') = '' blank,
       case when coalesce(trim(req_docid), '') = '' and coalesce(trim(req_path), '') = ''
            then 'failure' end route
from v_requests""")
def arg_blank_check(spark, sf):
    r = repo.requests(tables(spark, sf))
    blank = args.is_blank(F.col("req_docid")) & args.is_blank(F.col("req_path"))
    return r.select("req_id", blank.alias("blank"), F.when(blank, F.lit("failure")).alias("route"))


@query("arg_defaults", oracle="""
select batch, case when idx = '0' then '0' else idx end idx, coalesce(filename, 'data-' || batch || '-' || idx) filename,
       coalesce(filename, batch || '-' || idx) blob_name, 'part ' || idx name,
       case when idx = '1' then 'Second' else 'part ' || idx end title,
       case when idx = '1' then 'files:files' else 'file:content' end xpath
from v_uploads""")
def arg_defaults(spark, sf):
    """Records with and without index, file names, title and xpath."""
    u = repo.uploads(tables(spark, sf))
    second = F.col("idx") == "1"
    records = u.select("batch", F.concat_ws("-", "batch", "idx").alias("rec_id"), F.nullif("idx", F.lit("0")).alias("idx"), "filename",
                       F.col("filename").alias("blob_name"), F.concat(F.lit("part "), "idx").alias("name"),
                       F.when(second, "Second").alias("title"), F.when(second, "files:files").alias("xpath"))
    return args.fill_defaults(records, F.col("rec_id")).drop("rec_id")


@query("attr_merge", oracle=f"""
with {RECORDS_SQL},
{{resolved}},
parent as (
  select req_id, 'nx-docid' k, docid v from rec where docid is not null
  union all select req_id, 'nx-path', path from rec where path is not null
  union all select req_id, 'nx-type', event_type from rec
  union all select req_id, 'nx-page-size', page_size from rec where page_size is not null),
new as (
  select req_id, 'nx-docid' k, doc_id v from r_res where doc_id is not null
  union all select req_id, 'nx-entity', 'document' from r_res where doc_id is not null)
select req_id, k key, v value from parent p
where not exists (select 1 from new n where n.req_id = p.req_id and n.k = p.k)
union all select req_id, k, v from new""".replace("{resolved}", __import__(
    "contentlake.plans.sql_snippets", fromlist=["x"]).RESOLVED_REQUESTS.strip()))
def attr_merge(spark, sf):
    t = tables(spark, sf)
    rec = repo.request_records(t).withColumns({
        "req_docid": args.resolve(None, args.ATTR_DOCID),
        "req_path": args.resolve(None, args.ATTR_PATH)})
    res = lookup.get_document(rec, repo.docs(t), doc_cols=["id"])
    new = F.when(F.col("route") == SUCCESS, args.attribute_map(
        nx_docid=F.col("doc_id"), nx_entity=F.lit("document"))).otherwise(
        F.create_map().cast("map<string,string>"))
    merged = res.select("req_id", args.merge_attributes(F.col("attributes"), new).alias("a"))
    return merged.select("req_id", F.explode("a").alias("key", "value"))


@query("params_split", oracle="""
with p as (
  select event_id req_id,
         event_type || ',' || cast(user_id as varchar) || ','
           || case when value > 50 then '' else cast(event_id as varchar) end || ',,' s
  from events),
parts as (select req_id, unnest(string_split(s, ',')) param,
                 unnest(generate_series(1, len(string_split(s, ',')))) pos from p),
last as (select req_id, max(pos) last_pos from parts where param <> '' group by req_id)
select parts.req_id, pos, param from parts join last on parts.req_id = last.req_id
where pos <= last_pos""")
def params_split(spark, sf):
    ev = tables(spark, sf).events.select("event_id", "event_type", "user_id", "value")
    s = F.concat(F.col("event_type"), F.lit(","), F.col("user_id").cast("string"), F.lit(","),
                 F.when(F.col("value") > 50, F.lit("")).otherwise(F.col("event_id").cast("string")),
                 F.lit(",,"))
    return (ev.select(F.col("event_id").alias("req_id"), args.split_params(s).alias("p"))
              .select("req_id", F.posexplode("p").alias("pos", "param"))
              .withColumn("pos", F.col("pos") + 1))
