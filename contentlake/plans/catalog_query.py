"""Queries: parameterised queries, sorting, paging, page providers, fan-out."""

from __future__ import annotations

import json

from pyspark.sql import Window
from pyspark.sql import functions as F

from contentlake.operators import operations, query as q
from contentlake.operators.routing import union_routes
from contentlake.plans.registry import query
from contentlake.sources import repository as repo
from contentlake.sources.tables import tables


def _docs_view(spark, sf, name="docs"):
    d = repo.docs(tables(spark, sf), full=True)
    d.createOrReplaceTempView(name)
    return d


@query("query_filter", oracle="""
select id, title, state from v_docs where type = 'File' and state = 'review'""")
def query_filter(spark, sf):
    _docs_view(spark, sf)
    return q.run_query(spark, "select id, title, state from docs where type = 'File' and state = 'review'")


@query("query_named_params", oracle="""
select id, title, parent_id from v_docs
where type = 'File' and state = 'approved' and parent_id like 'c1%'""")
def query_named_params(spark, sf):
    _docs_view(spark, sf)
    return q.run_query(
        spark, "select id, title, parent_id from docs where type = :type and state = :state "
               "and parent_id like :parent",
        {"type": "File", "state": "approved", "parent": "c1%"})


@query("query_sort", oracle="""
select id, title, pos from (
  select id, title, row_number() over (order by title desc, id) pos from v_docs where type = 'File')
where pos <= 1000""")
def query_sort(spark, sf):
    d = _docs_view(spark, sf).where(F.col("type") == "File").select("id", "title")
    return q.page(d, "title", "DESC", page_size=1000, page_index=0, max_results=1000)


@query("query_page", oracle="""
select id, title, pos from (
  select id, title, row_number() over (order by title desc, id) pos from v_docs where type = 'File')
where pos between 31 and 40""")
def query_page(spark, sf):
    d = _docs_view(spark, sf).where(F.col("type") == "File").select("id", "title")
    return q.page(d, "title", "DESC", page_size=10, page_index=3)


@query("query_max_results", oracle="""
select id, title, pos from (
  select id, title, row_number() over (order by title, id) pos from v_docs where type = 'File')
where pos between 21 and 25""")
def query_max_results(spark, sf):
    d = _docs_view(spark, sf).where(F.col("type") == "File").select("id", "title")
    return q.page(d, "title", "ASC", page_size=10, page_index=2, max_results=25)


@query("query_next_page", oracle="""
select state, 100 page_size, 15 page_index, count(*) max_results, 'next_page' route,
       'File' doc_type
from v_docs where type = 'File' group by state having 15 * 100 < count(*)""")
def query_next_page(spark, sf):
    d = _docs_view(spark, sf).where(F.col("type") == "File")
    return q.next_pages(d, ["state"], page_size=100, page_index=14, max_results=2000,
                        extra={"doc_type": F.lit("File")})


@query("query_all_pages", oracle="""
select id, pos, (pos - 1) // 10 page_index from (
  select id, row_number() over (order by title, id) pos from v_docs where type = 'File')""")
def query_all_pages(spark, sf):
    d = _docs_view(spark, sf).where(F.col("type") == "File").select("id", "title")
    return q.all_pages(d, "title", "ASC", page_size=10).select("id", "pos", "page_index")


@query("query_keyset_page", oracle="""
with o as (select id, title, nullif(state, 'review') state from v_docs where type = 'File' and state in ('review', 'approved')),
k as (select min(id) key from (select id from o where state = 'approved' order by id desc limit 50))
select id, title, state, pos from (
  select id, title, state, row_number() over (order by state desc nulls last, id) pos from o, k where state is null or id > key)
where pos <= 200""")
def query_keyset_page(spark, sf):
    """Two pages behind a key near the end of many ties, with the nulls that come after them."""
    d = _docs_view(spark, sf).where(F.col("type") == "File").where(F.col("state").isin("review", "approved")).select(
        "id", "title", F.nullif("state", F.lit("review")).alias("state"))
    key = d.where("state = 'approved'").orderBy(F.desc("id")).limit(50).agg(F.min("id")).first()[0]
    first, following = q.keyset_page(d, "state", "DESC", page_size=100, after=json.dumps({"state": "approved", "id": key}))
    second, _ = q.keyset_page(d, "state", "DESC", page_size=100, after=following.first()["after"])
    number = F.row_number().over(Window.orderBy(*q.sort_columns("state", "DESC"))).cast("long")   # of a page's rows
    return first.withColumn("pos", number).unionByName(second.withColumn("pos", number + 100))


q.register_provider(
    "docs_by_type_and_state",
    "select id, title, state, type from docs where type = ? and state = ?")


@query("page_provider", oracle="""
select id, title, state, type, pos from (
  select id, title, state, type, row_number() over (order by title, id) pos
  from v_docs where type = 'File' and state = 'review')
where pos between 11 and 20""")
def page_provider(spark, sf):
    _docs_view(spark, sf)
    return q.run_provider(spark, "docs_by_type_and_state", "File,review,,",
                          sort_by="title", sort_order="ASC", page_size=10, page_index=1)


@query("query_error_echo", oracle="""
with q as (select 'folders' query_name, 'select id from docs where type = ''Folder''' query
  union all select 'broken', 'select no_such_column from docs'
  union all select 'failing', 'select cast(title as int) id from docs')
select q.query_name, query, 'id' sort_by, f.id, f.pos, '5' page_size, '0' page_index, '1000' max_results,
       case when q.query_name = 'folders' then 'success' else 'failure' end route,
       q.query_name <> 'folders' has_error
from q left join (select id, row_number() over (order by id) pos from v_docs where type = 'Folder') f
  on q.query_name = 'folders' and f.pos <= 5
where q.query_name <> 'folders' or f.pos is not null""")
def query_error_echo(spark, sf):
    _docs_view(spark, sf)
    good = q.query_or_failure(spark, "folders", "select id from docs where type = 'Folder'",
                              page_size=5, sort_by="id")
    bad = q.query_or_failure(spark, "broken", "select no_such_column from docs",
                             page_size=5, sort_by="id")
    # this one analyses, and fails only when it runs
    failing = q.query_or_failure(spark, "failing", "select cast(title as int) id from docs",
                                 page_size=5, sort_by="id")
    out = union_routes(union_routes(good, bad), failing)
    return out.select("query_name", "query", "sort_by", "id", "pos", "page_size", "page_index",
                      "max_results", "route", F.col("error").isNotNull().alias("has_error"))


@query("paged_query", oracle="""
select id, pos, 'success' route, cast(null as varchar) req_id, '1000' max_results, '1' page_index from (
  select id, row_number() over (order by title, id) pos from v_docs where state = 'project' and type = 'File')
where pos between 11 and 20
union all
select null, null, 'next_page', null, cast(count(*) as varchar), '2' from v_docs
where state = 'project' and type = 'File' having count(*) > 20
union all
select null, null, 'original', 'r1', null, null""")
def paged_query(spark, sf):
    """The page of a provider, its next-page record and the request, from one call."""
    _docs_view(spark, sf)
    request = spark.range(1).select(F.lit("r1").alias("req_id"))
    out = q.paged_query(spark, "docs_by_type_and_state", args="File,project", original=request,
                        sort_by="title", page_size=10, page_index=1)
    return out.select("id", "pos", "route", "req_id", "max_results", "page_index")


def _pages(spark, sf):
    d = _docs_view(spark, sf).where(F.col("type") == "File").select("id", "title")
    return q.all_pages(d, "title", "ASC", page_size=10)


@query("unsplit_entries", oracle="""
with p as (select id, row_number() over (order by title, id) pos from v_docs where type = 'File')
select (pos - 1) // 10 page_index, count(*) n_entries, to_json(list(id order by pos)) entries
from p group by (pos - 1) // 10""")
def unsplit_entries(spark, sf):
    return operations.unsplit_entries(_pages(spark, sf), ["page_index"], "pos", ["id"]) \
        .select("page_index", "n_entries", F.to_json(
            F.transform("entries", lambda e: e["id"])).alias("entries"))


@query("split_entries", oracle="""
with p as (select id, row_number() over (order by title, id) pos from v_docs where type = 'File')
select (pos - 1) // 10 page_index, (pos - 1) % 10 + 1 entry_no, id from p""")
def split_entries(spark, sf):
    pages = operations.unsplit_entries(_pages(spark, sf), ["page_index"], "pos", ["id"])
    return operations.split_entries(pages, "entries", pos_col="entry_no") \
        .select("page_index", "entry_no", "id")
