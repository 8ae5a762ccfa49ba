"""Queries: sources, lookups, children, routing."""

from __future__ import annotations

from pyspark.sql import functions as F

from contentlake.operators import lookup, relations, routing
from contentlake.operators.attributes import entity_stamp as stamp
from contentlake.plans.registry import query
from contentlake.plans.sql_snippets import ERROR_OF_MISS, RESOLVED_REQUESTS
from contentlake.sources import repository as repo
from contentlake.sources import entity_json as ej
from contentlake.sources.tables import tables

DOC_OUT = ["id", "path", "type", "title"]


@query("src_repo_docs", oracle="select * from v_docs")
def src_repo_docs(spark, sf):
    return repo.docs(tables(spark, sf))


@query("src_requests", oracle="""
select req_id, req_docid, req_path,
       case when coalesce(trim(req_docid), '') <> '' then 'id'
            when coalesce(trim(req_path), '') <> '' then 'path' else 'none' end ref_kind
from v_requests""")
def src_requests(spark, sf):
    kind, _ = lookup.reference("req_docid", "req_path")
    return repo.requests(tables(spark, sf)).withColumn("ref_kind", kind)


def _resolved(spark, sf, original=False):
    t = tables(spark, sf)
    return lookup.get_document(repo.requests(t), repo.docs(t), doc_cols=DOC_OUT, original=original)


@query("get_document", oracle=f"""
with {RESOLVED_REQUESTS}
select req_id, req_docid, req_path, doc_id, doc_path, doc_type, doc_title,
       case when doc_id is null then 'failure' else 'success' end route,
       case when doc_id is null then {ERROR_OF_MISS} end error
from r_res""")
def get_document(spark, sf):
    return _resolved(spark, sf)


@query("get_document_not_found", oracle=f"""
with {RESOLVED_REQUESTS}
select req_id, req_docid, req_path, 'failure' route, {ERROR_OF_MISS} error
from r_res where doc_id is null""")
def get_document_not_found(spark, sf):
    t = tables(spark, sf)
    return lookup.get_document_not_found(repo.requests(t), repo.docs(t))


@query("get_children", oracle=f"""
with {RESOLVED_REQUESTS}
select req_id, req_docid, req_path, r_res.doc_id parent_id, c.id child_id, c.path child_path,
       c.type child_type, c.title child_title, 'success' route, cast(null as varchar) error
from r_res join v_docs c on c.parent_id = r_res.doc_id
union all
select req_id, req_docid, req_path, null, null, null, null, null, 'failure', {ERROR_OF_MISS}
from r_res where doc_id is null""")
def get_children(spark, sf):
    t = tables(spark, sf)
    return lookup.get_children(repo.requests(t), repo.docs(t))


@query("entity_stamp", oracle=f"""
with {RESOLVED_REQUESTS}
select req_id, doc_id, doc_path, case when doc_id is not null then 'document' end entity, doc_id docid from r_res""")
def entity_stamp(spark, sf):
    """The output of every lookup with its entity and id; failures have neither.
    (``entity_stamp_documents`` stamps the documents themselves.)"""
    return stamp(_resolved(spark, sf), "doc_id").select("req_id", "doc_id", "doc_path", "entity", "docid")


@query("entity_stamp_documents", oracle="""
select id, path, type, 'document' entity, id docid from v_docs""")
def entity_stamp_documents(spark, sf):
    """Every document (root, folders, files) with its entity and id."""
    return stamp(repo.docs(tables(spark, sf))).select("id", "path", "type", "entity", "docid")


@query("route_outputs", oracle=f"""
with {RESOLVED_REQUESTS}
select req_id, case when doc_id is null then 'failure' else 'success' end route,
       case when doc_id is null then {ERROR_OF_MISS} end error
from r_res
union all
select req_id, 'original', null from v_requests""")
def route_outputs(spark, sf):
    res = _resolved(spark, sf, original=True)
    return res.select("req_id", "route", "error")


@query("route_counts", oracle=f"""
with {RESOLVED_REQUESTS}
select route, count(*) n from (
  select case when doc_id is null then 'failure' else 'success' end route from r_res
  union all select 'original' from v_requests) group by route""")
def route_counts(spark, sf):
    return routing.route_counts(_resolved(spark, sf, original=True))


@query("emit_original", oracle="""
select req_id, req_docid, req_path, 'original' route from v_requests""")
def emit_original(spark, sf):
    res = _resolved(spark, sf, original=True)
    return res.where(F.col("route") == routing.ORIGINAL).select("req_id", "req_docid", "req_path", "route")


@query("get_document_json", oracle=f"""
with {RESOLVED_REQUESTS}
select req_id, case when doc_id is null then 'failure' else 'success' end route,
       case when doc_id is not null then 'document' end entity, doc_id docid,
       case when doc_id is not null then
         json_object('entity-type', 'document', 'uid', doc_id, 'path', doc_path,
                     'type', doc_type, 'title', doc_title)::varchar end content
from r_res""")
def get_document_json(spark, sf):
    """The reference's output record: ``nx-entity``, ``nx-docid`` attributes
    and the document entity as JSON content (failures carry no content)."""
    res = _resolved(spark, sf)
    ok = F.col("route") == routing.SUCCESS
    return res.select("req_id", "route",
                      F.when(ok, F.lit("document")).alias("entity"),
                      F.col("doc_id").alias("docid"),
                      F.when(ok, ej.prefixed_entity_json("doc_")).alias("content"))


def _two_repos(df, changed=None):
    """Two repositories with the same ids and paths; ``changed`` columns differ in the second."""
    return df.withColumn("repo", F.lit("default")).unionByName(df.withColumns({**(changed or {}), "repo": F.lit("archive")}))


def _repo_requests(t):
    return repo.requests(t).withColumn("req_repo", F.when(F.col("req_id") % 3 == 0, "archive").when(F.col("req_id") % 3 == 1, "")
                                       .when(F.col("req_id") % 15 == 2, "nowhere"))


_REQ_REPO = "case when req_id % 3 = 0 then 'archive' when req_id % 3 = 1 then '' when req_id % 15 = 2 then 'nowhere' end"


@query("get_children_multi_repo", oracle=f"""
with {RESOLVED_REQUESTS}, q as (select *, {_REQ_REPO} req_repo from r_res)
select req_id, req_docid, req_path, req_repo, q.doc_id parent_id, c.id child_id,
       case when req_repo = 'archive' then 'Old ' || c.title else c.title end child_title,
       'success' route, cast(null as varchar) error
from q join v_docs c on c.parent_id = q.doc_id where coalesce(req_repo, '') <> 'nowhere'
union all
select req_id, req_docid, req_path, req_repo, null, null, null, 'failure', {ERROR_OF_MISS}
from q where doc_id is null or req_repo = 'nowhere'""")
def get_children_multi_repo(spark, sf):
    t = tables(spark, sf)
    docs = _two_repos(repo.docs(t).select("id", "path", "parent_id", "title"), {"title": F.concat(F.lit("Old "), "title")})
    return lookup.get_children(_repo_requests(t), docs, child_cols=["id", "title"], repo_col="req_repo")


@query("get_workflows_multi_repo", oracle=f"""
with {RESOLVED_REQUESTS}, q as (select *, {_REQ_REPO} req_repo from r_res)
select req_id, req_docid, req_path, req_repo, q.doc_id, workflow_id,
       case when req_repo = 'archive' then 'done' else w.state end state, 'success' route, cast(null as varchar) error
from q join v_workflows w on w.doc_id = q.doc_id where coalesce(req_repo, '') <> 'nowhere'
union all
select req_id, req_docid, req_path, req_repo, null, null, null, 'failure', {ERROR_OF_MISS}
from q where doc_id is null or req_repo = 'nowhere'""")
def get_workflows_multi_repo(spark, sf):
    t = tables(spark, sf)
    return relations.get_related(_repo_requests(t), _two_repos(repo.docs(t).select("id", "path")),
                                 _two_repos(repo.workflows(t), {"state": F.lit("done")}), ["workflow_id", "state"], repo_col="req_repo")


@query("get_blob_multi_repo", oracle="""
with r as (select page_id req_id, 'p' || cast(page_id as varchar) req_docid, case when page_id % 2 = 0 then 'archive' end req_repo from pages)
select req_id, req_docid, req_repo, 'file:content' xpath, case when req_repo = 'archive' then 'old_' || filename else filename end filename, digest,
       'success' route, cast(null as varchar) error
from r join v_blobs b on b.doc_id = r.req_docid""")
def get_blob_multi_repo(spark, sf):
    t = tables(spark, sf)
    page = F.col("page_id")
    reqs = t.pages.select(page.alias("req_id"), F.concat(F.lit("p"), page.cast("string")).alias("req_docid"),
                          F.when(page % 2 == 0, F.lit("archive")).alias("req_repo"))
    blobs = _two_repos(repo.blobs(t), {"filename": F.concat(F.lit("old_"), "filename")})
    return relations.get_blob(reqs, blobs, xpath_col=None, original=False, blob_cols=["filename", "digest"], repo_col="req_repo")


@query("get_document_schemas", oracle=f"""
with {RESOLVED_REQUESTS}
select req_id, r_res.doc_id, prop key from r_res join v_props p on p.doc_id = r_res.doc_id where split_part(prop, ':', 1) = 'cust'""")
def get_document_schemas(spark, sf):
    """The looked-up documents' properties of one schema."""
    t = tables(spark, sf)
    found = lookup.get_document(repo.requests(t), repo.docs_with_properties(t), doc_cols=["id", "properties"], schemas=["cust"])
    return found.select("req_id", "doc_id", F.explode(F.map_keys("doc_properties")).alias("key"))


@query("get_children_schemas", oracle=f"""
with {RESOLVED_REQUESTS}
select req_id, c.id child_id, prop key from r_res join v_docs c on c.parent_id = r_res.doc_id join v_props p on p.doc_id = c.id
where split_part(prop, ':', 1) in ('ord', 'cust')""")
def get_children_schemas(spark, sf):
    t = tables(spark, sf)
    kids = lookup.get_children(repo.requests(t), repo.docs_with_properties(t), child_cols=["id", "properties"], schemas=["ord", "cust"])
    return kids.select("req_id", "child_id", F.explode(F.map_keys("child_properties")).alias("key"))


@query("get_document_shuffle", same_oracle_as="get_document")
def get_document_shuffle(spark, sf):
    """The lookup as planned for a request side that isn't small."""
    t = tables(spark, sf)
    return lookup.get_document(repo.requests(t), repo.docs(t), doc_cols=DOC_OUT, small=False)


@query("get_document_multi_repo", oracle=f"""
with {RESOLVED_REQUESTS}
select req_id, req_docid, req_path, case when req_id % 3 = 0 then 'archive' when req_id % 3 = 1 then '' end req_repo,
       doc_id, case when req_id % 3 = 0 then 'Old ' || doc_title else doc_title end doc_title,
       case when doc_id is null then null when req_id % 3 = 0 then 'archive' else 'default' end doc_repo,
       case when doc_id is null then 'failure' else 'success' end route,
       case when doc_id is null then {ERROR_OF_MISS} end error
from r_res""")
def get_document_multi_repo(spark, sf):
    """Two repositories with the same ids and paths: one answer per request."""
    t = tables(spark, sf)
    docs = repo.docs(t).select("id", "path", "title", F.lit("default").alias("repo"))
    both = docs.unionByName(docs.withColumns({"title": F.concat(F.lit("Old "), "title"), "repo": F.lit("archive")}))
    reqs = repo.requests(t).withColumn("req_repo", F.when(F.col("req_id") % 3 == 0, "archive").when(F.col("req_id") % 3 == 1, ""))
    return lookup.get_document(reqs, both, doc_cols=["id", "title", "repo"], repo_col="req_repo")
