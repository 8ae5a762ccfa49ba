"""Queries: path language, document flattening, value coercion, schemas."""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from contentlake.functions import args, paths
from contentlake.functions.values import json_or_string, variant_kind
from contentlake.operators import attributes
from contentlake.operators import relations
from contentlake.plans.registry import query
from contentlake.plans.sql_snippets import NUM_TEXT
from contentlake.session import materialize
from contentlake.sources import repository as repo
from contentlake.sources.tables import tables



@query("path_entity_field", oracle="""
select id doc_id, id p_id, name p_name, state p_state, 'false' p_locked,
       cast(null as varchar) p_invalid
from v_docs""")
def path_entity_field(spark, sf):
    d = repo.docs(tables(spark, sf), full=True)
    cols = d.columns
    return d.select(F.col("id").alias("doc_id"),
                    *[paths.evaluate(p, cols).alias(f"p_{p}")
                      for p in ("id", "name", "state", "locked", "invalid")])


@query("path_schema_property", oracle=f"""
with pv as (
  select doc_id,
         max(case when prop = 'dc:title' then val end) title,
         max(case when prop = 'cust:segment' then val end) segment,
         max(case when prop = 'cust:acctbal' then {NUM_TEXT.format(v='val')} end) acctbal,
         max(case when prop = 'ord:totalprice' then {NUM_TEXT.format(v='val')} end) totalprice
  from v_props group by doc_id)
select d.id doc_id, pv.title, pv.segment, pv.acctbal, pv.totalprice, cast(null as varchar) missing
from v_docs d left join pv on d.id = pv.doc_id""")
def path_schema_property(spark, sf):
    d = repo.docs_with_properties(tables(spark, sf))
    cols = d.columns
    m = {"title": "dc:title", "segment": "properties/cust:segment",
         "acctbal": "cust:acctbal", "totalprice": "ord:totalprice", "missing": "missing:value"}
    return d.select(F.col("id").alias("doc_id"),
                    *[paths.evaluate(p, cols).alias(a) for a, p in m.items()])


def _audit_docs(spark, sf):
    a = repo.audit(tables(spark, sf))
    return a.select("entry_id", "doc_id", F.create_map(
        F.lit("ev:props"), json_or_string(F.col("props")),
        F.lit("ev:type"), json_or_string(F.col("event_type"))).alias("properties"))


@query("path_nested_member", oracle="""
select entry_id, json_extract_string(props, '$.k') k, event_type ev_type,
       cast(null as varchar) nothing
from v_audit""")
def path_nested_member(spark, sf):
    a = _audit_docs(spark, sf)
    cols = a.columns
    return a.select("entry_id", paths.evaluate("ev:props/k", cols).alias("k"),
                    paths.evaluate("ev:type", cols).alias("ev_type"),
                    paths.evaluate("ev:props/k/deeper", cols).alias("nothing"))


def _embedding_docs(spark, sf):
    e = tables(spark, sf).embeddings.select("vec_id", "embedding")
    return e.select("vec_id", F.create_map(
        F.lit("emb:vector"), F.col("embedding").cast("variant")).alias("properties"))


@query("path_array_index", oracle="""
select vec_id, round(embedding[1]::double, 4) first_el, round(embedding[2]::double, 4) second_el,
       round(embedding[len(embedding) - 1]::double, 4) minus_one,
       cast(null as double) zero, cast(null as double) beyond
from embeddings""")
def path_array_index(spark, sf):
    e = _embedding_docs(spark, sf)
    cols = e.columns

    def num(p):
        c = paths.compile_path(p, cols)
        return F.round(F.try_variant_get(c.value, "$", "double"), 4)

    return e.select("vec_id", num("emb:vector/1").alias("first_el"), num("emb:vector/2").alias("second_el"),
                    num("emb:vector/-1").alias("minus_one"), num("emb:vector/0").alias("zero"),
                    num("emb:vector/65").alias("beyond"))


@query("path_array_predicate", oracle="""
select doc_id, pos, name value from v_files where length > 25000""")
def path_array_predicate(spark, sf):
    f = repo.files(tables(spark, sf)).select("doc_id", "pos", "name", "mime_type", "length")
    return attributes.element_path(f, "files:files/[length>25000]/name")


@query("path_match_collapse", oracle="""
with e as (select doc_id, pos, case when mime_type <> 'type/R' then name end v from v_files where length > 15000),
f as (select doc_id, min(pos) p from e where v is not null group by doc_id),
m as (select e.*, count(*) over (partition by doc_id) n from e join f using (doc_id) where pos >= p),
c as (select doc_id, n, (pos - 1) // 2 chunk, min(case when n = 1 then v end) one, count(*) n_values, to_json(list(v order by pos)) l
      from m group by doc_id, n, (pos - 1) // 2)
select d.id doc_id, case when n is null then 'null' when n = 1 then 'value' else 'list' end kind, coalesce(n, 0) n_matches,
       one single_value, case when n > 1 then chunk end chunk, case when n > 1 then n_values end n_values,
       cast(case when n > 1 then l end as varchar) list_value
from v_docs d left join c on d.id = c.doc_id""")
def path_match_collapse(spark, sf):
    """Names of the large elements of each document; those of returned items are null,
    so lists begin with nulls (dropped) and hold nulls (kept)."""
    t = tables(spark, sf)
    f = repo.files(t).select("doc_id", "pos", F.when(F.col("mime_type") != "type/R", F.col("name")).alias("name"), "length")
    matches = attributes.element_path(f, "files:files/[length>15000]/name")
    docs, lists = attributes.collapse_matches(repo.docs(t).select(F.col("id").alias("doc_id")), matches, chunk=2)
    return docs.join(lists, "doc_id", "left")


@query("path_vector_collapse", oracle="""
with m as (select vec_id, len(list_filter(embedding, lambda x: x::double > 0.2)) n,
                  list_filter(embedding, lambda x: x::double > 0.2) l from embeddings)
select vec_id, case when n = 0 then 'null' when n = 1 then 'value' else 'list' end kind,
       n n_matches, case when n = 1 then round(l[1]::double, 4) end single_value
from m""")
def path_vector_collapse(spark, sf):
    e = _embedding_docs(spark, sf)
    c = paths.compile_path("emb:vector/[.>0.2]", e.columns)
    arr = F.try_variant_get(c.value, "$", "array<variant>")
    n = F.when(c.value.isNull(), 0).when(arr.isNull(), 1).otherwise(F.size(arr))
    return e.select("vec_id",
                    F.when(n == 0, "null").when(n == 1, "value").otherwise("list").alias("kind"),
                    n.cast("long").alias("n_matches"),
                    F.when(n == 1, F.round(F.try_variant_get(c.value, "$", "double"), 4))
                     .alias("single_value"))


@query("doc_to_columns_all", oracle=f"""
select doc_id, prop key,
       case when prop in ('cust:acctbal', 'ord:totalprice') then {NUM_TEXT.format(v='val')} else val end value
from v_props""")
def doc_to_columns_all(spark, sf):
    return attributes.document_to_columns_all(repo.docs_with_properties(tables(spark, sf)))


@query("doc_to_columns_mapped", oracle=f"""
with pv as (
  select doc_id,
         max(case when prop = 'dc:title' then val end) title_prop,
         max(case when prop = 'ord:priority' then val end) priority,
         max(case when prop = 'ord:totalprice' then {NUM_TEXT.format(v='val')} end) total
  from v_props group by doc_id)
select d.id, pv.title_prop, pv.priority, pv.total, d.state doc_state,
       cast(null as varchar) nothing, 'success' route, cast(null as varchar) error
from v_docs d left join pv on d.id = pv.doc_id""")
def doc_to_columns_mapped(spark, sf):
    d = repo.docs_with_properties(tables(spark, sf))
    return attributes.document_to_columns(d, {
        "title_prop": "dc:title", "priority": "ord:priority", "total": "ord:totalprice",
        "doc_state": "state", "nothing": "missing:x"})


_MAPPED = {"title_prop": "dc:title", "priority": "ord:priority", "total": "ord:totalprice", "doc_state": "state", "nothing": "missing:x"}


@query("doc_to_columns_stamped", oracle="""
with pv as (
  select doc_id, max(case when prop = 'dc:title' then val end) title_prop, max(case when prop = 'ord:priority' then val end) priority
  from v_props group by doc_id),
n as (select count(*) documents, count(*) - count(title_prop) no_title, count(*) - count(priority) no_priority
      from v_docs d left join pv on d.id = pv.doc_id)
select d.id docid, 'document' entity, pv.title_prop, pv.priority, documents, no_title, no_priority, documents nothing
from v_docs d left join pv on d.id = pv.doc_id, n""")
def doc_to_columns_stamped(spark, sf):
    """Mapped attributes with entity and id, written once; how many documents lack
    each attribute comes from that same pass."""
    nulls = Observation("mapped")
    d = repo.docs_with_properties(tables(spark, sf))
    out = attributes.entity_stamp(attributes.document_to_columns(d, _MAPPED, nulls=nulls))
    out = materialize(out.select("docid", "entity", "title_prop", "priority"))
    counts = nulls.get
    return out.select("*", *[F.lit(counts[k]).cast("long").alias(v) for k, v in (
        ("documents", "documents"), ("title_prop", "no_title"), ("priority", "no_priority"), ("nothing", "nothing"))])


@query("value_json_or_string", oracle="""
with v as (
  select event_id, 'props' field, props x from events
  union all select event_id, 'value', cast(value as varchar) from events
  union all select event_id, 'event_type', event_type from events)
select event_id, field,
       case when not json_valid(x) then 'string'
            when json_type(x) = 'OBJECT' then 'object' when json_type(x) = 'ARRAY' then 'array'
            when json_type(x) = 'VARCHAR' then 'string' when json_type(x) = 'BOOLEAN' then 'boolean'
            when json_type(x) = 'NULL' then 'null' else 'number' end kind
from v""")
def value_json_or_string(spark, sf):
    ev = tables(spark, sf).events.select("event_id", "props", "value", "event_type")
    long = ev.select("event_id", F.explode(F.array(
        F.struct(F.lit("props").alias("field"), F.col("props").alias("x")),
        F.struct(F.lit("value").alias("field"), F.col("value").cast("string").alias("x")),
        F.struct(F.lit("event_type").alias("field"), F.col("event_type").alias("x")),
    )).alias("s")).select("event_id", "s.field", "s.x")
    return long.select("event_id", "field", variant_kind(json_or_string(F.col("x"))).alias("kind"))


@query("include_schemas", oracle="""
select doc_id, prop key from v_props where split_part(prop, ':', 1) in ('dc', 'ord')""")
def include_schemas(spark, sf):
    d = repo.docs_with_properties(tables(spark, sf), schemas=["dc", "ord"])
    return d.select(F.col("id").alias("doc_id"), F.explode(F.map_keys("properties")).alias("key"))


@query("doc_to_columns_templated", oracle=f"""
with pv as (
  select doc_id,
         max(case when prop = 'dc:title' then val end) title,
         max(case when prop = 'ord:priority' then val end) priority,
         max(case when prop = 'ord:totalprice' then {NUM_TEXT.format(v='val')} end) total
  from v_props group by doc_id)
select d.id, case d.state when 'project' then pv.title when 'review' then pv.priority
                          else pv.total end picked,
       'success' route, cast(null as varchar) error
from v_docs d left join pv on d.id = pv.doc_id
union all
select id || '/own', null, 'success', null from v_docs""")
def doc_to_columns_templated(spark, sf):
    """The path of each row comes from the record: a template over its
    attributes (here the attribute ``nx-prop`` chosen by document state)."""
    d = repo.docs_with_properties(tables(spark, sf))
    attrs = F.create_map(F.lit("nx-prop"), F.when(F.col("state") == "project", "dc:title")
                         .when(F.col("state") == "review", "ord:priority")
                         .otherwise("ord:totalprice"))
    picked = {"picked": args.template("${nx-prop}")}
    out = attributes.document_to_columns_templated(d.withColumn("attributes", attrs), picked)
    # a path text of its own for every document: as many texts as rows
    own = F.create_map(F.lit("nx-prop"), F.concat(F.lit("own:"), F.col("id"), F.lit("/2")))
    each = attributes.document_to_columns_templated(d.withColumn("attributes", own), picked)
    return out.unionByName(each.withColumn("id", F.concat("id", F.lit("/own"))))


@query("get_audit_json", oracle="""
with a as (select doc_id, entry_id, event_type,
                  row_number() over (partition by doc_id order by entry_id) pos from v_audit)
select doc_id, (pos - 1) // 50 chunk, count(*) n_entries,
       to_json(list(struct_pack(entry_id := entry_id, event_type := event_type) order by pos)) content
from a group by doc_id, (pos - 1) // 50""")
def get_audit_json(spark, sf):
    """Audit of each document as JSON, in chunks of at most 50 entries."""
    a = repo.audit(tables(spark, sf))
    return relations.related_json_chunks(a, "doc_id", ["entry_id"], ["entry_id", "event_type"],
                                         chunk_size=50)


@query("path_validate", oracle="""
select id, case when state = 'approved' then 'failure' else 'success' end route,
       state = 'approved' invalid_path
from v_docs""")
def path_validate(spark, sf):
    """Path texts are validated when compiled: a schema step below a value
    (``ord:totalprice/nested:x``) is rejected, and only the rows carrying
    that path fail; valid paths on the other rows still evaluate."""
    d = repo.docs_with_properties(tables(spark, sf))
    attrs = F.create_map(F.lit("nx-prop"), F.when(F.col("state") == "approved", "ord:totalprice/nested:x")
                         .otherwise("dc:title"))
    out = attributes.document_to_columns_templated(d.withColumn("attributes", attrs),
                                                   {"v": args.template("${nx-prop}")})
    return out.select("id", "route", F.col("error").isNotNull().alias("invalid_path"))
