"""SQL fragments shared by several oracle queries."""

# requests with their reference kind and value (id wins when non-blank)
RESOLVED_REQUESTS = """
r_ref as (
  select req_id, req_docid, req_path,
         case when coalesce(trim(req_docid), '') <> '' then 'id'
              when coalesce(trim(req_path), '') <> '' then 'path' else 'none' end rk,
         case when coalesce(trim(req_docid), '') <> '' then req_docid
              when coalesce(trim(req_path), '') <> '' then req_path end rf
  from v_requests),
r_res as (
  select r_ref.*, d.id doc_id, d.path doc_path, d.type doc_type, d.title doc_title,
         d.parent_id doc_parent_id, d.name doc_name, d.state doc_state
  from r_ref left join v_docs d
    on (r_ref.rk = 'id' and d.id = r_ref.rf) or (r_ref.rk = 'path' and d.path = r_ref.rf))
"""

ERROR_OF_MISS = ("case when rk = 'none' then 'no document reference' "
                 "else 'document not found' end")

# DuckDB twin of Spark's decimal rendering after JSON parsing: trailing
# zeros of the fraction are not kept ('1863.80' -> '1863.8', '12.00' -> '12')
NUM_TEXT = "case when {v} like '%.%' then rtrim(rtrim({v}, '0'), '.') else {v} end"
