"""Role views as SQL text for the DuckDB oracle (FIXTURES.md §3).

The Spark side builds the same views with the DataFrame API in
``contentlake.sources.repository``; the oracle queries in
``contentlake.plans.catalog`` are written against these CTEs.
"""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {
    "v_nation": """
select n_nationkey, n_name, r_regionkey, r_name, 'n' || cast(n_nationkey as varchar) nation_id,
       'r' || cast(r_regionkey as varchar) region_id, '/' || r_name || '/' || n_name nation_path
from nation join region on n_regionkey = r_regionkey""",
    "v_docs": """
select 'root' id, cast(null as varchar) parent_id, '/' path, '' name, 'Root' type, 'project' state, 'Root' title
union all
select 'r' || cast(r_regionkey as varchar), 'root', '/' || r_name, r_name, 'Folder', 'project', r_name from region
union all
select 'n' || cast(n_nationkey as varchar), 'r' || cast(r_regionkey as varchar), '/' || r_name || '/' || n_name, n_name,
       'Folder', 'project', n_name
from nation join region on n_regionkey = r_regionkey
union all
select 'c' || cast(c_custkey as varchar), 'n' || cast(n_nationkey as varchar),
       '/' || r_name || '/' || n_name || '/' || c_name, c_name, 'Folder', 'project', c_name
from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
union all
select 'o' || cast(o_orderkey as varchar), 'c' || cast(c_custkey as varchar),
       '/' || r_name || '/' || n_name || '/' || c_name || '/order_' || cast(o_orderkey as varchar),
       'order_' || cast(o_orderkey as varchar), 'File',
       case o_orderstatus when 'O' then 'project' when 'P' then 'review' else 'approved' end,
       'Order ' || cast(o_orderkey as varchar)
from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
     join region on n_regionkey = r_regionkey""",
    "v_props": """
select 'c' || cast(c_custkey as varchar) doc_id, 'dc:title' prop, c_name val from customer
union all
select 'c' || cast(c_custkey as varchar), 'cust:segment', c_mktsegment from customer
union all
select 'c' || cast(c_custkey as varchar), 'cust:acctbal', cast(cast(c_acctbal as decimal(18,2)) as varchar) from customer
union all
select 'o' || cast(o_orderkey as varchar), 'dc:title', 'Order ' || cast(o_orderkey as varchar) from orders
union all
select 'o' || cast(o_orderkey as varchar), 'dc:created', cast(cast(o_orderdate as date) as varchar) from orders
union all
select 'o' || cast(o_orderkey as varchar), 'ord:priority', o_orderpriority from orders
union all
select 'o' || cast(o_orderkey as varchar), 'ord:totalprice', cast(cast(o_totalprice as decimal(18,2)) as varchar) from orders""",
    "v_files": """
select 'o' || cast(l_orderkey as varchar) doc_id,
       row_number() over (partition by l_orderkey
         order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) pos,
       'part_' || cast(l_partkey as varchar) name, 'type/' || l_returnflag mime_type,
       cast(l_quantity as bigint) * 1000 length
from lineitem""",
    "v_notes": """
select 'd' || cast(doc_id as varchar) id, '/' || source parent_path,
       '/' || source || '/note_' || cast(doc_id as varchar) path, 'Note' type,
       'Note ' || cast(doc_id as varchar) title, lang, text note
from documents""",
    "v_updates": """
select 'd' || cast(doc_id as varchar) doc_id, 'lbl:quality' prop, cast(quality as varchar) val from labels
union all
select 'd' || cast(doc_id as varchar), 'lbl:toxic', cast(toxic as varchar) from labels""",
    "v_blobs": """
select 'p' || cast(page_id as varchar) doc_id, 'file:content' xpath,
       'page_' || cast(page_id as varchar) || '.html' filename, 'text/html' mime_type, md5(html) digest,
       html content, strlen(html) length
from pages""",
    "v_uploads": """
select 'b' || cast(conv_id as varchar) batch, cast(turn as varchar) idx,
       case when role = 'system' then null else role || '.txt' end filename, text content,
       strlen(text) length
from conversations""",
    "v_audit": """
select event_id entry_id, 'c' || cast(user_id as varchar) doc_id, event_type, ts, value, props from events""",
    "v_workflows": """
select 'w' || cast(event_id as varchar) workflow_id, 'c' || cast(user_id as varchar) doc_id, event_type name,
       'running' state, ts started_ts
from events where event_type in ('signup', 'purchase')""",
    "v_acl": """
select 'n' || cast(s_nationkey as varchar) doc_id, 'local' acl_name,
       row_number() over (partition by s_nationkey order by s_suppkey) pos,
       s_name principal, 'Read' permission, s_acctbal >= 0 granted
from supplier""",
    "v_requests": """
select event_id req_id,
       case event_type when 'view' then 'c' || cast(user_id as varchar)
                       when 'purchase' then 'c' || cast(user_id as varchar)
                       when 'error' then 'missing-' || cast(event_id as varchar) end req_docid,
       case event_type when 'click' then '/' || r_name || '/' || n_name || '/' || c_name
                       when 'purchase' then '/' end req_path
from events join customer on user_id = c_custkey join nation on c_nationkey = n_nationkey
     join region on n_regionkey = r_regionkey""",
}

_REF = re.compile(r"\bv_[a-z_]+\b")


def with_views(sql: str) -> str:
    """Prefix ``sql`` with the CTEs of every role view it mentions (in
    dependency order)."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in _REF.findall(text):
            if name in VIEWS and name not in needed:
                visit(VIEWS[name])
                needed.append(name)

    visit(sql)
    if not needed:
        return sql
    ctes = ",\n".join(f"{n} as ({VIEWS[n]}\n)" for n in needed)
    body = sql.strip()
    if body.lower().startswith("with "):
        return f"with {ctes},\n{body[5:]}"
    return f"with {ctes}\n{body}"
