"""The repository as Spark tables, derived from the driver tables.

The driver tables play the repository's roles (see FIXTURES.md §3):

* ``docs``       folder tree root > region > nation > customer > order
* ``props``      document properties in long form (doc_id, prop, val)
* ``files``      elements of the array property ``files:files`` of an order
* ``notes``      note documents to create (from ``documents``)
* ``updates``    dynamic properties to set on notes (from ``labels``)
* ``blobs``      binaries of page documents (from ``pages``)
* ``uploads``    uploaded parts (from ``conversations``)
* ``audit``      audit entries on customer folders (from ``events``)
* ``workflows``  workflow instances (from ``events``)
* ``acl``        access entries on nation folders (from ``supplier``)
* ``requests``   lookup requests by id / path / both / neither (``events``)

Every builder selects only the columns it needs, so Catalyst prunes the
parquet scans. Small dimension tables (region, nation) are joined through
:meth:`Tables.at_most` (a checked row bound) and a broadcast hint; large-to-large joins
(orders-customer) are left to sort-merge with AQE skew splitting.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contentlake.functions.values import json_or_string
from contentlake.plans.numbering import position_within
from contentlake.sources.tables import Tables

REPO = "default"
# region (5 rows) and nation (25 rows) are fixed-size dimensions
DIM_ROW_BOUND = 10_000


def _s(c) -> F.Column:
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


def nation_folders(t: Tables) -> DataFrame:
    """One row per nation: keys, folder ids and folder path."""
    region = t.region.select("r_regionkey", "r_name")
    nation = t.nation.select("n_nationkey", "n_name", "n_regionkey")
    if t.at_most("region", DIM_ROW_BOUND):
        region = F.broadcast(region)
    return (nation.join(region, nation.n_regionkey == region.r_regionkey)
                  .select("n_nationkey", "n_name", "r_regionkey", "r_name",
                          F.concat(F.lit("n"), _s("n_nationkey")).alias("nation_id"),
                          F.concat(F.lit("r"), _s("r_regionkey")).alias("region_id"),
                          F.concat(F.lit("/"), "r_name", F.lit("/"), "n_name").alias("nation_path")))


def customer_folders(t: Tables, extra: list[str] | None = None) -> DataFrame:
    """One row per customer: key, folder id, name, parent nation id and
    folder path (plus ``extra`` customer columns)."""
    extra = extra or []
    cust = t.customer.select("c_custkey", "c_name", "c_nationkey", *extra)
    nf = nation_folders(t)
    # at most one row per nation (region key is unique): bounded with nation
    if t.at_most("nation", DIM_ROW_BOUND):
        nf = F.broadcast(nf)
    return (cust.join(nf, cust.c_nationkey == nf.n_nationkey)
                .select("c_custkey", "c_name", *extra,
                        F.concat(F.lit("c"), _s("c_custkey")).alias("cust_id"),
                        "nation_id",
                        F.concat("nation_path", F.lit("/"), "c_name").alias("cust_path")))


DOC_COLS = ["id", "parent_id", "path", "name", "type", "state", "title"]


def _dec_text(c: str) -> F.Column:
    return F.col(c).cast("decimal(18,2)").cast("string")


def _customer_props() -> list[tuple[str, F.Column]]:
    return [("dc:title", F.col("c_name")), ("cust:segment", F.col("c_mktsegment")),
            ("cust:acctbal", _dec_text("c_acctbal"))]


def _order_props() -> list[tuple[str, F.Column]]:
    okey = _s("o_orderkey")
    return [("dc:title", F.concat(F.lit("Order "), okey)),
            ("dc:created", F.to_date("o_orderdate").cast("string")),
            ("ord:priority", F.col("o_orderpriority")),
            ("ord:totalprice", _dec_text("o_totalprice"))]


def _prop_map(pairs: list[tuple[str, F.Column]], schemas: list[str] | None) -> F.Column:
    """Properties of one row as MAP<STRING, VARIANT> (JSON-or-string values),
    built in place: no explode, no grouping, no join."""
    keep = [(k, v) for k, v in pairs
            if not schemas or "*" in schemas or k.split(":", 1)[0] in schemas]
    if not keep:
        return F.create_map().cast("map<string,variant>")
    return F.map_from_entries(F.array(*[
        F.struct(F.lit(k).alias("key"), json_or_string(v).alias("value")) for k, v in keep]))


def docs(t: Tables, full: bool = False, properties: bool = False,
         schemas: list[str] | None = None) -> DataFrame:
    """The folder tree. ``full`` adds repo / locked / trashed / entity
    columns; ``properties`` adds ``properties MAP<STRING, VARIANT>`` (only
    the ``schemas`` listed, all when None or ``*``)."""
    spark = t.spark
    empty = F.create_map().cast("map<string,variant>")
    pcol = (lambda c: [c.alias("properties")]) if properties else (lambda c: [])
    root = spark.range(1).select(
        F.lit("root").alias("id"), F.lit(None).cast("string").alias("parent_id"),
        F.lit("/").alias("path"), F.lit("").alias("name"), F.lit("Root").alias("type"),
        F.lit("project").alias("state"), F.lit("Root").alias("title"), *pcol(empty))
    region = t.region.select(
        F.concat(F.lit("r"), _s("r_regionkey")).alias("id"), F.lit("root").alias("parent_id"),
        F.concat(F.lit("/"), "r_name").alias("path"), F.col("r_name").alias("name"),
        F.lit("Folder").alias("type"), F.lit("project").alias("state"),
        F.col("r_name").alias("title"), *pcol(empty))
    nation = nation_folders(t).select(
        F.col("nation_id").alias("id"), F.col("region_id").alias("parent_id"),
        F.col("nation_path").alias("path"), F.col("n_name").alias("name"),
        F.lit("Folder").alias("type"), F.lit("project").alias("state"),
        F.col("n_name").alias("title"), *pcol(empty))
    cf = customer_folders(t, ["c_mktsegment", "c_acctbal"] if properties else None)
    customer = cf.select(
        F.col("cust_id").alias("id"), F.col("nation_id").alias("parent_id"),
        F.col("cust_path").alias("path"), F.col("c_name").alias("name"),
        F.lit("Folder").alias("type"), F.lit("project").alias("state"),
        F.col("c_name").alias("title"), *pcol(_prop_map(_customer_props(), schemas)))
    ocols = ["o_orderkey", "o_custkey", "o_orderstatus"]
    if properties:
        ocols += ["o_orderdate", "o_orderpriority", "o_totalprice"]
    orders = t.orders.select(*ocols)
    okey = _s("o_orderkey")
    order = (orders.join(cf.select("c_custkey", "cust_id", "cust_path"),
                         orders.o_custkey == F.col("c_custkey"))
             .select(F.concat(F.lit("o"), okey).alias("id"), F.col("cust_id").alias("parent_id"),
                     F.concat("cust_path", F.lit("/order_"), okey).alias("path"),
                     F.concat(F.lit("order_"), okey).alias("name"),
                     F.lit("File").alias("type"),
                     F.when(F.col("o_orderstatus") == "O", "project")
                      .when(F.col("o_orderstatus") == "P", "review")
                      .otherwise("approved").alias("state"),
                     F.concat(F.lit("Order "), okey).alias("title"),
                     *pcol(_prop_map(_order_props(), schemas))))
    out = root.unionByName(region).unionByName(nation).unionByName(customer).unionByName(order)
    if full:
        out = out.withColumns({"repo": F.lit(REPO), "locked": F.lit(False),
                               "trashed": F.lit(False), "entity": F.lit("document")})
    return out


def docs_with_properties(t: Tables, schemas: list[str] | None = None) -> DataFrame:
    """Full ``docs`` with ``properties MAP<STRING, VARIANT>``: each row's map
    is built from the source row itself, so no shuffle is needed for it."""
    return docs(t, full=True, properties=True, schemas=schemas)


def files(t: Tables) -> DataFrame:
    """Array property ``files:files`` of each order, one row per element.

    ``pos`` is 1-based in (l_linenumber, l_partkey, l_suppkey, l_quantity,
    l_extendedprice) order, which is unique per order. Array properties are
    kept in this long form (a child table) rather than collected per
    document, so a document with a huge array never lands in one task.
    """
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                           "l_quantity", "l_extendedprice", "l_returnflag")
    numbered = position_within(
        li, ["l_orderkey"],
        ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"])
    return numbered.select(
        F.concat(F.lit("o"), _s("l_orderkey")).alias("doc_id"),
        F.col("pos").cast("long").alias("pos"),
        F.concat(F.lit("part_"), _s("l_partkey")).alias("name"),
        F.concat(F.lit("type/"), "l_returnflag").alias("mime_type"),
        (F.col("l_quantity").cast("long") * 1000).alias("length"))


def notes(t: Tables) -> DataFrame:
    d = t.documents.select("doc_id", "source", "lang", "text")
    did = _s("doc_id")
    return d.select(
        F.concat(F.lit("d"), did).alias("id"),
        F.concat(F.lit("/"), "source").alias("parent_path"),
        F.concat(F.lit("/"), "source", F.lit("/note_"), did).alias("path"),
        F.lit("Note").alias("type"),
        F.concat(F.lit("Note "), did).alias("title"),
        "lang", F.col("text").alias("note"))


def updates(t: Tables) -> DataFrame:
    lb = t.labels.select("doc_id", "quality", "toxic")
    did = F.concat(F.lit("d"), _s("doc_id"))
    return lb.select(did.alias("doc_id"), F.explode(F.array(
        F.struct(F.lit("lbl:quality").alias("prop"), _s("quality").alias("val")),
        F.struct(F.lit("lbl:toxic").alias("prop"), _s("toxic").alias("val")),
    )).alias("u")).select("doc_id", "u.prop", "u.val")


def blobs(t: Tables) -> DataFrame:
    pg = t.pages.select("page_id", "html")
    pid = _s("page_id")
    return pg.select(
        F.concat(F.lit("p"), pid).alias("doc_id"), F.lit("file:content").alias("xpath"),
        F.concat(F.lit("page_"), pid, F.lit(".html")).alias("filename"),
        F.lit("text/html").alias("mime_type"), F.md5(F.col("html")).alias("digest"),
        F.encode(F.col("html"), "UTF-8").alias("content"))


def uploads(t: Tables) -> DataFrame:
    cv = t.conversations.select("conv_id", "turn", "role", "text")
    return cv.select(
        F.concat(F.lit("b"), _s("conv_id")).alias("batch"), _s("turn").alias("idx"),
        F.when(F.col("role") == "system", F.lit(None).cast("string"))
         .otherwise(F.concat("role", F.lit(".txt"))).alias("filename"),
        F.encode(F.col("text"), "UTF-8").alias("content"))


def audit(t: Tables) -> DataFrame:
    ev = t.events.select("event_id", "user_id", "event_type", "ts", "value", "props")
    return ev.select(F.col("event_id").alias("entry_id"),
                     F.concat(F.lit("c"), _s("user_id")).alias("doc_id"),
                     "event_type", "ts", "value", "props")


def workflows(t: Tables) -> DataFrame:
    ev = t.events.select("event_id", "user_id", "event_type", "ts")
    return (ev.where(F.col("event_type").isin("signup", "purchase"))
              .select(F.concat(F.lit("w"), _s("event_id")).alias("workflow_id"),
                      F.concat(F.lit("c"), _s("user_id")).alias("doc_id"),
                      F.col("event_type").alias("name"), F.lit("running").alias("state"),
                      F.col("ts").alias("started_ts")))


def acl(t: Tables) -> DataFrame:
    sp = t.supplier.select("s_suppkey", "s_nationkey", "s_name", "s_acctbal")
    numbered = position_within(sp, ["s_nationkey"], ["s_suppkey"])
    return numbered.select(
        F.concat(F.lit("n"), _s("s_nationkey")).alias("doc_id"), F.lit("local").alias("acl_name"),
        F.col("pos").cast("long").alias("pos"), F.col("s_name").alias("principal"),
        F.lit("Read").alias("permission"), (F.col("s_acctbal") >= 0).alias("granted"))


def requests(t: Tables) -> DataFrame:
    """Lookup requests: by id (view), by path (click), both (purchase, id
    wins), unknown id (error) and neither (signup)."""
    ev = t.events.select("event_id", "event_type", "user_id")
    cf = customer_folders(t).select("c_custkey", "cust_path")
    et = F.col("event_type")
    cid = F.concat(F.lit("c"), _s("user_id"))
    return (ev.join(cf, ev.user_id == cf.c_custkey)
              .select(F.col("event_id").alias("req_id"),
                      F.when(et.isin("view", "purchase"), cid)
                       .when(et == "error", F.concat(F.lit("missing-"), _s("event_id")))
                       .alias("req_docid"),
                      F.when(et == "click", F.col("cust_path"))
                       .when(et == "purchase", F.lit("/")).alias("req_path")))


def request_records(t: Tables) -> DataFrame:
    """The lookup requests as records: ``req_id``, ``attributes`` (string
    map of the non-null well-known attributes) and empty ``content``.

    Attributes: ``nx-docid``, ``nx-path`` (as in :func:`requests`),
    ``nx-type`` (the event type) and, on ``view`` events, ``nx-page-size``
    (the integer part of the event value)."""
    ev = t.events.select("event_id", "event_type", "user_id", "value")
    cf = customer_folders(t).select("c_custkey", "cust_path")
    et = F.col("event_type")
    cid = F.concat(F.lit("c"), _s("user_id"))
    docid = (F.when(et.isin("view", "purchase"), cid)
              .when(et == "error", F.concat(F.lit("missing-"), _s("event_id"))))
    path = F.when(et == "click", F.col("cust_path")).when(et == "purchase", F.lit("/"))
    size = F.when(et == "view", F.floor(F.col("value")).cast("long").cast("string"))
    entries = F.array(
        F.struct(F.lit("nx-docid").alias("key"), docid.alias("value")),
        F.struct(F.lit("nx-path").alias("key"), path.alias("value")),
        F.struct(F.lit("nx-type").alias("key"), et.alias("value")),
        F.struct(F.lit("nx-page-size").alias("key"), size.alias("value")))
    return (ev.join(cf, ev.user_id == cf.c_custkey)
              .select(F.col("event_id").alias("req_id"),
                      F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))
                       .alias("attributes"),
                      F.lit(None).cast("binary").alias("content")))
