"""Invariants of the operators on the sf0.001 role views."""

from pyspark.sql import functions as F

from contentlake.operators import blobs, lookup, mutate, query as q, routing
from contentlake.sources import repository as repo
from contentlake.sources.tables import tables

from conftest import SF_SMALL


def test_every_request_has_one_terminal_outcome(spark):
    t = tables(spark, SF_SMALL)
    res = lookup.get_document(repo.requests(t), repo.docs(t), original=True)
    per = res.where(F.col("route") != "original").groupBy("req_id").count()
    assert per.where("count <> 1").count() == 0
    n = repo.requests(t).count()
    counts = {r["route"]: r["n"] for r in routing.route_counts(res).collect()}
    assert counts["original"] == n
    assert counts.get("success", 0) + counts.get("failure", 0) == n


def test_children_of_root_are_regions(spark):
    t = tables(spark, SF_SMALL)
    reqs = spark.createDataFrame([(1, None, "/")], "req_id long, req_docid string, req_path string")
    kids = lookup.get_children(reqs, repo.docs(t), original=True)
    counts = {r["route"]: r["n"] for r in routing.route_counts(kids).collect()}
    assert counts == {"success": 5, "original": 1}


def test_union_of_pages_is_the_result(spark):
    t = tables(spark, SF_SMALL)
    d = repo.docs(t).where("type = 'File'").select("id", "title")
    allp = q.all_pages(d, "title", "DESC", page_size=7)
    assert allp.count() == d.count() == allp.select("id").distinct().count()
    n_pages = allp.agg(F.max("page_index")).first()[0] + 1
    pages = [q.page(d, "title", "DESC", 7, i, max_results=None) for i in range(n_pages)]
    union = pages[0]
    for p in pages[1:]:
        union = union.unionByName(p)
    a = allp.select("id", "pos")
    assert union.select("id", "pos").exceptAll(a).count() == 0 and union.count() == a.count()


def test_next_page_record(spark):
    """The reference's query test: all documents, size 5, index 0, max 5,
    sorted by title desc -> one next page and the original."""
    t = tables(spark, SF_SMALL)
    d = repo.docs(t)
    page0 = q.page(d, "title", "DESC", page_size=5, page_index=0, max_results=5)
    assert page0.count() == 5
    nxt = q.next_pages(d, page_size=5, page_index=0, max_results=5).collect()
    assert len(nxt) == 1
    assert nxt[0]["page_index"] == 1 and nxt[0]["max_results"] == d.count()
    last = (d.count() - 1) // 5
    assert q.next_pages(d, page_size=5, page_index=last).count() == 0


def test_chunk_reassemble_identity(spark):
    t = tables(spark, SF_SMALL)
    u = repo.uploads(t)
    ch = blobs.chunk(u, 100)
    assert blobs.reassembled_matches(ch, u, ["batch", "idx"], 100).count() == 0
    # small fixture: whole-blob reassembly by concatenating the sorted chunks
    parts = F.array_sort(F.collect_list(F.struct("chunk_no", "chunk")))
    joined = F.aggregate(parts, F.lit(b"").cast("binary"), lambda acc, s: F.concat(acc, s["chunk"]))
    back = ch.groupBy("batch", "idx").agg(F.md5(joined).alias("h"))
    orig = u.select("batch", "idx", F.md5("content").alias("h"))
    assert back.exceptAll(orig).count() == 0


def test_trash_and_delete_are_idempotent(spark):
    t = tables(spark, SF_SMALL)
    docs = repo.docs_with_properties(t)
    reqs = spark.createDataFrame([(1, "c1", None), (2, None, "/")],
                                 "req_id long, req_docid string, req_path string")
    once, _ = mutate.trash_documents(docs, reqs)
    twice, _ = mutate.trash_documents(once, reqs)
    assert once.where("trashed").count() == twice.where("trashed").count() == 2
    d1, _ = mutate.delete_documents(docs, reqs)
    d2, _ = mutate.delete_documents(d1, reqs)
    assert d1.count() == d2.count() == docs.count() - 2


def test_create_collisions_and_missing_parent(spark):
    t = tables(spark, SF_SMALL)
    docs = repo.docs_with_properties(t)
    reqs = spark.createDataFrame(
        [(1, "/", "put_doc", "File", None), (2, "/", "put_doc", "File", None),
         (3, "/nowhere", "x", "File", None), (4, "/", "", "File", None)],
        "req_id long, parent_path string, name string, type string, title string")
    docs2, res = mutate.create_documents(docs, reqs)
    routes = {r["req_id"]: (r["route"], r["error"]) for r in res.collect()}
    assert routes[1] == ("success", None)
    assert routes[2][1] == mutate.DUPLICATE_IN_BATCH
    assert routes[3][1] == mutate.PARENT_NOT_FOUND
    assert routes[4][1] == mutate.ALREADY_EXISTS     # '/' + '' is the root path
    created = docs2.where("path = '/put_doc'").first()
    assert created["title"] == "put_doc" and created["parent_id"] == "root"


def test_update_keeps_other_properties(spark):
    t = tables(spark, SF_SMALL)
    docs = repo.docs_with_properties(t)
    upd = spark.createDataFrame([("c1", "dc:nature", "memo", 1), ("c1", "dc:nature", "report", 2)],
                                "doc_id string, prop string, val string, seq long")
    docs2, res = mutate.update_documents(docs, upd, seq_col="seq")
    row = docs2.where("id = 'c1'").select(
        F.col("properties")["dc:nature"].cast("string").alias("n"),
        F.col("properties")["cust:segment"].cast("string").alias("s")).first()
    assert row["n"] == "report" and row["s"] is not None
    assert {r["route"] for r in res.collect()} == {"success"}


def test_deep_pages_use_global_position(spark, monkeypatch):
    t = tables(spark, SF_SMALL)
    d = repo.docs(t).where("type = 'File'").select("id", "title")
    top = q.page(d, "title", "ASC", 7, 3, max_results=None)
    monkeypatch.setattr(q, "TOPK_MAX_ROWS", 5)
    deep = q.page(d, "title", "ASC", 7, 3, max_results=None)
    assert deep.select("id", "pos").exceptAll(top.select("id", "pos")).count() == 0
    assert deep.count() == top.count() == 7
    capped = q.all_pages(d, "title", "ASC", 7, max_results=30)
    assert capped.count() == 30 and capped.agg(F.max("pos")).first()[0] == 30


def test_wide_requests_broadcast_only_keys(spark):
    """Requests carrying record bytes take the keys-only broadcast branch and
    give the same children and related rows as narrow requests."""
    t = tables(spark, SF_SMALL)
    narrow = repo.requests(t)
    wide = narrow.withColumn("content", F.encode(F.col("req_path"), "UTF-8"))
    from contentlake.functions.joins import is_narrow
    assert is_narrow(narrow) and not is_narrow(wide)
    a = lookup.get_children(narrow, repo.docs(t)).select("req_id", "child_id", "route")
    b = lookup.get_children(wide, repo.docs(t)).select("req_id", "child_id", "route")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    from contentlake.operators import relations
    wf = repo.workflows(t)
    c = relations.get_related(narrow, repo.docs(t), wf, ["workflow_id"]).select("req_id", "workflow_id")
    d = relations.get_related(wide, repo.docs(t), wf, ["workflow_id"]).select("req_id", "workflow_id")
    assert c.exceptAll(d).count() == 0 and d.exceptAll(c).count() == 0


def test_every_create_request_has_one_result_and_ids_stay_unique(spark):
    t = tables(spark, SF_SMALL)
    docs = repo.docs_with_properties(t)
    reqs = spark.createDataFrame(
        [(1, None, "a", "i1"), (2, "/", None, "i2"), (3, "/", "a", "c1"), (4, "/", "b", "same"), (5, "/", "c", "same"),
         (6, "/nowhere", "d", "late"), (7, "/", "d", "late")], "req_id long, parent_path string, name string, new_id string")
    docs2, res = mutate.create_documents(docs, reqs.selectExpr("*", "'File' AS type"), title=None, new_id="new_id")
    errors = {r["req_id"]: r["error"] for r in res.collect()}
    assert errors == {1: mutate.NO_NAME, 2: mutate.NO_NAME, 3: mutate.ID_TAKEN, 4: None, 5: mutate.DUPLICATE_ID,
                      6: mutate.PARENT_NOT_FOUND, 7: None}
    assert docs2.count() == docs.count() + 2 == docs2.select("id").distinct().count()


def test_update_of_a_document_without_properties_and_by_path(spark):
    docs = spark.createDataFrame([("a", "/a"), ("b", "/b")], "id string, path string").withColumn(
        "properties", F.lit(None).cast("map<string,variant>"))
    ups = spark.createDataFrame([(1, "a", None, "x:y", "1"), (2, "a", None, "x:y", "0"), (3, None, "/b", "x:y", "7"), (4, "z", None, "x:y", "1")],
                                "req_id long, doc_id string, doc_path string, prop string, val string")
    docs2, res = mutate.update_documents(docs, ups, seq_col="req_id", req_key="req_id", path_col="doc_path")
    got = {r["id"]: r["v"] for r in docs2.select("id", F.col("properties")["x:y"].cast("string").alias("v")).collect()}
    assert got == {"a": "0", "b": "7"}
    assert {r["req_id"]: r["route"] for r in res.collect()} == {1: "success", 2: "success", 3: "success", 4: "failure"}


def test_an_instance_is_cancelled_once(spark):
    docs = spark.createDataFrame([("a", "/a")], "id string, path string")
    wf = spark.createDataFrame([("w1", "a", "M", "running"), ("w2", "a", "M", "running")], "workflow_id string, doc_id string, name string, state string")
    reqs = spark.createDataFrame([(2, "a", None, "M"), (1, None, "/a", "M")], "req_id long, req_docid string, req_path string, workflow string")
    wf2, res = mutate.cancel_workflows(docs, wf, reqs)
    assert sorted((r["req_id"], r["workflow_id"]) for r in res.collect()) == [(1, "w1"), (1, "w2")]
    assert wf2.where("state = 'canceled'").count() == 2
