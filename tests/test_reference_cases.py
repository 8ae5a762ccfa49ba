"""The reference's integration cases (FIXTURES.md §1.3), restated on the
sf0.001 repository: route counts and the attributes / values they assert."""

import json

from pyspark.sql import functions as F

from contentlake.operators import attributes, lookup, mutate, operations, relations, routing
from contentlake.operators import builtin_operations  # noqa: F401  (registers operations)
from contentlake.sources import entity_json as ej
from contentlake.sources import repository as repo
from contentlake.sources.tables import tables

from conftest import SF_SMALL


def _req(spark, docid=None, path=None, **extra):
    cols = {"req_id": 1, "req_docid": docid, "req_path": path, **extra}
    schema = ", ".join(f"{k} {'long' if k == 'req_id' else 'string'}" for k in cols)
    return spark.createDataFrame([tuple(cols.values())], schema)


def _counts(df):
    return {r["route"]: r["n"] for r in routing.route_counts(df).collect()}


def test_get_root_by_path(spark):
    t = tables(spark, SF_SMALL)
    res = lookup.get_document(_req(spark, path="/"), repo.docs(t))
    assert _counts(res) == {"success": 1} and res.first()["doc_id"] == "root"


def test_blob_of_a_document(spark):
    t = tables(spark, SF_SMALL)
    blobs = repo.blobs(t).withColumn("length", F.octet_length("content"))
    one = blobs.select("doc_id", "length").first()
    res = relations.get_blob(_req(spark, docid=one["doc_id"], req_xpath=None), blobs)
    assert _counts(res) == {"success": 1, "original": 1}
    assert res.where("route = 'success'").first()["length"] == one["length"]


def test_attributes_all_and_mapped(spark):
    t = tables(spark, SF_SMALL)
    d = repo.docs_with_properties(t).where("id = 'c1'")
    allp = {r["key"]: r["value"] for r in attributes.document_to_columns_all(d).collect()}
    assert "dc:title" in allp
    mapped = attributes.document_to_columns(d, {"title_prop": "dc:title"}).first()
    assert mapped["title_prop"] == allp["dc:title"] and mapped["route"] == "success"


def test_attributes_nested_member(spark):
    props = json.dumps({"data": "abc", "name": "blob.json"})
    d = spark.createDataFrame([("x", props)], "id string, p string").select(
        "id", F.create_map(F.lit("file:content"), F.parse_json("p")).alias("properties"))
    row = attributes.document_to_columns(d, {"fileData": "file:content/data"}).first()
    assert row["fileData"] == "abc"


def test_update_by_lookup_and_inline(spark):
    t = tables(spark, SF_SMALL)
    docs = repo.docs_with_properties(t)
    upd = spark.createDataFrame([("c1", "dc:nature", "memo")], "doc_id string, prop string, val string")
    docs2, res = mutate.update_documents(docs, upd)
    assert _counts(res) == {"success": 1}
    got = docs2.where("id = 'c1'").select(F.col("properties")["dc:nature"].cast("string")).first()[0]
    assert got == "memo"
    # inline: the record carries the document as JSON; its uid drives the update
    content = json.dumps({"entity-type": "document", "uid": "c2"}).encode()
    rec = spark.createDataFrame([(1, bytearray(content))], "req_id long, content binary")
    inline = rec.select(ej.parse_document(F.col("content"))["id"].alias("doc_id"),
                        F.lit("dc:nature").alias("prop"), F.lit("report").alias("val"))
    docs3, res3 = mutate.update_documents(docs2, inline)
    assert _counts(res3) == {"success": 1}
    assert docs3.where("id = 'c2'").select(F.col("properties")["dc:nature"].cast("string")).first()[0] == "report"


def test_start_workflow_on_a_document(spark):
    t = tables(spark, SF_SMALL)
    models = spark.createDataFrame([("SerialDocumentReview",)], "name string")
    wf, res = mutate.start_workflows(repo.docs(t), repo.workflows(t),
                                     _req(spark, path="/", workflow="SerialDocumentReview"), models)
    assert _counts(res) == {"success": 1}
    assert wf.where("workflow_id = 'wf-1'").count() == 1


def test_document_operation_and_plain_operation(spark):
    t = tables(spark, SF_SMALL)
    res = operations.run_operation(spark, "Document.AddToFavorites", _req(spark, docid="c1"),
                                   store={"docs": repo.docs(t)}, original=True)
    assert _counts(res) == {"success": 1, "original": 1}
    coll = spark.createDataFrame([("Administrator", "My collection")], "user string, name string")
    res2 = operations.run_operation(spark, "User.GetCollections", params={"searchTerm": ""},
                                    store={"collections": coll})
    assert _counts(res2) == {"success": 1}


def test_blob_operation(spark):
    rec = spark.createDataFrame([(1, "data.txt", bytearray(b"data"))], "req_id long, filename string, content binary")
    store = {"docs": repo.docs_with_properties(tables(spark, SF_SMALL))}
    res = operations.run_operation(spark, "Blob.Attach", rec, original=True, store=store,
                                   params={"document": "c1", "xpath": "files:files"})
    assert _counts(res) == {"success": 1, "original": 1}
    lost = operations.run_operation(spark, "Blob.Attach", rec, original=True, store=store,
                                    params={"document": "nowhere", "xpath": "files:files"})
    assert _counts(lost) == {"failure": 1, "original": 1}
