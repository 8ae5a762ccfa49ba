"""Several repositories, schemas on lookups, inline documents, defaults, blob files, null counts."""

import os

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from contentlake.functions import args, joins
from contentlake.operators import attributes, lookup, mutate, relations
from contentlake.operators.lookup import NOT_FOUND
from contentlake.sources.blob_files import file_name, read_blob_files, write_blob_files
from contentlake.sources.versioned import VersionedTable


def two_repos(spark):
    rows = [(r, i, p, parent, f"{r} {i}") for r in ("default", "archive") for i, p, parent in (("root", "/", None), ("a", "/a", "root"), ("b", "/a/b", "a"))]
    rows.append(("archive", "c", "/a/c", "a", "archive c"))
    return spark.createDataFrame(rows, "repo string, id string, path string, parent_id string, title string")


def requests(spark):
    return spark.createDataFrame([(1, "a", None, "archive"), (2, "a", None, None), (3, None, "/a", "archive"), (4, "c", None, "default"),
                                  (5, "c", None, "archive"), (6, None, None, "archive"), (7, "a", None, "nowhere"), (8, "a", None, " ")],
                                 "req_id int, req_docid string, req_path string, req_repo string")


@pytest.mark.parametrize("bound", [200_000, 0])      # broadcast keys; shuffle joins
def test_each_request_is_answered_by_its_repository(spark, monkeypatch, bound):
    for module in (joins, lookup):
        monkeypatch.setattr(module, "LOOKUP_BROADCAST_ROWS", bound)
    docs, reqs = two_repos(spark), requests(spark)
    got = {r["req_id"]: r["doc_title"] for r in lookup.get_document(reqs, docs, repo_col="req_repo").collect()}
    assert got == {1: "archive a", 2: "default a", 3: "archive a", 4: None, 5: "archive c", 6: None, 7: None, 8: "default a"}
    kids = lookup.get_children(reqs, docs, child_cols=["id", "title"], repo_col="req_repo")
    assert set(kids.columns) == {*reqs.columns, "parent_id", "child_id", "child_title", "route", "error"}
    found = sorted((r["req_id"], r["child_title"]) for r in kids.where("route = 'success'").collect())
    assert found == [(1, "archive b"), (1, "archive c"), (2, "default b"), (3, "archive b"), (3, "archive c"), (8, "default b")]
    assert sorted(r["req_id"] for r in kids.where("route = 'failure'").collect()) == [4, 6, 7]
    entries = spark.createDataFrame([("default", "a", "one"), ("archive", "a", "two"), ("archive", "c", "three")], "repo string, doc_id string, entry string")
    rel = relations.get_related(reqs, docs, entries, ["entry"], repo_col="req_repo")
    assert sorted((r["req_id"], r["entry"]) for r in rel.where("route = 'success'").collect()) == [(1, "two"), (2, "one"), (3, "two"), (5, "three"), (8, "one")]


def test_blobs_by_repository_and_path(spark):
    blobs = spark.createDataFrame([("default", "a", "file:content", "d.txt"), ("archive", "a", "file:content", "o.txt")],
                                  "repo string, doc_id string, xpath string, filename string")
    out = relations.get_blob(requests(spark), blobs, xpath_col=None, original=False, blob_cols=["filename"], path_col="req_path",
                             docs=two_repos(spark), repo_col="req_repo")
    assert {r["req_id"]: r["filename"] for r in out.collect()} == {1: "o.txt", 2: "d.txt", 3: "o.txt", 4: None, 5: None, 6: None, 7: None, 8: "d.txt"}


def test_only_named_repositories_are_read(spark, tmp_path):
    """The table's folders of other repositories are pruned at run time, by the requests."""
    docs = two_repos(spark).unionByName(two_repos(spark).withColumn("repo", F.concat(F.lit("r"), F.col("repo"))))
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.create(docs, buckets=1)
    reqs = spark.createDataFrame([(1, "a", None, "archive")], "req_id int, req_docid string, req_path string, req_repo string")
    found = lookup.get_children(reqs, table.read(), child_cols=["title"], repo_col="req_repo")
    assert sorted(r["child_title"] for r in found.collect()) == ["archive b", "archive c"]
    plan = found._jdf.queryExecution().toString()
    assert "dynamicpruning" in plan.lower()


def test_schemas_on_lookups(spark):
    docs = spark.sql("""select 'a' id, '/a' path, 'root' parent_id, map('dc:title', parse_json('"x"'), 'ord:n', parse_json('1')) properties
                        union all select 'b', '/a/b', 'a', map('dc:title', parse_json('"y"'), 'ord:n', parse_json('2'))""")
    reqs = spark.createDataFrame([(1, "a", None)], "req_id int, req_docid string, req_path string")
    keys = lambda df, c: sorted(k for r in df.select(F.map_keys(c).alias("k")).collect() for k in r["k"])
    assert keys(lookup.get_document(reqs, docs, doc_cols=["id", "properties"], schemas=["dc"]), "doc_properties") == ["dc:title"]
    assert keys(lookup.get_document(reqs, docs, doc_cols=["id", "properties"], schemas=["*"]), "doc_properties") == ["dc:title", "ord:n"]
    assert keys(lookup.get_document(reqs, docs, doc_cols=["id", "properties"]), "doc_properties") == ["dc:title", "ord:n"]
    assert keys(lookup.get_children(reqs, docs, child_cols=["properties"], schemas=["ord", "none"]), "child_properties") == ["ord:n"]


def small_docs(spark):
    return spark.sql("""select 'default' repo, id, concat('/', id) path, map('p:a', parse_json('1')) properties, false trashed
                        from values ('a'), ('b'), ('c') t(id)""")


def test_inline_documents_need_no_lookup(spark, monkeypatch):
    looked = []
    whole = mutate.get_document
    monkeypatch.setattr(mutate, "get_document", lambda rows, *a, **k: looked.extend(r["req_id"] for r in rows.collect()) or whole(rows, *a, **k))
    rows = [(1, None, None, ("a",), "x"), (2, "c", "/c", ("b",), "y"), (3, None, "/c", None, "z"), (4, "a", "/b", None, "w"),
            (5, None, None, ("gone",), "v"), (6, None, None, None, "u"), (7, None, "/nope", None, "t")]
    updates = spark.createDataFrame(rows, "req_id int, doc_id string, path string, inline struct<id:string>, val string").withColumn("prop", F.concat(F.lit("p:"), "req_id"))
    docs2, res = mutate.update_documents(small_docs(spark), updates, req_key="req_id", path_col="path", inline_col="inline")
    assert sorted(looked) == [3, 7]
    got = {r["req_id"]: (r["doc_id"], r["error"]) for r in res.collect()}
    assert got == {1: ("a", None), 2: ("b", None), 3: ("c", None), 4: ("a", None), 5: ("gone", NOT_FOUND), 6: (None, NOT_FOUND), 7: (None, NOT_FOUND)}
    held = {(r["id"], r["key"]): r["v"] for r in docs2.select("id", F.explode("properties").alias("key", "v")).select("id", "key", F.col("v").cast("string").alias("v")).collect()}
    assert held == {("a", "p:a"): "1", ("b", "p:a"): "1", ("c", "p:a"): "1", ("a", "p:1"): "x", ("b", "p:2"): "y", ("c", "p:3"): "z", ("a", "p:4"): "w"}


def test_defaults_of_what_is_not_given(spark):
    df = spark.createDataFrame([(7, "n", None, None, None, None, None), (8, "n", "t", "f", "b", "2", "x:y")],
                               "k int, name string, title string, filename string, blob_name string, idx string, xpath string")
    out = [tuple(r)[2:] for r in args.fill_defaults(df, F.col("k")).orderBy("k").collect()]
    assert out == [("n", "data-7", "7", "0", "file:content"), ("t", "f", "b", "2", "x:y")]
    assert args.fill_defaults(df.select("k", "idx"), F.col("k")).columns == ["k", "idx"]


def test_blob_files_round_trip(spark, tmp_path):
    folder = str(tmp_path / "blobs")
    keys = ["p1", "a/b", "A", "a", "ü%2F", "x.y", "sp ace", "+", "%25", "%", "_", "_41"]
    blobs = spark.createDataFrame([(k, bytes([i]) * (i * 100)) for i, k in enumerate(keys)] + [(None, b"x"), ("nothing", None)], "doc_id string, content binary")
    listed = write_blob_files(blobs.repartition(3), folder).persist()
    written = {r["key"]: r["length"] for r in listed.collect()}
    assert written == {k: i * 100 for i, k in enumerate(keys)} and len(os.listdir(folder)) == len(keys)
    back = {r["key"]: bytes(r["content"]) for r in read_blob_files(spark, folder, written=listed).collect()}
    assert back == {k: bytes([i]) * (i * 100) for i, k in enumerate(keys)}
    few = read_blob_files(spark, folder, most_bytes=250)
    assert {r["key"] for r in few.collect()} == set(keys[1:3])     # empty files are skipped
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(length), LessThanOrEqual(length,250)]" in plan
    names = read_blob_files(spark, folder).select("key", "length")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in names.split("ReadSchema")[1]
    assert {r["key"] for r in read_blob_files(spark, folder, keys=file_name("A")).collect()} == {"A"}


def test_null_counts_come_from_the_pass_that_writes(spark, tmp_path):
    docs = spark.sql("select id, map(if(id < 3, 'p:a', 'p:b'), cast(id as variant)) properties from range(10)")
    nulls = Observation()
    out = attributes.document_to_columns(docs, {"a": "p:a", "b": "p:b", "none": "p:c"}, nulls=nulls)
    out.write.parquet(str(tmp_path / "t"))
    assert nulls.get == {"documents": 10, "a": 7, "b": 3, "none": 10}
    assert "nulls" not in out.columns and spark.read.parquet(str(tmp_path / "t")).count() == 10
