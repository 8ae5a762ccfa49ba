"""Batches too large to broadcast: the table is scanned once for them, and not shuffled."""

from pyspark.sql import functions as F

from contentlake.functions.joins import near_keys
from contentlake.operators import changes as ch
from contentlake.operators import mutate

DOCS = "repo string, id string, parent_id string, path string, name string, type string, state string, title string, locked boolean, trashed boolean, entity string"
CHANGES = "seq bigint, kind string, doc_id string, parent_path string, name string, type string, prop string, val string"


def docs(spark, folder):
    rows = [("default", "root", None, "/", "", "Root", "project", "Root", False, False, "document")]
    rows += [("default", f"d{i}", "root", f"/n{i}", f"n{i}", "Note", "project", f"N {i}", False, False, "document") for i in range(30)]
    spark.createDataFrame(rows, DOCS).write.parquet(folder)
    return spark.read.parquet(folder).withColumn("properties", F.create_map(F.lit("p:a"), F.col("name")).cast("map<string,variant>"))


def held(df):
    cols = [c for c in df.columns if c != "properties"]
    return sorted(map(str, df.select(*cols, F.to_json("properties").alias("p")).collect()))


def test_many_creates_scan_the_table_once(spark, monkeypatch, tmp_path):
    table = docs(spark, str(tmp_path / "docs"))
    asked = [(i, p, n, "Note", k) for i, (p, n, k) in enumerate(
        [("/", "a", "x1"), ("/n1", "b", "x2"), ("/no", "c", "x3"), ("/", "n2", "x4"), ("/", "e", "d3"), ("/", "f", "x1"), ("/", "a", "x7"),
         (None, "g", "x8"), ("/", None, "x9")])]
    req = spark.createDataFrame(asked, "req_id int, parent_path string, name string, type string, new_id string")
    make = lambda: mutate.create_documents(table, req, title=None, new_id="new_id")
    few, few_results = make()
    monkeypatch.setattr(mutate, "requests_are_small", lambda requests: False)
    many, results = make()
    assert held(many) == held(few) and many.count() == 33
    assert sorted(map(str, results.collect())) == sorted(map(str, few_results.collect()))
    scans = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("parquet")
    assert (scans(many), scans(results)) == (1, 0)


def test_near_keys_hold_all_that_can_match(spark):
    table = spark.createDataFrame([(r, i) for r in ("a", "b", None) for i in ("1", "2", "3", None)], "r string, i string")
    keys = spark.createDataFrame([("a", "2"), ("a", "2"), ("b", "9"), (None, "3"), ("c", None)], "kr string, ki string")
    on = (F.col("r") == F.col("kr")) & (F.col("i") == F.col("ki"))
    near = near_keys(table, ["r", "i"], keys, ["kr", "ki"])
    assert near.count() < table.count()
    assert near.join(keys, on, "left_semi").collect() == table.join(keys, on, "left_semi").collect() == [("a", "2")]
    assert near_keys(table, ["r", "i"], keys, ["kr", "ki"], bound=3) is table


def test_large_batch_of_changes_streams_the_table(spark, monkeypatch, tmp_path):
    table = docs(spark, str(tmp_path / "docs"))
    data = [{"kind": "update", "doc_id": f"d{i}", "prop": "q:v", "val": str(i)} for i in (1, 1, 4, 99)]
    data += [{"kind": "create", "doc_id": "new", "parent_path": "/n2", "name": "x", "type": "Note"}, {"kind": "trash", "doc_id": "d5"},
             {"kind": "delete", "doc_id": "d6"}, {"kind": "create", "doc_id": "other", "parent_path": "/", "name": "n7", "type": "Note"},
             {"kind": "update", "doc_id": None, "prop": "q:v", "val": "1"}]
    batch = spark.createDataFrame([(n, *[x.get(c.split(" ")[0]) for c in CHANGES.split(", ")[1:]]) for n, x in enumerate(data)], CHANGES)
    few, few_results = ch.net_changes(table, batch)
    monkeypatch.setattr(ch, "LOOKUP_BROADCAST_ROWS", 0)
    many, results = ch.net_changes(table, batch)
    assert held(many) == held(few) and many.count() == 5
    assert sorted(map(str, results.collect())) == sorted(map(str, few_results.collect()))
    assert "_near" in many._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr("contentlake.functions.joins.HASHED_KEYS", 0)
    whole, _ = ch.net_changes(table, batch)
    assert held(whole) == held(few)
