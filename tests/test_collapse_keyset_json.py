"""Collapse in chunks, keyset pages, JSON per request, the clock."""

import json
import os
import random

from pyspark.sql import functions as F

from contentlake.operators import attributes, query as q, relations
from contentlake.operators.lookup import NO_REFERENCE, NOT_FOUND
from contentlake.streaming import streams


def collapsed(spark, data, chunk):
    """{doc: (kind, n, single, list)} with the lists put together again."""
    ids = spark.createDataFrame([(d,) for d in sorted({d for d, *_ in data} | {"none"})], "doc_id string")
    matches = spark.createDataFrame([x for x in data if x[1] is not None], "doc_id string, pos bigint, value string").repartition(3)
    docs, lists = attributes.collapse_matches(ids, matches, chunk=chunk)
    parts = {}
    for r in sorted(lists.collect(), key=lambda r: (r["doc_id"], r["chunk"])):
        values = json.loads(r["list_value"])
        assert len(values) == r["n_values"] <= chunk
        parts.setdefault(r["doc_id"], []).extend(values)
    return {r["doc_id"]: (r["kind"], r["n_matches"], r["single_value"], parts.get(r["doc_id"])) for r in docs.collect()}


def expected(values):
    while values and values[0] is None:
        values = values[1:]
    kind = "null" if not values else "value" if len(values) == 1 else "list"
    return kind, len(values), values[0] if len(values) == 1 else None, values if len(values) > 1 else None


def test_collapse_of_nulls_values_and_lists(spark):
    r = random.Random(1)
    cases = {"none": [], "nulls": [None] * 9, "late": [None] * 7 + ["x"], "mid": [None, None, "a", None, None, "b"], "one": ["v"],
             "tail": [None, "a", None], **{f"r{i}": [r.choice([None, "a", "b"]) for _ in range(r.randint(0, 12))] for i in range(20)}}
    data = [(d, p + 1, v) for d, vs in cases.items() for p, v in enumerate(vs)] + [(d, None, None) for d in cases]
    for chunk in (1, 3, 1000):
        assert collapsed(spark, data, chunk) == {d: expected(vs) for d, vs in cases.items()}


def test_collapse_of_a_hot_document(spark):
    """A third of all elements in one document: chunks, never one row."""
    hot = [(("hot" if i % 3 == 0 else f"d{i % 50}"), i + 1, None if i % 7 == 0 else str(i)) for i in range(30_000)]
    docs = {}
    for d, p, v in hot:
        docs.setdefault(d, []).append(v)
    got = collapsed(spark, hot, 100)
    assert {d: got[d] for d in docs} == {d: expected(vs) for d, vs in docs.items()}


def walk(df, sort_by, order, size):
    out, after = [], None
    while True:
        rows, following = q.keyset_page(df, sort_by, order, page_size=size, after=after)
        out.append([r["id"] for r in rows.orderBy(*q.sort_columns(sort_by, order)).collect()])
        more = following.collect()
        assert len(more) <= 1
        if not more:
            return out
        assert more[0]["route"] == "next_page" and more[0]["page_size"] == size
        after = more[0]["after"]


def test_keyset_pages_are_the_pages_of_the_order(spark):
    r = random.Random(2)
    rows = [(f"i{i:03d}", r.choice([None, "a", "b", "ü"]), r.choice([None, 1, 2, -3]), r.choice([None, 1.5, -0.25, 3.0])) for i in range(60)]
    df = spark.createDataFrame(rows, "id string, s string, n bigint, x double").repartition(3)
    for by, order in (("s", "ASC"), ("s", "DESC"), (["n", "s"], "ASC"), (["x", "n"], "DESC"), (None, None), ("id", "DESC")):
        want = [r["id"] for r in df.orderBy(*q.sort_columns(by, order)).collect()]
        pages = walk(df, by, order, 7)
        assert [i for p in pages for i in p] == want and all(len(p) == 7 for p in pages[:-1])
    assert walk(df.limit(0), "s", "ASC", 7) == [[]]
    exact = df.orderBy("id").limit(14)
    assert [len(p) for p in walk(exact, "s", "ASC", 7)] == [7, 7]     # no page after a full last one


def test_keyset_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).selectExpr("concat('i', id) AS id", "if(id % 9 = 0, null, id % 100) AS n").write.parquet(path)
    df = spark.read.parquet(path)
    key = df.where(q._after_key([("n", True, F.lit(5)), ("id", False, F.lit("i5"))]))
    plan = key._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(Or(LessThan(n,5),IsNull(n)),And(EqualTo(n,5),GreaterThan(id,i5)))]" in plan


def test_json_per_request_is_factored(spark):
    docs = spark.createDataFrame([(f"d{i}", f"/p{i}") for i in range(4)], "id string, path string")
    entries = spark.createDataFrame([("d1", i, f"e{i}") for i in range(7)] + [("d2", 1, "x"), ("d3", 1, "unasked")], "doc_id string, n int, v string")
    asked = [(1, "d1", None), (2, "d1", "/p2"), (3, None, "/p1"), (4, " ", "/p2"), (5, "d0", None), (6, "gone", None), (7, None, None), (8, "d1", None)]
    reqs = spark.createDataFrame(asked, "req_id int, req_docid string, req_path string")
    outcomes, chunks = relations.get_related_json(reqs, docs, entries, ["n"], ["v"], chunk_size=3)
    assert {r["req_id"]: (r["doc_id"], r["error"]) for r in outcomes.collect()} == {
        1: ("d1", None), 2: ("d1", None), 3: ("d1", None), 4: ("d2", None), 5: ("d0", None), 6: (None, NOT_FOUND), 7: (None, NO_REFERENCE), 8: ("d1", None)}
    got = sorted((r["doc_id"], r["chunk"], r["n_entries"], [e["v"] for e in json.loads(r["content"])]) for r in chunks.collect())
    assert got == [("d1", 0, 3, ["e0", "e1", "e2"]), ("d1", 1, 3, ["e3", "e4", "e5"]), ("d1", 2, 1, ["e6"]), ("d2", 0, 1, ["x"])]


def test_clock_runs_without_input_and_goes_on_after_a_restart(spark, tmp_path):
    sink, checkpoint = str(tmp_path / "sink"), str(tmp_path / "ckpt")
    ran = []

    def run(s):
        ran.append(1)
        return s.range(3).withColumn("run", F.lit(len(ran)))

    streams.timer_query(spark, None, run, sink, checkpoint, runs=3)
    folders = sorted(d for d in os.listdir(sink) if d.startswith("batch="))
    assert folders == ["batch=0", "batch=1", "batch=2"] and len(ran) == 3
    assert spark.read.parquet(sink).groupBy("batch").count().collect() and spark.read.parquet(sink).count() == 9
    streams.timer_query(spark, None, run, sink, checkpoint, runs=5)
    assert sorted(d for d in os.listdir(sink) if d.startswith("batch="))[:3] == folders
    assert 3 <= len(ran) <= 5
    streams.timer_query(spark, None, run, sink, str(tmp_path / "again"), runs=2)     # a replay writes the same folders
    assert sorted(d for d in os.listdir(sink) if d.startswith("batch="))[:2] == folders[:2]
