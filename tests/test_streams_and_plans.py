"""Streaming twins agree with batch; plans prune columns and push filters;
lookups stay right on the shuffle path with a hot key."""

from pyspark.sql import functions as F

from contentlake.functions import joins
from contentlake.operators import lookup
from contentlake.plans.catalog import QUERIES
from contentlake.sources import repository as repo
from contentlake.sources.tables import tables

from conftest import SF_SMALL


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_stream_lookup_equals_batch(spark):
    s = QUERIES["stream_lookup"](spark, SF_SMALL)
    b = QUERIES["get_document"](spark, SF_SMALL)
    assert _same(s.select(*sorted(b.columns)), b.select(*sorted(b.columns)))


def test_stream_upsert_equals_batch(spark):
    s = QUERIES["stream_upsert"](spark, SF_SMALL)
    b = QUERIES["update_document"](spark, SF_SMALL)
    assert _same(s, b)


def test_timer_query_equals_page(spark):
    assert _same(QUERIES["timer_query"](spark, SF_SMALL), QUERIES["query_page"](spark, SF_SMALL))


def test_scan_prunes_columns_and_pushes_filters(spark):
    df = QUERIES["workflow_name_filter"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "event_type" in plan
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    assert "props" not in scan and "value" not in scan


def test_shuffle_path_with_hot_document(spark, monkeypatch):
    """Force the shuffle path (no broadcast) and send a third of all requests
    to one document: every request still gets exactly one outcome."""
    monkeypatch.setattr(joins, "LOOKUP_BROADCAST_ROWS", 0)
    monkeypatch.setattr(lookup, "LOOKUP_BROADCAST_ROWS", 0)
    t = tables(spark, SF_SMALL)
    reqs = repo.requests(t).withColumn(
        "req_docid", F.when(F.col("req_id") % 3 == 0, F.lit("c1")).otherwise(F.col("req_docid")))
    res = lookup.get_document(reqs, repo.docs(t))
    assert res.count() == reqs.count()
    assert res.where("req_id % 3 = 0 and route = 'success' and doc_id = 'c1'").count() == \
        reqs.where("req_id % 3 = 0").count()
    kids = lookup.get_children(reqs, repo.docs(t))
    n_c1 = repo.docs(t).where("parent_id = 'c1'").count()
    hot_children = kids.where("req_id % 3 = 0 and route = 'success'").count()
    assert hot_children == reqs.where("req_id % 3 = 0").count() * n_c1


def test_upsert_goes_on_from_the_newest_version(spark, tmp_path):
    from contentlake.streaming import streams

    source, table, checkpoint = (str(tmp_path / x) for x in ("in", "table", "ckpt"))
    initial = spark.createDataFrame([(1, "old")], "id long, v string")
    spark.createDataFrame([(1, "new")], "id long, v string").write.parquet(source)

    def run():
        changes = streams.read_stream(spark, source)
        merge = lambda old, batch: batch.unionByName(old.join(batch, "id", "left_anti"))
        latest = streams.stream_upsert(spark, changes, initial, merge, table, checkpoint)
        return [tuple(r) for r in spark.read.parquet(latest).collect()]

    assert run() == [(1, "new")]
    assert run() == [(1, "new")]
    spark.createDataFrame([(2, "two")], "id long, v string").write.mode("append").parquet(source)
    assert sorted(run()) == [(1, "new"), (2, "two")]
