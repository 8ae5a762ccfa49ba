"""Sinks: routed outputs split into folders; snapshots replace only the
repositories they hold."""

from pyspark.sql import functions as F

from contentlake.operators import lookup, routing
from contentlake.session import shared_dir
from contentlake.sources import repository as repo
from contentlake.sources import snapshots
from contentlake.sources.tables import tables

from conftest import SF_SMALL


def test_write_routes_splits_outputs(spark):
    t = tables(spark, SF_SMALL)
    res = lookup.get_document(repo.requests(t), repo.docs(t), doc_cols=["id"], original=True)
    path = shared_dir(spark, "routes-test")
    routing.write_routes(res.select("req_id", "route", "error"), path)
    back = spark.read.parquet(path)
    want = {r["route"]: r["n"] for r in routing.route_counts(res).collect()}
    got = {r["route"]: r["n"] for r in routing.route_counts(back).collect()}
    assert got == want
    outs = routing.outputs(back)
    assert outs["original"].count() == repo.requests(t).count()


def test_snapshot_dynamic_overwrite_keeps_other_repos(spark):
    t = tables(spark, SF_SMALL)
    docs = repo.docs(t, full=True)
    path = shared_dir(spark, "snapshot-test")
    two = docs.unionByName(docs.withColumn("repo", F.lit("archive")))
    snapshots.write_snapshot(two, path)
    # rewrite only the default repository, with its folders trashed
    changed = docs.withColumn("trashed", F.col("type") == "Folder")
    snapshots.write_snapshot(changed, path)
    back = spark.read.parquet(path)
    assert back.where("repo = 'archive'").count() == docs.count()
    assert back.where("repo = 'archive' and trashed").count() == 0
    assert back.where("repo = 'default' and trashed").count() == docs.where("type = 'Folder'").count()
