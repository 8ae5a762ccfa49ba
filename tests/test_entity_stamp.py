"""Every document is stamped, not only folders."""

from pyspark.sql import functions as F

from contentlake.operators import lookup
from contentlake.operators.attributes import entity_stamp
from contentlake.plans.catalog import QUERIES
from contentlake.sources import repository as repo
from contentlake.sources.tables import tables

from conftest import SF_SMALL


def test_every_document_is_stamped(spark):
    out = QUERIES["entity_stamp_documents"](spark, SF_SMALL)
    docs = repo.docs(tables(spark, SF_SMALL))
    assert {r["type"] for r in out.select("type").distinct().collect()} == {"Root", "Folder", "File"}
    assert out.where((F.col("entity") == "document") & (F.col("docid") == F.col("id"))).count() == docs.count()


def test_stamp_of_any_output(spark):
    t = tables(spark, SF_SMALL)
    res = entity_stamp(lookup.get_document(repo.requests(t), repo.docs(t)), id_col="doc_id")
    right = F.when(F.col("route") == "success", F.col("entity").eqNullSafe("document") & F.col("docid").eqNullSafe(F.col("doc_id")))
    assert res.where(~right).count() == 0
    assert res.where("route = 'failure' and (entity is not null or docid is not null)").count() == 0
