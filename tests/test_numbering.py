"""Skew-safe positions agree with row_number, also with one hot key."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from contentlake.plans.numbering import global_position, position_within


def _skewed(spark):
    # key 0 holds half of all rows
    return spark.range(20000).select(
        F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id") % 97).alias("k"),
        (F.col("id") * 7919 % 20011).alias("v"), F.col("id").alias("u"))


def test_global_position_matches_row_number(spark):
    df = _skewed(spark)
    got = global_position(df, ["v", "u"]).select("u", "pos")
    want = df.select("u", F.row_number().over(Window.orderBy("v", "u")).alias("pos"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_position_within_matches_row_number_with_hot_key(spark):
    df = _skewed(spark)
    got = position_within(df, ["k"], ["v", "u"]).select("u", "pos")
    w = Window.partitionBy("k").orderBy("v", "u")
    want = df.select("u", F.row_number().over(w).alias("pos"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_hot_key_spans_partitions(spark):
    df = _skewed(spark)
    ranged = df.repartitionByRange(8, "k", "v", "u").select(F.spark_partition_id().alias("p"), "k")
    assert ranged.where("k = 0").select("p").distinct().count() > 1


def test_positions_with_payload_columns_and_string_keys(spark):
    """Extra columns used only by the output (not by the counting pass) and
    string keys: the two passes must still agree on every row's partition."""
    df = spark.range(60000).select(
        F.concat(F.lit("k"), (F.col("id") % 37).cast("string")).alias("k"),
        (F.col("id") * 104729 % 60013).alias("v"), F.col("id").alias("u"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"))
    got = position_within(df, ["k"], ["v", "u"]).select("u", "pos", "payload")
    w = Window.partitionBy("k").orderBy("v", "u")
    want = df.select("u", F.row_number().over(w).alias("pos"), "payload")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    g = global_position(df, ["payload", "u"]).select("u", "pos")
    wg = df.select("u", F.row_number().over(Window.orderBy("payload", "u")).alias("pos"))
    assert g.exceptAll(wg).count() == 0
