"""Argument helpers: split rules (property-based against a plain model of
the reference's splitting), templates, resolution order, attribute merge."""

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from contentlake.functions import args


def model_split(text: str) -> list[str]:
    # String.split(",") with limit 0: no separator -> the whole text;
    # otherwise split and drop trailing empty strings
    if "," not in text:
        return [text]
    parts = text.split(",")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


TEXTS = st.text(alphabet=st.sampled_from(["a", "b", ",", " ", "é"]), max_size=12)


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_split_params_text_matches_model(text):
    assert args.split_params_text(text) == model_split(text)


@settings(max_examples=1, deadline=None)
@given(st.lists(TEXTS, min_size=40, max_size=40))
def test_split_params_column_matches_model(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r["i"]: list(r["p"]) for r in df.select("i", args.split_params(F.col("t")).alias("p")).collect()}
    assert all(got[i] == model_split(t) for i, t in enumerate(texts))


def test_template_and_resolution_order(spark):
    df = spark.createDataFrame([({"nx-path": "/a", "nx-name": "n"},), ({},)],
                               "attributes map<string,string>")
    rows = df.select(
        args.template("${nx-path}/x_${nx-name}").alias("t"),
        args.resolve(None, "nx-path", "/default").alias("r1"),
        args.resolve("cfg-${nx-name}", "nx-path").alias("r2")).collect()
    assert rows[0]["t"] == "/a/x_n" and rows[1]["t"] == "/x_"
    assert rows[0]["r1"] == "/a" and rows[1]["r1"] == "/default"
    assert rows[0]["r2"] == "cfg-n" and rows[1]["r2"] == "cfg-"


def test_merge_overwrites_parent_keys(spark):
    df = spark.createDataFrame([({"a": "1", "b": "2"}, {"b": "3", "c": "4"})],
                               "p map<string,string>, n map<string,string>")
    merged = df.select(args.merge_attributes(F.col("p"), F.col("n")).alias("m")).first()["m"]
    assert merged == {"a": "1", "b": "3", "c": "4"}
