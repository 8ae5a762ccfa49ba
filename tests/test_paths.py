"""The path language, restated from the reference's unit tests on one
in-memory document (values as in FIXTURES.md §1.1)."""

import json
import math

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from contentlake.functions import paths
from contentlake.functions.values import json_or_string

FILES = [
    {"name": "a", "mimeType": "text/plain", "digest": "abc", "length": 123},
    {"name": "b", "mimeType": "text/html", "digest": "def", "length": 456},
    {"name": "c", "mimeType": "application/pdf", "digest": "ghi", "length": 789},
    {"name": "d", "mimeType": "application/octet-stream", "digest": "jkl", "length": 101112},
    {"name": "e", "mimeType": "video/mp4", "digest": "mno", "length": 131415},
]
PROPS = {
    "sample:string": json.dumps("test"),
    "sample:bool": "true",
    "sample:int": "42",
    "sample:float": "2.7",
    "sample:double": repr(math.pi),
    "sample:array": json.dumps(["one", 2, {"key": "three", "value": 3}, [4, "four", 4.0, 4.0]]),
    "files:files": json.dumps(FILES),
}


@pytest.fixture(scope="module")
def doc(spark):
    rows = [("doc-1", "test.doc", "File", "project", False, k, v) for k, v in PROPS.items()]
    df = spark.createDataFrame(rows, "id string, name string, type string, state string, "
                                     "locked boolean, k string, v string")
    return (df.groupBy("id", "name", "type", "state", "locked")
              .agg(F.map_from_entries(F.collect_list(F.struct("k", F.parse_json("v"))))
                   .alias("properties")))


def ev(doc, path):
    return doc.select(paths.evaluate(path, doc.columns).alias("v")).first()["v"]


@pytest.mark.parametrize("path,expected", [
    ("", None), (" \t\n", None), ("id", "doc-1"), ("name", "test.doc"), ("locked", "false"),
    ("state", "project"), ("invalid", None),
])
def test_document_fields(doc, path, expected):
    assert ev(doc, path) == expected


def test_self_is_the_document(doc):
    assert json.loads(ev(doc, "."))["name"] == "test.doc"


@pytest.mark.parametrize("path,expected", [
    ("sample:string", "test"), ("sample:bool", "true"), ("sample:int", "42"),
    ("sample:float", "2.7"), ("properties/sample:int", "42"), ("missing:value", None),
])
def test_properties(doc, path, expected):
    assert ev(doc, path) == expected


def test_double(doc):
    assert float(ev(doc, "sample:double")) == pytest.approx(math.pi)


@pytest.mark.parametrize("path,expected", [
    ("sample:array/1", "one"), ("sample:array/2", "2"), ("sample:array/3/key", "three"),
    ("sample:array/4/2", "four"), ("sample:array/0", None),
])
def test_arrays_are_one_based(doc, path, expected):
    assert ev(doc, path) == expected


def test_inner_array(doc):
    assert json.loads(ev(doc, "sample:array/4")) == [4, "four", 4, 4]


def test_negative_index_is_len_minus_k(doc):
    # -1 -> len-1 = 3 (1-based): the third element
    assert json.loads(ev(doc, "sample:array/-1")) == {"key": "three", "value": 3}


def test_out_of_range_is_a_row_error(doc):
    c = paths.compile_path("sample:array/9", doc.columns)
    row = doc.select(c.error.alias("e"), paths.render(c).alias("v")).first()
    assert row["e"] == paths.OUT_OF_RANGE and row["v"] is None


def test_all_files(doc):
    assert [f["name"] for f in json.loads(ev(doc, "files:files"))] == list("abcde")


def test_predicate_filter(doc):
    got = json.loads(ev(doc, "files:files/[length>1000]"))
    assert [f["name"] for f in got] == ["d", "e"]


def test_predicate_single_match_is_bare_value(doc):
    assert json.loads(ev(doc, "files:files/[length>110000]"))["name"] == "e"


def test_predicate_no_match_is_null(doc):
    assert ev(doc, "files:files/[length>99999999]") is None


def test_member_of_matches(doc):
    assert json.loads(ev(doc, "files:files/[length>1000]/name")) == ["d", "e"]


@pytest.mark.parametrize("path", ["properties/sample:int/test:int", "sample:int/nested:int"])
def test_schema_in_nested_context_is_rejected(path):
    with pytest.raises(ValueError):
        paths.compile_path(path, ["id"])


def test_missing_path_is_an_error():
    with pytest.raises(ValueError):
        paths.compile_path(None, ["id"])


def test_slash_inside_predicate_is_rejected():
    with pytest.raises(ValueError):
        paths.parse("files:files/[name='a/b']")


def test_json_or_string(spark):
    df = spark.createDataFrame([("12",), ("x y",), ("true",), (None,), ('{"a":1}',)], "v string")
    got = [r[0] for r in df.select(F.schema_of_variant(json_or_string(F.col("v")))).collect()]
    assert got[0] == "BIGINT" and got[1] == "STRING" and got[2] == "BOOLEAN"
    assert got[3] is None and got[4].startswith("OBJECT")


STEPS = st.sampled_from(["sample:array", "files:files", "properties", "id", "name", ".",
                         "1", "2", "-1", "0", "9", "key", "[length>1000]", "[.>1]",
                         "sample:int", "missing:x", "name/x"])


@settings(max_examples=1, deadline=None)
@given(st.lists(st.lists(STEPS, min_size=1, max_size=4), min_size=30, max_size=30))
def test_any_path_compiles_or_is_rejected_and_never_fails_a_job(doc, step_lists):
    """Random step sequences: compilation either succeeds or raises
    ValueError, and every compiled path evaluates without a runtime error
    (data problems come back as the row's error column)."""
    cols = []
    for i, steps in enumerate(step_lists):
        try:
            c = paths.compile_path("/".join(steps), doc.columns)
        except ValueError:
            continue
        cols += [paths.render(c).alias(f"v{i}"), c.error.alias(f"e{i}")]
    if cols:
        doc.select(*cols).collect()


ROW_PATHS = ["dc:title", "n:o", "n:o/k/z", "n:o/l/2/b", "n:o/l/-1", "n:o/l/0", "n:o/l/9", "n:o/l/-9", "n:o/l/[a>1]/b", "n:o/v/[.>0.2]",
             "n:o/v/[.>5]", "n:o/l/[b='q']", "id", "title/x", "nope", ".", "properties/dc:title", "dc:title/a:b", "/dc:title/", "a//b",
             "n:o/l/[a", "n:o/l/[a~1]", "n:o/l/[a>x]", "", "e:m/1", "n:o/l/[a>0]/a", "dc:t\u00eftle", "title/dc:x", "n:o/./k", "n:o/l/99999999999", "n:o/l/-99999999999",
             "n:o/l/999999999999999999999999", "n:o/l/+1/b", "n:o/l/\uff12", "n:o/l/\u0662/b", "n:o/k/99999999999", "n:o/l/[\u00e9>1]", "n:o/l/[a>\u0661]", "n:o/l/[a>1_0]", "n:o/l/[a>1d]", "n:o/l/[a>NaN]",
             "n:o/v/[.>.2]", "n:o/v/[.>2e-1]", "n:o/v/[.>+0.2]",
             "n:o/l/[a\u00e9>1]/b"]


def test_paths_per_row_follow_the_compiled_ones(spark):
    cols = ["id", "title", "properties"]
    docs = spark.sql("""select 'a' id, 'T' title, map('dc:title', parse_json('"x"'), 'n:o', parse_json(
        '{"k":{"z":5},"l":[{"a":1,"b":"q"},{"a":3,"b":"r"},{"a":null}],"v":[0.1,0.5,0.9]}'), 'e:m', parse_json('[]')) properties""")
    rows = docs.withColumn("p", F.explode(F.lit(ROW_PATHS)))
    got = {r["p"]: (r["v"], r["e"]) for r in paths.evaluate_per_row(rows, F.col("p"), "v", "e", cols).collect()}
    valid = {}
    for text in ROW_PATHS:
        try:
            valid[text] = paths.compile_path(text, cols)
        except ValueError:
            assert got[text][0] is None and got[text][1]
    out = docs.select(*[F.struct(paths.render(c), c.error).alias(f"c{i}") for i, c in enumerate(valid.values())]).first()
    assert [got[t] for t in valid] == [tuple(x) for x in out]
