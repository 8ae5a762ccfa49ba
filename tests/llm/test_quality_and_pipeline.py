import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from contentlake.llm.quality import classify
from tests.conftest import SF_ORACLE, SF_SMALL
from tests.llm.helpers import documents, empty, rows
from tests.llm.test_decontam import words
from tests.llm.test_minhash import shingles

LABELS = "doc_id bigint, quality int, toxic int"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    labels = spark.read.parquet(f"{SF_ORACLE}/labels.parquet")
    known = labels.where("doc_id % 4 <> 0")
    out = classify(docs, known, keep_text=False).join(labels.where("doc_id % 4 = 0"), "doc_id").toPandas()
    clean, poor, toxic = (out[(out.quality == q) & (out.toxic == t)] for q, t in ((1, 0), (0, 0), (1, 1)))
    assert clean.accepted.mean() > 0.95 and (~poor.accepted).mean() > 0.8 and (~toxic.accepted).mean() > 0.5


def test_sparse_sites_shrink_to_their_parents(spark):
    from contentlake.llm.quality import site_priors

    data = [("big", "p", 5.0, -9.0)] * 60 + [("big", "q", -5.0, -9.0)] * 60 + [("small", "p", 5.0, -9.0)] + [("mid", None, -5.0, -9.0)] * 40 + [(None, "p", -5.0, -9.0)]
    df = spark.createDataFrame(data, "host string, path string, evidence_low double, evidence_toxic double")
    got = {(r["host"], r["path"]): r["prior_low"] for r in site_priors(df, "host", "path").collect()}
    assert set(got) == {("big", "p"), ("big", "q"), ("small", "p"), ("mid", None), (None, "p")}
    assert got["big", "p"] > 0.7 > 0.3 > got["big", "q"] and got["mid", None] < 0.3
    assert got["small", "p"] < got["big", "p"]


@pytest.mark.parametrize("marks", [[], [(0, 1, 0), (3, None, 0), (None, 0, 1)], [(0, 1, 0), (3, 0, 1), (3, 0, 1), (4, 1, 0), (8, 1, 1)]])
def test_awkward_rows_and_few_labels(spark, marks):
    docs = documents(spark, clash=True)
    out = classify(docs, spark.createDataFrame(marks, LABELS))
    assert out.count() == len(rows()) and set(docs.columns) < set(out.columns)
    assert out.where("accepted IS NULL OR p_low NOT BETWEEN 0 AND 1 OR p_toxic NOT BETWEEN 0 AND 1").count() == 0
    assert classify(empty(spark), spark.createDataFrame(marks, LABELS)).count() == 0


def test_pipeline_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    names, text, kept = [n for n, _ in corpus_pipeline.STAGES], {}, None
    assert names == ["quality", "dedup", "decontaminate", "mix", "shard"]
    windows = [w[i:i + 13] for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect() for w in [words(r["text"])] if w for i in range(max(1, len(w) - 12))]
    phrases = {" ".join(w) for w in windows}
    for name, step in corpus_pipeline.STAGES:
        step(spark, docs, SF_SMALL).write.parquet(str(tmp_path / name))
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        columns, docs = docs.columns, spark.read.parquet(str(tmp_path / name))
        after = docs.collect()
        assert docs.columns == columns + (["shard", "slot"] if name == "shard" else [])
        ids = [r["doc_id"] for r in after]
        assert all(before[r["doc_id"]] == r["text"] for r in after)
        if name == "quality":
            labels = {r["doc_id"]: (r["quality"], r["toxic"]) for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
            clean = [i for i in before if labels.get(i) == (1, 0)]
            assert sum(i in set(ids) for i in clean) >= 0.9 * len(clean) and len(ids) < len(before)
        if name == "dedup":
            sets = {i: shingles(t) for i, t in before.items()}
            left = set(ids)
            assert len(ids) == len(left)
            for i in set(before) - left:
                assert any(100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]) for j in before if j != i)
            for i in left:
                assert not sets[i] or not any(j < i and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]) for j in left)
        if name == "decontaminate":
            for i, t in before.items():
                w, hit = words(t), set()
                for p in range(len(w)):
                    for n in {len(x) for x in windows}:
                        if p + n <= len(w) and " ".join(w[p:p + n]) in phrases:
                            hit.update(range(p, p + n))
                assert (i in set(ids)) == (not (hit and 20 * len(hit) >= len(w)))
        if name == "mix":
            assert set(ids) <= set(before) and max(map(ids.count, set(ids))) <= 2
        if name == "shard":
            assert sorted(ids) == sorted(kept)
            sizes = [r["count"] for r in docs.groupBy("shard").count().collect()]
            assert max(sizes) - min(sizes) <= 1
        kept = ids


#: Extra columns named like what the operators and stages use inside.
EXTRA = ["p_low", "p_toxic", "accepted", "evidence_low", "prior_toxic", "_copies", "_copy", "_pipeline_row", "component", "id", "first", "n", "Shard", "slot", "a.b"]


def test_pipeline_stages_take_awkward_rows_and_any_extra_names(spark):
    clash = [c for c in documents(spark, clash=True).columns if c not in corpus_pipeline.OWN and c not in EXTRA]
    docs = documents(spark).select("*", *[F.lit(None).cast("string").alias(c) for c in clash], *[
        F.concat(F.lit(f"{c} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(c) for c in EXTRA])
    for name, step in corpus_pipeline.STAGES:
        out = step(spark, docs, SF_SMALL)
        gone = ["Shard", "slot"] if name == "shard" else []     # written anew
        assert out.columns == [c for c in docs.columns if c not in gone] + (["shard", "slot"] if gone else [])
        got = out.collect()
        assert len(got) <= 2 * len(rows())
        for r in got:
            assert all(r[c] == f"{c} of {'none' if r['doc_id'] is None else r['doc_id']}" for c in EXTRA if c not in gone)
        step(spark, empty(spark), SF_SMALL).count()
