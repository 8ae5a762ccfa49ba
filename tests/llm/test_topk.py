import math
import random

from pyspark.sql import functions as F

from contentlake.llm import topk

SCHEMA = "vec_id bigint, embedding array<float>"


def brute(data, k=10):
    vecs = [(i, [math.floor(1024.0 * x) for x in v]) for i, v in data
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, x in {(i, tuple(v)) for i, v in vecs if i % 100 == 0}:
        scores = sorted((-max(-1 << 63, min((1 << 63) - 1, sum(a * b for a, b in zip(x, y)))), i) for i, y in vecs if i != q and len(y) == len(x))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def check(spark, data, **kw):
    df = spark.createDataFrame(data, SCHEMA).repartition(4).selectExpr("*", "1 AS id", "'x' AS v", "0 AS rank")
    out = topk.top_k(df, F.col("id") % 100 == 0, **kw)
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in out.collect()) == brute(data, **kw)


def test_against_brute_force(spark, monkeypatch):
    r = random.Random(1)
    import struct
    f32 = lambda x: struct.unpack("f", struct.pack("f", x))[0]
    centres = [[r.gauss(0, 1) for _ in range(20)] for _ in range(6)]
    data = [(i, [f32(c + r.gauss(0, 0.2)) for c in r.choice(centres)]) for i in range(600)]
    monkeypatch.setattr(topk, "CHUNK", 50)
    monkeypatch.setattr(topk, "SEED_ROWS", 120)
    check(spark, data)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 2)
    check(spark, data, k=3)


def test_awkward_vectors(spark):
    data = [(0, [1.0, 0.0]), (100, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5]), (3, None), (4, [None, 1.0]), (5, [float("nan"), 1.0]),
            (6, [float("inf"), 0.0]), (7, [1.0, 2.0, 3.0]), (200, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (8, []), (300, []), (2, [0.5, 0.5]),
            (400, None), (9, [-1.0, -1.0]), (10, [3e7, 1.0]), (500, [2e7, -1.0])]
    check(spark, data)
    check(spark, [])
