import math
import random

from pyspark.sql import functions as F

from contentlake.llm import negatives

SCHEMA = "vec_id bigint, embedding array<double>, label int"
LONG = (1 << 63) - 1


def brute(data, n_positives=5, n_negatives=10):
    clip = lambda s: max(-LONG - 1, min(LONG, s))
    rows = [(i, label, tuple(clip(math.floor(256 * x)) for x in v)) for i, v, label in data if i is not None and v is not None
            and label is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, label, x in {r for r in rows if r[0] % 100 == 0}:
        scored = [(-clip(sum(p * q for p, q in zip(x, y))), i, other) for i, other, y in rows if i != a and len(y) == len(x)]
        for ps, p in sorted((s, i) for s, i, other in scored if other == label)[:n_positives]:
            inside = sorted((s, i) for s, i, other in scored if other != label and 30 * -ps <= 100 * -s <= 90 * -ps)
            out += [(a, p, k + 1, i, -ps, -s) for k, (s, i) in enumerate(inside[:n_negatives])]
    return sorted(out)


def check(spark, data):
    df = spark.createDataFrame(data, SCHEMA).repartition(4).selectExpr("*", "1 AS id", "'x' AS v", "0 AS leaf", "0 AS a")
    out = negatives.hard_negatives(df, F.col("id") % 100 == 0)
    assert sorted(tuple(r) for r in out.collect()) == brute(data)


def clustered(n, seed=1, dim=12):
    r = random.Random(seed)
    centres = [[r.gauss(0, 1) for _ in range(dim)] for _ in range(10)]
    return [(i, [c + r.gauss(0, 0.4) for c in centres[i % 10]], r.choice([i % 10, i % 10, i % 3])) for i in range(n)]


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(negatives, "SAMPLE", 300)
    monkeypatch.setattr(negatives, "LEAF", 20)
    monkeypatch.setattr(negatives, "CHUNK", 64)
    monkeypatch.setattr(negatives, "BLOCK", 2)
    check(spark, clustered(900))


def test_leaves_are_eliminated(spark, monkeypatch):
    """Far groups of vectors: an anchor asks for few of the leaves."""
    r = random.Random(2)
    data = [(i, [(5.0 if j == i % 6 else 0.0) + r.gauss(0, 0.05) for j in range(6)], i % 2) for i in range(600)]
    asked = []
    whole = negatives._Index.surviving

    def counted(self, *args):
        for leaf, want in whole(self, *args):
            asked.append(want.mean())
            yield leaf, want

    rows = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in data]
    import numpy as np
    import pandas as pd
    frame = pd.DataFrame({"id": [x[0] for x in rows], "label": [x[2] for x in rows], "v": [np.array(x[1], float) for x in rows]})
    index = negatives._Index(frame, {6: max(float(sum(c * c for c in x[1])) for x in rows)})

    def seen(node, j, d):
        node.low[:, j], node.high[:, j] = np.minimum(node.low[:, j], d.min(axis=0)), np.maximum(node.high[:, j], d.max(axis=0))

    index.leaves(frame, seen)
    q = np.stack(frame["v"][:100])
    best = (q @ np.stack(frame["v"]).T).max(axis=1).astype(int)
    windows = np.stack([best // 2, best], axis=1)[:, None, :]
    list(counted(index, 6, q, windows))
    assert len(asked) > 10 and sum(asked) / len(asked) < 0.4
    check(spark, data)


def test_awkward_vectors(spark):
    v = [0.5, 0.25, 0.0]
    data = [(0, v, 1), (1, v, 1), (2, v, 2), (3, None, 1), (4, [None, 1.0, 1.0], 1), (5, [float("nan"), 1.0, 0.0], 1), (6, [float("inf"), 0.0, 0.0], 2),
            (7, [0.2, 0.2, 0.2], None), (None, v, 1), (8, [0.4, 0.2, 0.0], 2), (9, [0.4, 0.2, 0.0], 2), (9, [0.4, 0.2, 0.0], 2), (10, [0.3, 0.1, 0.0], 3),
            (100, v, 1), (100, v, 1), (200, [1.0, 2.0], 1), (11, [1.0, 1.0], 1), (12, [0.5, 0.5], 2), (300, [], 1), (13, [], 1), (14, [], 2),
            (400, [-0.5, 0.0, 0.0], 4), (15, [0.5, 0.0, 0.0], 4), (500, [3e16, 0.0, 1.0, 0.0], 1), (16, [3e16, 1.0, 1.0, 0.0], 1), (17, [1e16, 1.0, 1.0, 0.0], 2)]
    check(spark, data)
    check(spark, [])


def test_one_vector_in_a_third_of_all_rows(spark, monkeypatch):
    monkeypatch.setattr(negatives, "CHUNK", 50)
    data = clustered(400, seed=3) + [(1000 + i, [0.1] * 12, i % 2) for i in range(200)]
    check(spark, data)
