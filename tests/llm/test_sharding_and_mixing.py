import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from contentlake.llm.mixing import mix_sources
from contentlake.llm.sharding import shard_documents
from tests.llm.helpers import documents, empty, prose, rows



@pytest.mark.parametrize("k", [1, 5, 24])
def test_shards_are_even_gapless_and_complete(spark, k):
    out = shard_documents(documents(spark, clash=True), n_shards=k).collect()
    data = rows()
    assert Counter(r["id"] for r in out) == Counter(r[0] for r in data)
    sizes = Counter(r["shard"] for r in out)
    assert set(sizes) <= set(range(k)) and max(sizes.values()) - min(sizes.get(s, 0) for s in range(k)) <= 1
    for s in sizes:
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(sizes[s]))
    expected = Counter((r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in data)
    assert Counter((r["id"], r["size"], r["text_crc32"]) for r in out) == expected


def test_copies_share_a_shard_and_a_hot_group_is_split(spark):
    r = random.Random(3)
    data = [(i, f"hot {prose(random.Random(0), 5)}", "en", "s", 1) for i in range(200)]
    data += [(200 + i, f"pair {i // 2}", "en", "s", 1) for i in range(200)]
    data += [(400 + i, f"single {i} {prose(r, 3)}", "en", "s", 1) for i in range(200)]
    out = {row["id"]: row["shard"] for row in shard_documents(documents(spark, data), n_shards=6).collect()}
    counts = Counter(out.values())
    assert set(counts.values()) == {100}
    cut = sum(out[200 + 2 * i] != out[201 + 2 * i] for i in range(100))
    assert cut <= 10
    assert max(Counter(out[i] for i in range(200)).values()) <= 100


def test_a_hot_group_fills_a_shard_and_others_are_joined(spark):
    """A third of the rows are one text (two shards' worth), the others copies in eights."""
    data = [(i, "hot", "en", "s", 1) for i in range(480)]
    data += [(480 + i, f"eight {i // 8}", "en", "s", 1) for i in range(480)]
    data += [(960 + i, f"single {i}", "en", "s", 1) for i in range(480)]
    out = {row["id"]: row["shard"] for row in shard_documents(documents(spark, data), n_shards=6).collect()}
    assert set(Counter(out.values()).values()) == {240}
    hot = max(Counter(out[i] for i in range(480)).values())
    cut = sum(8 - max(Counter(out[480 + 8 * g + j] for j in range(8)).values()) for g in range(60))
    assert hot >= 220 and cut <= 5, (hot, cut)


def test_empty_tables(spark):
    assert shard_documents(empty(spark)).count() == 0
    assert mix_sources(empty(spark)).count() == 0


def _targets(data):
    size = defaultdict(int)
    for d in data:
        size[d[3]] += len(re.findall(r"[^\x20\x09-\x0D]+", d[1] or ""))
    names = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, full = 1.5 * sum(size.values()), set()
    while True:
        rest = total - sum(2 * size[s] for s in full)
        open_ = sum(weight[s] for s in names if s not in full) or 1
        target = {s: 2 * size[s] if s in full else rest * weight[s] / open_ for s in names}
        over = {s for s in names if s not in full and target[s] > 2 * size[s]}
        if not over:
            return size, target
        full |= over


def test_mix_meets_targets(spark):
    r = random.Random(5)
    data = [(i, prose(r, r.choice([1, 5, 30, 100, 400])), "en", r.choice(["a", "b", "é", "Z", None, "a"]), 0) for i in range(400)]
    out = mix_sources(documents(spark, data, clash=True)).collect()
    size, target = _targets(data)
    source, taken = {d[0]: d[3] for d in data}, defaultdict(int)
    assert len(out) == len(data)
    for row in out:
        s = source[row["id"]]
        assert row["taken"] == row["copies"] * row["size"] and 0 <= row["copies"] <= 2
        assert row["source_size"] == size[s] and row["target"] == pytest.approx(target[s])
        taken[s] += row["taken"]
    for s, t in target.items():
        assert abs(taken[s] - t) <= 0.02 * t + 5
    again = {row["id"]: row["copies"] for row in mix_sources(documents(spark, data)).collect()}
    assert again == {row["id"]: row["copies"] for row in out}


def test_mix_of_awkward_rows(spark):
    out = mix_sources(documents(spark, clash=True)).collect()
    _, target = _targets(rows())
    assert Counter(r["id"] for r in out) == Counter(r[0] for r in rows())
    assert all(r["taken"] <= 2 * r["size"] for r in out)
    assert {round(r["target"], 6) for r in out} == {round(t, 6) for t in target.values()}
