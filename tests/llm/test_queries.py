"""The registered queries without SQL, on a whole small table, held against plain recounts of their contracts."""

import re
import zlib
from collections import Counter, defaultdict

import pytest

from contentlake.llm.queries import QUERIES
from tests.llm.test_repeats import brute as repeats_by_brute_force

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    return {r["doc_id"]: (r["text"], r["source"]) for r in rows}


def test_op1_sharding(spark, texts):
    out = QUERIES["op1_sharding"](spark, SF_SMALL).collect()
    assert sorted(r["doc_id"] for r in out) == sorted(texts)
    for r in out:
        raw = (texts[r["doc_id"]][0] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 8, zlib.crc32(raw), "rows", None)
    slots = defaultdict(list)
    for r in out:
        slots[r["shard"]].append(r["slot"])
    assert set(slots) <= set(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(len(slots.get(s, [])) for s in range(24)) <= 1


def test_op2_token_counts(spark, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.no_truncation()
    library.no_padding()
    out = QUERIES["op2_token_counts"](spark, SF_SMALL).collect()
    assert sorted(r["doc_id"] for r in out) == sorted(texts)
    for r in out:
        text = texts[r["doc_id"]][0] or ""
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 512)


def targets(sizes):
    """The contract's targets, in fractions of all sizes, by resharing until no source is above twice its size."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, fixed = 1.5 * sum(sizes.values()), {}
    while True:
        open_ = [s for s in order if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        above = [s for s in open_ if share[s] > 2 * sizes[s]]
        if not above:
            return {**fixed, **share}
        fixed |= {s: 2.0 * sizes[s] for s in above}
        if len(fixed) == len(order):
            return fixed


def test_op3_mixing(spark, texts):
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, (t, _) in texts.items()}
    by_source = Counter()
    for i, (_, source) in texts.items():
        by_source[source] += size[i]
    want, taken = targets(by_source), Counter()
    out = QUERIES["op3_mixing"](spark, SF_SMALL).collect()
    assert sorted(r["doc_id"] for r in out) == sorted(texts)
    for r in out:
        source = texts[r["doc_id"]][1]
        assert (r["size"], r["source_size"]) == (size[r["doc_id"]], by_source[source])
        assert abs(r["target"] - want[source]) <= 1e-6 * want[source] + 1e-6
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[source] += r["taken"]
    largest = max(size.values())
    assert all(abs(taken[s] - want[s]) <= max(0.02 * want[s], largest) for s in want)


def test_op10_repeats(spark, texts):
    out = QUERIES["op10_repeats"](spark, SF_SMALL).collect()
    got = Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in out)
    assert got == repeats_by_brute_force([(i, t) for i, (t, _) in texts.items()])
