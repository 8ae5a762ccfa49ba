import hashlib
import random
from collections import Counter

import pytest

from contentlake.llm import repeats
from contentlake.llm.repeats import LENGTH, remove_repeats
from tests.llm.helpers import documents, empty, prose, rows


def brute(data):
    texts = [(d[0], (d[1] or "").encode()) for d in data]
    seen = Counter(t[p:p + LENGTH] for _, t in texts for p in range(len(t) - LENGTH + 1))
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for p in range(len(t) - LENGTH + 1):
            if seen[t[p:p + LENGTH]] > 1:
                gone[p:p + LENGTH] = b"\1" * LENGTH
        runs = sum(1 for p in range(len(t)) if gone[p] and (p == 0 or not gone[p - 1]))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((i, len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def check(spark, data):
    out = remove_repeats(documents(spark, data, clash=True), with_text=True).collect()
    assert Counter((r["id"], r["n_bytes"], r["n_removed"], len(r["spans"]), r["kept_sha256"]) for r in out) == brute(data)
    assert all(hashlib.sha256(bytes(r["kept"])).hexdigest() == r["kept_sha256"] for r in out)


def test_awkward_rows(spark):
    check(spark, rows())


@pytest.mark.parametrize("few", [64, 1])  # finished in place; by rounds of doubling
def test_passages_at_all_offsets(spark, monkeypatch, few):
    monkeypatch.setattr(repeats, "FEW", few)
    r = random.Random(8)
    passage = prose(r, 90)
    data = []
    for i in range(60):
        cut = passage[r.randrange(0, 60):][:r.choice([190, 199, 200, 201, 230, 300, 350])]
        data.append((i, prose(r, r.randint(0, 40)) + cut + prose(r, r.randint(0, 40)), "en", "s", 0))
    data.append((100, passage + "|" + passage[10:290], "en", "s", 0))  # within one text
    data.append((101, "é" * 300 + passage[:250], "en", "s", 0))
    data.append((102, "abc" * 150, "en", "s", 0))
    check(spark, data)


def test_small_pieces_hot_keys_and_periods(spark, monkeypatch):
    """A passage in a third of all rows, one-character and periodic texts; every bound small."""
    for name, value in {"FEW": 4, "PIECE_BYTES": 256, "PIECE_NODES": 3, "LEAST_HOT": 5, "HOT": 100, "BATCH_BYTES": 700}.items():
        monkeypatch.setattr(repeats, name, value)
    r = random.Random(9)
    passage = prose(r, 80)
    data = [(i, prose(r, r.randint(5, 120)) + (passage if i % 3 == 0 else "") + prose(r, 20), "en", "s", 0) for i in range(45)]
    data += [(100, "z" * 1500, "en", "s", 0), (101, "xy" * 600, "en", "s", 0), (102, "yx" * 300 + "q", "en", "s", 0), (103, "z" * 400 + prose(r, 300), "en", "s", 0)]
    check(spark, data)


def test_anchors_of_a_long_text_in_pieces(monkeypatch):
    text = (prose(random.Random(3), 2000) + "a" * 700 + "ab" * 500).encode()
    _, pos, rank = repeats.anchors([text])
    monkeypatch.setattr(repeats, "PIECE_BYTES", 333)
    pieces = [(p, k) for ps, ks in repeats.anchors_of(text) for p, k in zip(ps.tolist(), ks.tolist())]
    assert pieces == list(zip(pos.tolist(), rank.tolist()))


def test_empty(spark):
    assert remove_repeats(empty(spark)).count() == 0
