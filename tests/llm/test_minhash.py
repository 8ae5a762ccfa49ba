import random
import re

from contentlake.llm import minhash
from contentlake.llm.components import components
from tests.llm.helpers import documents, empty, prose, rows
from tests.llm.test_decontam import LOWER


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(data):
    sets = [(d[0], shingles(d[1])) for d in data if d[0] is not None]
    ids = sorted({i for i, _ in sets})
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (a, s) in enumerate(sets):
        for b, t in sets[n + 1:]:
            if s and t and 100 * len(s & t) >= 75 * len(s | t):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return sorted((i, len(s), find(i)) for i, s in sets)


def check(spark, data):
    members, links = minhash.near_duplicates(documents(spark, data, clash=True))
    got = members.collect()
    assert sorted((r["id"], r["n_shingles"], r["component"]) for r in got if r["id"] is not None) == brute(data)
    assert all(r["component"] is None for r in got if r["id"] is None) and len(got) == len(data)
    return links


def test_awkward_rows(spark):
    data = [d for d in rows() if d[0] != 16 or len(d[1]) > 1000]
    check(spark, data)


def test_families_of_near_copies(spark):
    r = random.Random(2)
    data, n = [], 0
    for _ in range(12):
        words = prose(r, r.choice([30, 60, 150])).split(" ")
        for _ in range(r.choice([1, 2, 5, 25])):
            copy = list(words)
            for _ in range(r.choice([0, 1, 1, 2, 3])):
                copy[r.randrange(len(copy))] = prose(r, 1)
            data.append((n, " ".join(copy), "en", "s", 0))
            n += 1
    links = check(spark, data)
    assert links.where("a >= b").count() == 0


def test_signatures_estimate_similarity():
    r = random.Random(4)
    words = prose(r, 400).split(" ")
    sets = minhash.shingle_sets([" ".join(words), " ".join(words[:350] + prose(r, 50).split(" "))])
    sig = minhash.signatures(sets)
    true = len(set(sets[0]) & set(sets[1])) / len(set(sets[0]) | set(sets[1]))
    assert abs((sig[0] == sig[1]).mean() - true) < 0.2


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (300, 299)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 299: 299, 300: 299}


def test_empty(spark):
    members, links = minhash.near_duplicates(empty(spark))
    assert members.count() == 0 and links.count() == 0


def test_pairs_at_the_threshold_with_few_agreeing_coordinates(spark):
    """Two pairs at exactly 0.75 (6 of 8 shingles) that agree in 27 and 29 of 64 coordinates."""
    data = []
    for n, first in enumerate((5101207, 6170431)):
        for i in (0, 1):
            data.append((2 * n + i, " ".join(f"w{j}" for j in range(first + i, first + i + 11)), "en", "s", 0))
    check(spark, data)
