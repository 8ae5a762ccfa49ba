import random
import re

import numpy as np

from contentlake.llm import licenses
from contentlake.llm.queries import LICENSE_PHRASES, op12_licenses
from tests.llm.helpers import documents, empty, prose, rows

MIT = licenses.TEMPLATES[1][2]
NOTICE = "Released under the MIT License."


def split(text):
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))


def base(text):
    w = split(text)
    at = sorted((i, label) for label, p in LICENSE_PHRASES for i in range(len(w)) if w[i:i + len(p.split())] == p.split())
    places = [i for i, _ in at]
    return len(w), len(at), places[0] if at else None, places[-1] if at else None, sorted({x for _, x in at})


def every_place(index, text):
    """{label: best score} by scoring every place of every template, and key phrases by comparison of lists."""
    w = split(text)
    out = {}
    for (label, keys, _), (_, raw, t) in zip(index.templates, licenses.TEMPLATES):
        t, total = split(t), None
        weight = [index.idf[index.codes[x.encode()]] for x in t]
        total = sum(weight)
        for at in range(-len(t) - 2, len(w) + 2):
            get = lambda i: w[i] if 0 <= i < len(w) else None
            score = sum(g for p, (x, g) in enumerate(zip(t, weight)) if any(get(at + p + d) == x for d in range(-2, 3))) / total
            low, high = max(at - 2, 0), max(at + len(t) + 2, 0)
            if score >= licenses.SCORE and all(any(w[i:i + len(split(k))] == split(k) for i in range(low, high - len(split(k)) + 1)) for k in raw):
                out[label] = max(out.get(label, 0), min(score, 1.0))
    return out


def cases():
    r = random.Random(5)
    mit, gpl = MIT.split(), licenses.TEMPLATES[6][2].split()
    changed = mit[:20] + mit[21:40] + ["really"] + mit[40:]
    texts = [NOTICE, prose(r, 40) + ". " + NOTICE + " " + prose(r, 30) + NOTICE.upper(), " ".join(mit), " ".join(changed).title(),
             " ".join(mit[:15]), prose(r, 9) + " Licensed under the Apache License, Version 2.0. " + prose(r, 9), "Licensed under CC BY-NC 4.0.",
             "This work is licensed under the GNU General Public License, version 3.", " ".join(gpl), "the version of the license is public",
             "general public license version 3", "MIT license", "cc byé nc", "under the mit licensed", prose(r, 3000) + NOTICE, "the " * 500 + "license " * 300]
    return [(100 + i, t, "en", "s", len(t)) for i, t in enumerate(texts)]


def test_query_against_comparison_of_lists(spark, tmp_path):
    data = rows() + cases()
    documents(spark, data, clash=True).write.parquet(str(tmp_path / "documents.parquet"))
    out = op12_licenses(spark, str(tmp_path)).collect()
    assert len(out) == len(data)
    got = sorted(((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in out), key=str)
    want = sorted(((x[0], *base(x[1])[:4], ",".join(base(x[1])[4])) for x in data), key=str)
    assert got == want
    for r in out:
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1


def test_index_finds_every_place_that_scores(spark):
    data = cases()
    docs = documents(spark, data)
    vocabulary = sorted({w for _, keys, t in licenses.TEMPLATES for x in (t, *keys) for w in split(x)})
    counts, n = licenses.word_document_counts(docs, vocabulary)
    assert n == len(data) and counts["license"] == sum("license" in split(x[1]) for x in data)
    index = licenses.Index([], licenses.TEMPLATES, counts, n)
    out = licenses.scan_licenses(docs, [])
    for r in out.collect():
        text = next(x[1] for x in data if x[0] == r["id"])
        best = every_place(index, text)
        assert r["labels"] == sorted(best)
        assert np.isclose(r["score"], max(best.values(), default=0))
    by_id = {r["id"]: r["labels"] for r in out.collect()}
    assert by_id[102] == by_id[103] == ["mit"] and by_id[104] == [] and by_id[107] == by_id[108] == ["gpl-3"] and by_id[106] == ["cc-by-nc"]


def test_long_texts_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(licenses, "PIECE", 64)
    text = prose(random.Random(1), 500) + " " + "é" * 500 + " " + NOTICE + prose(random.Random(2), 200)
    index = licenses.Index(LICENSE_PHRASES, licenses.TEMPLATES, {}, 1)
    assert index.scan(text)[:5] == base(text)


def test_empty(spark):
    assert licenses.scan_licenses(empty(spark), LICENSE_PHRASES).collect() == []
