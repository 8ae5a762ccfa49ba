import random
import re
import zlib
from collections import Counter

from contentlake.llm import spelling
from contentlake.llm.queries import op11_spelling
from tests.llm.helpers import SCHEMA, documents, empty

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def edits(w, alphabet):
    out = {w[:i] + w[i + 1:] for i in range(len(w))}
    for c in alphabet:
        out |= {w[:i] + c + w[i:] for i in range(len(w) + 1)} | {w[:i] + c + w[i + 1:] for i in range(len(w))}
    return out - {w}


def groups(counts, ratio=5):
    alphabet = {c for w in counts for c in w}
    near = {w: edits(w, alphabet) & counts.keys() for w in counts}
    best = {w: min(near[w], key=lambda v: (-counts[v], v)) for w in counts if near[w]}
    form = {w: v for w, v in best.items() if counts[v] >= ratio * counts[w]}
    out = []
    for w in counts:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, counts[w], len(near[w]), counts[form[w]] if w in form else None))
    return sorted(out, key=str)


def corpus(data):
    counts = Counter()
    for doc_id, text, *_ in data:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % 199 == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def got(df):
    return sorted(((r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()), key=str)


def vocabulary(seed, n):
    r = random.Random(seed)
    counts = {}
    for _ in range(n):
        w = "".join(r.choice("abé") for _ in range(r.randint(6, 9)))
        counts[w] = r.choice([5, 5, 6, 30, 31, 200, 1200])
    counts |= {"x" * k: 5 ** (k - 5) for k in range(6, 12)}  # a chain of forms, one letter
    counts |= {"ab" * 40: 7, "ab" * 40 + "a": 40, "Àbcdefg": 9, "àbcdefg": 90}
    return counts


def run(spark, counts):
    return got(spelling.spelling_groups(spark.createDataFrame(list(counts.items()), "word string, n bigint")))


def test_groups_against_all_edits(spark):
    counts = vocabulary(3, 700)
    assert run(spark, counts) == groups(counts)


def test_blocks_and_halves_that_fill_several(spark, monkeypatch):
    monkeypatch.setattr(spelling, "BLOCK_CHARS", 2000)
    counts = vocabulary(4, 250) | {"prefix" + w: n for w, n in vocabulary(5, 120).items()}
    counts |= {w[:5] + c + w[6:]: n for (w, n), c in zip(list(counts.items()), "cdefghijklmnopqrstuvwxyzÞßçð")}  # letters of few words
    counts |= {"prefix" + c + "ab": 9 for c in "qjwvzßçüÿ"} | {"prefi" + c + "cb": 70 for c in "qjwvzßçüÿ"}
    assert run(spark, counts) == groups(counts)


def test_query_over_documents(spark, tmp_path):
    r = random.Random(7)
    stems = ["spelling", "spellin", "spelings", "straße", "Straßen", "ÉCLAIRS", "éclairs", "colours", "colour", "abc", "longer"]
    data = [(None if i == 9 else i % 300, None if i % 50 == 49 else " ".join(r.choice(stems) for _ in range(r.randint(0, 40))) + "-1x", "en", "s", 0)
            for i in range(400)]
    data += [(1000, "word" * 30_000 + " " + "tailed " * 9, "en", "s", 0)]
    documents(spark, data, clash=True).withColumnRenamed("size", "word").write.parquet(str(tmp_path / "documents.parquet"))
    assert got(op11_spelling(spark, str(tmp_path))) == groups(corpus(data))


def test_empty(spark):
    assert got(spelling.spelling_groups(spelling.corpus_words(empty(spark)))) == []
    lone = spark.createDataFrame([(1, "single " * 6, "en", "s", 1)], SCHEMA)
    assert [x[0] for x in got(spelling.spelling_groups(spelling.corpus_words(lone)))] == ["single"]
