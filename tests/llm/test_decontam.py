import re
from collections import Counter
from urllib.parse import urlparse

import pandas as pd
import pyarrow.parquet as pq
import pytest

from contentlake.llm import decontam
from contentlake.llm.common import worker_batches
from tests.llm.helpers import documents, empty, rows

ITEMS = "item_id bigint, text string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(data, items):
    windows = [(i, w[s:s + 13]) for i, t in items for w in [words(t)] if w for s in range(max(1, len(w) - 12))]
    out = []
    for row in data:
        w, hit, found = words(row[1]), set(), set()
        for item, win in windows:
            for p in range(len(w) - len(win) + 1):
                if w[p:p + len(win)] == win:
                    hit.update(range(p, p + len(win)))
                    found.add(str(item))
        out.append((row[0], len(w), len(hit), ",".join(sorted(found))))
    return Counter(out)


def _items(spark, items):
    return spark.createDataFrame(items, ITEMS).selectExpr("*", "1 AS id", "'w' AS window")


def test_against_brute_force(spark, monkeypatch):
    data = rows()
    mid = words(data[0][1])
    items = [(1, " ".join(mid[10:40])), (2, " ".join(mid[30:48]).upper()), (3, " ".join(words(data[3][1])[:5])), (3, None), (4, ""), (5, "!!"),
             (6, "É ñ"), (7, "é, ñ!"), (8, "ab" * 700), (2, " ".join(mid[30:48])), (9, "word that is nowhere"), (10, "x" * 199)]
    for blocks in (decontam.BLOCK_BYTES, 50):
        monkeypatch.setattr(decontam, "BLOCK_BYTES", blocks)
        monkeypatch.setattr(decontam, "SEGMENT_WORDS", 150)
        out = decontam.decontaminate(documents(spark, data, clash=True), _items(spark, items)).collect()
        assert Counter((r["doc_id"], r["n_words"], r["n_hit"], ",".join(r["item_ids"])) for r in out) == brute(data, items)
        assert all(sum(s["hi"] - s["lo"] for s in r["spans"]) == r["n_hit"] for r in out)


def test_windows_of_words_the_corpus_lacks_are_never_visited(spark):
    data = [(i, f"alpha beta w{i} gamma delta", "en", "s", 0) for i in range(50)]
    items = [(1, "beta w7 gamma"), (2, "beta w8 delta")] + [(i, f"alpha beta nowhere{i} gamma") for i in range(10, 900)]
    index = decontam.build_index(documents(spark, data))
    filed = decontam.filed_windows(index, [(str(i), t) for i, t in items])
    assert {t: [w for w, _ in ws] for t, ws in filed.items()} == {b"w7": [(b"beta", b"w7", b"gamma")], b"w8": [(b"beta", b"w8", b"delta")]}


def test_copies_of_a_benchmark_text_are_in_all_blocks(spark, monkeypatch):
    """A text in a third of all items: no block holds them all; the result names them all."""
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 300)
    items = [(i, "same words in a third of the items" if i % 3 == 0 else f"other text number {i}") for i in range(120)]
    blocks = list(decontam._blocks(_items(spark, items), "item_id", "text"))
    assert sum(map(len, blocks)) == 120 and max(map(len, blocks)) < 40
    data = [(1, "x same words in a third of the items y", "en", "s", 0), (2, "nothing", "en", "s", 0)]
    out = decontam.decontaminate(documents(spark, data), _items(spark, items)).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_hit"], ",".join(r["item_ids"])) for r in out) == brute(data, items)


def test_empty_tables(spark):
    assert decontam.decontaminate(empty(spark), _items(spark, [(1, "a b")])).count() == 0
    out = decontam.decontaminate(documents(spark), _items(spark, [])).collect()
    assert len(out) == len(rows()) and not any(r["n_hit"] for r in out)


def test_proximity(spark):
    data = [(1, "one two three four", "en", "s", 0), (2, "four x three y two z one", "en", "s", 0), (3, "one two three", "en", "s", 0),
            (4, "four " + "pad " * 30 + "one two three", "en", "s", 0)]
    index = decontam.build_index(documents(spark, data))
    near = decontam.proximity_matches(index, _items(spark, [(7, "one two three four")]), slop=6).collect()
    assert {r["doc_id"] for r in near} == {1, 2}


def test_a_task_holds_pieces_of_its_rows(spark, monkeypatch):
    """Batches of texts and of index rows, and the index's row groups, stay small however many rows a task has."""
    monkeypatch.setattr(decontam, "PIECE_BYTES", 100_000)
    monkeypatch.setattr(decontam, "SEGMENT_WORDS", 1_000)
    key, seen, kept, plain = "spark.sql.execution.arrow.maxBytesPerBatch", {}, {}, decontam.stage
    before = spark.conf.get(key)

    def largest(batches):
        for b in batches:
            yield pd.DataFrame({"n": [sum(len(v) for c in b for v in b[c] if isinstance(v, (str, bytes)))]})

    def staged(df, name, *args):
        sent = docs.select("text") if name == "index" else kept["index"].select("postings")
        seen[name] = sent.mapInPandas(largest, "n bigint").agg({"n": "max"}).first()[0]
        kept[name] = plain(df, name, *args)
        return kept[name]

    docs = documents(spark, [(i, " ".join(f"w{(i * 7 + k) % 5000}" for k in range(200)), "en", "s", 0) for i in range(2_000)]).coalesce(1)
    items = [(1, " ".join(f"w{k}" for k in range(70, 90)))]
    monkeypatch.setattr(decontam, "stage", staged)
    out = decontam.decontaminate(docs, _items(spark, items))
    assert out.count() == 2_000 and out.where("n_hit > 0").count() > 0
    assert 0 < seen["index"] < 200_000 and 0 < seen["hits"] < 200_000, seen
    files = [pq.ParquetFile(urlparse(f).path) for f in kept["index"].inputFiles()]
    groups = [f.metadata.row_group(i) for f in files for i in range(f.metadata.num_row_groups)]
    assert sum(f.metadata.num_rows for f in files) > 300 and max(g.total_byte_size for g in groups) < 300_000
    assert spark.conf.get(key) == before


def test_batch_size_is_put_back_after_a_failure(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    with pytest.raises(ZeroDivisionError), worker_batches(spark, 1_000):
        assert spark.conf.get(key) == "1000"
        1 / 0
    assert spark.conf.get(key) == before
