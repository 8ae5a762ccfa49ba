"""Benchmark decontamination over a distributed positional inverted index.

The index is partitioned by document: a task writes segments of about
``SEGMENT_WORDS`` words, one row each, holding the segment's documents and,
term by term, the ascending positions of the term (words of a segment are
numbered on, with a gap after every document). Benchmark windows are filed under
their rarest term of the whole corpus; a segment looks up those whose term it has: the
list of the segment's rarest term of a window, shifted by the term's
place in the window, is intersected with the shifted lists of the next rarest
ones until it is empty or all terms agree. No posting is ever shuffled, a
frequent term costs only its list in each segment, windows of words that the corpus
lacks cost nothing, and whole texts are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contentlake.llm.common import stage, worker_batches

#: Words, on lower-cased UTF-8 bytes (bytes from 0x80 on belong to words).
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WINDOW = 13
SEGMENT_WORDS = 500_000
#: Texts and index rows go to Python workers in batches of about so many bytes, and the
#: index lies in row groups of as many: what a task holds doesn't grow with its rows.
PIECE_BYTES = 4 << 20
#: Benchmark text that is sent to every task at once; a larger benchmark goes in blocks,
#: each of which reads the index once.
BLOCK_BYTES = 16 << 20

INDEX_SCHEMA = ("segment string, doc_ids array<bigint>, n_words array<int>, terms array<binary>, "
                "counts array<int>, postings binary")
HIT_SCHEMA = "segment string, ord int, item_ids array<string>, spans array<struct<lo:int,hi:int>>"
NEAR_SCHEMA = "doc_id bigint, item_id string, window int, at int"


def words(text: str | None) -> list[bytes]:
    return WORD.findall(text.encode("utf-8", "replace").lower()) if text else []


def _segment(name: str, doc_ids: list, lengths: list[int], tokens: list[np.ndarray], vocab: dict) -> dict:
    """One index row: the positions of every term, ascending, as steps."""
    gap = np.array([-1], dtype=np.int32)
    ids = np.concatenate([x for t in tokens for x in (t, gap)])
    at = np.flatnonzero(ids >= 0).astype(np.int32)
    own = ids[at]
    # by term, then by place: one number to sort
    order = np.sort((own.astype(np.int64) << 32) | at)
    own, at = (order >> 32).astype(np.int32), order.astype(np.int32)
    present, first, counts = np.unique(own, return_index=True, return_counts=True)
    steps = np.diff(at, prepend=np.int32(0))
    steps[first] = at[first]
    spelled = list(vocab)
    return {"segment": name, "doc_ids": doc_ids, "n_words": lengths, "terms": [spelled[i] for i in present],
            "counts": counts.astype(np.int32), "postings": steps.astype("<i4").tobytes()}


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Positional inverted index of ``docs`` (see ``INDEX_SCHEMA``): postings of all words.

    Null and empty texts are documents without words. A text is never split, so
    a segment may be longer than ``SEGMENT_WORDS`` by one document. Null and
    repeated ids stay separate entries.
    """

    def segments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get()
        part, n = task.partitionId() if task else 0, 0
        vocab = _Numbers()
        doc_ids, lengths, tokens, size = [], [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch["id"], batch["text"]):
                found = words(text)
                ids = np.fromiter(map(vocab.__getitem__, found), np.int32, len(found))
                doc_ids.append(None if pd.isna(doc_id) else int(doc_id))
                lengths.append(len(found))
                tokens.append(ids)
                size += len(found) + 1
                if size >= SEGMENT_WORDS:
                    yield pd.DataFrame([_segment(f"{part}-{n}", doc_ids, lengths, tokens, vocab)])
                    doc_ids, lengths, tokens, size, n = [], [], [], 0, n + 1
                    vocab = _Numbers()
        if doc_ids:
            yield pd.DataFrame([_segment(f"{part}-{n}", doc_ids, lengths, tokens, vocab)])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(segments, INDEX_SCHEMA)


class _Numbers(dict):
    """Words numbered as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class _Segment:
    """Posting lists of one index row, unpacked when they are asked for."""

    def __init__(self, row) -> None:
        self.starts = np.concatenate([[0], np.cumsum(row.counts)]).astype(np.int64)
        self.steps = np.frombuffer(row.postings, dtype="<i4")
        self.terms = {t: i for i, t in enumerate(map(bytes, row.terms))}
        self.unpacked: dict[bytes, np.ndarray] = {}
        self.begin = np.concatenate([[0], np.cumsum(np.asarray(row.n_words, dtype=np.int64) + 1)])

    def list_of(self, term: bytes) -> np.ndarray | None:
        got = self.unpacked.get(term)
        if got is None and (i := self.terms.get(term)) is not None:
            got = self.unpacked[term] = np.cumsum(self.steps[self.starts[i]:self.starts[i + 1]])
        return got

    def phrase(self, window: tuple[bytes, ...]) -> np.ndarray:
        """Positions at which the window's words stand in a row."""
        if not all(map(self.terms.__contains__, window)):
            return np.empty(0, np.int64)
        lists = []
        for place, term in enumerate(window):
            found = self.list_of(term)
            lists.append((len(found), place, found))
        lists.sort(key=lambda x: x[0])
        starts = lists[0][2] - lists[0][1]
        for n, place, found in lists[1:]:
            if not len(starts):
                break
            want = starts + place
            at = np.searchsorted(found, want)
            starts = starts[(at < n) & (found[np.minimum(at, n - 1)] == want)]
        return starts

    def near(self, window: tuple[bytes, ...], slop: int) -> np.ndarray:
        """Positions of the window's rarest term that have every other term of
        the window, in any order, at most ``slop`` words away in the same document."""
        lists = [self.list_of(t) for t in set(window)]
        if any(x is None for x in lists):
            return np.empty(0, np.int64)
        lists.sort(key=len)
        at = lists[0]
        for found in lists[1:]:
            doc = np.searchsorted(self.begin, at, "right")
            lo, hi = np.maximum(at - slop, self.begin[doc - 1]), np.minimum(at + slop, self.begin[doc] - 2)
            at = at[np.searchsorted(found, hi, "right") > np.searchsorted(found, lo, "left")]
        return at


def item_windows(rows: list) -> dict[tuple[bytes, ...], list[str]]:
    """Windows of ``WINDOW`` words (a shorter item is one window) and the items
    that have them; ``rows``: (item_id, text)."""
    found: dict[tuple[bytes, ...], list[str]] = {}
    for item_id, text in rows:
        w = words(text)
        for i in range(max(1, len(w) - WINDOW + 1) if w else 0):
            items = found.setdefault(tuple(w[i:i + WINDOW]), [])
            if str(item_id) not in items[-1:]:
                items.append(str(item_id))
    return found


def _blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list]:
    """The benchmark in blocks of about ``BLOCK_BYTES`` of text, dealt by item and text, so
    that the copies of a text are in all blocks."""
    rows = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = 1 + size // BLOCK_BYTES
    for b in range(n):
        yield [(r["id"], r["text"]) for r in rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == b).distinct().collect()]


def filed_windows(index: DataFrame, block: list) -> dict[bytes, list[tuple[tuple[bytes, ...], list[str]]]]:
    """The windows of a block that the corpus may hold, under their rarest term."""
    windows = item_windows(block)
    vocabulary = {t for w in windows for t in w}
    sent = index.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wanted = sent.value
        for batch in batches:
            for row in batch.itertuples():
                at = [i for i, t in enumerate(map(bytes, row.terms)) if t in wanted]
                yield pd.DataFrame({"term": [row.terms[i] for i in at], "n": np.asarray(row.counts)[at].astype(np.int64)})

    rows = index.select("terms", "counts").mapInPandas(count, "term binary, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    counts = {bytes(r["term"]): r["n"] for r in rows.collect()}  # words of the block
    out: dict[bytes, list] = {}
    for window, items in windows.items():
        if all(t in counts for t in window):
            out.setdefault(min(window, key=lambda t: (counts[t], t)), []).append((window, items))
    return out


def phrase_hits(index: DataFrame, block: list) -> DataFrame:
    """Documents (segment, ord) that hold a window of the block: the items and
    the merged word spans [lo, hi) that the occurrences cover."""
    filed = index.sparkSession.sparkContext.broadcast(filed_windows(index, block))

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                seg, by_doc = _Segment(row), {}
                for window, items in (x for t in filed.value.keys() & seg.terms.keys() for x in filed.value[t]):
                    for p in seg.phrase(window).tolist():
                        d = int(np.searchsorted(seg.begin, p, "right")) - 1
                        got = by_doc.setdefault(d, (set(), []))
                        got[0].update(items)
                        lo = p - int(seg.begin[d])
                        got[1].append((lo, lo + len(window)))
                out = []
                for d, (items, spans) in by_doc.items():
                    merged: list[list[int]] = []
                    for lo, hi in sorted(spans):
                        if merged and lo <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], hi)
                        else:
                            merged.append([lo, hi])
                    out.append((row.segment, d, sorted(items), [{"lo": a, "hi": b} for a, b in merged]))
                yield pd.DataFrame(out, columns=["segment", "ord", "item_ids", "spans"])

    return index.select("segment", "n_words", "terms", "counts", "postings").mapInPandas(look, HIT_SCHEMA)


def proximity_matches(index: DataFrame, items: DataFrame, slop: int, id_col: str = "item_id",
                      text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, window, at): words of an item's window that stand, in
    any order, within ``slop`` words of the window's rarest word at ``at``."""
    out = None
    for block in _blocks(items, id_col, text_col):
        compiled = index.sparkSession.sparkContext.broadcast(item_windows(block))

        def look(batches: Iterator[pd.DataFrame], compiled=compiled) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for row in batch.itertuples():
                    seg = _Segment(row)
                    yield pd.DataFrame(
                        [(row.doc_ids[d], item, w, int(p - seg.begin[d]))
                         for w, (window, ids) in enumerate(compiled.value.items()) for p in seg.near(window, slop)
                         for d in [int(np.searchsorted(seg.begin, p, "right")) - 1] for item in ids],
                        columns=["doc_id", "item_id", "window", "at"])

        found = index.mapInPandas(look, NEAR_SCHEMA)
        out = found if out is None else out.unionByName(found)
    return out


def decontaminate(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id",
                  text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_words, n_hit (words inside an occurrence of a
    benchmark window), item_ids (sorted strings), spans (merged word ranges).

    Null texts have no words; items without words have no window; repeated items
    count once; a null item id is the empty string. Every row of ``docs`` gives
    one row, also for null or repeated ids. Other columns are not read.
    """
    hits = None
    with worker_batches(docs.sparkSession, PIECE_BYTES):
        index = stage(build_index(docs, doc_id, text_col), "index", PIECE_BYTES)
        for block in _blocks(items, item_id, text_col):
            found = stage(phrase_hits(index, block), "hits")
            hits = found if hits is None else hits.unionByName(found)
    span = "struct<lo:int,hi:int>"
    merge = F.aggregate(  # spans of several blocks may overlap
        F.array_sort(F.flatten(F.collect_list("spans"))), F.array().cast(f"array<{span}>"),
        lambda acc, s: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)["hi"] >= s["lo"]),
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
                F.element_at(acc, -1)["lo"].alias("lo"), F.greatest(F.element_at(acc, -1)["hi"], s["hi"]).alias("hi")))))
        .otherwise(F.concat(acc, F.array(s))))
    hits = hits.groupBy("segment", "ord").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"), merge.alias("spans"))
    all_docs = index.select("segment", F.posexplode(F.arrays_zip("doc_ids", "n_words")).alias("ord", "d")).select(
        "segment", "ord", F.col("d.doc_ids").alias("doc_id"), F.col("d.n_words").alias("n_words"))
    n_hit = F.aggregate("spans", F.lit(0), lambda a, s: a + s["hi"] - s["lo"])
    return all_docs.join(hits, ["segment", "ord"], "left").select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), F.coalesce(n_hit, F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        F.coalesce("spans", F.array().cast(f"array<{span}>")).alias("spans"))


def contaminated(n_hit, n_words):
    """The rule: at least a twentieth of the document's words are hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)
