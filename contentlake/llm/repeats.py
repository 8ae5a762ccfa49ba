"""Removal of repeated byte strings by distributed prefix doubling over anchors.

A suffix array of all positions would sort every byte; here only positions whose
rank can matter are sorted. In every string of ``LENGTH`` bytes the least hash of
its ``SEED``-byte strings marks an anchor, so equal strings have their anchors at
equal places and one byte in about 80 is an anchor. The rank of an anchor is
first that of its seed; anchors of unique rank drop out.

A node of the search is an anchor with a range [lo, hi] of distances from the
starts of the strings around it. Its inner string is what all of them share, its
outer string what they cover together. Each round Spark ranks (anchor rank, inner)
and (anchor rank, outer) pairs by grouping: a node whose inner string is unique
drops out, one whose outer string occurs again is past the threshold as a whole,
the others go on with both halves of the range, whose inner strings are longer:
50, 125, 162, ... up to LENGTH bytes, where inner and outer are one. Of nodes that
are through only one per outer string stays, as a partner for the others. Nodes
that share their inner string with at most ``FEW`` others are finished in place:
all their strings are ranked in the task that the shared rank sends them to. So a
group of n copies costs n rows, and the edges of a match at most eight rounds.
The first round needs no text; only nodes that go on carry the bytes around them.

Texts that occur more than once are removed whole at once, and take part once.
Ranks are 64-bit hashes under a 64-bit seed rank.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contentlake.functions.joins import bounded_broadcast
from contentlake.llm.common import discard, stage

LENGTH = 200
SEED = 50
REACH = LENGTH - SEED  # an anchor's largest distance from a string's start
BATCH_BYTES = 500_000
PIECE_BYTES = 1 << 20  # of a longer text that are looked at once
PIECE_NODES = 1_000  # nodes whose bytes or strings are hashed at once (a group of FEW is never cut)
BROADCAST_ROWS = 1_000_000
FEW = 64
HOT, LEAST_HOT = 1_000, 10_000  # keys of more than a HOT-th of all nodes, and so many, are broadcast
_RNG = np.random.default_rng(10)
_BYTE = _RNG.integers(0, 1 << 64, 256, dtype=np.uint64, endpoint=False)
_BASE = 0x9E3779B97F4A7C15
TEXT = ["h1", "h2"]  # 128 bits that stand for a text


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    have = 1
    while have < n:
        more = min(have, n - have)
        out[have:have + more] = out[:more] * np.uint64(pow(base, have, 1 << 64))
        have += more
    return out


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hashes:
    """Hashes of any substrings of a byte stream, from prefix sums."""

    def __init__(self, data: bytes) -> None:
        raw = np.frombuffer(data, np.uint8)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[raw] * _powers(_BASE, len(raw)), dtype=np.uint64)])
        self.undo = _powers(pow(_BASE, -1, 1 << 64), len(raw) + 1)

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[begin]) * self.undo[begin] + (end - begin).astype(np.uint64))


def _sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over x[i:i + width], by doubling."""
    have, out = 1, x
    while have * 2 <= width:
        out = pick(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return pick(out[:len(out) - rest], out[rest:]) if rest else out


def anchors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, position, seed rank) of the anchors of all texts."""
    data = b"".join(texts)
    if len(data) < LENGTH:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    ends = np.cumsum([len(t) for t in texts])
    h, n = Hashes(data), len(data)
    at = np.arange(n - SEED + 1)
    seed = h.of(at, at + SEED)
    least = _sliding(seed, REACH + 1, np.minimum)  # of the string that starts here
    for end in ends[:-1].tolist():  # strings end within their text
        least[max(0, end - LENGTH + 1):end] = 0
    most = _sliding(np.concatenate([np.zeros(REACH, np.uint64), least, np.zeros(REACH, np.uint64)]), REACH + 1, np.maximum)
    found = np.flatnonzero(most[:len(seed)] == seed)
    owner = np.searchsorted(ends, found, "right")
    begins = ends - np.array([len(t) for t in texts])
    return owner, found - begins[owner], seed[found].view(np.int64)


def anchors_of(text: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(position, seed rank) of the anchors of one text, piece by piece: whether a
    position is an anchor is up to the strings around it, which lie within LENGTH."""
    for begin in range(0, max(len(text), 1), PIECE_BYTES):
        end, first = begin + PIECE_BYTES, max(0, begin - LENGTH)
        _, pos, rank = anchors([text[first:end + LENGTH]])
        pos = pos + first
        here = (pos >= begin) & (pos < end)
        yield pos[here], rank[here]


def _anchor_table(docs: DataFrame) -> DataFrame:
    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, texts in _parts(batches):
            h1, h2 = part["h1"].to_numpy(), part["h2"].to_numpy()
            if len(texts) == 1:
                for pos, rank in anchors_of(texts[0]):
                    yield pd.DataFrame({"h1": h1[0], "h2": h2[0], "pos": pos, "rank": rank})
                continue
            owner, pos, rank = anchors(texts)
            yield pd.DataFrame({"h1": h1[owner], "h2": h2[owner], "pos": pos, "rank": rank})

    return docs.select("h1", "h2", "text").mapInPandas(find, "h1 bigint, h2 bigint, pos bigint, rank bigint")


NODE = "h1 bigint, h2 bigint, pos bigint, rank bigint, lo int, hi int, least int, most int, around binary"
RANKED = f"{NODE}, inner_rank bigint, outer_rank bigint"


def _rank(nodes: pd.DataFrame) -> pd.DataFrame:
    """Hashes of the inner and outer strings; ``around`` begins where the first
    of the node's strings that fit into the text does. A node of which some
    strings don't fit has no outer string."""
    h = Hashes(b"".join(nodes["around"]))
    sizes = nodes["around"].map(len).to_numpy()
    lo, hi, least, most = (nodes[c].to_numpy() for c in ("lo", "hi", "least", "most"))
    anchor = np.cumsum(sizes) - sizes + np.minimum(hi, most)
    inner = h.of(anchor - lo, anchor + LENGTH - hi).view(np.int64)
    whole = (lo >= least) & (hi <= most)
    outer = h.of(np.where(whole, anchor - hi, anchor), np.where(whole, anchor + LENGTH - lo, anchor)).view(np.int64)
    return nodes.assign(inner_rank=inner, outer_rank=pd.array(np.where(whole, outer, 0), dtype="Int64").copy()
                        if whole.all() else pd.Series(outer, index=nodes.index).astype("Int64").where(whole))


def _parts(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, list[bytes]]]:
    """Rows in pieces of about ``BATCH_BYTES`` of text, and their texts as bytes."""
    for batch in batches:
        texts = [t.encode("utf-8", "replace") for t in batch["text"]]
        begin = 0
        while begin < len(texts):
            end, size = begin, 0
            while end < len(texts) and (size < BATCH_BYTES or end == begin):
                size += len(texts[end])
                end += 1
            yield batch.iloc[begin:end], texts[begin:end]
            begin = end


def _roots(texts: DataFrame) -> DataFrame:
    """Ranked root nodes of the anchors (``found``: position, rank) of each text,
    without bytes: the inner string is the seed, the outer one all that is in reach."""

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, texts in _parts(batches):
            counts = part["found"].map(len).to_numpy()
            own = np.repeat(np.arange(len(part)), counts)
            pos = np.array([f["pos"] for found in part["found"] for f in found], np.int64)
            rank = np.array([f["rank"] for found in part["found"] for f in found], np.int64)
            sizes = np.array([len(t) for t in texts], np.int64)
            at = (np.cumsum(sizes) - sizes)[own] + pos
            least, most = np.maximum(0, pos + LENGTH - sizes[own]), np.minimum(REACH, pos)
            data, outer = b"".join(texts), np.empty(len(pos), np.int64)
            for piece in np.split(np.arange(len(at)), np.flatnonzero(np.diff(at // PIECE_BYTES)) + 1):  # ascending
                if len(piece):
                    first = int((at - most)[piece].min())
                    h = Hashes(data[first:int((at + LENGTH - least)[piece].max())])
                    outer[piece] = h.of((at - most)[piece] - first, (at + LENGTH - least)[piece] - first).view(np.int64)
            yield pd.DataFrame({
                "h1": part["h1"].to_numpy()[own], "h2": part["h2"].to_numpy()[own], "pos": pos, "rank": rank, "lo": 0, "hi": REACH,
                "least": least, "most": most, "inner_rank": rank,
                "outer_rank": pd.Series(outer).astype("Int64").where((least == 0) & (most == REACH))})

    return texts.mapInPandas(build, "h1 bigint, h2 bigint, pos bigint, rank bigint, lo int, hi int, least int, most int, "
                                    "inner_rank bigint, outer_rank bigint")


def _with_bytes(roots: DataFrame, texts: DataFrame) -> DataFrame:
    """Root nodes with the bytes around them."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, texts in _parts(batches):
            rows = [(h1, h2, f["pos"], f["rank"], 0, REACH, f["least"], f["most"],
                     data[f["pos"] - f["most"]:f["pos"] + LENGTH - f["least"]], f["rank"])
                    for h1, h2, data, found in zip(part["h1"], part["h2"], texts, part["found"]) for f in found]
            yield pd.DataFrame(rows, columns=[*(c.split()[0] for c in NODE.split(", ")), "inner_rank"])

    # a text's own anchors
    found = roots.groupBy(*TEXT).agg(F.collect_list(F.struct("pos", "rank", "least", "most")).alias("found"))
    return texts.join(found, TEXT).mapInPandas(cut, f"{NODE}, inner_rank bigint")


def _halves(nodes: DataFrame) -> DataFrame:
    """Both halves of every node's range, ranked."""

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in (b.iloc[i:i + PIECE_NODES] for b in batches for i in range(0, len(b), PIECE_NODES)):
            rows = []
            for r in batch.itertuples(index=False):
                begin, mid = min(r.hi, r.most), (r.lo + r.hi) // 2  # ``around`` begins ``begin`` before the anchor
                for lo, hi in ((r.lo, mid), (mid + 1, r.hi)):
                    first, last = min(hi, r.most), max(lo, r.least)
                    if first >= last:
                        rows.append((r.h1, r.h2, r.pos, r.rank, lo, hi, r.least, r.most, r.around[begin - first:begin + LENGTH - last]))
            if rows:
                yield _rank(pd.DataFrame(rows, columns=[c.split()[0] for c in NODE.split(", ")]))

    return nodes.mapInPandas(split, RANKED)


RANGES = "h1 bigint, h2 bigint, begin bigint, end bigint"
SHARED = ["rank", "lo", "hi", "inner_rank"]


def _ranges_of(nodes: pd.DataFrame) -> pd.DataFrame:
    """The runs of strings that occur again among ``nodes``, all of which are
    there that share an inner string."""
    h = Hashes(b"".join(nodes["around"]))
    sizes = nodes["around"].map(len).to_numpy()
    lo, hi, least, most, pos = (nodes[c].to_numpy() for c in ("lo", "hi", "least", "most", "pos"))
    near, far = np.maximum(lo, least), np.minimum(hi, most)
    anchor = np.cumsum(sizes) - sizes + far
    n = far - near + 1
    node = np.repeat(np.arange(len(nodes)), n)
    first = np.cumsum(n) - n
    d = far[node] - (np.arange(len(node)) - first[node])  # descending: strings in text order
    begin = anchor[node] - d
    key = _mix(h.of(begin, begin + LENGTH) ^ _mix(nodes["rank"].to_numpy().view(np.uint64)[node] + d.astype(np.uint64)))
    _, which, count = np.unique(key, return_inverse=True, return_counts=True)
    again = count[which] > 1
    edge = np.concatenate([[True], node[1:] != node[:-1]])
    before, after = np.concatenate([[False], again[:-1]]), np.concatenate([again[1:], [False]])
    starts = np.flatnonzero(again & (edge | ~before))
    ends = np.flatnonzero(again & (np.concatenate([edge[1:], [True]]) | ~after))
    own = node[starts]
    return pd.DataFrame({"h1": nodes["h1"].to_numpy()[own], "h2": nodes["h2"].to_numpy()[own],
                         "begin": pos[own] - d[starts], "end": pos[own] - d[ends] + LENGTH})


def _whole_groups(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Sorted nodes in pieces of about ``PIECE_NODES`` that part no shared inner string."""
    new = np.flatnonzero((rows[SHARED].to_numpy()[1:] != rows[SHARED].to_numpy()[:-1]).any(axis=1)) + 1
    begin = 0
    while begin < len(rows):
        later = new[np.searchsorted(new, begin + PIECE_NODES):]
        end = int(later[0]) if len(later) else len(rows)
        yield rows.iloc[begin:end].reset_index(drop=True)
        begin = end


def _finished(nodes: DataFrame) -> DataFrame:
    """Ranges of nodes that have few partners each."""

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            open_ = (rows[SHARED] == rows[SHARED].iloc[-1]).all(axis=1).to_numpy()  # may go on in the next batch
            rest = rows[open_].reset_index(drop=True)
            if not open_.all():
                yield from (_ranges_of(piece) for piece in _whole_groups(rows[~open_]))
        if rest is not None and len(rest):
            yield _ranges_of(rest)

    rows = nodes.select("h1", "h2", "pos", "lo", "hi", "least", "most", "around", "rank", "inner_rank")
    return rows.repartition(*SHARED).sortWithinPartitions(*SHARED).mapInPandas(finish, RANGES)


def _with_counts(rows: DataFrame, counts: DataFrame, keys: list[str], n: str, hot: int) -> DataFrame:
    """``rows`` left-joined with a table that has one row per key. The few keys of more
    than ``hot`` rows are broadcast; their rows go through the shuffle under their own
    node number instead of the key, so that no task gets them together."""
    values = [c for c in counts.columns if c not in keys]
    large = F.broadcast(counts.where(F.col(n) > hot).select(
        *[F.col(k).alias(f"_{k}") for k in keys], *[F.col(v).alias(f"_hot_{v}") for v in values]))
    met = rows.join(large, [rows[k] == large[f"_{k}"] for k in keys], "left").drop(*[f"_{k}" for k in keys])
    is_hot = F.col(f"_hot_{n}").isNotNull()
    met = met.withColumn("_first", F.when(is_hot, F.col("node")).otherwise(F.col(keys[0]))).withColumn("_apart", ~is_hot)
    rest = counts.where(F.col(n) <= hot).select(*[F.col(k).alias(f"_{k}") for k in keys], *values, F.lit(True).alias("_rest"))
    on = [met["_first"] == rest[f"_{keys[0]}"], met["_apart"] == rest["_rest"], *[met[k] == rest[f"_{k}"] for k in keys[1:]]]
    out = met.join(rest, on, "left")
    return out.select(*rows.columns, *[F.coalesce(F.col(f"_hot_{v}"), F.col(v)).alias(v) for v in values])


def _ranked(nodes: DataFrame) -> DataFrame:
    """(node, through, few, goes_on) of the nodes whose inner string isn't unique."""
    slim = nodes.select("node", "rank", "lo", "hi", "inner_rank", "outer_rank")
    same = ["rank", "lo", "hi"]
    hot = max(LEAST_HOT, nodes.count() // HOT)   # so at most HOT keys are broadcast
    outer = (slim.where(F.col("outer_rank").isNotNull()).groupBy(*same, "outer_rank")
             .agg(F.count(F.lit(1)).alias("n_out"), F.min("node").alias("kept")).where("n_out > 1"))
    inner = slim.groupBy(*same, "inner_rank").agg(F.count(F.lit(1)).alias("n_in")).where("n_in > 1")
    partner = (F.col("kept") == F.col("node")) & (F.col("n_in") > F.col("n_out"))
    met = _with_counts(slim, inner, [*same, "inner_rank"], "n_in", hot).where("n_in > 1")
    met = _with_counts(met, outer, [*same, "outer_rank"], "n_out", hot)
    return stage(met.select(
        "node", F.col("n_out").isNotNull().alias("through"), (F.col("n_in") <= FEW).alias("few"),
        ((F.col("lo") < F.col("hi")) & (F.col("n_out").isNull() | partner)).alias("goes_on")), "states")


def repeated_ranges(roots: DataFrame, texts: DataFrame) -> DataFrame:
    """(h1, h2, begin, end): byte ranges made of strings that occur again."""
    nodes, found, last = roots, None, None
    while True:
        nodes = stage(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
        if last is not None:
            discard(last)
        state = _ranked(nodes)
        pick = lambda which: nodes.join(bounded_broadcast(state.where(which).select("node"), BROADCAST_ROWS), "node", "left_semi")
        bytes_of = (lambda n: _with_bytes(n, texts)) if last is None else (lambda n: n.drop("node", "outer_rank"))
        whole = pick("through").select(*TEXT, (F.col("pos") - F.col("hi")).alias("begin"), (F.col("pos") - F.col("lo") + LENGTH).alias("end"))
        ranges = stage(whole.unionByName(_finished(bytes_of(pick("goes_on and few")))), "ranges")
        found = ranges if found is None else found.unionByName(ranges)
        if state.where("goes_on and not few").isEmpty():
            return found
        last, nodes = nodes, _halves(bytes_of(pick("goes_on and not few")).drop("inner_rank"))


SPANS = "array<struct<begin:bigint,end:bigint>>"


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   with_text: bool = False) -> DataFrame:
    """Per row: id, n_bytes, n_removed, spans (maximal removed byte ranges),
    kept_sha256 and, if asked for, ``kept`` (the remaining bytes).

    Removed is every byte of a string of ``LENGTH`` bytes that also starts
    elsewhere, in the same or another row. Null text is empty. Matches never
    cross rows. Rows with equal texts are copies of each other, also if their ids
    are equal or null. An empty table gives no rows. Other columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.col(id_col).alias("id"), text.alias("text")).withColumns(
        {"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit(10), "text")})
    rows = stage(keyed.select("id", *TEXT, F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha")), "rows")
    copies = stage(rows.where(F.col("n_bytes") >= LENGTH).groupBy(*TEXT).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*TEXT), "copies")

    found = stage(_anchor_table(keyed.where(F.octet_length("text") >= LENGTH)), "anchors")
    here = F.struct("h1", "h2", "pos")
    twice = (found.groupBy("rank").agg(F.min(here).alias("a"), F.max(here).alias("b")).where("a <> b").select("rank"))
    twice = stage(twice, "repeated-ranks")
    again = found.join(bounded_broadcast(twice, BROADCAST_ROWS), "rank", "left_semi")
    by_text = stage(again.groupBy(*TEXT).agg(F.sort_array(F.collect_set(F.struct("pos", "rank"))).alias("found")), "by-text")
    discard(found)
    # one row of every text that has such anchors
    wanted = bounded_broadcast(by_text.select(*TEXT), BROADCAST_ROWS)
    texts = stage(keyed.select(*TEXT, "text").join(wanted, TEXT, "left_semi").dropDuplicates(TEXT), "texts")
    ranges = repeated_ranges(_roots(texts.join(by_text, TEXT)), texts)

    # a text's ranges are at most as many as its anchors' nodes
    merged = F.aggregate(
        F.array_sort(F.collect_set(F.struct("begin", "end"))), F.array().cast(SPANS),
        lambda acc, s: F.when((F.size(acc) > 0) & (F.element_at(acc, -1)["end"] >= s["begin"]), F.concat(
            F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
                F.element_at(acc, -1)["begin"].alias("begin"), F.greatest(F.element_at(acc, -1)["end"], s["end"]).alias("end")))))
        .otherwise(F.concat(acc, F.array(s))))
    spans = ranges.groupBy(*TEXT).agg(merged.alias("spans")).join(copies, TEXT, "left_anti")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            kept = []
            for t, spans in zip(batch["text"], batch["spans"]):
                data, at, parts = t.encode("utf-8", "replace"), 0, []
                for s in spans:
                    parts.append(data[at:s["begin"]])
                    at = s["end"]
                kept.append(b"".join([*parts, data[at:]]))
            out = batch[["h1", "h2", "spans"]].assign(cut_sha=[hashlib.sha256(k).hexdigest() for k in kept])
            yield out.assign(kept=kept) if with_text else out

    extra = ", kept binary" if with_text else ""
    done = texts.join(spans, TEXT).mapInPandas(cut, f"h1 bigint, h2 bigint, spans {SPANS}, cut_sha string{extra}")
    whole = F.array(F.struct(F.lit(0).cast("long").alias("begin"), F.col("n_bytes").alias("end")))
    out = rows.join(copies.withColumn("copy", F.lit(True)), TEXT, "left").join(done, TEXT, "left")
    out = out.withColumn("spans", F.when(F.col("copy"), whole).otherwise(F.coalesce("spans", F.array().cast(SPANS))))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    sha = F.when(F.col("copy"), F.sha2(F.lit(""), 256)).otherwise(F.coalesce("cut_sha", "sha"))
    columns = ["id", "n_bytes", removed.alias("n_removed"), "spans", sha.alias("kept_sha256")]
    if with_text:
        own = keyed.select("id", *TEXT, "text").dropDuplicates(["id", *TEXT]).withColumnRenamed("id", "id_")
        out = out.join(own, out["id"].eqNullSafe(own["id_"]) & (out["h1"] == own["h1"]) & (out["h2"] == own["h2"]), "left")
        columns.append(F.when(F.col("copy"), F.lit(b"")).otherwise(F.coalesce("kept", F.col("text").cast("binary"))).alias("kept"))
    return out.select(*columns)
