"""Near-duplicates by an inverted join of MinHash signature coordinates.

A document's set are its distinct five-word shingles, hashed to 64 bits.
Documents of equal sets form a class; only classes are compared. A class has
``COORDINATES`` signature coordinates, each posted under its (coordinate, value).
Pairs at the similarity threshold agree in so many coordinates that fewer than
``LEAST`` agreements have a chance of about 5e-11, so:

* values that one class has are skipped, classes with fewer than LEAST shared
  values too;
* of the others, in order of frequency, all but the LEAST - 1 most frequent ones
  are posted (the prefix): two classes that agree in LEAST coordinates share at
  least one posted value, and very frequent values are hardly ever read;
* within a posting list every class is first paired with one member, the list's
  hub; lists whose members are then in one component are skipped; in what is left
  members of different components are paired if a shingle among the rarest of
  both sets, and its place there, leave room for the threshold. So a group of n
  near copies costs n pairs per list, while no link between
  components is lost.

Pairs that agree in LEAST coordinates are confirmed on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contentlake.llm.common import stage
from contentlake.llm.components import components

SHINGLE = 5
COORDINATES, LEAST = 64, 24
#: Ids up to which the compared classes are broadcast to the scan of the texts.
BROADCAST_IDS = 1_000_000
CHARS = 2_000_000  # text in arrays at once
_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(0, 1 << 64, 256, dtype=np.uint64, endpoint=False)
_MULTIPLY = _RNG.integers(0, 1 << 32, COORDINATES, dtype=np.uint32, endpoint=False) | np.uint32(1)
_ADD = _RNG.integers(0, 1 << 32, COORDINATES, dtype=np.uint32, endpoint=False)
_BASE = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. n - 1 modulo 2 ** 64, by doubling."""
    out = np.ones(n, np.uint64)
    have = 1
    while have < n:
        more = min(have, n - have)
        out[have:have + more] = out[:more] * np.uint64(pow(base, have, 1 << 64))
        have += more
    return out


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text (A-Z lower-cased; words
    are runs of non-white-space). Fewer than five words are one shingle."""
    raw = " ".join(["", *texts, ""]).encode("utf-8", "replace").lower()
    data = np.frombuffer(raw, np.uint8)
    space = _SPACE[data]
    begin = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    end = np.flatnonzero(~space[:-1] & space[1:]) + 1
    # a word's hash: its bytes as digits, from prefix sums that wrap around
    steps = _powers(_BASE, len(data))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[data] * steps, dtype=np.uint64)])
    undo = _powers(pow(_BASE, -1, 1 << 64), len(data))
    word = _mix((sums[end] - sums[begin]) * undo[begin] + (end - begin).astype(np.uint64))
    lengths = np.array([len(t.encode("utf-8", "replace")) + 1 for t in texts], np.int64)
    doc_begin = np.concatenate([[0], np.cumsum(lengths)])
    first = np.searchsorted(begin, doc_begin)
    weight = _powers(0xD6E8FEB86659FD93, SHINGLE)
    out = []
    run = np.zeros(max(0, len(word) - SHINGLE + 1), np.uint64)
    for j in range(SHINGLE):
        run += word[j:j + len(run)] * weight[j]
    run = _mix(run)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= SHINGLE:
            out.append(np.unique(run[a:b - SHINGLE + 1]))
        elif b > a:
            out.append(_mix(np.array([np.sum(word[a:b] * _powers(0xD6E8FEB86659FD93, b - a), dtype=np.uint64) + np.uint64(b - a)])))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """COORDINATES minima per non-empty set."""
    low = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    at = np.concatenate([[0], np.cumsum([len(s) for s in sets])])[:-1]
    out = np.empty((len(sets), COORDINATES), np.uint32)
    for k in range(COORDINATES):
        h = (low ^ _ADD[k]) * _MULTIPLY[k]
        h ^= h >> np.uint32(15)
        out[:, k] = np.minimum.reduceat(h, at)
    return out.view(np.int32)


def _pieces(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.Series, list[str]]]:
    for batch in batches:
        texts = [t if isinstance(t, str) else "" for t in batch["text"]]
        at = 0
        while at < len(texts):
            end, chars = at, 0
            while end < len(texts) and (chars < CHARS or end == at):
                chars += len(texts[end])
                end += 1
            yield batch["id"].iloc[at:end], texts[at:end]
            at = end


def signed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, n_shingles, h1, h2, sig): set size, 128 bits of the set, signature."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for ids, texts in _pieces(batches):
            sets = shingle_sets(texts)
            full = [i for i, s in enumerate(sets) if len(s)]
            sig = [None] * len(sets)
            if full:
                for i, row in zip(full, signatures([sets[i] for i in full])):
                    sig[i] = row
            yield pd.DataFrame({
                "id": ids.to_numpy(), "n_shingles": [len(s) for s in sets],
                "h1": np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64),
                "h2": np.array([_mix(s).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64), "sig": sig})

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(sign, "id bigint, n_shingles bigint, h1 bigint, h2 bigint, sig array<int>")


def full_sets(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, n, shingles) of the rows whose id is in ``ids`` (id)."""

    def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for some, texts in _pieces(batches):
            sets = shingle_sets(texts)
            yield pd.DataFrame({"id": some.to_numpy(), "n": [len(s) for s in sets], "shingles": [s.view(np.int64) for s in sets]})

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS  # of a written table
    rows = rows.join(F.broadcast(ids) if few else ids, "id", "left_semi")
    return rows.mapInPandas(expand, "id bigint, n bigint, shingles array<bigint>")


def postings(classes: DataFrame) -> DataFrame:
    """(token, id, n): the prefix of every class's shared coordinate values."""
    value = F.shiftleft(F.col("pos").cast("long"), 32).bitwiseOR(F.col("v").cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))
    tokens = classes.select("id", "n", F.posexplode("sig").alias("pos", "v")).select("id", "n", value.alias("token"))
    shared = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("freq")).where("freq > 1")
    mine = (tokens.join(shared, "token").groupBy("id")
            .agg(F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("freq", "token"))).alias("t"))  # at most COORDINATES
            .where(F.size("t") >= LEAST))
    prefix = F.slice("t", F.lit(1), F.size("t") - LEAST + 1)
    return mine.select("id", "n", F.explode(prefix).alias("t")).select(F.col("t.token").alias("token"), "id", "n")


def _similar_sizes(threshold: int):
    return (100 * F.least("n_a", "n_b") >= threshold * F.greatest("n_a", "n_b"))


def _hub_pairs(posts: DataFrame) -> DataFrame:
    """Every member of a list with its hub, the one with the least id."""
    hubs = posts.groupBy("token").agg(F.min(F.struct("id", "n", "component")).alias("hub"))
    return (posts.join(hubs, "token").where(F.col("component") != F.col("hub.component"))
            .select(F.col("hub.id").alias("a"), F.col("hub.n").alias("n_a"), F.col("id").alias("b"), F.col("n").alias("n_b")))


def _rarest_first(ids: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """(shingle, id, n, pos): of every set the part that a similar set can't
    miss altogether, its rarest shingles, with their places in that order;
    shingles that no other set of ``ids`` has are left out."""
    rows = sets.join(ids, "id", "left_semi").select("id", "n", F.explode("shingles").alias("shingle"))
    freq = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("freq"))
    order = (rows.join(freq, "shingle").groupBy("id")  # a document's own shingles
             .agg(F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("freq", "shingle"))).alias("t")))
    least = F.ceil(F.col("n") * threshold / 100).cast("int")
    part = order.select("id", "n", F.posexplode(F.slice("t", F.lit(1), F.col("n").cast("int") - least + 1)).alias("pos", "t"))
    return part.where("t.freq > 1").select("t.shingle", "id", "n", "pos")


def _cross_pairs(posts: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs of members of open lists that are in different components and
    may be similar: their sets share a shingle among the rarest of both, and
    what stands behind it in both is enough for the threshold. The first shingle
    that two similar sets share in this order always passes."""
    now = posts.select("id", "component").distinct()
    rare = stage(_rarest_first(now.select("id"), sets, threshold).join(now, "id"), "rarest")
    parts = rare.groupBy("shingle", "component").agg(F.count(F.lit(1)).alias("members"))
    main = parts.groupBy("shingle").agg(F.max(F.struct("members", "component")).alias("main")).select("shingle", "main.component")
    mine = lambda x: [F.col(c).alias(f"{c}_{x}") for c in ("id", "n", "pos", "component")]
    rest = rare.join(main, ["shingle", "component"], "left_anti").select("shingle", *mine("a"))
    other = rare.select(F.col("shingle").alias("shingle_b"), *mine("b"))
    behind = F.least(F.col("n_a") - F.col("pos_a"), F.col("n_b") - F.col("pos_b"))
    may = (F.col("component_a") != F.col("component_b")) & (behind * (100 + threshold) >= threshold * (F.col("n_a") + F.col("n_b")))
    return (rest.join(other, (F.col("shingle") == F.col("shingle_b")) & may & _similar_sizes(threshold))
            .select(F.col("id_a").alias("a"), "n_a", F.col("id_b").alias("b"), "n_b"))


def _confirmed(pairs: DataFrame, classes: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """(a, b) of the pairs that agree in LEAST coordinates and whose full sets
    have ``threshold`` hundredths of their union in common."""
    pairs = pairs.where(_similar_sizes(threshold)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    sig = lambda x: classes.select(F.col("id").alias(x), F.col("sig").alias(f"sig_{x}"))
    agree = F.aggregate(F.zip_with("sig_a", "sig_b", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    near = stage(pairs.join(sig("a"), "a").join(sig("b"), "b").where(agree >= LEAST).select("a", "b"), "near")
    own = lambda x: sets.select(F.col("id").alias(x), F.col("n").alias(f"n_{x}"), F.col("shingles").alias(f"s_{x}"))
    both = F.size(F.array_intersect("s_a", "s_b"))
    return (near.join(own("a"), "a").join(own("b"), "b")
            .where(100 * both >= threshold * (F.col("n_a") + F.col("n_b") - both)).select("a", "b"))


def near_duplicates(docs: DataFrame, threshold: int = 75, id_col: str = "doc_id",
                    text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(members, links). ``members``: every row's id, n_shingles and
    ``component`` (the least id it can reach over links and equal sets); ``links``:
    pairs (a, b) of class representatives that were confirmed, enough of them to
    connect every component.

    ``threshold`` is the least similarity in hundredths (75 or more: LEAST is
    chosen for it). Null, empty and blank texts have no shingles and are linked
    with nothing. Rows with the same id are the same document; a row without id
    has no component. An empty table gives no rows. Other columns are not read.
    """
    if threshold < 75:
        raise ValueError("signatures are made for similarities of 0.75 and more")
    rows = stage(signed(docs, id_col, text_col), "signatures")
    classes = stage(rows.where("n_shingles > 0 and id is not null").groupBy("h1", "h2", "n_shingles")
                    .agg(F.min("id").alias("id"), F.first("sig").alias("sig")).withColumnRenamed("n_shingles", "n"), "classes")
    posts = stage(postings(classes.select("id", "n", "sig")), "postings")
    compared = stage(posts.select("id").distinct(), "compared")
    sets = stage(full_sets(docs, compared, id_col, text_col), "sets")

    component = None  # (id, component) of the classes that have links
    links = None
    for step in ("hubs", "rest"):
        now = posts.withColumn("component", F.col("id")) if component is None else (
            posts.join(component, "id", "left").withColumn("component", F.coalesce("component", "id")))
        parts = now.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
        now = stage(now.join(parts.select("token"), "token", "left_semi"), "open-lists")
        if now.isEmpty():
            break
        pairs = _hub_pairs(now) if step == "hubs" else _cross_pairs(now, sets, threshold)
        found = stage(_confirmed(pairs, classes, sets, threshold), "links")
        links = found if links is None else links.unionByName(found)
        if found.isEmpty():
            continue
        merged = found if component is None else _between(found, component)
        fresh = components(merged)
        component = stage(fresh if component is None else _joined(component, fresh), "components")

    # classes keep their rows' ids; several classes of one id are one document
    rows = rows.join(classes.select("h1", "h2", F.col("n").alias("n_shingles"), F.col("id").alias("rep")), ["h1", "h2", "n_shingles"], "left")
    if component is None:
        component = classes.select("id", F.col("id").alias("component")).limit(0)
    rows = rows.join(component.select(F.col("id").alias("rep"), "component"), "rep", "left")
    own = F.when(F.col("id").isNotNull(), F.coalesce("component", "rep", "id"))
    members = rows.select("id", "n_shingles", own.alias("component"))
    return members, links if links is not None else classes.select(F.col("id").alias("a"), F.col("id").alias("b")).limit(0)


def _between(links: DataFrame, component: DataFrame) -> DataFrame:
    """Links as links between components."""
    for x in ("a", "b"):
        links = (links.join(component.select(F.col("id").alias(x), F.col("component").alias(f"c_{x}")), x, "left")
                 .withColumn(x, F.coalesce(f"c_{x}", x)).drop(f"c_{x}"))
    return links


def _joined(component: DataFrame, fresh: DataFrame) -> DataFrame:
    """Components whose roots were joined by ``fresh`` (id: an old root or a
    class that had no links)."""
    moved = fresh.select(F.col("id").alias("component"), F.col("component").alias("to"))
    old = component.join(moved, "component", "left").select("id", F.coalesce("to", "component").alias("component"))
    return old.unionByName(fresh.join(component.select("id"), "id", "left_anti"))
