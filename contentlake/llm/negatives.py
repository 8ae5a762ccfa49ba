"""Hard negatives by a multiway hyperplane tree (GNAT style).

Vectors are lifted to one sphere: with M the greatest length, x' = (x, sqrt(M^2 - |x|^2))
and, for an anchor, q' = (q, 0), so ``|q' - x'|^2 = |q|^2 + M^2 - 2 <q, x>``. A score
window is then an annulus around the anchor, and the triangle inequality holds.

Every node of the tree has up to ``FANOUT`` split points; a row goes to the child of
its nearest one. For each pair (split point, child) the node holds the least and the
greatest distance of the split point to the rows below the child, over all rows. From
its distances to the split points an anchor knows between which bounds its distances
to a child's rows lie; a child whose bounds don't meet any wanted annulus is
eliminated with all below it. Surviving leaves are searched exactly.

The split points are fitted on ``SAMPLE`` rows (the only rows the driver sees); all
rows are indexed, and results are exact. Leaves of many rows are dealt in chunks, and
the anchors that want one leaf in blocks, so that a task holds at most about ``CHUNK``
rows and ``BLOCK`` anchors however often a vector is repeated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contentlake.llm.common import stage

SAMPLE = 4096
FANOUT = 8
DEPTH = 2
LEAF = 64  # a node with fewer rows of the sample is a leaf
CHUNK = 4096
BLOCK = 1024
SLACK = 4e-6  # rounding of distances, in lengths of the longest vector
EXACT = float(1 << 53)  # integers below are exact as doubles
LONG = (1 << 63) - 1


class Node:
    """Split points with their children (nodes, or None for a leaf) and the
    (split point, child) ranges of distance."""

    def __init__(self, name: str, points: np.ndarray, children: list) -> None:
        self.name, self.points, self.children = name, points, children
        self.low = np.full((len(points), len(points)), np.inf)
        self.high = np.full((len(points), len(points)), -np.inf)

    def nodes(self) -> Iterator[Node]:
        yield self
        for child in self.children:
            if child is not None:
                yield from child.nodes()


def _lift(x: np.ndarray, m2: float) -> np.ndarray:
    return np.hstack([x, np.sqrt(np.maximum(m2 - np.einsum("ij,ij->i", x, x), 0))[:, None]])


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    sq = np.einsum("ij,ij->i", a, a)[:, None] + np.einsum("ij,ij->i", b, b)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(sq, 0))


def _fit(name: str, rows: np.ndarray, depth: int) -> Node | None:
    """Split points: each the candidate farthest from those chosen before."""
    if depth == 0 or len(rows) < LEAF:
        return None
    candidates = rows[:3 * FANOUT]
    chosen, nearest = [0], _distance(candidates, candidates[:1])[:, 0]
    while len(chosen) < FANOUT and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, _distance(candidates, candidates[chosen[-1:]])[:, 0])
    if len(chosen) < 2:
        return None
    points = candidates[chosen]
    child = _distance(rows, points).argmin(axis=1)
    return Node(name, points, [_fit(f"{name}.{j}", rows[child == j], depth - 1) for j in range(len(points))])


def _descend(node: Node | None, rows: np.ndarray, at: np.ndarray, leaves: np.ndarray, name: str, seen) -> None:
    """Names the leaf of every row; ``seen(node, j, distances)`` is told the
    distances of a child's rows to all split points."""
    if node is None or not len(at):
        leaves[at] = name
        return
    d = _distance(rows[at], node.points)
    child = d.argmin(axis=1)
    for j, below in enumerate(node.children):
        here = child == j
        if here.any() and seen:
            seen(node, j, d[here])
        _descend(below, rows, at[here], leaves, f"{node.name}.{j}", seen)


def _bounds(node: Node | None, name: str, q: np.ndarray, low: np.ndarray, high: np.ndarray) -> Iterator[tuple]:
    """(leaf, least, greatest possible distance of every anchor to its rows)."""
    if node is None:
        yield name, low, high
        return
    d = _distance(q, node.points)
    for j, below in enumerate(node.children):
        if node.low[0, j] > node.high[0, j]:
            continue  # no row
        least = np.maximum(d - node.high[:, j], node.low[:, j] - d).max(axis=1)
        most = (d + node.high[:, j]).min(axis=1)
        yield from _bounds(below, f"{node.name}.{j}", q, np.maximum(low, least), np.minimum(high, most))


def _matrix(vectors: pd.Series, dim: int) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in vectors]).reshape(len(vectors), dim)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products, beyond a long its nearest value."""
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(1, a.shape[1]) < EXACT:
        return (a @ b.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    out = [[max(-LONG - 1, min(LONG, int(sum(s)))) for s in (whole(x) * whole(b) if b.size else [[0]] * len(b))] for x in a]
    return np.array(out, dtype=np.int64).reshape(len(a), len(b))


def _by_dim(frame: pd.DataFrame) -> Iterator[tuple[int, pd.DataFrame]]:
    if len(frame):
        yield from frame.groupby(frame["v"].map(len).to_numpy(), sort=True)


class _Index:
    """The trees, one per dimension, their greatest squared length and the sample."""

    def __init__(self, sample: pd.DataFrame, m2: dict[int, float]) -> None:
        self.m2, self.trees, self.sample = m2, {}, {}
        for dim, rows in _by_dim(sample):
            x = _matrix(rows["v"], dim)
            self.sample[dim] = rows["id"].to_numpy(np.int64), rows["label"].to_numpy(np.int64), x
            if m2[dim] < EXACT:
                self.trees[dim] = _fit(str(dim), _lift(x, m2[dim]), DEPTH)

    def leaves(self, frame: pd.DataFrame, seen=None) -> np.ndarray:
        out = np.empty(len(frame), dtype=object)
        for dim, rows in _by_dim(frame.reset_index(drop=True)):
            at = rows.index.to_numpy()
            if self.trees.get(dim) is None:
                out[at] = str(dim)
            else:
                own = np.empty(len(rows), dtype=object)
                _descend(self.trees[dim], _lift(_matrix(rows["v"], dim), self.m2[dim]), np.arange(len(rows)), own, str(dim), seen)
                out[at] = own
        return out

    def surviving(self, dim: int, q: np.ndarray, windows: np.ndarray) -> Iterator[tuple[str, np.ndarray]]:
        """(leaf, which anchors want it): ``windows`` holds the (lowest, highest)
        scores wanted, any number per anchor; lowest above highest wants none."""
        tree, m2 = self.trees.get(dim), self.m2.get(dim, 0)
        if tree is None:
            yield str(dim), (windows[:, :, 0] <= windows[:, :, 1]).any(axis=1)
            return
        q2 = np.einsum("ij,ij->i", q, q)[:, None] + m2
        near = np.sqrt(np.maximum(q2 - 2 * windows[:, :, 1].astype(float), 0))
        far = np.sqrt(np.maximum(q2 - 2 * windows[:, :, 0].astype(float), 0))
        real = windows[:, :, 0] <= windows[:, :, 1]
        slack = SLACK * np.sqrt(m2)
        lifted = np.hstack([q, np.zeros((len(q), 1))])
        for leaf, low, high in _bounds(tree, str(dim), lifted, np.zeros(len(q)), np.full(len(q), np.inf)):
            yield leaf, (real & (low[:, None] <= far + slack) & (high[:, None] >= near - slack)).any(axis=1)


def _build(rows: DataFrame) -> tuple[_Index, DataFrame]:
    """The index and (id, label, v, leaf) of all rows."""
    squared = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    m2 = {r["d"]: float(r["m"]) for r in rows.groupBy(F.size("v").alias("d")).agg(F.max(squared).alias("m")).collect()}
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).toPandas()
    index = _Index(sample, m2)
    sent = rows.sparkSession.sparkContext.broadcast(index)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(leaf=sent.value.leaves(batch))

    def ranges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[tuple[str, int], list[np.ndarray]] = {}

        def seen(node: Node, j: int, d: np.ndarray) -> None:
            low, high = found.get((node.name, j), (np.inf, -np.inf))
            found[node.name, j] = [np.minimum(low, d.min(axis=0)), np.maximum(high, d.max(axis=0))]

        for batch in batches:
            sent.value.leaves(batch, seen)
        yield pd.DataFrame([(node, i, j, low[i], high[i]) for (node, j), (low, high) in found.items() for i in range(len(low))],
                           columns=["node", "point", "child", "low", "high"])

    placed = stage(rows.mapInPandas(assign, "id bigint, label bigint, v array<double>, leaf string"), "gnat-rows")
    spans = placed.select("v").mapInPandas(ranges, "node string, point int, child int, low double, high double")
    names = {n.name: n for t in index.trees.values() if t for n in t.nodes()}
    for r in spans.groupBy("node", "point", "child").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect():
        names[r["node"]].low[r["point"], r["child"]] = r["low"]
        names[r["node"]].high[r["point"], r["child"]] = r["high"]
    return index, placed


def _search(index: _Index, placed: DataFrame, anchors: DataFrame, schema: str, found: str, windows, pick) -> DataFrame:
    """Every anchor against the rows of the leaves it wants. ``windows(anchors,
    sample scores, sample ids, sample labels)`` gives the scores wanted, ``pick``
    the rows of ``found`` an anchor block takes from a chunk."""
    sent = anchors.sparkSession.sparkContext.broadcast(index)
    names = [c.split(" ")[0] for c in schema.split(", ")]

    def wanted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = sent.value
        for batch in batches:
            for dim, rows in _by_dim(batch):
                q = _matrix(rows["v"], dim)
                ids, labels, x = index.sample.get(dim, (np.empty(0, np.int64), np.empty(0, np.int64), np.empty((0, dim))))
                spans = windows(rows, _products(q, x), ids, labels)
                for leaf, want in index.surviving(dim, q, spans):
                    if want.any():
                        yield rows[want].assign(leaf=leaf)

    asked = stage(anchors.mapInPandas(wanted, f"{schema}, leaf string"), "gnat-anchors")
    sizes = placed.groupBy("leaf").count().withColumnRenamed("count", "n").join(
        asked.groupBy("leaf").agg(F.count(F.lit(1)).alias("k")), "leaf")
    parts = F.broadcast(sizes.select("leaf", F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks"),
                                     F.ceil(F.col("k") / BLOCK).cast("int").alias("blocks")))  # a row per leaf
    part = F.sequence(F.lit(0), F.col("blocks") - 1)
    mine = placed.join(parts, "leaf").select("id", "label", "v", "leaf", F.pmod(F.xxhash64("id", "v"), F.col("chunks")).alias("chunk"), F.explode(part).alias("block"))
    theirs = asked.join(parts, "leaf").select(*names, "leaf", F.pmod(F.xxhash64("a"), F.col("blocks")).cast("int").alias("block"),
                                              F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks").cast("long") - 1)).alias("chunk"))
    empty = pd.DataFrame({c.split(" ")[0]: [] for c in found.split(", ")})

    def exact(rows: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        out = [empty]
        for at in range(0, len(rows), CHUNK if len(anchors) else 1):  # copies share a chunk: in pieces
            if not len(anchors):
                break
            part = rows.iloc[at:at + CHUNK]
            for dim, some in _by_dim(anchors):
                out += pick(some, part, _products(_matrix(some["v"], dim), _matrix(part["v"], dim)))
        return pd.concat(out[1:] or out)

    keys = ["leaf", "chunk", "block"]
    return mine.groupBy(*keys).cogroup(theirs.groupBy(*keys)).applyInPandas(exact, found)


class _Found:
    """Rows of a result, collected as arrays; a column is an array or one value."""

    def __init__(self, *names: str) -> None:
        self.names, self.parts = names, []

    def add(self, *values) -> None:
        if len(values[-1]):
            self.parts.append([v if isinstance(v, np.ndarray) else np.full(len(values[-1]), v) for v in values])

    def frames(self) -> list[pd.DataFrame]:
        return [pd.DataFrame({n: np.concatenate(c) for n, c in zip(self.names, zip(*self.parts))})] if self.parts else []


def _top(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= least)
        return at[np.lexsort((ids[at], -scores[at]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def hard_negatives(vectors: DataFrame, is_anchor: Column, *, n_positives: int = 5, n_negatives: int = 10, low: int = 30,
                   high: int = 90, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                   scale: float = 256.0) -> DataFrame:
    """(anchor_id, positive_id, rank from 1, negative_id, positive_score,
    negative_score): for every row for which ``is_anchor`` (a column of ``id``)
    holds and each of its ``n_positives`` highest-scoring rows of the same label,
    the ``n_negatives`` highest-scoring rows of other labels whose score lies
    between ``low`` and ``high`` percent of the positive's. Scores are integer
    products of floor(scale * x); ties go to the smaller id.

    Rows without id or label, and vectors that are null or hold null or non-finite
    components, take no part; a row never meets rows with its own id. Vectors of
    different dimension have no score. Repeated rows: a candidate counts once per
    row, an equal anchor (id, label, vector) once. Components and scores beyond a
    long are its nearest value. An empty table gives no rows.
    """
    v = F.col(vec_col).cast("array<double>")
    ok = v.isNotNull() & F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = stage(vectors.where(ok).select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                                          F.transform(v, lambda x: F.floor(x * scale).cast("double")).alias("v")), "gnat-vectors")
    index, placed = _build(rows)
    anchors = stage(rows.where(is_anchor).distinct().withColumn("a", F.monotonically_increasing_id()), "gnat-queries")

    def best_known(some: pd.DataFrame, scores: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """From the n-th best score within the sample up."""
        out = np.full((len(some), 1, 2), LONG)
        out[:, :, 0] = -LONG - 1
        for i, (own, label) in enumerate(zip(some["id"], some["label"])):
            s = scores[i][(labels == label) & (ids != own)]
            if len(s) >= n_positives:
                out[i, 0, 0] = np.partition(s, len(s) - n_positives)[len(s) - n_positives]
        return out

    def positives(some: pd.DataFrame, part: pd.DataFrame, scores: np.ndarray) -> list[pd.DataFrame]:
        ids, labels, out = part["id"].to_numpy(), part["label"].to_numpy(), _Found("a", "positive_id", "positive_score")
        for i, (a, own, label) in enumerate(zip(some["a"], some["id"], some["label"])):
            at = np.flatnonzero((labels == label) & (ids != own))
            at = at[_top(scores[i, at], ids[at], n_positives)]
            out.add(a, ids[at], scores[i, at])
        return out.frames()

    near = _search(index, placed, anchors, "a bigint, id bigint, label bigint, v array<double>",
                   "a bigint, positive_id bigint, positive_score bigint", best_known, positives)
    order = Window.partitionBy("a").orderBy(F.desc("positive_score"), "positive_id")
    near = near.withColumn("p", F.row_number().over(order)).where(F.col("p") <= n_positives)
    near = stage(near, "gnat-positives")
    # at most n_positives rows per anchor
    held = near.groupBy("a").agg(F.array_sort(F.collect_list(F.struct("p", "positive_score"))).alias("ps"))
    asking = anchors.join(held, "a").select("a", "id", "label", "v", F.transform("ps", lambda x: x["positive_score"]).alias("scores"))

    def spans(some: pd.DataFrame) -> np.ndarray:
        out = np.full((len(some), n_positives, 2), 0, dtype=np.int64)
        out[:, :, 0] = 1  # none
        for i, scores in enumerate(some["scores"]):
            for j, s in enumerate(scores):
                out[i, j] = -(-low * int(s) // 100), high * int(s) // 100
        return out

    def windows(some: pd.DataFrame, scores: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """The windows, from the n-th best score within window and sample up."""
        out = spans(some)
        for i, (own, label) in enumerate(zip(some["id"], some["label"])):
            s = scores[i][(labels != label) & (ids != own)]
            for j, (lo, hi) in enumerate(out[i]):
                inside = s[(s >= lo) & (s <= hi)]
                if len(inside) >= n_negatives:
                    out[i, j, 0] = np.partition(inside, len(inside) - n_negatives)[len(inside) - n_negatives]
        return out

    def negatives(some: pd.DataFrame, part: pd.DataFrame, scores: np.ndarray) -> list[pd.DataFrame]:
        ids, labels, out = part["id"].to_numpy(), part["label"].to_numpy(), _Found("a", "p", "negative_id", "negative_score")
        for i, (span, a, own, label) in enumerate(zip(spans(some), some["a"], some["id"], some["label"])):
            wanted = span[span[:, 0] <= span[:, 1]]
            if not len(wanted):
                continue
            near = np.flatnonzero((labels != label) & (ids != own) & (scores[i] >= wanted[:, 0].min()) & (scores[i] <= wanted[:, 1].max()))
            near = near[np.lexsort((ids[near], -scores[i, near]))]  # in the order of the result: a window is a run of it
            falling = -scores[i, near]
            for j, (lo, hi) in enumerate(span):
                if lo <= hi:
                    first = np.searchsorted(falling, -hi)
                    at = near[first:min(first + n_negatives, np.searchsorted(falling, -lo, side="right"))]
                    out.add(a, j + 1, ids[at], scores[i, at])
        return out.frames()

    far = _search(index, placed, asking, "a bigint, id bigint, label bigint, v array<double>, scores array<bigint>",
                  "a bigint, p int, negative_id bigint, negative_score bigint", windows, negatives)
    order = Window.partitionBy("a", "p").orderBy(F.desc("negative_score"), "negative_id")
    far = far.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n_negatives)
    return far.join(near, ["a", "p"]).join(anchors.select("a", F.col("id").alias("anchor_id")), "a").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
