"""Exact top-k inner-product search with multi-resolution segment statistics.

Vectors are cut into 1, then 4, then 16 segments. With means m, deviations s
and length L of the segments of x and y, Cauchy-Schwarz gives for every
resolution ``<x, y> <= sum L (m_x m_y + s_x s_y)``, which in terms of distance
is the lower bound ``|x - y|^2 >= |x|^2 + |y|^2 - 2 * (that sum)``. Candidates
go through the resolutions from coarse to fine; only those whose bound still
reaches a query's k-th best score get the exact product.

The queries go in blocks of ``QUERY_BLOCK`` vectors (the bound on what is
broadcast); every block meets all candidates where they lie, without a shuffle
of vectors. Scores found in a first pass over ``SEED_ROWS`` candidates are the
starting thresholds of every task. Each task keeps k rows per query; a grouped
pass joins them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SEGMENTS = (1, 4, 16)
QUERY_BLOCK = 4096
CHUNK = 1024  # candidate vectors that are scored at once
PAIRS = 1 << 15  # single products at once
SEED_ROWS = 2048
EXACT = float(1 << 52)  # integers below are exact as doubles
RESULT = "query_id bigint, vec_id bigint, score bigint"


class _Stats:
    """Integer vectors with their segment statistics."""

    def __init__(self, ids: np.ndarray, x: np.ndarray) -> None:
        self.ids, self.x, self.levels = ids, x, []
        dim = x.shape[1]
        for n in SEGMENTS:
            cuts = np.unique(np.linspace(0, dim, min(n, dim) + 1).astype(int)) if dim else np.array([0, 0])
            parts = [x[:, a:b] for a, b in zip(cuts[:-1], cuts[1:])]
            root = [np.sqrt(b - a) for a, b in zip(cuts[:-1], cuts[1:])]
            mean = np.stack([p.mean(axis=1) * r if p.shape[1] else np.zeros(len(x)) for p, r in zip(parts, root)], axis=1)
            dev = np.stack([p.std(axis=1) * r if p.shape[1] else np.zeros(len(x)) for p, r in zip(parts, root)], axis=1)
            self.levels.append(np.hstack([mean, dev]))  # one product gives the whole bound

    def scores(self, other: _Stats, q: np.ndarray, c: np.ndarray) -> np.ndarray:
        size = float(np.abs(self.x).max(initial=0)) * float(np.abs(other.x).max(initial=0)) * max(1, self.x.shape[1])
        if size >= EXACT:
            sums = (sum(int(u) * int(v) for u, v in zip(self.x[i], other.x[j])) for i, j in zip(q, c))
            return np.array([max(-1 << 63, min((1 << 63) - 1, s)) for s in sums], dtype=np.int64)
        if len(q) > len(self.ids) * len(other.ids) // 8:  # most pairs: one product of matrices
            return (self.x @ other.x.T)[q, c].astype(np.int64)
        blocks = [slice(i, i + PAIRS) for i in range(0, len(q), PAIRS)]
        return np.concatenate([np.einsum("ij,ij->i", self.x[q[s]], other.x[c[s]]) for s in blocks]).astype(np.int64)


def _merge(best: tuple, q: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple:
    """The k highest scores per query (ties: smaller id) of old and new rows."""
    q, ids, scores = (np.concatenate(x) for x in zip(best, (q, ids, scores)))
    order = np.lexsort((ids, -scores, q))
    q, ids, scores = q[order], ids[order], scores[order]
    first = np.flatnonzero(np.diff(q, prepend=-1))
    rank = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q))))
    keep = rank < k
    return q[keep], ids[keep], scores[keep]


def _search(queries: _Stats, cands: _Stats, floor: np.ndarray, best: tuple, k: int) -> tuple[tuple, np.ndarray]:
    """Adds one chunk of candidates to ``best`` and raises the thresholds."""
    alive = cands.ids[None, :] != queries.ids[:, None]
    for mine, theirs in zip(queries.levels, cands.levels):
        live = np.flatnonzero(alive.any(axis=0))  # columns that any query still wants
        if not len(live):
            return best, floor
        bound = mine @ theirs[live].T
        slack = 1e-9 * (np.abs(mine).sum(axis=1)[:, None] * np.abs(theirs[live]).max(axis=1)[None, :] + 1)
        alive[:, live] &= bound + slack >= floor[:, None]
    q, c = np.nonzero(alive)
    if not len(q):
        return best, floor
    best = _merge(best, q, cands.ids[c], queries.scores(cands, q, c), k)
    counts = np.bincount(best[0], minlength=len(floor))
    last = np.cumsum(counts) - 1
    full = counts >= k
    floor = floor.copy()
    floor[full] = np.maximum(floor[full], best[2][last[full]])
    return best, floor


def _load(frame: pd.DataFrame) -> dict[int, _Stats]:
    """Vectors by their dimension."""
    out = {}
    dims = frame["v"].map(len)
    for dim, rows in frame.groupby(dims.to_numpy(), sort=True):
        out[int(dim)] = _Stats(rows["id"].to_numpy(np.int64), np.stack([np.asarray(v, np.float64) for v in rows["v"]]).reshape(len(rows), dim))
    return out


def integer_vectors(vectors: DataFrame, id_col: str, vec_col: str, scale: float) -> DataFrame:
    """(id, v): floor(scale * x) per component as double; vectors that are null
    or hold null or non-finite components, and rows without id, take no part."""
    v = F.col(vec_col).cast("array<double>")
    ok = v.isNotNull() & F.col(id_col).isNotNull() & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    scaled = F.transform(v, lambda x: F.floor(x * scale).cast("double"))
    return vectors.where(ok).select(F.col(id_col).cast("long").alias("id"), scaled.alias("v"))


def top_k(vectors: DataFrame, is_query, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding",
          scale: float = 1024.0) -> DataFrame:
    """(query_id, rank from 1, vec_id, score): the k highest integer inner
    products of every row for which ``is_query`` (a column of the id ``id``)
    holds, against all rows but those with the query's own id; ties go to the
    smaller id. Candidates of another dimension than the query take no part.
    Repeated rows: a repeated candidate counts once per row, a repeated query id
    with the same vector once. Scores beyond a long are its nearest value. An empty
    table gives no rows.
    """
    rows = integer_vectors(vectors, id_col, vec_col, scale)
    queries = rows.where(is_query).distinct()
    n_blocks = -(-queries.count() // QUERY_BLOCK) or 1
    out = None
    for b in range(n_blocks):
        block = queries.where(F.pmod(F.xxhash64("id"), F.lit(n_blocks)) == b)
        found = _block_top_k(rows, block, k)
        out = found if out is None else out.unionByName(found)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    # at most k rows per query and task arrive here
    return out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def _block_top_k(rows: DataFrame, block: DataFrame, k: int) -> DataFrame:
    sc = rows.sparkSession.sparkContext
    queries = _load(block.toPandas())  # about QUERY_BLOCK vectors
    first = rows.limit(SEED_ROWS).toPandas()
    best = {d: (np.empty(0, np.int64),) * 3 for d in queries}
    seeds = {d: np.full(len(q.ids), -np.inf) for d, q in queries.items()}
    for at in range(0, len(first), CHUNK):
        for dim, cands in _load(first.iloc[at:at + CHUNK]).items():
            if dim in queries:
                best[dim], seeds[dim] = _search(queries[dim], cands, seeds[dim], best[dim], k)
    sent = sc.broadcast({dim: (q.ids, q.x, seeds[dim]) for dim, q in queries.items()})

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        queries = {dim: _Stats(ids, x) for dim, (ids, x, _) in sent.value.items()}
        floors = {dim: floor for dim, (_, _, floor) in sent.value.items()}
        best = {d: (np.empty(0, np.int64),) * 3 for d in queries}
        for batch in batches:
            for at in range(0, len(batch), CHUNK):
                for dim, cands in _load(batch.iloc[at:at + CHUNK]).items():
                    if dim in queries:
                        best[dim], floors[dim] = _search(queries[dim], cands, floors[dim], best[dim], k)
        for dim, (q, ids, scores) in best.items():
            yield pd.DataFrame({"query_id": queries[dim].ids[q], "vec_id": ids, "score": scores})

    return rows.mapInPandas(search, RESULT)
