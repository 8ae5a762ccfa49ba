"""Join helpers: broadcast only behind a checked size bound."""

from __future__ import annotations

import threading
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_count_at_most(df: DataFrame, bound: int) -> bool:
    """True when ``df`` has at most ``bound`` rows.

    ``limit(bound + 1).count()`` stops scanning as soon as the bound is
    passed, so the check costs at most ``bound + 1`` rows of work. An
    unbounded stream is never proven small.
    """
    if df.isStreaming:
        return False
    return df.limit(bound + 1).count() <= bound


def bounded_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast-hint ``df`` only if it is proven to hold <= ``max_rows`` rows.

    Otherwise the plain frame is returned and the join is planned as a
    shuffle join (AQE may still turn it into a broadcast from measured
    shuffle sizes).
    """
    return F.broadcast(df) if row_count_at_most(df, max_rows) else df


# small frames kept by lookups; released by the caller when its result has
# been written (every streaming micro-batch does so). Each thread - each stream's
# batches have one of their own - keeps and releases its own frames.
_KEPT = threading.local()


def keep(df: DataFrame) -> DataFrame:
    """``df`` persisted until :func:`release_kept`: a small frame that is read twice."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    _KEPT.frames = [*getattr(_KEPT, "frames", []), kept]
    return kept


def release_kept() -> None:
    """Unpersist the small frames this thread's lookups kept since the last release."""
    frames, _KEPT.frames = getattr(_KEPT, "frames", []), []
    for df in frames:
        df.unpersist()


# A request-side frame at most this many rows is broadcast into lookups, so
# the (large) repository table is scanned in place instead of shuffled.
LOOKUP_BROADCAST_ROWS = 200_000


# Up to so many keys are broadcast as their 8-byte hashes (:func:`near_keys`).
HASHED_KEYS = 2_000_000


def near_keys(table: DataFrame, columns: list[str], keys: DataFrame, key_columns: list[str],
              bound: int | None = None) -> DataFrame:
    """The rows of ``table`` whose ``columns`` hash as one of ``keys`` does: all that an
    equi-join with ``keys`` can match, and a few more, so that join has to follow.

    Up to ``bound`` keys (checked) their hashes are broadcast, so a large table streams
    past them and only what may match is shuffled; with more, it is ``table`` itself.
    ``keys`` are read twice."""
    hashes = keys.select(F.xxhash64(*key_columns).alias("_near")).distinct()
    if not row_count_at_most(hashes, HASHED_KEYS if bound is None else bound):
        return table
    return table.join(F.broadcast(hashes), F.xxhash64(*columns) == F.col("_near"), "left_semi")


def preserving_lookup(left: DataFrame, right: DataFrame, left_keys: list[str],
                      right_keys: list[str], bound: int = LOOKUP_BROADCAST_ROWS,
                      small: bool | None = None, prune: str | None = None) -> DataFrame:
    """``left`` left-outer-joined with ``right`` on equal keys, where the
    right side holds at most one row per key.

    If ``left`` is proven to have at most ``bound`` rows, only its distinct
    key values are broadcast (short keys, never the request payload), the
    right side streams past them with no shuffle and no skew, and the few
    matches are joined back to ``left`` - two small frames. Otherwise this
    is a plain shuffle left join (AQE splits skewed keys). ``small`` passes
    a bound the caller already proved (e.g. on the frame ``left`` was
    derived from). ``prune`` names a left key that is never blank: if the right key
    is a folder of its files, only the folders that the keys name are read.
    """
    on_pairs = list(zip(left_keys, right_keys))
    if small is None:
        small = row_count_at_most(left, bound)
    if not small:
        return left.join(right, null_safe_free_on(left, right, on_pairs), "left")
    # ``left`` is read twice (its keys, then the final join); it is proven
    # small, so keep it rather than recompute its lineage (a lost block is
    # recomputed, so this stays fault tolerant)
    left = keep(left)
    keys = left.select(*[F.col(lk).alias(f"_bk{i}") for i, (lk, _) in enumerate(on_pairs)]).distinct()
    if prune:   # a predicate on the small side is what makes Spark prune the other one at run time
        keys = keys.where(F.col(f"_bk{left_keys.index(prune)}") != "")
    match = reduce(lambda a, b: a & b,
                   [right[rk] == keys[f"_bk{i}"] for i, (_, rk) in enumerate(on_pairs)])
    hits = right.join(F.broadcast(keys), match).drop(*[f"_bk{i}" for i in range(len(on_pairs))])
    return left.join(hits, null_safe_free_on(left, hits, on_pairs), "left")


def null_safe_free_on(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> Column:
    return reduce(lambda a, b: a & b, [left[a] == right[b] for a, b in pairs])


_WIDE_TYPES = ("binary", "map", "array", "struct", "variant")


def is_narrow(df: DataFrame, max_columns: int = 16) -> bool:
    """Few scalar columns: a proven-small frame of this shape is cheap to
    broadcast whole (no payload such as record bytes or nested documents)."""
    fields = df.schema.fields
    return len(fields) <= max_columns and not any(
        f.dataType.typeName() in _WIDE_TYPES for f in fields)
