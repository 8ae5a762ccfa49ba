"""Row positions without pulling a group (or the whole table) into one task.

``row_number() over (order by ...)`` with no partition runs in a single
task, and ``row_number() over (partition by k ...)`` runs a hot key in a
single task. Both helpers here range-partition on the full sort key first,
so a large group is spread over many partitions, then add the number of
rows that sit in earlier partitions:

1. ``repartitionByRange(n, keys + order)`` + ``sortWithinPartitions``;
2. per (partition, key) row counts and first row id -> a small table
   (at most one row per partition for the global case);
3. running sum of those counts over earlier partitions;
4. position = rows in earlier partitions + rank inside this partition.

The order columns must make the order total (add a unique tie-break), so
that every recomputation after a lost executor yields the same positions.
The sorted frame with its row ids is checkpointed once (both passes read
the same rows and ids), and the partition count is fixed explicitly.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contentlake.session import materialize

_PID, _MID, _N, _FIRST, _OFF = "_cl_pid", "_cl_mid", "_cl_n", "_cl_first", "_cl_off"
# monotonically_increasing_id puts the partition index in the upper 31 bits
# and the record number inside the partition in the lower 33 bits.
_ROW_BITS = 33


def _n_parts(df: DataFrame, n: int | None) -> int:
    if n:
        return n
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _ranged(df: DataFrame, cols: list, n: int) -> DataFrame:
    """Range-partitioned, sorted rows with their partition index and row id,
    written once to the shared checkpoint folder.

    Both passes (counting and numbering) must see the same partition of
    every row. A range exchange draws its own sample for its bounds, and the
    two passes would plan two exchanges (column pruning makes their inputs
    differ), so the row ids are fixed by a reliable checkpoint instead of
    being recomputed; a lost executor re-reads them rather than re-sampling.
    """
    ranged = (df.repartitionByRange(n, *cols)
                .sortWithinPartitions(*cols)
                .withColumn(_PID, F.spark_partition_id())
                .withColumn(_MID, F.monotonically_increasing_id()))
    return materialize(ranged)


def global_position(df: DataFrame, order: list[Column | str], pos_col: str = "pos",
                    partitions: int | None = None) -> DataFrame:
    """1-based position of each row in the total order ``order``."""
    n = _n_parts(df, partitions)
    ranged = _ranged(df, order, n)
    counts = ranged.groupBy(_PID).agg(F.count(F.lit(1)).alias(_N))
    # one row per partition: a single-partition window over it is bounded
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(_PID, F.coalesce(F.sum(_N).over(before), F.lit(0)).alias(_OFF))
    local = F.col(_MID) - F.shiftleft(F.col(_PID).cast("long"), _ROW_BITS)
    return (ranged.join(F.broadcast(offsets), _PID)
                  .withColumn(pos_col, F.col(_OFF) + local + F.lit(1))
                  .drop(_PID, _MID, _OFF))


def position_within(df: DataFrame, keys: list[str], order: list[Column | str],
                    pos_col: str = "pos", partitions: int | None = None) -> DataFrame:
    """1-based position of each row inside its ``keys`` group, in ``order``.

    Equivalent to ``row_number() over (partition by keys order by order)``
    but a key holding a large share of all rows is split over several
    partitions instead of running in one task.
    """
    n = _n_parts(df, partitions)
    ranged = _ranged(df, [*keys, *order], n)
    stats = (ranged.groupBy(_PID, *keys)
                   .agg(F.count(F.lit(1)).alias(_N), F.min(_MID).alias(_FIRST)))
    # a key has at most one stats row per partition, so even a hot key's
    # window here is bounded by the partition count
    before = Window.partitionBy(*keys).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.withColumn(_OFF, F.coalesce(F.sum(_N).over(before), F.lit(0))).drop(_N)
    s = stats.alias("_s")
    r = ranged.alias("_r")
    cond = reduce(lambda a, b: a & b,
                  [F.col(f"_r.{k}").eqNullSafe(F.col(f"_s.{k}")) for k in keys],
                  F.col(f"_r.{_PID}") == F.col(f"_s.{_PID}"))
    out = r.join(s, cond).select(
        "_r.*",
        (F.col(f"_s.{_OFF}") + F.col(f"_r.{_MID}") - F.col(f"_s.{_FIRST}") + F.lit(1)).alias(pos_col))
    return out.drop(_PID, _MID)


def last_before(df: DataFrame, keys: list[str], order: list[Column | str], value: str,
                out_col: str, partitions: int | None = None) -> DataFrame:
    """``value`` of the last earlier row of the same ``keys`` (in ``order``) that
    has one, as ``out_col``; null if there is none.

    As :func:`position_within`: rows are ranged on keys and order, so a hot key is
    spread over several partitions. Within a partition a window looks back; over the
    boundary each partition passes on one value per key."""
    n = _n_parts(df, partitions)
    ranged = _ranged(df, [*keys, *order], n)
    back = Window.partitionBy(_PID, *keys).orderBy(_MID).rowsBetween(Window.unboundedPreceding, -1)
    near = ranged.withColumn(out_col, F.last(value, ignorenulls=True).over(back))
    ends = ranged.groupBy(_PID, *keys).agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.col(_MID))).alias(_N))
    # at most one row per partition and key here
    before = Window.partitionBy(*keys).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn(_OFF, F.last(_N, ignorenulls=True).over(before)).drop(_N)
    r, s = near.alias("_r"), ends.alias("_s")
    cond = reduce(lambda a, b: a & b, [F.col(f"_r.{k}").eqNullSafe(F.col(f"_s.{k}")) for k in keys],
                  F.col(f"_r.{_PID}") == F.col(f"_s.{_PID}"))
    kept = [F.col(f"_r.{c}") for c in df.columns if c != out_col]
    return r.join(s, cond).select(*kept, F.coalesce(F.col(f"_r.{out_col}"), F.col(f"_s.{_OFF}")).alias(out_col))
