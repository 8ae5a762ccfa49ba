"""Sharding by balanced label propagation (DataFrame operations only).

Documents with equal texts are linked. They start spread over the shards by a
hash; in every round a group looks at how its members lie, its units ask to
move to the shard that already holds most of their neighbours, and quotas let
through only as many as the target's capacity allows: every i -> j move that a
j -> i move pays for, plus the room the target has left for linked documents.
Larger gains go first. A group that is larger than a shard asks for one shard's
worth of rows only, and its units are drawn one by one, so that it fills the
room that is there. A smaller group that isn't together yet passes over shards
that are full. Rounds go on until two in a row don't raise the cohesion (the mean
share of its group that a linked document has in its shard) by ``1 / STOP``.
Documents without neighbours can stand anywhere without
cutting an edge, so they are what the final step moves to make the shard
counts differ by one at most.

State that is iterated over is one row per (group, unit), never per edge: a
group is a hyperedge with counts per shard, so a group of a third of all rows
is at most ``n_shards * UNITS`` rows, and no list of pairs exists.
"""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contentlake.llm.common import discard, stage

#: Units per shard into which the members of one group are dealt; a unit moves
#: as one, so no single move shifts more than 1 / (n_shards * UNITS) of a group.
UNITS = 16
#: Rounds end when the cohesion rises by less than one in so many.
STOP = 1000
#: Rows that one ranking window holds on average.
ROWS_PER_BUCKET = 20_000


def _draw(seed: int, *cols: str):
    """A number in [0, 1) per value of ``cols``."""
    return F.pmod(F.xxhash64(*cols, F.lit(seed)), F.lit(1 << 20)) / float(1 << 20)


def _wanted(labels: DataFrame, seed: int, capacity: int, full: list[int]) -> DataFrame:
    """Adds ``to`` (the shard a unit asks for), ``asking`` (rows of its group
    that ask) and ``bucket`` (log2 of the edges saved per document) to every
    unit; ``to = shard`` if it stays. Of a group larger than a shard only as
    many rows ask as the shard can still hold of it."""
    group, here = Window.partitionBy("h1", "h2"), Window.partitionBy("h1", "h2", "shard")
    open_ = ~F.col("shard").isin(full) | (F.col("members") > capacity) | (F.col("cnt") == F.col("members"))
    best = F.max(F.struct(open_.cast("int"), "cnt", F.xxhash64("h1", "shard", F.lit(seed)).alias("tie"), "shard")).over(group)
    gain = F.col("best.cnt") - F.col("cnt") + F.col("n")
    outside = F.col("members") - F.col("best.cnt")
    fits = F.greatest(F.lit(0), F.lit(capacity) - F.col("best.cnt")) / F.greatest(outside, F.lit(1))
    asks = (F.col("members") <= capacity) | (_draw(seed + 1_000_003, "h1", "h2", "u") < fits)
    return (labels.withColumn("cnt", F.sum("n").over(here)).withColumn("best", best)
            .withColumn("to", F.when(asks, F.col("best.shard")).otherwise(F.col("shard")))
            .withColumn("asking", F.least(outside, F.greatest(F.lit(0), F.lit(capacity) - F.col("best.cnt"))))
            .withColumn("bucket", F.floor(F.log2(F.greatest(gain, F.lit(1)).cast("double"))).cast("int"))
            .withColumn("together", F.expr("1000 * n * cnt div members")).drop("best", "cnt"))


def _quotas(wants: list, linked: list[int], capacity: int, k: int) -> tuple[list[int], list[float], list[float]]:
    """For each pair (from * k + to): the gain bucket from which moves pass and
    the share of that bucket that passes; and the rows that
    the quotas let into each shard. ``wants``: rows (shard, to, bucket,
    n), at most k * k * 64 of them."""
    flow = [0] * (k * k)
    for r in wants:
        flow[r["shard"] * k + r["to"]] += r["n"]
    into = [0] * k
    paid = [min(flow[i * k + j], flow[j * k + i]) for i in range(k) for j in range(k)]
    for i in range(k):
        for j in range(k):
            into[j] += flow[i * k + j] - paid[i * k + j]
    share = [min(1.0, max(0, capacity - linked[j]) / into[j]) if into[j] else 0.0 for j in range(k)]
    left = [paid[p] + (flow[p] - paid[p]) * share[p % k] for p in range(k * k)]
    through = [sum(left[j::k]) for j in range(k)]
    threshold, fraction = [99] * (k * k), [0.0] * (k * k)
    for r in sorted(wants, key=lambda r: -r["bucket"]):
        p = r["shard"] * k + r["to"]
        if left[p] > 0:
            threshold[p], fraction[p] = r["bucket"], min(1.0, left[p] / r["n"])
            left[p] -= r["n"]
    return threshold, fraction, through


def propagate(labels: DataFrame, n_rows: int, n_shards: int) -> DataFrame:
    """Rounds of balanced label propagation over units (h1, h2, u, n, members,
    shard), until they don't help any more."""
    k, capacity, last = n_shards, n_rows // n_shards, None
    cohesion, idle = 0, 0
    for r in itertools.count():
        linked = [0] * k
        for row in labels.groupBy("shard").agg(F.sum("n").alias("n")).collect():  # k rows
            linked[row["shard"]] = row["n"]
        asked = stage(_wanted(labels, r, capacity, [j for j in range(k) if linked[j] >= capacity]), "wants")
        if last is not None:
            discard(last)
        last = labels = asked
        now = asked.agg(F.sum("together")).first()[0] or 0
        idle = 0 if now >= cohesion + max(1000, 1000 * sum(linked) // STOP) else idle + 1
        cohesion = max(cohesion, now)
        wants = (asked.where("to <> shard").groupBy("shard", "to", "bucket")
                 .agg(F.sum("n").alias("n")).collect())  # k * k * 64 rows at most
        if idle == 2 or not sum(linked):
            break
        threshold, fraction, through = _quotas(wants, linked, capacity, k)
        pair = F.col("shard") * k + F.col("to") + 1
        least, part = F.element_at(F.lit(threshold), pair), F.element_at(F.lit(fraction), pair)
        # one draw per group, so that the units of a group that move together stay together;
        # one per unit if the target doesn't take so many
        draw = F.when(F.col("asking") > F.element_at(F.lit(through), F.col("to") + 1), _draw(r, "h1", "h2", "u")).otherwise(_draw(r, "h1", "h2"))
        passes = (F.col("to") != F.col("shard")) & (
            (F.col("bucket") > least) | ((F.col("bucket") == least) & (draw < part)))
        labels = asked.withColumn("shard", F.when(passes, F.col("to")).otherwise(F.col("shard"))).drop("to", "asking", "bucket", "together")
    return labels.drop("to", "asking", "bucket", "together")


def shard_documents(docs: DataFrame, n_shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` with its ``shard`` (0 .. n_shards - 1) and ``slot``
    (gapless from 0 within the shard), plus ``size`` (UTF-8 bytes + 8) and
    ``text_crc32``. The shards' row counts are at most one apart.

    Null text counts as empty. Null and repeated ids, ties and repeated rows
    are kept: every input row takes one slot. An empty table gives no rows.
    Other columns of ``docs`` are not read, so their names can't clash.
    """
    k = n_shards
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(
        F.col(id_col).alias("id"), (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("crc"), F.xxhash64(text).alias("h1"),
        F.xxhash64(F.lit(7), text).alias("h2"))
    base = stage(base.withColumn("u", F.pmod(F.xxhash64("id", F.lit(3)), F.lit(k * UNITS)).cast("int")), "base")
    n_rows = base.count()

    units = base.groupBy("h1", "h2", "u").agg(F.count(F.lit(1)).alias("n"))
    members = F.sum("n").over(Window.partitionBy("h1", "h2"))
    labels = units.withColumn("members", members).where("members > 1").withColumn("shard", F.col("u") % k)
    labels = propagate(labels, n_rows, k)

    placed = stage(
        base.join(labels.select("h1", "h2", "u", F.col("shard").alias("label")), ["h1", "h2", "u"], "left")
        .select("id", "size", "crc", "h1", "h2", F.coalesce("label", F.col("u") % k).alias("shard"),
                F.when(F.col("label").isNull(), 1).otherwise(0).alias("free")), "placed")
    return _settle(placed, n_rows, k)


def _settle(placed: DataFrame, n_rows: int, k: int) -> DataFrame:
    """Exact counts: rank the rows of every shard (linked ones first), move what
    is over the shard's share into the gaps of the others."""
    buckets = max(1, n_rows // (k * ROWS_PER_BUCKET))
    rows = placed.withColumn("b", F.pmod(F.xxhash64("id", F.lit(11)), F.lit(buckets)).cast("int"))
    cells = rows.groupBy("shard", "free", "b").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("free", "b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.withColumn("off", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    count = [0] * k
    for r in cells.groupBy("shard").agg(F.sum("n").alias("n")).collect():  # k rows
        count[r["shard"]] = r["n"]
    share = [n_rows // k + (s < n_rows % k) for s in range(k)]
    kept = [min(c, q) for c, q in zip(count, share)]
    over, gap = [0], [0]  # running totals over the shards
    for s in range(k):
        over.append(over[-1] + count[s] - kept[s])
        gap.append(gap[-1] + share[s] - kept[s])

    at = lambda values, index: F.element_at(F.lit([int(v) for v in values]).cast("array<bigint>"), index + 1)
    own = Window.partitionBy("shard", "free", "b").orderBy("id", "h1", "h2")
    ranked = (rows.withColumn("rn", F.row_number().over(own)).join(offsets, ["shard", "free", "b"])
              .withColumn("rank", F.col("off") + F.col("rn") - 1)
              .withColumn("stays", F.col("rank") < at(share, F.col("shard")))
              .withColumn("e", at(over, F.col("shard")) + F.col("rank") - at(share, F.col("shard"))))
    target = F.size(F.filter(F.lit([int(g) for g in gap[1:]]).cast("array<bigint>"), lambda g: g <= F.col("e")))
    ranked = ranked.withColumn("target", F.when(F.col("stays"), F.col("shard")).otherwise(target).cast("int"))
    slot = F.when(F.col("stays"), F.col("rank")).otherwise(
        at(kept, F.col("target")) + F.col("e") - at(gap, F.col("target")))
    return ranked.select("id", "size", F.col("crc").alias("text_crc32"), F.col("target").alias("shard"),
                         slot.cast("long").alias("slot"))
