"""Mixing sources to target weights by entropy balancing (DataFrame operations only).

Every document gets a rate in (0, 2): the exponentially tilted form
``2 / (1 + exp(-lam * x))`` of the base rate 1, where ``x`` is its size over
its source's mean size and ``lam`` its source's multiplier. The multipliers
minimise the convex dual ``sum_d 2 log(1 + exp(lam x_d)) - lam * target``;
Newton steps need two sums per source, taken over the table of (source, size)
counts. Sources whose target is the upper bound take every document twice.

Rates become copies by systematic rounding: documents stand in order of size
within their source, the running sum of rates is cut at whole numbers, and of
``OFFSETS`` starting points the one whose tokens come nearest to the target is
used; then up to ``FLIPS`` documents per source give or take one copy to meet
what is left. All sums are of integers, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contentlake.llm.common import stage

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
ONE = 1 << 32  # rates and their running sums are integers of this unit
GRID = 1 << 20  # unit of the sums of a Newton step
MAX_STEPS, FARTHEST, TOLERANCE = 60, 64.0, 1e-7
OFFSETS, FLIPS, SALTS = 32, 3, 64


def targets(sources: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """``sources`` (source, n, source_size) with ``sid`` (rank by code point,
    null last), ``weight`` and ``target``: ``share`` of all sizes by weight, where
    none is above ``most`` times its size and the excess goes to the others by
    weight. The loop passes two sums per round through the driver."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))  # one row per source
    cycle = F.lit(list(weights))
    s = (sources.withColumn("sid", rank).withColumn("weight", F.element_at(cycle, (F.col("sid") - 1) % len(weights) + 1))
         .withColumn("most", most * F.col("source_size")))
    s = stage(s, "sources")
    total = s.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:
        full = F.col("most") <= level * F.col("weight")
        spent, open_ = s.agg(F.sum(F.when(full, F.col("most")).otherwise(0.0)),
                             F.sum(F.when(full, 0).otherwise(F.col("weight")))).first()
        if not open_:
            break
        new = (share * total - spent) / open_
        if new <= level:
            break
        level = new
    return s.withColumn("target", F.least(F.col("most"), level * F.col("weight")))


def _rate() -> Column:
    x = F.try_divide("size", "mean")
    return F.when(F.col("full"), F.lit(2.0)).when(F.col("mean") == 0, F.lit(1.0)).otherwise(
        2.0 / (1.0 + F.exp(-F.col("lam") * x)))


def balance(hist: DataFrame, sources: DataFrame) -> DataFrame:
    """Newton's method on the dual: ``sources`` (sid, n, source_size, target)
    with ``mean``, ``full`` and the multiplier ``lam``. ``hist``: (sid, size, cnt).
    The dual is convex, so every gradient narrows the bracket (low, high); a step
    that would leave it goes to its middle instead."""
    half = F.try_divide("target", "source_size") / 2
    state = (sources.withColumn("mean", F.col("source_size") / F.col("n"))
             .withColumn("full", (F.col("source_size") > 0) & (F.col("target") >= F.col("most") * (1 - 1e-12)))
             .withColumns({"low": F.lit(-FARTHEST), "high": F.lit(FARTHEST)})
             .withColumn("lam", F.when((F.col("source_size") == 0) | F.col("full"), F.lit(0.0))
                         .otherwise(F.log(F.try_divide(half, 1 - half)))))
    for _ in range(MAX_STEPS):
        x, w = F.try_divide("size", "mean"), _rate()
        term = lambda v: F.sum(F.round(v * F.col("cnt") * GRID).cast("bigint")) / GRID
        sums = (hist.join(state, "sid").where("not full and mean > 0").groupBy("sid")
                .agg(term(x * w).alias("g"), term(x * x * w * (1 - w / 2)).alias("h")))
        gap = F.try_divide("target", "mean") - F.col("g")
        state = state.join(sums, "sid", "left").withColumns({
            "off": F.coalesce(F.try_divide(F.abs(gap) * F.col("mean"), F.col("target")), F.lit(0.0)),
            "low": F.when(gap > 0, F.col("lam")).otherwise(F.col("low")),
            "high": F.when(gap <= 0, F.col("lam")).otherwise(F.col("high")),
            "newton": F.col("lam") + gap / F.greatest("h", F.lit(1e-9))})
        inside = (F.col("newton") > F.col("low")) & (F.col("newton") < F.col("high"))
        step = F.when(inside, F.col("newton")).otherwise((F.col("low") + F.col("high")) / 2)
        moved = F.when(F.col("g").isNull() | (F.col("off") < TOLERANCE), F.col("lam")).otherwise(F.round(step, 9))
        nxt = stage(state.withColumn("lam", moved).drop("g", "h", "newton"), "dual")
        off = nxt.agg(F.max("off")).first()[0]
        state = nxt.drop("off")
        if off is None or off < TOLERANCE:
            break
    return state


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0,
                id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Every row of ``docs`` with ``size`` (words), ``source_size``, ``target``
    (its source's), ``copies`` (0, 1 or 2) and ``taken`` (copies * size).

    ``most`` must be 2. Null text has no words; null is a source of its own, after
    the others. Documents without words get one copy unless their source is
    taken twice. Null and repeated ids and repeated rows are separate documents.
    An empty table gives no rows. Other columns are not read.
    """
    if most != 2.0:
        raise ValueError("the rates are tilted between 0 and 2")
    rows = stage(docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"),
        F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("long").alias("size")), "words")
    sources = targets(rows.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size")),
                      weights, share, most)
    named = sources.select(F.col("source").alias("s"), "sid")
    rows = rows.join(named, rows["source"].eqNullSafe(named["s"])).select("id", "sid", "size")
    hist = stage(rows.groupBy("sid", "size").agg(F.count(F.lit(1)).alias("cnt")), "hist")
    state = balance(hist, sources)
    return _round(rows, state)


def _round(rows: DataFrame, state: DataFrame) -> DataFrame:
    """Copies by systematic rounding in order of size (largest first)."""
    bits = F.length(F.bin("size"))
    cls = F.when(F.col("size") == 0, 0).otherwise(  # 16 size classes per power of two
        bits * 16 + F.expr("(size * 32) div shiftleft(1L, length(bin(size)))").bitwiseAND(15)).cast("int")
    state = state.select("sid", "source_size", "target", "mean", "full", "lam")
    w = (rows.join(state, "sid").withColumn("w", F.round(_rate() * ONE).cast("bigint")).withColumn("cls", cls)
         .withColumn("salt", F.pmod(F.xxhash64("id", "size"), F.lit(SALTS)).cast("int")))
    cell = ["sid", "cls", "salt"]
    before = Window.partitionBy("sid").orderBy(F.desc("cls"), "salt").rowsBetween(Window.unboundedPreceding, -1)
    cells = (w.groupBy(*cell).agg(F.sum("w").alias("cw"))
             .withColumn("off", F.coalesce(F.sum("cw").over(before), F.lit(0))).drop("cw"))
    own = Window.partitionBy(*cell).orderBy(F.desc("size"), "id")
    w = stage(w.withColumn("rn", F.row_number().over(own))
              .withColumn("upto", F.sum("w").over(own.rowsBetween(Window.unboundedPreceding, 0)))
              .join(cells, cell).withColumn("upto", F.col("upto") + F.col("off"))
              .select("id", "sid", "size", "cls", "salt", "rn", "w", "upto"), "rates")

    cut = lambda v: F.shiftright(v, 32)
    copies = lambda start: cut(F.col("upto") + start) - cut(F.col("upto") - F.col("w") + start)
    starts = [ONE * j // OFFSETS for j in range(OFFSETS)]
    tokens = w.groupBy("sid").agg(*[F.sum(copies(F.lit(u)) * F.col("size")).alias(f"t{j}") for j, u in enumerate(starts)])
    misses = F.array_min(F.array(*[F.struct(F.abs(F.col("target") - F.col(f"t{j}")).alias("miss"), F.lit(u).alias("start"),
                                            (F.col("target") - F.col(f"t{j}")).alias("left")) for j, u in enumerate(starts)]))
    chosen = stage(tokens.join(state, "sid").withColumn("best", misses)
                   .select("sid", "source_size", "target", "best.start", "best.left"), "starts")
    w = w.join(chosen, "sid").withColumn("copies", copies(F.col("start")).cast("int"))
    key = ["sid", "cls", "salt", "rn"]
    w = stage(w.select("id", "size", "source_size", "target", "copies", *key), "copies")

    # one document per source and pass that brings the source nearest to its target
    left, flipped = chosen.select("sid", "left"), None
    for _ in range(FLIPS):
        can = w if flipped is None else w.join(flipped, key, "left_anti")
        way = F.when((F.col("left") > 0) & (F.col("copies") < 2), 1).when((F.col("left") < 0) & (F.col("copies") > 0), -1)
        rest = F.col("left") - F.col("way") * F.col("size")
        pick = (can.join(left, "sid").withColumn("way", way).where(F.col("way").isNotNull() & (F.abs(rest) < F.abs("left")))
                .groupBy("sid").agg(F.min(F.struct(F.abs(rest).alias("miss"), "cls", "salt", "rn", "way", rest.alias("rest"))).alias("p"))
                .select("sid", "p.cls", "p.salt", "p.rn", "p.way", "p.rest"))
        pick = stage(pick, "flips")
        left = left.join(pick.select("sid", "rest"), "sid", "left").select("sid", F.coalesce("rest", "left").alias("left"))
        flipped = pick.select(*key, "way") if flipped is None else flipped.unionByName(pick.select(*key, "way"))
    w = w.join(flipped, key, "left").withColumn("copies", F.col("copies") + F.coalesce("way", F.lit(0)))
    return w.select("id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
