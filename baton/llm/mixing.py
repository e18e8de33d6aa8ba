"""Mixing sources to target weights by entropy balancing, in DataFrame operations only.

Targets: sources in code point order (null last) weigh 1, 2, 3, repeating, and share the
words of all documents; a target stops at ``limit`` times its source's words and the excess
is shared again by weight until none is above (water filling: ``min(limit * words, level *
weight)`` with one level for all).

Rates: each document gets the expected number of copies that is closest in entropy to one
copy each (bounded by 0 and ``limit``) while the source's words meet its target.  The
solution is a tilted rate ``limit / (1 + (limit - 1) * exp(-lambda * size / mean size))``;
its dual is convex, one lambda per source, and solved for all sources at once by Newton
steps kept inside a bracket.  Every step is one aggregate over the histogram of (source,
size), on which alone a rate depends, so no step reads the documents again.

Copies: rates are summed over the sizes of a source in ascending order and rounded
systematically, so that at every size the whole number of copies so far is within one half of
the sum of the rates; within a (source, size) cell the documents' copies differ by at most
one, and a hash of the id says who gets one more.  What remains to the target (about one of the
largest documents at most) is taken from or added to the source's largest documents that can
give or take it, as part of a copy.

Defined results: a null text, or one without words, has size 0 and is never taken; sources
without words have target 0; no documents give no rows; equal rows are told apart by nothing,
so they may get different numbers of copies, in any order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from baton.llm.wire import stored

#: Newton steps at most; the bracket halves whenever a step would leave it.
STEPS = 60
#: Relative miss of the worst source at which the steps end.
TOLERANCE = 1e-6
#: Hash ranges of the documents of one (source, size) cell, ranked separately.
CELLS = 256
_WORD = r"[^\x20\x09-\x0D]+"


def _rate(lam: Column, x: Column, limit: float) -> Column:
    return F.lit(limit) / (1 + (limit - 1) * F.exp(F.least(F.lit(700.0), -lam * x)))


def source_targets(hist: DataFrame, weights: tuple[int, ...] = (1, 2, 3), limit: float = 3.0) -> DataFrame:
    """(source, source_size, target, mean) from a histogram (source, size, n).  One row a source."""
    words = hist.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"),
                                       F.sum(F.when(F.col("size") > 0, F.col("n"))).alias("docs"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = words.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                                     ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")))
    # sources fill up in the order of limit * words / weight; the first whose level suffices ends it
    fill = Window.orderBy((F.col("source_size") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    after = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("source_size").over(before), F.lit(0)) * limit
    level = left / F.sum("weight").over(after)
    open_at = F.when(level * F.col("weight") <= F.col("source_size") * limit, level)
    return (ranked.withColumn("level", open_at).withColumn("level", F.first("level", ignorenulls=True).over(whole.orderBy(
        (F.col("source_size") / F.col("weight")).asc(), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        .select("source", "source_size", F.least(F.col("source_size") * limit, F.coalesce("level", F.lit(float("inf"))) * F.col("weight")).alias("target"),
                (F.col("source_size") / F.col("docs")).alias("mean")))


def balance(hist: DataFrame, targets: DataFrame, limit: float = 3.0) -> DataFrame:
    """(source, lambda): the dual solution, by Newton steps over the histogram."""
    goals = targets.where("source_size > 0").select(F.col("source").alias("of"), "target", "mean")
    cells = hist.where("size > 0").join(goals, on=F.col("source").eqNullSafe(F.col("of"))).select(
        "source", "size", "n", "target", (F.col("size") / F.col("mean")).alias("x"))
    state = targets.where("source_size > 0").select("source", F.lit(0.0).alias("lam"), F.lit(-1e4).alias("lo"), F.lit(1e4).alias("hi"))
    # a target at the limit needs every rate at the limit
    at_limit = F.col("target") >= F.col("source_size") * limit * (1 - 1e-9)
    done = targets.where(F.col("source_size") > 0).where(at_limit).select("source", F.lit(1e4).alias("lam"))
    state = state.join(targets.where(at_limit).select(F.col("source").alias("s")), on=F.col("source").eqNullSafe(F.col("s")), how="left_anti")
    for _ in range(STEPS):
        tilted = cells.join(state.withColumnRenamed("source", "s"), on=F.col("source").eqNullSafe(F.col("s"))).withColumn(
            "r", _rate(F.col("lam"), F.col("x"), limit))
        words = F.col("size") * F.col("n")
        miss = tilted.groupBy("source").agg(
            F.first("lam").alias("lam"), F.first("lo").alias("lo"), F.first("hi").alias("hi"), F.first("target").alias("target"),
            (F.sum(words * F.col("r")) - F.first("target")).alias("f"),
            F.sum(words * F.col("x") * F.col("r") * (1 - F.col("r") / limit)).alias("slope"))
        lo = F.when(F.col("f") < 0, F.col("lam")).otherwise(F.col("lo"))
        hi = F.when(F.col("f") > 0, F.col("lam")).otherwise(F.col("hi"))
        newton = F.col("lam") - F.try_divide(F.col("f"), F.col("slope"))
        # outside the bracket: halve it, on the scale of its distance from zero
        middle = F.when(lo * hi < 0, F.lit(0.0)).when((F.abs(lo) < 1) | (F.abs(hi) < 1), (lo + hi) / 2).otherwise(F.signum(lo + hi) * F.sqrt(lo * hi))
        middle = F.when(middle == F.col("lam"), (lo + hi) / 2).otherwise(middle)
        step = F.when(F.col("f") == 0, F.col("lam")).when((F.col("slope") > 0) & (newton > lo) & (newton < hi), newton).otherwise(middle)
        state = stored(miss.select("source", step.alias("lam"), lo.alias("lo"), hi.alias("hi"), F.abs(F.col("f") / F.col("target")).alias("off")))
        worst = state.agg(F.max("off")).first()[0]
        if worst is None or worst < TOLERANCE:
            break
    return state.select("source", "lam").unionByName(done)


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: tuple[int, ...] = (1, 2, 3), limit: int = 3) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies, rate): the words of each document that
    the mix takes, in ``copies`` whole copies and perhaps part of another."""
    sized = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("source"),
                        F.coalesce(F.regexp_count(F.col(f"`{text_col}`"), F.lit(_WORD)), F.lit(0)).cast("bigint").alias("size"))
    sized = stored(sized)  # three small columns: the text is read once
    hist = sized.groupBy("source", "size").agg(F.count("*").alias("n"))
    targets = stored(source_targets(hist, weights, float(limit)))
    lam = balance(hist, targets, float(limit))

    t, s = targets.alias("t"), lam.alias("s")
    per_source = t.join(s, on=F.col("t.source").eqNullSafe(F.col("s.source")), how="left").select(
        F.col("t.source").alias("of"), "source_size", "target", "mean", "lam")
    # systematic rounding along the sizes of each source
    along = Window.partitionBy("source").orderBy("size")
    rate = F.when((F.col("size") > 0) & F.col("lam").isNotNull(), F.least(F.lit(float(limit)), _rate(F.col("lam"), F.col("size") / F.col("mean"), float(limit)))).otherwise(F.lit(0.0))
    cells = hist.join(per_source, on=F.col("source").eqNullSafe(F.col("of"))).withColumn("rate", rate)
    upto = F.floor(F.sum(F.col("n") * F.col("rate")).over(along) + 0.5)
    cells = cells.withColumn("upto", upto).withColumn(
        "total", F.greatest(F.lit(0), F.least(F.col("n") * limit, F.col("upto") - F.coalesce(F.lag("upto").over(along), F.lit(0)))))
    cells = cells.select("source", "size", "n", "rate", "source_size", "target", F.floor(F.col("total") / F.col("n")).alias("each"),
                         F.pmod(F.col("total"), F.col("n")).alias("more"), "total")
    # what is left to the target goes to the largest sizes that can give or take it
    whole = Window.partitionBy("source")
    largest = Window.partitionBy("source").orderBy(F.col("size").desc())
    rest = (F.round(F.col("target")) - F.sum(F.col("total") * F.col("size")).over(whole)).cast("bigint")
    room = F.when(F.col("rest") < 0, F.col("total")).otherwise(F.col("n") * limit - F.col("total")) * F.col("size")
    before = F.col("upto") - F.col("room")
    cells = cells.withColumn("rest", rest).withColumn("room", room).withColumn("upto", F.sum("room").over(largest))
    cells = stored(cells.withColumn("part", F.greatest(F.lit(0), F.least(F.col("room"), F.abs("rest") - before))).drop("room", "upto"))

    # the rank of each document in its cell: ranges of the id's hash, then ranks within a range
    keyed = sized.withColumn("cell", F.pmod(F.xxhash64("doc_id"), F.lit(CELLS)).cast("int"))
    ahead = keyed.groupBy("source", "size", "cell").agg(F.count("*").alias("m")).withColumn(
        "ahead", F.sum("m").over(Window.partitionBy("source", "size").orderBy("cell")) - F.col("m"))
    in_cell = Window.partitionBy("source", "size", "cell").orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id")
    ranked = keyed.withColumn("nth", F.row_number().over(in_cell))
    k, a, c = ranked.alias("k"), ahead.alias("a"), cells.alias("c")
    ranked = k.join(a, on=F.col("k.source").eqNullSafe(F.col("a.source")) & (F.col("k.size") == F.col("a.size")) & (F.col("k.cell") == F.col("a.cell"))).select(
        "k.doc_id", "k.source", "k.size", (F.col("k.nth") + F.col("a.ahead")).alias("rank")).alias("k")
    joined = ranked.join(c, on=F.col("k.source").eqNullSafe(F.col("c.source")) & (F.col("k.size") == F.col("c.size")))
    # within a cell the first ranks give or take as much as each can
    extra = (F.col("rank") <= F.col("more")).cast("bigint")
    copies, size = F.col("each") + extra, F.col("k.size")
    ahead_of = (F.col("rank") - 1) * F.col("each") + F.least(F.col("rank") - 1, F.col("more"))
    own = F.when(F.col("rest") < 0, copies).otherwise(limit - copies) * size
    used = F.when(F.col("rest") < 0, ahead_of).otherwise((F.col("rank") - 1) * limit - ahead_of) * size
    moved = F.greatest(F.lit(0), F.least(own, F.col("part") - used))
    taken = (copies * size + F.when(F.col("rest") < 0, -moved).otherwise(moved)).cast("bigint")
    return joined.select("doc_id", size.alias("size"), "source_size", "target", taken.alias("taken"),
                         F.when(size > 0, F.floor(taken / size)).otherwise(0).cast("bigint").alias("copies"), "rate")
