"""Mixing sources to target weights by entropy balancing.

Targets: sources in code-point order (null last) weigh 1, 2, 3, repeating, and
share all words by weight; a target stops at ``CAP`` times its source's size
and the excess is shared again by weight until none is above.

Rates: among all document rates w with 0 <= w <= CAP that give each source its
target, sum(w_i * size_i) = target, take the ones nearest to 1 in relative
entropy, sum(w_i * (ln w_i - 1)). The dual of that convex problem has one
multiplier per source, and its solution tilts documents exponentially in their
words: w_i = min(CAP, exp(multiplier * size_i / mean size)). The dual is solved
by Newton steps, kept inside a bracket that every step narrows (a step that
would leave it halves it instead). Each iteration is one aggregate by source
over a histogram (source, size) -> documents, written once; no step reads the
texts or holds a source in one task.

Copies: floor(w) or one more. Equal sizes of a source have equal rates, so
fractional parts are added up in the order of sizes and a document gets the
extra copy where the running sum passes a whole number (systematic rounding):
the words taken are within about one document of the target. Within a size,
documents are ordered by a hash of their id and text; sizes shared by many
documents (copies) are split into cells of about ``CELL`` documents first, so
neither the running sums nor the ranks hold a hot source in one task.

At scale: the text is read once for the sizes; what is shuffled are (id, size)
rows and the histogram. The running sum over cells goes in two levels (sizes
are dealt into ``BLOCK`` wide blocks, block totals are added up, then cells
within blocks), so its windows are bounded by a block's cells.

Defined results: a null or empty text has size 0 and takes 0 words (in
``mix_documents`` it stays once); a null source is a source; repeated rows are
separate documents, equal rows get the extra copies together as far as the
running sum allows; an empty table gives an empty result; extra columns are
ignored (``mix_documents`` passes them through).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, row_hash, stored, table

CAP = 3
WEIGHTS = (1, 2, 3)
CELL = 1000               # documents of a cell of equal sizes
BLOCK = 64                # sizes of a block of the running sum
ROUNDS = 60
CLOSE = 1e-9              # relative gap at which a source's constraint is met


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, row_hash, source, size of every row."""
    size = F.regexp_count(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(WORD)).cast("long")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_hash(["text"]).alias("row_hash"),
                       F.col("source").cast("string").alias("source"), size.alias("size"))


def targets(hist: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_size, n_docs, target) from the size histogram.

    The number of sources times a few numbers is all that is worked on here.
    Sharing the excess again keeps the shares of weight: a source is at its
    stop if the common level times its weight reaches it. Ordered by the level
    at which each source stops, the level with the first k stopped is
    (all - stops of those k) / (weights of the rest), and the k to use is the
    first whose next source doesn't reach its stop.
    """
    s = hist.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("n_docs"),
                                   F.sum(F.when(F.col("size") > 0, F.col("n")).otherwise(0)).alias("n_filled"))
    order = W.orderBy(F.col("source").isNull(), F.col("source"))
    place = F.row_number().over(order) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    s = stored(s.withColumn("weight", weight), "mix-sources")
    by_level = W.orderBy(F.col("stop") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    before = by_level.rowsBetween(W.unboundedPreceding, -1)
    ranked = (s.withColumn("stop", F.col("source_size") * float(cap))
              .withColumn("left", F.sum("source_size").over(W.partitionBy()) - F.coalesce(F.sum("stop").over(before), F.lit(0.0)))
              .withColumn("rest", F.sum("weight").over(W.partitionBy()) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
              .withColumn("level", F.col("left") / F.col("rest")))
    free = F.min(F.when(F.col("level") * F.col("weight") < F.col("stop"), F.struct(F.col("stop") / F.col("weight"), F.col("level").alias("level")))).over(W.partitionBy())
    level = free["level"]
    return ranked.withColumn("_level", level).select(
        "source", "source_size", "n_docs", "n_filled",
        F.when(F.col("_level").isNull(), F.col("stop")).otherwise(F.least(F.col("stop"), F.col("_level") * F.col("weight"))).alias("target"))


def _sum(x: Column) -> Column:
    """Sum in fixed point: the same whatever order rows come in, so that reruns agree."""
    return F.sum(x.cast("decimal(38,10)")).cast("double")


def _rate(multiplier: Column, z: Column, cap: int) -> Column:
    e = F.exp(F.least(multiplier * z, F.lit(50.0)))
    return F.least(e, F.lit(float(cap)))


def multipliers(hist: DataFrame, goal: DataFrame, cap: int = CAP) -> DataFrame:
    """(source, mean, multiplier, full): the dual solution; ``full`` sources take every document CAP times."""
    filled = goal.filter("source_size > 0")
    state = filled.select("source", "target", (F.col("source_size") / F.col("n_filled")).alias("mean"),
                          (F.col("target") >= F.col("source_size") * float(cap) * (1 - 1e-12)).alias("full"),
                          F.lit(0.0).alias("multiplier"), F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"),
                          F.lit(False).alias("done"))
    state = stored(state, "mix-dual")
    cells = hist.filter("size > 0")
    for _ in range(ROUNDS):
        open_ = state.filter("not full and not done")
        if open_.isEmpty():
            break
        j = cells.join(open_.select(F.col("source").alias("_s"), "mean", "multiplier"), F.col("source").eqNullSafe(F.col("_s")))
        z = F.col("size") / F.col("mean")
        w = _rate(F.col("multiplier"), z, cap)
        words = F.col("n") * F.col("size")
        sums = j.groupBy("source").agg(_sum(words * w).alias("got"),
                                       _sum(F.when(F.col("multiplier") * z < F.log(F.lit(float(cap))), words * w * z).otherwise(0.0)).alias("slope"))
        gap = F.col("got") - F.col("target")
        low = F.when(gap < 0, F.col("multiplier")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("multiplier")).otherwise(F.col("high"))
        newton = F.col("multiplier") - gap / F.col("slope")
        middle = (F.coalesce(F.col("low"), F.col("high") - 2 * F.abs(F.col("high")) - 1)
                  + F.coalesce(F.col("high"), F.col("low") + 2 * F.abs(F.col("low")) + 1)) / 2
        inside = (F.col("slope") > 0) & (F.col("low").isNull() | (newton > F.col("low"))) & (F.col("high").isNull() | (newton < F.col("high")))
        step = (state.join(sums.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
                .withColumn("low", low).withColumn("high", high)
                .withColumn("done", F.col("done") | F.coalesce(F.abs(gap) <= F.col("target") * CLOSE, F.lit(False)))
                .withColumn("multiplier", F.when(F.col("got").isNull() | F.col("done"), F.col("multiplier")).when(inside, newton).otherwise(middle))
                .select(*state.columns))
        state = stored(step, "mix-dual")
    else:
        if not state.filter("not full and not done").isEmpty():
            raise RuntimeError(f"the multipliers did not settle in {ROUNDS} rounds")
    return state.select("source", "mean", "multiplier", "full")


def mixed(docs: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """Every row with doc_id, row_hash, source, size, source_size, target, rate, copies, taken."""
    rows = stored(sized(docs), "mix-sizes")
    hist = stored(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-histogram")
    goal = stored(targets(hist, weights, cap), "mix-targets")
    dual = multipliers(hist, goal, cap)

    rate = F.when(F.col("full"), F.lit(float(cap))).otherwise(_rate(F.col("multiplier"), F.col("size") / F.col("mean"), cap))
    info = (goal.join(dual.withColumnRenamed("source", "_d"), F.col("source").eqNullSafe(F.col("_d")), "left").drop("_d")
            .withColumnRenamed("source", "_s"))
    rates = stored(hist.join(info, F.col("source").eqNullSafe(F.col("_s"))).drop("_s", "n_docs", "n_filled")
                   .withColumn("rate", F.when(F.col("size") > 0, rate).otherwise(1.0))
                   .withColumn("part", F.col("rate") - F.floor("rate"))
                   .withColumn("cells", F.ceil(F.col("n") / CELL))
                   .select("source", "size", "n", "source_size", "target", "rate", "part", "cells"), "mix-rates")

    # cells of equal (source, size), and the running sum of fractional parts before each
    key = F.xxhash64("doc_id", "row_hash")
    placed = (rows.join(rates.select(F.col("source").alias("_s"), F.col("size").alias("_z"), "source_size", "target", "rate", "part", "cells"),
                        F.col("source").eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_z"))).drop("_s", "_z")
              .withColumn("h", key).withColumn("cell", F.pmod(F.shiftright("h", 20), F.col("cells"))))
    placed = stored(placed, "mix-placed")
    counts = placed.filter("part > 0").groupBy("source", "size", "cell").agg(F.count(F.lit(1)).alias("m"), F.first("part").alias("part"))
    counts = counts.withColumn("block", F.floor(F.col("size") / BLOCK)).withColumn("sum", F.col("m") * F.col("part"))
    blocks = counts.groupBy("source", "block").agg(_sum(F.col("sum")).alias("sum"))
    upto = W.partitionBy("source").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    blocks = blocks.select(F.col("source").alias("_s"), F.col("block").alias("_b"), F.coalesce(F.sum("sum").over(upto), F.lit(0.0)).alias("base"))
    inner = W.partitionBy("source", "block").orderBy("size", "cell").rowsBetween(W.unboundedPreceding, -1)
    begun = (counts.withColumn("in_block", F.coalesce(F.sum("sum").over(inner), F.lit(0.0)))
             .join(blocks, F.col("source").eqNullSafe(F.col("_s")) & (F.col("block") == F.col("_b")))
             .select(F.col("source").alias("_s"), F.col("size").alias("_z"), F.col("cell").alias("_c"), (F.col("base") + F.col("in_block")).alias("before")))
    rank = F.row_number().over(W.partitionBy("source", "size", "cell").orderBy("h", "doc_id", "row_hash"))
    some = (placed.filter("part > 0").withColumn("rank", rank)
            .join(begun, F.col("source").eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_z")) & (F.col("cell") == F.col("_c")))
            .withColumn("extra", (F.floor(F.col("before") + F.col("rank") * F.col("part") + 0.5)
                                  > F.floor(F.col("before") + (F.col("rank") - 1) * F.col("part") + 0.5)).cast("int")))
    cols = ["doc_id", "row_hash", "source", "size", "source_size", "target", "rate"]
    whole = placed.filter("part = 0").select(*cols, F.lit(0).alias("extra"))
    out = whole.unionByName(some.select(*cols, "extra"))
    return (out.withColumn("copies", (F.floor("rate") + F.col("extra")).cast("int"))
            .withColumn("taken", F.col("size") * F.col("copies")).drop("extra"))


def mix_documents(docs: DataFrame, **kw) -> DataFrame:
    """``docs`` with every row repeated as often as the mix takes it."""
    plan = stored(mixed(docs, **kw).select("doc_id", "row_hash", "source", "copies"), "mix-copies")
    plan = plan.groupBy("doc_id", "row_hash", "source").agg(F.sum("copies").alias("sum"), F.count(F.lit(1)).alias("n"))
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("doc_id").cast("long").alias("_id"),
                        row_hash(["text"]).alias("_hash"), F.col("source").cast("string").alias("_source"))
    j = keyed.join(plan, F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_hash") == F.col("row_hash")) & F.col("_source").eqNullSafe(F.col("source")))
    once = j.filter("n = 1").select("_row", F.col("sum").alias("times"))
    # rows repeated whole share their copies; the first ones take the remainder
    nth = F.row_number().over(W.partitionBy("_id", "_hash", "_source").orderBy(F.lit(1)))
    again = j.filter("n > 1").withColumn("nth", nth).select("_row", (F.floor(F.col("sum") / F.col("n")) + (F.col("nth") <= F.col("sum") % F.col("n")).cast("long")).alias("times"))
    return (once.unionByName(again).filter("times > 0").select("_row", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("_n"))
            .select("_row.*"))


def op2_entropy_mix(spark, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "rate")
