"""Mixing sources to target weights by entropy balancing, in DataFrame operations only.

Each document gets a rate, the number of times the mix takes it. Among all rates
that meet each source's token constraint, those of least relative entropy against
one copy each are exponentially tilted: rate = exp(lambda * size / mean size), cut off at the
largest number of repeats. The convex dual has one unknown lambda a source. Newton iterations find all of them side by side:
in each, gradient and curvature of every source are sums over its documents' sizes, aggregated by the cluster, and a step
that leaves the bracket of the root is replaced by the bracket's middle. Rates are then rounded into whole copies so that a
source's taken words meet its target as nearly as its documents' sizes let them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parchment.llm.common import WORD, Shared, text_of

#: Iterations end when every source's gradient is under this share of its target, or after so many.
EXACT, NEWTON_STEPS = 1e-10, 60
#: Single corrections after rounding, each by the largest size that still fits.
CORRECTIONS = 6
#: Blocks over which documents of one source and size are ranked.
BLOCKS = 256


def numbered(sizes: DataFrame, shared: Shared) -> DataFrame:
    """sizes with nth, the place of each source in code point order from 1, null last.

    Sources are dealt to ranges, and ranked within; of each range only its number of sources reaches the driver.
    """
    dealt = sizes.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id())
    dealt = shared.save(dealt, "ranges")
    upto, before = 0, {}
    for r in sorted(dealt.groupBy("part").agg(F.count("*").alias("n")).collect()):
        before[r.part] = upto
        upto += r.n
    start = F.element_at(F.create_map(*[F.lit(x) for pair in before.items() for x in pair]), F.col("part")) if before else F.lit(0)
    own = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last()))
    return dealt.withColumn("nth", (own + start).cast("long")).drop("part")


def targets(sizes: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """(source, source_size, ...) -> with nth, weight, target: the total of all sizes shared by weight, none above most times its size.

    Sources must be distinct; weights repeat over them in code point order, null last. Those whose share exceeds the bound stop there, and the
    excess is shared again by weight, until none is above: the level at which the others share only rises, so each round binds
    further sources, and the last round binds none. A round is one sum over all sources.
    """
    shared = Shared(sizes.sparkSession, "targets")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    rows = numbered(sizes, shared).withColumn("weight", F.element_at(cycle, (F.pmod(F.col("nth") - 1, F.lit(len(weights))) + 1).cast("int")))
    rows = shared.save(rows, "weighted")
    bound = F.lit(float(most)) * F.col("source_size")
    total, level, last = rows.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0], 0.0, -1
    while True:
        # A hair of tolerance: equal by arithmetic, not by rounding.
        stops = bound < F.lit(level) * F.col("weight") * (1 - 1e-12)
        n, held, weight = rows.agg(F.count_if(stops), F.coalesce(F.sum(F.when(stops, F.col("source_size"))), F.lit(0)), F.sum(F.when(stops, 0.0).otherwise(F.col("weight")))).first()
        if n == last or not weight:
            break
        last, level = n, (total - float(most) * held) / weight
    return rows.withColumn("target", F.least(bound, F.lit(level) * F.col("weight")))


def tilts(grid: DataFrame, totals: DataFrame, shared: Shared, most: float) -> DataFrame:
    """(nth, lam, mean) of each source with a target between 0 and most times its size, from its sizes (nth, size, n).

    The gradient, sum of size * min(most, exp(lam * size / mean)) - target, rises with lam. Its root lies between
    ln(target / source_size) and ln(most), both over the least x = size / mean, with 0 as the other bound.
    """
    x, cap = F.col("size") / F.col("mean"), float(most)
    open_ = totals.where((F.col("target") > 0) & (F.col("target") < cap * F.col("source_size"))).select("nth", "target", "source_size")
    mean = grid.where("size > 0").groupBy("nth").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"), F.min("size").alias("small"))
    low, high = F.least(F.lit(0.0), F.log(F.col("target") / F.col("source_size"))), F.when(F.col("target") > F.col("source_size"), F.lit(cap)).otherwise(F.lit(1.0))
    least = F.col("small") / F.col("mean")
    state = open_.join(mean, "nth").select("nth", "target", "mean", (low / least).alias("lo"), (F.log(high) / least).alias("hi"), F.lit(0.0).alias("lam"))
    state = shared.save(state, "lam-0")
    sizes = grid.where("size > 0").select("nth", "size", "n")
    for i in range(1, NEWTON_STEPS + 1):
        tilted = sizes.join(state.select("nth", "mean", "lam"), "nth")
        raw, tokens = F.exp(F.least(F.col("lam") * x, F.lit(50.0))), F.col("size") * F.col("n")
        sums = tilted.groupBy("nth").agg(F.sum(tokens * F.least(F.lit(cap), raw)).alias("s"), F.sum(F.when(raw < cap, tokens * x * raw).otherwise(0.0)).alias("h"))
        both = state.join(sums, "nth").withColumn("g", F.col("s") - F.col("target"))
        both = both.withColumn("lo", F.when(F.col("g") <= 0, F.col("lam")).otherwise(F.col("lo"))).withColumn("hi", F.when(F.col("g") >= 0, F.col("lam")).otherwise(F.col("hi")))
        to = F.col("lam") - F.col("g") / F.nullif(F.col("h"), F.lit(0.0))
        done = F.abs("g") <= F.lit(EXACT) * F.col("target")
        step = F.when(done, F.col("lam")).when(to.between(F.col("lo"), F.col("hi")), to).otherwise((F.col("lo") + F.col("hi")) / 2)
        state = shared.save(both.select("nth", "target", "mean", "lo", "hi", step.alias("lam"), done.alias("done")), f"lam-{i}")
        if state.where("NOT done").isEmpty():
            break
    return state.select("nth", "lam", "mean")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """One row per input row: id, source, size, source_size, target, rate, copies, taken.

    size counts words (null and empty texts: 0) and taken = copies * size, with copies in 0..most.
    Documents without words get rate 0 and no copies. Null sources form one source, the last.
    Rows with equal source and size are alike, repeated rows too; which of them get the odd copy is fixed by a hash of the
    id (rows that share it, null ids among them, are told apart by nothing else), so reruns agree. An empty table gives an empty result; a source without words has
    target 0. Other columns are not read.
    """
    spark = docs.sparkSession
    shared = Shared(spark, "mixing")
    sized = shared.save(docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), F.regexp_count(text_of(text_col), F.lit(WORD)).cast("long").alias("size")), "sized")
    grid = shared.save(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "sizes")
    totals = targets(grid.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, most)
    totals = shared.save(totals, "totals")
    grid = grid.withColumnRenamed("source", "g_source").join(totals, F.col("g_source").eqNullSafe(F.col("source"))).drop("g_source")
    grid = shared.save(grid, "grid")
    rates = tilts(grid, totals, shared, float(most))

    # Copies for all documents of one source and size, rounded along falling size: the rounding error never exceeds half of the largest document.
    cap = F.when(F.col("target") <= 0, F.lit(0.0)).otherwise(F.lit(float(most)))
    rate = F.when(F.col("lam").isNull(), cap).otherwise(F.least(F.lit(float(most)), F.exp(F.least(F.col("lam") * F.col("size") / F.col("mean"), F.lit(50.0)))))
    cells = grid.join(rates, "nth", "left").withColumn("rate", F.when(F.col("size") > 0, rate).otherwise(0.0))
    of_source = Window.partitionBy("nth")
    falling = of_source.orderBy(F.col("size").desc())
    upto = F.sum(F.col("rate") * F.col("n")).over(falling.rowsBetween(Window.unboundedPreceding, 0))
    cells = cells.withColumn("upto", F.floor(upto + 0.5 + 1e-9)).withColumn("k", F.col("upto") - F.lag("upto", 1, 0).over(falling))
    cells = cells.withColumn("k", F.greatest(F.lit(0), F.least(F.col("k"), F.lit(most) * F.col("n"))))
    for _ in range(CORRECTIONS):
        cells = cells.withColumn("off", F.col("target") - F.sum(F.col("k") * F.col("size")).over(of_source))
        room = F.when(F.col("off") >= 0, F.lit(most) * F.col("n") - F.col("k")).otherwise(F.col("k"))
        # Documents without words change nothing.
        fits = F.when(F.col("size") > 0, F.least(room, F.floor(F.abs("off") / F.nullif(F.col("size"), F.lit(0))))).otherwise(0)
        cells = cells.withColumn("most_k", fits)
        cells = cells.withColumn("pick", F.max(F.when(F.col("most_k") > 0, F.col("size"))).over(of_source))
        cells = cells.withColumn("k", F.when(F.col("size") == F.col("pick"), F.col("k") + F.signum("off").cast("long") * F.col("most_k")).otherwise(F.col("k")))
    cells = shared.save(cells.select("source", "source_size", "target", "size", "n", "rate", "k"), "cells")

    # Of n documents that share k copies, k mod n get one more: ranked block by block, so no group meets in one task.
    keyed = sized.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(BLOCKS)))
    blocks = keyed.groupBy("source", "size", "block").agg(F.count("*").alias("m"))
    before = Window.partitionBy("source", "size").orderBy("block")
    blocks = blocks.withColumn("before", F.sum("m").over(before) - F.col("m"))
    dealt = blocks.alias("b").join(cells.alias("c"), F.col("b.source").eqNullSafe(F.col("c.source")) & (F.col("b.size") == F.col("c.size")))
    dealt = shared.save(dealt.select(F.col("b.source").alias("b_source"), F.col("b.size").alias("b_size"), F.col("block").alias("b_block"), "before", "source_size", "target", "n", "rate", "k"), "dealt")
    found = keyed.join(dealt, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("size") == F.col("b_size")) & (F.col("block") == F.col("b_block")))
    # Not ordered by id alone: neighbours in id are often neighbours in kind.
    nth = F.row_number().over(Window.partitionBy("source", "size", "block").orderBy(F.xxhash64("id", F.lit(1)), "id")) + F.col("before")
    copies = (F.floor(F.col("k") / F.col("n")) + (nth <= F.col("k") % F.col("n")).cast("long")).cast("long")
    found = found.withColumn("copies", copies)
    return found.select("id", "source", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def repeat(docs: DataFrame, id_col: str = "doc_id", **how) -> DataFrame:
    """docs with each row as many times as the mix takes it, all columns as they were.

    Rows that share an id and size share the copies of all of them: they are alike to the mix.
    """
    names = set(docs.columns)
    c = {x: next(f"_{x}{i}" for i in range(99) if f"_{x}{i}" not in names) for x in ("id", "source", "size", "copies", "nth", "copy")}
    source, text = how.get("source_col", "source"), how.get("text_col", "text")
    taken = mix(docs, id_col, **how).groupBy("id", "source", "size").agg(F.array_sort(F.collect_list("copies")).alias(c["copies"]))
    taken = taken.select(*[F.col(x).alias(c[x]) for x in ("id", "source", "size")], c["copies"])
    size = F.regexp_count(text_of(text), F.lit(WORD)).cast("long")
    rows = docs.join(taken, docs[id_col].eqNullSafe(F.col(c["id"])) & docs[source].cast("string").eqNullSafe(F.col(c["source"])) & (size == F.col(c["size"])))
    one = Window.partitionBy(c["id"], c["source"], c["size"]).orderBy(text)
    rows = rows.withColumn(c["nth"], F.row_number().over(one))
    times = F.element_at(c["copies"], F.col(c["nth"])).cast("int")
    return rows.withColumn(c["copy"], F.explode(F.when(times > 0, F.sequence(F.lit(1), times)))).select(docs.columns)
