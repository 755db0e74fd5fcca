"""Mixing sources to target weights by entropy balancing.

Rates r of documents minimise the relative entropy sum(r * log(r) - r + 1) to one copy each, under one
token constraint a source, sum(size * r) = target, and 0 <= r <= most.  The convex dual has one
multiplier m for each source, and its solution tilts documents exponentially by their size,
r = min(most, exp(m * size)).  Newton iterations on the dual find the multipliers, each a grouped
aggregate over the counts of (source, size).  Rates are then rounded into whole copies.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from laptrace.llm.tables import numbered, stored, summed_before, word_count

#: Steps at most; Newton takes some 4 to 12, halving of the bracket the rest.
NEWTON_STEPS = 100
#: Largest relative distance of a source's tilted words from its target.
TOLERANCE = 1e-9
#: Rows of one source and size that one window may hold.
SLICE_ROWS = 2000
#: Rates are rounded into copies in units of 2 ** -UNIT, sums of the dual are taken in units of 2 ** -60 of the
#: target; both are whole numbers, so reruns agree whatever the order of rows.
UNIT = 30


def targets(totals: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Adds ``weight`` and ``target`` to (source, source_size, docs).

    Sources in code point order, null last, take the weights in turn and share ``share`` times all
    words.  A target stops at ``most`` times its source; what is above goes to the others by weight,
    again and again until nothing is above.  Each round is one aggregate over the sources.
    """
    if not 0 <= share <= most:
        raise ValueError("the sources can't fill that share")
    places = numbered(totals, "place", F.col("source").isNull(), F.col("source"))
    turn = (F.col("place") - 1) % len(weights)
    weighted = stored(places.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                                               (turn + 1).cast("int"))).drop("place"), "weights")
    limit, size = most * F.col("source_size"), F.col("source_size")
    total = weighted.agg(F.sum(size)).first()[0] or 0
    level, full = None, -1
    while total:
        over = F.lit(False) if level is None else F.col("weight") * level >= limit
        fixed, rest, count = weighted.agg(
            F.coalesce(F.sum(F.when(over, limit)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0)),
            F.count(F.when(over, 1))).first()
        if count == full or not rest:
            level = level if rest else float("inf")
            break
        full, level = count, (share * total - fixed) / rest
    return weighted.withColumn("target", F.least(limit, F.col("weight") * F.lit(level or 0.0)))


def _whole_sum(value: Column) -> Column:
    """A sum of doubles that does not depend on their order."""
    return F.sum((value * 2.0 ** 60).cast("decimal(38,0)")).cast("double") / 2.0 ** 60


def multipliers(cells: DataFrame, most: float) -> DataFrame:
    """source, m: what solves the dual of every source with 0 < target < most * source_size.

    ``cells`` has source, size, docs, source_size and target.  A step is Newton's on the logarithm of the tilted
    words, from the multiplier that would fit documents of the mean size (weighted by words); where it leaves the
    bracket of what was too small and too large, the bracket is halved.  Each step is one aggregate by source.
    """
    cells = cells.filter((F.col("target") > 0) & (F.col("target") < most * F.col("source_size")) & (F.col("size") > 0))
    words = F.col("docs") * F.col("size")
    mean = F.sum((words * F.col("size")).cast("decimal(38,0)")).cast("double") / F.first("source_size")
    state = stored(cells.groupBy("source").agg(mean.alias("mean"), F.first("target").alias("target"),
                                               F.first("source_size").alias("source_size")).select(
        "source", "mean", "target", F.log(F.col("target") / F.col("source_size")).alias("u"),
        F.lit(float("-inf")).alias("low"), F.lit(float("inf")).alias("high")), "dual")
    power = F.col("u") * F.col("size") / F.col("mean")
    bound = float(math.log(most))
    tilted = words * F.exp(F.least(power, F.lit(bound))) / F.col("s.target")
    bending = F.when(power < bound, tilted * F.col("size") / F.col("mean")).otherwise(0.0)
    for _ in range(NEWTON_STEPS):
        sums = cells.alias("c").join(state.alias("s"), F.col("c.source").eqNullSafe(F.col("s.source"))).groupBy(
            F.col("c.source").alias("of")).agg(_whole_sum(tilted).alias("g"), _whole_sum(bending).alias("h"))
        step = state.join(sums, F.col("source").eqNullSafe(F.col("of"))).drop("of").withColumns({
            "low": F.when(F.col("g") < 1, F.col("u")).otherwise(F.col("low")),
            "high": F.when(F.col("g") > 1, F.col("u")).otherwise(F.col("high")),
            "off": F.abs(F.col("g") - 1)})
        newton = F.col("u") - F.log("g") * F.col("g") / F.when(F.col("h") > 0, F.col("h"))
        inside = (newton > F.col("low")) & (newton < F.col("high"))
        moved = F.when(F.col("off") <= TOLERANCE, F.col("u")).when(inside, newton).otherwise(
            (F.col("low") + F.col("high")) / 2)
        state = stored(step.select("source", "mean", "target", moved.alias("u"), "low", "high", "off"), "dual")
        if (state.agg(F.max("off")).first()[0] or 0.0) <= TOLERANCE:
            return state.select("source", (F.col("u") / F.col("mean")).alias("m"))
    raise ArithmeticError("a source's multiplier was not found")


def rates(cells: DataFrame, most: float = 2.0) -> DataFrame:
    """Adds ``rate``, the exponential tilt that meets each source's token constraint.

    ``cells`` has source, size, docs, source_size and target.  No constraint touches documents without words: their
    rate is 1, or ``most`` if that is less.  A target of 0 gives all others rate 0, one of ``most`` times the
    source gives them ``most``.
    """
    solved = multipliers(cells, most).withColumnRenamed("source", "of")
    joined = cells.join(solved, F.col("source").eqNullSafe(F.col("of")), "left").drop("of")
    size, target = F.col("size"), F.col("target")
    rate = (F.when(size <= 0, F.lit(min(1.0, most))).when(target <= 0, F.lit(0.0))
            .when(F.col("m").isNull(), F.lit(float(most)))
            .otherwise(F.least(F.lit(float(most)), F.exp(F.least(F.col("m") * size, F.lit(700.0))))))
    return joined.withColumn("rate", rate).drop("m")


def mix(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text",
        weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, rate, copies, taken.

    ``taken`` is copies * size.  Copies are the floor or the ceiling of the rate: the parts beyond the floor are added
    up over the documents, from large to small within a source, those of one size in order of a hash, and a document
    that lifts the sum over a half takes one more.  As sizes only fall, a source's taken words differ from the tilted
    ones by one largest document at most.

    Null texts and texts without words have size 0 and one copy; a null source is a source of its own, the last; a
    null id is an id like any other; repeated rows are separate documents; an empty table gives an empty result;
    other columns are not looked at.
    """
    sized = stored(docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"),
        word_count(F.col(text)).alias("size")), "sizes")
    cells = stored(sized.groupBy("source", "size").agg(F.count("*").alias("docs")), "cells")
    totals = cells.groupBy("source").agg(F.sum(F.col("size") * F.col("docs")).alias("source_size"),
                                         F.sum("docs").alias("docs"))
    aims = stored(targets(totals, weights, share, most).select(F.col("source").alias("of"), "source_size", "target"),
                  "targets")
    aimed = stored(cells.join(aims, F.col("source").eqNullSafe(F.col("of"))).drop("of"), "aimed")
    part = F.round((F.col("rate") - F.floor("rate")) * 2.0 ** UNIT).cast("long")
    rated = stored(rates(aimed, most).withColumn("part", part), "rates")

    # sizes that many documents of a source share are cut into slices
    crowded = cells.filter(F.col("docs") > SLICE_ROWS).select(
        "source", "size", F.ceil(F.col("docs") / SLICE_ROWS).cast("int").alias("slices"))
    mark = F.xxhash64("d.doc_id", "d.size")
    sliced = sized.alias("d").join(
        crowded.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")) & (F.col("d.size") == F.col("s.size")), "left"
    ).select("doc_id", "d.source", "d.size", mark.alias("mark"),
             F.coalesce(F.pmod(F.xxhash64(mark, F.lit(1)), F.col("slices")), F.lit(0)).cast("int").alias("slice"))
    counts = sliced.groupBy("source", "size", "slice").agg(F.count("*").alias("rows"))
    slices = counts.alias("n").join(
        rated.alias("r"), F.col("n.source").eqNullSafe(F.col("r.source")) & (F.col("n.size") == F.col("r.size"))
    ).select("n.source", "n.size", "slice", "rows", "source_size", "target", "rate", "part")
    # only the sum's remainder matters to where it is lifted over the next half
    starts = summed_before(slices, "before", F.pmod(F.col("rows") * F.col("part"), F.lit(1 << UNIT)),
                           F.col("source"), F.col("size").desc(), F.col("slice"))
    inside = F.row_number().over(Window.partitionBy("source", "size", "slice").orderBy("mark", "doc_id"))
    joined = sliced.withColumn("inside", inside).alias("d").join(
        starts.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")) & (F.col("d.size") == F.col("s.size"))
        & (F.col("d.slice") == F.col("s.slice")))
    upto = F.col("before") + F.col("inside") * F.col("part") + F.lit(1 << UNIT - 1)
    extra = F.shiftright(upto, UNIT) - F.shiftright(upto - F.col("part"), UNIT)
    copies = (F.floor("rate") + extra).cast("int")
    return joined.select("doc_id", "d.source", "d.size", "source_size", "target", "rate", copies.alias("copies"),
                         (copies * F.col("d.size")).alias("taken"))


def repeated(docs: DataFrame, mixed: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it.

    Ids are expected to be unique and are compared null-safe; rows that share an id are taken as often
    as the largest number of copies any of them has.  Columns may have any name; an empty table stays empty.
    """
    copies = mixed.groupBy(F.col("doc_id").alias("mix_id_")).agg(F.max("copies").alias("mix_copies_"))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    joined = whole.join(copies, F.col("row")[doc_id].eqNullSafe(F.col("mix_id_"))).filter("mix_copies_ > 0")
    return joined.select("row", F.explode(F.sequence(F.lit(1), F.col("mix_copies_")))).select(
        *[F.col("row")[c].alias(c) for c in docs.columns])
