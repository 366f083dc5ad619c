"""Mixing sources to target weights by entropy balancing; DataFrame operations only.

The mix takes ``share`` times all words. Sources get it by weight; a target stops at ``most`` times
its source's size and the excess is shared anew by weight (water filling).

Document rates are those closest to the wish in relative entropy that meet every source's token
constraint: ``rate = least(most, exp(a * x))`` with ``x`` the document's size over its source's mean
size, so that rates are exponentially tilted and long documents move most. ``a`` solves the convex
dual, one equation for each source. Newton steps, kept inside a shrinking bracket, run on all sources
at once; each is one aggregate over the histogram (source, size), to which documents are summed
before any shuffle, so a source with a third of all rows weighs no more than its distinct sizes.

Rates become copies per cell of the histogram: the running sum of rates over falling sizes is rounded,
which gives every cell whole copies; the words still missing or too many are then settled in
``settle`` rounds, each moving the largest cell that fits. Copies of a cell are dealt to its documents
in the order of a hash, numbered in salted groups, so that no group holds a whole hot cell. Nothing is
random: reruns agree.

Null and empty texts have size 0 and are not taken. A null source is a source of its own, sorted last.
Equal rows may get different numbers of copies, which differ by one at most. An empty table gives an
empty mix. Other columns are kept; helper columns avoid their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glebe.llm.tables import apart, stored

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
TOLERANCE = 1e-6
SETTLE = 4


def word_count(text: Column) -> Column:
    """Number of words between ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, target) of a table (source, source_size), one row for each source.

    ``source`` is a struct of the name, so that a null name joins like any other.

    Sources are few against documents; they are numbered and ranked in one sorted run.
    """
    order = Window.orderBy(F.col("source.name").asc_nulls_last())
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(order) - 1) % len(weights))
    listed = sizes.withColumn("weight", weight)
    # the level that fills the targets: sources are full in the order of room per weight
    room = most * F.col("source_size")
    full = Window.orderBy(room / F.col("weight"), F.col("source.name").asc_nulls_last())
    every = Window.partitionBy(F.lit(1))
    before = full.rowsBetween(Window.unboundedPreceding, -1)
    amount = share * F.sum("source_size").over(every)
    rest = amount - F.coalesce(F.sum(room).over(before), F.lit(0.0))
    left = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    ranked = listed.withColumn("level", rest / left).withColumn("open", F.col("level") * F.col("weight") < room)
    level = F.min(F.when(F.col("open"), F.struct((room / F.col("weight")).alias("at"), "level"))).over(every)["level"]
    goal = F.when(level.isNull(), room).otherwise(F.least(room, level * F.col("weight")))
    return ranked.select("source", "source_size", goal.cast("double").alias("target"))


def tilts(cells: DataFrame, goals: DataFrame, most: float = MOST, tolerance: float = TOLERANCE) -> DataFrame:
    """(source, a): the dual variable of each source's token constraint.

    ``cells`` has (source, size, n), ``goals`` (source, source_size, target).
    """
    mean = cells.groupBy("source").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"), F.max("size").alias("longest"))
    state = goals.join(mean, "source").select(
        "source", "target", "mean", F.lit(0.0).alias("a"), F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"),
        (F.col("source_size") > 0).alias("going"),
    )
    state = stored(state, "tilts")
    while not state.filter("going").isEmpty():
        joined = cells.join(state.select("source", "a", "mean").filter("mean > 0"), "source")
        x = F.col("size") / F.col("mean")
        tilted = F.exp(F.least(F.col("a") * x, F.lit(50.0)))
        taken = F.col("n") * F.col("size") * F.least(tilted, F.lit(float(most)))
        moments = joined.groupBy("source").agg(
            F.sum(taken).alias("got"), F.sum(F.when(tilted < most, taken * x).otherwise(0.0)).alias("slope")
        )
        now = state.join(moments, "source", "left")
        gap = F.col("target") - F.col("got")
        low = F.when(gap > 0, F.col("a")).otherwise(F.col("low"))
        high = F.when(gap <= 0, F.col("a")).otherwise(F.col("high"))
        bounded = now.withColumns({"gap": gap, "l": low, "h": high, "newton": F.col("a") + gap / F.when(F.col("slope") > 0, F.col("slope"))})
        inside = (F.col("l").isNull() | (F.col("newton") > F.col("l"))) & (F.col("h").isNull() | (F.col("newton") < F.col("h")))
        beyond = F.when(F.col("h").isNull(), F.greatest(2 * F.col("l"), F.lit(1.0))).when(F.col("l").isNull(), F.least(2 * F.col("h"), F.lit(-1.0)))
        step = F.when(inside, F.col("newton")).otherwise(F.coalesce(beyond, (F.col("l") + F.col("h")) / 2))
        done = (F.abs("gap") <= tolerance * F.col("target")) | (F.col("h") - F.col("l") < 1e-12) | (F.col("l") > 1e6) | (F.col("h") < -1e6)
        going = F.col("going") & ~F.coalesce(done, F.lit(False))
        state = stored(
            bounded.select("source", "target", "mean", F.when(going, step).otherwise(F.col("a")).alias("a"),
                           F.col("l").alias("low"), F.col("h").alias("high"), going.alias("going")), "tilts",
        )
    return state.select("source", "a", "mean", "target")


def cell_copies(cells: DataFrame, tilted: DataFrame, most: int = MOST, settle: int = SETTLE) -> DataFrame:
    """(source, size, n, copies): whole copies of each cell, whose words come near the source's target."""
    joined = cells.join(tilted, "source").filter("size > 0")
    rate = F.least(F.exp(F.least(F.col("a") * F.col("size") / F.col("mean"), F.lit(50.0))), F.lit(float(most)))
    falling = Window.partitionBy("source").orderBy(F.col("size").desc())
    upto = F.round(F.sum(F.col("n") * rate).over(falling.rowsBetween(Window.unboundedPreceding, 0))).cast("long")
    out = joined.withColumn("upto", upto)
    copies = F.col("upto") - F.coalesce(F.lag("upto").over(falling), F.lit(0))
    out = out.withColumn("copies", F.least(F.greatest(copies, F.lit(0)), F.col("n") * most)).select("source", "size", "n", "target", "copies")
    for _ in range(settle):
        out = stored(out, "cells")
        gaps = out.groupBy("source").agg((F.first("target") - F.sum(F.col("copies") * F.col("size"))).alias("gap"))
        with_gap = out.join(gaps, "source")
        free = F.when(F.col("gap") > 0, F.col("n") * most - F.col("copies")).otherwise(F.col("copies"))
        fits = with_gap.withColumn("moves", F.least(free, F.floor(F.abs("gap") / F.col("size"))))
        best = fits.filter("moves > 0").groupBy("source").agg(F.max(F.struct("size", "moves", "gap")).alias("best"))
        moved = out.join(best.withColumn("size", F.col("best.size")), ["source", "size"], "left")
        change = F.coalesce(F.signum("best.gap") * F.col("best.moves"), F.lit(0.0)).cast("long")
        out = moved.select("source", "size", "n", "target", (F.col("copies") + change).alias("copies"))
    return out.select("source", "size", "n", "copies")


def mix(
    docs: DataFrame, doc_id: str = "doc_id", source: str = "source", size: Column | None = None,
    weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: int = MOST,
) -> tuple[DataFrame, list[str]]:
    """``docs`` with size, source size, target and number of copies; returns the names of these columns.

    ``size`` gives a row's words; by default those of the column ``text``.
    """
    names = apart(docs, "size", "source_size", "target", "copies")
    own, key, salt, turn, each, more = apart(docs, "mix_source", "mix_key", "mix_salt", "mix_turn", "mix_each", "mix_more")
    size = word_count(F.col("text")) if size is None else size
    salts = 4 * max(16, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    keyed = docs.withColumns({names[0]: size, own: F.struct(F.col(source).alias("name")), key: F.xxhash64(F.col(doc_id).cast("string"))})
    keyed = keyed.withColumn(salt, F.pmod(key, F.lit(salts)).cast("int"))
    slim = keyed.select(F.col(own).alias("source"), F.col(names[0]).alias("size"), F.col(salt).alias("salt"))
    groups = stored(slim.groupBy("source", "size", "salt").agg(F.count("*").alias("m")), "groups")
    cells = stored(groups.groupBy("source", "size").agg(F.sum("m").alias("n")), "cells")
    sums = cells.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    goals = stored(targets(sums, weights, share, most), "targets")
    copies = stored(cell_copies(cells, tilts(cells, goals, most), most), "copies")
    # the documents of a cell are numbered in salted groups, which start where the earlier ones end
    earlier = Window.partitionBy("source", "size").orderBy("salt").rowsBetween(Window.unboundedPreceding, 0)
    dealt = groups.withColumn("before", F.sum("m").over(earlier) - F.col("m")).join(copies, ["source", "size"]).select(
        F.col("source").alias(own), F.col("size").alias(names[0]), F.col("salt").alias(salt),
        F.floor(F.col("copies") / F.col("n")).alias(each), (F.col("copies") % F.col("n") - F.col("before")).alias(more),
    )
    place = [own, names[0], salt]
    numbered = keyed.withColumn(turn, F.row_number().over(Window.partitionBy(*place).orderBy(key)))
    goals = goals.select(F.col("source").alias(own), F.col("source_size").alias(names[1]), F.col("target").alias(names[2]))
    out = numbered.join(dealt, place, "left").join(goals, own, "left")
    taken = F.coalesce(F.col(each) + (F.col(turn) <= F.col(more)).cast("long"), F.lit(0)).cast("long")
    return out.select(*docs.columns, *names[:3], taken.alias(names[3])), names


def mixture(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: every document as often as the mix takes it."""
    mixed, (_, _, _, copies) = mix(docs, **options)
    nth, = apart(mixed, "nth")
    return mixed.filter(F.col(copies) > 0).select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col(copies))).alias(nth)).select(*docs.columns)
