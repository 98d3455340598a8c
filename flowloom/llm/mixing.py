"""Mixing sources to target weights by entropy balancing.

Every document d of source s gets a rate r, how often it is to be taken. Among all rates that give source s its
target of words T, those nearest to 1 in relative entropy and at most ``MOST`` are

    r(d) = min(MOST, exp(lambda_s * z(d))),      z(d) = the document's words / the source's mean

one multiplier for each token constraint. The dual is convex in lambda; Newton steps, kept inside a bracket, solve
it for all sources at once: each step is one distributed sum over the cells below. Then the rates become copies.

* Cells: documents of one source and one size class (sizes within 1/16 octave; small sizes have a class each) share a
  rate, so counts and words per cell are all the iterations read. A cell with many rows is cut into parts by a hash.
* Rounding: per source, from the largest class to the smallest, a cell takes the whole number of copies nearest to what
  it should have plus what earlier cells left over, so the leftover at the end is about one small document. Inside a cell the
  copies go to documents evenly in order of size. Everything rests on integer sums and values rounded before use,
  so reruns agree.

Defined results: a null text has no words and takes nothing; a null source is a source of its own, last in order;
repeated rows are documents of their own; a source without words has target 0; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowloom.llm.catalog import query
from flowloom.llm.common import documents, n_words, store

#: No document is taken more often than this; it is also the cap of a source's target over its size.
MOST = 3
#: Weights of the sources in order, repeated.
WEIGHTS = (1, 2, 3)
#: Size classes per octave, rows from which a cell is cut into parts (as a share of all rows), and Newton's limits.
PER_OCTAVE, HOT_SHARE, STEPS, TOLERANCE = 16, 1 / 500, 60, 1e-7


def source_targets(slim: DataFrame, most: float = MOST, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, n, source_size, target): shares by weight, stopped at ``most`` times the source's size, the excess
    shared again by weight among the others. One row per source, so the windows over sources are small."""
    sizes = slim.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size"))
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.row_number().over(in_order) - 1) % len(weights) + 1).cast("int"))
    weighed = sizes.select("*", weight.cast("double").alias("w"))
    # the level at which everything is shared out: sources fill up in order of size / weight
    filling = Window.orderBy(F.col("source_size") / F.col("w"), F.col("source").asc_nulls_last())
    before, after = filling.rowsBetween(Window.unboundedPreceding, -1), filling.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy())
    level = (total - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / F.sum("w").over(after)
    open_level = F.when(F.col("level") * F.col("w") <= most * F.col("source_size"), F.col("level"))
    levels = weighed.select("*", level.alias("level")).select("*", open_level.alias("own"))
    chosen = F.max("own").over(Window.partitionBy())
    target = F.least(most * F.col("source_size").cast("double"), F.coalesce(chosen, F.lit(math.inf)) * F.col("w"))
    return levels.select("source", "n", "source_size", target.alias("target"))


def size_class(size: Column) -> Column:
    return F.when(size > 0, F.floor(F.log2(size.cast("double")) * PER_OCTAVE)).otherwise(-1).cast("int")


def hot_cells(slim: DataFrame, rows: int) -> DataFrame:
    """(hot_source, hot_class, parts) of the cells that are cut into parts; at most 1 / HOT_SHARE rows."""
    cap = max(64, int(rows * HOT_SHARE))
    counts = slim.groupBy("source", size_class(F.col("size")).alias("class")).agg(F.count("*").alias("rows"))
    return counts.where(F.col("rows") > cap).select(
        F.col("source").alias("hot_source"), F.col("class").alias("hot_class"), F.ceil(F.col("rows") / cap).alias("parts"))


def in_cells(df: DataFrame, hot: DataFrame) -> DataFrame:
    """``df`` with its cell: class and part."""
    own = size_class(F.col("size"))
    same = F.col("source").eqNullSafe(F.col("hot_source")) & (own == F.col("hot_class"))
    part = F.pmod(F.xxhash64("doc_id", "tie"), F.coalesce("parts", F.lit(1).cast("long"))).cast("int")
    return df.join(F.broadcast(hot), same, "left").select(*df.columns, own.alias("class"), part.alias("part"))


def multipliers(cells: DataFrame, targets: DataFrame, most: float = MOST) -> DataFrame:
    """(source, lam) by safeguarded Newton steps on the dual, one distributed sum over the cells per step."""
    cells = cells.where("words > 0").withColumnRenamed("source", "s")
    top = F.lit(math.log(most))
    same = F.col("s").eqNullSafe(F.col("source"))
    usable = targets.where("source_size > 0 and target > 0")
    z = (F.col("words") / F.col("n")) / F.col("mean")
    joined = cells.join(usable.select("source", (F.col("source_size") / F.col("n")).alias("mean")), same).select("source", "words", z.alias("z"))
    joined = store(joined, "dual")  # one row per cell
    state = usable.join(joined.groupBy(F.col("source").alias("s")).agg(F.min("z").alias("z_min")), same).select(
        "source", "target", F.lit(0.0).alias("lam"),
        F.least(F.lit(0.0), F.log(F.col("target") / F.col("source_size")) / F.col("z_min")).alias("lo"), (top / F.col("z_min")).alias("hi"),
        F.lit(False).alias("done"))
    state = state.checkpoint()
    for _ in range(STEPS):
        at = joined.withColumnRenamed("source", "s").join(state, same)
        power = F.col("lam") * F.col("z")
        rate = F.exp(F.least(power, top))
        slope = F.when(power < top, F.col("words") * F.col("z") * rate).otherwise(0.0)
        sums = at.groupBy("source", "target", "lam", "lo", "hi").agg(F.sum(F.col("words") * rate).alias("f"), F.sum(slope).alias("df"))
        lo = F.when(F.col("f") <= F.col("target"), F.col("lam")).otherwise(F.col("lo"))
        hi = F.when(F.col("f") >= F.col("target"), F.col("lam")).otherwise(F.col("hi"))
        done = F.abs(F.col("f") - F.col("target")) <= TOLERANCE * F.col("target")
        newton = F.col("lam") - (F.col("f") - F.col("target")) / F.col("df")
        stepped = sums.select("*", lo.alias("lo2"), hi.alias("hi2"), done.alias("done"), newton.alias("newton"))
        inside = (F.col("df") > 0) & (F.col("newton") > F.col("lo2")) & (F.col("newton") < F.col("hi2"))
        lam = F.when(F.col("done"), F.col("lam")).when(inside, F.col("newton")).otherwise((F.col("lo2") + F.col("hi2")) / 2)
        state = stepped.select("source", "target", lam.alias("lam"), F.col("lo2").alias("lo"), F.col("hi2").alias("hi"), "done").checkpoint()
        if state.where(~F.col("done") & (F.col("hi") - F.col("lo") > 1e-12 * F.abs(F.col("hi")))).isEmpty():
            break
    return state.select("source", F.round("lam", 9).alias("lam"))


def cell_copies(cells: DataFrame, targets: DataFrame, lams: DataFrame, most: int = MOST) -> DataFrame:
    """(source, class, part, copies): rates rounded, leftovers handed on from large classes to small ones.

    The array per source has one entry per size class (at most 16 an octave) and per part of a hot cell: a fixed number.
    """
    same = F.col("s").eqNullSafe(F.col("source"))
    lams = lams.withColumnRenamed("source", "s")
    top = F.lit(math.log(most))
    known = targets.join(lams, same, "left").select("source", "target", (F.col("source_size") / F.col("n")).alias("mean"), "lam").withColumnRenamed("source", "s")
    mean_size = F.col("words") / F.col("n")
    rate = F.when(F.col("target") > 0, F.exp(F.least(F.col("lam") * mean_size / F.col("mean"), top))).otherwise(0.0)
    rated = cells.where("words > 0").join(known, same).select("source", "target", F.struct(
        F.negative("class").alias("order"), "part", "n", "words", F.round(F.col("n") * rate, 6).alias("due")).alias("cell"))
    listed = rated.groupBy("source").agg(F.first("target").alias("target"), F.sort_array(F.collect_list("cell")).alias("cells"))

    def take(state: Column, cell: Column) -> Column:
        size = cell["words"] / cell["n"]
        wanted = F.floor(cell["due"] + state["left"] / size + F.lit(0.5))
        copies = F.least(F.greatest(wanted, F.lit(0).cast("long")), cell["n"] * most)
        left = state["left"] + (cell["due"] - copies) * size
        return F.struct(left.alias("left"), F.array_append(state["copies"], copies).alias("copies"))

    start = F.struct(F.lit(0.0).alias("left"), F.array().cast("array<bigint>").alias("copies"))
    taken = listed.select("source", "cells", F.aggregate("cells", start, take)["copies"].alias("copies"))
    each = taken.select("source", F.explode(F.arrays_zip("cells", "copies")).alias("x"))
    return each.select("source", F.negative("x.cells.order").alias("class"), F.col("x.cells.part").alias("part"), F.col("x.cells.n").alias("n"), F.col("x.copies").alias("copies"))


def mix(df: DataFrame, slim: DataFrame, most: int = MOST, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``df`` with source_size, target and ``copies`` added.

    ``slim`` (doc_id, source, size, tie) is a stored table of the same rows, on which everything is counted and solved; ``df`` has
    these columns too, and others.
    """
    targets = store(source_targets(slim, most, weights), "targets")
    hot = store(hot_cells(slim, slim.count()), "hot")
    cells = store(in_cells(slim, hot).groupBy("source", "class", "part").agg(F.count("*").alias("n"), F.sum("size").alias("words")), "cells")
    copies = store(cell_copies(cells, targets, multipliers(cells, targets, most), most), "copies")
    # the copies of a cell, spread evenly over its documents in order of size
    spread = Window.partitionBy("source", "class", "part").orderBy("size", F.xxhash64("doc_id", "tie"), "doc_id", "tie")
    ranked = in_cells(df, hot).select("*", F.row_number().over(spread).cast("long").alias("rank"))
    c = copies.select(F.col("source").alias("c_source"), F.col("class").alias("c_class"), F.col("part").alias("c_part"), F.col("n").alias("c_n"), F.col("copies").alias("c_copies"))
    t = targets.select(F.col("source").alias("t_source"), "source_size", "target")
    of_cell = F.col("source").eqNullSafe(F.col("c_source")) & (F.col("class") == F.col("c_class")) & (F.col("part") == F.col("c_part"))
    share = F.expr("(rank * c_copies) div c_n - ((rank - 1) * c_copies) div c_n")
    return (
        ranked.join(c, of_cell, "left").join(t, F.col("source").eqNullSafe(F.col("t_source")), "left")
        .select(*df.columns, "source_size", "target", F.coalesce(share, F.lit(0).cast("long")).alias("copies"))
    )


def slim_columns(docs: DataFrame) -> list[Column]:
    return [F.col("doc_id"), F.col("source"), n_words("text").alias("size"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("tie")]


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """The columns of ``docs``, each row as often as the mix takes it; ``docs`` must be a stored table."""
    own = slim_columns(docs)
    mixed = mix(docs.select(F.struct(*docs.columns).alias("__row"), *own), store(docs.select(*own), "words"), weights=weights)
    return mixed.where("copies > 0").select("__row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("__row.*")


@query("op10_mixing")
def op10_mixing(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    slim = store(docs.select(*slim_columns(docs)), "words")
    return mix(slim, slim).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "copies")
