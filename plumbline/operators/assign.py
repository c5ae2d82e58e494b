"""Assignment by rank: what fits by number, else by length, else the nearest that is still free."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.scratch import scratch, written


def settle(pairs: DataFrame) -> DataFrame:
    """(sheet, block, curve) such that each block, in order of its number, has the nearest curve that no earlier one took.

    ``pairs``: sheet, block, curve, gap. Blocks ask for their nearest curve all at once; a curve keeps the earliest that asks,
    and nobody behind that one can get it any more, so those pairs go. The others ask again until no pair goes: the result
    is that of taking turns, as all curves prefer earlier blocks. Ties in the gap go to the smaller curve.
    """
    left = written(pairs.select("sheet", "block", "curve", "gap"), "assign")
    while True:
        asked = left.groupBy("sheet", "block").agg(F.min(F.struct("gap", "curve")).alias("best")).select("sheet", "block", F.col("best.curve").alias("curve"))
        kept = asked.groupBy("sheet", "curve").agg(F.min("block").alias("holder"))
        held = left.join(kept, ["sheet", "curve"], "left").withColumn("goes", F.coalesce(F.col("block") > F.col("holder"), F.lit(False)))
        held = written(held, "assign")
        if held.where("goes").isEmpty():
            return held.where("block = holder").groupBy("sheet", "block").agg(F.min(F.struct("gap", "curve")).alias("best")).select("sheet", "block", F.col("best.curve").alias("curve"))
        left = held.where("not goes").select("sheet", "block", "curve", "gap")


def ranked_assignment(blocks: DataFrame, curves: DataFrame, tolerance: float = 0.02) -> DataFrame:
    """(sheet, block, curve, rule): to which curves of its sheet each block belongs; one that fits none has no row.

    ``blocks`` and ``curves``: sheet, block or curve (numbers, in the order of the sheet), num, length, x. Each rule sees what
    the ones before left over:

    number: all curves with the block's number. length: the only curve whose length differs by less than ``tolerance``, also
    if others have it. nearest: of several such curves the one nearest in x that no earlier block has; ties go to the smaller
    curve. taken: the nearest of them, where earlier blocks have all. again: a block with number and length of an earlier one
    of its sheet goes where that went. Null numbers and lengths equal nothing.
    """
    with scratch(blocks.sparkSession):
        return written(_ranked(blocks, curves, tolerance), "assignment", keep=True)


def _ranked(blocks: DataFrame, curves: DataFrame, tolerance: float) -> DataFrame:
    c = curves.select("sheet", "curve", "num", "length", F.col("x").alias("cx"))
    named = blocks.where("num is not null").join(c.select("sheet", "curve", "num"), ["sheet", "num"]).select("sheet", "block", "curve", F.lit("number").alias("rule"))
    rest = blocks.join(named.select("sheet", "block").distinct(), ["sheet", "block"], "left_anti").where("length is not null")
    head = F.when(F.col("num").isNull(), F.struct(F.col("block").alias("b"), F.lit(None).cast("string").alias("n"))).otherwise(F.struct(F.lit(None).cast("long").alias("b"), F.col("num").cast("string").alias("n")))
    rest = rest.withColumn("head", head)
    first = rest.groupBy("sheet", "head", "length").agg(F.min("block").alias("first"), F.min_by("x", "block").alias("x"))
    cell = lambda x: F.floor(x / tolerance).cast("long")
    asks = first.select("sheet", F.col("first").alias("block"), "length", "x", F.explode(F.array(*[cell(F.col("length")) + d for d in (-1, 0, 1)])).alias("cell"))
    have = c.where("length is not null").select("sheet", "curve", F.col("length").alias("clength"), "cx", cell(F.col("length")).alias("cell"))
    fits = asks.join(have, ["sheet", "cell"]).where(F.abs(F.col("length") - F.col("clength")) < tolerance)
    fits = written(fits.select("sheet", "block", "curve", F.abs(F.col("x") - F.col("cx")).alias("gap")), "fits")
    counts = fits.groupBy("sheet", "block").agg(F.count("*").alias("n"), F.min(F.struct("gap", "curve")).alias("near"))
    single = counts.where("n = 1").select("sheet", "block", F.col("near.curve").alias("curve"))
    several = counts.where("n > 1")
    # a block with one curve takes it whoever has it; later blocks with a choice find it taken
    gone = single.groupBy("sheet", "curve").agg(F.min("block").alias("gone"))
    open_ = fits.join(several.select("sheet", "block"), ["sheet", "block"], "left_semi").join(gone, ["sheet", "curve"], "left").where("gone is null or block < gone")
    free = written(settle(open_), "assigned")
    none = several.join(free, ["sheet", "block"], "left_anti").select("sheet", "block", F.col("near.curve").alias("curve"), F.lit("taken").alias("rule"))
    heads = single.withColumn("rule", F.lit("length")).unionByName(free.withColumn("rule", F.lit("nearest"))).unionByName(none)
    back = rest.select("sheet", "head", "length", "block").join(first.select("sheet", "head", "length", "first"), ["sheet", "head", "length"])
    placed = back.join(heads.withColumnRenamed("block", "first"), ["sheet", "first"])
    return named.unionByName(placed.select("sheet", "block", "curve", F.when(F.col("block") > F.col("first"), "again").otherwise(F.col("rule")).alias("rule")))
