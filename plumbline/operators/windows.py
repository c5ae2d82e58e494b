"""Sequence operators: latest versions, islands, tiles, clusters, stacks."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def latest(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row for each key, the first by ``order``."""
    return rows.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rn = 1").drop("_rn")


def islands(rows: DataFrame, keys: list[str], order: list[str], flag: Column) -> DataFrame:
    """Runs of consecutive rows with ``flag``: keys, first and last of the first order column, and their number."""
    w, f = Window.partitionBy(*keys).orderBy(*order), Window.partitionBy(*keys, "_flag").orderBy(*order)
    marked = rows.withColumn("_flag", F.coalesce(flag, F.lit(False))).withColumn("_island", F.row_number().over(w) - F.row_number().over(f))
    return marked.where("_flag").groupBy(*keys, "_island").agg(F.min(order[0]).alias("run_from"), F.max(order[0]).alias("run_to"), F.count("*").alias("run_length")).drop("_island")


def tiles(rows: DataFrame, keys: list[str], order: list[str], size: int, least: int) -> DataFrame:
    """Adds ``tile``: fixed windows of ``size`` rows; a tail of fewer than ``least`` goes."""
    w = Window.partitionBy(*keys).orderBy(*order)
    out = rows.withColumn("tile", F.floor((F.row_number().over(w) - 1) / size).cast("long"))
    return out.withColumn("_n", F.count("*").over(Window.partitionBy(*keys, "tile"))).where(F.col("_n") >= least).drop("_n")


def gap_clusters(rows: DataFrame, keys: list[str], value: str, seq: str, tolerance: float) -> DataFrame:
    """Adds ``cluster`` (from 0): a new one where the step from the last member exceeds ``tolerance``."""
    w = Window.partitionBy(*keys).orderBy(value, seq)
    new = F.when(F.col(value) - F.lag(value).over(w) > tolerance, 1).otherwise(0)
    return rows.withColumn("_new", new).withColumn("cluster", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def anchored_clusters(rows: DataFrame, keys: list[str], value: str, seq: str, tolerance: float) -> DataFrame:
    """As ``gap_clusters``, but measured from the first member: a fold along each key's sorted values.

    A key's rows are one sheet's lines, bounded by what a sheet holds.
    """
    schema = T.StructType([*rows.schema.fields, T.StructField("cluster", T.LongType())])

    def fold(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values([value, seq], kind="stable")
        out, first, n = [], None, -1
        for x in part[value]:
            if first is None or x - first > tolerance:
                first, n = x, n + 1
            out.append(n)
        return part.assign(cluster=out)

    return rows.groupBy(*keys).applyInPandas(fold, schema)


def label_stack(rows: DataFrame, keys: list[str], offset: str, text: str, max_gap: float, stop: str) -> DataFrame:
    """Joins the lines of each key in order of offset until a gap above ``max_gap`` or a line that matches ``stop``."""
    w = Window.partitionBy(*keys).orderBy(offset)
    ends = F.when((F.col(offset) - F.lag(offset).over(w) > max_gap) | F.col(text).rlike(stop), 1).otherwise(0)
    kept = rows.withColumn("_end", ends).withColumn("_ended", F.sum("_end").over(w.rowsBetween(Window.unboundedPreceding, 0))).where("_ended = 0")
    return kept.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(offset, text))), lambda s: s[text]), " ").alias("stacked"))


def budgeted(rows: DataFrame, keys: list[str], order: list[Column], size: Column, forced: Column, most: int, total: int) -> DataFrame:
    """Rows of each key in order up to the first that would be more than ``most`` rows or ``total`` in size; what comes behind
    it is left out too. Forced rows never overflow, but count."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    over = ~F.coalesce(forced, F.lit(False)) & ((F.count("*").over(w) > most) | (F.sum(size).over(w) > total))
    return rows.withColumn("_over", over).withColumn("_ended", F.max("_over").over(w)).where("not _ended").drop("_over", "_ended")
