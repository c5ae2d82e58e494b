"""Pitch and phase of periodic profiles: autocorrelation, then a line through the peaks that is fitted over doubling spans.

A profile is a key's values at whole positions from 0 on. No profile is gathered: lag products are summed in cells of
bounded width with a halo of what lies a lag further on, smoothing and peaks look one position to either side, peaks are
thinned along islands of close peaks, and each fit is an aggregate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.operators.positional import neighbours
from plumbline.scratch import scratch, written

CELL = 4096


def lag_products(profile: DataFrame, lags: DataFrame, cell: int = CELL) -> DataFrame:
    """(key, lag, ac): the sum of p(x) * p(x + lag) over each profile (key, x, p) for the lags of ``lags`` (key, low, high),
    both ends included; at most ``cell`` lags a key.

    A position is the left factor in its own cell and the right factor in the cells that lie a lag before it, two at most.
    """
    rows = profile.join(lags, "key")
    at = lambda x: F.floor(x / cell).cast("long")
    x = F.col("x")
    left = rows.select("key", "low", "high", at(x).alias("cell"), F.lit(0).alias("side"), "x", "p")
    first = F.greatest(at(x - F.col("high")), F.lit(0).cast("long"))
    right = rows.where(x >= F.col("low")).select("key", "low", "high", F.explode(F.sequence(first, at(x - F.col("low")))).alias("cell"), F.lit(1).alias("side"), "x", "p")

    def run(part: pd.DataFrame) -> pd.DataFrame:
        key, low, high, k = (part[c].iloc[0] for c in ("key", "low", "high", "cell"))
        start, count = k * cell, high - low + 1
        a, b = np.zeros(cell), np.zeros(cell + count)
        own, far = part[part["side"] == 0], part[part["side"] == 1]
        a[own["x"] - start] = own["p"]
        b[far["x"] - start - low] = far["p"]
        return pd.DataFrame({"key": key, "lag": np.arange(low, high + 1), "ac": [float(a @ b[d : d + cell]) for d in range(count)]})

    schema = T.StructType([profile.schema["key"], T.StructField("lag", T.LongType()), T.StructField("ac", T.DoubleType())])
    return left.unionByName(right).groupBy("key", "cell").applyInPandas(run, schema).groupBy("key", "lag").agg(F.sum("ac").alias("ac"))


def rough_pitch(profile: DataFrame, low: int, high: int, cell: int = CELL) -> DataFrame:
    """(key, n, pitch): the first lag in [low, high) whose autocorrelation is a positive peak of 0.6 of the highest, measured
    again over as many periods as half the profile holds. Keys without a peak have no row."""
    sums = profile.groupBy("key").agg(F.avg("value").alias("mean"), (F.max("x") + 1).alias("n"))
    level = written(profile.join(sums, "key").select("key", "x", (F.col("value") - F.col("mean")).alias("p")), "profile")
    bounds = sums.select("key", "n", F.lit(low).cast("long").alias("low"), (F.least(F.lit(high).cast("long"), F.col("n") - 2) - 1).alias("high")).where("high - low >= 2")
    near = lag_products(level, bounds.select("key", "low", "high"), cell)
    w = Window.partitionBy("key").orderBy("lag")
    peaks = near.withColumns({"before": F.lag("ac").over(w), "behind": F.lead("ac").over(w)}).where("ac >= before and ac >= behind and ac > 0")
    top = peaks.withColumn("top", F.max("ac").over(Window.partitionBy("key"))).where("ac >= 0.6 * top").groupBy("key").agg(F.min("lag").alias("lag"))
    found = top.join(sums.select("key", "n"), "key")
    found = found.withColumn("k", F.greatest(F.lit(1), F.floor(F.col("n") / (2 * F.col("lag"))))).withColumn("w", F.greatest(F.lit(2), F.floor(F.col("lag") / 4)))
    found = written(found.select("key", "n", "k", F.greatest(F.lit(0), F.col("k") * F.col("lag") - F.col("w")).alias("low"), F.least(F.col("n") - 1, F.col("k") * F.col("lag") + F.col("w")).alias("high")), "pitch-lags")
    far = lag_products(level, found.select("key", "low", "high"), cell).groupBy("key").agg(F.max_by("lag", F.struct("ac", -F.col("lag"))).alias("lag"))
    return far.join(found.select("key", "n", "k"), "key").select("key", "n", (F.col("lag") / F.col("k")).alias("pitch"))


def smooth_peaks(profile: DataFrame, pitches: DataFrame) -> DataFrame:
    """(key, x, height, pitch) of the local peaks of the mean of three neighbours that stand 0.3 deviations above the mean."""
    around = lambda rows, value: rows.select("key", F.explode(F.array(*[F.struct((F.col("x") - d).alias("x"), F.lit(d).alias("d"), F.col(value).alias("v")) for d in (-1, 0, 1)])).alias("s")).select("key", "s.*")
    at = lambda d: F.coalesce(F.max(F.when(F.col("d") == d, F.col("v"))), F.lit(0.0))
    real = profile.select("key", "x", F.col("value").cast("double").alias("value"))
    smooth = around(real, "value").groupBy("key", "x").agg(((at(-1) + at(0) + at(1)) / 3).alias("height"))
    smooth = written(smooth.join(pitches, "key").where("x between 0 and n - 1"), "smooth")
    level = smooth.groupBy("key").agg((F.avg("height") + 0.3 * F.stddev_pop("height")).alias("least"), F.max("n").alias("n"), F.max("pitch").alias("pitch"))
    beside = around(smooth, "height").groupBy("key", "x").agg(at(-1).alias("before"), at(0).alias("height"), at(1).alias("behind"))
    peaks = beside.join(level, "key").where("x between 1 and n - 2 and height >= before and height > behind and height > least")
    return peaks.select("key", "x", "height", "pitch")


def thinned(peaks: DataFrame, share: float = 0.6) -> DataFrame:
    """One peak of those closer than ``share`` of the pitch to the last one kept, the strongest, the first of equals.

    Where the next peak is farther away nothing is carried over, so a profile falls into islands; an island is read in order
    with the last kept peak in mind."""
    # neighbours' next row, seen from behind, is the one before
    back = neighbours(peaks.withColumn("_back", -F.col("x")), "key", "_back", ["_back"], F.col("x")).withColumn("_new", F.col("_next").isNull() | (F.col("x") - F.col("_next") >= share * F.col("pitch")))
    marked = neighbours(back.select("key", "x", "height", "pitch", "_new"), "key", "x", ["x"], F.when(F.col("_new"), F.col("x"))).withColumnRenamed("_prev", "island")
    rows = marked.select("key", "island", "x", "height", (share * F.col("pitch")).alias("reach"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = None
        for part in batches:
            out = []
            for row in part.itertuples(index=False):
                if kept is not None and kept[:2] == row[:2] and row.x - kept.x < row.reach:
                    kept = row if row.height > kept.height else kept
                else:
                    out += [] if kept is None else [kept]
                    kept = row
            yield pd.DataFrame([(r.key, r.x) for r in out], columns=["key", "x"])
        if kept is not None:
            yield pd.DataFrame([(kept.key, kept.x)], columns=["key", "x"])

    schema = T.StructType([peaks.schema["key"], T.StructField("x", T.LongType())])
    return rows.repartition("key", "island").sortWithinPartitions("key", "island", "x").mapInPandas(run, schema)


def pitch_and_phase(profile: DataFrame, low: int, high: int, cell: int = CELL) -> DataFrame:
    """(key, pitch, phase, columns): the pitch and the first column of each profile (key, x, value), and how many columns were
    found. ``x``: whole, 0 or more, once a key; a position without a value counts as the mean, in smoothing as 0. Keys without
    a period, or with fewer than four columns, have no row.

    Columns are numbered from the first with the pitch so far, and a line is fitted through those within 0.3 of a pitch of
    their place; the span doubles from 15 columns on, as an error of the pitch adds up along a profile."""
    with scratch(profile.sparkSession):
        rows = profile.where("x >= 0 and value is not null").select("key", F.col("x").cast("long").alias("x"), "value")
        pitches = written(rough_pitch(rows, low, high, cell), "pitch")
        x = written(thinned(smooth_peaks(rows, pitches)), "peaks")
        state = x.groupBy("key").agg(F.count("*").alias("columns"), F.min("x").cast("double").alias("p0")).where("columns >= 4").join(pitches.select("key", F.col("pitch").alias("pp")), "key")
        state = written(state.withColumn("done", F.lit(False)), "fit")
        span = 15
        while not state.where("not done").isEmpty():
            near = x.join(state.where("not done"), "key").where(F.col("x") <= F.col("p0") + span * F.col("pp")).withColumn("k", F.rint((F.col("x") - F.col("p0")) / F.col("pp")))
            good = F.abs(F.col("x") - (F.col("p0") + F.col("k") * F.col("pp"))) < 0.3 * F.col("pp")
            y, k = F.when(good, F.col("x").cast("double")), F.when(good, F.col("k"))
            fit = near.groupBy("key", "columns").agg(F.count_if(good).alias("fits"), F.count("*").alias("near"), F.regr_intercept(y, k).alias("p0"), F.regr_slope(y, k).alias("pp")).where("fits >= 4")
            fit = fit.select("key", "columns", "p0", "pp", (F.col("near") == F.col("columns")).alias("done"))
            state = written(state.where("done").select("key", "columns", "p0", "pp", "done").unionByName(fit), "fit")
            span *= 2
        phase = F.when(F.col("p0") >= F.col("pp"), F.pmod("p0", "pp")).otherwise(F.col("p0"))
        return written(state.select("key", F.col("pp").alias("pitch"), phase.alias("phase"), "columns"), "pitch-and-phase", keep=True)
