"""Occupancy of pages on a grid: cells of boxes and strokes, dilation, components, and the view that owns a point.

A page is never gathered: cells are labelled in tiles of bounded size, and only the links across tile borders, one for a pair of
pieces, take part in the rounds that join the pieces.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.operators import graph
from plumbline.scratch import scratch, written

TILE = 128


def _whole(x: Column, size: float) -> Column:
    return F.floor(x / size).cast("long")


def cells_of_boxes(boxes: DataFrame, size: float) -> DataFrame:
    """(page, y, x): the cells that boxes (page, x0, y0, x1, y1) touch. Boxes with nulls, or turned inside out, touch none."""
    span = lambda a, b: F.explode(F.sequence(_whole(F.col(a), size), _whole(F.col(b), size)))
    return boxes.where("x0 <= x1 and y0 <= y1").withColumn("y", span("y0", "y1")).withColumn("x", span("x0", "x1")).select("page", "y", "x").distinct()


def cells_of_strokes(strokes: DataFrame, size: float, longest: float) -> DataFrame:
    """(page, y, x): the cells along straight strokes (page, x0, y0, x1, y1), sampled at half a cell. Strokes of ``longest`` or
    more are frames, no content."""
    length = F.hypot(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))
    steps = F.greatest(F.lit(1).cast("long"), F.floor(length / (size / 2)).cast("long"))
    rows = strokes.withColumn("steps", F.when(length < longest, steps)).where("steps is not null").withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("steps"))))
    at = lambda a, b: _whole(F.col(a) + (F.col(b) - F.col(a)) * (F.col("k") / F.col("steps")), size)
    return rows.select("page", at("y0", "y1").alias("y"), at("x0", "x1").alias("x")).distinct()


def dilated(cells: DataFrame, reach: int) -> DataFrame:
    """Cells at most ``reach`` rows and columns from one of ``cells`` (page, y, x): first along rows, then along columns."""
    for c in ("x", "y"):
        cells = cells.withColumn(c, F.explode(F.array(*[F.col(c) + d for d in range(-reach, reach + 1)]))).distinct()
    return cells


def _label(tile: pd.DataFrame) -> pd.DataFrame:
    """Adds the least cell (py, px) of each cell's piece of the tile."""
    tile = tile.sort_values(["y", "x"], ignore_index=True)
    y, x = tile["y"].to_numpy(), tile["x"].to_numpy()
    wide = (y - y.min()) * (x.max() - x.min() + 2) + (x - x.min())
    ends = []
    for step in (1, x.max() - x.min() + 2):
        at = np.searchsorted(wide, wide + step)
        there = np.flatnonzero((at < len(wide)) & (wide[np.minimum(at, len(wide) - 1)] == wide + step))
        ends.append((there, at[there]))
    a, b = (np.concatenate(e) for e in zip(*ends, strict=True))
    least = np.arange(len(tile))
    while True:
        low = np.minimum(least[a], least[b])
        new = least.copy()
        np.minimum.at(new, least[a], low)
        np.minimum.at(new, least[b], low)
        new = new[new]
        if (new == least).all():
            return tile.assign(py=y[least], px=x[least])
        least = new


def components(cells: DataFrame, tile: int = TILE) -> DataFrame:
    """(page, y, x, comp): cells with the least cell (y, x) of their component by four neighbours. ``page`` and cells: longs."""
    with scratch(cells.sparkSession):
        placed = cells.select("page", "y", "x").distinct().withColumns({"ty": F.floor(F.col("y") / tile), "tx": F.floor(F.col("x") / tile)})
        pieces = placed.groupBy("page", "ty", "tx").applyInPandas(_label, "page long, y long, x long, ty long, tx long, py long, px long")
        pieces = written(pieces.select("page", "y", "x", F.struct("page", "py", "px").alias("piece")), "pieces")
        links = None
        for down, c in ((True, "y"), (False, "x")):
            edge = pieces.where(F.pmod(c, F.lit(tile)) == tile - 1).select("page", (F.col("y") + int(down)).alias("y"), (F.col("x") + int(not down)).alias("x"), F.col("piece").alias("a"))
            met = edge.join(pieces.where(F.pmod(c, F.lit(tile)) == 0), ["page", "y", "x"]).select("a", F.col("piece").alias("b")).distinct()
            links = met if links is None else links.unionByName(met)
        joined = graph.components(links).withColumnRenamed("node", "piece")
        found = pieces.join(joined, "piece", "left").withColumn("comp", F.coalesce("comp", "piece"))
        return written(found.select("page", "y", "x", F.struct(F.col("comp.py").alias("y"), F.col("comp.px").alias("x")).alias("comp")), "cells", keep=True)


def views_of_points(points: DataFrame, cells: DataFrame, views: DataFrame, size: float, reach: int = 2, pad: float = 2.0, coarse: float = 64.0) -> DataFrame:
    """(page, point, view): the view that most of the owned cells around a point belong to, in the smallest square around it
    that has any, up to ``reach`` cells away; without one the smallest view box that holds the point, ``pad`` included.

    ``points``: page, point, x, y; ``cells``: page, y, x, view; ``views``: page, view, x0, y0, x1, y1. Ties go to the smaller
    view; points that no view claims have no row."""
    ring = F.explode(F.array(*[F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx"), F.lit(max(abs(dy), abs(dx))).alias("ring")) for dy in range(-reach, reach + 1) for dx in range(-reach, reach + 1)]))
    around = points.select("page", "point", _whole(F.col("y"), size).alias("cy"), _whole(F.col("x"), size).alias("cx"), ring.alias("d"))
    around = around.select("page", "point", (F.col("cy") + F.col("d.dy")).alias("y"), (F.col("cx") + F.col("d.dx")).alias("x"), "d.ring")
    votes = around.join(cells.where("view is not null"), ["page", "y", "x"]).groupBy("page", "point", "ring", "view").agg(F.count("*").alias("n"))
    voted = votes.groupBy("page", "point").agg(F.min(F.struct("ring", (-F.col("n")).alias("n"), "view"))["view"].alias("view"))
    rest = points.join(voted, ["page", "point"], "left_anti")
    wide = views.where("x0 <= x1 and y0 <= y1")
    for c, a, b in (("gy", "y0", "y1"), ("gx", "x0", "x1")):
        wide = wide.withColumn(c, F.explode(F.sequence(_whole(F.col(a) - pad, coarse), _whole(F.col(b) + pad, coarse))))
    inside = F.col("x").between(F.col("x0") - pad, F.col("x1") + pad) & F.col("y").between(F.col("y0") - pad, F.col("y1") + pad)
    area = (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))
    held = rest.withColumns({"gy": _whole(F.col("y"), coarse), "gx": _whole(F.col("x"), coarse)}).join(wide, ["page", "gy", "gx"]).where(inside)
    boxed = held.groupBy("page", "point").agg(F.min(F.struct(area.alias("area"), "view"))["view"].alias("view"))
    return voted.unionByName(boxed)
