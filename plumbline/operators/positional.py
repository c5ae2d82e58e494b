"""Joins along a one-dimensional position: as-of, bracketing interpolation, intervals, nearest, bands.

Every function is a composition of equi-joins and windows over stretches of a line. As-of sides come from one union and
sorted stretches, not from a join on an inequality; interval, band and box joins have an equality on cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.scratch import written


def round3(x: Column) -> Column:
    """Half-up on the third decimal, the same in every engine."""
    return F.floor(x * 1000 + 0.5) / 1000


#: Positions that a task sorts together: a line is cut at their multiples, so a hot line is dealt to many tasks.
STRETCH = 10_000.0


def neighbours(rows: DataFrame, line: str, pos: str, order: list[str], value: Column, stretch: float = STRETCH) -> DataFrame:
    """Adds _prev, the last non-null ``value`` up to each row in ``order`` along its line, and _next, the first one behind it.

    ``order`` begins with ``pos``. Each stretch of a line is sorted on its own, once either way; the last and first values
    of the stretches, one row each, are carried along the line and fill what a stretch does not hold itself.
    """
    cut = rows.withColumn("_stretch", F.coalesce(F.floor(F.col(pos) / stretch).cast("long"), F.lit(-(1 << 63)))).withColumn("_value", value)
    up = Window.partitionBy(line, "_stretch").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy(line, "_stretch").orderBy(*[F.desc(c) for c in order]).rowsBetween(Window.unboundedPreceding, -1)
    own = cut.withColumn("_in_prev", F.last("_value", ignorenulls=True).over(up)).withColumn("_in_next", F.last("_value", ignorenulls=True).over(down))
    at = F.when(F.col("_value").isNotNull(), F.struct(*order))
    edges = cut.groupBy(line, "_stretch").agg(F.max_by("_value", at).alias("_last"), F.min_by("_value", at).alias("_first"))
    along = lambda way: Window.partitionBy(line).orderBy(way("_stretch")).rowsBetween(Window.unboundedPreceding, -1)
    edges = edges.withColumn("_before", F.last("_last", ignorenulls=True).over(along(F.asc))).withColumn("_behind", F.last("_first", ignorenulls=True).over(along(F.desc)))
    joined = own.join(edges.select(line, "_stretch", "_before", "_behind"), [line, "_stretch"])
    return joined.select(*rows.columns, F.coalesce("_in_prev", "_before").alias("_prev"), F.coalesce("_in_next", "_behind").alias("_next"))


def asof_pair(probes: DataFrame, points: DataFrame, line: str, pos: str, payload: str, seq: str, stretch: float = STRETCH) -> DataFrame:
    """``probes`` with the last point at or before (prev_pos, prev) and the first one after (next_pos, next).

    Both have ``line``, ``pos`` and ``seq``; points have ``payload``. Points at one position: the highest seq is before,
    the lowest is after. Lines without points give nulls; points without a position take no part.
    """
    carried = [c for c in probes.columns if c not in (line, pos, seq)]
    a = probes.select(line, pos, seq, F.lit(1).alias("_probe"), F.struct(*carried).alias("_row") if carried else F.lit(None).alias("_row"), F.lit(None).cast(points.schema[payload].dataType).alias("_v"))
    b = points.where(F.col(pos).isNotNull()).select(line, pos, seq, F.lit(0).alias("_probe"), F.lit(None).cast(a.schema["_row"].dataType).alias("_row"), F.col(payload).alias("_v"))
    point = F.when(F.col("_probe") == 0, F.struct(F.col(pos).alias("p"), F.col("_v").alias("v")))
    # points at the probe's own position sort before it, so what follows is strictly after
    out = neighbours(a.unionByName(b), line, pos, [pos, "_probe", seq], point, stretch).where("_probe = 1")
    return out.select(line, pos, seq, *([F.col("_row")[c].alias(c) for c in carried]), F.col("_prev.p").alias("prev_pos"), F.col("_prev.v").alias("prev"), F.col("_next.p").alias("next_pos"), F.col("_next.v").alias("next"))


def interpolate(pairs: DataFrame, pos: str, gap: float | None = None, tolerance: float = 0.0) -> DataFrame:
    """Adds status and value to the result of ``asof_pair``.

    exact: a point lies at the probe. interpolated: both neighbours exist and, with ``gap``, lie that far apart within
    ``tolerance``. gap: they are not. outside: one is missing; errors are values, not exceptions.
    """
    width = F.col("next_pos") - F.col("prev_pos")
    exact = F.col("prev_pos") == F.col(pos)
    outside = F.col("prev_pos").isNull() | F.col("next_pos").isNull()
    wrong = F.lit(False) if gap is None else F.abs(width - gap) > tolerance
    status = F.when(exact, "exact").when(outside, "outside").when(wrong, "gap").otherwise("interpolated")
    between = F.col("prev") + (F.col("next") - F.col("prev")) * ((F.col(pos) - F.col("prev_pos")) / width)
    return pairs.withColumn("status", status).withColumn("value", F.when(status == "exact", F.col("prev")).when(status == "interpolated", round3(between)))


def segments(points: DataFrame, line: str, pos: str, seq: str) -> DataFrame:
    """Points as half-open segments [pos, end) of their line; the last one is open (null end)."""
    return points.withColumn("end", F.lead(pos).over(Window.partitionBy(line).orderBy(pos, seq)))


def containing(probes: DataFrame, intervals: DataFrame, line: str, pos: str, low: str, high: str, closed: bool = True, bin_width: float = 64.0) -> DataFrame:
    """Inner join of probes with the intervals of their line that hold them.

    Intervals are cut at multiples of ``bin_width``, so the join has an equality on (line, bin) and a hot line spreads.
    """
    left = probes.withColumn("_bin", F.floor(F.col(pos) / bin_width))
    right = intervals.where(F.col(low).isNotNull() & F.col(high).isNotNull() & (F.col(low) <= F.col(high)))
    right = right.withColumn("_bin", F.explode(F.sequence(F.floor(F.col(low) / bin_width), F.floor(F.col(high) / bin_width))))
    inside = (F.col(pos) >= F.col(low)) & ((F.col(pos) <= F.col(high)) if closed else (F.col(pos) < F.col(high)))
    return left.join(right, [line, "_bin"]).where(inside).drop("_bin")


def containing_many(probes: DataFrame, intervals: DataFrame, line: str, pos: str, low: str, high: str, bin_width: float, tasks: int) -> DataFrame:
    """The pairs of ``containing``, ends included, without ``pos``, ``low`` and ``high``, where far more come out than rows go in.

    An interval has a copy in each bin it reaches. Copies go only to bins between the first and the last position, and those in
    bins that an interval fills carry no ends, so that many narrow bins cost little. The bins are dealt to ``tasks``, as Spark would
    go by the rows. Pairs come out interval by interval, with the positions of a bin in the same order each time: such rows take
    little room in a file. A position that is no number is in no interval.
    """
    at = probes.where(F.col(pos).isNotNull() & ~F.isnan(pos)).withColumn("_bin", F.floor(F.col(pos) / bin_width))
    held = intervals.where(F.col(low).isNotNull() & ~F.isnan(low) & F.col(high).isNotNull() & (F.col(low) <= F.col(high)))
    # a high that is no number is above all numbers
    held = held.withColumn("_first", F.floor(F.col(low) / bin_width)).withColumn("_last", F.floor(F.nanvl(high, F.lit(float("inf"))) / bin_width))
    ends, reach = at.agg(F.min("_bin").alias("a"), F.max("_bin").alias("b")).first(), held.agg(F.min("_first").alias("a"), F.max("_last").alias("b")).first()
    at = at.where(F.col("_bin").between(F.lit(reach.a).cast("long"), F.lit(reach.b).cast("long")))
    first, last = F.greatest("_first", F.lit(ends.a).cast("long")), F.least("_last", F.lit(ends.b).cast("long"))
    cut = held.where(first <= last).withColumn("_bin", F.explode(F.sequence(first, last)))
    full = (F.col("_bin") > F.col("_first")) & (F.col("_bin") < F.col("_last"))
    cut = cut.withColumns({c: F.when(~full, F.col(c)) for c in (low, high)}).drop("_first", "_last")
    cut, at = cut.repartition(tasks, line, "_bin"), at.repartition(tasks, line, "_bin")
    # a merge goes along its left side
    return cut.join(at.hint("merge"), [line, "_bin"]).where(F.col(low).isNull() | F.col(pos).between(F.col(low), F.col(high))).drop("_bin", pos, low, high)


def within(left: DataFrame, right: DataFrame, line: str, pos: str, other: str, radius: float) -> DataFrame:
    """Band join: pairs of a line at most ``radius`` apart, with their distance. Bins of the radius, three for each row."""
    a = left.withColumn("_bin", F.floor(F.col(pos) / radius))
    b = right.withColumn("_bin", F.explode(F.array(*[F.floor(F.col(other) / radius) + k for k in (-1, 0, 1)])))
    return a.join(b, [line, "_bin"]).withColumn("distance", F.abs(F.col(pos) - F.col(other))).where(F.col("distance") <= radius).drop("_bin")


def parted(rows: DataFrame, keys: list[str], most: int) -> tuple[DataFrame, DataFrame | None]:
    """``rows`` of keys that at most ``most`` rows have, and those of the others, None where there are none.

    What is small can be met by its keys alone; only what is not needs cells and stretches, which cost a row several copies.
    ``rows`` are read once more to count them."""
    large = written(rows.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > most).select(*keys), "large")
    if large.isEmpty():
        return rows, None
    return rows.join(large, keys, "left_anti"), rows.join(large, keys, "left_semi")


def close_by(left: DataFrame, right: DataFrame, keys: list[str], axes: list[tuple[str, str, float]]) -> DataFrame:
    """Pairs with equal ``keys`` whose positions differ by less than the reach on every axis (column, other, reach).

    The plane is cut into cells as wide as the reach; a row meets those of its own cell and the ones around it, so a
    crowded page spreads over its cells.
    """
    a, b, inside = left, right, F.lit(True)
    for k, (column, other, reach) in enumerate(axes):
        cell = lambda c, r=reach: F.floor(F.col(c) / r).cast("long")
        a = a.withColumn(f"_cell{k}", cell(column))
        b = b.withColumn(f"_cell{k}", F.explode(F.array(*[cell(other) + d for d in (-1, 0, 1)])))
        inside = inside & (F.abs(F.col(column) - F.col(other)) < reach)
    cells = [f"_cell{k}" for k in range(len(axes))]
    return a.join(b, [*keys, *cells]).where(inside).drop(*cells)


def nearest_intervals(probes: DataFrame, intervals: DataFrame, line: str, pos: str, low: str, high: str, probe: str, bin_width: float, stretch: float = STRETCH) -> DataFrame:
    """``probe`` and the columns of ``intervals``: those that hold a position, or else the nearest of its line, all ties.

    The distance comes from the next start and the last end along the line; the intervals that have it are met by equality.
    """
    held = containing(probes, intervals, line, pos, low, high, True, bin_width)
    columns = [c for c in intervals.columns if c != line]
    rest = probes.join(held.select(probe), probe, "left_anti").select(line, F.col(pos).alias("_at"), F.col(probe).alias("_seq"))
    ends = intervals.withColumn("_n", F.monotonically_increasing_id())
    side = lambda edge: asof_pair(rest, ends.select(line, F.col(edge).alias("_at"), F.col("_n").alias("_seq"), F.lit(1).alias("_one")), line, "_at", "_one", "_seq", stretch)
    ahead = side(low).select("_seq", line, "_at", F.col("next_pos").alias("_next"))
    back = side(high).select("_seq", F.col("prev_pos").alias("_last"))
    both = ahead.join(back, "_seq").withColumn("_least", F.least(F.col("_next") - F.col("_at"), F.col("_at") - F.col("_last")))
    meet = lambda edge, have, gap: both.where(gap == F.col("_least")).select(line, F.col("_seq").alias(probe), F.col(have).alias(edge)).join(intervals, [line, edge]).select(probe, *columns)
    return held.select(probe, *columns).unionByName(meet(low, "_next", F.col("_next") - F.col("_at"))).unionByName(meet(high, "_last", F.col("_at") - F.col("_last")))


def nearest(pairs: DataFrame, pos: str) -> DataFrame:
    """Of ``asof_pair``'s neighbours the nearer one; the earlier on a tie."""
    back, ahead = F.col(pos) - F.col("prev_pos"), F.col("next_pos") - F.col(pos)
    use_next = F.col("prev_pos").isNull() | (ahead < back)
    return pairs.withColumn("near_pos", F.when(use_next, F.col("next_pos")).otherwise(F.col("prev_pos"))).withColumn("near", F.when(use_next, F.col("next")).otherwise(F.col("prev")))


def beside(points: DataFrame, line: str, pos: str, seq: str, payload: Column) -> DataFrame:
    """``points`` with _earlier and _later: the payload of the point before and of the one behind each on its line, itself left out.

    What ``neighbours`` finds behind a row, seen from the other end of the line, lies before it."""
    ahead = neighbours(points, line, pos, [pos, seq], payload).drop("_prev").withColumnRenamed("_next", "_later")
    turned = ahead.withColumns({"_pos": -F.col(pos), "_seq": -F.col(seq)})
    back = neighbours(turned, line, "_pos", ["_pos", "_seq"], payload).drop("_prev").withColumnRenamed("_next", "_earlier")
    return back.drop("_pos", "_seq")


def interpolate_at_breaks(probes: DataFrame, columns: DataFrame, breaks: DataFrame, line: str, pos: str, value: str, seq: str, reach: float = 0.0015) -> DataFrame:
    """``probes`` (line, pos, seq) with value and how: between the two columns around a probe, but on the stretch that holds it
    where the grade breaks between them.

    A break counts if it lies strictly between the columns and the lines through the two columns before it and the two behind
    it meet there (within ``reach``) off the straight line between the columns (by more than that); of several breaks between
    two columns the last at or before the probe is looked at, else the next. how: straight, left or right of the break; exact on
    a column; outside where a column is missing (null value). ``columns``: line, pos, seq, ``value``; ``breaks``: line, pos, seq."""
    own = F.struct(F.col(pos).alias("p"), F.col(value).alias("v"))
    c = beside(columns.where(F.col(pos).isNotNull()), line, pos, seq, own).select(line, pos, seq, F.struct(F.col(pos).alias("p"), F.col(value).alias("v"), F.col("_earlier").alias("before"), F.col("_later").alias("behind")).alias("_column"))
    held = asof_pair(probes, c, line, pos, "_column", seq).withColumnsRenamed({"prev": "_l", "next": "_r"}).drop("prev_pos", "next_pos")
    g = asof_pair(held, breaks.select(line, pos, seq, F.lit(1).alias("_one")), line, pos, "_one", seq)
    x, a, b = F.col(pos), F.col("_l"), F.col("_r")
    inside = lambda p: (p > a["p"]) & (p < b["p"])
    at = F.when(inside(F.col("prev_pos")), F.col("prev_pos")).when(inside(F.col("next_pos")), F.col("next_pos"))
    through = lambda s, t, p: s["v"] + (t["v"] - s["v"]) * (p - s["p"]) / F.nullif(t["p"] - s["p"], F.lit(0.0))
    before, behind = lambda p: through(a["before"], a, p), lambda p: through(b, b["behind"], p)
    meets = (F.abs(before(at) - behind(at)) <= reach) & (F.abs(before(at) - through(a, b, at)) > reach)
    how = F.when(a["p"] == x, "exact").when(a.isNull() | b.isNull(), "outside").when(F.coalesce(meets, F.lit(False)), F.when(x <= at, "left").otherwise("right")).otherwise("straight")
    found = F.when(how == "exact", a["v"]).when(how == "left", before(x)).when(how == "right", behind(x)).when(how == "straight", through(a, b, x))
    return g.select(*probes.columns, how.alias("how"), found.alias("value"))
