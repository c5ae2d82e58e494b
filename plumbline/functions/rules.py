"""Checks of labels, levels and curve formulas with their severities; null where a check finds nothing or lacks a value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plumbline.functions.parse import one_in

FLAT = 2000.0


def labels_disagree(after: Column, before: Column) -> Column:
    """Severity of two labels of one stretch (in words) that differ: INFO where both are level or 1 in 2000 or flatter, else CHECK."""
    flat = lambda x: F.coalesce(one_in(x), F.lit(float("inf"))) >= FLAT
    return F.when(after != before, F.when(flat(after) & flat(before), "INFO").otherwise("CHECK"))


def implied_gradient(run: Column, rise: Column) -> Column:
    """The gradient in words that two levels give over a distance; level under a millionth."""
    way = F.when(rise > 0, "rising").otherwise("falling")
    return F.when(F.abs(rise) < 1e-6, "level").otherwise(F.concat(F.lit("1 in "), F.round(run / F.abs(rise)).cast("long").cast("string"), F.lit(" "), way))


def gradient_against_levels(label: Column, run: Column, rise: Column) -> Column:
    """Why a label (in words) does not fit the levels: ``level`` is printed but they differ by over 0.005; ``flat``, a slope is
    printed but they do not differ; ``rate``, 1 in n is off by over 3 %; ``sign``, it rises where they fall."""
    n = one_in(label)
    off = F.abs(run / F.abs(rise) - n) / n > 0.03
    wrong = (rise > 0) != label.endswith("rising")
    return F.when((label == "level") & (F.abs(rise) > 0.005), "level").when(n > 0, F.when(F.abs(rise) < 1e-6, "flat").when(off, "rate").when(wrong, "sign"))


def steeper_than_ruling(label: Column, ruling: Column) -> Column:
    return F.when(one_in(label) < ruling, "FLAG")


def curve_findings(radius: Column, length: Column, angle: Column, shift: Column, degree: Column, tangent: Column) -> Column:
    """(severity, what, value): printed values of a curve that its formulas do not give. CHECK where shift (L²/24R) or degree
    (1750/R) is off by over 0.0015, INFO where the tangent length ((R + S) tan(Δ/2) + L/2) is off by over 0.02. A value that is not
    printed is not checked; without radius or angle, or with a radius of 0, none is."""
    radius = F.nullif(radius, F.lit(0.0))
    s = length * length / (24 * radius)
    t = (radius + s) * F.tan(F.radians(angle / 2)) + length / 2
    one = lambda severity, what, printed, value, reach: F.when(F.abs(value - printed) > reach, F.struct(F.lit(severity).alias("severity"), F.lit(what).alias("what"), value.alias("value")))
    found = F.array(one("CHECK", "shift", shift, s, 0.0015), one("CHECK", "degree", degree, 1750 / radius, 0.0015), one("INFO", "tangent", tangent, t, 0.02))
    known = radius.isNotNull() & length.isNotNull() & (angle != 0)
    return F.when(F.coalesce(known, F.lit(False)), F.filter(found, lambda x: x.isNotNull())).otherwise(F.filter(found, lambda x: F.lit(False)))
