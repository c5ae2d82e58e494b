"""Seeded variants of tables: which columns a table has, in which order and under which names, is data, not a schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def draw(*parts: Column | str) -> Column:
    """A number of 32 bits from the parts' texts, the same on any partitioning and in any engine with SHA-256."""
    text = F.concat_ws("|", *[F.coalesce((F.lit(p) if isinstance(p, str) else p).cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")


def varied(rows: DataFrame, table: str, row: str, columns: list[str], names: dict[str, list[str]], seed: str, drop: int = 25, keep: int = 80, fixed: tuple[str, ...] = ()) -> DataFrame:
    """(table, row, cells): ``rows`` with the columns of each table dropped, shuffled and renamed, and some rows left out.

    ``cells`` is an array of (name, value): a column is left out of a table in ``drop`` of 100 draws unless it is ``fixed``, the
    rest stand in the order of their draws (ties by column), named by a draw from ``names``, where a column has any. A row stays in
    ``keep`` of 100 draws. Every draw goes by seed, table and column, or row. A value that is null stays null."""
    t = F.col(table)
    cells = []
    for c in columns:
        options = names.get(c) or [c]
        name = F.element_at(F.array(*map(F.lit, options)), (draw(seed, "name", t, c) % len(options) + 1).cast("int"))
        there = F.lit(True) if c in fixed else draw(seed, "drop", t, c) % 100 >= drop
        cells.append(F.when(there, F.struct(draw(seed, "place", t, c).alias("place"), F.lit(c).alias("column"), name.alias("name"), F.col(c).cast("string").alias("value"))))
    held = F.array_sort(F.filter(F.array(*cells), lambda x: x.isNotNull()))
    kept = rows.where(draw(seed, "row", t, F.col(row)) % 100 < keep)
    return kept.select(t.alias("table"), F.col(row).alias("row"), F.transform(held, lambda x: F.struct(x["name"].alias("name"), x["value"].alias("value"))).alias("cells"))
