"""Row keys and the headings printed for them, resolved by values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators.positional import close_by, parted

#: Printed rows of a sheet up to which they meet its cells by the sheet alone.
FEW = 64


def resolved_headings(cells: DataFrame, printed: DataFrame, names: dict[str, str], place: float = 0.01, same: float = 1e-9) -> DataFrame:
    """(sheet, key, heading): for each row key of ``cells`` (sheet, key, pos, value) the heading of the printed row of its sheet
    (``printed``: sheet, row, heading, pos, value, the row's first value) that has its value at that position.

    Positions differ by less than ``place`` and values by less than ``same``. Both sides cross one shuffle, by the sheet; of sheets
    with more than ``FEW`` printed rows they meet in cells of those widths. Of several rows the last wins, of equal ones that with
    the least ``seq``, if ``printed`` has it. Without one the key's name in ``names``, else the key with spaces for underscores.
    Printed rows without a heading, a position or a value match nothing; keys without a value keep their name."""
    known = printed.where("heading <> '' and row is not null and pos is not null and value is not null").select(F.col("sheet").alias("_sheet"), "row", "heading", (F.col("seq") if "seq" in printed.columns else F.col("heading")).alias("_seq"), F.col("pos").alias("_pos"), F.col("value").alias("_value"))
    small, large = parted(known, ["_sheet"], FEW)
    near = F.col("key").isNotNull() & (F.abs(F.col("pos") - F.col("_pos")) < place) & (F.abs(F.col("value") - F.col("_value")) < same)
    kept = ["sheet", "key", "row", "heading", "_seq"]
    met = cells.join(small, (F.col("sheet") == F.col("_sheet")) & near, "left").select(*kept)
    if large is not None:
        crowded = cells.where("key is not null and pos is not null and value is not null").join(large.select(F.col("_sheet").alias("sheet")).distinct(), "sheet", "left_semi")
        met = met.unionByName(close_by(crowded, large.withColumnRenamed("_sheet", "sheet"), ["sheet"], [("pos", "_pos", place), ("value", "_value", same)]).select(*kept))
    last = F.when(F.col("row").isNotNull(), F.struct((-F.col("row")).alias("row"), "_seq"))
    listed = F.create_map(*[F.lit(x) for pair in names.items() for x in pair]) if names else F.lit(None).cast("map<string,string>")
    name = F.coalesce(F.try_element_at(listed, F.col("key")), F.replace("key", F.lit("_"), F.lit(" ")))
    return met.groupBy("sheet", "key").agg(F.min_by("heading", last).alias("heading")).select("sheet", "key", F.coalesce("heading", name).alias("heading"))
