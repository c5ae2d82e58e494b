"""Beyond the reference: its append-only versions as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_revisions(stream: DataFrame, key: str, order: list[str], payload: list[str]) -> DataFrame:
    """A streaming (or batch) aggregation that keeps the newest row of each key; state is one row for each key."""
    return stream.groupBy(key).agg(F.max_by(F.struct(*payload), F.struct(*order)).alias("_r")).select(key, "_r.*")


def counts_by_window(stream: DataFrame, ts: str, key: str, width: str, late: str) -> DataFrame:
    """Rows of each key in tumbling windows, late rows up to ``late``; state ends with the watermark."""
    return stream.withWatermark(ts, late).groupBy(F.window(ts, width), key).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), key, "n")
