"""What the corpus operators share: written intermediate tables, and row keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.scratch import delete, fresh_path, scratch, shared_dir, written

__all__ = ["content_key", "delete", "fresh_path", "scratch", "shared_dir", "table", "written"]


def content_key(text: Column) -> list[Column]:
    """128 bits that stand for a text: two longs, cheaper to shuffle than a hexadecimal digest."""
    digest = F.sha2(text, 256)
    return [F.conv(F.substring(digest, at, 15), 16, 10).cast("long").alias(name) for at, name in ((1, "key_hi"), (16, "key_lo"))]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
