"""All registered queries and their DuckDB SQL."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from plumbline import query

for _name in ("positional", "windows", "joins", "aggregates", "sampling", "sets", "rules", "retrieve", "evaluate", "curate", "layout", "parsing", "scalars", "lookup", "store", "printed", "checks", "wording", "sequence", "pages", "routing", "records", "values"):
    importlib.import_module(f"plumbline.plans.{_name}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(query.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(query.SQL)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return query.QUERIES["interpolate_bracketed"](spark, sf_dir)
