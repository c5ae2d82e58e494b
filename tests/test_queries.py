"""Every registered query with SQL against DuckDB on the smallest tables."""

import duckdb
import pandas as pd
import pytest

from plumbline import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    c.sql("SET timezone = 'UTC'")
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


def cells(df: pd.DataFrame) -> list[tuple]:
    def one(x):
        if x is None or x is pd.NA or x is pd.NaT or (isinstance(x, float) and x != x):
            return "null"
        return f"{x:.9g}" if isinstance(x, float) else str(x)

    df = df[sorted(df.columns)].astype(object)
    floats = [any(isinstance(x, float) for x in df[c]) for c in df.columns]
    return sorted(tuple(one(float(x)) if f and isinstance(x, int) and not isinstance(x, bool) else one(x) for x, f in zip(r, floats, strict=True)) for r in df.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, duck, sf, name):
    got = registry.queries()[name](spark, sf).toPandas()
    want = duck.sql(registry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert cells(got) == cells(want)


def test_entry_has_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0


def test_entry_is_imported_without_a_session():
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; assert e.queries() and e.oracle_sql()"], cwd=root, check=True, timeout=120)
