"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Folders of applications on one machine that have no ``spark.checkpoint.dir`` (tests).
_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Where it is unset, one machine (tests) gets a new local folder; a cluster,
    whose machines would not see that, gets an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        name = spark.sparkContext.applicationId
        found = _LOCAL.get(name) or _LOCAL.setdefault(name, "file://" + tempfile.mkdtemp(prefix="plumbline-"))
    return found.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/plumbline/{name}-{uuid.uuid4().hex}"


#: Spark's setting that deletes the shuffle files of an execution when it has ended.
CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Tables written inside the scratches that are open now.
_OPEN: list[list[str]] = []


def delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes the tables written inside, but for those of ``written(..., keep=True)``: a result must not be lazy on them."""
    _OPEN.append([])
    try:
        yield
    finally:
        for path in _OPEN.pop():
            delete(spark, path)


def written(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: a lost executor costs a re-read, not the lineage before it.

    Once the table is there, the shuffle files that made it are of no use and go.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    before = spark.conf.get(CLEAN, "false")
    spark.conf.set(CLEAN, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEAN, before)
    if _OPEN and not keep:
        _OPEN[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)
