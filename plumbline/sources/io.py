"""Sources and sinks: document folders, JSON lines in parts, fixed-order sinks, file hashes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_json_documents(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A document a file, in order of name, with the file's name."""
    return spark.read.schema(schema).json(path, multiLine=True).withColumn("_file", F.input_file_name())


def read_json_lines(spark: SparkSession, paths: list[str], schema: T.StructType | str) -> DataFrame:
    """JSON lines in several parts with the part each row is from; parts that do not exist are skipped."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    there = [p for p in paths if (q := jvm.org.apache.hadoop.fs.Path(p)).getFileSystem(conf).exists(q)]
    if not there:
        return spark.createDataFrame([], schema).withColumn("_file", F.lit(None).cast("string"))
    return spark.read.schema(schema).json(there).withColumn("_file", F.input_file_name())


def write_json_lines(rows: DataFrame, path: str, columns: list[str]) -> None:
    """JSON lines with the given keys in the given order."""
    rows.select(*columns).write.mode("overwrite").json(path)


def write_csv(rows: DataFrame, path: str, columns: list[str]) -> None:
    """CSV with a header and a byte order mark, for spreadsheets: the mark is part of the first column's name."""
    first, *rest = columns
    rows.select(F.col(first).alias("﻿" + first), *rest).write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """(path, sha, md5, length) of every file."""
    return spark.read.format("binaryFile").load(path).select("path", F.sha2("content", 256).alias("sha"), F.md5("content").alias("md5"), "length")


def unseen(files: DataFrame, known: DataFrame) -> DataFrame:
    """Files whose content is not in the store, one of each content by name."""
    new = files.join(known.select("sha"), "sha", "left_anti")
    return new.groupBy("sha").agg(F.min("path").alias("path"))
