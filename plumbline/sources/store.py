"""A versioned store of sheets: append-only Parquet, latest revision wins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.parse import revision_order
from plumbline.operators.windows import latest

SCHEMA = "id long, sheet_id string, line string, sheet_no string, revision string, file string, sha string, pos_from double, pos_to double, doc string"


class Store:
    """Versions under ``path``, partitioned by line. Nothing is updated in place; a forgotten file is left out on read."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _exists(self, name: str) -> bool:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p)

    def versions(self) -> DataFrame:
        if not self._exists("versions"):
            return self.spark.createDataFrame([], SCHEMA)
        rows = self.spark.read.schema(SCHEMA).parquet(f"{self.path}/versions")
        if self._exists("forgotten"):
            gone = self.spark.read.schema("file string, upto long").parquet(f"{self.path}/forgotten").groupBy("file").agg(F.max("upto").alias("upto"))
            rows = rows.join(gone, "file", "left").where("upto is null or id > upto").drop("upto")
        return rows.select(*[c.split(" ")[0] for c in SCHEMA.split(", ")])

    def add(self, rows: DataFrame) -> int:
        """Appends rows whose content is new, one of each content; returns how many."""
        have = self.versions()
        start = have.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
        fresh = rows.join(have.select("sha"), "sha", "left_anti")
        fresh = fresh.groupBy("sha").agg(F.min_by(F.struct(*[c for c in rows.columns if c != "sha"]), F.struct("file", "sheet_id")).alias("r")).select("sha", "r.*")
        before = fresh.count()
        if before:
            ids = F.lit(start) + 1 + F.monotonically_increasing_id()
            fresh.withColumn("id", ids).select(*[F.col(c.split(" ")[0]) for c in SCHEMA.split(", ")]).write.mode("append").partitionBy("line").parquet(f"{self.path}/versions")
        return before

    def forget(self, file: str) -> None:
        upto = self.versions().agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
        self.spark.createDataFrame([(file, upto)], "file string, upto long").write.mode("append").parquet(f"{self.path}/forgotten")

    def latest(self) -> DataFrame:
        """One row for each sheet: the highest revision number, the later of equals."""
        return latest(self.versions(), ["sheet_id"], [F.desc(revision_order(F.col("revision"))), F.desc("id")])

    def history(self, line: str, sheet_no: str) -> DataFrame:
        rows = self.versions().where((F.col("line") == F.lit(line)) & (F.col("sheet_no") == F.lit(sheet_no)))
        return rows.join(self.latest().select("id", F.lit(True).alias("is_latest")), "id", "left").withColumn("is_latest", F.coalesce("is_latest", F.lit(False)))

    def status(self) -> DataFrame:
        """(sheet_id, revision, status) of each sheet's latest version: what it is, and the earlier revisions in their order."""
        each = self.versions().groupBy("sheet_id", "revision").agg(F.min("id").alias("id"))
        listed = each.groupBy("sheet_id").agg(F.array_sort(F.collect_list(F.struct(revision_order(F.col("revision")).alias("n"), "id", "revision"))).alias("all"))
        rows = self.latest().select("sheet_id", "revision").join(listed, "sheet_id")
        earlier = F.array_join(F.filter(F.col("all.revision"), lambda r: r != F.col("revision")), ", ")
        return rows.select("sheet_id", "revision", F.when(earlier == "", F.concat("revision", F.lit(" is the first"))).otherwise(F.concat("revision", F.lit(" after "), earlier)).alias("status"))
