"""An append-only log whose batches can be written again without adding anything."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Log:
    """JSON lines under ``path``, a folder for each batch. Writing a batch replaces its folder, so a rerun, after a lost driver or
    by ``foreachBatch``, leaves the log as it was; batches are never changed otherwise."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), T.StructType.fromDDL(schema)

    def append(self, rows: DataFrame, batch: int) -> None:
        """Adds the rows of a batch; the shape of ``foreachBatch``."""
        rows.select(*self.schema.fieldNames()).write.mode("overwrite").json(f"{self.path}/batch={batch}")

    def follow(self, stream: DataFrame, checkpoint: str):
        """Appends what a stream brings, once, however often it is restarted; the finished query."""
        query = stream.writeStream.foreachBatch(self.append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        return query

    def read(self) -> DataFrame:
        """All rows with the number of their batch; none if nothing was written."""
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        if not where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
            return self.spark.createDataFrame([], T.StructType([*self.schema.fields, T.StructField("batch", T.LongType())]))
        rows = self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField("batch", T.LongType())])).json(self.path)
        return rows.select(*self.schema.fieldNames(), F.col("batch").cast("long").alias("batch"))


def write_index(rows: DataFrame, sheet: str, kind: str, kinds: list[str], path: str) -> DataFrame:
    """Writes a CSV with a row for each sheet and the number of things of each kind on it, and reads it back."""
    counts = rows.groupBy(sheet).pivot(kind, kinds).count().na.fill(0, kinds)
    counts.write.mode("overwrite").option("header", True).csv(path)
    columns = ", ".join([f"`{sheet}` {rows.schema[sheet].dataType.simpleString()}", *[f"`{k}` long" for k in kinds]])
    return rows.sparkSession.read.schema(columns).option("header", True).csv(path)
