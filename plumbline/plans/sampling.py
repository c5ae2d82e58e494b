"""Order, limits and samples. Seeded choices rank by md5(seed, id), the same on every engine and partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.query import query, table

_H = "md5(concat_ws(',', '7', {}::VARCHAR))"


def draw(seed: int, *ids: str) -> Column:
    return F.md5(F.concat_ws(",", F.lit(str(seed)), *[F.col(i).cast("string") for i in ids]))


def cap(rows: DataFrame, keys: list[str], seed: int, ident: str, n: int) -> DataFrame:
    """At most ``n`` rows of each key, by the seeded order."""
    return rows.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(draw(seed, ident), ident))).where(F.col("_rn") <= n).drop("_rn")


@query(f"SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY source, lang ORDER BY {_H.format('doc_id')}, doc_id) AS rn FROM documents) WHERE rn <= 5")
def cap_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cap(table(spark, sf_dir, "documents").select("doc_id", "source", "lang"), ["source", "lang"], 7, "doc_id", 5).select("doc_id")


@query(f"SELECT doc_id, CASE WHEN ('0x' || substr({_H.format('doc_id')}, 1, 8))::BIGINT % 100 < 5 THEN 'val' ELSE 'train' END AS split FROM documents")
def bernoulli_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    share = F.conv(F.substring(draw(7, "doc_id"), 1, 8), 16, 10).cast("long") % 100
    return table(spark, sf_dir, "documents").select("doc_id", F.when(share < 5, "val").otherwise("train").alias("split"))


@query(f"SELECT item_id, row_number() OVER (ORDER BY {_H.format('item_id')}, item_id) AS place FROM benchmark")
def seeded_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of a seeded order, ranked by slices of the hash: no single task sorts all rows."""
    rows = table(spark, sf_dir, "benchmark").select("item_id", draw(7, "item_id").alias("h")).withColumn("slice", F.substring("h", 1, 2))
    sizes = rows.groupBy("slice").count()
    before = sizes.withColumn("before", F.sum("count").over(Window.orderBy("slice")) - F.col("count")).select("slice", "before")
    w = Window.partitionBy("slice").orderBy("h", "item_id")
    return rows.withColumn("rn", F.row_number().over(w)).join(before, "slice").select("item_id", (F.col("before") + F.col("rn")).alias("place"))


@query("""WITH s AS (SELECT item_id, length(text) AS n, sum(length(text)) OVER (ORDER BY item_id) AS upto, row_number() OVER (ORDER BY item_id) AS rn FROM benchmark),
b AS (SELECT min(rn) AS stop FROM s WHERE upto > 3600 OR rn > 30) SELECT item_id, upto::BIGINT AS upto FROM s, b WHERE stop IS NULL OR rn < stop""")
def budgeted_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items in order up to the first that passes 30 rows or 3600 characters. One question's list is ordered at a time."""
    w = Window.partitionBy(F.lit(0)).orderBy("item_id")
    s = table(spark, sf_dir, "benchmark").select("item_id", F.length("text").alias("n")).orderBy("item_id").limit(31)
    s = s.withColumn("upto", F.sum("n").over(w)).withColumn("rn", F.row_number().over(w))
    over = F.max(((F.col("upto") > 3600) | (F.col("rn") > 30)).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return s.withColumn("over", over).where("over = 0").select("item_id", "upto")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 8")
def top_eight(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(8)


@query("SELECT doc_id, k::INTEGER AS repeat_no FROM documents, unnest(range(1, CASE WHEN lang = 'de' THEN 4 ELSE 2 END)) AS t(k)")
def oversample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(F.sequence(F.lit(1), F.when(F.col("lang") == "de", 3).otherwise(1))).alias("repeat_no"))


@query("SELECT event_id FROM (SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS i FROM events) WHERE i % 3 = 0")
def every_third(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("event_id")
    return table(spark, sf_dir, "events").select("event_id", ((F.row_number().over(w) - 1) % 3).alias("i")).where("i = 0").select("event_id")


@query("SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END, coalesce(o_totalprice, 0), o_orderkey) AS serial FROM orders")
def serial_by_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rank = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
    w = Window.partitionBy("o_custkey").orderBy(rank, F.coalesce("o_totalprice", F.lit(0.0)), "o_orderkey")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.row_number().over(w).alias("serial"))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_totalprice BETWEEN 1000 AND 250000 AND lower(o_orderpriority) LIKE '%urgent%'")
def closed_range_and_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where(F.col("o_totalprice").between(1000, 250000) & F.lower("o_orderpriority").contains("urgent")).select("o_orderkey", "o_custkey")
