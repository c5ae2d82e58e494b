"""Revision queries as the store answers them, with orders as versions of a customer's sheet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.parse import revision_order
from plumbline.operators.windows import latest
from plumbline.query import query, table


@query("""WITH v AS (SELECT o_custkey AS sheet, o_orderkey AS id, CASE WHEN o_orderkey % 7 = 0 THEN 'draft' ELSE 'R' || o_orderkey % 13 END AS rev FROM orders), r AS (SELECT *, CASE WHEN rev = 'draft' THEN -1 ELSE substr(rev, 2)::INTEGER END AS k FROM v)
SELECT sheet, id, rev FROM (SELECT *, row_number() OVER (PARTITION BY sheet ORDER BY k DESC, id DESC) AS rn FROM r) WHERE rn = 1""")
def latest_revision(spark: SparkSession, sf_dir: str) -> DataFrame:
    rev = F.when(F.col("o_orderkey") % 7 == 0, "draft").otherwise(F.concat(F.lit("R"), (F.col("o_orderkey") % 13).cast("string")))
    v = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("sheet"), F.col("o_orderkey").alias("id"), rev.alias("rev"))
    return latest(v, ["sheet"], [F.desc(revision_order(F.col("rev"))), F.desc("id")])


@query("SELECT min(doc_id) AS doc_id, sha256(text) AS sha FROM documents GROUP BY 2")
def content_hash_first_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy(F.sha2("text", 256).alias("sha")).agg(F.min("doc_id").alias("doc_id"))


@query("SELECT p_partkey FROM part WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_returnflag = 'R' AND l_quantity > 40)")
def insert_or_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R' and l_quantity > 40").select(F.col("l_partkey").alias("p_partkey"))
    return table(spark, sf_dir, "part").select("p_partkey").join(known, "p_partkey", "left_anti")
