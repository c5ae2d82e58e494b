"""Set operations and deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators.windows import latest
from plumbline.query import query, table


@query("SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY rtrim(lower(text), '?') ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1")
def exact_dedup_first_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.sha2(F.regexp_replace(F.lower("text"), r"\?+$", ""), 256)
    # one id for each text is summed before texts of a kind meet
    return table(spark, sf_dir, "documents").groupBy(key.alias("k")).agg(F.min("doc_id").alias("doc_id")).select("doc_id")


@query("""WITH n AS (SELECT event_id, user_id, event_type, (CASE WHEN value > 30 THEN 1 ELSE 0 END + CASE WHEN length(props) > 9 THEN 1 ELSE 0 END) AS filled FROM events)
SELECT event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY filled DESC, event_id) AS rn FROM n) WHERE rn = 1""")
def keep_fuller_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = (F.col("value") > 30).cast("int") + (F.length("props") > 9).cast("int")
    return table(spark, sf_dir, "events").withColumn("filled", filled).groupBy("user_id", "event_type").agg(F.min_by("event_id", F.struct((-F.col("filled")).alias("f"), "event_id")).alias("event_id")).select("event_id")


@query("SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def unlabelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_anti").distinct()


@query("SELECT o_custkey AS custkey FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'O'")
def on_both_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("custkey")).intersect(o.where("o_orderstatus = 'O'").select("o_custkey"))


@query("SELECT p_name AS t FROM part UNION SELECT unnest(string_split(p_name, ' ')) FROM part")
def names_and_their_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_name").alias("t")).union(p.select(F.explode(F.split("p_name", " ")))).distinct()


@query("SELECT r.r_name AS k, 'region' AS rule FROM region r UNION ALL SELECT n_name, 'nation' FROM nation UNION ALL SELECT n_name, 'nation' FROM nation WHERE n_regionkey = 1")
def union_of_generators(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    named = n.select(F.col("n_name").alias("k"), F.lit("nation").alias("rule"), "n_regionkey")
    return r.select(F.col("r_name").alias("k"), F.lit("region").alias("rule")).unionByName(named.drop("n_regionkey")).unionByName(named.where("n_regionkey = 1").drop("n_regionkey"))


@query("SELECT h, min(doc_id) AS doc_id, count(*) AS copies FROM (SELECT doc_id, md5(text) AS h FROM documents) GROUP BY 1 HAVING count(*) > 1")
def content_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy(F.md5("text").alias("h")).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies")).where("copies > 1")


@query("SELECT c.c_custkey, count(o.o_orderkey) AS n FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey GROUP BY 1")
def left_join_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    return table(spark, sf_dir, "customer").select("c_custkey").join(o, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", F.coalesce("n", F.lit(0)).alias("n"))


@query("SELECT coalesce(a.k, b.k) AS k, a.n AS n_f, b.n AS n_o FROM (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) a FULL JOIN (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_orderstatus = 'O' GROUP BY 1) b ON a.k = b.k")
def summaries_side_by_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    side = lambda status, name: o.where(F.col("o_orderstatus") == status).groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias(name))
    return side("F", "n_f").join(side("O", "n_o"), "k", "full")


@query("SELECT o_orderkey, array_to_string(older, ',') AS older FROM (SELECT o_orderkey, list(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS older, lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS nxt FROM orders) WHERE nxt IS NULL AND older IS NOT NULL")
def older_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest row of each key with the ids of the ones it replaced."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    newest = latest(o, ["o_custkey"], [F.desc("o_orderkey")])
    rest = o.join(newest.select("o_orderkey"), "o_orderkey", "left_anti").groupBy("o_custkey").agg(F.array_join(F.array_sort(F.collect_list("o_orderkey")), ",").alias("older"))
    return newest.join(rest, "o_custkey").select("o_orderkey", "older")
