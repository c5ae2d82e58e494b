"""Aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.query import query, table


@query("SELECT event_type, user_id % 7 AS split, count(*) AS n, count(DISTINCT user_id) AS users, count(*) FILTER (WHERE value > 50) AS high FROM events GROUP BY 1, 2")
def counts_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.groupBy("event_type", (F.col("user_id") % 7).alias("split")).agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("users"), F.count_if(F.col("value") > 50).alias("high"))


@query("SELECT coalesce(event_type, 'TOTAL') AS event_type, count(*) AS n, count(*) FILTER (WHERE value >= 50) AS passed, floor(1000.0 * count(*) FILTER (WHERE value >= 50) / count(*)) / 10 AS pct FROM events GROUP BY ROLLUP (event_type)")
def pass_rate_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    passed = F.count_if(F.col("value") >= 50)
    return table(spark, sf_dir, "events").rollup("event_type").agg(F.count("*").alias("n"), passed.alias("passed"), (F.floor(1000.0 * passed / F.count("*")) / 10).alias("pct")).withColumn("event_type", F.coalesce("event_type", F.lit("TOTAL")))


@query("""WITH m AS (SELECT l_shipdate, l_returnflag, CASE WHEN l_quantity > 40 THEN 1 ELSE 0 END AS tp, CASE WHEN l_discount > 0.08 THEN 1 ELSE 0 END AS fp, CASE WHEN l_tax > 0.07 THEN 1 ELSE 0 END AS fn FROM lineitem)
SELECT l_returnflag, floor(1000.0 * sum(tp) / nullif(sum(tp) + sum(fp), 0) + 0.5) / 1000 AS precision_, floor(1000.0 * sum(tp) / nullif(sum(tp) + sum(fn), 0) + 0.5) / 1000 AS recall_ FROM m GROUP BY 1""")
def micro_precision_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = table(spark, sf_dir, "lineitem").select("l_returnflag", (F.col("l_quantity") > 40).cast("int").alias("tp"), (F.col("l_discount") > 0.08).cast("int").alias("fp"), (F.col("l_tax") > 0.07).cast("int").alias("fn"))
    share = lambda other: F.floor(1000.0 * F.sum("tp") / F.nullif(F.sum("tp") + F.sum(other), F.lit(0)) + 0.5) / 1000
    return m.groupBy("l_returnflag").agg(share("fp").alias("precision_"), share("fn").alias("recall_"))


@query("""WITH r AS (SELECT lang, length(text) AS n, row_number() OVER (PARTITION BY lang ORDER BY length(text)) - 1 AS i, count(*) OVER (PARTITION BY lang) AS c FROM documents)
SELECT lang, max(CASE WHEN i = least(c - 1, floor(0.95 * c)) THEN n END) AS p95, max(CASE WHEN i = least(c - 1, floor(0.995 * c)) THEN n END) AS p995, max(CASE WHEN i = c // 2 THEN n END) AS median_, max(n) AS longest,
 ceil(max(CASE WHEN i = least(c - 1, floor(0.995 * c)) THEN n END) / 256.0)::BIGINT * 256 AS max_len FROM r GROUP BY 1""")
def rank_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Value at rank floor(p * n), from 0, of the sorted lengths: from counts of each length, never from a gathered group."""
    n = table(spark, sf_dir, "documents").select("lang", F.length("text").cast("long").alias("n")).groupBy("lang", "n").agg(F.count("*").alias("k"))
    upto = F.sum("k").over(Window.partitionBy("lang").orderBy("n"))
    r = n.withColumn("upto", upto).withColumn("c", F.sum("k").over(Window.partitionBy("lang")))
    at = lambda rank: F.min(F.when(F.col("upto") > rank, F.col("n")))
    out = r.groupBy("lang").agg(at(F.least(F.col("c") - 1, F.floor(0.95 * F.col("c")))).alias("p95"), at(F.least(F.col("c") - 1, F.floor(0.995 * F.col("c")))).alias("p995"), at(F.floor(F.col("c") / 2)).alias("median_"), F.max("n").alias("longest"))
    return out.withColumn("max_len", F.ceil(F.col("p995") / 256.0).cast("long") * 256)


@query("""SELECT user_id, arg_min(event_id, event_id) AS first_event, max(event_id) AS last_event, arg_max(event_type, event_id) AS last_type, min(event_type) AS lowest_type FROM events GROUP BY 1""")
def first_and_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.min("event_id").alias("first_event"), F.max("event_id").alias("last_event"), F.max_by("event_type", "event_id").alias("last_type"), F.min("event_type").alias("lowest_type"))


@query("""SELECT user_id, arg_max(event_id, CASE WHEN event_type = 'purchase' THEN 1000000000000 + event_id ELSE -event_id END) AS chosen FROM events WHERE event_type IN ('purchase', 'view') GROUP BY 1""")
def priority_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases override views; the last purchase, else the first view."""
    purchase = F.col("event_type") == "purchase"
    rank = F.struct(purchase.alias("a"), F.when(purchase, F.col("event_id")).otherwise(-F.col("event_id")).alias("b"))
    return table(spark, sf_dir, "events").where(F.col("event_type").isin("purchase", "view")).groupBy("user_id").agg(F.max_by("event_id", rank).alias("chosen"))


@query("SELECT source, array_to_string(list_sort(list_distinct(list(lang))), ',') AS langs FROM documents GROUP BY 1")
def distinct_sorted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy("source").agg(F.array_join(F.array_sort(F.collect_set("lang")), ",").alias("langs"))


@query("SELECT label, min(embedding[1]) AS x0, min(embedding[2]) AS y0, max(embedding[1]) AS x1, max(embedding[2]) AS y1 FROM embeddings GROUP BY 1")
def box_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").select("label", F.col("embedding")[0].alias("x"), F.col("embedding")[1].alias("y"))
    return e.groupBy("label").agg(F.min("x").alias("x0"), F.min("y").alias("y0"), F.max("x").alias("x1"), F.max("y").alias("y1"))


@query("SELECT l_orderkey, arg_min(l_linenumber, struct_pack(a := l_extendedprice, b := l_linenumber)) AS cheapest, arg_max(l_linenumber, struct_pack(a := l_extendedprice, b := l_linenumber)) AS dearest FROM lineitem GROUP BY 1")
def extreme_and_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.struct("l_extendedprice", "l_linenumber")
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.min_by("l_linenumber", at).alias("cheapest"), F.max_by("l_linenumber", at).alias("dearest"))


@query("WITH c AS (SELECT user_id, event_type, count(*) AS n, min(event_id) AS first FROM events GROUP BY 1, 2) SELECT user_id, arg_max(event_type, struct_pack(n := n, f := -first)) AS most FROM c GROUP BY 1")
def most_common_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"), F.min("event_id").alias("first"))
    return c.groupBy("user_id").agg(F.max_by("event_type", F.struct("n", (-F.col("first")).alias("f"))).alias("most"))


@query("SELECT p_brand, floor(regr_slope(p_retailprice, p_size) * 1000 + 0.5) / 1000 AS slope, floor(avg(CASE WHEN p_size > 25 THEN 1.0 ELSE 0.0 END) * 1000 + 0.5) / 1000 AS share FROM part GROUP BY 1")
def regression_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").groupBy("p_brand").agg((F.floor(F.regr_slope("p_retailprice", "p_size") * 1000 + 0.5) / 1000).alias("slope"), (F.floor(F.avg(F.when(F.col("p_size") > 25, 1.0).otherwise(0.0)) * 1000 + 0.5) / 1000).alias("share"))


@query("SELECT o_orderkey, floor(avg(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) * 100 + 0.5) / 100 AS mean3 FROM orders")
def moving_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey").rowsBetween(-2, 0)
    return table(spark, sf_dir, "orders").select("o_orderkey", (F.floor(F.avg("o_totalprice").over(w) * 100 + 0.5) / 100).alias("mean3"))


@query("SELECT DISTINCT w AS word FROM (SELECT unnest(regexp_extract_all(text, '[A-Z][A-Za-z]+')) AS w FROM documents)")
def vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.explode(F.regexp_extract_all("text", F.lit("[A-Z][A-Za-z]+"), F.lit(0))).alias("word")).distinct()


@query("SELECT user_id, value, count(*) AS n FROM events GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("user_id", "value").agg(F.count("*").alias("n")).where("n > 1")


@query("""WITH s AS (SELECT user_id, count(*) FILTER (WHERE value > 20) * 1.0 / count(*) AS ok FROM events GROUP BY 1) SELECT user_id, CASE WHEN ok >= 0.8 THEN 'high' WHEN ok >= 0.5 THEN 'medium' ELSE 'low' END AS confidence FROM s""")
def coverage_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok = F.count_if(F.col("value") > 20) / F.count("*")
    return table(spark, sf_dir, "events").groupBy("user_id").agg(ok.alias("ok")).select("user_id", F.when(F.col("ok") >= 0.8, "high").when(F.col("ok") >= 0.5, "medium").otherwise("low").alias("confidence"))


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS qty, floor(avg(l_discount) * 10000 + 0.5) / 10000 AS disc FROM lineitem GROUP BY 1, 2")
def means_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "lineitem")
    return l.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("qty"), (F.floor(F.avg("l_discount") * 10000 + 0.5) / 10000).alias("disc"))
