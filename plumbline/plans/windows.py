"""Window queries on orders and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.operators import windows as op
from plumbline.query import query, table


@query("SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1")
def latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.latest(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderpriority"), ["o_custkey"], [F.desc("o_orderpriority"), F.desc("o_orderkey")]).select("o_custkey", "o_orderkey")


@query("SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority DESC, o_orderkey DESC) = 1 AS is_latest FROM orders")
def versions_with_latest_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_orderpriority"), F.desc("o_orderkey"))
    return table(spark, sf_dir, "orders").select("o_orderkey", (F.row_number().over(w) == 1).alias("is_latest"))


@query("""WITH m AS (SELECT l_orderkey, l_linenumber, l_returnflag = 'N' AS f, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_extendedprice)
 - row_number() OVER (PARTITION BY l_orderkey, l_returnflag = 'N' ORDER BY l_linenumber, l_partkey, l_extendedprice) AS g FROM lineitem)
SELECT l_orderkey, min(l_linenumber) AS run_from, max(l_linenumber) AS run_to, count(*) AS run_length FROM m WHERE f GROUP BY l_orderkey, g""")
def gaps_and_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_returnflag")
    return op.islands(rows, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_extendedprice"], F.col("l_returnflag") == "N")


@query("""WITH t AS (SELECT user_id, event_id, (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // 16 AS tile FROM events), n AS (SELECT *, count(*) OVER (PARTITION BY user_id, tile) AS n FROM t)
SELECT user_id, event_id, tile FROM n WHERE n >= 4""")
def tiles_of_sixteen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.tiles(table(spark, sf_dir, "events").select("user_id", "event_id"), ["user_id"], ["event_id"], 16, 4)


@query("SELECT event_id, min(event_id) OVER w AS window_from, max(event_id) OVER w AS window_to, count(*) OVER w AS window_rows FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 3 PRECEDING AND 4 FOLLOWING)")
def centred_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("event_id").rowsBetween(-3, 4)
    return table(spark, sf_dir, "events").select("event_id", F.min("event_id").over(w).alias("window_from"), F.max("event_id").over(w).alias("window_to"), F.count("*").over(w).alias("window_rows"))


@query("""WITH d AS (SELECT p_brand, p_partkey, p_retailprice, CASE WHEN p_retailprice - lag(p_retailprice) OVER w > 2 THEN 1 ELSE 0 END AS new FROM part WINDOW w AS (PARTITION BY p_brand ORDER BY p_retailprice, p_partkey))
SELECT p_partkey, sum(new) OVER (PARTITION BY p_brand ORDER BY p_retailprice, p_partkey ROWS UNBOUNDED PRECEDING)::BIGINT AS cluster FROM d""")
def cluster_by_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.gap_clusters(table(spark, sf_dir, "part").select("p_brand", "p_partkey", "p_retailprice"), ["p_brand"], "p_retailprice", "p_partkey", 2.0).select("p_partkey", "cluster")


@query("""WITH RECURSIVE r AS (SELECT p_brand, p_partkey, p_retailprice, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice, p_partkey) AS rn FROM part),
c AS (SELECT p_brand, p_partkey, rn, p_retailprice AS first, 0::BIGINT AS cluster FROM r WHERE rn = 1
 UNION ALL SELECT r.p_brand, r.p_partkey, r.rn, CASE WHEN r.p_retailprice - c.first > 25 THEN r.p_retailprice ELSE c.first END, CASE WHEN r.p_retailprice - c.first > 25 THEN c.cluster + 1 ELSE c.cluster END FROM c JOIN r ON r.p_brand = c.p_brand AND r.rn = c.rn + 1)
SELECT p_partkey, cluster FROM c""")
def cluster_by_first_member(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.anchored_clusters(table(spark, sf_dir, "part").select("p_brand", "p_partkey", "p_retailprice"), ["p_brand"], "p_retailprice", "p_partkey", 25.0).select("p_partkey", "cluster")


@query("""WITH p AS (SELECT o_custkey, o_orderkey, o_totalprice, lead(o_orderkey) OVER w AS next_key, lead(o_totalprice) OVER w AS next_price FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey))
SELECT o_orderkey, next_key, next_price - o_totalprice AS change, CASE WHEN abs(next_price - o_totalprice) < 1 THEN 'level' WHEN next_price > o_totalprice THEN 'rising' ELSE 'falling' END AS words FROM p WHERE next_key IS NOT NULL""")
def lead_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    p = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.lead("o_orderkey").over(w).alias("next_key"), F.lead("o_totalprice").over(w).alias("next_price")).where("next_key is not null")
    change = F.col("next_price") - F.col("o_totalprice")
    return p.select("o_orderkey", "next_key", change.alias("change"), F.when(F.abs(change) < 1, "level").when(change > 0, "rising").otherwise("falling").alias("words"))


@query("""WITH d AS (SELECT *, count(*) OVER (PARTITION BY user_id, value) > 1 AS dup FROM events), p AS (SELECT *, lag(CASE WHEN NOT dup THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id) AS before FROM d)
SELECT event_id, CASE WHEN NOT dup THEN event_id - before END AS distance FROM p""")
def distance_to_previous_unless_duplicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "value").withColumn("dup", F.count("*").over(Window.partitionBy("user_id", "value")) > 1)
    w = Window.partitionBy("user_id").orderBy("event_id").rowsBetween(Window.unboundedPreceding, -1)
    before = F.last(F.when(~F.col("dup"), F.col("event_id")), ignorenulls=True).over(w)
    return e.select("event_id", F.when(~F.col("dup"), F.col("event_id") - before).alias("distance"))


@query("SELECT o_custkey, bool_and(ok) AS increasing FROM (SELECT o_custkey, coalesce(o_totalprice > lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderkey), true) AS ok FROM orders) GROUP BY 1")
def strictly_increasing(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    return table(spark, sf_dir, "orders").select("o_custkey", F.coalesce(F.col("o_totalprice") > F.lag("o_totalprice").over(w), F.lit(True)).alias("ok")).groupBy("o_custkey").agg(F.bool_and("ok").alias("increasing"))


@query("""WITH l AS (SELECT conv_id, max(CASE WHEN role = 'user' THEN turn END) AS last_user FROM conversations GROUP BY 1)
SELECT c.conv_id, turn, CASE WHEN role = 'assistant' AND turn < last_user THEN '' ELSE text END AS text FROM conversations c LEFT JOIN l ON c.conv_id = l.conv_id""")
def drop_text_before_last_user_turn(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    last = F.max(F.when(F.col("role") == "user", F.col("turn"))).over(Window.partitionBy("conv_id"))
    return c.withColumn("last_user", last).select("conv_id", "turn", F.when((F.col("role") == "assistant") & (F.col("turn") < F.col("last_user")), "").otherwise(F.col("text")).alias("text"))


@query("""WITH m AS (SELECT user_id, event_id, event_type = 'view' AS f, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - row_number() OVER (PARTITION BY user_id, event_type = 'view' ORDER BY event_id) AS g FROM events),
r AS (SELECT user_id, min(event_id) AS run_from, count(*) AS run_length FROM m WHERE f GROUP BY user_id, g)
SELECT user_id, max(run_length) AS run_length, arg_min(run_from, struct_pack(n := -run_length, f := run_from)) AS run_from FROM r GROUP BY 1""")
def longest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = op.islands(table(spark, sf_dir, "events").select("user_id", "event_id", "event_type"), ["user_id"], ["event_id"], F.col("event_type") == "view")
    return runs.groupBy("user_id").agg(F.max("run_length").alias("run_length"), F.min_by("run_from", F.struct((-F.col("run_length")).alias("n"), "run_from")).alias("run_from"))
