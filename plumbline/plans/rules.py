"""Consistency rules that emit typed findings: severity, category, item, message. Comparisons are strict where the rule says so."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.operators import windows
from plumbline.query import query, table


def finding(rows: DataFrame, severity: str, category: str, item: Column, message: Column) -> DataFrame:
    return rows.select(F.lit(severity).alias("severity"), F.lit(category).alias("category"), item.cast("string").alias("item"), message.alias("message"))


@query("SELECT 'FLAG' AS severity, 'threshold' AS category, p_partkey::VARCHAR AS item, 'below the least value' AS message FROM part WHERE p_retailprice < 900 + p_size * 10")
def rule_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finding(table(spark, sf_dir, "part").where(F.col("p_retailprice") < 900 + F.col("p_size") * 10), "FLAG", "threshold", F.col("p_partkey"), F.lit("below the least value"))


@query("""SELECT 'CHECK' AS severity, 'identity' AS category, l_orderkey || '-' || l_linenumber AS item,
 concat_ws('; ', CASE WHEN abs(l_extendedprice - l_quantity * 1000) > 40000 THEN 'price' END, CASE WHEN abs(l_discount - l_tax) > 0.09 THEN 'rate' END, CASE WHEN l_quantity % 10 = 0 THEN 'lot' END) AS message
FROM lineitem WHERE abs(l_extendedprice - l_quantity * 1000) > 40000 OR abs(l_discount - l_tax) > 0.09 OR l_quantity % 10 = 0""")
def rule_identities_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several identities with tolerances, one finding with the messages of those that fail."""
    price, rate, lot = F.abs(F.col("l_extendedprice") - F.col("l_quantity") * 1000) > 40000, F.abs(F.col("l_discount") - F.col("l_tax")) > 0.09, F.col("l_quantity") % 10 == 0
    message = F.concat_ws("; ", F.when(price, "price"), F.when(rate, "rate"), F.when(lot, "lot"))
    return finding(table(spark, sf_dir, "lineitem").where(price | rate | lot), "CHECK", "identity", F.concat_ws("-", "l_orderkey", "l_linenumber"), message)


@query("""WITH a AS (SELECT l_partkey, l_suppkey, max(l_tax) AS t, max(l_discount) AS d FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2), b AS (SELECT l_partkey, l_suppkey, max(l_tax) AS t, max(l_discount) AS d FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1, 2)
SELECT 'CHECK' AS severity, 'copies' AS category, a.l_partkey || '/' || a.l_suppkey AS item, concat_ws(',', CASE WHEN a.t <> b.t THEN 'tax' END, CASE WHEN a.d <> b.d THEN 'discount' END) AS message FROM a JOIN b USING (l_partkey, l_suppkey) WHERE a.t <> b.t OR a.d <> b.d""")
def rule_two_copies_differ(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "lineitem")
    side = lambda flag, k: l.where(F.col("l_returnflag") == flag).groupBy("l_partkey", "l_suppkey").agg(F.max("l_tax").alias("t" + k), F.max("l_discount").alias("d" + k))
    both = side("R", "1").join(side("A", "2"), ["l_partkey", "l_suppkey"])
    tax, disc = F.col("t1") != F.col("t2"), F.col("d1") != F.col("d2")
    return finding(both.where(tax | disc), "CHECK", "copies", F.concat_ws("/", "l_partkey", "l_suppkey"), F.concat_ws(",", F.when(tax, "tax"), F.when(disc, "discount")))


@query("""SELECT CASE WHEN o_orderpriority IS NULL THEN 'FLAG' WHEN o_orderstatus = 'P' THEN 'CHECK' ELSE 'INFO' END AS severity, 'incomplete' AS category, o_orderkey::VARCHAR AS item,
 CASE WHEN o_orderpriority IS NULL THEN 'no priority' WHEN o_orderstatus = 'P' THEN 'pending' ELSE 'no lines' END AS message
FROM orders o WHERE o_orderpriority IS NULL OR o_orderstatus = 'P' OR NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)""")
def rule_exclusive_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An if / else-if chain: the first that holds reports; completeness elsewhere is an anti join."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey").distinct().withColumn("has", F.lit(True))
    o = table(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    none, pending, alone = F.col("o_orderpriority").isNull(), F.col("o_orderstatus") == "P", F.col("has").isNull()
    o = o.where(none | pending | alone)
    pick = lambda a, b, c: F.when(none, a).when(pending, b).otherwise(c)
    return o.select(pick("FLAG", "CHECK", "INFO").alias("severity"), F.lit("incomplete").alias("category"), F.col("o_orderkey").cast("string").alias("item"), pick("no priority", "pending", "no lines").alias("message"))


@query("""WITH m AS (SELECT user_id, event_id, value < 20 AS f, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - row_number() OVER (PARTITION BY user_id, value < 20 ORDER BY event_id) AS g FROM events)
SELECT 'INFO' AS severity, 'blank' AS category, user_id::VARCHAR AS item, min(event_id) || ' to ' || max(event_id) || ' (' || count(*) || ')' AS message FROM m WHERE f GROUP BY user_id, g""")
def rule_blank_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = windows.islands(table(spark, sf_dir, "events").select("user_id", "event_id", "value"), ["user_id"], ["event_id"], F.col("value") < 20)
    return finding(runs, "INFO", "blank", F.col("user_id"), F.concat("run_from", F.lit(" to "), "run_to", F.lit(" ("), "run_length", F.lit(")")))


@query("""WITH p AS (SELECT o_custkey, o_orderkey, o_totalprice AS a, lead(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS b FROM orders)
SELECT CASE WHEN b - a > 100000 THEN 'FLAG' ELSE 'CHECK' END AS severity, 'continuity' AS category, o_orderkey::VARCHAR AS item, CASE WHEN b - a > 100000 THEN 'gap' ELSE 'overlap' END AS message FROM p WHERE b - a > 100000 OR b - a < -100000""")
def rule_continuity(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    p = table(spark, sf_dir, "orders").select("o_orderkey", (F.lead("o_totalprice").over(w) - F.col("o_totalprice")).alias("step")).where("step > 100000 or step < -100000")
    gap = F.col("step") > 100000
    return p.select(F.when(gap, "FLAG").otherwise("CHECK").alias("severity"), F.lit("continuity").alias("category"), F.col("o_orderkey").cast("string").alias("item"), F.when(gap, "gap").otherwise("overlap").alias("message"))


@query("""WITH s AS (SELECT user_id, event_id, value AS a, lag(value) OVER w AS b, lag(event_type) OVER w AS t, event_type FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
r AS (SELECT *, CASE WHEN t = event_type AND abs(a - b) > 50 THEN 'CHECK levels' WHEN t <> event_type AND a > 95 THEN 'FLAG steep' END AS verdict FROM s)
SELECT split_part(verdict, ' ', 1) AS severity, 'gradient' AS category, event_id::VARCHAR AS item, split_part(verdict, ' ', 2) AS message FROM r WHERE verdict IS NOT NULL""")
def rule_levels_before_steepness(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("event_id")
    s = table(spark, sf_dir, "events").select("event_id", "event_type", "value", F.lag("value").over(w).alias("b"), F.lag("event_type").over(w).alias("t"))
    same = F.col("t") == F.col("event_type")
    verdict = F.when(same & (F.abs(F.col("value") - F.col("b")) > 50), "CHECK levels").when((F.col("t") != F.col("event_type")) & (F.col("value") > 95), "FLAG steep")
    s = s.withColumn("v", F.split(verdict, " ")).where("v is not null")
    return s.select(F.col("v")[0].alias("severity"), F.lit("gradient").alias("category"), F.col("event_id").cast("string").alias("item"), F.col("v")[1].alias("message"))


def curve_values(length: Column, radius: Column, delta: Column) -> tuple[Column, Column, Column]:
    """Shift, tangent length and degree of a transition curve."""
    shift = length * length / (24 * radius)
    return shift, (radius + shift) * F.tan(F.radians(delta / 2)) + length / 2, 1750 / radius


@query("""WITH c AS (SELECT p_partkey, p_size + 20.0 AS l, p_retailprice AS r, (p_partkey % 60) + 5.0 AS d FROM part), v AS (SELECT *, l * l / (24 * r) AS shift FROM c)
SELECT p_partkey, floor(shift * 1000 + 0.5) / 1000 AS shift, floor(((r + shift) * tan(radians(d / 2)) + l / 2) * 1000 + 0.5) / 1000 AS ttl, floor(1750 / r * 1000 + 0.5) / 1000 AS degree FROM v""")
def curve_formulas(spark: SparkSession, sf_dir: str) -> DataFrame:
    r3 = lambda x: F.floor(x * 1000 + 0.5) / 1000
    shift, ttl, degree = curve_values(F.col("p_size") + 20.0, F.col("p_retailprice"), (F.col("p_partkey") % 60) + 5.0)
    return table(spark, sf_dir, "part").select("p_partkey", r3(shift).alias("shift"), r3(ttl).alias("ttl"), r3(degree).alias("degree"))


@query("""WITH b AS (SELECT l_orderkey, l_linenumber, l_quantity AS base, [l_tax * 400, l_discount * 400, l_extendedprice / 2000] AS hs FROM lineitem)
SELECT l_orderkey, l_linenumber, list_filter(hs, lambda h: abs(base - h - 10) < 2)[1] AS fits FROM b""")
def rule_any_level_fits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first of several levels with which an identity holds; null: none does."""
    levels = F.array(F.col("l_tax") * 400, F.col("l_discount") * 400, F.col("l_extendedprice") / 2000)
    fits = F.filter(levels, lambda h: F.abs(F.col("l_quantity") - h - 10) < 2)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.get(fits, F.lit(0)).alias("fits"))


@query("""SELECT 'part' AS source, severity, count(*) AS n FROM (SELECT CASE WHEN p_retailprice < 900 + p_size * 10 THEN 'FLAG' WHEN p_size > 45 THEN 'CHECK' ELSE 'INFO' END AS severity FROM part) GROUP BY 2""")
def findings_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.when(F.col("p_retailprice") < 900 + F.col("p_size") * 10, "FLAG").when(F.col("p_size") > 45, "CHECK").otherwise("INFO")
    return table(spark, sf_dir, "part").groupBy(s.alias("severity")).agg(F.count("*").alias("n")).select(F.lit("part").alias("source"), "severity", "n")
