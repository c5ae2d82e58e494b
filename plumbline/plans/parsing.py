"""Parsers and scalar functions over columns of the tables, printed into the formats they read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions import parse
from plumbline.functions.udfs import calc, flatten_json, split_successive
from plumbline.query import query, table


@query("SELECT p_partkey, floor((p_partkey * 1000 + p_retailprice) * 1000 + 0.5) / 1000 AS pos FROM part")
def km_text_to_metres(spark: SparkSession, sf_dir: str) -> DataFrame:
    printed = F.format_string("%d+%.2f", F.col("p_partkey"), F.col("p_retailprice"))
    return table(spark, sf_dir, "part").select("p_partkey", (F.floor(parse.km_to_m(printed) * 1000 + 0.5) / 1000).alias("pos"))


@query("SELECT o_orderkey, (o_orderkey * 3) // 1000 || '+' || lpad(((o_orderkey * 3) % 1000)::VARCHAR, 3, '0') || '.000' AS km FROM orders")
def metres_to_km_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", parse.m_to_km((F.col("o_orderkey") * 3).cast("double")).alias("km"))


@query("SELECT p_partkey, CASE WHEN p_size = 1 THEN 'level' ELSE '1 in ' || p_size * 10 || CASE WHEN p_partkey % 2 = 0 THEN ' rising' ELSE ' falling' END END AS words FROM part")
def gradient_in_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("p_size") == 1, "LEVEL").otherwise(F.concat(F.when(F.col("p_partkey") % 2 == 0, "R ").otherwise("F "), F.lit("1 IN "), (F.col("p_size") * 10).cast("string")))
    return table(spark, sf_dir, "part").select("p_partkey", parse.gradient_words(label).alias("words"))


@query("SELECT p_partkey, floor((p_size + (p_partkey % 60) / 60.0) * 1000 + 0.5) / 1000 AS degrees FROM part")
def degrees_of_dms(spark: SparkSession, sf_dir: str) -> DataFrame:
    printed = F.format_string("%d° %d'", F.col("p_size"), F.col("p_partkey") % 60)
    return table(spark, sf_dir, "part").select("p_partkey", (F.floor(parse.dms(printed) * 1000 + 0.5) / 1000).alias("degrees"))


@query("SELECT event_id, (regexp_extract(props, '[0-9]+'))::BIGINT AS k FROM events")
def json_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query("SELECT event_id, {'k': regexp_extract(props, '[0-9]+')}['k'] AS flat FROM events")
def flattened_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", flatten_json("props")["k"].alias("flat"))


@query("SELECT p_partkey, floor((p_size * 3 - p_partkey / 4.0) * 1000 + 0.5) / 1000 AS value, NULL::VARCHAR AS error FROM part")
def arithmetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.format_string("(%d * 3) - %d / 4", F.col("p_size"), F.col("p_partkey"))
    return table(spark, sf_dir, "part").select("p_partkey", calc(text).alias("r")).select("p_partkey", "r.value", "r.error")


@query("SELECT p_partkey, upper(regexp_replace(p_name, '[^A-Za-z0-9]', '', 'g')) AS k, CASE WHEN regexp_matches(p_type, 'STEEL') THEN 'steel' WHEN regexp_matches(p_type, 'COPPER|BRASS') THEN 'alloy' ELSE 'other' END AS kind FROM part")
def keys_and_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", parse.key(F.col("p_name")).alias("k"), parse.first_kind(F.col("p_type"), [("steel", "STEEL"), ("alloy", "COPPER|BRASS")], "other").alias("kind"))


@query("SELECT n_nationkey, (n_nationkey + 10) || ',' || (n_nationkey + 11) AS pair FROM nation")
def successive_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_nationkey") + 10
    return table(spark, sf_dir, "nation").select("n_nationkey", F.array_join(split_successive(F.concat(n.cast("string"), (n + 1).cast("string"))), ",").alias("pair"))


_BARE = r"regexp_replace(regexp_replace(html, '(?is)<(script|style)\b.*?</(?:script|style)\s*>', ' ', 'g'), '<[^>]+>', ' ', 'g')"
for _name, _char in parse.ENTITIES.items():
    _BARE = f"replace({_BARE}, '{_name}', '{_char.replace(chr(39), chr(39) * 2)}')"


@query(rf"SELECT page_id, md5(trim(regexp_replace({_BARE}, '\s+', ' ', 'g'))) AS h FROM pages")
def tags_stripped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.md5(parse.strip_tags(F.col("html"))).alias("h"))


@query("SELECT doc_id, CASE WHEN len(x) = 0 THEN NULL ELSE list_max(x) END AS largest FROM (SELECT doc_id, list_transform(regexp_extract_all(text, '[0-9]+(?:[.][0-9]+)?'), lambda v: v::DOUBLE) AS x FROM documents)")
def largest_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.regexp_extract_all("text", F.lit(r"[0-9]+(?:[.][0-9]+)?"), F.lit(0))
    return table(spark, sf_dir, "documents").select("doc_id", F.array_max(F.transform(found, lambda v: v.cast("double"))).alias("largest"))
