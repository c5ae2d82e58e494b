"""Scalar families: normalisers, synonyms, tool calls, precedence of meanings, map and array work, validation flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.plans.evaluate import boxes
from plumbline.operators.ranking import best_printed
from plumbline.query import query, table

# Words that stand for one another in questions.
SYNONYMS = {"the": ["that"], "thing": ["item", "object"], "ing": ["doing"]}


def expanded(tokens: Column) -> Column:
    """Tokens with their synonyms, and the singular of words that end in s, each once."""
    extra = F.create_map(*[x for k, v in SYNONYMS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    none = F.array().cast("array<string>")
    more = F.flatten(F.transform(tokens, lambda t: F.coalesce(F.try_element_at(extra, t), none)))
    single = F.transform(F.filter(tokens, lambda t: t.rlike("^.{3,}s$")), lambda t: F.regexp_replace(t, "s$", ""))
    return F.array_distinct(F.concat(tokens, more, single))


@query("""WITH t AS (SELECT item_id, list_distinct(regexp_extract_all(lower(text), '[a-z]+')) AS ts FROM benchmark), e AS (SELECT item_id, unnest(list_concat(ts, list_transform(list_filter(ts, lambda t: regexp_matches(t, '^.{3,}s$')), lambda t: regexp_replace(t, 's$', '')),
 CASE WHEN list_contains(ts, 'the') THEN ['that'] ELSE [] END, CASE WHEN list_contains(ts, 'thing') THEN ['item', 'object'] ELSE [] END, CASE WHEN list_contains(ts, 'ing') THEN ['doing'] ELSE [] END)) AS t FROM t)
SELECT item_id, count(DISTINCT t) AS n FROM e GROUP BY 1""")
def expanded_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0)))
    return table(spark, sf_dir, "benchmark").select("item_id", F.size(expanded(t)).cast("long").alias("n"))


def normalised(value: Column) -> Column:
    """'12 mm' to metres, '5.50 m' and '100 kmph' to plain numbers, three decimals as text; other texts trimmed in lower case."""
    n = F.nullif(F.regexp_extract(value, r"^\s*(-?[0-9]+(?:\.[0-9]+)?)\s*(?:mm|m|kmph)?\s*$", 1), F.lit("")).try_cast("double")
    return F.when(n.isNotNull(), F.format_string("%.3f", F.when(value.rlike(r"mm\s*$"), n / 1000).otherwise(n))).otherwise(F.lower(F.trim(value)))


@query("SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN printf('%.3f', p_size / 1000.0) WHEN 1 THEN printf('%.3f', p_size::DOUBLE) ELSE lower(p_brand) END AS v FROM part")
def normalised_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, k = F.col("p_size").cast("string"), F.col("p_partkey") % 3
    printed = F.when(k == 0, F.concat(s, F.lit(" mm"))).when(k == 1, F.concat(s, F.lit(" kmph"))).otherwise(F.concat(F.lit(" "), "p_brand", F.lit(" ")))
    return table(spark, sf_dir, "part").select("p_partkey", normalised(printed).alias("v"))


def tool_calls(text: Column) -> Column:
    """Calls printed as <call name="x">key=value;...</call>: array of (name, arguments)."""
    found = F.regexp_extract_all(text, F.lit('(?s)<call name="[^"]*">.*?</call>'), F.lit(0))
    body = lambda c: F.regexp_extract(c, "(?s)>(.*)</call>", 1)
    return F.transform(found, lambda c: F.struct(F.regexp_extract(c, 'name="([^"]*)"', 1).alias("name"), F.str_to_map(body(c), F.lit(";"), F.lit("=")).alias("args")))


@query("SELECT event_id, event_type AS first_tool, user_id::VARCHAR AS line FROM events")
def first_tool_and_arguments(spark: SparkSession, sf_dir: str) -> DataFrame:
    printed = F.concat(F.lit('so <call name="'), "event_type", F.lit('">line='), F.col("user_id").cast("string"), F.lit(';k=1</call> then <call name="z">a=1</call>'))
    return table(spark, sf_dir, "events").select("event_id", F.get(tool_calls(printed), F.lit(0)).alias("c")).select("event_id", F.col("c.name").alias("first_tool"), F.col("c.args")["line"].alias("line"))


@query("""SELECT n.n_nationkey, CASE WHEN r.r_regionkey = 1 THEN 'approved ' || r.r_name WHEN n.n_nationkey % 4 = 0 THEN 'built-in' WHEN s.k IS NOT NULL THEN 'seen' ELSE 'unknown' END AS meaning
FROM nation n LEFT JOIN region r ON r.r_regionkey = n.n_regionkey LEFT JOIN (SELECT DISTINCT s_nationkey AS k FROM supplier) s ON s.k = n.n_nationkey""")
def meaning_by_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first source that knows a term: ordered left joins and a coalesce."""
    n = table(spark, sf_dir, "nation")
    approved = table(spark, sf_dir, "region").where("r_regionkey = 1").select(F.col("r_regionkey").alias("n_regionkey"), F.concat(F.lit("approved "), "r_name").alias("a"))
    seen = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("n_nationkey")).distinct().withColumn("c", F.lit("seen"))
    built = F.when(F.col("n_nationkey") % 4 == 0, "built-in")
    return n.join(approved, "n_regionkey", "left").join(seen, "n_nationkey", "left").select("n_nationkey", F.coalesce("a", built, "c", F.lit("unknown")).alias("meaning"))


@query("SELECT p_partkey, CASE WHEN p_size > 20 THEN 2 ELSE 1 END AS kept, CASE WHEN p_size % 2 = 0 THEN 'size' ELSE '' END AS differs FROM part")
def map_filter_and_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.create_map(F.lit("size"), F.col("p_size"), F.lit("big"), F.when(F.col("p_size") > 20, 1))
    other = F.create_map(F.lit("size"), F.col("p_size") + (F.col("p_size") % 2 == 0).cast("int"), F.lit("big"), F.when(F.col("p_size") > 20, 1))
    differs = F.map_filter(F.map_zip_with(m, other, lambda k, a, b: ~a.eqNullSafe(b)), lambda k, v: v)
    return table(spark, sf_dir, "part").select("p_partkey", F.size(F.map_filter(m, lambda k, v: v.isNotNull())).alias("kept"), F.array_join(F.map_keys(differs), ",").alias("differs"))


@query("""WITH b AS (SELECT vec_id, vec_id % 100 AS page, embedding[1]::DOUBLE * 10 AS x, embedding[2]::DOUBLE * 10 AS y FROM embeddings) SELECT vec_id, x >= -2 AND y >= -2 AND x + 3 <= 3 AND y + 3 <= 3 AS inside, greatest(abs(floor(x * 1000 + 0.5) / 1000 - x), abs(floor(y * 1000 + 0.5) / 1000 - y)) <= 0.0005001 AS round_trip FROM b""")
def boxes_validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    r3 = lambda v: F.floor(v * 1000 + 0.5) / 1000
    x, y = F.col("x"), F.col("y")
    return boxes(spark, sf_dir).select("vec_id", ((x >= -2) & (y >= -2) & (x + 3 <= 3) & (y + 3 <= 3)).alias("inside"), (F.greatest(F.abs(r3(x) - x), F.abs(r3(y) - y)) <= 0.0005001).alias("round_trip"))


@query("""SELECT conv_id, count(*) FILTER (WHERE role = 'user') = count(*) FILTER (WHERE role = 'assistant') AS paired, bool_or(contains(text, '<image>')) AS has_images, sum(length(text)) AS n FROM conversations GROUP BY 1""")
def rows_validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    role = F.col("role")
    return table(spark, sf_dir, "conversations").groupBy("conv_id").agg((F.count_if(role == "user") == F.count_if(role == "assistant")).alias("paired"), F.bool_or(F.contains("text", F.lit("<image>"))).alias("has_images"), F.sum(F.length("text")).alias("n"))


@query("""SELECT lang, sum(n_chars) AS chars, floor(sum(n_chars) / 1000.0 + 0.5) / 1000 AS millions, count(*) FILTER (WHERE n_chars > 3072) AS left_out FROM documents GROUP BY 1""")
def kept_token_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.sum("n_chars")
    return table(spark, sf_dir, "documents").groupBy("lang").agg(n.alias("chars"), (F.floor(n / 1000.0 + 0.5) / 1000).alias("millions"), F.count_if(F.col("n_chars") > 3072).alias("left_out"))


@query("""SELECT o_orderkey, (o_orderpriority LIKE '1%' AND o_orderstatus = 'F') AS all_asked FROM orders""")
def all_asked_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether every asked condition holds for a row."""
    asked = F.array(F.startswith("o_orderpriority", F.lit("1")), F.col("o_orderstatus") == "F")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.forall(asked, lambda x: x).alias("all_asked"))


_PRINTED = "list_distinct(list_transform(regexp_extract_all(text, '[0-9]+(?:[.][0-9]+)?'), lambda x: x::DOUBLE)) AS numbers, list_distinct(regexp_extract_all(upper(text), '[A-Z]+-?[0-9]+')) AS codes, list_distinct(regexp_extract_all(lower(text), '[a-z]{3,}')) AS words"


@query(f"""WITH q AS (SELECT item_id, {_PRINTED} FROM benchmark), d AS (SELECT doc_id, {_PRINTED} FROM documents),
j AS (SELECT item_id, doc_id, sum(score)::BIGINT AS score FROM (
 SELECT item_id, doc_id, count(DISTINCT v) * 10 AS score FROM (SELECT item_id, unnest(numbers) AS v FROM q) JOIN (SELECT doc_id, unnest(numbers) AS x FROM d) ON v >= 10 AND x >= 10 AND abs(v - x) <= 0.6 + 1e-9 GROUP BY 1, 2
 UNION ALL SELECT item_id, doc_id, count(*) * 10 FROM (SELECT item_id, unnest(codes) AS v FROM q) JOIN (SELECT doc_id, unnest(codes) AS v FROM d) USING (v) GROUP BY 1, 2
 UNION ALL SELECT item_id, doc_id, count(*) FROM (SELECT item_id, unnest(words) AS v FROM q) JOIN (SELECT doc_id, unnest(words) AS v FROM d) USING (v) GROUP BY 1, 2) GROUP BY 1, 2)
SELECT item_id, arg_max(doc_id, struct_pack(s := score, d := -doc_id)) AS best, max(score) AS score FROM j GROUP BY 1""")
def printed_text_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text that fits a question best by numbers, codes and words of three letters or more."""
    found = lambda pattern, text: F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    parts = [F.array_distinct(F.transform(found(r"[0-9]+(?:[.][0-9]+)?", F.col("text")), lambda x: x.cast("double"))).alias("numbers"), found("[A-Z]+-?[0-9]+", F.upper("text")).alias("codes"), found("[a-z]{3,}", F.lower("text")).alias("words")]
    texts = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("tid"), *parts)
    found = best_printed(texts, table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), *parts))
    return found.select(F.col("qid").alias("item_id"), F.col("tid").alias("best"), "score")
