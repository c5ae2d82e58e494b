"""Values, tokens, calls and rules on texts of several formats, faulty ones among them, made from keys by one expression for
both engines; the SQL reads the same texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions import rules, values
from plumbline.functions.udfs import KEEP, flatten_json_by, match_boxes, reword_udf
from plumbline.operators.variants import draw
from plumbline.plans.evaluate import boxes
from plumbline.plans.retrieve import STOP
from plumbline.query import query, table


def texts(spark: SparkSession, sf_dir: str, name: str, key: str, made: str, *more: str) -> DataFrame:
    return table(spark, sf_dir, name).select(key, F.expr(made).alias("text"), *more)


_MIXED = """CASE p_partkey % 8 WHEN 0 THEN 'from ' || (p_partkey % 900) || '+' || p_size || '.5 to ' || (p_partkey % 900) || '+' || p_size || '.5 and 1,234,567.25' WHEN 1 THEN 'H.F.L. ' || p_size || ' at R.L. ' || p_size || '.00, up/dn; the b.m. 12,34 and 1,2345'
 WHEN 2 THEN p_name || ' 12+ ' || p_partkey || ',000' WHEN 3 THEN p_name || ' no number, e.g. a.b.c.d.e.f' WHEN 4 THEN '' WHEN 5 THEN 'and/or/not ' || p_size || '.' || p_size || '.' || p_size WHEN 6 THEN '7+8+9 ' || p_type ELSE NULL END"""
_AT = "regexp_extract_all(text, '[0-9]+\\+[0-9]+(?:\\.[0-9]+)?')"


@query(rf"""WITH t AS (SELECT p_partkey, {_MIXED} AS text FROM part),
n AS (SELECT p_partkey, list_transform({_AT}, lambda x: split_part(x, '+', 1)::DOUBLE * 1000 + split_part(x, '+', 2)::DOUBLE) AS a, list_transform(regexp_extract_all(regexp_replace(text, '[0-9]+\+[0-9]+(?:\.[0-9]+)?', ' ', 'g'), '[0-9]{{1,3}}(?:,[0-9]{{3}})+(?:\.[0-9]+)?|[0-9]+(?:\.[0-9]+)?'), lambda x: replace(x, ',', '')::DOUBLE) AS b FROM t)
SELECT p_partkey, CASE WHEN a IS NOT NULL THEN len(list_distinct(list_concat(a, b)))::INTEGER END AS n, list_sum(list_distinct(list_concat(a, b))) AS total FROM n""")
def numbers_and_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many numbers a text has, and their sum: positions, thousands with commas, numbers that only look like them."""
    found = values.numbers(F.col("text"))
    t = texts(spark, sf_dir, "part", "p_partkey", _MIXED).withColumn("found", found)
    return t.select("p_partkey", F.when(F.col("found").isNotNull(), F.size("found")).alias("n"), F.when(F.size("found") > 0, F.aggregate("found", F.lit(0.0), lambda a, x: a + x)).alias("total"))


_SHORT = "lower(text)"
for _n in (5, 4, 3, 2):
    _SHORT = f"regexp_replace({_SHORT}, '\\b{'\\.'.join(['([a-z])'] * _n)}\\b\\.?', '{''.join(f'\\{k}' for k in range(1, _n + 1))}', 'g')"
_STOPS = ", ".join(f"'{w}'" for w in STOP)


@query(rf"""WITH t AS (SELECT p_partkey, {_MIXED} AS text FROM part), w AS (SELECT p_partkey, list_filter(regexp_extract_all({_SHORT}, '[a-z]+(?:/[a-z]+)*|[0-9]+(?:[.][0-9]+)?'), lambda x: x NOT IN ({_STOPS})) AS words FROM t)
SELECT p_partkey, array_to_string(list_sort(list_distinct(words)), ' ') AS tokens FROM w""")
def tokens_with_shorthand(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = texts(spark, sf_dir, "part", "p_partkey", _MIXED)
    return t.select("p_partkey", F.array_join(F.array_sort(values.tokens(F.col("text"), STOP)), " ").alias("tokens"))


_REPLY = """CASE p_partkey % 7 WHEN 0 THEN 'Here: ```json {"size": ' || p_size || ', "tags": ["a", null]} ``` done {x}' WHEN 1 THEN 'I read [1, ' || p_size || ', {"b": true}] there' WHEN 2 THEN 'broken {"size": ' || p_size || ', "x" } end' WHEN 3 THEN 'none'
 WHEN 4 THEN '```json not json ```' WHEN 5 THEN '{"a": {"b": [' || p_size || ']}} and } more' ELSE NULL END"""


@query(rf"""WITH t AS (SELECT p_partkey, {_REPLY} AS text FROM part), j AS (SELECT p_partkey, coalesce(nullif(regexp_extract(text, '(?s)```json\s*(.*?)```', 1), ''), nullif(regexp_extract(text, '(?s)(\[.*\]|\{{.*\}})', 1), '')) AS held FROM t)
SELECT p_partkey, CASE WHEN json_valid(held) THEN trim(held) END AS json FROM j""")
def valid_json_of_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON in a fence, between brackets, broken, missing: only what is valid is kept."""
    t = texts(spark, sf_dir, "part", "p_partkey", _REPLY)
    return t.select("p_partkey", F.trim(values.json_of(F.col("text"))).alias("json"))


_ANSWER = "CASE p_partkey % 5 WHEN 0 THEN 'The ' || upper(p_name) || ' is ' || p_size || '.00 wide' WHEN 1 THEN p_name || ' of ' || (p_size + 1) WHEN 2 THEN 'Nothing' WHEN 3 THEN p_type || '  ' || p_size || ' and ' || p_brand ELSE NULL END"


@query(rf"""WITH t AS (SELECT p_partkey, {_ANSWER} AS text, CASE p_partkey % 6 WHEN 0 THEN [] ELSE [p_name, p_size || '.0', p_size::VARCHAR, upper(p_type), ' ', NULL] END AS wanted FROM part),
n AS (SELECT p_partkey, coalesce(trim(regexp_replace(lower(text || ' '), '\s+', ' ', 'g')), '') AS text, list_distinct(list_filter(list_transform(wanted, lambda v: CASE WHEN regexp_matches(v, '^-?[0-9]+(\.[0-9]+)?$') THEN regexp_replace(printf('%.3f', v::DOUBLE), '\.?0+$', '') ELSE trim(lower(v)) END), lambda v: v IS NOT NULL AND v <> '')) AS wanted FROM t),
h AS (SELECT *, list_transform(regexp_extract_all(text, '[0-9]+(?:\.[0-9]+)?'), lambda x: regexp_replace(printf('%.3f', x::DOUBLE), '\.?0+$', '')) AS have FROM n)
SELECT p_partkey, CASE WHEN len(wanted) > 0 THEN len(list_filter(wanted, lambda v: list_contains(have, v) OR (NOT regexp_matches(v, '^[0-9.]+$') AND contains(text, v)))) / len(wanted)::DOUBLE END AS recall FROM h""")
def recall_of_normal_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers by value, other values anywhere in the answer; no value asked gives null."""
    size, none = F.col("p_size").cast("string"), F.lit(None).cast("string")
    wanted = F.when(F.col("p_partkey") % 6 == 0, F.array().cast("array<string>")).otherwise(F.array("p_name", F.concat(size, F.lit(".0")), size, F.upper("p_type"), F.lit(" "), none))
    t = texts(spark, sf_dir, "part", "p_partkey", _ANSWER, "p_name", "p_size", "p_type")
    return t.select("p_partkey", values.value_recall(F.col("text"), wanted).alias("recall"))


_CALLS = """CASE p_partkey % 4 WHEN 0 THEN 'so <call name="find"><arg name="line">' || p_brand || '</arg><arg name="at"> ' || p_size || '.5 </arg><arg name="at">9</arg></call> and <call name="calc"><arg name="text">1+"1"</arg><arg name="exact">TRUE</arg></call>'
 WHEN 1 THEN '<call name="find"><arg name="at">near ' || p_size || '</arg></call>' WHEN 2 THEN 'no call <call name="find">' ELSE '<call name="other"><arg name="at">' || p_size || '</arg></call>' END"""


@query(f"""WITH k AS (SELECT p_partkey, p_brand, p_size FROM part)
SELECT p_partkey, 0 AS place, 'find' AS tool, '{{"line":"' || p_brand || '","at":' || p_size || '.5}}' AS arguments FROM k WHERE p_partkey % 4 = 0 UNION ALL SELECT p_partkey, 1, 'calc', '{{"text":"1+\\"1\\"","exact":true}}' FROM k WHERE p_partkey % 4 = 0
UNION ALL SELECT p_partkey, 0, 'find', '{{"at":"near ' || p_size || '"}}' FROM k WHERE p_partkey % 4 = 1 UNION ALL SELECT p_partkey, 0, 'other', '{{"at":"' || p_size || '"}}' FROM k WHERE p_partkey % 4 = 3""")
def typed_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls with arguments typed by a schema; what is not of its kind stays a text."""
    calls = values.tool_calls(F.col("text"), {"find.at": "number", "calc.exact": "boolean"})
    t = texts(spark, sf_dir, "part", "p_partkey", _CALLS).select("p_partkey", F.posexplode(calls).alias("place", "c"))
    pairs = F.transform(F.map_entries("c.arguments"), lambda e: F.concat(F.lit('"'), e["key"], F.lit('":'), e["value"]))
    return t.select("p_partkey", "place", F.col("c.name").alias("tool"), F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}")).alias("arguments"))


_SAID = """CASE p_partkey % 4 WHEN 0 THEN 'at ' || p_partkey || '+' || p_size || '.5 is "' || p_name || ' 7" or -' || p_size WHEN 1 THEN p_name WHEN 2 THEN '12' ELSE '' END"""


@query(rf"""WITH t AS (SELECT p_partkey, {_SAID} AS text FROM part), k AS (SELECT p_partkey, regexp_extract_all(text, '{KEEP}') AS kept, regexp_split_to_array(text, '{KEEP}') AS free FROM t)
SELECT p_partkey, array_to_string(list_transform(range(1, len(free) + 1), lambda i: free[i] || CASE WHEN i <= len(kept) THEN '⟦' || (i - 1) || '⟧' ELSE '' END), '') AS masked, array_to_string(kept, '; ') AS kept FROM k""")
def protected_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers, positions and quotes as placeholders, and what they stand for."""
    t = texts(spark, sf_dir, "part", "p_partkey", _SAID).withColumn("p", values.protected(F.col("text")))
    return t.select("p_partkey", F.col("p.text").alias("masked"), F.array_join("p.kept", "; ").alias("kept"))


@query("""WITH t AS (SELECT p_partkey, p_name || ' ' || p_type || ' ' || p_brand AS text, CASE p_partkey % 4 WHEN 0 THEN upper(p_type) || ', ' || split_part(p_name, ' ', 1) WHEN 1 THEN 'ring brand' WHEN 2 THEN ' - ' ELSE 'sma' END AS asked FROM part)
SELECT p_partkey, len(list_filter(list_filter(regexp_split_to_array(lower(asked), '[^a-z0-9]+'), lambda w: w <> ''), lambda w: NOT list_contains(regexp_split_to_array(lower(text), '[^a-z0-9]+'), w))) = 0 AS fits FROM t""")
def rows_with_asked_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey") % 4
    asked = F.when(k == 0, F.concat(F.upper("p_type"), F.lit(", "), F.split_part("p_name", F.lit(" "), F.lit(1)))).when(k == 1, "ring brand").when(k == 2, " - ").otherwise("sma")
    return table(spark, sf_dir, "part").select("p_partkey", values.all_words(F.concat_ws(" ", "p_name", "p_type", "p_brand"), asked).alias("fits"))


_LABELS = "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE l_partkey % 5 WHEN 0 THEN 'level' WHEN 1 THEN '1 in 2500 rising' WHEN 2 THEN '1 in ' || (100 + l_partkey % 50) || ' rising' WHEN 3 THEN '1 in ' || (100 + l_partkey % 50) || ' falling' END AS after, CASE l_suppkey % 4 WHEN 0 THEN 'level' WHEN 1 THEN '1 in 2500 rising' WHEN 2 THEN '1 in ' || (100 + l_partkey % 50) || ' rising' END AS before, 1000.0 AS run, CASE l_suppkey % 6 WHEN 0 THEN 0.0 WHEN 1 THEN 0.004 WHEN 2 THEN -1000.0 / (100 + l_partkey % 50) WHEN 3 THEN 1020.0 / (100 + l_partkey % 50) WHEN 4 THEN 1100.0 / (100 + l_partkey % 50) END AS rise FROM lineitem"


@query(f"""WITH l AS ({_LABELS}), n AS (SELECT *, try_cast(nullif(regexp_extract(after, '1 in ([0-9]+)', 1), '') AS DOUBLE) AS n, try_cast(nullif(regexp_extract(before, '1 in ([0-9]+)', 1), '') AS DOUBLE) AS m FROM l),
f AS (SELECT *, CASE WHEN after <> before THEN CASE WHEN coalesce(n, 1e9) >= 2000 AND coalesce(m, 1e9) >= 2000 THEN 'INFO' ELSE 'CHECK' END END AS labels, CASE WHEN after = 'level' AND abs(rise) > 0.005 THEN 'level' WHEN n > 0 AND abs(rise) < 1e-6 THEN 'flat' WHEN n > 0 AND abs(run / abs(rise) - n) / n > 0.03 THEN 'rate' WHEN n > 0 AND (rise > 0) <> (after LIKE '%rising') THEN 'sign' END AS levels FROM n)
SELECT coalesce(labels, '-') AS labels, coalesce(levels, '-') AS levels, coalesce(CASE WHEN n < 120 THEN 'FLAG' END, '-') AS ruling, CASE WHEN abs(rise) < 1e-6 THEN 'level' WHEN rise > 0 THEN 'rising' WHEN rise < 0 THEN 'falling' ELSE '-' END AS implied, count(*) AS stretches FROM f GROUP BY 1, 2, 3, 4""")
def gradient_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stretches by what their labels and levels give: each branch of the checks is reached."""
    part, supp = F.col("l_partkey"), F.col("l_suppkey")
    n = 100 + part % 50
    words = lambda way: F.concat(F.lit("1 in "), n.cast("string"), F.lit(f" {way}"))
    after = F.when(part % 5 == 0, "level").when(part % 5 == 1, "1 in 2500 rising").when(part % 5 == 2, words("rising")).when(part % 5 == 3, words("falling"))
    before = F.when(supp % 4 == 0, "level").when(supp % 4 == 1, "1 in 2500 rising").when(supp % 4 == 2, words("rising"))
    k = supp % 6
    rise = F.when(k == 0, 0.0).when(k == 1, 0.004).when(k == 2, F.lit(-1000.0) / n).when(k == 3, F.lit(1020.0) / n).when(k == 4, F.lit(1100.0) / n)
    run = F.lit(1000.0)
    way = F.regexp_extract(rules.implied_gradient(run, rise), "(level|rising|falling)$", 1)
    found = {"labels": rules.labels_disagree(after, before), "levels": rules.gradient_against_levels(after, run, rise), "ruling": rules.steeper_than_ruling(after, F.lit(120.0)), "implied": way}
    return table(spark, sf_dir, "lineitem").groupBy(*[F.coalesce(c, F.lit("-")).alias(name) for name, c in found.items()]).agg(F.count("*").alias("stretches"))


@query("""WITH c AS (SELECT p_partkey, p_retailprice AS r, p_size + 20.0 AS l, (p_partkey % 60) * 1.0 AS d FROM part), v AS (SELECT *, l * l / (24 * r) AS s, (r + l * l / (24 * r)) * tan(radians(d / 2)) + l / 2 AS t FROM c WHERE d <> 0),
p AS (SELECT *, CASE WHEN p_partkey % 7 > 0 THEN s + (p_partkey % 3) * 0.001 END AS ps, 1750 / r + (p_partkey % 4) * 0.0007 AS pd, t + (p_partkey % 5 - 2) * 0.011 AS pt FROM v)
SELECT p_partkey, 'CHECK' AS severity, 'shift' AS what, floor(s * 1000 + 0.5) / 1000 AS value FROM p WHERE abs(s - ps) > 0.0015 UNION ALL SELECT p_partkey, 'CHECK', 'degree', floor(1750 / r * 1000 + 0.5) / 1000 FROM p WHERE abs(1750 / r - pd) > 0.0015 UNION ALL SELECT p_partkey, 'INFO', 'tangent', floor(t * 1000 + 0.5) / 1000 FROM p WHERE abs(t - pt) > 0.02""")
def curve_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Printed shift, degree and tangent length against their formulas, each with its tolerance and severity."""
    k = F.col("p_partkey")
    r, l, d = F.col("p_retailprice"), F.col("p_size") + F.lit(20.0), (k % 60) * F.lit(1.0)
    s = l * l / (24 * r)
    printed = (F.when(k % 7 > 0, s + (k % 3) * F.lit(0.001)), 1750 / r + (k % 4) * F.lit(0.0007), (r + s) * F.tan(F.radians(d / 2)) + l / 2 + (k % 5 - 2) * F.lit(0.011))
    found = table(spark, sf_dir, "part").select("p_partkey", F.explode(rules.curve_findings(r, l, d, *printed)).alias("f"))
    return found.select("p_partkey", "f.severity", "f.what", (F.floor(F.col("f.value") * 1000 + 0.5) / 1000).alias("value"))


@query()
def matched_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """True and false positives and misses of each page: boxes of even vectors are references, the others are predictions. A
    page's boxes are what one sheet or reply holds."""
    b = boxes(spark, sf_dir).withColumn("page", F.floor(F.col("page") / 2))
    box = F.struct("vec_id", F.array("x", "y", F.col("x") + 3, F.col("y") + 3).alias("box"))
    side = lambda odd: F.transform(F.array_sort(F.collect_list(F.when(F.col("vec_id") % 2 == odd, box))), lambda s: s["box"])
    match = F.udf(lambda r, p: match_boxes(r, p), "struct<tp int, fp int, fn int>")
    return b.groupBy("page").agg(side(0).alias("refs"), side(1).alias("preds")).select("page", match("refs", "preds").alias("m")).select("page", "m.*")


@query()
def reworded_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three in five user turns in other words, by a draw for each turn; numbers and quotes stay, and what was reworded once is
    marked and left alone."""
    c = table(spark, sf_dir, "conversations").where("role = 'user'").select("conv_id", "turn", "text", F.lit(False).alias("reworded"))

    def again(rows: DataFrame) -> DataFrame:
        chosen = ~F.col("reworded") & (draw("reword", F.col("conv_id"), F.col("turn")) % 100 < 60)
        other = F.when(chosen, reword_udf("text", F.concat_ws("|", F.col("conv_id").cast("string"), F.col("turn").cast("string"))))
        return rows.withColumn("other", other).select("conv_id", "turn", F.coalesce("other", "text").alias("text"), (F.col("reworded") | F.col("other").isNotNull()).alias("reworded"))

    return again(again(c))


_TREE = """'{"sheet": "' || p_brand || '", "marks": [{"tbm_id": "T' || p_size || '", "level": ' || p_size || '.5}, {"tbm_id": "' || (CASE WHEN p_partkey % 3 = 0 THEN 'T' || p_size ELSE 'U' END) || '", "level": null, "at": [1, ' || p_partkey || ']}]' || CASE WHEN p_partkey % 7 = 0 THEN '' ELSE '}' END"""


@query("""WITH p AS (SELECT *, 'T' || p_size AS a, CASE WHEN p_partkey % 3 = 0 THEN '1' ELSE 'U' END AS second FROM part WHERE p_partkey % 7 > 0), n AS (SELECT *, CASE WHEN p_partkey % 3 = 0 THEN '0' ELSE a END AS first FROM p)
SELECT p_partkey, unnest(['sheet', 'marks[' || first || '].tbm_id', 'marks[' || first || '].level', 'marks[' || second || '].tbm_id', 'marks[' || second || '].at[0]', 'marks[' || second || '].at[1]']) AS path, unnest([p_brand, a, p_size || '.5', CASE WHEN p_partkey % 3 = 0 THEN a ELSE 'U' END, '1', p_partkey::VARCHAR]) AS value FROM n""")
def paths_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of nested JSON by their paths, list items by their id where ids tell them apart; broken JSON has no rows."""
    t = texts(spark, sf_dir, "part", "p_partkey", _TREE)
    return t.select("p_partkey", F.explode(flatten_json_by("tbm_id")("text")).alias("path", "value"))
