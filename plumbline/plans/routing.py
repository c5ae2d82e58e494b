"""Questions routed to pages: the book is printed from suppliers and lines of orders, the questions from the orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators.routing import Book, pages_for, sheet_for
from plumbline.query import query, table

#: Text of the question of an order, for both engines.
_ASKED = """CASE o_orderkey % 12 WHEN 0 THEN 'What is the span of bridge ' || (o_custkey % 140) || '?' WHEN 1 THEN 'levels of BR. NO. ' || (o_custkey % 140) || 'UP, Bridge ' || (o_custkey % 90) || 'up and br ' || (o_custkey % 140)
 WHEN 2 THEN 'Show all bridges of the line' WHEN 3 THEN 'radius of curve no. ' || (o_custkey % 130) WHEN 4 THEN 'C-' || (o_custkey % 130) || ' versine at 12' WHEN 5 THEN 'Which gradient at ' || CAST(FLOOR(o_totalprice / 6) AS BIGINT) || '.3 ?'
 WHEN 6 THEN 'formation level at CH ' || CAST(FLOOR(o_totalprice / 4000) AS BIGINT) || '+' || (o_custkey % 1000) WHEN 7 THEN 'level at ' || CAST(FLOOR(o_totalprice / 5000) AS BIGINT) * 1000 || ' or at 5 or sheet 99' WHEN 8 THEN 'ground at ' || CAST(FLOOR(o_totalprice / 4) AS BIGINT) || '.2'
 WHEN 9 THEN 'Supplier number ' || o_orderstatus || ' ' || lower(o_orderpriority) WHEN 10 THEN 'small ring ' || o_orderpriority || ' widget' ELSE NULL END"""
_BOOK = """bridges AS (SELECT DISTINCT l_suppkey AS page, (l_partkey % 97) || CASE l_partkey % 5 WHEN 0 THEN 'UP' WHEN 1 THEN 'Dn' ELSE '' END AS num FROM lineitem WHERE l_quantity < 3),
curves AS (SELECT DISTINCT l_suppkey AS page, (l_partkey % 89)::VARCHAR AS num FROM lineitem WHERE l_quantity = 4), bands AS (SELECT s_suppkey AS page, s_suppkey * 1000.0 AS low, s_suppkey * 1000.0 + 400 + s_nationkey * 50 AS high FROM supplier),
labels AS (SELECT l_suppkey AS page, l_suppkey * 1000.0 + l_partkey % 1500 + 0.5 AS pos FROM lineitem WHERE l_quantity = 5), texts AS (SELECT l_suppkey AS page, string_agg(DISTINCT p_name || ' ' || p_brand || ' ' || p_type, ' ') AS text FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_quantity = 6 GROUP BY 1)"""
_READ = r"""asked AS (SELECT o_orderkey AS qid, coalesce(ASKED, '') AS text FROM orders),
q AS (SELECT qid, text, list_distinct(list_transform(regexp_extract_all(text, '(?i)\bbr(?:idge)?\.?\s*(?:no\.?\s*)?([0-9]+[a-z]{0,3})\b', 1), lambda x: upper(x))) AS bridges,
 upper(regexp_extract_all(text, '(?i)\b(?:curve\s*(?:no\.?)?|c\.?\s*no\.?|c)\s*[-.:]?\s*([0-9]+[a-z]*)\b', 1)[1]) AS curve,
 list_filter(list_transform(regexp_extract_all(regexp_replace(text, '(?i)\b(?:br|bridge|no|c|lc|rob|rub|tbm|bm|curve|sl|sheet|line|main|span)\b\.?\s*(?:no\b\.?)?\s*[:.-]?\s*[0-9]+[a-z]*', ' ', 'g'), '[0-9]+\+[0-9]+(?:\.[0-9]+)?|[0-9]+(?:\.[0-9]+)?'),
  lambda x: CASE WHEN contains(x, '+') THEN split_part(x, '+', 1)::DOUBLE * 1000 + split_part(x, '+', 2)::DOUBLE ELSE x::DOUBLE END), lambda x: x >= 10)[1:3] AS places,
 regexp_matches(text, '(?i)\b(list|all|how many|which|show|every|count)\b') AND regexp_matches(text, '(?i)\bbr(?:idge)?s?\b') AS lists, regexp_matches(text, '(?i)\b(gradient|grade|slope|rise|fall|falling|rising|gp|vpi)\b') AS grades,
 PARTS FROM asked)""".replace("ASKED", _ASKED)
_PARTS = "list_distinct(list_transform(regexp_extract_all(text, '[0-9]+(?:[.][0-9]+)?'), lambda x: x::DOUBLE)) AS numbers, list_distinct(regexp_extract_all(upper(text), '[A-Z]+-?[0-9]+')) AS codes, list_distinct(regexp_extract_all(lower(text), '[a-z]{3,}')) AS words"
_FITS = f"""d AS (SELECT page, {_PARTS} FROM texts), fits AS (SELECT qid, page, sum(score)::BIGINT AS score FROM (
 SELECT qid, page, count(DISTINCT v) * 10 AS score FROM (SELECT qid, unnest(numbers) AS v FROM q) JOIN (SELECT page, unnest(numbers) AS x FROM d) ON v >= 10 AND x >= 10 AND abs(v - x) <= 0.6 + 1e-9 GROUP BY 1, 2
 UNION ALL SELECT qid, page, count(*) * 10 FROM (SELECT qid, unnest(codes) AS v FROM q) JOIN (SELECT page, unnest(codes) AS v FROM d) USING (v) GROUP BY 1, 2
 UNION ALL SELECT qid, page, count(*) FROM (SELECT qid, unnest(words) AS v FROM q) JOIN (SELECT page, unnest(words) AS v FROM d) USING (v) GROUP BY 1, 2) GROUP BY 1, 2),
best AS (SELECT qid, page, row_number() OVER (PARTITION BY qid ORDER BY page) AS rn FROM (SELECT *, max(score) OVER (PARTITION BY qid) AS top FROM fits) WHERE score = top),
at_ AS (SELECT qid, grades, unnest(places) AS place, generate_subscripts(places, 1) AS k FROM q), near AS (SELECT DISTINCT qid, page, grades FROM at_ JOIN labels ON abs(place - pos) < 0.6),
held AS (SELECT qid, page, place, k, place > low AND place < high AS inner_ FROM at_ JOIN bands ON place BETWEEN low AND high)"""
_WITH = "WITH " + _BOOK + ", " + _READ.replace("PARTS", _PARTS) + ", " + _FITS


def _book(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Book]:
    l, s, p = (table(spark, sf_dir, t) for t in ("lineitem", "supplier", "part"))
    page, part = F.col("l_suppkey").alias("page"), F.col("l_partkey")
    suffix = F.when(part % 5 == 0, "UP").when(part % 5 == 1, "Dn").otherwise("")
    bridges = l.where("l_quantity < 3").select(page, F.concat((part % 97).cast("string"), suffix).alias("num")).distinct()
    curves = l.where("l_quantity = 4").select(page, (part % 89).cast("string").alias("num")).distinct()
    low = F.col("s_suppkey") * F.lit(1000.0)
    bands = s.select(F.col("s_suppkey").alias("page"), low.alias("low"), (low + 400 + F.col("s_nationkey") * 50).alias("high"))
    labels = l.where("l_quantity = 5").select(page, (F.col("l_suppkey") * F.lit(1000.0) + part % 1500 + 0.5).alias("pos"))
    texts = l.where("l_quantity = 6").join(p, part == F.col("p_partkey")).groupBy(page).agg(F.array_join(F.array_sort(F.collect_set(F.concat_ws(" ", "p_name", "p_brand", "p_type"))), " ").alias("text"))
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("qid"), F.expr(_ASKED).alias("text")), Book(bridges, curves, bands, labels, texts)


@query(_WITH + """, r AS (SELECT qid, CASE WHEN len(bridges) > 0 THEN 'bridge' WHEN lists THEN 'list' WHEN curve IS NOT NULL THEN 'curve' WHEN grades AND EXISTS (SELECT 1 FROM near n WHERE n.qid = q.qid) THEN 'label'
 WHEN EXISTS (SELECT 1 FROM held h WHERE h.qid = q.qid AND inner_) THEN 'inside' WHEN EXISTS (SELECT 1 FROM held h WHERE h.qid = q.qid) THEN 'covers' WHEN EXISTS (SELECT 1 FROM near n WHERE n.qid = q.qid) THEN 'label' WHEN len(places) > 0 THEN 'outside'
 WHEN EXISTS (SELECT 1 FROM best b WHERE b.qid = q.qid) THEN 'text' END AS stage FROM q),
f AS (SELECT qid, page, 'bridge' AS stage FROM (SELECT qid, unnest(bridges) AS num FROM q) a JOIN bridges b ON upper(b.num) = a.num UNION SELECT qid, page, 'curve' FROM q JOIN curves c ON upper(c.num) = q.curve UNION SELECT qid, page, 'label' FROM near UNION SELECT qid, page, 'inside' FROM held WHERE inner_
 UNION SELECT qid, page, 'covers' FROM held UNION SELECT qid, page, 'text' FROM best WHERE rn <= 3)
SELECT r.qid, f.page, r.stage FROM r LEFT JOIN f ON f.qid = r.qid AND f.stage = r.stage""")
def pages_for_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each question's pages, by the first of nine stages that answers or claims it."""
    return pages_for(*_book(spark, sf_dir))


@query(_WITH + r""", b AS (SELECT qid, min(page) AS page FROM (SELECT qid, unnest(list_transform(bridges, lambda x: regexp_replace(x, '(UP|DN)$', ''))) AS num FROM q) a JOIN bridges b ON regexp_replace(upper(b.num), '(UP|DN)$', '') = a.num GROUP BY 1),
c AS (SELECT qid, min(page) AS page FROM q JOIN curves c ON upper(c.num) = q.curve GROUP BY 1), p AS (SELECT qid, arg_min(page, (k, page)) AS page FROM held GROUP BY 1)
SELECT q.qid, coalesce(b.page, c.page, p.page, t.page) AS page, CASE WHEN b.page IS NOT NULL THEN 'bridge' WHEN c.page IS NOT NULL THEN 'curve' WHEN p.page IS NOT NULL THEN 'place' WHEN t.page IS NOT NULL THEN 'text' END AS stage
FROM q LEFT JOIN b USING (qid) LEFT JOIN c USING (qid) LEFT JOIN p USING (qid) LEFT JOIN (SELECT * FROM best WHERE rn = 1) t USING (qid)""")
def sheet_for_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one sheet that a question is about; a stage that finds nothing leaves it to the next."""
    return sheet_for(*_book(spark, sf_dir))
