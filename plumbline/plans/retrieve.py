"""Text ranking: IDF scores, substring search, routing by priority."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.operators.ranking import score_facts
from plumbline.query import query, table

# Words that carry no meaning in a question.
STOP = ["the", "of", "and", "a", "to", "in", "is", "it", "for", "on", "was", "with", "as", "that", "by", "at", "an"]
_STOP = ", ".join(f"'{w}'" for w in STOP)


def tokens(text: Column) -> Column:
    """Distinct lower-case runs of a-z or digits without stop words."""
    found = F.regexp_extract_all(F.lower(text), F.lit("[a-z]+|[0-9]+"), F.lit(0))
    return F.array_distinct(F.filter(found, lambda w: ~w.isin(*STOP)))


_TOK = f"list_filter(list_distinct(regexp_extract_all(lower(text), '[a-z]+|[0-9]+')), lambda w: w NOT IN ({_STOP}))"


# Words that a question's word also stands for.
SYNONYMS = {"her": ["hers"], "than": ["then"], "thin": ["thinly"], "there": ["therein"]}
_NUM = "list_distinct(regexp_extract_all(text, '[0-9]+(?:[.][0-9]+)?'))"
_SYN = "CASE w " + " ".join(f"WHEN '{w}' THEN {others}" for w, others in SYNONYMS.items()) + " ELSE CAST([] AS VARCHAR[]) END"


def expanded(found: Column) -> Column:
    """The tokens and what they also stand for."""
    names = F.create_map(*[x for w, others in SYNONYMS.items() for x in (F.lit(w), F.array(*map(F.lit, others)))])
    return F.array_distinct(F.concat(found, F.flatten(F.transform(found, lambda w: F.coalesce(F.try_element_at(names, w), F.array().cast("array<string>"))))))


def printed_numbers(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(text, F.lit("[0-9]+(?:[.][0-9]+)?"), F.lit(0)))


# documents stand for facts (a title is a text's first two tokens by name), the benchmark's items for questions
_IDF = f"""WITH f0 AS (SELECT doc_id AS fid, lang, {_TOK} AS toks, {_NUM} AS nums FROM documents),
q1 AS (SELECT item_id AS qid, {_TOK} AS t, {_NUM} AS nums FROM benchmark), q0 AS (SELECT qid, nums, list_distinct(list_concat(t, flatten(list_transform(t, lambda w: {_SYN})))) AS toks FROM q1),
f AS (SELECT fid, unnest(toks) AS token FROM f0), q AS (SELECT qid, unnest(toks) AS token FROM q0), n AS (SELECT count(*) AS n FROM documents), d AS (SELECT token, count(*) AS df FROM f GROUP BY 1),
w AS (SELECT qid, fid, sum(ln(1 + n / df)) AS w FROM f JOIN q USING (token) JOIN d USING (token), n GROUP BY 1, 2),
x AS (SELECT qid, fid, count(*) AS k FROM (SELECT fid, unnest(nums) AS v FROM f0) JOIN (SELECT qid, unnest(nums) AS v FROM q0) USING (v) GROUP BY 1, 2),
u AS (SELECT coalesce(w.qid, x.qid) AS qid, coalesce(w.fid, x.fid) AS fid, coalesce(w, 0) AS w, coalesce(k, 0) AS k FROM w FULL JOIN x ON w.qid = x.qid AND w.fid = x.fid),
s AS (SELECT qid, fid, w + CASE WHEN k > 0 THEN 6 ELSE 0 END - CASE WHEN lang = 'en' THEN 0.5 ELSE 0 END AS score FROM u JOIN f0 USING (fid))"""


def _facts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    text = F.col("text")
    facts = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("fid"), F.when(F.col("lang") == "en", "text").otherwise("item").alias("grp"), tokens(text).alias("tokens"), printed_numbers(text).alias("numbers"))
    questions = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), expanded(tokens(text)).alias("tokens"), printed_numbers(text).alias("numbers"))
    return facts.withColumn("title", F.slice(F.array_sort("tokens"), 1, 2)), questions


@query(_IDF + " SELECT qid, fid, floor(score * 1000 + 0.5) / 1000 AS score FROM s")
def idf_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_facts(*_facts(spark, sf_dir)).select("qid", "fid", (F.floor(F.col("score") * 1000 + 0.5) / 1000).alias("score"))


@query(_IDF + """, t AS (SELECT qid, fid FROM f0, q0 WHERE len(f0.toks) > 0 AND list_has_all(q0.toks, list_sort(f0.toks)[1:2]))
SELECT u.qid, u.fid, floor((w + 6 * k + CASE WHEN t.fid IS NULL THEN 0 ELSE 8 END) * 1000 + 0.5) / 1000 AS score FROM u LEFT JOIN t ON u.qid = t.qid AND u.fid = t.fid""")
def idf_score_with_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = score_facts(*_facts(spark, sf_dir), each_number=True, titles=True, weak=None)
    return found.select("qid", "fid", (F.floor(F.col("score") * 1000 + 0.5) / 1000).alias("score"))


@query(_IDF + " SELECT qid, fid, total FROM (SELECT qid, fid, count(*) OVER (PARTITION BY qid) AS total, row_number() OVER (PARTITION BY qid ORDER BY floor(score * 1000 + 0.5) DESC, fid) AS rn FROM s) WHERE rn <= 8")
def top_facts_with_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = score_facts(*_facts(spark, sf_dir)).select("qid", "fid", F.floor(F.col("score") * 1000 + 0.5).alias("score"))
    w = Window.partitionBy("qid").orderBy(F.desc("score"), "fid")
    best = s.withColumn("rn", F.row_number().over(w)).where("rn <= 8")
    return best.join(s.groupBy("qid").agg(F.count("*").alias("total")), "qid").select("qid", "fid", "total")


@query("SELECT doc_id, ((length(lower(text)) - length(replace(lower(text), 'thing', ''))) // 5 + (length(lower(text)) - length(replace(lower(text), 'er', ''))) // 2)::BIGINT AS hits FROM documents")
def substring_occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.lower("text")
    count = lambda word: F.floor((F.length(t) - F.length(F.replace(t, F.lit(word), F.lit("")))) / len(word))
    return table(spark, sf_dir, "documents").select("doc_id", (count("thing") + count("er")).cast("long").alias("hits"))


@query("SELECT token, count(*) AS df FROM (SELECT unnest(list_distinct(regexp_extract_all(lower(text), '[a-z]+|[0-9]+'))) AS token FROM documents) GROUP BY 1")
def document_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+|[0-9]+"), F.lit(0)))
    return table(spark, sf_dir, "documents").select(F.explode(found).alias("token")).groupBy("token").agg(F.count("*").alias("df"))


@query("""SELECT doc_id, CASE WHEN regexp_matches(text, 'Licen[sc]e') THEN 'licence' WHEN regexp_matches(text, '[0-9]+[.][0-9]+[.][0-9]+[.][0-9]+') THEN 'address' WHEN regexp_matches(text, '@[a-z]') THEN 'mail' WHEN regexp_matches(text, '[0-9]{4,}') THEN 'number' ELSE 'text' END AS intent FROM documents""")
def route_by_ordered_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    intent = F.when(t.rlike("Licen[sc]e"), "licence").when(t.rlike("[0-9]+[.][0-9]+[.][0-9]+[.][0-9]+"), "address").when(t.rlike("@[a-z]"), "mail").when(t.rlike("[0-9]{4,}"), "number").otherwise("text")
    return table(spark, sf_dir, "documents").select("doc_id", intent.alias("intent"))


@query("""SELECT doc_id, i AS chunk, md5(substr(text, 1 + 800 * i, 900)) AS h FROM (SELECT doc_id, text, unnest(range(0, (length(text) - 1) // 800 + 1))::INTEGER AS i FROM documents WHERE length(text) > 0)""")
def overlapping_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of 900 characters every 800."""
    starts = F.sequence(F.lit(0), F.floor((F.length("text") - 1) / 800).cast("int"))
    return table(spark, sf_dir, "documents").where("length(text) > 0").select("doc_id", "text", F.explode(starts).alias("chunk")).select("doc_id", "chunk", F.md5(F.substr("text", F.col("chunk") * 800 + 1, F.lit(900))).alias("h"))


# search terms printed from the parts: names, some with numbers, words or a piece of a listed name with them
_TERM = "CASE p_size % 8 WHEN 0 THEN '' WHEN 1 THEN p_name || ' ' || p_size || '+5' WHEN 2 THEN p_name || ' of the best kind' WHEN 3 THEN 'ozambiqu' WHEN 4 THEN 'from france' WHEN 5 THEN p_name || ' 1.5' WHEN 6 THEN p_name || ' ' || p_type || ' ' || p_brand || ' all' ELSE p_name END"


@query(f"""WITH t AS (SELECT p_partkey, lower({_TERM}) AS term FROM part), l AS (SELECT lower(n_name) AS name FROM nation)
SELECT p_partkey, CASE WHEN term = '' THEN 'empty' WHEN length(term) > 30 THEN 'long' WHEN len(string_split(term, ' ')) > 4 THEN 'words' WHEN regexp_matches(term, '[0-9]{{3,}}|[0-9][.][0-9]|[0-9][+][0-9]') THEN 'number'
WHEN EXISTS (SELECT 1 FROM l WHERE term = name OR (length(name) >= 4 AND contains(term, name)) OR (length(term) >= 4 AND contains(name, term) AND length(term) > 0.6 * length(name))) THEN 'listed' ELSE 'pass' END AS gate FROM t""")
def leak_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "part").select("p_partkey", F.lower(F.expr(_TERM)).alias("term"))
    return gated(t, table(spark, sf_dir, "nation").select(F.lower("n_name").alias("name"))).select("p_partkey", "gate")


def _pieces(text: Column, least: Column) -> Column:
    """All substrings with ``least`` characters or more."""
    n = F.length(text)
    grid = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda k: F.when(k <= n - i + 1, F.substr(text, i, k))))
    return F.array_distinct(F.filter(F.flatten(grid), lambda x: x.isNotNull() & (F.length(x) >= least)))


def gated(terms: DataFrame, listed: DataFrame) -> DataFrame:
    """``terms`` (term and more) with ``gate``: whether a search term may leave. Empty, long (30 characters, 4 words) and
    numeric ones may not, nor those that equal a listed name, hold one of 4 characters or more, or are, with 4 or more,
    most (60 %) of one. Terms meet the list by equal substrings, so neither side is broadcast or compared pair by pair.
    """
    t = F.col("term")
    form = F.when(t == "", "empty").when(F.length(t) > 30, "long").when(F.size(F.split(t, " ")) > 4, "words").when(t.rlike("[0-9]{3,}|[0-9][.][0-9]|[0-9][+][0-9]"), "number")
    open_ = terms.where(form.isNull()).select("term").distinct()
    holds = open_.select("term", F.explode(_pieces(t, F.lit(4))).alias("name")).join(listed, "name").select("term")
    inside = listed.select("name", F.explode(_pieces(F.col("name"), F.lit(4))).alias("term")).where(F.length("term") > 0.6 * F.length("name")).join(open_, "term").select("term")
    same = open_.join(listed.select(F.col("name").alias("term")), "term").select("term")
    held = holds.union(inside).union(same).distinct().withColumn("listed", F.lit(True))
    return terms.join(held, "term", "left").withColumn("gate", F.coalesce(form, F.when(F.col("listed"), "listed"), F.lit("pass"))).drop("listed")
