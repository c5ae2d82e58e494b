"""Scores of answers against references. Here the answer of a conversation is its last assistant turn, the reference its first user turn."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators.positional import close_by
from plumbline.query import query, table

_PAIR = """WITH a AS (SELECT conv_id, arg_max(text, turn) AS pred FROM conversations WHERE role = 'assistant' GROUP BY 1), r AS (SELECT conv_id, arg_min(text, turn) AS ref FROM conversations WHERE role = 'user' GROUP BY 1), p AS (SELECT * FROM a JOIN r USING (conv_id))"""
_W = "list_distinct(list_filter(regexp_extract_all(lower({}), '[a-z]+'), lambda w: length(w) > 1))"


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    a = c.where("role = 'assistant'").groupBy("conv_id").agg(F.max_by("text", "turn").alias("pred"))
    return a.join(c.where("role = 'user'").groupBy("conv_id").agg(F.min_by("text", "turn").alias("ref")), "conv_id")


def words(text: Column) -> Column:
    return F.array_distinct(F.filter(F.regexp_extract_all(F.lower(text), F.lit("[a-z]+"), F.lit(0)), lambda w: F.length(w) > 1))


def recall(pred: Column, ref: Column) -> Column:
    """Share of the reference's distinct values in the answer; null if it has none."""
    return F.size(F.array_intersect(pred, ref)) / F.nullif(F.size(ref), F.lit(0))


@query(_PAIR + f" SELECT conv_id, floor(1000.0 * len(list_intersect({_W.format('pred')}, {_W.format('ref')})) / nullif(len({_W.format('ref')}), 0) + 0.5) / 1000 AS word_recall FROM p")
def word_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs(spark, sf_dir).select("conv_id", (F.floor(1000 * recall(words(F.col("pred")), words(F.col("ref"))) + 0.5) / 1000).alias("word_recall"))


_NUM = "list_distinct(list_transform(regexp_extract_all({}, '-?[0-9]+(?:[.][0-9]+)?'), lambda x: CASE WHEN contains(x, '.') THEN rtrim(rtrim(x, '0'), '.') ELSE x END))"


def numbers(text: Column) -> Column:
    """Distinct numbers as text, trailing zeros only stripped behind a point."""
    found = F.regexp_extract_all(text, F.lit(r"-?[0-9]+(?:\.[0-9]+)?"), F.lit(0))
    return F.array_distinct(F.transform(found, lambda x: F.when(F.contains(x, F.lit(".")), F.regexp_replace(x, r"\.?0+$", "")).otherwise(x)))


@query(f"SELECT event_id, array_to_string({_NUM.format('props')}, ',') AS nums, len(list_intersect({_NUM.format('props')}, {_NUM.format('value::INTEGER::VARCHAR')})) AS shared FROM events")
def value_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    nums = numbers(F.col("props"))
    rounded = F.rint("value").cast("int").cast("string")
    return e.select("event_id", F.array_join(nums, ",").alias("nums"), F.size(F.array_intersect(nums, numbers(rounded))).cast("long").alias("shared"))


@query(_PAIR + """ SELECT conv_id, array_to_string(list_filter([CASE WHEN NOT contains(lower(pred), 'th') THEN 'contains' END, CASE WHEN NOT (contains(pred, 'eau') OR contains(pred, 'er')) THEN 'any_of' END, CASE WHEN regexp_matches(pred, '[0-9]{5,}') THEN 'no_values' END, CASE WHEN NOT contains(pred, '?') AND length(ref) < 60 THEN 'ask_back' END], lambda x: x IS NOT NULL), ',') AS reasons FROM p""")
def item_score_with_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An item passes when no expectation fails; each failure is a reason."""
    pred = F.col("pred")
    checks = F.array(F.when(~F.contains(F.lower(pred), F.lit("th")), "contains"), F.when(~(F.contains(pred, F.lit("eau")) | F.contains(pred, F.lit("er"))), "any_of"), F.when(pred.rlike("[0-9]{5,}"), "no_values"), F.when(~F.contains(pred, F.lit("?")) & (F.length("ref") < 60), "ask_back"))
    return pairs(spark, sf_dir).select("conv_id", F.array_join(F.filter(checks, lambda x: x.isNotNull()), ",").alias("reasons"))


def iou(a: list[Column], b: list[Column]) -> Column:
    """Intersection over union of boxes (x0, y0, x1, y1); 0 where they do not meet."""
    zero = F.lit(0.0)
    w, h = F.greatest(F.least(a[2], b[2]) - F.greatest(a[0], b[0]), zero), F.greatest(F.least(a[3], b[3]) - F.greatest(a[1], b[1]), zero)
    area = lambda x: (x[2] - x[0]) * (x[3] - x[1])
    return F.when(w * h > 0, w * h / (area(a) + area(b) - w * h)).otherwise(zero)


_BOX = "SELECT vec_id, vec_id % 100 AS page, embedding[1]::DOUBLE * 10 AS x, embedding[2]::DOUBLE * 10 AS y FROM embeddings"


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", (F.col("vec_id") % 100).alias("page"), (F.col("embedding")[0].cast("double") * 10).alias("x"), (F.col("embedding")[1].cast("double") * 10).alias("y"))


@query(f"""WITH b AS ({_BOX}), j AS (SELECT r.vec_id AS ref, greatest(least(r.x, p.x) + 3 - greatest(r.x, p.x), 0) AS w, greatest(least(r.y, p.y) + 3 - greatest(r.y, p.y), 0) AS h FROM b r JOIN b p ON r.page = p.page AND r.vec_id <> p.vec_id)
SELECT ref, floor(max(CASE WHEN w * h > 0 THEN w * h / (18 - w * h) ELSE 0 END) * 1000 + 0.5) / 1000 AS best FROM j GROUP BY 1""")
def best_box_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = boxes(spark, sf_dir)
    refs = b.select("page", F.col("vec_id").alias("ref"), "x", "y")
    others = b.select("page", F.col("vec_id").alias("other"), F.col("x").alias("x2"), F.col("y").alias("y2"))
    w, h = F.least("x", "x2") + 3 - F.greatest("x", "x2"), F.least("y", "y2") + 3 - F.greatest("y", "y2")
    met = close_by(refs, others, ["page"], [("x", "x2", 3.0), ("y", "y2", 3.0)]).where("ref <> other").groupBy("ref").agg(F.max(F.when((w > 0) & (h > 0), w * h / (18 - w * h))).alias("best"))
    # a box alone on its page has no other to be compared with
    shared = b.groupBy("page").count().where("count > 1").select("page")
    return refs.join(shared, "page").join(met, "ref", "left").select("ref", (F.floor(F.coalesce("best", F.lit(0.0)) * 1000 + 0.5) / 1000).alias("best"))


@query(_PAIR + """ SELECT conv_id, regexp_extract(pred, '(?s)^([^.]*[.])', 1) AS head, regexp_matches(pred, '^[A-Z]') AS capital, CASE WHEN length(pred) > length(ref) THEN 'longer' WHEN length(pred) < length(ref) THEN 'shorter' ELSE 'equal' END AS verdict FROM p""")
def split_and_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, m = F.length("pred"), F.length("ref")
    return pairs(spark, sf_dir).select("conv_id", F.regexp_extract("pred", r"(?s)^([^.]*[.])", 1).alias("head"), F.col("pred").rlike("^[A-Z]").alias("capital"), F.when(n > m, "longer").when(n < m, "shorter").otherwise("equal").alias("verdict"))


@query("""SELECT lang, count(*) AS n, count(*) FILTER (WHERE toxic = 1) AS positive, floor(avg(quality) * 1000 + 0.5) / 1000 AS quality FROM documents JOIN labels USING (doc_id) GROUP BY 1""")
def summary_by_task(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = table(spark, sf_dir, "documents").select("doc_id", "lang").join(table(spark, sf_dir, "labels"), "doc_id")
    return j.groupBy("lang").agg(F.count("*").alias("n"), F.count_if(F.col("toxic") == 1).alias("positive"), (F.floor(F.avg("quality") * 1000 + 0.5) / 1000).alias("quality"))
