"""Mixing sources to target weights by Pareto order sampling.

A source's target is its share of the mix, capped at a multiple of its size; the excess goes to the others by weight
(water filling, by running sums over the sources in the order in which they fill up). Inside a source a document's
expected copies are ``min(most, kappa * w)`` with w the square root of its words, and kappa such that the expected words
are the target: long documents are likelier than short ones, but less than in proportion. The whole part of the copies is
certain, the rest an inclusion probability p, which differs from document to document. Pareto sampling ranks documents by
``(u / (1 - u)) / (p / (1 - p))``, u a hash of the document, and takes the first of that order until the sample has its
size, here counted in words.

No source is ever gathered: words are summed by (source, size of the document) for kappa and by (source, slice of the
rank) for the end of the sample, and only the documents of one slice of a slice are ranked exactly. Small tables (one row
a source) are joined without a hint, so they are broadcast only where Spark finds them small.

Defined results: a null text has size 0 and is taken 0 words; null sources form one source, last in the order; a source
without words has target 0; rows repeated in full have the same rank and are taken or left together; an empty table gives
an empty result. Extra columns do not take part and are kept by ``mix``, also when their names clash with those here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.llm.common import scratch, table, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
SLICES = 1024
SEED = 20240
_BEFORE = (Window.unboundedPreceding, -1)
_UPTO = (Window.unboundedPreceding, Window.currentRow)
_FROM = (Window.currentRow, Window.unboundedFollowing)


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; 0 for null."""
    return F.coalesce(F.size(F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source_key, source_size, target) of ``sizes`` (source_key, source_size): one row a source comes together in a task.

    Sources by code point, null (key "n") last, get the weights in turn. Those with the least words for their weight fill up
    first; the first that does not sets the level for it and all behind it.
    """
    order = Window.orderBy(F.col("source_key") == "n", "source_key")
    turn = F.array(*[F.lit(int(w)) for w in weights])
    named = sizes.withColumn("weight", F.element_at(turn, ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")))
    filling = Window.partitionBy("words").orderBy(F.lit(most) * F.col("source_size") / F.col("weight"), "source_key")
    total = F.lit(share) * F.sum("source_size").over(Window.partitionBy(F.lit(1)))
    left = F.col("total") - F.lit(most) * F.coalesce(F.sum("source_size").over(filling.rowsBetween(*_BEFORE)), F.lit(0))
    ranked = named.withColumn("words", F.col("source_size") > 0).withColumn("total", total)
    ranked = ranked.withColumns({"left": left, "others": F.sum("weight").over(filling.rowsBetween(*_FROM)), "place": F.row_number().over(filling)})
    full = F.col("left") * F.col("weight") / F.col("others") > F.lit(most) * F.col("source_size")
    level = F.min(F.when(~full, F.struct("place", "left", "others"))).over(Window.partitionBy("words"))
    target = F.when(~F.col("words"), 0.0).when(F.col("level").isNull() | (F.col("place") < F.col("level.place")), F.lit(most) * F.col("source_size")).otherwise(F.col("level.left") * F.col("weight") / F.col("level.others"))
    return ranked.withColumn("level", level).select("source_key", "source_size", target.cast("double").alias("target"))


def pull(size: Column) -> Column:
    """What a document's expected copies are in proportion to: 1024 times the root of its words, in whole numbers."""
    return F.floor(F.lit(1024) * F.sqrt(size.cast("double"))).cast("long")


def rates(slim: DataFrame, plan: DataFrame, most: float = MOST) -> DataFrame:
    """(source_key, kappa): sums of words by document size come together for a source, as many as it has sizes."""
    counts = slim.where("size > 0").groupBy("source_key", "size").count().join(plan, "source_key")
    by = Window.partitionBy("source_key").orderBy(F.desc("size"))
    words = (F.col("size") * F.col("count")).cast("decimal(38,0)")
    # the documents longer than this one have ``most`` copies each, the rest share what is left
    longer = F.coalesce(F.sum(words).over(by.rowsBetween(*_BEFORE)), F.lit(0)).cast("double")
    rest = F.sum(words * F.col("pull")).over(by.rowsBetween(*_FROM)).cast("double")
    tried = counts.withColumn("pull", pull(F.col("size"))).withColumn("kappa", (F.col("target") - F.lit(most) * longer) / rest)
    fits = tried.where(F.col("kappa") * F.col("pull") <= F.lit(most + 1e-9))
    return fits.groupBy("source_key").agg(F.max_by("kappa", "size").alias("kappa"))


def _ranked(rows: DataFrame, most: float) -> DataFrame:
    """Adds whole, the certain copies, p, the inclusion probability beyond them, and ``at``: the Pareto rank
    u/(1-u) / (p/(1-p)) mapped to [0, 1). The map is monotone, so slices of ``at`` are slices of the Pareto order.
    """
    copies = F.coalesce(F.round(F.least(F.lit(most), F.col("kappa") * pull(F.col("size"))), 9), F.lit(0.0))
    q = (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p")))
    rows = rows.withColumn("m", copies).withColumn("whole", F.floor("m")).withColumn("p", F.col("m") - F.col("whole"))
    return rows.withColumn("at", F.when(F.col("p") > 0, q / (1 + q))).withColumn("s1", F.floor(F.col("at") * SLICES)).withColumn("s2", F.floor(F.col("at") * SLICES * SLICES))


def _cut(rows: DataFrame, need: DataFrame, column: str) -> DataFrame:
    """For each source the slice in which the running sum of sizes reaches ``need``, and what is left to take in it.

    At most SLICES sums of a source come together in one task."""
    sums = rows.groupBy("source_key", F.col(column).alias("slice")).agg(F.sum("size").alias("n"))
    by = Window.partitionBy("source_key").orderBy("slice").rowsBetween(*_UPTO)
    summed = sums.withColumn("upto", F.sum("n").over(by)).join(need, "source_key")
    return summed.where(F.col("upto") - F.col("n") <= F.col("need")).groupBy("source_key").agg(F.max_by(F.struct("slice", (F.col("need") - (F.col("upto") - F.col("n"))).alias("left")), "slice").alias("m")).select("source_key", "m.slice", F.col("m.left").alias("need"))


def pareto_marks(rows: DataFrame) -> DataFrame:
    """(source_key, c2, end_at): where the sample of each source ends. ``rows``: source_key, size, p, at, s1, s2.

    The sample's words come nearest to ``sum(p * size)`` of the source: it ends before or after the document that passes
    that mark. Two levels of slices leave about one document in a million to be ranked exactly.
    """
    need = written(rows.groupBy("source_key").agg(F.sum(F.col("p") * F.col("size")).alias("need")), "mixing-need")
    cut1 = written(_cut(rows, need, "s1"), "mixing-cut")
    inner = rows.join(cut1.select("source_key", F.col("slice").alias("s1")), ["source_key", "s1"])
    cut2 = written(_cut(inner, cut1.select("source_key", "need"), "s2"), "mixing-cut")
    last = rows.join(cut2.select("source_key", F.col("slice").alias("s2"), "need"), ["source_key", "s2"])
    # documents of equal rank, rows repeated in full, are one step
    steps = last.groupBy("source_key", "need", "at").agg(F.sum("size").alias("n"))
    steps = steps.withColumn("upto", F.sum("n").over(Window.partitionBy("source_key").orderBy("at").rowsBetween(*_UPTO)))
    ends = steps.where(F.col("upto") - F.col("need") < F.col("need") - (F.col("upto") - F.col("n"))).groupBy("source_key").agg(F.max("at").alias("end_at"))
    return cut2.select("source_key", F.col("slice").alias("c2")).join(ends, "source_key", "left")


def _slim(documents: DataFrame, seed: int) -> tuple[Column, Column, Column]:
    """Key of the source, size in words, and the draw u in (0, 1) of a document."""
    text, doc_id = F.col("text").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("?"))
    draw = F.sha2(F.concat_ws("|", F.lit(str(seed)), doc_id, F.coalesce(F.sha2(text, 256), F.lit("?"))), 256)
    u = (F.conv(F.substring(draw, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    key = F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("source").cast("string")))
    return key.alias("source_key"), word_count(text).alias("size"), u.alias("u")


def plan_of(slim: DataFrame, weights: tuple[int, ...], share: float, most: float) -> tuple[DataFrame, DataFrame]:
    """One row a source: (source_key, source_size, target, kappa), and the marks of its sample."""
    sizes = slim.groupBy("source_key").agg(F.sum("size").alias("source_size"))
    plan = written(targets(sizes, weights, share, most), "mixing-targets")
    plan = written(plan.join(rates(slim, plan.select("source_key", "target"), most), "source_key", "left"), "mixing-plan", keep=True)
    # only what the sample's ends are found from
    ranked = _ranked(slim.join(plan.select("source_key", "kappa"), "source_key"), most).where("p > 0").select("source_key", "size", "p", "at", "s1", "s2")
    return plan, written(pareto_marks(ranked), "mixing-marks", keep=True)


def copied(rows: DataFrame, plan: DataFrame, marks: DataFrame, most: float) -> DataFrame:
    """``rows`` (source_key, size, u and more) with source_size, target and ``copies``: the certain ones, and one more if
    the row is in the sample that ``marks`` delimits."""
    out = _ranked(rows.join(plan, "source_key"), most).join(marks, "source_key", "left")
    chosen = (F.col("p") > 0) & ((F.col("s2") < F.col("c2")) | ((F.col("s2") == F.col("c2")) & (F.col("at") <= F.coalesce(F.col("end_at"), F.lit(-1.0)))))
    return out.withColumn("copies", (F.col("whole") + F.when(F.coalesce(chosen, F.lit(False)), 1).otherwise(0)).cast("long"))


def mix(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = SEED) -> DataFrame:
    """All rows and columns of ``documents``, with mix_size, mix_source_size, mix_target, mix_copies and mix_taken, which
    replace columns of these names."""
    # the row is packed, so that its own names clash with none here
    whole = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"), *_slim(documents, seed))
    with scratch(documents.sparkSession):
        plan, marks = plan_of(written(whole.select("source_key", "size", "u"), "mixing"), weights, share, most)
    taken = copied(whole, plan, marks, most)
    new = {"mix_size": F.col("size"), "mix_source_size": F.col("source_size"), "mix_target": F.col("target"), "mix_copies": F.col("copies"), "mix_taken": F.col("copies") * F.col("size")}
    own = [F.col(f"row.`{c}`") for c in documents.columns if c.lower() not in new]
    return taken.select(*own, *[c.alias(name) for name, c in new.items()])


def mixed_sizes(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken: what ``mix`` decides, in one pass over the texts."""
    slim = written(documents.select("doc_id", *_slim(documents, seed)), "mixing")
    with scratch(documents.sparkSession):
        plan, marks = plan_of(slim, weights, share, most)
    return copied(slim, plan, marks, most).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op8_pareto_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed_sizes(table(spark, sf_dir, "documents"))


SQL = rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         (('0x' || substr(sha256(concat_ws('|', '{SEED}', coalesce(CAST(doc_id AS VARCHAR), '?'), coalesce(sha256(text), '?'))), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS n FROM d GROUP BY source
), w AS (
  SELECT source, n, CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, 1.5::DOUBLE * sum(n) OVER () AS total
  FROM s
), f AS (
  SELECT *, total - 2.0::DOUBLE * coalesce(sum(n) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_,
         sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS others, row_number() OVER o AS place
  FROM w WHERE n > 0 WINDOW o AS (ORDER BY 2.0::DOUBLE * n / weight, source IS NULL, source)
), l AS (
  SELECT place AS level_place, left_ AS level_left, others AS level_others FROM f WHERE NOT left_ * weight / others > 2.0::DOUBLE * n ORDER BY place LIMIT 1
), t AS (
  SELECT source, n, CASE WHEN level_place IS NULL OR place < level_place THEN 2.0::DOUBLE * n ELSE level_left * weight / level_others END AS target
  FROM f LEFT JOIN l ON true
  UNION ALL SELECT source, n, 0.0::DOUBLE FROM s WHERE n = 0
), c AS (
  SELECT d.source, size, count(*) AS c, any_value(target) AS target, floor(1024 * sqrt(size::DOUBLE))::BIGINT AS pull
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source WHERE size > 0 GROUP BY d.source, size
), k AS (
  SELECT source, size, pull, (target - 2.0::DOUBLE * coalesce(sum((size * c)::HUGEINT) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
         / (sum((size * c)::HUGEINT * pull) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS kappa
  FROM c WINDOW o AS (PARTITION BY source ORDER BY size DESC)
), r AS (
  SELECT source, max_by(kappa, size) AS kappa FROM k WHERE kappa * pull <= 2.0::DOUBLE + 1e-9 GROUP BY source
), m AS (
  SELECT d.*, t.n AS source_size, t.target, coalesce(round(least(2.0::DOUBLE, kappa * floor(1024 * sqrt(size::DOUBLE))), 9), 0) AS m
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN r ON d.source IS NOT DISTINCT FROM r.source
), q AS (
  SELECT *, m - floor(m) AS p, CASE WHEN m > floor(m) THEN (u / (1 - u)) / ((m - floor(m)) / (1 - (m - floor(m)))) END AS odds FROM m
), z AS (
  SELECT source, odds / (1 + odds) AS mark, sum(size) AS n FROM q WHERE p > 0 GROUP BY 1, 2
), g AS (
  SELECT source, sum(p * size) AS need FROM q WHERE p > 0 GROUP BY source
), e AS (
  SELECT z.source, max(z.mark) AS end_at
  FROM (SELECT *, sum(n) OVER (PARTITION BY source ORDER BY mark) AS upto FROM z) z JOIN g ON z.source IS NOT DISTINCT FROM g.source
  WHERE upto - need < need - (upto - n) GROUP BY z.source
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       ((floor(m) + CASE WHEN p > 0 AND odds / (1 + odds) <= coalesce(end_at, -1) THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM q LEFT JOIN e ON q.source IS NOT DISTINCT FROM e.source
"""
