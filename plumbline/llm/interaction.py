"""Filter interaction audit: what each filter removes at each place of each order, without running any order.

With k filters a run of filters is a path in the lattice of subsets: its step goes from the subset already applied to that
subset and one filter more. There are k * 2^(k-1) such edges (80 of five filters), and what a step removes depends on its
edge alone. Documents are counted by the set of filters that they fail, those counts are added up on the edges, and the
k! orders (600 steps of five filters) are read off as paths. The Shapley column adds up the edges of a filter, each as
often as an order passes it.

Copies are found table-wide by a 128-bit digest of the text: rows are summed by (text, document) and then by (text, part)
before a text's smallest id is looked up, so a text that a third of the rows hold is a row for each part by then.

Defined results: a null text is the empty text and equal to it; a null source is the empty string and one part with it;
a null doc_id is smaller and larger than no other, so such a row is never a later copy, makes none, and has no labels;
rows that repeat an id are documents each, and copies of one id are no later copies of each other; a document that
several label rows name is good (toxic) if one of them says so; an empty table has no parts. Extra columns are ignored.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.llm.common import content_key, scratch, table, written

COUNTS = ("n", "good", "toxic")


def text_conditions(text: Column, words: Column) -> dict[str, Column]:
    """Filters that look at one text alone; true where the text fails."""
    n = F.size(words)
    return {
        "A": n < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * n,
        "C": 100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > 2 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


COPY = "E"


def failing(documents: DataFrame, labels: DataFrame) -> tuple[DataFrame, list[str]]:
    """(part, mask, n, good, toxic) by part and set of failed filters, bit k of ``mask`` for letter k, and the letters."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    part = F.coalesce(F.col("source").cast("string"), F.lit(""))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), part.alias("part"), text.alias("text"))
    rows = rows.withColumn("words", F.array_remove(F.split("text", "[\\x20\\x09-\\x0D]+"), ""))
    found = text_conditions(F.col("text"), F.col("words"))
    letters = [*found, COPY]
    mask = sum((F.when(c, 1 << k).otherwise(0) for k, c in enumerate(found.values())), F.lit(0))
    # rows without an id are dealt out by their text
    slim = rows.select("doc_id", "part", *content_key(F.col("text")), mask.alias("mask")).withColumn("salt", F.when(F.col("doc_id").isNull(), F.col("key_lo")).otherwise(0))
    says = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)).cast("long"))
    named = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(says("quality").alias("good"), says("toxic").alias("toxic")).withColumn("salt", F.lit(0).cast("long"))
    known = slim.join(named, ["doc_id", "salt"], "left").na.fill(0, ["good", "toxic"])
    by_id = known.groupBy("doc_id", "salt", "key_hi", "key_lo", "part").agg(F.count("*").alias("n"), *[F.max(c).alias(c) for c in ("mask", "good", "toxic")])
    times = {"n": F.col("n"), "good": F.col("n") * F.col("good"), "toxic": F.col("n") * F.col("toxic")}
    held = by_id.groupBy("key_hi", "key_lo", "part").agg(
        F.max("mask").alias("mask"),
        F.struct(*[F.sum(x).alias(c) for c, x in times.items()]).alias("whole"),
        F.min("doc_id").alias("own"),
        F.min_by(F.struct(*[x.alias(c) for c, x in times.items()]), "doc_id").alias("first"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("nameless"),
    )
    held = written(held, "audit-copies")
    least = held.groupBy("key_hi", "key_lo").agg(F.min("own").alias("least"))
    marked = held.join(least, ["key_hi", "key_lo"])
    # what is no later copy: the text's smallest id, where it is in this part, and rows without an id
    once = F.struct(*[(F.when(F.col("own") == F.col("least"), F.col(f"first.{c}")).otherwise(0) + (F.col("nameless") if c == "n" else 0)).alias(c) for c in COUNTS])
    split = marked.select("part", "mask", "whole", once.alias("once"))
    later = F.struct((F.col("mask") + (1 << (len(letters) - 1))).alias("mask"), *[(F.col(f"whole.{c}") - F.col(f"once.{c}")).alias(c) for c in COUNTS])
    both = split.select("part", F.explode(F.array(F.struct("mask", *[F.col(f"once.{c}").alias(c) for c in COUNTS]), later)).alias("x")).select("part", "x.*")
    return both.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in COUNTS]), letters


def lattice_edges(classes: DataFrame, k: int) -> DataFrame:
    """(part, applied, filter) with kept, removed, redundant, good_lost, toxic_lost: one row for each part and edge, zeros
    included. ``classes``: part, mask, n, good, toxic; ``applied`` is a set of bits, ``filter`` the bit's number."""
    pairs = [(s, f) for f in range(k) for s in range(1 << k) if not s >> f & 1]
    edge = F.explode(F.array(*[F.struct(F.lit(s).alias("applied"), F.lit(f).alias("filter")) for s, f in pairs])).alias("edge")
    rows = classes.select("*", edge).select("part", "mask", *COUNTS, "edge.*")
    reached = F.col("mask").bitwiseAND(F.col("applied")) == 0
    fails = F.expr("(shiftright(mask, filter) & 1) = 1")
    total = lambda c, when: F.sum(F.when(when, F.col(c)).otherwise(0))
    return rows.groupBy("part", "applied", "filter").agg(
        total("n", reached & ~fails).alias("kept"),
        total("n", reached & fails).alias("removed"),
        total("n", ~reached & fails).alias("redundant"),
        total("good", reached & fails).alias("good_lost"),
        total("toxic", reached & fails).alias("toxic_lost"),
    )


def audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part, order of the filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost
    and shapley, the filter's removals summed over all orders."""
    spark = documents.sparkSession
    with scratch(spark):
        classes, letters = failing(documents, labels)
        k = len(letters)
        # 2^k rows a part
        edges = lattice_edges(written(classes, "audit-classes", keep=True), k)
    paths = F.create_map(*[F.lit(x) for size in range(k) for x in (size, factorial(size) * factorial(k - 1 - size))])
    size = F.bit_count("applied")
    alone = Window.partitionBy("part", "filter")
    unique = F.sum(F.when(size == k - 1, F.col("removed")).otherwise(0)).over(alone)
    edges = edges.withColumns({"unique_fails": unique, "shapley": F.sum(F.col("removed") * paths[size]).over(alone)})
    steps = []
    for order in permutations(range(k)):
        name, applied = "".join(letters[f] for f in order), 0
        for step, f in enumerate(order, 1):
            steps.append((name, step, applied, f))
            applied |= 1 << f
    # k! * k rows, 600 of five filters, whatever the documents
    path = spark.createDataFrame(steps, "filter_order string, step int, applied int, filter int")
    out = edges.join(F.broadcast(path), ["applied", "filter"])
    whole = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    return out.select("part", "filter_order", "step", *[F.col(c).cast("long").alias(c) for c in whole])


def op11_filter_interaction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), g AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY 1
), f AS (
  SELECT row_number() OVER () AS row, part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         len(ws) < 200 AS a, 100 * len(list_distinct(ws)) < 50 * len(ws) AS b, 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) AS c,
         regexp_matches(t, '[#$%&*|]') AS d, coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY t), false) AS e
  FROM d LEFT JOIN g ON d.doc_id = g.doc_id
), x AS (
  SELECT row, part, good, toxic, (CASE WHEN a THEN 'A' ELSE '' END) || (CASE WHEN b THEN 'B' ELSE '' END) || (CASE WHEN c THEN 'C' ELSE '' END)
         || (CASE WHEN d THEN 'D' ELSE '' END) || (CASE WHEN e THEN 'E' ELSE '' END) AS fails FROM f
), l AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l
), p AS (
  SELECT l1.l || l2.l || l3.l || l4.l || l5.l AS filter_order FROM l l1, l l2, l l3, l l4, l l5
  WHERE len(list_distinct([l1.l, l2.l, l3.l, l4.l, l5.l])) = 5
), r AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM x GROUP BY 1, 2
), o AS (
  SELECT r.*, filter_order, unnest(range(1, 6)) AS step,
         coalesce(list_min([strpos(filter_order, z) FOR z IN string_split(fails, '') IF z <> '']), 9) AS gone
  FROM r, p
), s AS (
  SELECT *, filter_order[step] AS letter, contains(fails, filter_order[step]) AS bad FROM o
), y AS (
  SELECT part, filter_order, step, letter, sum(CASE WHEN gone > step THEN n ELSE 0 END) AS kept, sum(CASE WHEN gone = step THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN bad AND gone < step THEN n ELSE 0 END) AS redundant, sum(CASE WHEN fails = letter THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN gone = step THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN gone = step THEN toxic ELSE 0 END) AS toxic_lost
  FROM s GROUP BY 1, 2, 3, 4
)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
       good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM y
"""
