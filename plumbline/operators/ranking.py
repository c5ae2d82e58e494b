"""Scores of facts and printed texts against questions, as equi-joins on what they share."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.scratch import scratch, written


#: Shared tokens and numbers of facts that a task scores.
FACT_ROWS = 200_000


def score_facts(facts: DataFrame, questions: DataFrame, each_number: bool = False, titles: bool = False, weak: str | None = "text") -> DataFrame:
    """(qid, fid, score) of every fact that shares a token, a number or its title with a question.

    ``facts``: fid, grp, tokens, numbers, title (arrays of distinct values); ``questions``: qid, tokens, numbers. The score
    is the sum of log(1 + N / df) over shared tokens, 6 for shared numbers (once, or for each), 8 if the question has all
    tokens of the fact's title (with ``titles``), less 0.5 for facts of the group ``weak``. Only tokens that questions
    hold cross the shuffle.
    """
    kinds = [("token", "tokens", "tokens"), ("number", "numbers", "numbers")] + ([("title", "title", "tokens")] if titles else [])
    empty = F.array().cast("array<struct<kind:string,v:string>>")
    marked = lambda column, kind: F.coalesce(F.transform(column, lambda v: F.struct(F.lit(kind).alias("kind"), v.cast("string").alias("v"))), empty)
    less = F.when(F.coalesce(F.col("grp") == weak, F.lit(False)), 0.5).otherwise(0.0) if weak is not None else F.lit(0.0)
    with scratch(facts.sparkSession):
        q = written(questions.select("qid", F.explode(F.concat(*[marked(there, kind) for kind, _, there in kinds])).alias("e")).select("qid", "e.*"), "asked")
        # texts are parsed once: what questions hold of them is a small part
        f = facts.select("fid", less.alias("less"), F.size("title").alias("n"), F.explode(F.concat(*[marked(column, kind) for kind, column, _ in kinds])).alias("e")).select("fid", "less", "n", "e.*")
        f = written(f.join(q.select("kind", "v").distinct(), ["kind", "v"]), "facts")
        df = f.where("kind = 'token'").groupBy("v").agg(F.count("*").alias("df"))
        weights = df.crossJoin(facts.agg(F.count("*").alias("all"))).select(F.lit("token").alias("kind"), "v", F.log1p(F.col("all") / F.col("df")).alias("w"))
        asked = written(q.join(weights, ["kind", "v"], "left"), "weighed")
        # all rows of a fact are in one task before they meet the questions, so pairs do not cross a shuffle; tasks grow in
        # number, not in size
        met = f.repartition(f.count() // FACT_ROWS + 1, "fid").join(asked, ["kind", "v"]).groupBy("fid", "qid").agg(
            F.count_if(F.col("kind") == "token").alias("tokens"), F.sum("w").alias("w"), F.count_if(F.col("kind") == "number").alias("numbers"),
            ((F.max("n") > 0) & (F.count_if(F.col("kind") == "title") == F.max("n"))).alias("titled"), F.max("less").alias("less"),
        )
        met = met.where("tokens > 0 or numbers > 0 or titled").withColumn("w", F.coalesce("w", F.lit(0.0)))
        number = (F.col("numbers") if each_number else (F.col("numbers") > 0).cast("int")) * 6.0
        score = F.col("w") + number + (F.when(F.col("titled"), 8.0).otherwise(0.0) if titles else F.lit(0.0)) - F.col("less")
        return written(met.select("qid", "fid", score.alias("score")), "scores", keep=True)


def _strong(texts: DataFrame, questions: DataFrame, reach: float, least: float) -> DataFrame:
    """(qid, tid, score) of shared numbers and codes, in one row or two a pair.

    Numbers meet by their whole part and its neighbours, so the range match is an equality."""
    value = lambda rows, key, name: rows.select(key, F.explode("numbers").alias(name)).where(F.col(name) >= least)
    near = value(questions, "qid", "v").withColumn("bin", F.explode(F.sequence(F.floor(F.col("v") - reach), F.floor(F.col("v") + reach))))
    numbers = near.join(value(texts, "tid", "x").withColumn("bin", F.floor("x")), "bin").where(F.abs(F.col("v") - F.col("x")) <= reach + 1e-9)
    numbers = numbers.select("qid", "tid", "v").distinct().groupBy("qid", "tid").agg((10 * F.count("*")).alias("score"))
    return numbers.unionByName(_equal(texts, questions, "codes", 10))


def _equal(texts: DataFrame, questions: DataFrame, column: str, weight: int) -> DataFrame:
    side = lambda rows, key: rows.select(key, F.explode(column).alias("v"))
    return side(questions, "qid").join(side(texts, "tid"), "v").groupBy("qid", "tid").agg((weight * F.count("*")).alias("score"))


def printed_match(texts: DataFrame, questions: DataFrame, reach: float = 0.6, least: float = 10.0) -> DataFrame:
    """(qid, tid, score): 10 for each number of the question (``least`` or more) that the text prints within ``reach``, 10
    for each shared code, 1 for each shared word. Both sides: id, numbers, codes, words (arrays of distinct values)."""
    return _strong(texts, questions, reach, least).unionByName(_equal(texts, questions, "words", 1)).groupBy("qid", "tid").agg(F.sum("score").alias("score"))


def best_printed(texts: DataFrame, questions: DataFrame, most: int = 1, reach: float = 0.6, least: float = 10.0) -> DataFrame:
    """(qid, tid, score): the texts that fit a question best by the score of ``printed_match``, of equal ones the ``most``
    with the smallest ids; questions that share nothing with any text have no row.

    Every pair with a number or a code is scored. Of the words the rarest come first: once a text with score s is known, a
    text that lacks all but the s - 1 most frequent words of the question cannot reach it. So the texts of the first word are
    scored, then those of the next four, sixteen and so on, until that holds: frequent words are looked up for candidates alone.
    """
    with scratch(texts.sparkSession):
        # parsed once, not for each pass
        texts, questions = written(texts.select("tid", "numbers", "codes", "words"), "printed"), written(questions.select("qid", "numbers", "codes", "words"), "asked")
        asked = questions.select("qid", F.explode("words").alias("word")).distinct()
        posted = written(texts.select("tid", F.explode("words").alias("word")).distinct().join(asked.select("word").distinct(), "word"), "postings")
        held = asked.join(posted.groupBy("word").agg(F.count("*").alias("df")), "word")
        places = held.withColumn("place", F.row_number().over(Window.partitionBy("qid").orderBy("df", "word")))
        places = written(places.withColumn("n", F.count("*").over(Window.partitionBy("qid"))).select("qid", "word", "place", "n"), "places")
        strong = _strong(texts, questions, reach, least).groupBy("qid", "tid").agg(F.sum("score").alias("strong"))
        fresh, scored, done, step = written(strong, "strong"), None, 0, 1
        left = places.select("qid", "n").distinct()
        while True:
            word = places.where((F.col("place") > done) & (F.col("place") <= done + step)).join(left.select("qid"), "qid", "left_semi")
            met = word.join(posted, "word").groupBy("qid", "tid", "n").agg(F.count("*").alias("got"))
            if scored is None:
                pairs = met.select("qid", "tid")
            else:
                # what has none of the words before, few of these and too few left cannot reach the floor
                open_ = met.join(floors, "qid", "left").where(F.col("got") + F.greatest(F.col("n") - (done + step), F.lit(0)) >= F.coalesce("floor", F.lit(0)))
                pairs = open_.select("qid", "tid").join(scored, ["qid", "tid"], "left_anti")
            pairs = pairs.withColumn("strong", F.lit(0).cast("long"))
            if scored is None:
                pairs = pairs.unionByName(fresh).groupBy("qid", "tid").agg(F.sum("strong").alias("strong"))
            shared = pairs.join(places.select("qid", "word"), "qid").join(posted, ["tid", "word"]).groupBy("qid", "tid").agg(F.count("*").alias("words"))
            new = pairs.join(shared, ["qid", "tid"], "left").select("qid", "tid", (F.col("strong") + F.coalesce("words", F.lit(0))).alias("score"))
            scored = written(new if scored is None else scored.unionByName(new), "scored")
            done, step = done + step, 4 * step
            floors = written(scored.groupBy("qid").agg(F.max("score").alias("floor")), "floors")
            left = written(places.select("qid", "n").distinct().join(floors, "qid", "left").where(F.col("n") - F.coalesce("floor", F.lit(0)) + 1 > done).where(F.col("n") > done).select("qid", "n"), "open")
            if left.isEmpty():
                break
        best = scored.withColumn("rank", F.rank().over(Window.partitionBy("qid").orderBy(F.desc("score")))).where("rank = 1")
        best = best.withColumn("place", F.row_number().over(Window.partitionBy("qid").orderBy("tid"))).where(F.col("place") <= most)
        return written(best.select("qid", "tid", "score"), "best", keep=True)
