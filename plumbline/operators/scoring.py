"""Scores of answers against references, and replays of recorded results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def field_accuracy(answer: Column, reference: Column) -> Column:
    """Share of the reference's fields (a flat map; null values are left out) that the answer has with an equal value; null
    where the reference has none."""
    asked = F.map_filter(reference, lambda _, v: v.isNotNull())
    hits = F.size(F.map_filter(asked, lambda k, v: F.coalesce(F.try_element_at(answer, k) == v, F.lit(False))))
    return hits / F.nullif(F.size(asked), F.lit(0))


def quotes_both(answer: Column, verdict: Column, levels: list[Column]) -> Column:
    """Whether the answer says the verdict (yes or no, as a word) and quotes every level to the letter."""
    said = F.when(verdict, answer.rlike(r"(?i)\byes\b")).otherwise(answer.rlike(r"(?i)\bno\b"))
    for x in levels:
        said = said & F.contains(answer, x)
    return F.coalesce(said, F.lit(False))


def reply_flags(reply: Column) -> Column:
    """flag (all marks are closed), think, json and tool (a call with a name) and empty of a reply, as booleans."""
    body = F.regexp_replace(reply, r"(?s)^.*</think>", "")
    return F.struct(
        (F.size(F.split(reply, "<think>", -1)) == F.size(F.split(reply, "</think>", -1))).alias("flag_ok"),
        reply.rlike(r"(?s)<think>\s*\S.*</think>").alias("think_ok"),
        F.coalesce(F.try_parse_json(body).isNotNull(), F.lit(False)).alias("json_ok"),
        F.coalesce(F.get_json_object(body, "$.name").isNotNull(), F.lit(False)).alias("tool_ok"),
        (F.trim(body) == "").alias("empty"),
    )


def task_score(task: Column, answer: Column, reference: Column, recall: Column) -> Column:
    """A row's score by its task: values need a recall of 0.9, absent ones must be denied without inventing a number,
    verdicts must agree in their first word, texts must be equal but for case and white space."""
    first = lambda x: F.lower(F.regexp_extract(x, r"^\W*(\w+)", 1))
    plain = lambda x: F.lower(F.trim(F.regexp_replace(x, r"\s+", " ")))
    good = (
        F.when(task == "values", recall >= 0.9)
        .when(task == "absent", answer.rlike(r"(?i)\b(not|no|none|absent)\b") & ~answer.rlike("[0-9]"))
        .when(task == "verdict", first(answer) == first(reference))
        .otherwise(plain(answer) == plain(reference))
    )
    return F.coalesce(good, F.lit(False)).cast("int")


def replay(recorded: DataFrame, live: DataFrame, keys: list[str], result: str) -> DataFrame:
    """(keys without the last, identical, different, missing): results of calls against those of the same calls now, as JSON.

    The last key numbers the calls."""
    text = lambda c: F.to_json(F.struct(F.col(c).alias("r")))
    both = recorded.select(*keys, text(result).alias("was")).join(live.select(*keys, text(result).alias("now")), keys, "left")
    same = F.col("was") == F.col("now")
    return both.groupBy(*keys[:-1]).agg(F.count_if(same).alias("identical"), F.count_if(~same).alias("different"), F.count_if(F.col("now").isNull()).alias("missing"))


def stop_if(rows: DataFrame, wrong: Column, what: str) -> DataFrame:
    """``rows``, unless one is ``wrong``: then an error that names the first found, and nothing is built on them."""
    found = rows.where(wrong).limit(1).collect()
    if found:
        raise ValueError(f"{what}: {found[0].asDict()}")
    return rows
