"""Rules on the wording of values: whole statements, texts that are not reworded, patterns whose spaces may be lost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.query import query, table

# Words that a whole statement does not end in; texts that stay as they are (file names, an answer that names a line).
OPEN_ENDS = "of|to|the|and|for"
STAYS = r"(?i)\.(?:pdf|png|jpe?g|tiff?)\b|^the (?:3rd|4th) line\.\n?\z"


def complete(value: Column) -> Column:
    """Two words or more, the last of which asks for no other. False for null and empty texts."""
    return F.coalesce(value.rlike(r"\S\s+\S") & ~value.rlike(rf"(?i)(?:^|[^\p{{L}}\p{{N}}_])(?:{OPEN_ENDS})\s*\z"), F.lit(False))


def may_be_reworded(value: Column) -> Column:
    """Not for null texts and those that stay as they are."""
    return F.coalesce(~value.rlike(STAYS), F.lit(False))


def loose(pattern: str) -> str:
    """``pattern`` with each space optional and stretchable, as scans lose and add them."""
    return r"\s*".join(pattern.split(" "))


@query(r"""SELECT doc_id, coalesce(regexp_matches(text, '\S\s+\S') AND NOT regexp_matches(text, '(?i)(?:^|[^\p{L}\p{N}_])(?:of|to|the|and|for)\s*\z'), false) AS complete FROM documents""")
def complete_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", complete(F.col("text")).alias("complete"))


@query(r"""SELECT conv_id, turn, coalesce(NOT regexp_matches(text, '(?i)\.(?:pdf|png|jpe?g|tiff?)\b|^the (?:3rd|4th) line\.\n?\z'), false) AS rewordable FROM conversations""")
def rewordable_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", may_be_reworded(F.col("text")).alias("rewordable"))


@query(r"""SELECT p_partkey, regexp_matches(p_name, '^(?:cold|small)\s*widget$') AS spaced, regexp_matches(replace(p_name, ' ', ''), '^(?:cold|small)\s*widget$') AS lost FROM part""")
def loosely_printed_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A printed name is found with its space, and where that was lost."""
    pattern = F.lit(loose("^(?:cold|small) widget$"))
    return table(spark, sf_dir, "part").select("p_partkey", F.regexp_like("p_name", pattern).alias("spaced"), F.regexp_like(F.replace("p_name", F.lit(" "), F.lit("")), pattern).alias("lost"))


@query(r"""SELECT doc_id, len(regexp_extract_all(lower(text), 'of\s*the')) AS n FROM documents WHERE regexp_matches(lower(text), 'of\s*the')""")
def loosely_printed_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often a phrase is printed, its space kept, doubled or lost."""
    n = F.regexp_count(F.lower("text"), F.lit(loose("of the")))
    return table(spark, sf_dir, "documents").select("doc_id", n.cast("long").alias("n")).where("n > 0")
