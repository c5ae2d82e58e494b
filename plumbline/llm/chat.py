"""Chat formatting after a collapse of cumulative snapshots.

Logs often keep a conversation each time it grows. Every turn gets a hash of (role, text) with its position, and the
running sum of those hashes along the conversation is the hash of each prefix. A conversation whose whole hash is a
proper prefix of another is a snapshot and goes (anti-join); of equal conversations the smallest id stays. What is left
is rendered turn by turn.

Defined results: turns are ordered by turn, role, text (nulls first); a null role or text counts as its own value, apart
from the empty one, and is rendered as an empty string; a null conv_id is one conversation like any other id; turns
repeated in full stay, as positions tell them apart; an empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.llm.common import table, written

PARTS = 4


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), role, text, n (turns in all) and h0..h3, the hash of the turns up to pos: sums of 32-bit parts."""
    w = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string")).withColumn("pos", F.row_number().over(w).cast("long"))
    shape = F.concat_ws(",", F.isnull("role").cast("string"), F.isnull("text").cast("string"))
    digest = F.sha2(F.concat_ws("\x1f", F.col("pos").cast("string"), shape, F.col("role"), F.length("role").cast("string"), F.col("text")), 256)
    upto = Window.partitionBy("conv_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("digest", digest)
    for k in range(PARTS):
        rows = rows.withColumn(f"h{k}", F.sum(F.conv(F.substring("digest", 8 * k + 1, 8), 16, 10).cast("long")).over(upto))
    return rows.withColumn("n", F.count("*").over(Window.partitionBy("conv_id"))).drop("digest", "turn")


def maximal(turns: DataFrame) -> DataFrame:
    """The turns (conv_id, pos, role, text) of conversations that no other one extends, one of each set of equals."""
    h = [f"h{k}" for k in range(PARTS)]
    rows = written(prefix_hashes(turns), "chat")
    # equal conversations: the smallest id stays, the null id only if it is alone
    whole = rows.where("pos = n").groupBy("pos", *h).agg(F.min("conv_id").alias("kept_id"))
    proper = rows.where("pos < n").select("pos", *h).distinct()
    kept = whole.join(proper, ["pos", *h], "left_anti").select("kept_id")
    return rows.join(kept, F.col("conv_id").eqNullSafe(F.col("kept_id")), "left_semi").select("conv_id", "pos", "role", "text")


def render(turns: DataFrame, template: str = "<|{role}|>\n{text}<|end|>\n") -> DataFrame:
    """conv_id, n_turns, rendered: the turns of a conversation in order, each in the template."""
    before, rest = template.split("{role}")
    between, after = rest.split("{text}")
    turn = F.concat(F.lit(before), F.coalesce("role", F.lit("")), F.lit(between), F.coalesce("text", F.lit("")), F.lit(after))
    # a conversation is one output row, so its turns meet by nature
    rows = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("pos", turn.alias("t")))).alias("turns"))
    return rows.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.array_join(F.col("turns.t"), "").alias("rendered"))


def op5_chat_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render(maximal(table(spark, sf_dir, "conversations")))


SQL = """
WITH o AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS pos, role, text FROM conversations
), t AS (
  SELECT conv_id, pos, sha256(pos || chr(31) || coalesce('r' || role, 'n') || chr(31) || coalesce('t' || text, 'n')) AS d,
         '<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || '<|end|>' || chr(10) AS line FROM o
), p AS (
  SELECT conv_id, pos, string_agg(d, '') OVER (PARTITION BY conv_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS h, max(pos) OVER (PARTITION BY conv_id) AS n FROM t
), w AS (
  SELECT h, min(conv_id) AS conv_id FROM p WHERE pos = n GROUP BY h
), k AS (
  SELECT conv_id FROM w WHERE h NOT IN (SELECT h FROM p WHERE pos < n)
)
SELECT conv_id, count(*) AS n_turns, string_agg(line, '' ORDER BY pos) AS rendered FROM t WHERE conv_id IN (SELECT conv_id FROM k) GROUP BY conv_id
"""
