"""Positional queries: events are readings of a line (user_id) at a position, minutes since 2020."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators import positional as op
from plumbline.query import query, table

_EVENTS = "SELECT user_id AS line, event_id, event_type, value, date_diff('second', TIMESTAMP '2020-01-01', ts) / 60.0 AS pos FROM events"
_PAIR = f"""WITH e AS ({_EVENTS}), u AS (SELECT *, event_type = 'error' AS probe FROM e WHERE event_type IN ('view', 'error')),
w AS (SELECT *, last_value(CASE WHEN NOT probe THEN pos END IGNORE NULLS) OVER b AS prev_pos, last_value(CASE WHEN NOT probe THEN value END IGNORE NULLS) OVER b AS prev,
 first_value(CASE WHEN NOT probe THEN pos END IGNORE NULLS) OVER a AS next_pos, first_value(CASE WHEN NOT probe THEN value END IGNORE NULLS) OVER a AS next
 FROM u WINDOW b AS (PARTITION BY line ORDER BY pos, probe, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
 a AS (PARTITION BY line ORDER BY pos, probe, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)), p AS (SELECT * FROM w WHERE probe)"""


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = F.timestamp_diff("SECOND", F.lit("2020-01-01").cast("timestamp_ntz"), F.col("ts").cast("timestamp_ntz"))
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("line"), "event_id", "event_type", "value", (seconds / 60.0).alias("pos"))


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir)
    return op.asof_pair(e.where("event_type = 'error'").select("line", "pos", "event_id"), e.where("event_type = 'view'"), "line", "pos", "value", "event_id")


@query(_PAIR + " SELECT line, event_id, prev, next FROM p")
def asof_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir).select("line", "event_id", "prev", "next")


_VALUE = "prev + (next - prev) * ((pos - prev_pos) / (next_pos - prev_pos))"


@query(_PAIR + f""" SELECT line, event_id, CASE WHEN prev_pos = pos THEN 'exact' WHEN prev_pos IS NULL OR next_pos IS NULL THEN 'outside' ELSE 'interpolated' END AS status,
 CASE WHEN prev_pos = pos THEN prev WHEN next_pos IS NOT NULL THEN floor(({_VALUE}) * 1000 + 0.5) / 1000 END AS value FROM p""")
def interpolate_bracketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.interpolate(_pairs(spark, sf_dir), "pos").select("line", "event_id", "status", "value")


@query(_PAIR + f""" SELECT line, event_id, CASE WHEN prev_pos = pos THEN 'exact' WHEN prev_pos IS NULL OR next_pos IS NULL THEN 'outside' WHEN abs(next_pos - prev_pos - 20000) > 15000 THEN 'gap' ELSE 'interpolated' END AS status,
 CASE WHEN prev_pos = pos THEN prev WHEN next_pos IS NOT NULL AND abs(next_pos - prev_pos - 20000) <= 15000 THEN floor(({_VALUE}) * 1000 + 0.5) / 1000 END AS value FROM p""")
def interpolate_with_gap_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.interpolate(_pairs(spark, sf_dir), "pos", 20000.0, 15000.0).select("line", "event_id", "status", "value")


@query(_PAIR + """ SELECT line, event_id, CASE WHEN prev_pos IS NULL OR next_pos - pos < pos - prev_pos THEN next ELSE prev END AS near FROM p""")
def nearest_reading(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.nearest(_pairs(spark, sf_dir), "pos").select("line", "event_id", "near")


_SEGMENTS = f"""WITH e AS ({_EVENTS}), s AS (SELECT line, event_id AS segment, pos AS low, lead(pos) OVER (PARTITION BY line ORDER BY pos, event_id) AS high FROM e WHERE event_type = 'click'),
q AS (SELECT * FROM e WHERE event_type = 'signup')"""


@query(_SEGMENTS + " SELECT q.line, q.event_id, s.segment FROM q JOIN s ON q.line = s.line AND q.pos >= s.low AND q.pos < s.high")
def segment_half_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir)
    s = op.segments(e.where("event_type = 'click'").select("line", "pos", F.col("event_id").alias("segment")), "line", "pos", "segment").select("line", "segment", F.col("pos").alias("low"), F.col("end").alias("high"))
    return op.containing(e.where("event_type = 'signup'").select("line", "event_id", "pos"), s, "line", "pos", "low", "high", False, 20000.0).select("line", "event_id", "segment")


@query(_SEGMENTS + " SELECT q.line, q.event_id, min(s.segment) AS segment, count(*) AS hits FROM q JOIN s ON q.line = s.line AND q.pos BETWEEN s.low AND s.high GROUP BY 1, 2")
def segment_closed_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir)
    s = op.segments(e.where("event_type = 'click'").select("line", "pos", F.col("event_id").alias("segment")), "line", "pos", "segment").select("line", "segment", F.col("pos").alias("low"), F.col("end").alias("high"))
    hits = op.containing(e.where("event_type = 'signup'").select("line", "event_id", "pos"), s, "line", "pos", "low", "high", True, 20000.0)
    return hits.groupBy("line", "event_id").agg(F.min("segment").alias("segment"), F.count("*").alias("hits"))


@query("SELECT o.o_orderkey, l.l_linenumber, p.p_partkey FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey JOIN part p ON p.p_partkey = l.l_partkey WHERE l.l_quantity BETWEEN p.p_size - 1 AND p.p_size + 1")
def interval_on_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, l, p = (table(spark, sf_dir, t) for t in ("orders", "lineitem", "part"))
    joined = l.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity").join(p.select("p_partkey", "p_size"), F.col("l_partkey") == F.col("p_partkey"))
    return joined.where(F.col("l_quantity").between(F.col("p_size") - 1, F.col("p_size") + 1)).join(o.select("o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey")).select("o_orderkey", "l_linenumber", "p_partkey")


@query(f"WITH e AS ({_EVENTS}) SELECT a.line, a.event_id AS a_id, b.event_id AS b_id FROM e a JOIN e b ON a.line = b.line AND a.event_type = 'error' AND b.event_type = 'click' AND abs(a.pos - b.pos) <= 5000")
def band_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir)
    a = e.where("event_type = 'error'").select("line", F.col("event_id").alias("a_id"), "pos")
    b = e.where("event_type = 'click'").select("line", F.col("event_id").alias("b_id"), F.col("pos").alias("other"))
    return op.within(a, b, "line", "pos", "other", 5000.0).select("line", "a_id", "b_id")


@query(f"""WITH e AS ({_EVENTS}), w AS (SELECT *, last_value(CASE WHEN event_type IN ('click', 'signup') THEN event_type END IGNORE NULLS) OVER (PARTITION BY line ORDER BY pos, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS zone FROM e)
SELECT event_id, CASE zone WHEN 'click' THEN 'curve' WHEN 'signup' THEN 'straight' ELSE 'before' END AS zone FROM w WHERE event_type = 'purchase'""")
def zone_by_last_transition(spark: SparkSession, sf_dir: str) -> DataFrame:
    change = F.when(F.col("event_type").isin("click", "signup"), F.col("event_type"))
    return op.neighbours(events(spark, sf_dir), "line", "pos", ["pos", "event_id"], change).withColumnRenamed("_prev", "zone").where("event_type = 'purchase'").select("event_id", F.when(F.col("zone") == "click", "curve").when(F.col("zone") == "signup", "straight").otherwise("before").alias("zone"))


@query(f"""WITH e AS ({_EVENTS}), b AS (SELECT event_id, line, pos, pos + 3000 * (value / 100) AS stop FROM e WHERE event_type = 'click'), q AS (SELECT event_id AS probe, line, pos AS pt FROM e WHERE event_type = 'purchase'),
d AS (SELECT probe, event_id, greatest(pos - pt, pt - stop, 0) AS dist FROM b JOIN q USING (line)), m AS (SELECT *, min(dist) OVER (PARTITION BY probe) AS least FROM d)
SELECT probe, event_id FROM m WHERE dist = least""")
def nearest_interval_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intervals that contain a position, or else the nearest of its line, all ties."""
    e = events(spark, sf_dir)
    b = e.where("event_type = 'click'").select("line", "event_id", "pos", (F.col("pos") + 3000 * (F.col("value") / 100)).alias("stop"))
    q = e.where("event_type = 'purchase'").select("line", F.col("event_id").alias("probe"), F.col("pos").alias("at"))
    return op.nearest_intervals(q, b, "line", "at", "pos", "stop", "probe", 3000.0).select("probe", "event_id")
