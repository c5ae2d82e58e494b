"""Sequence queries: points grouped by a state machine, blocks assigned to curves, periods of profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators.assign import ranked_assignment
from plumbline.operators.fold import Machine, run_machine
from plumbline.operators.period import pitch_and_phase
from plumbline.operators.positional import interpolate_at_breaks, neighbours
from plumbline.plans.positional import _EVENTS, events
from plumbline.query import query, table

#: States: no curve, its circular part begun, its circular part ended. Symbols: begin, end, end of a transition.
CURVES = Machine(step=[[1, 2, 0], [1, 2, 1], [1, 2, 0]], opens=[[True, True, False], [True, False, False], [True, True, False]])


def curves_of_points(points: DataFrame) -> DataFrame:
    """(line, curve, lead_in, begins, ends, lead_out): points (line, seq, pos, kind) without a number, grouped into curves.

    kind: begin or end of a circular part, or the end of a transition. A curve opens at a begin, or at an end that has none;
    the transition that follows its end closes it; the last transition before its begin leads in unless an end lies between.
    Points at one position go by seq; points without a position take no part."""
    rows = points.where("pos is not null")
    symbol = F.when(F.col("kind") == "begin", 0).when(F.col("kind") == "end", 1).when(F.col("kind") == "transition", 2)
    at = F.struct("pos", "seq")
    last = lambda df, kind, name: neighbours(df, "line", "pos", ["pos", "seq"], F.when(F.col("kind") == kind, at)).drop("_next").withColumnRenamed("_prev", name)
    before = last(last(rows.select("line", "seq", "pos", "kind"), "transition", "passed"), "end", "ended")
    lead = before.where("kind = 'begin'").select("line", "seq", F.when(F.col("ended").isNull() | (F.col("ended") < F.col("passed")), F.col("passed.seq")).alias("lead_in"))
    grouped = run_machine(rows.select("line", "seq", "pos", "kind"), "line", ["pos", "seq"], "seq", symbol, CURVES)
    own = grouped.where(F.col("kind").isin("begin", "end") | ((F.col("kind") == "transition") & (F.col("state") == 2)))
    one = lambda kind: F.max(F.when(F.col("kind") == kind, F.col("seq")))
    curves = own.groupBy("line", F.col("group").alias("curve")).agg(one("begin").alias("begins"), one("end").alias("ends"), one("transition").alias("lead_out"))
    return curves.join(lead.withColumnRenamed("seq", "begins"), ["line", "begins"], "left").select("line", "curve", "lead_in", "begins", "ends", "lead_out")


@query(f"""WITH RECURSIVE e AS ({_EVENTS}), p AS (SELECT line, event_id AS seq, pos, CASE event_type WHEN 'click' THEN 'begin' WHEN 'signup' THEN 'end' ELSE 'transition' END AS kind FROM e WHERE event_type IN ('click', 'signup', 'view')),
k AS (SELECT *, row_number() OVER (PARTITION BY line ORDER BY pos, seq) AS i, max(CASE WHEN kind = 'transition' THEN row_number() OVER (PARTITION BY line ORDER BY pos, seq) END) OVER () AS unused FROM p),
n AS (SELECT line, seq, kind, i, max(CASE WHEN kind = 'transition' THEN i END) OVER w AS t, max(CASE WHEN kind = 'end' THEN i END) OVER w AS z FROM k WINDOW w AS (PARTITION BY line ORDER BY i ROWS UNBOUNDED PRECEDING)),
r AS (SELECT line, 0::BIGINT AS i, 0 AS state, NULL::BIGINT AS curve, NULL::VARCHAR AS role FROM n GROUP BY line UNION ALL
 SELECT n.line, n.i, CASE n.kind WHEN 'begin' THEN 1 WHEN 'end' THEN 2 ELSE CASE WHEN r.state = 2 THEN 0 ELSE r.state END END, CASE WHEN n.kind = 'begin' OR (n.kind = 'end' AND r.state <> 1) THEN n.seq ELSE r.curve END,
 CASE WHEN n.kind <> 'transition' THEN n.kind WHEN r.state = 2 THEN 'out' END FROM r JOIN n ON n.line = r.line AND n.i = r.i + 1),
m AS (SELECT n.line, n.seq, n.t, n.z, r.curve, r.role FROM r JOIN n ON n.line = r.line AND n.i = r.i WHERE role IS NOT NULL),
g AS (SELECT line, curve, max(CASE WHEN role = 'begin' THEN seq END) AS begins, max(CASE WHEN role = 'end' THEN seq END) AS ends, max(CASE WHEN role = 'out' THEN seq END) AS lead_out, max(CASE WHEN role = 'begin' AND (z IS NULL OR z < t) THEN t END) AS lead FROM m GROUP BY 1, 2)
SELECT g.line, g.curve, n.seq AS lead_in, begins, ends, lead_out FROM g LEFT JOIN n ON n.line = g.line AND n.i = g.lead""".replace(", max(CASE WHEN kind = 'transition' THEN row_number() OVER (PARTITION BY line ORDER BY pos, seq) END) OVER () AS unused", ""))
def curves_from_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks begin, signups end, views are ends of transitions."""
    kind = F.when(F.col("event_type") == "click", "begin").when(F.col("event_type") == "signup", "end").otherwise("transition")
    points = events(spark, sf_dir).where("event_type in ('click', 'signup', 'view')").select("line", F.col("event_id").alias("seq"), "pos", kind.alias("kind"))
    return curves_of_points(points)


@query("""WITH RECURSIVE c AS (SELECT o_custkey AS sheet, o_orderkey AS curve, CASE WHEN o_orderkey % 4 = 0 THEN (o_orderkey % 50)::VARCHAR END AS num, (o_orderkey % 3) * 5.0 + (o_orderkey % 2) * 0.01 AS length, o_totalprice AS x FROM orders),
b AS (SELECT user_id AS sheet, event_id AS block, CASE WHEN event_id % 5 > 0 THEN (event_id % 60)::VARCHAR END AS num, CASE WHEN event_id % 11 > 0 THEN (event_id % 4) * 5.0 + 0.005 END AS length, value * 4000 AS x FROM events),
named AS (SELECT b.sheet, block, curve, 'number' AS rule FROM b JOIN c ON b.sheet = c.sheet AND b.num = c.num),
rest AS (SELECT * FROM b WHERE length IS NOT NULL AND NOT EXISTS (SELECT 1 FROM named n WHERE n.sheet = b.sheet AND n.block = b.block)),
f AS (SELECT sheet, coalesce(num, 'b' || block) AS head, length, min(block) AS first, arg_min(x, block) AS x FROM rest GROUP BY 1, 2, 3),
fits AS (SELECT f.sheet, f.first AS block, list(c.curve ORDER BY abs(f.x - c.x), c.curve) AS curves FROM f JOIN c ON c.sheet = f.sheet AND abs(c.length - f.length) < 0.02 GROUP BY 1, 2),
o AS (SELECT *, row_number() OVER (PARTITION BY sheet ORDER BY block) AS i FROM fits),
r AS (SELECT DISTINCT sheet, 0::BIGINT AS i, []::BIGINT[] AS taken, NULL::BIGINT AS block, NULL::BIGINT AS curve, NULL::VARCHAR AS rule FROM o UNION ALL
 SELECT sheet, i, list_append(taken, pick), block, pick, CASE WHEN n = 1 THEN 'length' WHEN left_ IS NOT NULL THEN 'nearest' ELSE 'taken' END FROM (
  SELECT *, CASE WHEN n = 1 THEN curves[1] ELSE coalesce(left_, curves[1]) END AS pick FROM (
   SELECT o.sheet, o.i, r.taken, o.block, o.curves, len(o.curves) AS n, list_filter(o.curves, lambda k: NOT list_contains(r.taken, k))[1] AS left_ FROM r JOIN o ON o.sheet = r.sheet AND o.i = r.i + 1))),
a AS (SELECT rest.sheet, rest.block, r.curve, CASE WHEN rest.block > f.first THEN 'again' ELSE r.rule END AS rule FROM r JOIN f ON r.sheet = f.sheet AND r.block = f.first JOIN rest ON rest.sheet = f.sheet AND coalesce(rest.num, 'b' || rest.block) = f.head AND rest.length = f.length WHERE r.block IS NOT NULL)
SELECT * FROM named UNION ALL SELECT * FROM a""")
def blocks_to_curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks (events) of a sheet (user) to its curves (orders): by number, else length, else the nearest that is free."""
    o, e = table(spark, sf_dir, "orders"), table(spark, sf_dir, "events")
    k = F.col("o_orderkey")
    curves = o.select(F.col("o_custkey").alias("sheet"), k.alias("curve"), F.when(k % 4 == 0, (k % 50).cast("string")).alias("num"), ((k % 3) * F.lit(5.0) + (k % 2) * F.lit(0.01)).alias("length"), F.col("o_totalprice").alias("x"))
    b = F.col("event_id")
    blocks = e.select(F.col("user_id").alias("sheet"), b.alias("block"), F.when(b % 5 > 0, (b % 60).cast("string")).alias("num"), F.when(b % 11 > 0, (b % 4) * F.lit(5.0) + 0.005).alias("length"), (F.col("value") * 4000).alias("x"))
    return ranked_assignment(blocks, curves)


@query()
def profile_pitch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five profiles of the orders: a mark every 17 to 21 positions over the customers' noise."""
    k, x = F.col("o_orderkey") % 5, F.floor(F.col("o_orderkey") / 5)
    value = F.when(F.pmod(x, 17 + k) == 3, F.lit(100)).otherwise(F.col("o_custkey") % 40).cast("double")
    profile = table(spark, sf_dir, "orders").groupBy(k.alias("key"), x.alias("x")).agg(F.sum(value).alias("value"))
    return pitch_and_phase(profile, 5, 80)


_WAVE = "abs((pos - floor(pos / 10000) * 10000) - 5000) * 0.002"


@query(f"""WITH e AS ({_EVENTS}), c0 AS (SELECT line, event_id AS seq, pos, {_WAVE} AS v FROM e WHERE event_type IN ('view', 'signup')),
c AS (SELECT *, lag(pos) OVER w AS bp, lag(v) OVER w AS bv, lead(pos) OVER w AS fp, lead(v) OVER w AS fv, lead(pos, 2) OVER w AS gp, lead(v, 2) OVER w AS gv FROM c0 WINDOW w AS (PARTITION BY line ORDER BY pos, seq)),
k AS (SELECT line, floor(pos / 5000) * 5000 + (event_id % 2) AS pos FROM e WHERE event_type = 'click'), q AS (SELECT line, event_id, pos FROM e WHERE event_type = 'error'),
h AS (SELECT q.line, q.event_id, q.pos AS x, c.pos AS ap, c.v AS av, bp, bv, fp, fv, gp, gv FROM q LEFT JOIN LATERAL (SELECT * FROM c WHERE c.line = q.line AND c.pos <= q.pos ORDER BY c.pos DESC, c.seq DESC LIMIT 1) c ON true),
b AS (SELECT h.*, coalesce((SELECT max(pos) FROM k WHERE k.line = h.line AND k.pos <= h.x AND k.pos > ap AND k.pos < fp), CASE WHEN (SELECT min(pos) FROM k WHERE k.line = h.line AND k.pos > h.x) < fp THEN (SELECT min(pos) FROM k WHERE k.line = h.line AND k.pos > h.x) END) AS at_ FROM h),
m AS (SELECT *, bv + (av - bv) * (at_ - bp) / nullif(ap - bp, 0) AS l, fv + (gv - fv) * (at_ - fp) / nullif(gp - fp, 0) AS r, av + (fv - av) * (at_ - ap) / nullif(fp - ap, 0) AS s FROM b),
w AS (SELECT *, CASE WHEN ap = x THEN 'exact' WHEN ap IS NULL OR fp IS NULL THEN 'outside' WHEN abs(l - r) <= 0.0015 AND abs(l - s) > 0.0015 THEN CASE WHEN x <= at_ THEN 'left' ELSE 'right' END ELSE 'straight' END AS how FROM m)
SELECT line, event_id, how, floor(CASE how WHEN 'exact' THEN av WHEN 'left' THEN bv + (av - bv) * (x - bp) / nullif(ap - bp, 0) WHEN 'right' THEN fv + (gv - fv) * (x - fp) / nullif(gp - fp, 0) WHEN 'straight' THEN av + (fv - av) * (x - ap) / nullif(fp - ap, 0) END * 1000 + 0.5) / 1000 AS value FROM w""")
def interpolation_at_grade_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Levels that rise and fall by stretches of 5000: columns are views and signups, breaks clicks moved to the turns (some
    beside them), probes errors."""
    e = events(spark, sf_dir)
    wave = F.abs((F.col("pos") - F.floor(F.col("pos") / 10000) * 10000) - 5000) * 0.002
    columns = e.where("event_type in ('view', 'signup')").select("line", F.col("event_id"), "pos", wave.alias("v"))
    breaks = e.where("event_type = 'click'").select("line", (F.floor(F.col("pos") / 5000) * 5000 + F.col("event_id") % 2).cast("double").alias("pos"), "event_id")
    found = interpolate_at_breaks(e.where("event_type = 'error'").select("line", "pos", "event_id"), columns, breaks, "line", "pos", "v", "event_id")
    return found.select("line", "event_id", "how", (F.floor(F.col("value") * 1000 + 0.5) / 1000).alias("value"))
