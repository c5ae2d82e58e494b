"""Label chains, headings by values, table variants, logs and indexes, on lines of orders, events and customers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators.headings import resolved_headings
from plumbline.operators.pieces import callout_chains
from plumbline.operators.positional import close_by
from plumbline.operators.variants import varied
from plumbline.operators.windows import budgeted
from plumbline.plans.checks import _sheets
from plumbline.plans.evaluate import _BOX, boxes
from plumbline.plans.pages import _LINES, _lines
from plumbline.query import query, table
from plumbline.scratch import fresh_path
from plumbline.sources.log import Log, write_index
from plumbline.sources.store import Store

# Words of the printed labels.
_WORDS = ["STONE", "PITCHING WITH", "CEMENT|GROUTING", "300 THK", "of it", "WALL"]


@query(f"""WITH RECURSIVE l AS ({_LINES}), t AS (SELECT page, page * 10 + k AS id, CASE part % 6 WHEN 0 THEN 'STONE' WHEN 1 THEN 'PITCHING WITH' WHEN 2 THEN 'CEMENT|GROUTING' WHEN 3 THEN '300 THK' WHEN 4 THEN 'of it' ELSE 'WALL' END AS text, supp % 10 = 0 AS up, part % 4 = 0 AS red,
 10.0 + supp % 4 AS size, 40.0 * (q % 2) + part % 9 AS u0, 40.0 * (q % 2) + part % 9 + 20 + supp % 6 AS u1, 12.0 * k + part % 3 AS v0, 12.0 * k + part % 3 + 9 AS v1, q % 25 = 0 AS out_, q % 23 = 0 AS stop FROM l),
n AS (SELECT * FROM t WHERE NOT out_), p AS (SELECT a.page, a.id, a.v0, a.u0, b.id AS next, b.v0 AS gap FROM n a JOIN n b ON a.page = b.page AND a.id <> b.id AND a.up = b.up AND a.red = b.red AND abs(a.size - b.size) <= 0.25 * a.size AND b.v0 - a.v1 >= -1 AND b.v0 - a.v1 < greatest(3.5, 0.8 * (a.v1 - a.v0))
 AND (abs(a.u0 - b.u0) < 8 OR abs((a.u0 + a.u1 - b.u0 - b.u1) / 2) < 10 OR abs(a.u1 - b.u1) < 4) WHERE NOT b.stop AND regexp_matches(b.text, '[A-Za-z]{{3}}') AND NOT regexp_matches(b.text, '[0-9]')),
o AS (SELECT page, id, list(next ORDER BY gap, next) AS nexts, row_number() OVER (PARTITION BY page ORDER BY any_value(v0), any_value(u0), id) AS i FROM p GROUP BY page, id),
r AS (SELECT DISTINCT page, 0::BIGINT AS i, []::BIGINT[] AS taken, NULL::BIGINT AS prev, NULL::BIGINT AS id FROM o UNION ALL
 SELECT page, i, CASE WHEN pick IS NULL THEN taken ELSE list_append(taken, pick) END, prev, pick FROM (SELECT o.page, o.i, r.taken, o.id AS prev, list_filter(o.nexts, lambda x: NOT list_contains(r.taken, x))[1] AS pick FROM r JOIN o ON o.page = r.page AND o.i = r.i + 1)),
c AS (SELECT n.page, n.id, n.id AS head, 0 AS rank FROM n WHERE n.id NOT IN (SELECT id FROM r WHERE id IS NOT NULL) UNION ALL SELECT c.page, r.id, c.head, c.rank + 1 FROM c JOIN r ON r.prev = c.id AND r.id IS NOT NULL)
SELECT c.page, head AS id, trim(regexp_replace(replace(string_agg(text, ' ' ORDER BY rank), '|', ' '), '\\s+', ' ', 'g')) AS text, count(*) AS lines FROM c JOIN n ON n.id = c.id WHERE rank < 5 GROUP BY 1, 2 HAVING count(*) > 1""")
def labels_over_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of up to five lines, some upright, in two colours, with lines that are excluded or stop them."""
    part, supp, q, k = (F.col(c) for c in ("part", "supp", "q", "k"))
    l = _lines(spark, sf_dir).withColumn("u0", F.lit(40.0) * (q % 2) + part % 9).withColumn("u1", F.col("u0") + 20 + supp % 6).withColumn("v0", F.lit(12.0) * k + part % 3).withColumn("v1", F.col("v0") + 9)
    up = supp % 10 == 0
    # an upright text runs from the bottom up: its frame is turned back here
    box = {"x0": F.when(up, F.col("v0")).otherwise(F.col("u0")), "y0": F.when(up, -F.col("u1")).otherwise(F.col("v0")), "x1": F.when(up, F.col("v1")).otherwise(F.col("u1")), "y1": F.when(up, -F.col("u0")).otherwise(F.col("v1"))}
    text = F.element_at(F.array(*map(F.lit, _WORDS)), (part % 6 + 1).cast("int"))
    lines = l.withColumns(box).select("page", (F.col("page") * 10 + k).alias("id"), text.alias("text"), F.when(up, "up").otherwise("right").alias("way"), F.when(part % 4 == 0, "red").otherwise("black").alias("colour"), (F.lit(10.0) + supp % 4).alias("size"), *box, q)
    found = callout_chains(lines, F.col("q") % 25 == 0, F.col("q") % 23 == 0)
    return found.select("page", "id", "text", F.size("ids").cast("long").alias("lines"))


@query("""WITH c AS (SELECT l_orderkey AS sheet, CASE l_linenumber % 4 WHEN 0 THEN 'ground_level' WHEN 1 THEN 'formation' WHEN 2 THEN 'fill' ELSE 'cut_depth' END AS key, l_partkey % 10 * 20.0 AS pos, l_quantity AS value FROM lineitem WHERE l_returnflag <> 'R'),
p AS (SELECT l_orderkey AS sheet, l_linenumber * 100000 + l_partkey AS row, CASE WHEN l_suppkey % 7 > 0 THEN 'HEAD ' || l_suppkey END AS heading, l_partkey % 10 * 20.0 + (l_suppkey % 3) * 0.006 AS pos, floor(l_quantity / 2) * 2 AS value FROM lineitem),
m AS (SELECT c.sheet, c.key, arg_max(p.heading, p.row) AS heading FROM c JOIN p ON c.sheet = p.sheet AND p.heading IS NOT NULL AND abs(c.pos - p.pos) < 0.01 AND abs(c.value - p.value) < 1e-9 GROUP BY 1, 2)
SELECT c.sheet, c.key, coalesce(m.heading, CASE c.key WHEN 'ground_level' THEN 'GROUND LEVEL' WHEN 'fill' THEN 'FILL (m)' ELSE replace(c.key, '_', ' ') END) AS heading FROM (SELECT DISTINCT sheet, key FROM c) c LEFT JOIN m USING (sheet, key)""")
def headings_by_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series of a sheet (order) matched to the printed rows by position and first value, the last row winning."""
    l = table(spark, sf_dir, "lineitem")
    k, pos = F.col("l_linenumber") % 4, F.col("l_partkey") % 10 * F.lit(20.0)
    key = F.when(k == 0, "ground_level").when(k == 1, "formation").when(k == 2, "fill").otherwise("cut_depth")
    cells = l.where("l_returnflag <> 'R'").select(F.col("l_orderkey").alias("sheet"), key.alias("key"), pos.alias("pos"), F.col("l_quantity").cast("double").alias("value"))
    heading = F.when(F.col("l_suppkey") % 7 > 0, F.concat(F.lit("HEAD "), F.col("l_suppkey").cast("string")))
    row = F.col("l_linenumber") * 100000 + F.col("l_partkey")
    # rows that repeat an order, line and part: the first in the file
    seq = F.struct("_metadata.file_path", "_metadata.row_index").alias("seq")
    printed = l.select(F.col("l_orderkey").alias("sheet"), row.alias("row"), seq, heading.alias("heading"), (pos + F.col("l_suppkey") % 3 * F.lit(0.006)).alias("pos"), (F.floor(F.col("l_quantity") / 2) * 2).cast("double").alias("value"))
    return resolved_headings(cells, printed, {"ground_level": "GROUND LEVEL", "fill": "FILL (m)"})


_VARIED = ["c_custkey", "c_name", "c_mktsegment", "c_acctbal"]
_NAMES = {"c_name": ["name", "customer", "Name of firm"], "c_acctbal": ["balance", "sum"]}
_DRAW = "('0x' || substr(sha256('s1|{kind}|' || coalesce(c_nationkey::VARCHAR, '') || '|{c}'), 1, 8))::BIGINT"
_CELL = " , ".join(
    "CASE WHEN {there} THEN {{'place': {place}, 'column': '{c}', 'name': {name}, 'value': {value}}} END".format(
        c=c,
        there="true" if c == "c_custkey" else _DRAW.format(kind="drop", c=c) + " % 100 >= 25",
        place=_DRAW.format(kind="place", c=c),
        name=f"({_NAMES.get(c, [c])!r})[{_DRAW.format(kind='name', c=c)} % {len(_NAMES.get(c, [c]))} + 1]",
        value="c_acctbal::VARCHAR" if c == "c_acctbal" else f"{c}::VARCHAR",
    )
    for c in _VARIED
)


@query(f"""WITH k AS (SELECT c_nationkey, c_custkey, list_sort(list_filter([{_CELL}], lambda x: x IS NOT NULL)) AS cells FROM customer WHERE ('0x' || substr(sha256('s1|row|' || c_nationkey || '|' || c_custkey), 1, 8))::BIGINT % 100 < 80)
SELECT c_nationkey AS sheet, c_custkey AS row, array_to_string(list_transform(cells, lambda x: x.name || '=' || x.value), '; ') AS cells FROM k""")
def table_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table for each nation: columns dropped, shuffled and renamed by a seed, a fifth of the rows left out."""
    found = varied(table(spark, sf_dir, "customer"), "c_nationkey", "c_custkey", _VARIED, _NAMES, "s1", fixed=("c_custkey",))
    cells = F.array_join(F.transform("cells", lambda x: F.concat(x["name"], F.lit("="), x["value"])), "; ")
    return found.select(F.col("table").alias("sheet"), "row", cells.alias("cells"))


@query("SELECT CASE o_orderstatus WHEN 'F' THEN 'ok' WHEN 'O' THEN 'blocked' ELSE 'off' END AS status, o_orderkey % 3 AS batch, count(*) AS n FROM orders GROUP BY 1, 2")
def log_written_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Searches logged in three batches, two of them written again: nothing is there twice."""
    s = F.col("o_orderstatus")
    status = F.when(s == "F", "ok").when(s == "O", "blocked").otherwise("off")
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("search"), status.alias("status"))
    log = Log(spark, fresh_path(spark, "log"), "search long, status string")
    for batch in (0, 1, 2, 1, 0):
        log.append(rows.where(F.col("search") % 3 == batch), batch)
    return log.read().groupBy("status", "batch").agg(F.count("*").alias("n"))


@query("SELECT user_id AS sheet, count(*) FILTER (WHERE event_type = 'view') AS view, count(*) FILTER (WHERE event_type = 'click') AS click, count(*) FILTER (WHERE event_type = 'error') AS error FROM events GROUP BY 1")
def sheet_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many things of each kind a sheet has, written as CSV and read back."""
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("sheet"), "event_type")
    return write_index(rows, "sheet", "event_type", ["view", "click", "error"], fresh_path(spark, "index"))


@query(f"""WITH l AS ({_LINES}), s AS (SELECT page, k, CASE flag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS grp, q FROM l), c AS (SELECT *, count(*) OVER w AS n, sum(q) OVER w AS upto FROM s WINDOW w AS (PARTITION BY page ORDER BY grp, q DESC, k ROWS UNBOUNDED PRECEDING)),
o AS (SELECT *, max(CASE WHEN grp <> 1 AND (n > 4 OR upto > 90) THEN 1 ELSE 0 END) OVER (PARTITION BY page ORDER BY grp, q DESC, k ROWS UNBOUNDED PRECEDING) AS ended FROM c)
SELECT page, k, grp FROM o WHERE ended = 0""")
def budgeted_with_forced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Core lines, forced ones, then the rest by size, up to four lines or 90 in all; forced ones go beyond, but count."""
    group = F.when(F.col("flag") == "A", 0).when(F.col("flag") == "N", 1).otherwise(2)
    rows = _lines(spark, sf_dir).withColumn("grp", group)
    return budgeted(rows, ["page"], [F.asc("grp"), F.desc("q"), F.asc("k")], F.col("q"), F.col("grp") == 1, 4, 90).select("page", "k", "grp")


@query("""SELECT 'S-' || p_partkey AS sheet_id, CASE WHEN p_size > 40 THEN 'R12' WHEN p_size > 25 THEN 'R10' ELSE 'R2' END AS revision,
CASE WHEN p_size > 40 THEN 'R12 after R2, R10' WHEN p_size > 25 THEN 'R10 after R2' ELSE 'R2 is the first' END AS status FROM part""")
def version_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is stored of each sheet, in words: its latest revision and those before it."""
    store, p = Store(spark, fresh_path(spark, "store")), table(spark, sf_dir, "part")
    few = lambda least: p.where(F.col("p_size") > least).select(F.format_string("S-%d", "p_partkey").alias("sheet_id"))
    for revision, least in (("R10", 25), ("R2", -1), ("R12", 40), ("R10", 25)):
        store.add(_sheets(spark, sf_dir, revision).join(few(least), "sheet_id", "left_semi"))
    return store.status()


@query(f"""WITH b AS ({_BOX}), p AS (SELECT *, c, CASE c WHEN 'corners' THEN x + 3.2 ELSE x + 3.2 - x * (vec_id % 2) END AS px, CASE c WHEN 'corners' THEN y + 2.9 ELSE y + 2.9 - y * (vec_id % 2) END AS py FROM b, (VALUES ('corners'), ('sizes')) v(c)),
i AS (SELECT *, greatest(least(x + 3, px) - x, 0) * greatest(least(y + 3, py) - y, 0) AS shared, greatest(px - x, 0) * greatest(py - y, 0) AS own FROM p), a AS (SELECT c, floor(avg(shared / (9 + own - shared)) * 1e6 + 0.5) / 1e6 AS agreement, count(*) AS n FROM i GROUP BY 1)
SELECT c AS convention, agreement, n, agreement = max(agreement) OVER () AS best FROM a""")
def box_convention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which reading of predicted boxes, as corners or (for odd vectors) as sizes, agrees best with the references on average."""
    corner = F.array(F.struct(F.lit("corners").alias("c"), (F.col("x") + 3.2).alias("px"), (F.col("y") + 2.9).alias("py")), F.struct(F.lit("sizes").alias("c"), (F.col("x") + 3.2 - F.col("x") * (F.col("vec_id") % 2)).alias("px"), (F.col("y") + 2.9 - F.col("y") * (F.col("vec_id") % 2)).alias("py")))
    p = boxes(spark, sf_dir).select("x", "y", F.explode(corner).alias("p")).select("x", "y", "p.*")
    zero = F.lit(0.0)
    shared = F.greatest(F.least(F.col("x") + 3, "px") - F.col("x"), zero) * F.greatest(F.least(F.col("y") + 3, "py") - F.col("y"), zero)
    own = F.greatest(F.col("px") - F.col("x"), zero) * F.greatest(F.col("py") - F.col("y"), zero)
    means = p.groupBy(F.col("c").alias("convention")).agg((F.floor(F.avg(shared / (9 + own - shared)) * 1e6 + 0.5) / 1e6).alias("agreement"), F.count("*").alias("n"))
    # two rows, one for each convention
    return means.join(F.broadcast(means.agg(F.max("agreement").alias("top")))).select("convention", "agreement", "n", (F.col("agreement") == F.col("top")).alias("best"))


@query(f"""WITH b AS ({_BOX}), j AS (SELECT r.page, r.vec_id AS ref, greatest(least(r.x, p.x) + 3 - greatest(r.x, p.x), 0) AS w, greatest(least(r.y, p.y) + 3 - greatest(r.y, p.y), 0) AS h FROM b r LEFT JOIN b p ON r.page = p.page AND r.vec_id <> p.vec_id),
m AS (SELECT page, ref, max(CASE WHEN w * h > 0 THEN w * h / (18 - w * h) ELSE 0 END) AS best FROM j GROUP BY 1, 2) SELECT page, floor(avg(best) * 1e6 + 0.5) / 1e6 AS agreement FROM m GROUP BY 1""")
def mean_box_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mean over a page's references of the best overlap that any other box has with them, 0 where none has."""
    b = boxes(spark, sf_dir)
    other = b.select("page", F.col("vec_id").alias("other"), F.col("x").alias("x2"), F.col("y").alias("y2"))
    shared = (F.least("x", "x2") + 3 - F.greatest("x", "x2")) * (F.least("y", "y2") + 3 - F.greatest("y", "y2"))
    best = close_by(b, other, ["page"], [("x", "x2", 3.0), ("y", "y2", 3.0)]).where("vec_id <> other").groupBy("vec_id").agg(F.max(shared / (18 - shared)).alias("best"))
    means = b.join(best, "vec_id", "left").groupBy("page").agg(F.avg(F.coalesce("best", F.lit(0.0))).alias("mean"))
    return means.select("page", (F.floor(F.col("mean") * 1e6 + 0.5) / 1e6).alias("agreement"))
