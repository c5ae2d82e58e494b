"""Page queries: components of occupied cells, the view of a point, contained readings, joined pieces, tables from words.

Boxes come from the vectors, words and pieces from the lines of orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.operators import grid, pieces
from plumbline.query import query, table


@query("""WITH RECURSIVE c AS (SELECT DISTINCT vec_id % 20 AS page, floor(embedding[1] * 20)::BIGINT AS y, floor(embedding[2] * 20)::BIGINT AS x FROM embeddings), n AS (SELECT page, y, x, (y + 100) * 1000 + x + 100 AS id FROM c),
e AS (SELECT a.page, a.id AS a, b.id AS b FROM n a JOIN n b ON a.page = b.page AND abs(a.y - b.y) + abs(a.x - b.x) = 1), r(page, a, b) AS (SELECT page, id, id FROM n UNION SELECT r.page, r.a, e.b FROM r JOIN e ON r.page = e.page AND r.b = e.a),
m AS (SELECT page, a, min(b) AS root FROM r GROUP BY 1, 2), s AS (SELECT page, root, count(*) AS cells FROM m GROUP BY 1, 2) SELECT page, row_number() OVER (PARTITION BY page ORDER BY root) - 1 AS comp, cells FROM s""")
def occupancy_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of the occupied cells of each page, numbered by their least cell, and their sizes."""
    cells = table(spark, sf_dir, "embeddings").select((F.col("vec_id") % 20).alias("page"), F.floor(F.col("embedding")[0] * 20).alias("y"), F.floor(F.col("embedding")[1] * 20).alias("x"))
    sizes = grid.components(cells).groupBy("page", F.col("comp").alias("root")).agg(F.count("*").alias("cells"))
    return sizes.select("page", (F.row_number().over(Window.partitionBy("page").orderBy("root")) - 1).cast("long").alias("comp"), "cells")


_PLACED = "SELECT vec_id, vec_id % 49 AS page, embedding[1]::DOUBLE * 60 AS x0, embedding[2]::DOUBLE * 60 AS y0 FROM embeddings"


def _placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", (F.col("vec_id") % 49).alias("page"), (F.col("embedding")[0].cast("double") * 60).alias("x0"), (F.col("embedding")[1].cast("double") * 60).alias("y0"))


@query(f"""WITH RECURSIVE p AS ({_PLACED}), b AS (SELECT page, x0, y0, unnest(range(floor(y0 / 2)::BIGINT - 1, floor((y0 + 3) / 2)::BIGINT + 2)) AS y FROM p), c AS (SELECT DISTINCT page, y, unnest(range(floor(x0 / 2)::BIGINT - 1, floor((x0 + 3) / 2)::BIGINT + 2)) AS x FROM b),
n AS (SELECT page, y, x, (y + 500) * 1000 + x + 500 AS id FROM c), e AS (SELECT a.page, a.id AS a, b.id AS b FROM n a JOIN n b ON a.page = b.page AND ((a.y = b.y AND abs(a.x - b.x) = 1) OR (a.x = b.x AND abs(a.y - b.y) = 1))),
r(page, a, b) AS (SELECT page, id, id FROM n UNION SELECT r.page, r.a, e.b FROM r JOIN e ON r.page = e.page AND r.b = e.a), m AS (SELECT page, a AS id, min(b) AS root FROM r GROUP BY 1, 2),
t AS (SELECT m.page, m.root, min(p.vec_id) AS view FROM p JOIN m ON m.page = p.page AND m.id = (floor((p.y0 + 1.5) / 2)::BIGINT + 500) * 1000 + floor((p.x0 + 1.5) / 2)::BIGINT + 500 WHERE p.vec_id % 4 = 0 GROUP BY 1, 2),
o AS (SELECT n.page, n.y, n.x, t.view FROM n JOIN m ON n.page = m.page AND n.id = m.id JOIN t ON t.page = m.page AND t.root = m.root),
q AS (SELECT page, vec_id AS point, x0 + vec_id % 9 AS x, y0 - vec_id % 7 AS y FROM p WHERE vec_id % 4 = 1),
h AS (SELECT q.page, q.point, o.view, greatest(abs(o.y - floor(q.y / 2)), abs(o.x - floor(q.x / 2))) AS ring, count(*) AS k FROM q JOIN o ON q.page = o.page AND abs(o.y - floor(q.y / 2)) <= 2 AND abs(o.x - floor(q.x / 2)) <= 2 GROUP BY 1, 2, 3, 4),
v AS (SELECT page, point, arg_min(view, (ring, -k, view)) AS view FROM h GROUP BY 1, 2),
w AS (SELECT q.page, q.point, arg_min(p.vec_id, ((12 + p.vec_id % 5) * 12, p.vec_id)) AS view FROM q JOIN p ON p.page = q.page AND p.vec_id % 4 = 2 AND q.x BETWEEN p.x0 - 8 AND p.x0 + 8 + p.vec_id % 5 AND q.y BETWEEN p.y0 - 8 AND p.y0 + 8 WHERE NOT EXISTS (SELECT 1 FROM v WHERE v.point = q.point) GROUP BY 1, 2)
SELECT * FROM v UNION ALL SELECT * FROM w""")
def view_of_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points to the views that own the drawing around them, else to the smallest view box.

    Boxes of three by three, spread by a cell, make up the drawing; a component belongs to the least title (every fourth box) in it;
    every other fourth box is the corner of a view box."""
    p = _placed(spark, sf_dir)
    drawn = grid.dilated(grid.cells_of_boxes(p.select("page", "x0", "y0", (F.col("x0") + 3).alias("x1"), (F.col("y0") + 3).alias("y1")), 2.0), 1)
    cells = grid.components(drawn)
    at = lambda c: F.floor((F.col(c) + 1.5) / 2).cast("long")
    titles = p.where("vec_id % 4 = 0").select("page", at("y0").alias("y"), at("x0").alias("x"), "vec_id")
    owners = titles.join(cells, ["page", "y", "x"]).groupBy("page", "comp").agg(F.min("vec_id").alias("view"))
    owned = cells.join(owners, ["page", "comp"]).select("page", "y", "x", "view")
    k = F.col("vec_id")
    views = p.where("vec_id % 4 = 2").select("page", k.alias("view"), (F.col("x0") - 6).alias("x0"), (F.col("y0") - 6).alias("y0"), (F.col("x0") + 6 + k % 5).alias("x1"), (F.col("y0") + 6).alias("y1"))
    points = p.where("vec_id % 4 = 1").select("page", k.alias("point"), (F.col("x0") + k % 9).alias("x"), (F.col("y0") - k % 7).alias("y"))
    return grid.views_of_points(points, owned, views, 2.0)


@query(f"""WITH RECURSIVE p AS ({_PLACED}), t AS (SELECT page, vec_id AS id, 1 + vec_id * 7 % 13 AS n, x0, y0, x0 + 4 + vec_id * 7 % 13 AS x1, y0 + 5 + vec_id % 3 AS y1 FROM p),
o AS (SELECT *, row_number() OVER (PARTITION BY page ORDER BY n DESC, id) AS i FROM t),
r AS (SELECT DISTINCT page, 0::BIGINT AS i, []::STRUCT(x0 DOUBLE, y0 DOUBLE, x1 DOUBLE, y1 DOUBLE)[] AS kept, NULL::BIGINT AS id, false AS keeps FROM o UNION ALL
 SELECT page, i, CASE WHEN keeps THEN list_append(kept, b) ELSE kept END, id, keeps FROM (SELECT *, NOT covered AS keeps FROM (
  SELECT o.page, o.i, o.id, r.kept, {{'x0': o.x0, 'y0': o.y0, 'x1': o.x1, 'y1': o.y1}} AS b,
   len(list_filter(r.kept, lambda k: greatest(least(k.x1, o.x1) - greatest(k.x0, o.x0), 0) * greatest(least(k.y1, o.y1) - greatest(k.y0, o.y0), 0) > 0.6 * (o.x1 - o.x0) * (o.y1 - o.y0))) > 0 AS covered
  FROM r JOIN o ON o.page = r.page AND o.i = r.i + 1)))
SELECT page, id FROM r WHERE keeps""")
def readings_not_contained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings without those inside a longer one that stays."""
    k = F.col("vec_id") * 7 % 13
    texts = _placed(spark, sf_dir).select("page", F.col("vec_id").alias("id"), F.repeat(F.lit("x"), (k + 1).cast("int")).alias("text"), "x0", "y0", (F.col("x0") + 4 + k).alias("x1"), (F.col("y0") + 5 + F.col("vec_id") % 3).alias("y1"))
    return pieces.without_contained(texts).select("page", "id")


#: One line of an order: the least of those that repeat its number.
_LINES = "SELECT l_orderkey AS page, l_linenumber AS k, min(l_partkey)::BIGINT AS part, min(l_suppkey)::BIGINT AS supp, min(l_quantity)::BIGINT AS q, min(l_returnflag) AS flag FROM lineitem GROUP BY 1, 2"


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").cast("long").alias("page"), F.col("l_linenumber").cast("long").alias("k"))
    return l.agg(F.min("l_partkey").alias("part"), F.min("l_suppkey").alias("supp"), F.min("l_quantity").cast("long").alias("q"), F.min("l_returnflag").alias("flag"))


@query(f"""WITH RECURSIVE l AS ({_LINES}), t AS (SELECT page, page * 10 + k AS id, q::VARCHAR AS text, 40.0 * k + part % 12 AS x0, 40.0 * k + part % 12 + 28 AS x1, 5.0 * (supp % 2) + part % 3 AS y0, 5.0 * (supp % 2) + part % 3 + 8 AS y1, 10.0 + part % 4 AS size FROM l),
m AS (SELECT a.page, a.id, b.id AS prev, a.x0 - b.x1 AS gap FROM t a JOIN t b ON a.page = b.page AND a.id <> b.id AND a.x0 - b.x1 >= 0 AND a.x0 - b.x1 < 0.9 * greatest(a.size, b.size) AND abs((a.y0 + a.y1 - b.y0 - b.y1) / 2) < 0.35 * greatest(a.size, b.size)),
n AS (SELECT id, arg_min(prev, (gap, prev)) AS prev, min(gap) AS gap FROM m GROUP BY 1), o AS (SELECT prev, arg_min(id, (gap, id)) AS id FROM n GROUP BY 1),
r AS (SELECT t.id, t.id AS head, 0 AS rank FROM t WHERE t.id NOT IN (SELECT id FROM o) UNION ALL SELECT o.id, r.head, r.rank + 1 FROM r JOIN o ON o.prev = r.id)
SELECT page, head AS id, string_agg(text, ' ' ORDER BY rank) AS text, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1, count(*) AS pieces FROM r JOIN t USING (id) GROUP BY 1, 2""")
def lines_from_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of text that lie on one line, a word's gap apart, as lines."""
    l = _lines(spark, sf_dir)
    x0, y0 = F.lit(40.0) * F.col("k") + F.col("part") % 12, F.lit(5.0) * (F.col("supp") % 2) + F.col("part") % 3
    texts = l.select("page", (F.col("page") * 10 + F.col("k")).alias("id"), F.col("q").cast("string").alias("text"), x0.alias("x0"), y0.alias("y0"), (x0 + 28).alias("x1"), (y0 + 8).alias("y1"), (F.lit(10.0) + F.col("part") % 4).alias("size"))
    return pieces.joined_pieces(texts)


@query(f"""WITH l AS ({_LINES}), s AS (SELECT *, 25.0 * k + part % 3 AS top FROM l),
w AS (SELECT page, (k * 10)::BIGINT AS id, 'A' || k AS text, 20.0 AS x0, top AS y0 FROM s UNION ALL SELECT page, k * 10 + 1, q::VARCHAR, 100.0 + part % 9, top + supp % 5 - 2 FROM s UNION ALL SELECT page, k * 10 + 2, 'of', 190.0 - supp % 8, top + part % 6 FROM s
 UNION ALL SELECT page, k * 10 + 3, part::VARCHAR, 185.0 - part % 10, top + 9 FROM s WHERE part % 4 > 0 UNION ALL SELECT page, k * 10 + 4, flag, 270.0 + q % 7, top + 1 FROM s WHERE flag <> 'R'),
c AS (SELECT *, x0 + 15 AS cx, y0 + 4 AS cy, text LIKE 'A%' AND id % 10 = 0 AS anchor FROM w), a AS (SELECT page, y0, arg_min(id, (x0, id)) AS row, arg_min(cy, (x0, id)) AS at_ FROM c WHERE anchor GROUP BY 1, 2),
n AS (SELECT page, count(*) AS rows FROM a GROUP BY 1), d AS (SELECT DISTINCT c.page, c.id, c.cx FROM c JOIN a ON a.page = c.page AND abs(c.cy - a.at_) < 4),
g AS (SELECT *, sum(new) OVER (PARTITION BY page ORDER BY cx, id) AS cluster FROM (SELECT *, CASE WHEN cx - lag(cx) OVER (PARTITION BY page ORDER BY cx, id) < 22 THEN 0 ELSE 1 END AS new FROM d)),
h AS (SELECT g.page, cluster, avg(cx) AS centre FROM g JOIN n ON n.page = g.page GROUP BY 1, 2, rows HAVING count(*) >= CASE WHEN rows <= 3 THEN 1 ELSE greatest(2, rows // 3) END),
k AS (SELECT page, list(centre ORDER BY centre) AS centres FROM h GROUP BY 1 HAVING count(*) = 4),
p AS (SELECT c.*, a.row, row_number() OVER (PARTITION BY c.page, c.id ORDER BY a.y0 DESC, a.row DESC) AS rn FROM c JOIN a ON a.page = c.page AND a.y0 - 12 <= c.cy),
z AS (SELECT p.page, p.row, p.text, p.y0, p.x0, p.id, list_transform(centres, lambda x: abs(x - cx)) AS away FROM p JOIN k ON k.page = p.page WHERE rn = 1)
SELECT page, row, list_position(away, list_min(away))::BIGINT AS "column", string_agg(text, ' ' ORDER BY y0, x0, id) AS text FROM z GROUP BY 1, 2, 3""")
def table_from_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loose words, some off their line, some cells of two words or none, as a table of four columns."""
    s = _lines(spark, sf_dir).withColumn("top", F.lit(25.0) * F.col("k") + F.col("part") % 3)
    word = lambda n, text, x, y, there=F.lit(True): F.when(there, F.struct((F.col("k") * 10 + n).alias("id"), text.alias("text"), x.cast("double").alias("x0"), (F.col("top") + y).alias("y0")))
    part, supp, q = F.col("part"), F.col("supp"), F.col("q")
    made = F.array(
        word(0, F.concat(F.lit("A"), F.col("k").cast("string")), F.lit(20.0), F.lit(0)),
        word(1, q.cast("string"), 100 + part % 9, supp % 5 - 2),
        word(2, F.lit("of"), 190 - supp % 8, part % 6),
        word(3, part.cast("string"), 185 - part % 10, F.lit(9), part % 4 > 0),
        word(4, F.col("flag"), 270 + q % 7, F.lit(1), F.col("flag") != "R"),
    )
    w = s.select("page", F.explode(made).alias("w")).where("w is not null").select("page", "w.*").withColumns({"x1": F.col("x0") + 30, "y1": F.col("y0") + 8})
    return pieces.table_of_words(w, F.col("text").startswith("A") & (F.col("id") % 10 == 0), 4)
