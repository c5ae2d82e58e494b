"""Layout operators on boxes: assignment, neighbours, near duplicates, tiles, rulers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.operators.positional import close_by
from plumbline.plans.evaluate import _BOX, boxes
from plumbline.query import query, table


@query(f"""WITH b AS ({_BOX}), r AS (SELECT k AS region, -3.0 + 2 * (k % 3) AS x0, -3.0 + 2 * (k // 3) AS y0 FROM range(9) AS t(k))
SELECT vec_id, min(region) AS region FROM b JOIN r ON x >= x0 AND x <= x0 + 2.5 AND y >= y0 AND y <= y0 + 2.5 GROUP BY 1""")
def point_to_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first of nine regions that holds a point; regions are a table of fixed size."""
    r = spark.range(9).select(F.col("id").alias("region"), (-3.0 + 2 * (F.col("id") % 3)).alias("x0"), (-3.0 + 2 * F.floor(F.col("id") / 3)).alias("y0"))
    hit = F.col("x").between(F.col("x0"), F.col("x0") + 2.5) & F.col("y").between(F.col("y0"), F.col("y0") + 2.5)
    return boxes(spark, sf_dir).join(F.broadcast(r), hit).groupBy("vec_id").agg(F.min("region").alias("region"))


@query(f"""WITH b AS ({_BOX}), r AS (SELECT k AS region, -3.0 + 2 * (k % 3) AS x0, -3.0 + 2 * (k // 3) AS y0 FROM range(9) AS t(k)),
o AS (SELECT vec_id, region, floor(greatest(least(x + 3, x0 + 2.5) - greatest(x, x0), 0) * greatest(least(y + 3, y0 + 2.5) - greatest(y, y0), 0) * 1e6) AS shared FROM b, r)
SELECT vec_id, arg_max(region, (shared, -region)) AS region FROM o WHERE shared > 0 GROUP BY 1""")
def box_to_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The region that a box shares the largest area with, the first of equals; regions are a table of nine rows."""
    r = spark.range(9).select(F.col("id").alias("region"), (-3.0 + 2 * (F.col("id") % 3)).alias("x0"), (-3.0 + 2 * F.floor(F.col("id") / 3)).alias("y0"))
    side = lambda c: F.greatest(F.least(F.col(c) + 3, F.col(f"{c}0") + 2.5) - F.greatest(c, f"{c}0"), F.lit(0.0))
    rows = boxes(spark, sf_dir).join(F.broadcast(r)).withColumn("shared", F.floor(side("x") * side("y") * 1e6)).where("shared > 0")
    return rows.groupBy("vec_id").agg(F.max_by("region", F.struct("shared", -F.col("region"))).alias("region"))


@query(f"""WITH b AS ({_BOX}) SELECT a.vec_id, arg_min(c.vec_id, struct_pack(d := c.y - a.y, v := c.vec_id)) AS below FROM b a JOIN b c ON a.page = c.page AND c.y > a.y AND c.y - a.y < 2 AND abs(c.x - a.x) < 1 GROUP BY 1""")
def neighbour_below(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = boxes(spark, sf_dir)
    c = b.select("page", F.col("vec_id").alias("other"), F.col("x").alias("x2"), F.col("y").alias("y2"))
    j = close_by(b, c, ["page"], [("x", "x2", 1.0), ("y", "y2", 2.0)]).where("y2 > y")
    return j.groupBy("vec_id").agg(F.min_by("other", F.struct((F.col("y2") - F.col("y")).alias("d"), "other")).alias("below"))


@query(f"""WITH b AS (SELECT *, vec_id % 5 AS word FROM ({_BOX})) SELECT vec_id FROM b a WHERE NOT EXISTS (SELECT 1 FROM b c WHERE c.page = a.page AND c.word = a.word AND c.vec_id < a.vec_id AND abs(c.x - a.x) < 1 AND abs(c.y - a.y) < 1)""")
def near_duplicate_text_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without an earlier one of the same text close by."""
    b = boxes(spark, sf_dir).withColumn("word", F.col("vec_id") % 5)
    c = b.select("page", "word", F.col("vec_id").alias("other"), F.col("x").alias("x2"), F.col("y").alias("y2"))
    later = close_by(b, c, ["page", "word"], [("x", "x2", 1.0), ("y", "y2", 1.0)]).where("other < vec_id").select("vec_id").distinct()
    return b.join(later, "vec_id", "left_anti").select("vec_id")


@query("""SELECT p_partkey, i::INTEGER AS i, j::INTEGER AS j, least(i * 40, greatest(p_size * 10 - 50, 0))::INTEGER AS x, least(j * 40, greatest(p_size * 6 - 50, 0))::INTEGER AS y
FROM part, unnest(range(0, greatest(ceil((p_size * 10 - 50) / 40.0), 0)::BIGINT + 1)) AS a(i), unnest(range(0, greatest(ceil((p_size * 6 - 50) / 40.0), 0)::BIGINT + 1)) AS b(j)""")
def tile_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles of 50 every 40, the last ones flush with the edge."""
    steps = lambda size: F.greatest(F.ceil((size - 50) / 40.0), F.lit(0)).cast("int")
    w, h = F.col("p_size") * 10, F.col("p_size") * 6
    t = table(spark, sf_dir, "part").select("p_partkey", w.alias("w"), h.alias("h"), F.explode(F.sequence(F.lit(0), steps(w))).alias("i")).select("*", F.explode(F.sequence(F.lit(0), steps(F.col("h")))).alias("j"))
    flush = lambda k, size: F.least(F.col(k) * 40, F.greatest(F.col(size) - 50, F.lit(0)))
    return t.select("p_partkey", "i", "j", flush("i", "w").alias("x"), flush("j", "h").alias("y"))


@query("SELECT p_partkey, (ceil(p_size * 7 / 32.0) * 32)::BIGINT AS padded, (p_size * 28 // 32) * (p_size * 35 // 32) AS tokens FROM part")
def image_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("p_size")
    return table(spark, sf_dir, "part").select("p_partkey", (F.ceil(s * 7 / 32.0) * 32).cast("long").alias("padded"), (F.floor(s * 28 / 32) * F.floor(s * 35 / 32)).cast("int").alias("tokens"))


@query("SELECT p_partkey, (p_partkey * 7919 % 16777216) // 65536 AS r, (p_partkey * 7919 % 16777216) // 256 % 256 AS g, (p_partkey * 7919 % 16777216) % 256 AS b FROM part")
def colour_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from plumbline.functions.parse import colour

    c = colour(F.col("p_partkey") * 7919 % 16777216)
    return table(spark, sf_dir, "part").select("p_partkey", c[0].alias("r"), c[1].alias("g"), c[2].alias("b"))


@query(f"""WITH b AS ({_BOX}) SELECT vec_id, count(*) OVER (PARTITION BY page ORDER BY y, vec_id) AS row_no, floor((x * 0.6 + y * 0.8) * 1000 + 0.5) / 1000 AS along, floor((y * 0.6 - x * 0.8) * 1000 + 0.5) / 1000 AS offset_ FROM b""")
def reading_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coordinates along and across a direction, and the order of rows on a page."""
    r3 = lambda v: F.floor(v * 1000 + 0.5) / 1000
    w = Window.partitionBy("page").orderBy("y", "vec_id")
    return boxes(spark, sf_dir).select("vec_id", F.row_number().over(w).alias("row_no"), r3(F.col("x") * 0.6 + F.col("y") * 0.8).alias("along"), r3(F.col("y") * 0.6 - F.col("x") * 0.8).alias("offset_"))
