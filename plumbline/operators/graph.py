"""Components of links and ranks along chains, as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.scratch import scratch, written


def components(links: DataFrame) -> DataFrame:
    """(node, comp): the least node of the component of each node of ``links`` (a, b); nodes are of any type with an order.

    In every round a node goes to the one with the least hash among itself and its neighbours, and links are drawn between
    the nodes that are left; other hashes each round make long paths shrink by a share, not by one node. Repeated links and
    links to itself are harmless; nulls link nothing."""
    with scratch(links.sparkSession):
        left = links.where("a is not null and b is not null").select("a", "b").distinct()
        labels = written(left.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("comp", F.col("node")), "nodes")
        left, k = written(left.where("a <> b"), "links"), 0
        while not left.isEmpty():
            both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
            draw = lambda c, k=k: F.struct(F.xxhash64(c, F.lit(k)).alias("h"), F.col(c).alias("n"))
            goes = written(both.groupBy("a").agg(F.least(F.min(draw("b")), F.min(draw("a")))["n"].alias("to")).withColumnRenamed("a", "was"), "goes")
            moved = lambda rows, c: rows.join(goes, F.col(c) == F.col("was"), "left").withColumn(c, F.coalesce("to", c)).drop("was", "to")
            labels = written(moved(labels, "comp"), "nodes")
            left, k = written(moved(moved(left, "a"), "b").where("a <> b").distinct(), "links"), k + 1
        least = labels.groupBy("comp").agg(F.min("node").alias("least"))
        return written(labels.join(least, "comp").select("node", F.col("least").alias("comp")), "components", keep=True)


def linked(pairs: DataFrame) -> DataFrame:
    """(id, prev) of ``pairs`` (id, prev) and, with a null prev, of the heads they name: links for ``chains`` without what stands alone."""
    heads = pairs.select(F.col("prev").alias("id")).join(pairs.select("id"), "id", "left_anti")
    return pairs.select("id", "prev").unionByName(heads.withColumn("prev", F.lit(None).cast(pairs.schema["prev"].dataType)))


def chains(links: DataFrame) -> DataFrame:
    """(id, head, rank) of every row of ``links`` (id, prev): the first of its chain and how many rows lie between.

    ``prev`` is null for heads, and names a row; no links go round. A row looks twice as far back in each round."""
    with scratch(links.sparkSession):
        rows = links.select("id", F.coalesce("prev", "id").alias("head"), F.when(F.col("prev").isNull(), 0).otherwise(1).cast("long").alias("rank"))
        rows = written(rows.withColumn("done", F.col("rank") == 0), "chains")
        while not rows.where("not done").isEmpty():
            on = rows.select(F.col("id").alias("head"), F.col("head").alias("next"), F.col("rank").alias("more"))
            jumped = rows.where("not done").join(on, "head").select("id", F.col("next").alias("head"), (F.col("rank") + F.col("more")).alias("rank"), (F.col("more") == 0).alias("done"))
            rows = written(rows.where("done").unionByName(jumped), "chains")
        return written(rows.drop("done"), "chained", keep=True)
