"""The lookup surface: one row of a question (kind and arguments) to rows of an answer; errors are values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators import positional
from plumbline.query import query, table

#: Rows of items or sheets for each task of a join on positions: its pairs grow faster than its rows.
DEALT = 5_000

KINDS = ("item", "range", "containing", "versions", "term")


class Lookups:
    """Index over items (line, key, pos), sheets (line, sheet, low, high) and notes (sheet, text). All are DataFrames."""

    def __init__(self, items: DataFrame, sheets: DataFrame, notes: DataFrame):
        self.items, self.sheets, self.notes = items, sheets, notes

    def answer(self, kind: str, **ask) -> DataFrame:
        """Rows for a question; ``error`` is set where the arguments cannot be answered."""
        spark = self.items.sparkSession
        need = {"item": {"line", "key"}, "range": {"line", "low", "high"}, "containing": {"line", "pos"}, "versions": {"line", "sheet"}, "term": {"term"}}
        if kind not in need:
            return spark.createDataFrame([(f"unknown kind {kind}",)], "error string")
        missing = sorted(need[kind] - {k for k, v in ask.items() if v is not None})
        if missing:
            return spark.createDataFrame([("missing " + ", ".join(missing),)], "error string")
        none = F.lit(None).cast("string").alias("error")
        if kind == "item":
            return self.items.where((F.col("line") == F.lit(ask["line"])) & (F.col("key") == F.lit(ask["key"]))).select("*", none)
        if kind == "range":
            return self.items.where((F.col("line") == F.lit(ask["line"])) & F.col("pos").between(F.lit(ask["low"]), F.lit(ask["high"]))).orderBy(F.asc_nulls_last("pos")).select("*", none)
        if kind == "containing":
            return self.sheets.where((F.col("line") == F.lit(ask["line"])) & F.lit(ask["pos"]).between(F.col("low"), F.col("high"))).select("*", none)
        if kind == "versions":
            return self.sheets.where((F.col("line") == F.lit(ask["line"])) & (F.col("sheet") == F.lit(ask["sheet"]))).select("*", none)
        if len(ask["term"]) < 2:
            return spark.createDataFrame([("a term has two characters or more",)], "error string")
        return self.notes.where(F.contains(F.lower("text"), F.lit(ask["term"].lower()))).select("*", none)

    def answer_all(self, questions: DataFrame, range_bin: float = 25.0, sheet_bin: float = 1_000.0) -> DataFrame:
        """(qid, key, sheet, error) for a table of questions: qid, kind (item, range, containing or versions), line, key, low,
        high, pos, sheet. Each kind is one join for all its questions; a question that lacks an argument, or is of no known kind,
        has one row with the error as ``answer`` words it, and one without an answer has none. The bins are narrow against ranges and
        sheets, so that a question meets few rows that it does not hold, and many tasks share a line."""
        need = {"item": ("key", "line"), "range": ("high", "line", "low"), "containing": ("line", "pos"), "versions": ("line", "sheet")}
        lacks = F.lit(None).cast("string")
        for kind, names in need.items():
            lacks = F.when(F.col("kind") == kind, F.array_join(F.filter(F.array(*[F.when(F.col(n).isNull(), n) for n in names]), lambda x: x.isNotNull()), ", ")).otherwise(lacks)
        error = F.when(lacks.isNull(), F.concat(F.lit("unknown kind "), F.coalesce("kind", F.lit("")))).when(lacks != "", F.concat(F.lit("missing "), lacks))
        q = questions.withColumn("error", error)
        ask = lambda kind, *names: q.where((F.col("kind") == kind) & F.col("error").isNull()).select("qid", *names)
        none = lambda kind, name: F.lit(None).cast(kind).alias(name)
        dealt = lambda rows: rows.count() // DEALT + 1
        item = ask("item", "line", "key").join(self.items.select("line", "key"), ["line", "key"]).select("qid", "key", none("long", "sheet"))
        span = positional.containing_many(self.items.select("line", "key", "pos"), ask("range", "line", "low", "high"), "line", "pos", "low", "high", range_bin, dealt(self.items)).select("qid", "key", none("long", "sheet"))
        held = positional.containing_many(ask("containing", "line", "pos"), self.sheets.select("line", "sheet", "low", "high"), "line", "pos", "low", "high", sheet_bin, dealt(self.sheets)).select("qid", none("long", "key"), "sheet")
        same = ask("versions", "line", "sheet").join(self.sheets.select("line", "sheet"), ["line", "sheet"]).select("qid", none("long", "key"), "sheet")
        rows = item.unionByName(span).unionByName(held).unionByName(same).withColumn("error", F.lit(None).cast("string"))
        return rows.unionByName(q.where("error is not null").select("qid", none("long", "key"), none("long", "sheet"), "error"))


def lookups(spark: SparkSession, sf_dir: str) -> Lookups:
    o = table(spark, sf_dir, "orders")
    items = o.select(F.col("o_orderstatus").alias("line"), F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("pos"))
    sheets = o.select(F.col("o_orderstatus").alias("line"), F.col("o_orderkey").alias("sheet"), F.col("o_totalprice").alias("low"), (F.col("o_totalprice") + 20000).alias("high"))
    return Lookups(items, sheets, table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("sheet"), "text"))


@query("SELECT o_orderkey AS key, o_totalprice AS pos, NULL::VARCHAR AS error FROM orders WHERE o_orderstatus = 'F' AND o_totalprice BETWEEN 100000 AND 150000")
def lookup_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups(spark, sf_dir).answer("range", line="F", low=100000.0, high=150000.0).select("key", "pos", "error")


@query("SELECT o_orderkey AS sheet, NULL::VARCHAR AS error FROM orders WHERE o_orderstatus = 'O' AND 120000 BETWEEN o_totalprice AND o_totalprice + 20000")
def lookup_containing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups(spark, sf_dir).answer("containing", line="O", pos=120000.0).select("sheet", "error")


@query("SELECT item_id AS sheet, NULL::VARCHAR AS error FROM benchmark WHERE contains(lower(text), 'thing')")
def lookup_term(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups(spark, sf_dir).answer("term", term="Thing").select("sheet", "error")


@query("""WITH q AS (SELECT l_orderkey * 10 + l_linenumber AS qid, CASE l_linenumber WHEN 1 THEN 'item' WHEN 2 THEN 'range' WHEN 3 THEN CASE WHEN l_quantity < 3 THEN 'containing' ELSE 'versions' END WHEN 5 THEN 'curve' WHEN 6 THEN NULL ELSE 'item' END AS kind, CASE WHEN l_partkey % 9 > 0 THEN l_returnflag END AS flag, l_orderkey % 4000 AS k, l_extendedprice AS x, l_suppkey FROM lineitem),
a AS (SELECT DISTINCT qid, kind, CASE flag WHEN 'A' THEN 'F' WHEN 'N' THEN 'O' WHEN 'R' THEN 'P' END AS line, CASE WHEN k % 5 > 0 THEN k END AS key, CASE WHEN k % 6 > 0 THEN x END AS low, x + 300 AS high, x AS pos, k AS sheet FROM q),
o AS (SELECT o_orderstatus AS line, o_orderkey AS key, o_totalprice AS pos, o_totalprice + 20000 AS high FROM orders),
e AS (SELECT *, CASE WHEN kind IS NULL OR kind = 'curve' THEN 'unknown kind ' || coalesce(kind, '') ELSE nullif('missing ' || array_to_string(list_filter(CASE kind WHEN 'item' THEN [CASE WHEN key IS NULL THEN 'key' END, CASE WHEN line IS NULL THEN 'line' END] WHEN 'range' THEN [CASE WHEN line IS NULL THEN 'line' END, CASE WHEN low IS NULL THEN 'low' END] ELSE [CASE WHEN line IS NULL THEN 'line' END] END, lambda x: x IS NOT NULL), ', '), 'missing ') END AS error FROM a)
SELECT qid, NULL::BIGINT AS key, NULL::BIGINT AS sheet, error FROM e WHERE error IS NOT NULL UNION ALL SELECT qid, o.key, NULL, NULL FROM e JOIN o USING (line, key) WHERE kind = 'item' AND error IS NULL UNION ALL SELECT qid, o.key, NULL, NULL FROM e JOIN o ON e.line = o.line AND o.pos BETWEEN e.low AND e.high WHERE kind = 'range' AND error IS NULL
UNION ALL SELECT qid, NULL, o.key, NULL FROM e JOIN o ON e.line = o.line AND e.pos BETWEEN o.pos AND o.high WHERE kind = 'containing' AND error IS NULL UNION ALL SELECT qid, NULL, o.key, NULL FROM e JOIN o ON e.line = o.line AND e.sheet = o.key WHERE kind = 'versions' AND error IS NULL""")
def lookup_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions of four kinds, some without an argument, some of no kind, answered together; errors are values."""
    l = table(spark, sf_dir, "lineitem")
    n, k, x = F.col("l_linenumber"), F.col("l_orderkey") % 4000, F.col("l_extendedprice")
    kind = F.when(n == 2, "range").when(n == 3, F.when(F.col("l_quantity") < 3, "containing").otherwise("versions")).when(n == 5, "curve").when(n != 6, "item")
    line = F.when(F.col("l_partkey") % 9 > 0, F.when(F.col("l_returnflag") == "A", "F").when(F.col("l_returnflag") == "N", "O").otherwise("P"))
    # the other arguments follow from these, so equal questions are found by them
    q = l.select((F.col("l_orderkey") * 10 + n).alias("qid"), kind.alias("kind"), line.alias("line"), k.alias("sheet"), x.alias("pos")).distinct()
    asked, at = F.col("sheet"), F.col("pos")
    return lookups(spark, sf_dir).answer_all(q.withColumns({"key": F.when(asked % 5 > 0, asked), "low": F.when(asked % 6 > 0, at), "high": at + 300}))


@query("""WITH s AS (SELECT o_custkey AS line, o_orderkey AS sheet, o_totalprice AS low, o_totalprice + 20000 AS high FROM orders)
SELECT o_orderkey AS key, count(*) AS sheets, min(sheet) AS first_sheet FROM orders JOIN s ON line = o_custkey AND o_totalprice BETWEEN low AND high GROUP BY 1""")
def sheets_for_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many positions at once, a customer being a line: the binned interval join."""
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("line"), F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("pos"))
    sheets = o.select("line", F.col("key").alias("sheet"), F.col("pos").alias("low"), (F.col("pos") + 20000).alias("high"))
    return positional.containing(o, sheets, "line", "pos", "low", "high", True, 20000.0).groupBy("key").agg(F.count("*").alias("sheets"), F.min("sheet").alias("first_sheet"))
