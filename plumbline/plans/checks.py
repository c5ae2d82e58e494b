"""Checks of sheets, scores by task, replays and orders by group, on the tables as stand-ins for sheets and replies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.operators import positional, scoring
from plumbline.plans.positional import _EVENTS, events
from plumbline.query import query, table
from plumbline.scratch import fresh_path as scratch
from plumbline.sources.io import file_hashes, read_json_lines, unseen, write_csv, write_json_lines
from plumbline.sources.store import Store


@query("""WITH p AS (SELECT p_partkey, p_brand AS b, p_type AS t, CASE WHEN p_size % 5 <> 0 THEN p_size END AS s FROM part)
SELECT p_partkey, floor(((CASE WHEN p_partkey % 2 = 0 THEN 1 ELSE 0 END + 1 + CASE WHEN s % 3 = 0 THEN 1 ELSE 0 END) / (2.0 + CASE WHEN s IS NULL THEN 0 ELSE 1 END)) * 1000 + 0.5) / 1000 AS accuracy FROM (SELECT p_partkey, coalesce(s, 1) AS s0, s FROM p)""")
def field_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brand (right for even keys), type (always right) and size (right for multiples of 3, absent from some references)."""
    size = F.col("p_size")
    kept = F.when(size % 5 != 0, size.cast("string"))
    reference = F.create_map(F.lit("brand"), F.col("p_brand"), F.lit("type"), F.col("p_type"), F.lit("size"), kept)
    answer = F.create_map(F.lit("brand"), F.when(F.col("p_partkey") % 2 == 0, F.col("p_brand")).otherwise(F.lit("none")), F.lit("type"), F.col("p_type"), F.lit("size"), F.when(size % 3 == 0, size.cast("string")))
    return table(spark, sf_dir, "part").select("p_partkey", (F.floor(scoring.field_accuracy(answer, reference) * 1000 + 0.5) / 1000).alias("accuracy"))


@query("SELECT p_partkey, p_size % 3 <> 1 AND p_size % 4 <> 0 AS quoted FROM part")
def verdict_with_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    low, high = F.format_string("%d.25", size), F.format_string("%d.75", size)
    answer = F.concat(F.when(size % 3 == 1, "Perhaps").when(size % 2 == 0, "Yes").otherwise("No"), F.lit(": "), low, F.lit(" against "), F.when(size % 4 == 0, F.lit("that")).otherwise(high))
    return table(spark, sf_dir, "part").select("p_partkey", scoring.quotes_both(answer, size % 2 == 0, [low, high]).alias("quoted"))


@query("""SELECT event_id, event_id % 4 <> 3 AS flag_ok, event_id % 4 IN (0, 1, 2) AS think_ok, event_id % 4 IN (0, 1) AS json_ok, event_id % 4 = 0 AS tool_ok, event_id % 4 = 2 AS empty FROM events""")
def reply_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id") % 4
    reply = F.when(k == 0, '<think>so</think>{"name": "find", "arguments": {}}').when(k == 1, F.concat(F.lit("<think>so</think>"), "props")).when(k == 2, "<think>so</think> ").otherwise("<think>so, and then")
    return table(spark, sf_dir, "events").select("event_id", scoring.reply_flags(reply).alias("f")).select("event_id", "f.*")


_TASK = "CASE p_size % 4 WHEN 0 THEN 'values' WHEN 1 THEN 'absent' WHEN 2 THEN 'verdict' ELSE 'text' END"


@query(f"""SELECT {_TASK} AS task, count(*) AS n, sum(CASE p_size % 4 WHEN 0 THEN (p_partkey % 20 >= 18)::INTEGER WHEN 1 THEN (p_partkey % 2 = 0)::INTEGER WHEN 2 THEN (p_partkey % 3 = 0)::INTEGER ELSE 1 END)::BIGINT AS good FROM part GROUP BY 1""")
def score_by_task(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    task = F.expr(_TASK)
    answer = F.when(task == "absent", F.when(k % 2 == 0, "It is not given.").otherwise("It is not given, perhaps 7.")).when(task == "verdict", F.when(k % 3 == 0, "YES, it fits").otherwise("No")).otherwise(F.concat(F.lit("The  "), F.upper("p_name")))
    reference = F.when(task == "verdict", F.lit("yes")).otherwise(F.concat(F.lit("the "), "p_name"))
    rows = table(spark, sf_dir, "part").select(task.alias("task"), scoring.task_score(task, answer, reference, (k % 20) / 20.0).alias("good"))
    return rows.groupBy("task").agg(F.count("*").alias("n"), F.sum("good").alias("good"))


@query("""WITH r AS (SELECT l_orderkey, l_linenumber, l_shipmode AS tool, l_quantity AS was FROM lineitem), n AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_discount > 0.05 THEN l_quantity + 1 ELSE l_quantity END AS now FROM lineitem WHERE l_linenumber < 5)
SELECT l_orderkey AS task, count(*) FILTER (WHERE was = now) AS identical, count(*) FILTER (WHERE was <> now) AS different, count(*) FILTER (WHERE now IS NULL) AS missing FROM r LEFT JOIN n USING (l_orderkey, l_linenumber) GROUP BY 1""".replace(", l_shipmode AS tool", ""))
def replay_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recorded results of calls (lines of an order) against those of the same calls now; some calls are no longer there."""
    l = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("task"), F.col("l_linenumber").alias("call"), "l_quantity", "l_discount")
    live = l.where("call < 5").select("task", "call", F.when(F.col("l_discount") > 0.05, F.col("l_quantity") + 1).otherwise(F.col("l_quantity")).alias("result"))
    return scoring.replay(l.select("task", "call", F.col("l_quantity").alias("result")), live, ["task", "call"], "result")


@query("""WITH g AS (SELECT p_brand, count(*) FILTER (WHERE p_type = 'ECONOMY') > 0 AND count(*) >= 4 AS known FROM part GROUP BY 1)
SELECT p_brand, 'INFO' AS severity, NULL::BIGINT AS p_partkey FROM g WHERE NOT known UNION ALL SELECT p_brand, CASE WHEN p_size > 40 THEN 'FLAG' ELSE 'CHECK' END, p_partkey FROM part JOIN g USING (p_brand) WHERE known AND p_size > 30""")
def recognised_or_one_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sheet (brand) whose layout is not recognised gives one INFO and no rule runs on it."""
    p = table(spark, sf_dir, "part")
    known = ((F.count_if(F.col("p_type") == "ECONOMY") > 0) & (F.count("*") >= 4)).alias("known")
    sheets = p.groupBy("p_brand").agg(known)
    info = sheets.where("not known").select("p_brand", F.lit("INFO").alias("severity"), F.lit(None).cast("long").alias("p_partkey"))
    found = p.where("p_size > 30").join(sheets.where("known"), "p_brand").select("p_brand", F.when(F.col("p_size") > 40, "FLAG").otherwise("CHECK").alias("severity"), F.col("p_partkey").cast("long"))
    return info.unionByName(found)


@query("""SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderstatus WHEN 'P' THEN 0 WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 9 END, o_orderkey) AS place FROM orders""")
def by_group_then_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a key by the order of their groups, then as they came."""
    order = F.create_map(*[x for k, g in enumerate("PFO") for x in (F.lit(g), F.lit(k))])
    w = Window.partitionBy("o_custkey").orderBy(F.coalesce(F.try_element_at(order, F.col("o_orderstatus")), F.lit(9)), "o_orderkey")
    return table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.row_number().over(w).cast("long").alias("place"))


@query(f"""WITH e AS ({_EVENTS}), p AS (SELECT line, event_id, event_type AS a, pos, value, lead(event_type) OVER w AS b, lead(event_type, 2) OVER w AS c, lead(event_type, 3) OVER w AS d, lead(value) OVER w AS v2, lead(value, 2) OVER w AS v3, lead(value, 3) OVER w AS v4 FROM e WHERE event_type <> 'error' WINDOW w AS (PARTITION BY line ORDER BY pos, event_id)),
m AS (SELECT * FROM p WHERE a IN ('view', 'click') AND b IN ('view', 'click') AND c IN ('view', 'click') AND d = 'purchase'), x AS (SELECT line, event_id AS box, pos AS mark, value AS length FROM e WHERE event_type = 'signup'),
j AS (SELECT m.event_id, v2 - m.value AS first_gap, box, length, row_number() OVER (PARTITION BY m.event_id ORDER BY mark, box) AS rn FROM m JOIN x ON m.line = x.line AND x.mark - m.pos BETWEEN -20000 AND 20000)
SELECT event_id, box, abs(abs(first_gap) - length) > 0.05 * length AS off FROM j WHERE rn = 1""")
def sequence_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four consecutive points of given kinds, matched to the first box of their line within reach; whether the first pair
    of points is farther from the box's length than 5 %."""
    e = events(spark, sf_dir)
    w = Window.partitionBy("line").orderBy("pos", "event_id")
    kind, ahead = F.col("event_type"), lambda c, k: F.lead(c, k).over(w)
    shape = [kind.isin("view", "click"), ahead("event_type", 1).isin("view", "click"), ahead("event_type", 2).isin("view", "click"), ahead("event_type", 3) == "purchase"]
    points = e.where("event_type <> 'error'").select("line", "event_id", "pos", (ahead("value", 1) - F.col("value")).alias("first_gap"), (shape[0] & shape[1] & shape[2] & shape[3]).alias("fits")).where("fits")
    boxes = e.where("event_type = 'signup'").select("line", F.col("event_id").alias("box"), F.col("pos").alias("at"), F.col("value").alias("length"))
    near = positional.within(points, boxes, "line", "pos", "at", 20000.0)
    first = near.groupBy("event_id", "first_gap").agg(F.min(F.struct("at", "box", "length")).alias("b"))
    return first.select("event_id", "b.box", (F.abs(F.abs(F.col("first_gap")) - F.col("b.length")) > 0.05 * F.col("b.length")).alias("off"))


@query("""WITH s AS (SELECT l_orderkey, count(*) AS n, count(*) FILTER (WHERE abs(l_quantity - 25 - l_tax * 100) > 15) AS apart, count(*) FILTER (WHERE l_discount IS NULL) AS blank, max(l_linenumber) AS top FROM lineitem GROUP BY 1)
SELECT l_orderkey, array_to_string(list_filter([CASE WHEN apart > n / 2.0 THEN 'levels ' || apart END, CASE WHEN top <> n THEN 'series' END, CASE WHEN n < 2 THEN 'bands' END], lambda x: x IS NOT NULL), '; ') AS findings FROM s""")
def sheet_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings of a sheet from one aggregate: levels that differ from their reference in most columns, gaps in the series,
    missing bands."""
    apart = F.count_if(F.abs(F.col("l_quantity") - 25 - F.col("l_tax") * 100) > 15)
    g = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"), apart.alias("apart"), F.max("l_linenumber").alias("top"))
    found = F.array(F.when(F.col("apart") > F.col("n") / 2.0, F.concat(F.lit("levels "), F.col("apart").cast("string"))), F.when(F.col("top") != F.col("n"), "series"), F.when(F.col("n") < 2, "bands"))
    return g.select("l_orderkey", F.array_join(F.filter(found, lambda x: x.isNotNull()), "; ").alias("findings"))


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN p_partkey IS NULL THEN 'no bridge' WHEN abs(l_quantity - p_size) > 20 THEN 'level' WHEN l_extendedprice < p_retailprice THEN 'span' ELSE 'ok' END AS verdict FROM lineitem LEFT JOIN part ON p_partkey = l_partkey""")
def block_against_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reading of each item against the sheet's own value for it, the first difference that counts."""
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_size", "p_retailprice", F.lit(True).alias("there"))
    l = table(spark, sf_dir, "lineitem").join(p, "l_partkey", "left")
    verdict = F.when(F.col("there").isNull(), "no bridge").when(F.abs(F.col("l_quantity") - F.col("p_size")) > 20, "level").when(F.col("l_extendedprice") < F.col("p_retailprice"), "span").otherwise("ok")
    return l.select("l_orderkey", "l_linenumber", verdict.alias("verdict"))


def _sheets(spark: SparkSession, sf_dir: str, revision: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    text = F.concat_ws("|", F.lit(revision), F.col("p_partkey").cast("string"), "p_name")
    return p.select(F.format_string("S-%d", "p_partkey").alias("sheet_id"), F.col("p_brand").alias("line"), F.col("p_partkey").cast("string").alias("sheet_no"), F.lit(revision).alias("revision"), F.lit(f"set {revision}").alias("file"), F.sha2(text, 256).alias("sha"), F.col("p_retailprice").alias("pos_from"), (F.col("p_retailprice") + 1).alias("pos_to"), F.col("p_name").alias("doc"))


@query("""SELECT 'S-' || p_partkey AS sheet_id, p_brand AS line, CASE WHEN p_size > 25 THEN 'R10' ELSE 'R2' END AS revision, CASE WHEN p_size > 25 THEN 2 ELSE 1 END::BIGINT AS versions FROM part""")
def stored_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sheets stored twice, some with a second revision; a set that was forgotten; equal contents are stored once."""
    store = Store(spark, scratch(spark, "store"))
    store.add(_sheets(spark, sf_dir, "R2"))
    store.add(_sheets(spark, sf_dir, "R9"))
    store.forget("set R9")
    store.add(_sheets(spark, sf_dir, "R2"))
    store.add(_sheets(spark, sf_dir, "R10").join(table(spark, sf_dir, "part").where("p_size > 25").select(F.format_string("S-%d", "p_partkey").alias("sheet_id")), "sheet_id", "left_semi"))
    counts = store.versions().groupBy("sheet_id").agg(F.count("*").alias("versions"))
    return store.latest().join(counts, "sheet_id").select("sheet_id", "line", "revision", "versions")


@query("SELECT event_id, event_type, value, 2::BIGINT AS parts FROM events")
def json_lines_in_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows written as JSON lines in two parts and read back; a part that does not exist is skipped."""
    e, path = table(spark, sf_dir, "events").select("event_id", "event_type", "value"), scratch(spark, "lines")
    for k in (0, 1):
        write_json_lines(e.where(F.col("event_id") % 2 == k), f"{path}/{k}", ["event_id", "event_type", "value"])
    back = read_json_lines(spark, [f"{path}/{k}" for k in (0, 1, 2)], e.schema)
    folder = F.regexp_extract("_file", r"([^/]+)/[^/]*$", 1)
    parts = back.agg(F.count_distinct(folder).alias("parts"))
    return back.select("event_id", "event_type", "value").crossJoin(parts)


@query("SELECT n_nationkey AS k, n_name AS name FROM nation")
def csv_with_a_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A CSV for spreadsheets, read back by its header."""
    path = scratch(spark, "csv")
    write_csv(table(spark, sf_dir, "nation"), path, ["n_nationkey", "n_name"])
    back = spark.read.option("header", True).csv(path)
    return back.select(F.col(f"`{back.columns[0]}`").cast("int").alias("k"), F.col("n_name").alias("name"))


@query("""WITH f AS (SELECT p_brand, p_size % 3 AS copy, string_agg(p_partkey::VARCHAR, ',' ORDER BY p_partkey) AS content FROM part WHERE p_size % 3 < 2 GROUP BY 1, 2 UNION ALL SELECT p_brand, 2, string_agg(p_partkey::VARCHAR, ',' ORDER BY p_partkey) FROM part WHERE p_size % 3 = 0 GROUP BY 1),
k AS (SELECT content FROM f WHERE copy = 1) SELECT count(*) AS files, count(DISTINCT content) AS contents, count(DISTINCT CASE WHEN content NOT IN (SELECT content FROM k) THEN content END) AS new FROM f""")
def files_not_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of each brand's parts by the hash of their content: those that are known are left out, copies of a new one count once."""
    path, p = scratch(spark, "files"), table(spark, sf_dir, "part")
    content = F.array_join(F.transform(F.array_sort(F.collect_list("p_partkey")), lambda x: x.cast("string")), ",").alias("text")
    made = p.withColumn("copy", F.explode(F.when(F.col("p_size") % 3 == 0, F.array(F.lit(0), F.lit(2))).when(F.col("p_size") % 3 == 1, F.array(F.lit(1))))).groupBy("p_brand", "copy").agg(content)
    made.repartition("p_brand", "copy").write.partitionBy("copy", "p_brand").text(path)
    files = file_hashes(spark, f"{path}/copy=*/p_brand=*/part-*").cache()
    known = files.where(F.col("path").contains("/copy=1/")).select("sha")
    counts = files.agg(F.count("*").alias("files"), F.count_distinct("sha").alias("contents"))
    return counts.crossJoin(unseen(files, known).agg(F.count("*").alias("new")))
