"""Parsers of printed sheets as queries: columns of the tables are printed in the formats that the parsers read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions import documents as d
from plumbline.functions import parse
from plumbline.functions.udfs import answer_mask_udf, segment_udf, similarity
from plumbline.operators.windows import label_stack
from plumbline.plans.positional import _EVENTS, events
from plumbline.query import query, table


def part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part")


def _n() -> Column:
    return F.col("p_partkey")


def _size() -> Column:
    return F.col("p_size")


_KM = "p_partkey % 9000 + 100"


@query(f"""SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN ({_KM}) * 1000 + p_size + 100 WHEN 1 THEN p_partkey + 1000000 WHEN 2 THEN p_partkey + 2000000 ELSE ({_KM}) * 1000 END::DOUBLE AS pos FROM part""")
def free_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions in running text: 12+345, CH 1234567, a bare number of seven digits, km 12."""
    km = _n() % 9000 + 100
    text = F.when(_size() % 4 == 0, F.format_string("bridge at %d+%d, left", km, _size() + 100)).when(_size() % 4 == 1, F.format_string("at CH. %d only", _n() + 1000000)).when(_size() % 4 == 2, F.format_string("near %d there", _n() + 2000000)).otherwise(F.format_string("past km %d", km))
    return part(spark, sf_dir).select("p_partkey", parse.free_position(text).alias("pos"))


@query("SELECT p_partkey, rtrim(rtrim(printf('%.3f', p_retailprice + p_size / 8.0), '0'), '.') AS text, (p_size * 25)::DOUBLE AS one_in FROM part")
def plain_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part(spark, sf_dir).select("p_partkey", parse.plain(F.col("p_retailprice") + _size() / 8.0).alias("text"), parse.one_in(F.format_string("falls 1 IN %d here", _size() * 25)).alias("one_in"))


@query("SELECT p_partkey, greatest(p_size, p_partkey % 60) + 0.5 AS level FROM part")
def highest_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.format_string("HFL: %d.5 OHFL 999 AND HFL = %d.5", _size(), _n() % 60)
    return part(spark, sf_dir).select("p_partkey", parse.highest_level(F.regexp_replace(text, "OHFL 999", "BED 7"), "HFL").alias("level"))


@query("SELECT p_partkey, (p_partkey % 7 + 1)::DOUBLE AS cells, p_size + 0.5 AS span, p_size::DOUBLE AS height FROM part")
def box_configurations(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.format_string("%d x %d.5 X %d", _n() % 7 + 1, _size(), _size())
    return part(spark, sf_dir).select("p_partkey", parse.configuration(text).alias("c")).select("p_partkey", "c.cells", "c.span", "c.height")


@query("SELECT event_id, props AS block FROM events")
def json_in_a_reply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a fence holds; without one the widest brackets."""
    reply = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("Here it is:\n```json\n"), "props", F.lit("```\nDone."))).otherwise(F.concat(F.lit("It is "), "props", F.lit(" as asked.")))
    return table(spark, sf_dir, "events").select("event_id", parse.json_block(reply).alias("block"))


@query(r"SELECT conv_id, turn, regexp_replace(text, '^\s+|\s+$', '', 'g') AS thinking, role AS answer FROM conversations WHERE text IS NOT NULL AND trim(text) <> '' AND role IS NOT NULL")
def thinking_and_answer(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").where("text is not null and trim(text) <> '' and role is not null")
    thinking, answer = parse.split_think(F.concat(F.lit("<|start|><think> "), "text", F.lit(" </think>\n "), "role", F.lit("<|end|>")))
    return c.select("conv_id", "turn", thinking.alias("thinking"), answer.alias("answer"))


@query("""SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'LC-' || p_partkey WHEN 1 THEN p_partkey::VARCHAR ELSE 'ROB-' || p_partkey END AS bridge_id,
 CASE p_size % 3 WHEN 0 THEN 'LEVEL CROSSING' WHEN 1 THEN 'PIPE ' || p_type ELSE 'ROB' END AS existing_type, CASE WHEN p_size % 3 = 1 THEN '1 X ' || p_size END AS existing_span,
 CASE p_size % 3 WHEN 2 THEN 'none - space available for proposed line' WHEN 1 THEN '2 X ' || p_size || ' - BOX' END AS proposal, CASE WHEN p_size % 3 = 1 THEN 'MINOR' END AS category, p_partkey + 0.5 AS chainage_m FROM part""")
def callouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = (
        F.when(_size() % 3 == 0, F.format_string("C/L OF EXG. LC %d OLD ROAD AT CH: %d.5", _n(), _n()))
        .when(_size() % 3 == 1, F.format_string("C/L OF EXG. BR. NO. %d PIPE %s - 1 X %d - DITCH PRO TO BE EXTENDED AS 2 X %d - BOX (MINOR) AT CH: %d.5", _n(), F.col("p_type"), _size(), _size(), _n()))
        .otherwise(F.format_string("C/L OF EXG. ROB-%d LANE SPACE AVAILABLE FOR PROP. LINE AT CH: %d.5", _n(), _n()))
    )
    c = part(spark, sf_dir).select("p_partkey", d.callout(text).alias("c"))
    return c.select("p_partkey", *[f"c.{x}" for x in ("bridge_id", "existing_type", "existing_span", "proposal", "category", "chainage_m")])


@query("""SELECT p_partkey, p_size + 0.25 AS existing_fl, p_size + 0.5 + CASE WHEN p_partkey % 2 = 0 THEN 1 ELSE 0 END AS proposed_fl, CASE WHEN p_partkey % 2 = 1 THEN p_size - 1.0 END AS bed_level FROM part""")
def level_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Levels by the names of lines, the highest ordinal being the proposed one, or by EXG and PROP."""
    text = F.when(_n() % 2 == 0, F.format_string("FL UP LINE = %d.25 FL 3RD LINE = 0.5 FL 4TH LINE = %d.5", _size(), _size() + 1)).otherwise(F.format_string("EXG. FL : %d.25 PROP. FL : %d.5 BL : %d.0", _size(), _size(), _size() - 1))
    return part(spark, sf_dir).select("p_partkey", d.level_block(text).alias("b")).select("p_partkey", "b.existing_fl", "b.proposed_fl", "b.bed_level")


@query("""SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'S-' || p_size || '_' || lpad((p_partkey % 900)::VARCHAR, 3, '0') ELSE 'plan_' || p_partkey || '_p' || lpad((p_size + 1)::VARCHAR, 2, '0') END AS sheet,
 CASE WHEN p_size % 3 = 0 THEN lower(p_brand) WHEN p_size % 3 = 1 THEN '4th line' ELSE '3rd line' END AS line,
 CASE WHEN p_size BETWEEN 10 AND 20 THEN 'this sheet' WHEN p_size < 10 THEN 'previous sheet' ELSE 'next sheet' END AS place FROM part""")
def sheet_names_and_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawing = F.when(_size() % 2 == 0, F.format_string("A/S-%d/P&P/%d", _size(), _n() % 900))
    lines = F.create_map(F.lit("proposed"), F.when(_size() % 3 == 0, F.col("p_brand")).otherwise(F.lit("")))
    title = F.when(_size() % 3 == 1, "PLAN OF THE 4TH LINE").otherwise("PLAN")
    return part(spark, sf_dir).select("p_partkey", d.sheet_id(drawing, F.format_string("in/plan %d.pdf", _n()), _size()).alias("sheet"), d.line_of(lines, title).alias("line"), d.belongs_to(_size().cast("double"), F.lit(10.0), F.lit(20.0)).alias("place"))


@query("""SELECT p_partkey, (CASE WHEN p_size % 2 = 0 THEN p_size ELSE 762 END) / 1000.0 AS rail, (CASE WHEN p_size % 3 = 0 THEN p_size + 100 ELSE 150 END)::DOUBLE AS ruling, p_size > 5 AND p_name <> '' AS complete FROM part""")
def constants_from_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rail height and ruling gradient from notes, with defaults; whether a bridge has all that it must."""
    note = lambda on, text: F.struct(F.when(on, text).otherwise(F.lit("SEE PLAN.")).alias("text"))
    rail, ruling = d.constants(F.array(note(_size() % 2 == 0, F.format_string("RAIL LEVEL SHOULD BE %d MM ABOVE FORMATION.", _size())), note(_size() % 3 == 0, F.format_string("RULING GRADIENT IS 1 IN %d.", _size() + 100))))
    bridge = F.struct(*[F.col("p_name").alias(x) for x in d.REQUIRED[:-1]], F.when(_size() > 5, _size()).otherwise(0).cast("double").alias("chainage_m"))
    return part(spark, sf_dir).select("p_partkey", rail.alias("rail"), ruling.alias("ruling"), d.complete(bridge).alias("complete"))


@query(f"""WITH e AS ({_EVENTS}), m AS (SELECT line, event_id, event_type, CASE WHEN event_id - lag(event_id) OVER w > 400 OR event_type = 'purchase' THEN 1 ELSE 0 END AS ends FROM e WINDOW w AS (PARTITION BY line ORDER BY event_id)),
k AS (SELECT *, sum(ends) OVER (PARTITION BY line ORDER BY event_id) AS ended FROM m) SELECT line, string_agg(event_type, ' ' ORDER BY event_id) AS stacked FROM k WHERE ended = 0 GROUP BY 1""")
def stacked_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first lines of a key up to a gap or a line that ends the label."""
    return label_stack(events(spark, sf_dir).select("line", "event_id", "event_type"), ["line"], "event_id", "event_type", 400, "^purchase$")


@query("SELECT p_partkey, array_to_string(list_filter(string_split(p_name, ' '), lambda x: x <> ''), ' ') AS words FROM part")
def words_run_together(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names without their spaces, cut into the words of the vocabulary of all names."""
    p = part(spark, sf_dir).select("p_partkey", F.replace("p_name", F.lit(" "), F.lit("")).alias("run"), "p_name")
    words = p.select(F.explode(F.split("p_name", " ")).alias("word")).where("word <> ''").distinct()
    return p.join(run_words(p.select("run"), words), "run", "left").select("p_partkey", F.array_join("words", " ").alias("words"))


def run_words(runs: DataFrame, words: DataFrame, longest: int = 20) -> DataFrame:
    """(run, words): each different ``run`` as the fewest of ``words`` (word, up to ``longest`` characters) that make it up, else as
    it is. The pieces of a run meet the vocabulary by equality, so that is of any size and never gathered."""
    each = runs.where("run is not null").distinct()
    n = F.length("run")
    pieces = F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.transform(F.sequence(F.lit(1), F.least(F.lit(longest), F.greatest(n - i + 1, F.lit(1)))), lambda k: F.substr(F.col("run"), i, k)))))
    met = each.select("run", F.explode(pieces).alias("word")).join(words.select("word").distinct(), "word").groupBy("run").agg(F.collect_set("word").alias("known"))
    return each.join(met, "run", "left").select("run", segment_udf("run", "known").alias("words"))


@query(r"""WITH t AS (SELECT p_partkey, p_name AS a, CASE p_partkey % 5 WHEN 0 THEN p_name WHEN 1 THEN upper(p_name) || '.' WHEN 2 THEN replace(p_name, ' ', '  ') WHEN 3 THEN '0123456789' ELSE NULL END AS b FROM part),
n AS (SELECT p_partkey, a IS NULL OR b IS NULL AS gap, regexp_replace(lower(a), '[^a-z]', '', 'g') AS a, regexp_replace(lower(b), '[^a-z]', '', 'g') AS b FROM t)
SELECT p_partkey, CASE WHEN gap THEN NULL WHEN a = b THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS ratio, CASE WHEN NOT gap THEN a = b END AS alike FROM n""")
def label_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names against what was read of them: the same, in capitals with a point, with wider gaps, another thing, nothing. Only letters
    count, and 0.8 makes them alike."""
    k = F.col("p_partkey") % 5
    read = F.when(k == 0, F.col("p_name")).when(k == 1, F.concat(F.upper("p_name"), F.lit("."))).when(k == 2, F.replace("p_name", F.lit(" "), F.lit("  "))).when(k == 3, "0123456789")
    letters = lambda x: F.regexp_replace(F.lower(x), "[^a-z]", "")
    rows = part(spark, sf_dir).select("p_partkey", similarity(letters(F.col("p_name")), letters(read)).alias("ratio"))
    return rows.select("p_partkey", "ratio", (F.col("ratio") >= 0.8).alias("alike"))


@query("""WITH n AS (SELECT conv_id, turn, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS k FROM conversations), t AS (SELECT conv_id, k, CASE WHEN role = 'assistant' THEN 3 ELSE 0 END AS on_ FROM n)
SELECT conv_id, sum(on_)::BIGINT AS trained, (count(*) * 5)::BIGINT AS total FROM t GROUP BY 1""")
def answer_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens that are trained on: two of an answer and its end, behind the start of each assistant turn (ids 1, 2; end 9)."""
    turn = F.when(F.col("role") == "assistant", F.array(*map(F.lit, (1, 2, 5, 6, 9)))).otherwise(F.array(*map(F.lit, (1, 3, 5, 6, 9))))
    ids = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", "text", turn.alias("ids")))), lambda x: x["ids"]))
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(ids.alias("ids"))
    mask = answer_mask_udf("ids", F.array(F.lit(1), F.lit(2)), F.lit(9))
    return rows.select("conv_id", F.aggregate(mask, F.lit(0).cast("long"), lambda a, x: a + x).alias("trained"), F.size("ids").cast("long").alias("total"))
