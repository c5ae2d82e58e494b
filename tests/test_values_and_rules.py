"""Values in free text, typed calls, rule branches, interpolation at breaks and questions answered together: hand-made cases."""

import random

import pytest
from pyspark.sql import functions as F

from plumbline.functions import rules, udfs, values
from plumbline.operators.positional import beside, interpolate_at_breaks
from plumbline.plans.lookup import Lookups


def one(spark, column, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.v for r in df.select("i", column(F.col("t")).alias("v")).orderBy("i").collect()]


def test_numbers_and_tokens(spark):
    assert one(spark, values.numbers, "at 12+345.5, 1,234,567.5 and 12,34", "12+345.5 12345.5", "", None) == [[12345.5, 1234567.5, 12.0, 34.0], [12345.5], [], None]
    assert one(spark, lambda t: values.tokens(t, ["the"]), "The H.F.L. up/dn 1.5 h.f.l", "e.g. a.b.c.d.e", None) == [["hfl", "up/dn", "1.5"], ["eg", "abcde"], None]


def test_json_of_a_reply(spark):
    got = one(spark, values.json_of, 'x ```json {"a": 1}``` {', "see [1, 2] there", '{"a": }', '{"a": 1} and }', "none", None)
    assert [g and g.strip() for g in got] == ['{"a": 1}', "[1, 2]", None, None, None, None]


def test_value_recall(spark):
    wanted = lambda *v: F.array(*[F.lit(x) for x in v]).cast("array<string>")
    assert one(spark, lambda t: values.value_recall(t, wanted("12.50", "Box", None, "7")), "a BOX of 12.5", "17", "7", None) == [pytest.approx(2 / 3), 0.0, pytest.approx(1 / 3), 0.0]
    assert one(spark, lambda t: values.value_recall(t, wanted("", None)), "x") == [None]


def test_tool_calls(spark):
    text = '<call name="f"><arg name="n"> 1.50 </arg><arg name="n">2</arg><arg name="b">True</arg><arg name="s">a "b" \\</arg></call> <call name="g"></call>'
    (calls,), = [one(spark, lambda t: values.tool_calls(t, {"f.n": "number", "f.b": "boolean"}), text)]
    assert [(c.name, c.arguments) for c in calls] == [("f", {"n": "1.50", "b": "true", "s": '"a \\"b\\" \\\\"'}), ("g", {})]
    assert one(spark, lambda t: values.tool_calls(t, {"f.n": "number"}), '<call name="f"><arg name="n">near 2</arg></call>', "none", None)[1:] == [[], None]


def test_protected_is_what_the_rewording_protects(spark):
    texts = ['at 1240+535.820 is "FL 5" 5.5', "none", "", "1 2 3", '"open 7']
    got = one(spark, values.protected, *texts)
    assert [(g.text, g.kept) for g in got] == [udfs.protect(t) for t in texts]
    assert all(udfs.restore(g.text, g.kept) == t for g, t in zip(got, texts, strict=True))


def test_calculator_with_two_stacks():
    for text in ("1+2*3", "(1+2)*3", "2-3-4", "8/4/2", "-2*-3", "-(1-4)/2", "1.5e2-.5", "((7))", "2*(3+(4-1))*-1"):
        assert udfs.evaluate(text) == (round(eval(text), 3), None)
    for bad in ("1+", "*1", "(1", "1)", "()", "1 2", "2**3", "1//2", "1e400", "x", "9" * 201):
        assert udfs.evaluate(bad)[0] is None and udfs.evaluate(bad)[1]


def test_gradient_rules(spark):
    rows = [
        ("1 in 100 rising", "1 in 100 rising", 1000.0, 10.0), ("1 in 100 rising", "level", 1000.0, 10.4), ("level", "1 in 2500 rising", 1000.0, 0.005), ("level", "level", 1000.0, 0.006), ("1 in 100 rising", None, 1000.0, -10.0),
        ("1 in 100 falling", "1 in 90 falling", 1000.0, 0.0), (None, "level", 1000.0, 1.0), ("level", "level", None, 1.0),
    ]
    df = spark.createDataFrame(rows, "after string, before string, run double, rise double")
    got = [tuple(r) for r in df.select(rules.labels_disagree(F.col("after"), F.col("before")), rules.gradient_against_levels(F.col("after"), F.col("run"), F.col("rise")), rules.steeper_than_ruling(F.col("after"), F.lit(150))).collect()]
    assert got == [(None, None, "FLAG"), ("CHECK", "rate", "FLAG"), ("INFO", None, None), (None, "level", None), (None, "sign", "FLAG"), ("CHECK", "flat", "FLAG"), (None, None, None), (None, "level", None)]
    words = [r[0] for r in df.select(rules.implied_gradient(F.col("run"), F.col("rise"))).collect()]
    assert words[:2] == ["1 in 100 rising", "1 in 96 rising"] and words[5] == "level"


def test_curve_rules(spark):
    s = 30.0 * 30 / (24 * 500)
    rows = [(500.0, 30.0, 20.0, s + 0.001, 3.5, None), (500.0, 30.0, 20.0, s + 0.002, 3.503, 0.0), (0.0, 30.0, 20.0, 1.0, 1.0, 1.0), (500.0, None, 20.0, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "r double, l double, d double, s double, g double, t double")
    got = [[(f.severity, f.what) for f in r.f] for r in df.select(rules.curve_findings(*[F.col(c) for c in "rldsgt"]).alias("f")).collect()]
    assert got == [[], [("CHECK", "shift"), ("CHECK", "degree"), ("INFO", "tangent")], [], []]


def test_beside_on_a_hot_line(spark):
    rng = random.Random(1)
    rows = [(rng.choice("aaab"), float(rng.randrange(60_000)), k) for k in range(300)]
    df = spark.createDataFrame(rows, "line string, pos double, seq long")
    got = {r.seq: (r._earlier, r._later) for r in beside(df, "line", "pos", "seq", F.col("seq")).collect()}
    for line in "ab":
        own = [k for _, k in sorted((p, k) for x, p, k in rows if x == line)]
        assert all(got[k] == (own[i - 1] if i else None, own[i + 1] if i + 1 < len(own) else None) for i, k in enumerate(own))


def test_interpolation_at_breaks(spark):
    level = lambda x: 10 - 0.1 * x if x <= 50 else 5 + 0.2 * (x - 50)
    columns = spark.createDataFrame([("a", float(x), k, level(x)) for k, x in enumerate((0, 20, 40, 60, 80, 100))] + [("b", 0.0, 9, 1.0)], "line string, pos double, seq long, v double")
    probes = [("a", x, k) for k, x in enumerate((10.0, 20.0, 45.0, 50.0, 55.0, 70.0, 100.0, 120.0))] + [("b", 5.0, 90), ("c", 1.0, 91)]
    p = spark.createDataFrame(probes, "line string, pos double, seq long")
    at = lambda *x: interpolate_at_breaks(p, columns, spark.createDataFrame([("a", b, k) for k, b in enumerate(x)], "line string, pos double, seq long"), "line", "pos", "v", "seq")
    got = {r.seq: (r.how, r.value and round(r.value, 6)) for r in at(50.0).collect()}
    assert got == {0: ("straight", 9.0), 1: ("exact", 8.0), 2: ("left", 5.5), 3: ("left", 5.0), 4: ("right", 6.0), 5: ("straight", 9.0), 6: ("exact", 15.0), 7: ("outside", None), 90: ("outside", None), 91: ("outside", None)}
    # a break that is not where the stretches meet does not count
    assert {r.how for r in at(47.0).where("line = 'a' and pos between 45 and 55").collect()} == {"straight"}


def test_questions_answered_together(spark):
    df = lambda rows, s: spark.createDataFrame(rows, s)
    book = Lookups(df([("x", 1, 5.0), ("x", 2, 9.0), ("y", 1, 5.0)], "line string, key long, pos double"), df([("x", 7, 0.0, 6.0), ("x", 8, 6.0, 9.0)], "line string, sheet long, low double, high double"), df([], "sheet long, text string"))
    asked = [(1, "item", "x", 2, None, None, None, None), (2, "range", "x", None, 5.0, 9.0, None, None), (3, "containing", "x", None, None, None, 6.0, None), (4, "versions", "x", None, None, None, None, 8), (5, "range", None, None, 5.0, None, None, None), (6, "curve", "x", None, None, None, None, None), (7, None, None, None, None, None, None, None), (8, "item", "z", 1, None, None, None, None)]
    q = df(asked, "qid long, kind string, line string, key long, low double, high double, pos double, sheet long")
    got = sorted((r.qid, r.key, r.sheet, r.error) for r in book.answer_all(q, 4.0).collect())
    assert sorted(got, key=str) == sorted([(1, 2, None, None), (2, 1, None, None), (2, 2, None, None), (3, None, 7, None), (3, None, 8, None), (4, None, 8, None), (5, None, None, "missing high, line"), (6, None, None, "unknown kind curve"), (7, None, None, "unknown kind ")], key=str)


def test_a_build_stops_at_a_wrong_row(spark):
    from plumbline.operators.scoring import stop_if

    rows = spark.createDataFrame([(1, "fine"), (2, "it is None here")], "k int, text string")
    assert stop_if(rows, F.col("text").contains("Nothing"), "text").count() == 2
    with pytest.raises(ValueError, match="a value is missing.*'k': 2"):
        stop_if(rows, F.col("text").rlike(r"\bNone\b"), "a value is missing")


def test_runs_of_words_of_any_vocabulary(spark):
    from plumbline.plans.printed import run_words

    runs = spark.createDataFrame([("railwaybridge",), ("xyz",), ("",), (None,), ("railwaybridge",)], "run string")
    words = spark.createDataFrame([("rail",), ("way",), ("railway",), ("bridge",), ("x",)], "word string")
    assert {r.run: r.words for r in run_words(runs, words).collect()} == {"railwaybridge": ["railway", "bridge"], "xyz": ["xyz"], "": udfs.segment("", frozenset())}


def test_budget_with_forced_rows(spark):
    from plumbline.operators.windows import budgeted

    rows = spark.createDataFrame([("a", 1, 5, False), ("a", 2, 50, True), ("a", 3, 5, False), ("a", 4, 1, True), ("b", 1, 5, False), ("b", 2, 4, False)], "g string, k int, n int, f boolean")
    got = budgeted(rows, ["g"], [F.asc("k")], F.col("n"), F.col("f"), 9, 12)
    assert sorted((r.g, r.k) for r in got.collect()) == [("a", 1), ("a", 2), ("b", 1), ("b", 2)]


def test_equal_rows_of_a_heading_go_by_the_file(spark, sf, tmp_path):
    """Lines that repeat an order, line and part with other suppliers: the first in the file wins, as in the SQL's engine."""
    import duckdb

    from plumbline import registry

    c = duckdb.connect()
    c.sql(f"COPY (SELECT * REPLACE (l_suppkey + 21 * r AS l_suppkey) FROM '{sf}/lineitem.parquet', range(3) x(r) ORDER BY hash(l_orderkey * 31 + l_partkey * 7 + l_suppkey)) TO '{tmp_path}/lineitem.parquet'")
    c.sql(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet'")
    got = [tuple(r) for r in registry.queries()["headings_by_values"](spark, str(tmp_path)).select("sheet", "key", "heading").collect()]
    assert sorted(got) == sorted(c.sql(registry.oracle_sql()["headings_by_values"]).fetchall())


def test_bands_in_one_place_are_not_met_pair_by_pair(spark, tmp_path):
    """Copies of vectors, ends of a page, boxes without overlap: the band of the SQL, and few pairs for many copies."""
    import duckdb
    import random

    from plumbline import registry

    rng = random.Random(3)
    rows = [(k, [rng.choice([0.1, 0.1, 0.25, rng.random() * 3 - 1, 9.0 + k]), rng.choice([0.5, rng.random()])], 0) for k in range(3000)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    c = duckdb.connect()
    c.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    got = registry.queries()["row_to_band_by_overlap"](spark, str(tmp_path))
    want = c.sql(registry.oracle_sql()["row_to_band_by_overlap"]).fetchall()
    assert sorted((r.vec_id, r.band) for r in got.collect()) == sorted(want)


def test_a_callout_reads_its_text_once(spark):
    """The expression names its text once, however many fields there are."""
    from plumbline.functions.documents import callout

    df = spark.createDataFrame([("C/L OF EXG. LC 5 ROAD AT CH: 5.5",)], "t string").select(callout(F.concat("t", F.lit("mark"))).alias("c"))
    assert df.select("c.*")._jdf.queryExecution().analyzed().toString().count("mark") == 1


def test_pairs_of_facts_do_not_cross_a_shuffle(spark):
    """One read of the facts, and no more rows of a task for more facts."""
    from plumbline.operators import ranking

    facts = spark.range(500).select(F.col("id").alias("fid"), F.lit("g").alias("grp"), F.array(F.lit("a"), F.concat(F.lit("b"), F.col("id") % 7)).alias("tokens"), F.array().cast("array<string>").alias("numbers"), F.array(F.lit("a")).alias("title"))
    asked = spark.createDataFrame([(1, ["a", "b3"], ["7"]), (2, ["zz"], ["8"])], "qid long, tokens array<string>, numbers array<string>")
    was, ranking.FACT_ROWS = ranking.FACT_ROWS, 100
    try:
        got = ranking.score_facts(facts, asked, titles=True)
    finally:
        ranking.FACT_ROWS = was
    assert got.count() == 500 and {r.qid for r in got.select("qid").distinct().collect()} == {1}
    assert len(got.inputFiles()) > 4


def test_positions_of_one_line_are_dealt_to_many_tasks(spark):
    """A line with all sheets and items, against plain loops, in more tasks than the tables have parts."""
    from plumbline.plans import lookup

    rng = random.Random(8)
    items = [("a", k, rng.random() * 9000) for k in range(400)]
    sheets = [("a", k, p, p + rng.choice([0.0, 700.0, 5000.0])) for _, k, p in items]
    asked = [(k, "containing" if k % 2 else "range", "a", None, p, p + 300, p, None) for k, p in enumerate(rng.random() * 9000 for _ in range(40))]
    want = sorted([(q, i, None) for q, kind, _, _, low, high, _, _ in asked if kind == "range" for _, i, p in items if low <= p <= high] + [(q, None, s) for q, kind, _, _, _, _, p, _ in asked if kind == "containing" for _, s, low, high in sheets if low <= p <= high], key=str)
    df = lambda rows, schema: spark.createDataFrame(rows, schema)
    was, lookup.DEALT = lookup.DEALT, 50
    try:
        found = Lookups(df(items, "line string, key long, pos double"), df(sheets, "line string, sheet long, low double, high double"), spark.range(1)).answer_all(
            df(asked, "qid long, kind string, line string, key long, low double, high double, pos double, sheet long")
        )
    finally:
        lookup.DEALT = was
    assert sorted(((r.qid, r.key, r.sheet) for r in found.collect()), key=str) == want
    assert found._jdf.queryExecution().executedPlan().toString().count("REPARTITION_BY_NUM") >= 4


def test_long_sheets_take_little_room_on_disk(spark, shuffled, tmp_path):
    """Sheets have copies only in the bins where questions are; ends that are no numbers are above all; also without any question."""
    from plumbline.plans import lookup

    rng = random.Random(9)
    sheets = [("a", k, p, p + 20000) for k, p in enumerate(rng.random() * 90000 for _ in range(1500))]
    sheets += [("a", 1500, 39000.0, float("inf")), ("a", 1501, 41000.0, float("nan")), ("a", 1502, float("nan"), float("nan"))]
    asked = [(k, "containing", "a", None, None, None, 40000 + rng.random() * 2500, None) for k in range(1500)] + [(-1, "containing", "a", None, None, None, float("nan"), None)]
    want = sorted((q, s) for q, *_, p, _ in asked for _, s, low, high in sheets if low <= p and not p > high)  # no number is above all
    df = lambda rows, schema: spark.createDataFrame(rows, schema)
    book = Lookups(df([], "line string, key long, pos double"), df(sheets, "line string, sheet long, low double, high double"), spark.range(1))
    q = df(asked, "qid long, kind string, line string, key long, low double, high double, pos double, sheet long")
    was, lookup.DEALT = lookup.DEALT, 50
    try:
        assert shuffled(lambda: book.answer_all(q).write.parquet(f"{tmp_path}/out")) < 4 * (len(sheets) + len(asked))
        assert book.answer_all(q.where("false")).count() == 0
    finally:
        lookup.DEALT = was
    found = spark.read.parquet(f"{tmp_path}/out")
    assert sorted((r.qid, r.sheet) for r in found.collect()) == want
