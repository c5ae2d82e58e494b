"""Hand-made cases of parsers, folds and scorers."""

import pytest
from pyspark.sql import functions as F

from plumbline.functions import parse, udfs
from plumbline.operators import positional, windows
from plumbline.plans.lookup import Lookups
from plumbline.sources import io
from plumbline.sources.store import Store


def values(spark, column, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.v for r in df.select("i", column(F.col("t")).alias("v")).orderBy("i").collect()]


def test_positions(spark):
    assert values(spark, parse.km_to_m, "1240+535.8", "x 1240+5", "12+", None) == [1240535.8, None, None, None]
    assert values(spark, parse.free_position, "at 1240+535", "CH 1242662.9", "1242662", "km 1240", "none") == [1240535.0, 1242662.9, 1242662.0, 1240000.0, None]
    df = spark.createDataFrame([(1240535.82,), (None,)], "x double")
    assert [r[0] for r in df.select(parse.m_to_km(F.col("x"))).collect()][0] == "1240+535.820"


def test_labels(spark):
    assert values(spark, parse.gradient_words, "R 1 in 150", "F 1 in 1000", "LEVEL", "1 in 200000", "?") == ["1 in 150 rising", "1 in 1000 falling", "level", "level", None]
    assert values(spark, parse.dms, "10° 30' 36\"", "5", "") == [10.51, 5.0, None]
    assert values(spark, lambda t: parse.highest_level(t, "HFL"), "HFL 10.5 and HFL: 11.25", "no") == [11.25, None]
    assert values(spark, parse.revision_order, "R10", "R2", "draft", None) == [10, 2, -1, -1]
    assert values(spark, parse.json_block, 'a ```json {"x": 1}``` b', "see [1, 2] there", "none") == ['{"x": 1}', "[1, 2]", None]


def test_calculator():
    assert udfs.evaluate("245.541 - 245.5") == (0.041, None)
    assert udfs.evaluate("-(2 + 3) × 4 ÷ 8")[0] == -2.5
    for bad in ("__import__('os')", "1 / 0", "", None, "2 ** 9", "a + 1"):
        assert udfs.evaluate(bad)[0] is None and udfs.evaluate(bad)[1]


def test_text_folds():
    assert udfs.segment("railwaybridge", frozenset({"railway", "rail", "way", "bridge"})) == ["railway", "bridge"]
    assert udfs.segment("xyz", frozenset({"x"})) == ["xyz"]
    assert udfs.successive("1011") == [10, 11] and udfs.successive("99100101") == [99, 100, 101] and udfs.successive("13") is None
    body, kept = udfs.protect('at 1240+535.820 is "FL" 5.5')
    assert udfs.restore(body, kept) == 'at 1240+535.820 is "FL" 5.5'
    assert udfs.restore(body.replace("⟦0⟧", ""), kept) is None
    assert udfs.reword("What is the height at 12.5?", "a") == udfs.reword("What is the height at 12.5?", "a")
    assert udfs.flatten({"a": [{"b": 1}, {"b": None}], "c": "x"}) == {"a[0].b": "1", "c": "x"}
    assert udfs.flatten({"a": [{"id": "p", "b": 1}, {"id": "q", "b": [2]}]}, key="id") == {"a[p].id": "p", "a[p].b": "1", "a[q].id": "q", "a[q].b[0]": "2"}
    assert udfs.flatten([{"id": 1}, {"id": 1}, 3], key="id") == {"[0].id": "1", "[1].id": "1", "[2]": "3"}


def test_boxes_and_masks():
    assert udfs.match_boxes([[0, 0, 10, 10], [1, 0, 11, 10]], [[0, 0, 10, 10]]) == (1, 0, 1)
    assert udfs.match_boxes([], [[0, 0, 1, 1]]) == (0, 1, 0)
    assert udfs.answer_mask([5, 1, 2, 7, 9, 1, 2, 8], [1, 2], 9) == [0, 0, 0, 1, 1, 0, 0, 1]


def test_interpolation(spark):
    points = spark.createDataFrame([("a", 0.0, 1, 0.0), ("a", 20.0, 2, 10.0), ("a", 60.0, 3, 30.0)], "line string, pos double, seq int, v double")
    probes = spark.createDataFrame([("a", p, k) for k, p in enumerate((0.0, 5.0, 30.0, 60.0, 70.0))] + [("b", 1.0, 9)], "line string, pos double, seq int")
    out = positional.interpolate(positional.asof_pair(probes, points, "line", "pos", "v", "seq"), "pos", 20.0)
    got = {r.seq: (r.status, r.value) for r in out.collect()}
    assert got == {0: ("exact", 0.0), 1: ("interpolated", 2.5), 2: ("gap", None), 3: ("exact", 30.0), 4: ("outside", None), 9: ("outside", None)}


def test_segments_half_open_and_closed(spark):
    s = spark.createDataFrame([("a", 1, 0.0, 10.0), ("a", 2, 10.0, 20.0)], "line string, seg int, low double, high double")
    p = spark.createDataFrame([("a", 10.0)], "line string, pos double")
    run = lambda closed: sorted(r.seg for r in positional.containing(p, s, "line", "pos", "low", "high", closed, 4.0).collect())
    assert run(False) == [2] and run(True) == [1, 2]


def test_anchored_clusters_differ_from_gaps(spark):
    rows = spark.createDataFrame([("k", i, float(x)) for i, x in enumerate((0, 4, 8, 12))], "k string, i int, v double")
    anchored = [r.cluster for r in windows.anchored_clusters(rows, ["k"], "v", "i", 5.0).orderBy("i").collect()]
    gaps = [r.cluster for r in windows.gap_clusters(rows, ["k"], "v", "i", 5.0).orderBy("i").collect()]
    assert anchored == [0, 0, 1, 1] and gaps == [0, 0, 0, 0]


def test_label_stack(spark):
    rows = spark.createDataFrame([("k", 0.0, "BR"), ("k", 1.0, "NO 5"), ("k", 9.0, "far")], "k string, o double, t string")
    assert windows.label_stack(rows, ["k"], "o", "t", 3.0, "STOP").first().stacked == "BR NO 5"


def test_lookup_errors_are_values(spark):
    items = spark.createDataFrame([("a", "k", 1.0)], "line string, key string, pos double")
    sheets = spark.createDataFrame([("a", "s", 0.0, 2.0)], "line string, sheet string, low double, high double")
    notes = spark.createDataFrame([("s", "Some note")], "sheet string, text string")
    k = Lookups(items, sheets, notes)
    assert k.answer("what").first().error.startswith("unknown")
    assert k.answer("item", line="a").first().error == "missing key"
    assert k.answer("item", line="a", key="k").first().pos == 1.0
    assert k.answer("containing", line="a", pos=2.0).count() == 1
    assert k.answer("term", term="x").first().error and k.answer("term", term="NOTE").count() == 1


@pytest.fixture
def versions(spark):
    schema = "sheet_id string, line string, sheet_no string, revision string, file string, sha string, pos_from double, pos_to double, doc string"
    make = lambda *r: spark.createDataFrame([(s, "l", s, rev, f, sha, 0.0, 1.0, "{}") for s, rev, f, sha in r], schema)
    return make


def test_store(spark, tmp_path, versions):
    store = Store(spark, str(tmp_path / "store"))
    assert store.versions().count() == 0
    assert store.add(versions(("s1", "R0", "f0", "a"), ("s1", "R10", "f1", "b"), ("s1", "R2", "f2", "c"))) == 3
    assert store.add(versions(("s1", "R10", "f3", "d"), ("s1", "R0", "f9", "a"))) == 1
    assert store.latest().first().file == "f3"
    assert store.history("l", "s1").where("is_latest").count() == 1
    store.forget("f3")
    assert store.latest().first().file == "f1" and store.versions().count() == 3


def test_json_and_csv(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "x int, y string")
    io.write_json_lines(rows, str(tmp_path / "j"), ["y", "x"])
    back = io.read_json_lines(spark, [str(tmp_path / "j"), str(tmp_path / "none")], "x int, y string")
    assert sorted((r.x, r.y) for r in back.collect()) == [(1, "a"), (2, "b")] and back.where("_file = ''").count() == 0
    io.write_csv(rows.coalesce(1), str(tmp_path / "c"), ["x", "y"])
    text = next((tmp_path / "c").glob("part-*")).read_bytes()
    assert text.startswith(b"\xef\xbb\xbfx,y")
    files = io.file_hashes(spark, str(tmp_path / "c" / "part-*"))
    assert io.unseen(files, files.select("sha")).count() == 0


def test_stream_latest(spark, tmp_path):
    from plumbline.streaming.latest import latest_revisions

    src = tmp_path / "in"
    spark.createDataFrame([("s", 1, "old"), ("s", 2, "new")], "k string, r int, v string").write.parquet(str(src))
    stream = spark.readStream.schema("k string, r int, v string").parquet(str(src))
    q = latest_revisions(stream, "k", ["r"], ["v"]).writeStream.outputMode("complete").format("memory").queryName("latest_test").start()
    q.processAllAvailable()
    q.stop()
    assert [(r.k, r.v) for r in spark.table("latest_test").collect()] == [("s", "new")]


def test_lines_are_cut_without_a_trace(spark):
    """As-of neighbours and nearest intervals do not depend on where lines are cut; all of them against brute force."""
    import random

    rng = random.Random(4)
    points = [(rng.choice("ab"), float(rng.randint(0, 60)), k, k * 1.5) for k in range(40)] + [("a", None, 90, 1.0)]
    probes = [(rng.choice("abc"), float(rng.randint(-5, 65)), 100 + k) for k in range(60)] + [("a", None, 200)]
    p = spark.createDataFrame(points, "line string, pos double, seq long, v double")
    q = spark.createDataFrame(probes, "line string, pos double, seq long")
    whole = None
    for stretch in (7.0, 1000.0):
        got = {r.seq: (r.prev_pos, r.prev, r.next_pos, r.next) for r in positional.asof_pair(q, p, "line", "pos", "v", "seq", stretch).collect()}
        for line, at, seq in probes:
            if at is not None:
                own = sorted((x, s, v) for n, x, s, v in points if n == line and x is not None)
                before, after = [o for o in own if o[0] <= at], [o for o in own if o[0] > at]
                assert got[seq] == ((before[-1][0], before[-1][2]) if before else (None, None)) + ((after[0][0], after[0][2]) if after else (None, None))
        assert whole in (None, got)
        whole = got
    spans = [(n, x, x + rng.randint(0, 6), s) for n, x, s, _ in points if x is not None]
    found = positional.nearest_intervals(q.where("pos is not null").withColumnRenamed("seq", "probe"), spark.createDataFrame(spans, "line string, low double, high double, id long"), "line", "pos", "low", "high", "probe", 5.0, 7.0)
    want = set()
    for line, at, probe in probes:
        own = [(max(lo - at, at - hi, 0), i) for n, lo, hi, i in spans if n == line] if at is not None else []
        want |= {(probe, i) for d, i in own if d == min(own)[0]}
    assert sorted((r.probe, r.id) for r in found.collect()) == sorted(want)


def test_ranking_by_hand(spark):
    from plumbline.operators.ranking import printed_match, score_facts

    facts = spark.createDataFrame([(1, "item", ["pier", "height"], ["12"], ["pier"]), (2, "text", ["pier"], [], []), (3, "item", ["road"], ["12", "7.5"], ["road", "far"])], "fid int, grp string, tokens array<string>, numbers array<string>, title array<string>")
    asked = spark.createDataFrame([(9, ["pier", "near", "road"], ["12", "7.5"])], "qid int, tokens array<string>, numbers array<string>")
    import math

    once = {r.fid: r.score for r in score_facts(facts, asked).collect()}
    pier, road = math.log1p(3 / 2), math.log1p(3)
    assert all(abs(once[k] - v) < 1e-9 for k, v in {1: pier + 6, 2: pier - 0.5, 3: road + 6}.items())
    each = {r.fid: r.score for r in score_facts(facts, asked, each_number=True, titles=True, weak=None).collect()}
    assert all(abs(each[k] - v) < 1e-9 for k, v in {1: pier + 6 + 8, 2: pier, 3: road + 12}.items())
    side = "array<double>, codes array<string>, words array<string>"
    texts = spark.createDataFrame([(1, [12.6, 12.0, 9.0], ["LC-9"], ["bridge"]), (2, [13.4], [], ["bridge", "deck"]), (3, [11.3], [], [])], f"tid int, numbers {side}")
    q = spark.createDataFrame([(5, [12.0, 9.0, 14.0], ["LC-9"], ["bridge", "deck"])], f"qid int, numbers {side}")
    assert {r.tid: r.score for r in printed_match(texts, q).collect()} == {1: 10 + 10 + 1, 2: 10 + 2}


def test_wording(spark):
    from plumbline.plans import wording

    rows = [("Width of the",), ("Width of the span",), ("one",), ("Ends with FOR \n",), ("a  beforehand",), ("",), (None,), ("see plan.PDF now",), ("The 3rd line.",), ("The 3rd line. Or not",)]
    got = spark.createDataFrame(rows, "v string").select(wording.complete(F.col("v")).alias("whole"), wording.may_be_reworded(F.col("v")).alias("free")).collect()
    assert [r.whole for r in got] == [False, True, False, False, True, False, False, True, True, True]
    assert [r.free for r in got] == [True, True, True, True, True, True, False, False, False, True]
    assert wording.loose("details of walls") == r"details\s*of\s*walls"
