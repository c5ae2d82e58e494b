"""Nested sheet documents: fields, callouts, level blocks, long band, facts."""

from pyspark.sql import functions as F

from plumbline import schemas
from plumbline.functions import documents as d

SHEET = {
    "file": "in/Plan A-1.pdf", "page": 2, "sheet_info": {"title": "PLAN OF 4TH LINE", "chainage_from": "1240+000", "chainage_to": "1241+000.5", "drawing_no": "X/KGP-1/P&P/7", "issue_record": [{"no": "1", "rev": "R0"}, {"no": "2", "rev": "R2"}]},
    "columns": [{"chainage": 1240000.0, "x": 1.0, "values": {"fl": 5.0, "rl": 6.0}, "checks_ok": True}, {"chainage": 1240020.0, "x": 2.0, "values": {"fl": 5.5}, "checks_ok": False}],
    "bridges": [{"bridge_id": "516", "existing_type": "RCC SLAB", "existing_span": "1 X 3.66", "crossing": "STREAM", "proposal": "1 X 4", "chainage_m": 1240500.0}, {"bridge_id": "517", "chainage_m": 0.0}],
    "notes": [{"no": 5, "text": "RAIL LEVEL SHOULD BE 800 MM ABOVE FORMATION."}, {"no": 6, "text": "RULING GRADIENT IS 1 IN 200."}], "abbreviations": {"FL": "formation level"}, "texts": [{"text": "TRACK"}],
}


def test_fields(spark):
    df = spark.createDataFrame([SHEET, {"file": "b c.pdf", "page": 0, "sheet_info": {"title": ""}, "bands_error": "no table"}], schemas.SHEET)
    spans = {r.sheet: r for r in d.sheet_spans(df).collect()}
    assert spans["KGP-1_007"].asDict() == {"sheet": "KGP-1_007", "line": "4th line", "revision": "R2", "low": 1240000.0, "high": 1241000.5}
    assert spans["b_c_p01"].line is None and spans["b_c_p01"].revision == "R0"
    rail, ruling = d.constants(F.col("notes"))
    assert [(r[0], r[1]) for r in df.select(rail, ruling).collect()] == [(0.8, 200.0), (0.762, 150.0)]
    assert sorted((r.pos, r.field, r.value) for r in d.band_cells(df).collect()) == [(1240000.0, "fl", 5.0), (1240000.0, "rl", 6.0)]
    flags = df.select(F.explode("bridges").alias("b")).select("b.bridge_id", d.complete(F.col("b")).alias("ok")).collect()
    assert [r.ok for r in flags] == [True, False]
    got = {(r.grp, r.ref) for r in d.facts(df).collect()}
    assert got == {("bridge", "516"), ("bridge", "517"), ("note", "5"), ("note", "6"), ("abbreviation", "FL"), ("text", "TRACK")}
    where = df.select(F.explode(F.array(F.lit(5.0), F.lit(10.0), F.lit(30.0), F.lit(None))).alias("x")).select(d.belongs_to(F.col("x"), F.lit(10.0), F.lit(20.0)).alias("w")).limit(4).collect()
    assert [r.w for r in where] == ["previous sheet", "this sheet", "next sheet", None]


def test_callouts(spark):
    cases = {
        "C/L OF EXG. BR. NO. 77 STONE ARCH - 2 X 1.25 - CANAL PRO TO BE EXTENDED AS 3 X 2 X 1.5 - BOX CELL (MAJOR) AT CH: 4005.25": ("77", "STONE ARCH", "2 X 1.25", "CANAL", "3 X 2 X 1.5 - BOX CELL", "MAJOR", 4005.25),
        "C/L OF EXG. LC 9 FOREST PATH AT CH: 818.5": ("LC-9", "LEVEL CROSSING", None, "FOREST PATH", None, None, 818.5),
        "C/L OF EXG. ROB-31 TOWN ROAD SPACE AVAILABLE FOR PROP. LINE AT CH: 77.0": ("ROB-31", "ROB", None, "TOWN ROAD", "none - space available for proposed line", None, 77.0),
        "C/L OF EXG. BR. NO. 8 PIPE - 1 X 0.6 - DITCH EXISTING STRUCTURE IS SUFFICIENT AT CH: 5.0": ("8", "PIPE", "1 X 0.6", "DITCH", "none - existing structure is sufficient", None, 5.0),
        "something else": None,
    }
    df = spark.createDataFrame([(t,) for t in cases], "t string").select("t", d.callout(F.col("t")).alias("c"))
    for r in df.collect():
        want = cases[r.t]
        got = r.c and (r.c.bridge_id, r.c.existing_type, r.c.existing_span, r.c.crossing, r.c.proposal, r.c.category, r.c.chainage_m)
        assert got == want


def test_level_blocks(spark):
    texts = ["EX. FL : 41.5 PROP. FL : 42.25 HFL : 40.125 BL : 33.75", "FL UP LINE = 9.5 FL 3RD LINE = 9.625 FL 4TH LINE = 10.0", "EXG FL = 88.25 FL = 88.5 B.L = 80.0"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(d.level_block(F.col("t")).alias("b"))
    assert [(r.b.existing_fl, r.b.proposed_fl, r.b.bed_level) for r in df.collect()] == [(41.5, 42.25, 33.75), (9.5, 10.0, None), (88.25, 88.5, 80.0)]
