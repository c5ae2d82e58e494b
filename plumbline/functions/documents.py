"""Fields of nested sheet documents, and the parsers of callouts and level blocks, as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.parse import group, km_to_m, number, one_in, plain

# Phrases and patterns that the sheets print.
SPAN = r"[0-9]+ *X *[0-9.]+(?: *\+ *[0-9]+ *X *[0-9.]+)*"
EXTENDED = "PRO TO BE EXTENDED AS"
SUFFICIENT = "EXISTING STRUCTURE IS SUFFICIENT"
SPACE = "SPACE AVAILABLE"
REQUIRED = ("bridge_id", "existing_type", "existing_span", "crossing", "proposal", "chainage_m")
RAIL_MM, RULING = 762.0, 150.0


def line_of(lines: Column, title: Column) -> Column:
    """The proposed line: as the band says, else by the title; lower case."""
    printed = F.nullif(F.element_at(lines, F.lit("proposed")), F.lit(""))
    by_title = F.when(title.contains("4TH LINE"), "4TH LINE").when(title != "", "3RD LINE")
    return F.lower(F.coalesce(printed, by_title))


def revision_of(issue_record: Column) -> Column:
    """The last record's revision; R0 without records."""
    return F.when(F.coalesce(F.size(issue_record), F.lit(0)) <= 0, "R0").otherwise(F.try_element_at(issue_record, F.lit(-1))["rev"])


def belongs_to(pos: Column, low: Column, high: Column) -> Column:
    return F.when(pos.isNull() | low.isNull(), None).when(pos.between(low, high), "this sheet").when(pos < low, "previous sheet").otherwise("next sheet")


def complete(bridge: Column) -> Column:
    """All required fields are there; 0 and the empty text count as missing."""
    out = F.lit(True)
    for f in REQUIRED:
        out = out & F.coalesce(bridge[f] != 0 if f == "chainage_m" else bridge[f] != "", F.lit(False))
    return out


def sheet_id(drawing_no: Column, file: Column, page: Column) -> Column:
    """Series and number of the drawing, else the file's name and page (from 0)."""
    series, n = group(drawing_no, r"/([A-Z0-9-]+)/P&P/[0-9]+"), group(drawing_no, r"/[A-Z0-9-]+/P&P/([0-9]+)")
    stem = F.regexp_replace(F.regexp_replace(F.regexp_extract(file, r"([^/]*)$", 1), r"\.[^.]*$", ""), "[^A-Za-z0-9]+", "_")
    return F.when(series.isNotNull(), F.format_string("%s_%03d", series, n.cast("int"))).otherwise(F.concat(stem, F.format_string("_p%02d", page + 1)))


def constants(notes: Column) -> tuple[Column, Column]:
    """(rail above formation in metres, N of the ruling gradient 1 in N) from the notes, with defaults."""
    text = F.array_join(F.transform(notes, lambda n: n["text"]), " ")
    rail = number(group(text, r"RAIL LEVEL SHOULD BE ([0-9]+)\s*MM ABOVE FORMATION"))
    return F.coalesce(rail, F.lit(RAIL_MM)) / 1000, F.coalesce(one_in(group(text, r"(RULING GRADIENT[^.]*?1 IN [0-9]+)")), F.lit(RULING))


def _clean(x: Column) -> Column:
    return F.nullif(F.regexp_replace(x, r"^[\s-]+|[\s-]+$", ""), F.lit(""))


def _once(x: Column, f: Callable[[Column], Column]) -> Column:
    """``f(x)`` with ``x`` worked out once, however often ``f`` names it: columns are expressions and would be repeated."""
    return F.get(F.transform(F.array(x), f), F.lit(0))


def callout(text: Column) -> Column:
    """A bridge callout as a struct; null for a text that is none."""
    return _once(text, lambda t: F.when(t.rlike("^C/L OF EXG"), _callout(t)))


def _callout(text: Column) -> Column:
    head = r"^C/L OF EXG\.? *"
    kind = r"(?:BR\.? *NO\.? *)"
    lc, rob = group(text, head + kind + r"?(LC[ -]?[0-9]+\w*)"), group(text, head + r"(ROB(?:-[0-9]+)?)")
    plain_no = group(text, head + kind + r"([\w-]+(?:\([\w -]+\))?)")
    rest = F.regexp_replace(text, head + r"(?:" + kind + r"?LC[ -]?[0-9]+\w*|ROB(?:-[0-9]+)?|" + kind + r"[\w-]+(?:\([\w -]+\))?) *", "")
    found = F.struct(lc.alias("lc"), rob.alias("rob"), plain_no.alias("no"), number(group(text, r"AT CH: *([0-9.]+)")).alias("pos"), rest.alias("rest"))
    return _once(found, lambda x: _once(_callout_body(x["rest"]), lambda y: _callout_fields(x, y)))


def _callout_body(rest: Column) -> Column:
    body = F.regexp_replace(rest, "^(UP|DN) ", "")
    body = F.regexp_replace(body, rf"({EXTENDED}|{SUFFICIENT}|(?:ROB PROPOSED BY [\w.]+ *)?{SPACE}|AT CH:).*$", "")
    wanted = lambda after: _clean(F.regexp_extract(after, r"^(.*?)(?:\(|AT CH:|$)", 1))
    after = _once(group(rest, rf"{EXTENDED} *(.*)$"), lambda a: F.struct(a.alias("text"), wanted(a).alias("wanted")))
    return _once(body, lambda b: F.struct(b.alias("body"), group(b, f"({SPAN})").alias("span"), F.filter(F.split(b, r"\s*-\s*"), lambda p: p != "").alias("parts"), b.rlike(r"^\s*-").alias("held"), after.alias("after")))


def _callout_fields(x: Column, y: Column) -> Column:
    lc, rob, plain_no, pos, rest = (x[c] for c in ("lc", "rob", "no", "pos", "rest"))
    body, span, parts, held, after, wanted = y["body"], y["span"], y["parts"], y["held"], y["after"]["text"], y["after"]["wanted"]
    named = F.when((rob == "ROB") & pos.isNotNull(), F.concat(F.lit("ROB at CH "), plain(pos))).when(rob != "ROB", rob)
    ident = F.coalesce(F.regexp_replace(lc, "^LC[ -]?", "LC-"), named, F.when(rob.isNull(), plain_no))
    on = F.when(rest.rlike("^(UP|DN) "), F.concat(F.lit("existing "), F.substring(rest, 1, 2), F.lit(" line")))
    before_span, behind = F.regexp_extract(body, f"^(.*?){SPAN}", 1), F.regexp_extract(body, rf"^.*?{SPAN}(.*)$", 1)
    etype = F.when(rob.isNotNull(), "ROB").when(held, None).when(span.isNotNull(), _clean(before_span)).when(lc.isNotNull(), "LEVEL CROSSING").otherwise(F.get(parts, F.lit(0)))
    over = F.when(held, None).when(span.isNotNull() & rob.isNull(), _clean(behind)).when(rob.isNotNull() | lc.isNotNull(), _clean(body)).otherwise(F.nullif(F.array_join(F.slice(parts, 2, 9), " "), F.lit("")))
    proposal = F.when(rest.contains(SUFFICIENT), "none - existing structure is sufficient").when(rest.contains(SPACE), "none - space available for proposed line").when(wanted.rlike(r"[0-9] *X"), wanted)
    category = F.when(wanted.rlike(r"[0-9] *X"), group(after, r"\(([^)]*)\)"))
    return F.struct(ident.alias("bridge_id"), on.alias("existing_on"), etype.alias("existing_type"), F.when(rob.isNull() & ~held, span).alias("existing_span"), over.alias("crossing"), proposal.alias("proposal"), category.alias("category"), pos.alias("chainage_m"))


def level_block(text: Column) -> Column:
    """Existing and proposed formation level and bed level: named lines first (UP and DN exist, the highest ordinal is proposed)."""
    num = r"\s*[:=]\s*([0-9]+(?:\.[0-9]+)?)"
    by_no = F.transform(F.regexp_extract_all(text, F.lit(r"FL ([0-9])(?:ST|ND|RD|TH) LINE\s*[:=]\s*[0-9.]+"), F.lit(0)), lambda x: F.struct(F.regexp_extract(x, r"FL ([0-9])", 1).cast("int").alias("k"), number(F.regexp_extract(x, r"([0-9.]+)$", 1)).alias("v")))
    ranked = F.sort_array(by_no, asc=False)
    old = number(group(text, r"FL (?:UP|DN) LINE" + num))
    printed_old = number(group(text, r"EX(?:G|IST(?:ING)?)?\.?\s*FL" + num))
    printed_new = F.coalesce(number(group(text, r"PROP(?:OSED)?\.?\s*FL" + num)), number(group(text, r"(?<![A-Z.] )(?<![A-Z])FL" + num)))
    bed = number(group(text, r"(?<![A-Z])B\.?\s?L\.?" + num))
    return F.struct(F.coalesce(old, F.get(ranked, F.lit(1))["v"], printed_old).alias("existing_fl"), F.coalesce(F.get(ranked, F.lit(0))["v"], printed_new).alias("proposed_fl"), bed.alias("bed_level"))


def band_cells(sheets: DataFrame) -> DataFrame:
    """The columnar band in long form: sheet, line, pos, field, value; columns that failed their checks are left out."""
    info = F.col("sheet_info")
    rows = sheets.select(sheet_id(info["drawing_no"], F.col("file"), F.col("page")).alias("sheet"), line_of(F.col("lines"), info["title"]).alias("line"), F.explode("columns").alias("c")).where("c.checks_ok")
    return rows.select("sheet", "line", F.col("c.chainage").alias("pos"), F.explode("c.values").alias("field", "value"))


def sheet_spans(sheets: DataFrame) -> DataFrame:
    info = F.col("sheet_info")
    return sheets.select(sheet_id(info["drawing_no"], F.col("file"), F.col("page")).alias("sheet"), line_of(F.col("lines"), info["title"]).alias("line"), revision_of(info["issue_record"]).alias("revision"), km_to_m(info["chainage_from"]).alias("low"), km_to_m(info["chainage_to"]).alias("high"))


def facts(sheets: DataFrame) -> DataFrame:
    """Every nested item as one line: sheet, grp, text, ref."""
    info = F.col("sheet_info")
    own = sheets.withColumn("sheet", sheet_id(info["drawing_no"], F.col("file"), F.col("page")))
    row = lambda grp, text, ref: F.struct(F.lit(grp).alias("grp"), text.alias("text"), ref.cast("string").alias("ref"))
    empty = F.array().cast("array<struct<grp:string,text:string,ref:string>>")
    part = lambda items, f: F.coalesce(F.transform(items, f), empty)
    all_rows = F.concat(
        part(F.col("bridges"), lambda b: row("bridge", F.concat_ws(" ", F.lit("Bridge"), b["bridge_id"], F.lit("at"), plain(b["chainage_m"]), b["crossing"]), b["bridge_id"])),
        part(F.col("curves"), lambda c: row("curve", F.concat_ws(" ", F.lit("Curve"), c["curve_no"], c["line"]), c["curve_no"])),
        part(F.col("notes"), lambda n: row("note", n["text"], n["no"])),
        part(F.map_entries("abbreviations"), lambda e: row("abbreviation", F.concat_ws(": ", e["key"], e["value"]), e["key"])),
        part(F.col("texts"), lambda t: row("text", t["text"], t["text"])),
    )
    return own.select("sheet", F.explode(all_rows).alias("f")).select("sheet", "f.*").where("text is not null")
