"""Cleaning of recognised text: readings inside longer ones go, pieces of one line are joined, tables are built from words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.operators.assign import settle
from plumbline.operators.graph import chains, linked
from plumbline.operators.positional import asof_pair, close_by, neighbours, parted
from plumbline.scratch import scratch, written

#: Lines or pieces of a page that all meet each other; those of larger pages meet by cells.
LINES = 64
#: Words of a page that a task reads as they are; those of larger pages are dealt out by cells and stretches.
WORDS = 256


def _overlaps(rows: DataFrame, size: float) -> DataFrame:
    """Pairs (a, b of the same page, columns of b with the prefix o_) whose boxes overlap, met by cells of ``size``."""
    span = lambda lo, hi: F.explode(F.sequence(F.floor(F.col(lo) / size), F.floor(F.col(hi) / size)))
    cut = rows.withColumn("cy", span("y0", "y1")).withColumn("cx", span("x0", "x1"))
    other = cut.select("page", "cy", "cx", *[F.col(c).alias(f"o_{c}") for c in rows.columns if c != "page"])
    wide, high = F.least("x1", "o_x1") - F.greatest("x0", "o_x0"), F.least("y1", "o_y1") - F.greatest("y0", "o_y0")
    met = cut.join(other, ["page", "cy", "cx"]).withColumn("shared", F.greatest(wide, F.lit(0.0)) * F.greatest(high, F.lit(0.0)))
    # a pair is met in many cells; the first of them counts
    first = (F.col("cy") == F.floor(F.greatest("y0", "o_y0") / size)) & (F.col("cx") == F.floor(F.greatest("x0", "o_x0") / size))
    return met.where(first & (F.col("shared") > 0)).drop("cy", "cx")


def without_contained(texts: DataFrame, share: float = 0.6, size: float = 50.0) -> DataFrame:
    """``texts`` (page, id, text, x0, y0, x1, y1) without those of whose area a longer one that is kept covers over ``share``.

    Longer texts come first, of equal ones the smaller id. Only a kept text excludes others: a text is settled once all before
    it that cover it are, and rounds go on until all are settled. Texts without a box, or with an empty one, are kept."""
    with scratch(texts.sparkSession):
        boxes = texts.where("x0 < x1 and y0 < y1").select("page", "id", F.struct((-F.length("text")).alias("n"), F.col("id").alias("i")).alias("place"), "x0", "y0", "x1", "y1")
        over = _overlaps(boxes, size).where("o_place < place").where(F.col("shared") > share * (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0")))
        over = written(over.select("page", "id", F.col("o_id").alias("by")), "covered")
        # by: covers id unless it goes itself
        left, gone = over, None
        while not left.isEmpty():
            open_ = left.select("page", "id").distinct()
            kept = left.join(open_.withColumnRenamed("id", "by"), ["page", "by"], "left_anti")
            falls = written(kept.select("page", "id").distinct(), "fallen")
            gone = falls if gone is None else gone.unionByName(falls)
            # what has fallen neither waits nor covers any more
            left = written(left.join(falls, ["page", "id"], "left_anti").join(falls.withColumnRenamed("id", "by"), ["page", "by"], "left_anti"), "covered")
        out = texts if gone is None else texts.join(gone, ["page", "id"], "left_anti").select(*texts.columns)
        return written(out, "uncovered", keep=True)


def line_links(texts: DataFrame, beside: float = 0.35, ahead: float = 0.9, reach: float = 100.0) -> DataFrame:
    """(id, prev): for each text that continues a piece of its line, that piece. Ids are unique.

    ``texts``: page, id, x0, y0, x1, y1, size. A piece continues the one whose middle line is less than ``beside`` of the
    larger size away and that ends less than ``ahead`` of it before its start; the nearest of several, then the smaller id.
    Of several pieces that continue one, the nearest does. ``reach`` bounds the sizes: pieces of larger ones meet no other."""
    rows = texts.select("page", "id", "x0", "x1", ((F.col("y0") + F.col("y1")) / 2).alias("mid"), "size").where(F.col("size") <= reach)
    others = lambda r: r.select("page", F.col("id").alias("prev"), F.col("x1").alias("end"), F.col("mid").alias("omid"), F.col("size").alias("osize"))
    few, many = parted(rows, ["page"], LINES)
    met = few.join(others(few), "page")
    if many is not None:
        met = met.unionByName(close_by(many, others(many), ["page"], [("x0", "end", ahead * reach), ("mid", "omid", beside * reach)]))
    large, gap = F.greatest("size", "osize"), F.col("x0") - F.col("end")
    met = met.where((F.col("id") != F.col("prev")) & (gap >= 0) & (gap < ahead * large) & (F.abs(F.col("mid") - F.col("omid")) < beside * large))
    # a gap of 0 between texts without width would link both ways
    met = met.withColumn("gap", gap).where((F.col("x1") > F.col("x0")) | (F.col("gap") > 0))
    # by page too: what met on a page is there already
    back = met.groupBy("page", "id").agg(F.min(F.struct("gap", "prev")).alias("p")).select("page", "id", "p.prev", "p.gap")
    return back.groupBy("page", "prev").agg(F.min(F.struct("gap", "id")).alias("p")).select(F.col("p.id").alias("id"), "prev")


def joined_pieces(texts: DataFrame, beside: float = 0.35, ahead: float = 0.9, reach: float = 100.0) -> DataFrame:
    """(page, id, text, x0, y0, x1, y1, pieces): lines of the pieces of ``texts`` (page, id, text, x0, y0, x1, y1, size), with the
    id of the first, their texts joined by a space and the box around all. Ids are unique."""
    with scratch(texts.sparkSession):
        texts = written(texts.select("page", "id", F.coalesce("text", F.lit("")).alias("text"), "x0", "y0", "x1", "y1", "size"), "pieces")
        ranked = chains(linked(written(line_links(texts, beside, ahead, reach), "links")))
        rows = written(texts.drop("size").join(ranked, "id", "left"), "ranked")
        # most pieces are a line of their own: only the others are brought together
        alone = rows.where("head is null").select("page", "id", "text", "x0", "y0", "x1", "y1", F.lit(1).cast("long").alias("pieces"))
        lines = rows.where("head is not null").groupBy("page", "head").agg(
            F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", F.col("text").alias("t")))), lambda p: p["t"]), " ").alias("text"),
            *[F.min(c).alias(c) for c in ("x0", "y0")], *[F.max(c).alias(c) for c in ("x1", "y1")], F.count("*").alias("pieces"),
        )
        return written(alone.unionByName(lines.withColumnRenamed("head", "id")), "lines", keep=True)


def clusters_along(rows: DataFrame, key: str, value: str, gap: float, stretch: float = 10_000.0) -> DataFrame:
    """Adds ``cluster``, the first value of the run of values that lie less than ``gap`` behind the one before; a key's values
    are sorted in stretches, so a long key is dealt to many tasks. Null values are in none."""
    named = rows.where(F.col(value).isNotNull()).withColumn("_back", -F.col(value))
    # the row behind, seen from the other end, is the one before; equal values are one position
    spots = named.select(key, "_back", value).distinct()
    spots = neighbours(spots, key, "_back", ["_back"], F.col(value), stretch)
    spots = spots.withColumn("_start", F.when(F.col("_next").isNull() | (F.col(value) - F.col("_next") >= gap), F.col(value))).drop("_next", "_prev")
    spots = neighbours(spots, key, value, [value], F.col("_start"), stretch).select(key, value, F.col("_prev").alias("cluster"))
    return named.drop("_back").join(spots, [key, value])


def table_of_words(words: DataFrame, is_anchor: Column, columns: int, row_gap: float = 4.0, column_gap: float = 22.0, lead: float = 12.0) -> DataFrame:
    """(page, row, column, text) of the table that loose words (page, id, text, x0, y0, x1, y1) make up.

    Anchors begin rows: those words with ``is_anchor``, one for each height. Columns are clusters of the middles of words on the
    anchors' lines (``row_gap``), cut where the step is ``column_gap`` or more; a cluster counts if it has a word on a third of
    the rows (two at least, or one with up to three rows). A page whose columns are not ``columns`` has no rows. A word goes to
    the row of the last anchor that begins up to ``lead`` below its middle, and to the nearest column, the left one of equals; the
    words of a cell are read from above, then from the left, then by id."""
    with scratch(words.sparkSession):
        w = words.where("page is not null and x0 is not null and y0 is not null and x1 is not null and y1 is not null")
        w = written(w.select("page", "id", "text", "x0", "y0", ((F.col("x0") + F.col("x1")) / 2).alias("cx"), ((F.col("y0") + F.col("y1")) / 2).alias("cy"), F.coalesce(is_anchor, F.lit(False)).alias("anchor")), "words")
        few, many = parted(w, ["page"], WORDS)
        placed = _placed_on_small_pages(few, columns, row_gap, column_gap, lead)
        if many is not None:
            placed = placed.unionByName(_placed_on_large_pages(many, columns, row_gap, column_gap, lead))
        away = F.transform("centres", lambda c: F.abs(c - F.col("cx")))
        words = placed.select("page", "row", F.array_position(away, F.array_min(away)).cast("long").alias("column"), "y0", "x0", "id", F.coalesce("text", F.lit("")).alias("text"))
        cell = Window.partitionBy("page", "row", "column").orderBy("y0", "x0", "id")
        # all of a cell at its first word: one sort, where a grouped list takes three
        whole = F.collect_list("text").over(cell.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        cells = words.withColumn("texts", whole).withColumn("n", F.row_number().over(cell)).where("n = 1")
        return written(cells.select("page", "row", "column", F.array_join("texts", " ").alias("text")), "table", keep=True)


def _anchors(w: DataFrame) -> DataFrame:
    """(page, y0, row, at): of each height with anchors the first of them from the left, and its middle."""
    return w.where("anchor").groupBy("page", "y0").agg(F.min_by("id", F.struct("x0", "id")).alias("row"), F.min_by("cy", F.struct("x0", "id")).alias("at"))


def _centres(spots: DataFrame, columns: int) -> DataFrame:
    """(page, centres) from words on anchors' lines (page, cx, cluster, rows): middles of the clusters that count, on pages with
    ``columns`` of them."""
    found = spots.groupBy("page", "cluster").agg(F.count("*").alias("n"), F.avg("cx").alias("centre"), F.first("rows").alias("rows"))
    held = found.where(F.col("n") >= F.when(F.col("rows") <= 3, 1).otherwise(F.greatest(F.lit(2), F.floor(F.col("rows") / 3))))
    counted = held.groupBy("page").agg(F.count("*").alias("k"), F.collect_list("centre").alias("centres"))
    return counted.where(F.col("k") == columns).select("page", F.array_sort("centres").alias("centres"))


def _placed_on_small_pages(w: DataFrame, columns: int, row_gap: float, column_gap: float, lead: float) -> DataFrame:
    """(page, id, text, x0, y0, cx, row, centres): a page's anchors, at most as many as its words, meet each word in one row."""
    # a word carries its page's lists through the join, so they are short
    anchors = _anchors(w).groupBy("page").agg(F.count("*").alias("rows"), F.collect_list("at").alias("lines"), F.collect_list(F.struct("y0", "row")).alias("begins"))
    lines = anchors.select("page", "rows", "lines")
    near = w.select("page", "id", "cx", "cy").join(lines, "page").where(F.exists("lines", lambda at: F.abs(F.col("cy") - at) < row_gap))
    # words of a page stay together from here on
    spots = near.groupBy("page", "id", "cx").agg(F.first("rows").alias("rows"))
    along = Window.partitionBy("page").orderBy("cx")
    back = F.lag("cx").over(along)
    spots = spots.withColumn("start", F.when(back.isNull() | (F.col("cx") - back >= column_gap), F.col("cx")))
    clusters = spots.withColumn("cluster", F.last("start", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, 0)))
    pages = anchors.select("page", "begins").join(_centres(clusters, columns), "page")
    last = F.array_max(F.filter("begins", lambda a: a["y0"] - lead <= F.col("cy")))
    return w.join(pages, "page").select("page", "id", "text", "x0", "y0", "cx", last["row"].alias("row"), "centres").where("row is not null")


def _placed_on_large_pages(w: DataFrame, columns: int, row_gap: float, column_gap: float, lead: float) -> DataFrame:
    """The same by cells and stretches, so that a page is dealt to many tasks."""
    anchors = written(_anchors(w), "anchors")
    rows = anchors.groupBy("page").agg(F.count("*").alias("rows"))
    near = close_by(w.select("page", "id", "cx", "cy"), anchors.select("page", "at"), ["page"], [("cy", "at", row_gap)]).select("page", "id", "cx").distinct()
    centres = _centres(clusters_along(near, "page", "cx", column_gap).join(rows, "page"), columns)
    begin = anchors.select("page", (F.col("y0") - lead).alias("cy"), F.col("row"), F.lit(0).cast("long").alias("id"))
    placed = asof_pair(w.select("page", "cy", "id", "text", "cx", "x0", "y0"), begin, "page", "cy", "row", "id").where("prev is not null").join(centres, "page")
    return placed.select("page", "id", "text", "x0", "y0", "cx", F.col("prev").alias("row"), "centres")


def in_reading_frame(lines: DataFrame) -> DataFrame:
    """``lines`` with u0, v0, u1, v1: the box (x0, y0, x1, y1) along and across the way the text runs (``way``): right, up or
    down; the next line of a text has the larger v. Lines of other ways are left out."""
    turned = {"right": ("x0", "y0", "x1", "y1"), "up": ("-y1", "x0", "-y0", "x1"), "down": ("y0", "-x1", "y1", "-x0")}
    box = {k: F.when(F.col("way") == "right", F.expr(turned["right"][n])).when(F.col("way") == "up", F.expr(turned["up"][n])).when(F.col("way") == "down", F.expr(turned["down"][n])) for n, k in enumerate(("u0", "v0", "u1", "v1"))}
    return lines.withColumns(box).where("u0 is not null")


def callout_chains(lines: DataFrame, excluded: Column, stops: Column, longest: int = 5, tallest: float = 60.0) -> DataFrame:
    """(page, id, text, ids): labels written over several lines, by their first line; at most ``longest`` lines each.

    ``lines``: page, id, text, way, colour, size, x0, y0, x1, y1. A line goes on in the one right under it (up to 1 into it, less
    than 0.8 of its height or 3.5 away) of the same way and colour and nearly its size, that starts (8) or ends (4) where it does
    or is centred under it (10), has a word of three letters and no figure, and is neither ``excluded`` nor one that ``stops``.
    Lines choose in reading order, the nearest below that none before took; ties go to the smaller id. Lines taller than
    ``tallest`` have none under them. A bar in a text is a space."""
    with scratch(lines.sparkSession):
        named = lines.withColumn("_out", F.coalesce(excluded, F.lit(False))).withColumn("_stop", F.coalesce(stops, F.lit(False))).where("not _out")
        l = written(in_reading_frame(named).withColumn("mid", (F.col("u0") + F.col("u1")) / 2).select("page", "id", "text", "way", "colour", "size", "u0", "v0", "u1", "v1", "mid", "_stop"), "lines")
        under = ~F.col("_stop") & F.col("text").rlike("[A-Za-z]{3}") & ~F.col("text").rlike("[0-9]")
        nexts = lambda u: u.select("page", "way", F.col("id").alias("next"), *[F.col(c).alias(f"o_{c}") for c in ("colour", "size", "u0", "v0", "u1", "mid")])
        down = F.col("o_v0") - F.col("v1")
        fits = (F.col("id") != F.col("next")) & F.col("colour").eqNullSafe(F.col("o_colour")) & (F.abs(F.col("size") - F.col("o_size")) <= 0.25 * F.col("size"))
        fits = fits & (down >= -1) & (down < F.greatest(F.lit(3.5), 0.8 * (F.col("v1") - F.col("v0"))))
        axes = (("u0", 8.0), ("mid", 10.0), ("u1", 4.0))
        low = F.col("v1") - F.col("v0") <= tallest
        pair = lambda met: met.where(fits).select(F.col("page").alias("sheet"), F.struct("v0", "u0", "id").alias("block"), F.col("next").alias("curve"), F.col("o_v0").alias("gap"))
        few, many = parted(l, ["page", "way"], LINES)
        beside = F.lit(False)
        for a, reach in axes:
            beside = beside | (F.abs(F.col(a) - F.col(f"o_{a}")) < reach)
        pairs = pair(few.where(low).join(nexts(few.where(under)), ["page", "way"]).where(beside))
        if many is not None:
            cells = [pair(close_by(many.where(low), nexts(many.where(under)), ["page", "way"], [("v1", "o_v0", max(3.5, 0.8 * tallest)), (a, f"o_{a}", reach)])) for a, reach in axes]
            pairs = pairs.unionByName(cells[0].unionByName(cells[1]).unionByName(cells[2]).distinct())
        # what follows what is settled like blocks that take turns
        taken = written(settle(pairs).select(F.col("curve").alias("id"), F.col("block.id").alias("prev")), "taken")
        ranked = chains(linked(taken))
        parts = ranked.where(F.col("rank") < longest).join(l.select("page", "id", "text"), "id").groupBy("page", "head")
        rows = parts.agg(F.array_sort(F.collect_list(F.struct("rank", "id", F.coalesce("text", F.lit("")).alias("t")))).alias("parts")).where(F.size("parts") > 1)
        text = F.trim(F.regexp_replace(F.regexp_replace(F.array_join(F.col("parts.t"), " "), r"\|", " "), r"\s+", " "))
        return written(rows.select("page", F.col("head").alias("id"), text.alias("text"), F.col("parts.id").alias("ids")), "callouts", keep=True)
