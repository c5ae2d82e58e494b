"""Components over tiles, views of points, contained and joined readings, tables from words: against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from plumbline.operators import graph, grid, pieces


def plain_components(cells):
    left, out = set(cells), {}
    while left:
        todo = [min(left)]
        left.discard(todo[0])
        own = list(todo)
        while todo:
            p, y, x = todo.pop()
            for c in ((p, y + 1, x), (p, y - 1, x), (p, y, x + 1), (p, y, x - 1)):
                if c in left:
                    left.discard(c)
                    todo.append(c)
                    own.append(c)
        out |= dict.fromkeys(own, min(own)[1:])
    return out


@pytest.mark.parametrize("share", [0.45, 0.62])
def test_components_over_tiles(spark, share):
    """Random pages, a snake through all tiles, cells at negative places, repeated rows; tiles of three."""
    rng = random.Random(1)
    cells = [(p, y, x) for p in (1, 2) for y in range(-7, 14) for x in range(-6, 15) if rng.random() < share]
    snake = [(3, y, x) for y in range(0, 13) for x in range(12) if y % 2 == 0 or x == (11 if y % 4 == 1 else 0)]
    df = spark.createDataFrame(cells + snake + cells[:5], "page long, y long, x long")
    got = {(r.page, r.y, r.x): (r.comp.y, r.comp.x) for r in grid.components(df, tile=3).collect()}
    assert got == plain_components(cells + snake)
    assert grid.components(df.where("false")).count() == 0


def test_components_of_links(spark):
    rng = random.Random(2)
    links = [(k, k + 1) for k in range(300)] + [(1000 + rng.randrange(99), 1000 + rng.randrange(99)) for _ in range(60)] + [(5, 5), (None, 7), (7, None), (2000, 2000)]
    got = {r.node: r.comp for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    root = {}

    def find(a):
        while root.setdefault(a, a) != a:
            a = root[a]
        return a

    for a, b in links:
        if a is not None and b is not None:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    assert got == {a: find(a) for a in root}


def test_chains(spark):
    links = [(k, k - 1 if k % 50 else None) for k in range(150)] + [(900, None), (901, 900), (902, 900)]
    got = {r.id: (r.head, r.rank) for r in graph.chains(spark.createDataFrame(links, "id long, prev long")).collect()}
    assert got == {k: (k // 50 * 50, k % 50) for k in range(150)} | {900: (900, 0), 901: (900, 1), 902: (900, 1)}


def test_cells_and_dilation(spark):
    boxes = spark.createDataFrame([(1, 0.0, 0.0, 2.5, 1.0), (1, 5.0, 5.0, 4.0, 6.0), (2, None, 0.0, 1.0, 1.0)], "page long, x0 double, y0 double, x1 double, y1 double")
    cells = grid.cells_of_boxes(boxes, 1.0)
    assert {tuple(r) for r in cells.collect()} == {(1, y, x) for y in (0, 1) for x in (0, 1, 2)}
    one = cells.where("y = 0 and x = 0")
    assert {tuple(r) for r in grid.dilated(one, 2).collect()} == {(1, y, x) for y in range(-2, 3) for x in range(-2, 3)}
    strokes = spark.createDataFrame([(1, 0.2, 0.2, 3.2, 0.2), (1, 0.0, 0.0, 90.0, 0.0), (1, 0.5, 0.5, 0.5, 0.5)], "page long, x0 double, y0 double, x1 double, y1 double")
    assert {tuple(r) for r in grid.cells_of_strokes(strokes, 1.0, 50.0).collect()} == {(1, 0, x) for x in range(4)}


def test_views_of_points(spark):
    cells = spark.createDataFrame([(1, 0, 0, 7), (1, 0, 1, 7), (1, 1, 0, 8), (1, 2, 2, 9), (1, 3, 3, None)], "page long, y long, x long, view long")
    views = spark.createDataFrame([(1, 20, 50.0, 50.0, 90.0, 90.0), (1, 21, 60.0, 60.0, 70.0, 70.0), (1, 22, 60.0, 60.0, 70.0, 70.0)], "page long, view long, x0 double, y0 double, x1 double, y1 double")
    # on a cell; around it by majority; a tie; boxes; the edge of a box; nothing
    points = [(1, 0, 0.5, 0.5), (1, 1, -0.5, -0.5), (1, 2, 1.5, 1.5), (1, 3, 65.0, 65.0), (1, 4, 91.5, 60.0), (1, 5, 300.0, 0.0), (1, 6, 4.5, 2.5)]
    got = {r.point: r.view for r in grid.views_of_points(spark.createDataFrame(points, "page long, point long, x double, y double"), cells, views, 1.0).collect()}
    assert got == {0: 7, 1: 7, 2: 7, 3: 21, 4: 20, 6: 9}


TEXTS = "page long, id long, text string, x0 double, y0 double, x1 double, y1 double, size double"


@pytest.mark.parametrize("seed", range(2))
def test_contained_readings(spark, seed):
    rng = random.Random(seed)
    rows = []
    for k in range(150):
        x, y = rng.randrange(60), rng.randrange(40)
        rows.append((rng.randrange(2), k, rng.choice([None, "", "x" * rng.randrange(1, 12)]), float(x), float(y), float(x + rng.randrange(0, 30)), float(y + rng.randrange(0, 12)), 10.0))
    kept = []
    area = lambda b: max(0, b[5] - b[3]) * max(0, b[6] - b[4])
    for r in sorted(rows, key=lambda r: (r[2] is not None, -len(r[2] or ""), r[1])):
        over = lambda o, r=r: max(0, min(o[5], r[5]) - max(o[3], r[3])) * max(0, min(o[6], r[6]) - max(o[4], r[4]))
        if not any(o[0] == r[0] and area(r) > 0 and over(o) > 0.6 * area(r) for o in kept):
            kept.append(r)
    got = pieces.without_contained(spark.createDataFrame(rows, TEXTS), size=7.0)
    assert sorted(r.id for r in got.collect()) == sorted(r[1] for r in kept)
    assert got.columns == [c.split(" ")[0] for c in TEXTS.split(", ")]


def test_contained_readings_in_a_chain(spark):
    """Each covers the next: every second one stays."""
    rows = [(1, k, "x" * (40 - k), 3.0 * k, 0.0, 3.0 * k + 10, 10.0, 1.0) for k in range(30)]
    got = pieces.without_contained(spark.createDataFrame(rows, TEXTS))
    assert sorted(r.id for r in got.collect()) == list(range(0, 30, 2))
    assert pieces.without_contained(spark.createDataFrame([], TEXTS)).count() == 0


def test_joined_pieces(spark):
    rows = [
        (1, 1, "BORE", 0.0, 0.0, 20.0, 10.0, 10.0),
        (1, 2, "LOG", 25.0, 1.0, 40.0, 11.0, 10.0),
        (1, 3, "AT", 45.0, 0.0, 55.0, 10.0, 10.0),
        (1, 4, "far", 70.0, 0.0, 80.0, 10.0, 10.0),
        (1, 5, "low", 25.0, 9.0, 40.0, 19.0, 10.0),
        (2, 6, "other", 25.0, 1.0, 40.0, 11.0, 10.0),
        (1, 7, None, 57.0, 0.0, 60.0, 10.0, 10.0),
    ]
    got = {r.id: (r.text, r.x0, r.x1, r.pieces) for r in pieces.joined_pieces(spark.createDataFrame(rows, TEXTS)).collect()}
    assert got == {1: ("BORE LOG AT ", 0.0, 60.0, 4), 4: ("far", 70.0, 80.0, 1), 5: ("low", 25.0, 40.0, 1), 6: ("other", 25.0, 40.0, 1)}


def test_clusters_along_cross_stretches(spark):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), k, float(rng.randrange(400))) for k in range(120)] + [("a", 500, None)]
    got = {r.id: r.cluster for r in pieces.clusters_along(spark.createDataFrame(rows, "key string, id long, v double"), "key", "v", 5.0, stretch=20.0).collect()}
    want = {}
    for key in "ab":
        last = start = None
        for k, i, v in sorted((r for r in rows if r[0] == key and r[2] is not None), key=lambda r: r[2]):
            start = v if last is None or v - last >= 5 else start
            last, want[i] = v, start
    assert got == want


def test_table_of_words(spark):
    word = lambda page, k, text, x, y: (page, k, text, float(x), float(y), float(x + 20), float(y + 8))
    one = [word(1, 10 * r + c, t, 10 + 60 * c, 100 + 30 * r) for r, row in enumerate([["1A", "span", "12.5"], ["2", None, "7"], ["3", "box", "9"]]) for c, t in enumerate(row) if t]
    one += [word(1, 90, "long", 71, 112), word(1, 91, "late", 128, 141), word(1, 92, "above", 10, 60), (1, 93, "odd", None, 1.0, 2.0, 2.0)]
    two = [word(2, k, t, x, 50) for k, (t, x) in enumerate([("1", 10), ("x", 70)])]
    df = spark.createDataFrame(one + two, "page long, id long, text string, x0 double, y0 double, x1 double, y1 double")
    got = {(r.page, r.row, r.column): r.text for r in pieces.table_of_words(df, F.col("text").rlike(r"^\d[A-Z]?$") & (F.col("x0") < 30), 3).collect()}
    assert got == {(1, 0, 1): "1A", (1, 0, 2): "span long", (1, 0, 3): "12.5", (1, 10, 1): "2", (1, 10, 3): "7 late", (1, 20, 1): "3", (1, 20, 2): "box", (1, 20, 3): "9"}


def test_table_of_words_of_small_and_large_pages(spark, shuffled, monkeypatch):
    """Pages of a few words do not go through cells and stretches, whose copies and counts are many rows; the rows are the same."""
    rng = random.Random(5)
    rows = []
    for page in range(300):
        for k in range(rng.randrange(1, 7)):
            rows.append((page, 10 * k, "A", 20.0, 25.0 * k + rng.randrange(3)))
            rows += [(page, 10 * k + c, f"w{c}", 80.0 * c + rng.randrange(12), 25.0 * k + rng.randrange(9)) for c in range(1, 4) if rng.random() < 0.9]
    words = spark.createDataFrame([(*r, r[3] + 30, r[4] + 8) for r in rows], "page long, id long, text string, x0 double, y0 double, x1 double, y1 double")
    table = lambda: sorted(map(tuple, pieces.table_of_words(words, F.col("text") == "A", 4).collect()))
    got = []
    assert shuffled(lambda: got.append(table())) < 4 * len(rows)
    for most in (0, 12):
        monkeypatch.setattr(pieces, "WORDS", most)
        got.append(table())
    assert len(got[0]) > 1000
    assert got[0] == got[1] == got[2]


def test_joined_pieces_of_small_and_large_pages(spark, shuffled, monkeypatch):
    """Pieces of small pages meet on their page, not as nine copies, and single ones take no part in chains."""
    rng = random.Random(7)
    rows = [(page, 10 * page + k, f"t{k}", 40.0 * k + rng.randrange(12), 5.0 * rng.randrange(2), 10.0 + rng.randrange(4)) for page in range(400) for k in range(7)]
    texts = spark.createDataFrame([(p, i, t, x, y, x + 28, y + 8, s) for p, i, t, x, y, s in rows], TEXTS)
    lines = lambda: sorted(map(tuple, pieces.joined_pieces(texts).collect()))
    got = []
    assert shuffled(lambda: got.append(lines())) < 8 * len(rows)
    monkeypatch.setattr(pieces, "LINES", 0)
    got.append(lines())
    assert {n for *_, n in got[0]} >= {1, 2, 3}
    assert got[0] == got[1]
