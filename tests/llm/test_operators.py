"""Corpus operators against brute force, on hand-made rows and on the smallest tables."""

import collections
import hashlib
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plumbline.llm import chat, common, decontam, html_crf, jaccard, mixing, registry, shingling, spans, suffix, topk, toxicity, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows, extra=False):
    df = spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], DOCS)
    return df.withColumn("score", F.lit(1)).withColumn("at", F.lit("x")).withColumn("n", F.lit(2)) if extra else df


def words(rng, n):
    return " ".join("".join(rng.choices(["an", "be", "cro", "du", "el", "fi"], k=rng.randint(2, 4))) for _ in range(n))


EDGE = [(1, None, "a"), (2, "", "a"), (3, "one", None), (3, "one", None), (None, "two words", "b"), (None, None, None), (5, "x " * 5000, "a")]


@pytest.fixture(scope="module")
def real(sf):
    return sorted(duckdb.sql(f"SELECT doc_id, text, source FROM '{sf}/documents.parquet'").fetchall())


def test_shared_dir_is_the_sessions(spark):
    assert common.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_equals_sql(spark, sf, name):
    c = duckdb.connect()
    for t in ("documents", "embeddings", "labels", "pages", "conversations"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    got = registry.QUERIES[name](spark, sf)
    cols = sorted(got.columns)
    key = lambda rows: sorted(tuple("" if x is None or x != x else str(x) for x in r) for r in rows)
    want = c.sql(f"SELECT {', '.join(cols)} FROM ({registry.SQL[name]})").fetchall()
    assert key([tuple(r[x] for x in cols) for r in got.collect()]) == key(want)


# 1


def cut_sentences(text):
    """Pieces of a text behind line ends and behind . ! ? with marks and white space, one character after another."""
    out, at, k = [], 0, 0
    while k < len(text):
        j = k
        if text[k] in ".!?…":
            while j < len(text) and text[j] in ".!?…":
                j += 1
            while j < len(text) and text[j] in "\"'”»)]":
                j += 1
            if j == len(text) or not text[j].isspace():
                k = j
                continue
        elif text[k] != "\n":
            k += 1
            continue
        while j < len(text) and text[j].isspace():
            j += 1
        out.append(text[at:j])
        at = k = j
    return out + ([text[at:]] if at < len(text) else [])


def naive_runs(parts):
    """(first, behind the last) of each span: tried run by run."""
    n = [len(p.split()) for p in parts]
    fits = lambda i, j: j - i >= 3 and sum(n[i:j]) >= 12
    out = set()
    for k in range(len(parts)):
        out |= {(k, next((j for j in range(k, len(parts) + 1) if fits(k, j)), 0)), (next((i for i in range(k, -1, -1) if fits(i, k + 1)), -1), k + 1)}
        out.add((k, next((j for j in range(k, len(parts) + 1) if j - k >= 2 and sum(n[k:j]) >= 20 and not any(fits(k, x) for x in range(k, j + 1))), 0)))
    return {(i, j) for i, j in out if i >= 0 and j > i and n[i]}


def brute_spans(rows):
    first, gone = {}, collections.defaultdict(set)
    for i, t in sorted(rows):
        parts = cut_sentences(t)
        for p, q in sorted(naive_runs(parts)):
            key = tuple(tuple(x.lower().split()) for x in parts[p:q])
            if first.setdefault(key, (i, p)) != (i, p):
                gone[i].update(range(p, q))
    return {i: "".join(x for k, x in enumerate(cut_sentences(t)) if k not in gone[i]) for i, t in rows}


def test_sentences_cover_the_text(real):
    for _, t, _ in real:
        assert "".join(t[a:b] for a, b in spans.sentences(t)) == t


def test_spans_brute(spark, real):
    got = {r.doc_id: r.text for r in spans.remove_repeats(docs(spark, real)).collect()}
    assert got == brute_spans([(i, t) for i, t, _ in real])


@pytest.mark.parametrize("lengths", [[30, 12, 12], [12, 12, 30, 12, 12], [12, 12, 12, 3, 3, 3], [3, 3, 3, 12, 12]])
def test_spans_remove_whole_passages(spark, lengths):
    rng = random.Random(7)
    text = lambda sizes: " ".join(words(rng, n) + "." for n in sizes)
    passage = text(lengths)
    rows = [(i, " ".join([text([14, 9]), passage, text([11, 20])]), "a") for i in (1, 2)]
    got = {r.doc_id: r.text for r in spans.remove_repeats(docs(spark, rows)).collect()}
    assert got[1] == rows[0][1] and got[2] == rows[1][1].replace(passage + " ", "")


def test_one_sentence_is_no_span(spark):
    long = "This one sentence is much longer than all the others here and holds more than five and twenty words, but it is alone in its text and so it must stay where it is."
    got = {r.doc_id: r.text for r in spans.remove_repeats(docs(spark, [(1, "Before. " + long + " After it.", "a"), (2, "Else. " + long + " Quite another end.", "a")])).collect()}
    assert long in got[1] and long in got[2]


def test_spans_edges(spark):
    out = spans.remove_repeats(docs(spark, EDGE, True)).collect()
    assert len(out) == len(EDGE) and {"score", "at", "n"} <= set(out[0].asDict())
    assert spans.remove_repeats(docs(spark, [])).count() == 0
    line = "This is a first sentence of some words. And here is one more of them. A third one ends the passage here."
    got = {r.doc_id: r.text for r in spans.remove_repeats(docs(spark, [(1, line, "a"), (2, "Before it all.\n" + line + "\nAfter.", "a")])).collect()}
    assert got[1] == line and "third" not in got[2] and "Before" in got[2] and "After" in got[2]


# 2


def test_toxicity_held_out(spark, sf):
    big = sf.replace("sf0.001", "sf0.01")
    out = toxicity.op2_toxicity_nnpu(spark, big)
    labels = common.table(spark, big, "labels")
    got = out.join(labels, "doc_id").where("held_out").collect()
    assert out.count() == common.table(spark, big, "documents").count()
    right = sum(r.predicted == r.toxic for r in got) / len(got)
    assert right > 0.9
    assert sum(r.predicted for r in got if r.toxic == 0) <= 0.02 * len(got)


def test_toxicity_recall_on_held_out_labels(spark):
    """At least nine in ten of the held-out toxic rows, few others; rows without any learned feature are label noise here: they
    hold none of the words that toxic texts share."""
    l = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = toxicity.op2_toxicity_nnpu(spark, "/root/testdata/sf0.1").where("held_out").join(l.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "doc_id").collect()
    least = min(r.score for r in got)
    toxic, found = [r for r in got if r.toxic == 1], [r for r in got if r.predicted == 1]
    assert sum(r.predicted for r in toxic) >= 0.9 * len(toxic)
    assert sum(r.predicted for r in toxic) >= 0.95 * sum(r.score > least for r in toxic)
    assert sum(r.toxic == 1 for r in found) >= 0.95 * len(found)


def test_toxicity_reads_whole_words():
    long = "x" * 50
    assert toxicity.word_features(long + "a") != toxicity.word_features(long + "b")
    assert toxicity.word_features("scum") == ["=scum"]


def test_nnpu_learns_without_clean_labels():
    rng = np.random.default_rng(0)
    p = np.zeros((300, 6), np.uint8)
    p[np.arange(300), rng.integers(0, 3, 300)] = 1
    u = np.zeros((1000, 6), np.uint8)
    u[np.arange(100), rng.integers(0, 3, 100)] = 1
    u[np.arange(100, 1000), rng.integers(3, 6, 900)] = 1
    w, b = toxicity.train_nnpu(p, u, 0.1)
    assert (p @ w + b > 0).mean() > 0.95 and (u[100:] @ w + b > 0).mean() < 0.05


def test_toxicity_edges(spark):
    labels = spark.createDataFrame([(2, 1, 1), (None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    d = docs(spark, EDGE, True)
    model = toxicity.fit(d, labels)
    assert toxicity.score(d, model).count() == len(EDGE)
    assert all(0 <= r.score <= 1 for r in toxicity.score(d, model).collect())
    none = toxicity.fit(d, labels.where("false"))
    assert {r.score for r in toxicity.score(d, none).collect()} == {1 / (1 + np.exp(60.0))}
    assert toxicity.drop_toxic(d, labels.where("false")).count() == len(EDGE)
    assert toxicity.score(docs(spark, []), model).count() == 0


# 3


def test_decontamination(spark):
    rng = random.Random(3)
    items = [(k, words(rng, 20) + ".\n" + words(rng, 12)) for k in range(8)]
    rows = [(i, words(rng, 150), "a") for i in range(60)]
    item = items[2][1].split()
    rows.append((100, words(rng, 60) + " " + items[1][1] + " " + words(rng, 60), "a"))
    rows.append((101, words(rng, 60) + " " + " ".join(w for k, w in enumerate(item) if k % 9) + " " + words(rng, 60), "a"))
    bench = spark.createDataFrame([*items, (9, None), (10, "")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.leaks(docs(spark, rows), bench).collect()}
    assert got == {(100, 1), (101, 2)}
    assert {r.doc_id for r in decontam.drop_leaks(docs(spark, rows, True), bench).collect()} == {i for i, _, _ in rows} - {100, 101}
    assert decontam.leaks(docs(spark, rows), bench.where("false")).count() == 0
    assert decontam.leaks(docs(spark, EDGE), bench).count() == 0
    assert decontam.leaks(docs(spark, []), bench).count() == 0


@pytest.mark.parametrize(("n", "length", "held"), [(900, 60, 300), (60, 60, 3), (20, 0, 20)])
def test_decontamination_of_a_widespread_item(spark, n, length, held):
    """One item in a third of the documents, in three of a table of about 200 passages, and alone in every document."""
    rng = random.Random(4)
    items = [(k, words(rng, 20) + ".\n" + words(rng, 10)) for k in range(8)]
    rows = [(i, " ".join([words(rng, length), items[3][1] if i < held else "", words(rng, 8) if length else ""]), "a") for i in range(n)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontam.leaks(docs(spark, rows), bench).collect()} == {(i, 3) for i in range(held)}


def test_decontamination_of_long_items(spark):
    rng = random.Random(6)
    items = [(k, words(rng, n)) for k, n in enumerate([20, 60, 80, 100, 150, 150, 200, 300, 300, 1000])]
    rows = [(100 + k, words(rng, 60) + " " + t + " " + words(rng, 60), "a") for k, t in items] + [(i, words(rng, 400), "a") for i in range(60)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontam.leaks(docs(spark, rows), bench).collect()} == {(100 + k, k) for k, _ in items}


def plain_leak(text, item):
    """The rule without retrieval: SEQUENCE of the item's words in order in some piece, or PARAPHRASE and ANSWER."""
    own, words = [w for w in decontam.words_of(item) if w], decontam.words_of(text)
    last = [w for w in decontam.words_of(item.strip().split("\n")[-1]) if w] or own
    n = len(own)
    for a in range(0, max(1, len(words) - n), max(1, n // 8)):
        piece = words[a : a + n + n // 2]
        share = decontam.lcs(decontam.word_masks(own), n, piece) / n
        if share >= decontam.SEQUENCE or (share >= decontam.PARAPHRASE and decontam.lcs(decontam.word_masks(last), len(last), piece) / len(last) >= decontam.ANSWER):
            return True
    return False


def test_decontamination_recall_against_the_rule(spark):
    """Copies and rewordings of given items (words left out, put in, swapped) in given documents."""
    rng = random.Random(12)
    items = [(i, t) for i, t in duckdb.sql("SELECT item_id, text FROM '/root/testdata/sf0.01/benchmark.parquet' ORDER BY 1").fetchall() if len(t.split()) >= 10]
    hosts = [t for (t,) in duckdb.sql("SELECT text FROM '/root/testdata/sf0.01/documents.parquet' WHERE length(text) BETWEEN 300 AND 3000 ORDER BY doc_id LIMIT 200").fetchall()]
    rows, planted = [], []
    for k in range(150):
        i, t = rng.choice(items)
        lines = [line.split(" ") for line in t.split("\n")]
        for line in lines if k % 3 else []:
            for _ in range(max(1, len(line) // 8)):
                at = rng.randrange(len(line))
                line[at : at + 1] = rng.choice([[], [line[at], "zzz"], ["yyy"]]) if len(line) > 3 else [line[at]]
        body, at = hosts[k % len(hosts)].split(" "), rng.randrange(20)
        text = " ".join([*body[:at], "\n".join(" ".join(line) for line in lines), *body[at:]])
        rows.append((k, text, "a"))
        if plain_leak(text, t):
            planted.append((k, i))
    got = {(r.doc_id, r.item_id) for r in decontam.leaks(docs(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert len(planted) >= 120
    assert len(got & set(planted)) >= 0.95 * len(planted)
    # what it reports is a leak by the rule as well
    text_of, item_of = {k: t for k, t, _ in rows}, dict(items)
    assert sum(plain_leak(text_of[d], item_of[i]) for d, i in got) >= 0.98 * len(got)


def test_lcs():
    def plain(a, b):
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        return t[-1][-1]

    rng = random.Random(1)
    for _ in range(200):
        a, b = rng.choices("abcd", k=rng.randint(1, 20)), rng.choices("abcd", k=rng.randint(0, 20))
        assert decontam.lcs(decontam.word_masks(a), len(a), b) == plain(a, b)


# 4


def test_topk_brute_and_edges(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(-30, 30, (700, 16))
    x[5] = x[6] = x[40]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(40, x[3].tolist())]
    df = spark.createDataFrame(rows, "id long, v array<long>")
    got = collections.defaultdict(list)
    for r in topk.topk(df, df.where("id % 20 = 0"), 7).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.id, r.score))
    for q in (0, 20, 60):
        want = sorted(((int(np.dot(x[q], v)), i) for i, v in rows if i != q), key=lambda s: (-s[0], s[1]))[:7]
        assert got[q] == [(i, s) for s, i in want]
    assert len(got[40]) == 14  # two rows, each a query
    e = spark.createDataFrame([(1, None), (2, [1.0, None]), (3, [float("nan")]), (4, [0.5]), (None, [1.0])], "id long, v array<double>")
    assert [r.id for r in e.where(F.col("id").isNotNull() & topk.usable(F.col("v"))).collect()] == [4]
    assert topk.topk(df.where("false"), df.where("false"), 3).count() == 0


def test_topk_over_many_blocks(spark, monkeypatch):
    """Floors from one block, groups of query blocks, ties, long components and a vector alone, against brute force."""
    for name, size in (("BLOCK", 16), ("QUERY_BLOCK", 8), ("GROUP", 2), ("RUN", 3)):
        monkeypatch.setattr(topk, name, size)
    rng = np.random.default_rng(11)
    vectors = [rng.integers(-60, 60, 6).tolist() for _ in range(150)] + [[5] * 6] * 30 + [[2**33, -(2**30), 1, 0, 0, 7], [3]]
    rows = spark.createDataFrame(list(enumerate(vectors)), "id long, v array<long>")
    got = collections.defaultdict(list)
    for r in topk.topk(rows, rows.where("id % 3 = 0"), 5).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.id, r.score))
    padded = [v + [0] * (6 - len(v)) for v in vectors]
    for q in range(0, len(vectors), 3):
        every = sorted(((i, sum(a * b for a, b in zip(padded[q], v, strict=True))) for i, v in enumerate(padded) if i != q), key=lambda s: (-s[1], s[0]))
        assert got[q] == every[:5]


def test_a_task_gives_k_rows_for_a_query():
    """However many blocks of rows it takes, those of the whole run are the best; its own block is met elsewhere."""
    rng = np.random.default_rng(4)
    x = [rng.integers(-50, 50, (30, 8)) for _ in range(5)]
    row = lambda n, a, **more: {"block": n, **dict(zip(("ids", "raw", "d"), topk.pack(np.arange(len(a)) + 100 * n, list(a)), strict=True)), **more}
    rows = pa.Table.from_pylist([row(n, a) for n, a in enumerate(x)])
    q = row(7, x[2][:10])
    asked = pa.Table.from_pylist([{"q_block": 7, "q_ids": q["ids"], "q_raw": q["raw"], "q_d": q["d"], "floors": None}])
    got = topk._meeting(4, 5)(rows, asked)
    assert got.num_rows == 4 * 10
    for i in range(10):
        every = sorted((-int(x[2][i] @ v), 100 * n + j) for n, a in enumerate(x) for j, v in enumerate(a) if n != 7 % 5 and 100 * n + j != 700 + i)[:4]
        mine = [(-r["score"], r["id"]) for r in got.to_pylist() if r["query_row"] == (7 << 32) + i]
        assert sorted(mine) == every


def test_block_topk_large_numbers():
    x = np.array([[2**20, 1], [-(2**20), 5], [3, 2**19]], np.int64)
    q, ids = np.array([[2**20, 7]], np.int64), np.array([1, 2, 3])
    at, found, score = topk.block_topk(np.array([9]), q, ids, topk.Segments(x), 2)
    assert found.tolist() == [1, 3] and score.tolist() == [2**40 + 7, 3 * 2**20 + 7 * 2**19]


# 5


def test_chat_snapshots(spark):
    rows = []
    for conv, turns in ((1, "ab"), (2, "abc"), (3, "abc"), (4, "xbc"), (5, "a"), (6, "z")):
        rows += [(conv, k, "user" if k % 2 == 0 else "assistant", t) for k, t in enumerate(turns)]
    rows += [(7, 0, None, "a"), (8, 0, "user", None), (None, 0, "user", "q")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("pos", F.lit(1)).withColumn("n", F.lit(1))
    out = {r.conv_id: r for r in chat.render(chat.maximal(df)).collect()}
    assert set(out) == {2, 4, 6, 7, 8, None}
    assert out[2].rendered == "<|user|>\na<|end|>\n<|assistant|>\nb<|end|>\n<|user|>\nc<|end|>\n" and out[2].n_turns == 3
    assert chat.render(chat.maximal(df.where("false"))).count() == 0


# 6


def wrong_blocks(chain, family):
    wrong = total = 0
    for page, gold in html_crf.labelled_pages(120, seed=77, families=(family,)):
        found = chain.decode([own for _, own in html_crf.leaf_blocks(page)])
        assert len(found) == len(gold)
        wrong += sum(a != b for a, b in zip(found, gold, strict=True))
        total += len(gold)
    return wrong / total


@pytest.mark.parametrize("family", html_crf.FAMILIES)
def test_html_held_out_pages(family):
    assert wrong_blocks(html_crf.trained(), family) < 0.02


@pytest.mark.parametrize("family", ["short", "headed", "table"])
def test_html_families_not_trained_on(family):
    assert wrong_blocks(html_crf.trained(tuple(f for f in html_crf.FAMILIES if f != family)), family) < 0.08


@pytest.mark.parametrize("wrap", ["article", "main", "div", "div class='content'", "section"])
def test_html_keeps_lists_and_tables_of_an_article(wrap):
    """Short and long lists, data tables, terms, captions, code in an article stay whole; menus around it do not."""
    rng, chain = random.Random(8), html_crf.trained()
    line = lambda a, b: words(rng, rng.randint(a, b)).capitalize()
    sentence = lambda a, b: line(a, b) + "."
    menu = "<ul>" + "".join(f"<li><a href='/{k}'>Menu {k}</a></li>" for k in range(5)) + "</ul>"
    for kind in html_crf.STRUCTURES:
        kept = wanted = 0
        for _ in range(25):
            piece, n = html_crf.structure(kind, rng, line, sentence)
            page = f"<body><nav>{menu}</nav><{wrap}><h1>{line(2, 6)}</h1><p>{sentence(5, 30)}</p>{piece}<p>{sentence(5, 30)}</p></{wrap.split()[0]}><aside>{menu}</aside><footer>{menu}</footer></body>"
            blocks = [t for t, _ in html_crf.leaf_blocks(piece)]
            got = html_crf.main_text(page, chain).split("\n")
            assert len(blocks) == n and not any(t.startswith("Menu") for t in got)
            kept, wanted = kept + sum(t in got for t in blocks), wanted + n
        assert kept >= 0.95 * wanted, kind


def test_html_layout_tables_and_given_pages(sf):
    page = "<table><tr><td class='menu'><a href='/1'>Home</a><br><a href='/2'>News</a></td><td><p>The first long sentence of the text is here.</p><table><tr><th>Year</th><th>Sum</th></tr><tr><td>1999</td><td>12</td></tr></table><p>And it goes on for a while.</p></td></tr><tr><td class='footer'>&copy; all</td></tr></table>"
    assert html_crf.main_text(page, html_crf.trained()) == "The first long sentence of the text is here.\nYear\nSum\n1999\n12\nAnd it goes on for a while."
    pages = duckdb.sql(f"SELECT html FROM '{sf}/pages.parquet'").fetchall()
    got = [html_crf.main_text(h, html_crf.trained()) for (h,) in pages]
    assert all(got) and not any("©" in t for t in got)
    assert html_crf.main_text("<div>short</div>", html_crf.trained()) == "short"


def test_html_of_an_empty_table_and_repeated_rows(spark):
    df = spark.createDataFrame([(1, "u", "<p>One text.</p>")] * 2 + [(2, None, None)], "page_id long, url string, html string")
    assert html_crf.extract(df.where("false")).count() == 0
    assert sorted((r.page_id, r.text, r.n_chars) for r in html_crf.extract(df).collect()) == [(1, "One text.", 9), (1, "One text.", 9), (2, "", 0)]


def test_html_loses_no_text():
    text = lambda page: html_crf.main_text(page, html_crf.trained())
    assert text("Just a page of plain text. With two sentences.") == "Just a page of plain text. With two sentences."
    assert text("<main><p>One sentence here.</p></main>") == "One sentence here."
    page = "<article><header><h1>Title of it</h1></header><p>We have <math><mi>x</mi>=1</math> in the first paragraph, as you see.</p><p>And then <button>a second one that has some more words in it.</p></article>"
    assert text(page) == "Title of it\nWe have x=1 in the first paragraph, as you see.\nAnd then a second one that has some more words in it."
    again = "<article>" + "<p>The same paragraph comes again and again.</p>" * 3 + "</article>"
    assert text(again).split("\n") == ["The same paragraph comes again and again."] * 3


def test_html_blocks_equal_a_plain_reading():
    """Blocks against a reading that splits at block tags alone, on pages without what is left out."""
    rng = random.Random(8)
    inline, block = ["b", "i", "a", "span", "em"], ["p", "div", "section", "h2", "li"]
    for _ in range(60):
        page, want, run, stack = "", [], "", []
        for _ in range(rng.randint(1, 60)):
            kind = rng.random()
            if kind < 0.5:
                word = rng.choice(["one", "two &amp; three", " ", "\n four", "&lt;x&gt;"])
                page, run = page + word, run + word
            elif kind < 0.7:
                page += rng.choice(["<{}>", "</{}>"]).format(rng.choice(inline))
            else:
                name = rng.choice(block)
                page, want, run = page + rng.choice(["<{}>", "</{}>"]).format(name), [*want, run], ""
        want = [" ".join(w.replace("&lt;", "<").replace("&gt;", ">").replace("&amp;", "&").split()) for w in [*want, run]]
        assert [t for t, _ in html_crf.leaf_blocks(page)] == [w for w in want if w] and not stack


def test_html_deep_pages_take_linear_time():
    import time

    def seconds(n):
        start = time.perf_counter()
        html_crf.main_text("".join(f"<div class=c{k}>" for k in range(n)) + "<p>x</p>" * n + "</div>" * n, html_crf.trained())
        return time.perf_counter() - start

    html_crf.trained()
    assert seconds(16_000) < 12 * max(0.05, seconds(4000))


def test_viterbi_is_the_best_sequence():
    import itertools

    chain = html_crf.trained()
    for page, _ in html_crf.labelled_pages(20, seed=5):
        blocks = [own for _, own in html_crf.leaf_blocks(page)][:8]
        u = chain.scores(blocks)
        score = lambda y: sum(a for a, l in zip(u, y, strict=True) if l) + chain.start * y[0] + sum(chain.pair[a][b] for a, b in zip(y, y[1:], strict=False))
        assert abs(score(chain.decode(blocks)) - max(score(y) for y in itertools.product((0, 1), repeat=len(blocks)))) < 1e-9


def test_html_edges(spark):
    page = '<nav><a href="/">Home</a></nav><article><h1>A &amp; B</h1><p>Some  text<br>of a page that is <b>long</b> enough to be one.<p title="x>y">And another&nbsp;paragraph of it.</article><div class="comments"><p>Nice one!</p></div><script>var a = "<p>no</p>"</script><footer>&copy; us</footer'
    rows = [(1, "u", page), (2, None, None), (3, "u", ""), (4, "u", "<p"), (None, "u", "<div><!-- open")]
    out = {r.page_id: r for r in html_crf.extract(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1))).collect()}
    assert out[1].text == "A & B\nSome text of a page that is long enough to be one.\nAnd another paragraph of it."
    assert [out[k].text for k in (2, 3, 4, None)] == [""] * 4 and out[1].n_chars == len(out[1].text)


@pytest.mark.parametrize("change", [spans.remove_repeats, suffix.cut_repeats])
def test_names_of_the_users_columns_clash_with_none(spark, change):
    names = ["_hi", "_lo", "_data", "_holder", "_at", "_kept", "_copies", "row", "key_hi", "key_lo", "holder", "at", "data", "copies", "kept"]
    passage = " ".join(f"Sentence {k} of a passage that repeats in both." for k in range(9))
    rows = docs(spark, [(1, "Before. " + passage, "a"), (2, passage + " After.", "a"), (None, None, None)]).withColumns({c: F.lit(c.upper()) for c in names})
    out = change(rows).collect()
    assert len(out) == 3 and all(r[c] == c.upper() for r in out for c in names)
    assert any("Sentence 4" not in (r.text or "") for r in out if r.doc_id)


# 7


def brute_cut(texts):
    n, count = suffix.LENGTH, collections.Counter()
    for x in texts:
        for i in range(len(x) - n + 1):
            count[x[i : i + n]] += 1
    out = []
    for x in texts:
        gone = bytearray(len(x))
        for i in range(len(x) - n + 1):
            if count[x[i : i + n]] > 1:
                gone[i : i + n] = b"\1" * n
        kept = bytes(b for b, g in zip(x, gone, strict=True) if not g)
        out.append((len(x), sum(gone), sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1])), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [150, 3])
def test_suffix_brute(spark, sf, real, monkeypatch, hot):
    monkeypatch.setattr(suffix, "HOT", hot)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix.op7_suffix_dedup(spark, sf).collect()}
    want = brute_cut([(t or "").encode() for _, t, _ in real])
    assert [got[i] for i, _, _ in real] == want


def test_repeated_windows_and_merge():
    rng = np.random.default_rng(0)
    make = lambda n: bytes(rng.integers(97, 99, n, dtype=np.uint8))
    core = make(230)
    texts = [make(int(rng.integers(150, 400))) for _ in range(15)] + [make(50) + core + make(60), make(31) + core + make(7), core[3:], b"ab" * 200, b""]
    count = collections.Counter(c[i : i + 200] for c in texts for i in range(len(c) - 199))
    for c, found in zip(texts, suffix.repeated_windows(texts), strict=True):
        assert found.tolist() == [i for i in range(len(c) - 199) if count[c[i : i + 200]] > 1]


def test_suffix_edges(spark):
    passage = "é" * 60 + "".join(chr(97 + k % 23) + str(k) for k in range(90))
    rows = EDGE + [(10, passage, "a"), (11, "before " + passage + " after", "a"), (12, "y" * 500, "a"), (13, "short", "a")]
    out = {r.doc_id: r for r in suffix.cut_repeats(docs(spark, rows, True)).collect() if r.doc_id and r.doc_id > 3}
    assert out[10].text == "" and out[11].text == "before  after" and out[12].text == "" and out[13].text == "short" and out[5].text == ""
    assert out[11].n_chars == len(out[11].text) and out[11].score == 1
    edge = EDGE + [(20, "z" * 300, "a"), (20, "z" * 300, "a"), (None, "z" * 300 + "q", "a")]
    table_ = docs(spark, edge, True)
    found = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix.digests(table_).collect())
    want = brute_cut([(t or "").encode() for _, t, _ in edge])
    assert found == sorted((str(i), *w) for (i, _, _), w in zip(edge, want, strict=True))
    assert suffix.digests(docs(spark, [])).count() == 0
    assert suffix.cut_repeats(docs(spark, [])).count() == 0


# 8


def brute_targets(sizes):
    """Shares of 1.5 times all words by weight; what passes twice a source's size goes to the others, over and over."""
    order = sorted((x for x in sizes if x[0] is not None), key=lambda x: [ord(c) for c in x[0]]) + [x for x in sizes if x[0] is None]
    weight = {s: (5, 2, 1)[k % 3] for k, (s, _) in enumerate(order)}
    size, out = dict(order), {s: 0.0 for s, _ in order}
    left, free = 1.5 * sum(size.values()), [s for s, n in order if n]
    while free:
        total = sum(weight[s] for s in free)
        full = [s for s in free if left * weight[s] / total > 2 * size[s]]
        if not full:
            return out | {s: left * weight[s] / total for s in free}
        out |= {s: 2.0 * size[s] for s in full}
        left -= sum(2 * size[s] for s in full)
        free = [s for s in free if s not in full]
    return out


def test_targets_equal_brute(spark):
    rng = random.Random(6)
    for case in [[("b", 100), ("a", 1000), (None, 500), ("c", 0)], [("a", 0)], [(None, 7)], *([(f"s{i}" if i else None, rng.choice([0, 1, 50, 900, 4000])) for i in range(rng.randint(1, 9))] for _ in range(6))]:
        rows = [("n" if s is None else "s" + s, n) for s, n in case]
        got = {None if r.source_key == "n" else r.source_key[1:]: r.target for r in mixing.targets(spark.createDataFrame(rows, "source_key string, source_size long")).collect()}
        want = brute_targets(case)
        assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want)


def brute_mix(rows):
    """[(size, target, taken)] by the letter: kappa by bisection, then one Pareto order a source, sorted whole."""
    size = [len((t or "").encode().split()) for _, t, _ in rows]
    totals = collections.Counter()
    for n, (_, _, s) in zip(size, rows, strict=True):
        totals[s] += n
    wanted, out = brute_targets(list(totals.items())), [None] * len(rows)
    for s, target in wanted.items():
        own = [k for k, r in enumerate(rows) if r[2] == s]
        pull = {k: int(1024 * size[k] ** 0.5) for k in own}
        low, high = 0.0, 2.0
        for _ in range(200):
            mid = (low + high) / 2
            low, high = (mid, high) if sum(min(2.0, mid * pull[k]) * size[k] for k in own) < target else (low, mid)
        copies = {k: round(min(2.0, high * pull[k]), 9) for k in own}
        steps = collections.Counter()
        rank = {}
        for k in own:
            i, t, _ = rows[k]
            inner = "?" if t is None else hashlib.sha256(t.encode()).hexdigest()
            u = (int(hashlib.sha256(f"{mixing.SEED}|{'?' if i is None else i}|{inner}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
            p = copies[k] % 1
            if p:
                q = (u / (1 - u)) / (p / (1 - p))
                rank[k] = q / (1 + q)
                steps[rank[k]] += size[k]
        need, upto, end = sum(copies[k] % 1 * size[k] for k in own), 0, -1
        for r in sorted(steps):
            if upto + steps[r] - need < need - upto:
                end = r
            upto += steps[r]
        for k in own:
            out[k] = (rows[k][0], size[k], round(target, 3), (int(copies[k]) + (k in rank and rank[k] <= end)) * size[k])
    return out


def test_mixing_equals_brute(spark, real):
    rows = [(i, t, s) for i, t, s in real] + EDGE
    got = mixing.mix(docs(spark, rows)).collect()
    assert sorted(((r.doc_id, r.mix_size, round(r.mix_target, 3), r.mix_taken) for r in got), key=str) == sorted(brute_mix(rows), key=str)
    assert {r.mix_taken // r.mix_size for r in got if r.mix_size} == {0, 1, 2}
    # documents of one source differ in their odds: the long ones are taken more often
    ratio = lambda rs: sum(r.mix_taken for r in rs) / max(1, sum(r.mix_size for r in rs))
    assert ratio([r for r in got if r.mix_size > 400]) > ratio([r for r in got if 0 < r.mix_size < 100])


def test_mixing(spark, real):
    rows = [(i, t, s) for i, t, s in real] + EDGE
    out = mixing.mix(docs(spark, rows, True)).collect()
    again = mixing.mix(docs(spark, rows, True).repartition(7)).collect()
    key = lambda rs: sorted((str(r.doc_id), str(r.text), r.mix_taken) for r in rs)
    assert key(out) == key(again) and len(out) == len(rows)
    assert all(0 <= r.mix_taken <= 2 * r.mix_size for r in out)
    assert all(r.mix_size == len((r.text or "").encode().split()) for r in out)
    for s in {r.source for r in out}:
        own = [r for r in out if r.source == s]
        assert abs(sum(r.mix_taken for r in own) - own[0].mix_target) <= max(r.mix_size for r in own) / 2 + 1
    assert mixing.mix(docs(spark, [])).count() == 0
    clash = mixing.mix(docs(spark, rows[:5]).withColumns({"size": F.lit("z"), "u": F.lit("y"), "row": F.lit("x"), "source_key": F.lit("w"), "target": F.lit("v")})).collect()
    assert {(r.size, r.u, r.row, r.source_key, r.target) for r in clash} == {("z", "y", "x", "w", "v")}


# 9


def test_warc_round_trip_and_edges(spark):
    long = "<p>" + "é" * 80
    rows = [(3, "http://www.b.org:80/x", long), (1, "http://a.org/?q=1", long), (2, None, "short"), (4, "http://a.org/y", "short"), (None, "::bad::[", None), (7, "http://a.org/y", None), (7, "http://a.org/y", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1))
    archives, index, shards = warc.archive(pages)
    got = sorted((str(r.page_id), r.payload_bytes, r.record_type, r.refers_to, r.html) for r in warc.read_captures(pages, shards, index, archives, 4).collect())
    n = len(long.encode())
    want = [("3", n, "revisit", 1, None), ("1", n, "response", None, long), ("2", 5, "response", None, "short"), ("4", 5, "response", None, "short"), ("None", 0, "response", None, ""), ("7", 0, "response", None, ""), ("7", 0, "response", None, "")]
    assert got == sorted(want, key=lambda r: (r[0], r[1]))
    one = spark.createDataFrame([(4, "http://a.org/y"), (5, "http://a.org/y")], "page_id long, url string")
    assert [r.page_id for r in warc.read_captures(one, shards, index, archives, 2).collect()] == [4]
    archives, index, shards = warc.archive(pages.where("false"))
    assert warc.read_captures(pages, shards, index, archives, 2).count() == 0


def test_surt_and_blocks():
    assert warc.surt("http://www.Example.org/A?b=C") == "org,example)/a?b=c"
    assert list(warc.find_blocks([("a", 1), ("c", 1), ("c", 1), ("e", 1)], ("c", 1))) == [0, 1, 2]


class Counted(tuple):
    """A key that counts how often it is compared."""

    seen = 0

    def __lt__(self, other):
        Counted.seen += 1
        return tuple.__lt__(self, other)

    def __gt__(self, other):
        Counted.seen += 1
        return tuple.__gt__(self, other)


@pytest.mark.parametrize("n", [1000, 100_000])
def test_a_lookup_compares_a_few_first_keys(n):
    firsts = [Counted(("k", i)) for i in range(n)]
    Counted.seen = 0
    assert list(warc.find_blocks(firsts, ("k", n // 3))) == [n // 3 - 1, n // 3]
    assert Counted.seen <= 2 * (n.bit_length() + 1)


def test_index_of_many_shards(spark, monkeypatch):
    """More shards than shuffle partitions, a URL over several of them, very long pages."""
    monkeypatch.setattr(warc, "SHARD_ENTRIES", 20)
    monkeypatch.setattr(warc, "BLOCK_LINES", 4)
    rows = [(i, "http://a.example/hot" if i % 3 else f"http://b{i}.example/", "<p>x</p>" * (60_000 if i == 7 else i % 5 * 20)) for i in range(200)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    archives, index, shards = warc.archive(pages)
    assert len(shards) >= 8
    got = {r.page_id: (r.payload_bytes, r.record_type) for r in warc.read_captures(pages, shards, index, archives, 4).collect()}
    assert {k: v[0] for k, v in got.items()} == {i: len(h) for i, _, h in rows}


# 10


def word_runs(text, k=5):
    """The set of a text by the letter of its contract, without the operator's code."""
    own = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    return {tuple(own[i : i + k]) for i in range(max(1, len(own) - k + 1))} if own else set()


def brute_components(rows):
    sets = [(i, word_runs(t)) for i, t in rows]
    parent = list(range(len(sets)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if len(x) and len(y):
                both = len(x & y)
                if 100 * both >= 80 * (len(x) + len(y) - both):
                    parent[find(a)] = find(b)
    ids = collections.defaultdict(list)
    for a in range(len(sets)):
        ids[find(a)].append(sets[a][0])
    least = {k: min((i for i in v if i is not None), default=None) for k, v in ids.items()}
    return collections.Counter((i, len(s), least[find(a)]) for a, (i, s) in enumerate(sets))


def test_jaccard_near_copies(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "OFTEN", 2)
    monkeypatch.setattr(jaccard, "SAMPLE", 2)
    rng = random.Random(4)
    rows = list((i, t) for i, t, _ in EDGE)
    passage = words(rng, 40)
    for g in range(6):
        base = words(rng, 150).split()
        for k in range(12):
            own = list(base)
            for _ in range(rng.randint(0, 6)):
                own[rng.randrange(len(own))] = words(rng, 1)
            rows.append((1000 + 100 * g + k, " ".join(own)))
    rows += [(5000 + k, words(rng, rng.randint(3, 120)) + " " + passage) for k in range(40)]
    got = collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.join_components(docs(spark, [(i, t, "a") for i, t in rows])).collect())
    assert got == brute_components(rows)


def test_jaccard_edges(spark):
    out = jaccard.join_components(docs(spark, EDGE, True)).collect()
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in out) == brute_components([(i, t) for i, t, _ in EDGE])
    assert jaccard.join_components(docs(spark, [])).count() == 0
    kept = jaccard.one_of_each(docs(spark, [(1, "a b c d e f", "s"), (2, "A b c d e f", "s"), (3, "", "s"), (4, None, "s")], True)).collect()
    assert sorted(r.doc_id for r in kept) == [1, 3, 4]


def test_one_of_each_goes_by_row(spark):
    t, other = "some words of a text that is here twice or more", "another text of its own with quite other words in it"
    rows = [(0, t, "a"), (1, other, "a"), (1, t, "a"), (2, other, "a"), (2, other, "a"), (None, t, "a"), (3, "", "a"), (3, "", "a"), (None, None, "a")]
    clash = docs(spark, rows, True).withColumns({"holder": F.lit("h"), "key_hi": F.lit(9), "row": F.lit(8), "rows": F.lit(7), "full": F.lit(6)})
    kept = jaccard.one_of_each(clash)
    assert kept.columns == clash.columns
    assert sorted((r.doc_id or -1, r.text or "", r.holder, r.key_hi, r.row, r.rows, r.full) for r in kept.collect()) == sorted((i or -1, x or "", "h", 9, 8, 7, 6) for i, x in [(0, t), (1, other), (3, ""), (3, ""), (None, None)])
    # only copies of one row: the first of them stays
    assert [r.doc_id for r in jaccard.one_of_each(docs(spark, [(5, t, "a"), (5, t, "a"), (5, t, "b")])).collect()] == [5]


def test_inverted_index_search():
    rng = np.random.default_rng(3)
    for _ in range(30):
        base = rng.integers(0, 1 << 60, 60).astype(np.uint64)
        sets = [np.unique(np.concatenate([rng.choice(base, rng.integers(1, 60), replace=False), rng.integers(0, 1 << 60, rng.integers(0, 20)).astype(np.uint64)])) for _ in range(25)]
        query = np.unique(base)
        want = {i: len(np.intersect1d(query, s)) for i, s in enumerate(sets)}
        want = {i: c for i, c in want.items() if 100 * c >= 80 * (len(query) + len(sets[i]) - c)}
        found = jaccard.InvertedIndex(sets).search(query)
        assert found.keys() == want.keys() and all(jaccard.needed(len(query), len(sets[i])) <= c <= want[i] for i, c in found.items())


def test_bitmaps_bound_the_difference():
    rng = np.random.default_rng(5)
    for _ in range(60):
        n, own = rng.integers(1, 400), rng.integers(0, 1 << 62, 900).astype(np.uint64)
        x, y = np.unique(own[:n]), np.unique(own[rng.integers(0, n) : n + rng.integers(0, 500)])
        bits = jaccard.differing_bits(jaccard.parity_bits(x), jaccard.parity_bits(y))
        assert bits <= len(np.setxor1d(x, y)) and jaccard.differing_bits(jaccard.parity_bits(x), jaccard.parity_bits(x)) == 0


def test_shingles_equal_brute(real, monkeypatch):
    texts = [t for _, t, _ in real] + [None, "", " \t\n", "one", "A b\x0bC", "x" * 9000, "é É ß", "\u00a0 no \u2003 break"]
    for piece in (1 << 21, 500):
        monkeypatch.setattr(shingling, "PIECE", piece)
        sets = [s for _, part in shingling.shingle_sets(pa.array(texts)) for s in part]
        assert [len(s) for s in sets] == [len(word_runs(t)) for t in texts]
        assert len(np.unique(np.concatenate(sets))) == len(set().union(*map(word_runs, texts)))


def test_divide_skip():
    rng = random.Random(2)
    for _ in range(100):
        lists = [sorted(rng.sample(range(30), rng.randint(0, 30))) for _ in range(rng.randint(1, 12))]
        need = [rng.randint(1, 8) for _ in range(30)]
        count = collections.Counter(x for own in lists for x in own)
        found = jaccard.divide_skip(lists, min(need), need)
        assert set(found) == {x for x, n in count.items() if n >= need[x]}


def test_needed_and_prefix():
    for n in range(1, 60):
        assert jaccard.prefix_length(n) == n - -(-4 * n // 5) + 1
        for m in range(1, 60):
            t = jaccard.needed(n, m)
            assert 5 * t >= 4 * (n + m - t) and not 5 * (t - 1) >= 4 * (n + m - t + 1)


def test_components(spark):
    rng = random.Random(9)
    edges = [(3, 4), (4, 0), (4, 2), (7, 0), (10, 7)] + [(100 + i, 101 + i) for i in range(40)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(80)]
    edges = [(a, b) for a, b in edges if a != b]
    got = {r.ref: r.comp for r in jaccard.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = {x: x for e in edges for x in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    assert got == label


def test_merge_stops_when_a_round_parts_nothing(monkeypatch):
    """Copies of random bytes are told apart by their first symbol: no 25 rounds, and the common prefixes are whole."""
    rng = np.random.default_rng(9)
    text = rng.integers(0, 256, 300, dtype=np.uint8).tobytes()
    sorts, argsort = [], np.argsort
    monkeypatch.setattr(np, "argsort", lambda *a, **k: sorts.append(1) or argsort(*a, **k))
    found = suffix.repeated_windows([text, text, b"x" * 150])
    assert [x.tolist() for x in found] == [list(range(101)), list(range(101)), []]
    assert len(sorts) < 20


def test_merge_keeps_who_shares_symbols_alone():
    """Suffixes that are told apart from all others leave the rounds; those that stay are the ones a plain count finds."""
    rng = np.random.default_rng(4)
    core = rng.integers(1, 9, 40).astype(np.uint16)
    parts = [np.concatenate([rng.integers(1, 900, 60), core, rng.integers(1, 900, 30), [0]]).astype(np.uint16) for _ in range(3)]
    depth = 10
    prefix = lambda part, k: tuple(np.roll(part, -k)[:depth])
    count = collections.Counter(prefix(part, k) for part in parts for k in range(len(part)))
    shards = [suffix.Transform(part, depth) for part in parts]
    for shard, part in zip(shards, parts, strict=True):
        assert [prefix(part, k) for k in shard.order] == sorted(prefix(part, k) for k in range(len(part)))
    source, place, interval = suffix.merge(shards, depth)
    found = [prefix(parts[s], shards[s].order[p]) for s, p in zip(source, place, strict=True)]
    assert found == sorted(found) and collections.Counter(found) == {k: n for k, n in count.items() if n > 1}
    assert (np.diff(interval) > 0).tolist() == [a != b for a, b in zip(found, found[1:], strict=False)]


def test_repeated_windows_of_more_than_16_bits():
    rng = np.random.default_rng(6)
    texts = [bytes(rng.integers(97, 99, 300, dtype=np.uint8)) * 100, b"abc" * 14_000, bytes(rng.integers(97, 99, 5000, dtype=np.uint8))]
    count = collections.Counter(c[i : i + 200] for c in texts for i in range(len(c) - 199))
    for c, found in zip(texts, suffix.repeated_windows(texts), strict=True):
        assert found.tolist() == [i for i in range(len(c) - 199) if count[c[i : i + 200]] > 1]


def test_suffix_texts_meet_their_first_places_where_they_are_written(spark, monkeypatch):
    plans, write = [], suffix.written
    monkeypatch.setattr(suffix, "written", lambda df, name, **k: plans.append((name, df._jdf.queryExecution().toString())) or write(df, name, **k))
    rows = [(k, "".join(chr(97 + (k * j * j + j) % 26) for j in range(400)) + "shared " * 60, "a") for k in range(6)]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix.digests(docs(spark, rows)).collect()}
    assert [got[k] for k, _, _ in rows] == brute_cut([t.encode() for _, t, _ in rows])
    contexts = [plan for name, plan in plans if name == "suffix-contexts"]
    assert contexts and "Exchange" not in contexts[0] and "Join" not in contexts[0]


def test_merge_stops_early_counted_by_its_own_sort(monkeypatch):
    text = np.random.default_rng(9).integers(0, 256, 300, dtype=np.uint8).tobytes()
    sorts, sort = [], suffix._sorted
    monkeypatch.setattr(suffix, "_sorted", lambda ranks: sorts.append(1) or sort(ranks))
    assert [len(x) for x in suffix.repeated_windows([text, text, b"x" * 150])] == [101, 101, 0]
    assert 0 < len(sorts) < 20
