"""Filter audit and phrases against plain loops, language codes against held-out labels; defined edge cases of the three."""

import random
import re
from collections import Counter
from itertools import permutations
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plumbline.llm import collocation, interaction, language

DOCS = "doc_id long, text string, lang string, source string"
LABELS = "doc_id long, quality int, toxic int"


# --- filter interaction audit


def plain_audit(docs, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    smallest = {}
    for d, t, *_ in docs:
        if d is not None:
            smallest[t or ""] = min(smallest.get(t or "", d), d)
    rows = []
    for d, t, _, s in docs:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            "D": bool(re.search("[#$%&*|]", t)),
            "E": d is not None and d > smallest[t],
        }
        rows.append((s or "", {k for k, v in fails.items() if v}, d in good, d in toxic))
    out, removed = {}, Counter()
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        for order in permutations("ABCDE"):
            left = own
            for step, letter in enumerate(order, 1):
                gone = [r for r in left if letter in r[1]]
                before = [r for r in own if letter in r[1] and set(order[: step - 1]) & r[1]]
                left = [r for r in left if letter not in r[1]]
                removed[part, letter] += len(gone)
                out[part, "".join(order), step] = [len(left), len(gone), len(before), sum(r[1] == {letter} for r in own), sum(r[2] for r in gone), sum(r[3] for r in gone), letter]
    return {k: (*v[:-1], removed[k[0], v[-1]]) for k, v in out.items()}


def audit_rows(df):
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in df.collect()}


def made_docs(rng):
    words = ["one", "Two", "THREE", "four", "fünf", "$", "a#b"]
    texts = [" ".join(rng.choice(words[: rng.choice([4, 7])]) for _ in range(rng.choice([3, 250]))) for _ in range(12)] + [" ".join(f"w{i}" for i in range(300)), "", None]
    docs = [(rng.choice([None, *range(40)]), rng.choice(texts), None, rng.choice(["a", "b", "", None])) for _ in range(120)]
    labels = [(rng.choice([None, *range(40)]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(40)]
    return docs, labels


def test_audit_equals_a_plain_loop_with_nulls_and_repeated_rows(spark):
    docs, labels = made_docs(random.Random(4))
    got = audit_rows(interaction.audit(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)))
    assert got == plain_audit(docs, labels)


def test_audit_of_nothing_and_with_clashing_columns(spark):
    docs, labels = made_docs(random.Random(5))
    d, l = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    assert interaction.audit(d.where("false"), l).count() == 0
    alone = interaction.audit(d.limit(20), l.where("false"))
    assert alone.agg(F.sum("good_lost"), F.sum("toxic_lost")).first() == (0, 0)
    more = d.withColumns({c: F.lit(9) for c in ("part", "mask", "n", "good", "words", "key_hi", "salt")})
    assert audit_rows(interaction.audit(more, l.withColumn("salt", F.lit(1)))) == audit_rows(interaction.audit(d, l))


def test_lattice_has_eighty_edges_and_six_hundred_steps(spark):
    docs = spark.createDataFrame([(1, "a text", "en", "s")], DOCS)
    classes, letters = interaction.failing(docs, spark.createDataFrame([], LABELS))
    assert interaction.lattice_edges(classes, len(letters)).count() == 80
    assert interaction.audit(docs, spark.createDataFrame([], LABELS)).count() == 600


# --- phrases


def plain_phrases(docs, least, most, percent=80):
    f, n = Counter(), Counter()
    for _, text, lang, _ in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    held = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    out = []
    for (lang, ws), a in held.items():
        inside = any(b == lang and len(o) > len(ws) and 100 * x >= percent * a and any(o[i : i + len(ws)] == ws for i in range(len(o))) for (b, o), x in held.items())
        if not inside:
            score, _, l, r = min((2_000_000 * a // (f[lang, ws[:k]] + f[lang, ws[k:]]), k, f[lang, ws[:k]], f[lang, ws[k:]]) for k in range(1, len(ws)))
            out.append((lang, " ".join(ws), a, l, r, n[lang], score))
    rows = []
    for lang in {o[0] for o in out}:
        own = sorted((o for o in out if o[0] == lang), key=lambda o: (-o[6], -o[2], o[1].encode()))[:most]
        rows += [(lang, rank, *o[1:]) for rank, o in enumerate(own, 1)]
    return sorted(rows)


def phrase_rows(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def phrase_docs(seed, n=60):
    rng = random.Random(seed)
    words = ["New", "york", "ÉCOLE", "of", "the", "a", "city", "x-y", " nb", "rare%d"]
    text = lambda m: "".join((w % rng.randrange(99) if "%" in w else w) + rng.choice([" ", "  ", "\t", ", ", ".", "\n", " ", " "]) for w in rng.choices(words, [9, 9, 3, 9, 9, 5, 4, 2, 1, 2], k=m))
    docs = [(i, rng.choice([None, "", text(rng.choice([1, 5, 60, 200]))]), rng.choice(["en", "de", None, "und"]), "s") for i in range(n)]
    return docs + [(99, "of the new york city " * 150, "en", "s")] * 2 + [(None, text(3000).replace(".", "").replace(",", "").replace("\n", " "), "en", "s")]


@pytest.mark.parametrize("size", [1 << 22, 700, 40])
def test_phrases_equal_a_plain_loop_however_texts_are_cut(spark, monkeypatch, size):
    docs = phrase_docs(3)
    got = collocation.collocations(spark.createDataFrame(docs, DOCS), least=4, most=50, size=size)
    assert phrase_rows(got) == plain_phrases(docs, 4, 50)


def test_phrases_with_small_runs_in_sorting(spark):
    """Runs of one first key that are longer than what is sorted at once give partial counts, which are added."""
    high = np.repeat(np.arange(1, 6, dtype=np.uint64), [1, 40, 3, 200, 7]) << np.uint64(32) | np.uint64(9)
    rng = np.random.default_rng(1)
    low = rng.integers(0, 4, len(high)).astype(np.uint64) << np.uint64(32)
    low |= np.where(low == 0, 0, rng.integers(0, 3, len(high))).astype(np.uint64)
    want = Counter()
    for h, l in zip(high.tolist(), low.tolist(), strict=True):
        for key in {(h, 0), (h, l >> 32 << 32), (h, l)}:
            want[key] += 1
    before = collocation.ROWS
    try:
        collocation.ROWS = 32
        cut = [pa.RecordBatch.from_arrays([pa.array(x[i : i + 10].view(np.int64)) for x in (high, low, np.ones(len(high), np.int64))], names=["hi", "lo", "n"]) for i in range(0, len(high), 10)]
        got = Counter()
        for b in collocation._run_lengths(12)(iter(cut)):
            for h, l, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                got[h, l] += n
    finally:
        collocation.ROWS = before
    assert {k: v for k, v in got.items() if v >= 12} == {k: v for k, v in want.items() if v >= 12}


def test_radix_order_sorts_keys_of_128_bits():
    rng = np.random.default_rng(2)
    high, low = (rng.integers(0, 1 << 62, 5000, dtype=np.uint64) >> rng.integers(0, 62, 5000).astype(np.uint64) for _ in range(2))
    order = collocation._order(high, low)
    assert order.tolist() == np.lexsort((low, high)).tolist()


def test_phrase_scores_beyond_64_bits(spark):
    big = 1 << 44
    phrases = spark.createDataFrame([((1 << 32) | 2, 0, big)], "hi long, lo long, f long")
    words = spark.createDataFrame([(1, "en", "a", big + 3), (2, "en", "b", big)], "id long, lang string, word string, f long")
    assert collocation.scored(phrases, phrases, words).first().score == 2_000_000 * big // (2 * big + 3)


def test_phrases_of_nothing_and_with_clashing_columns(spark):
    docs = phrase_docs(8, 20)
    d = spark.createDataFrame(docs, DOCS)
    assert collocation.collocations(d.where("false")).count() == 0
    assert collocation.collocations(d.where("text is null")).count() == 0
    more = d.withColumns({c: F.lit(1) for c in ("hi", "lo", "word", "batch", "rank", "n")})
    assert phrase_rows(collocation.collocations(more, least=5)) == plain_phrases(docs, 5, 2000)


# --- language codes


def test_codewords_are_far_apart():
    for k in (2, 3, 4, 5, 9, 30):
        code = language.codewords(k)
        apart = [(a != b).sum() for i, a in enumerate(code) for b in code[:i]]
        assert len(code) == k and min(apart) >= (code.shape[1] + 1) // 2 if k <= 5 else min(apart) >= code.shape[1] // 4
        assert len({tuple(c) for c in code.T}) == code.shape[1] and not (abs(code.sum(0, dtype=int)) == k).any()


def test_whole_texts_are_counted_whatever_the_pieces(monkeypatch):
    text = "Abc,  def! ÉÉ ... " * 9
    one = next(language.histograms(pa.array([text])))[1]
    monkeypatch.setattr(language, "PIECE", 7)
    assert (next(language.histograms(pa.array([text])))[1] == one).all()
    clean = " " + re.sub(r"[^a-zé]+", " ", text.lower())
    assert one.sum() == sum(len(clean.encode()) - n + 1 for n in language.NGRAMS)


def test_held_out_languages_are_found(spark, sf):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.op13_language_codes(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang", F.length("text").alias("n")), "doc_id").collect()
    assert len(got) == docs.count()
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert np.mean([r.lang == r.lang_pred for r in held]) >= 0.98
    for lang in {r.lang for r in held}:
        assert np.mean([r.lang_pred == lang for r in held if r.lang == lang]) >= 0.95
    clear = [r for r in held if not r.ambiguous]
    assert len(clear) >= 0.9 * len(held) and np.mean([r.lang == r.lang_pred for r in clear]) >= 0.99


def test_language_edges(spark):
    words = {"aa": ["lorem", "ipsum", "dolor"], "bb": ["xyzzy", "quux", "fnord"], "cc": ["été", "garçon", "île"]}
    rng = random.Random(0)
    docs = [(i, " ".join(rng.choices(words[k], k=6)), k, "s") for i, k in enumerate(["aa", "bb", "cc"] * 60)]
    odd = [(None, "quux fnord", "aa", "s"), (1000, None, "aa", None), (1001, "", None, None), (1002, "12 %% 3", "bb", None), (1003, "ÎLE GARÇON", None, None), (1004, "lorem " * 400_000, None, None), (7, docs[7][1], None, "s")]
    d = spark.createDataFrame(docs + odd, DOCS)
    got = {(r.doc_id, r.lang_pred, r.ambiguous) for r in language.predict(d, language.fit(d)).where("doc_id is null or doc_id >= 1000").collect()}
    assert got == {(None, "bb", False), (1000, "und", True), (1001, "und", True), (1002, "und", True), (1003, "cc", False), (1004, "aa", False)}
    assert language.predict(d, language.fit(d)).count() == d.count()
    assert language.predict(d.where("false"), language.fit(d)).count() == 0
    assert {r.lang_pred for r in language.predict(d, language.fit(d.where("false"))).collect()} == {"und"}
    one = {(r.lang_pred, r.score) for r in language.predict(d, language.fit(d.where("lang = 'bb'"))).collect()}
    assert one == {("bb", 1.0), ("und", 0.0)}
    more = d.withColumns({c: F.lit("x") for c in ("letter", "lang_pred", "score", "slots")})
    assert sorted(map(str, language.predict(more, language.fit(more)).collect())) == sorted(map(str, language.predict(d, language.fit(d)).collect()))
