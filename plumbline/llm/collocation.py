"""Phrase collocation mining: phrases of two to four words that occur together more than their parts do.

Pass one cuts texts into pieces and words and writes them in batches of bounded size, each with a dictionary of its own:
a row holds the words' local numbers, the local dictionary and its counts. Word counts are summed from those dictionaries;
words below the threshold get no number, the others (language, word) get a global one. A batch is then re-encoded by
joining its own dictionary with the global one, so no task ever holds the global dictionary and nothing is broadcast.

Pass two slides a window of four words along the batches. Pieces break where a word has no number, since no phrase with it
can be frequent. A window is a key of fixed width, four ids of 32 bits in two longs, zeros behind the end of a piece. Keys are
radix sorted and summed inside the task, range-partitioned on the whole key, sorted by the first long within partitions
(Spark's radix sort, which spills) and by the second in runs of bounded size; equal prefixes of two, three and four words
lie together then, and their run lengths are the counts. A run that ends at a partition's border is a partial count; the
partial counts are summed last. A frequent word pair is split between partitions like any other range of keys.

Scores need the counts of a phrase's parts, which are frequent if it is: they are met by key. All arithmetic is in whole
numbers, products in decimals of 38 digits.

Defined results: a null text has no words; a null lang is ``und``, one group with that name; repeated rows count each;
words and texts of any length are read whole (a text longer than a batch goes on in the next, with the words that windows
across the cut need); a language without candidates has no rows, nor has an empty table. Extra columns are ignored.
Local numbers come from 64-bit hashes of the words of one batch.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.llm.common import scratch, table, written
from plumbline.llm.shingling import mixed

LONGEST = 4
LEAST = 30
MOST = 2000
#: Bytes of text of a batch; rows that a task sorts at once.
BATCH = 4 << 20
ROWS = 1 << 21
BUCKETS = 4096
SPREAD = 64
STOPS = [*b".,;:!?", *range(0x0A, 0x0E)]
_GAP = np.zeros(256, bool)
_GAP[[0x20, 0x09, *STOPS]] = True
_STOP = np.zeros(256, bool)
_STOP[STOPS] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CUT = re.compile(rb"[ \t.,;:!?\n-\r]")
_AHEAD = re.compile(rb"(?:[ \t]*[^ \t.,;:!?\n-\r]+){0,%d}" % (LONGEST - 1))


def _numbers(n: int, salt: int) -> np.ndarray:
    return mixed((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15))


_BYTE = _numbers(256, 1 << 21)
_BYTE[_GAP] = 0


def encode(text: bytes) -> tuple[np.ndarray, list[str]]:
    """(codes, words): 1 + the local number of each word in order, 0 between pieces; the words by number."""
    data = _LOWER[np.frombuffer(text, np.uint8)]
    word = ~_GAP[data]
    edge = np.diff(word.astype(np.int8), prepend=0, append=0)
    at, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(at):
        return np.zeros(0, np.int32), []
    # a word's hash: a random number a byte times one for its place, summed
    place = np.arange(at[0], len(data)) - np.repeat(at, np.diff(np.append(at, len(data))))
    longest = int((end - at).max())
    turn = _numbers(longest + 1, 1 << 41) | np.uint64(1)
    value = _BYTE[data[at[0] :]] * turn[np.minimum(place, longest)]
    codes, _ = pd.factorize(mixed(np.add.reduceat(value, at - at[0])))
    new = np.flatnonzero(np.diff(np.maximum.accumulate(codes), prepend=-1))
    low = data.tobytes()
    words = [low[a:b].decode() for a, b in zip(at[new].tolist(), end[new].tolist(), strict=True)]
    stops = np.cumsum(_STOP[data])
    apart = np.append(False, stops[at[1:]] > stops[at[:-1]])
    out = np.zeros(len(at) + int(apart.sum()), np.int32)
    out[np.arange(len(at)) + np.cumsum(apart)] = codes + 1
    return out, words


BATCHES = "batch long, lang string, ahead int, codes binary, words array<string>, counts array<bigint>"


def _encode_batches(size: int):
    """Rows (lang, text) into batches of about ``size`` bytes, one for each language that the bytes hold."""

    def row(batch: int, lang: str, text: bytes, ahead: int) -> pa.RecordBatch:
        codes, words = encode(text)
        counted = codes[: len(codes) - ahead]
        counts = np.bincount(counted, minlength=len(words) + 1)[1:]
        columns = [pa.array([batch]), pa.array([lang]), pa.array([ahead], pa.int32()), pa.array([codes.tobytes()], pa.binary()), pa.array([words], pa.list_(pa.string())), pa.array([counts.tolist()], pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays(columns, names=["batch", "lang", "ahead", "codes", "words", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, total = TaskContext.get().partitionId() << 32, {}, 0
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            for lang, text in zip(batch.column(0).to_pylist(), texts, strict=True):
                text, at = text.as_py(), 0
                while at < len(text):
                    cut, ahead = _CUT.search(text, at + size), b""
                    end = cut.end() if cut else len(text)
                    if cut and cut.group() in b" \t":
                        ahead = _AHEAD.match(text, end).group()
                    held.setdefault(lang, []).append(text[at:end] + ahead)
                    total, at = total + end - at, end
                    if total >= size or ahead:
                        for name, parts in held.items():
                            yield row(number, name, b"\n".join(parts), len(re.findall(rb"[^ \t]+", ahead)) if name == lang else 0)
                            number += 1
                        held, total = {}, 0
        for name, parts in held.items():
            yield row(number, name, b"\n".join(parts), 0)
            number += 1

    return run


def batches_of(documents: DataFrame, size: int = BATCH) -> DataFrame:
    lang, text = F.coalesce(F.col("lang").cast("string"), F.lit("und")), F.col("text").cast("string")
    return documents.select(lang.alias("lang"), text.alias("text")).where("text is not null").mapInArrow(_encode_batches(size), BATCHES)


def dictionary(batches: DataFrame, least: int) -> DataFrame:
    """(id, lang, word, f) of the words that occur ``least`` times in their language; ids from 1 on, without gaps.

    Words are numbered inside buckets of their hash; the buckets' sizes, BUCKETS rows, give where each begins."""
    pairs = batches.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w")).groupBy("lang", F.col("w.words").alias("word")).agg(F.sum("w.counts").alias("f"))
    found = written(pairs.where(F.col("f") >= least).withColumn("bucket", F.pmod(F.xxhash64("lang", "word"), F.lit(BUCKETS))), "phrase-words")
    sizes = found.groupBy("bucket").count()
    before = sizes.select("bucket", (F.sum("count").over(Window.orderBy("bucket")) - F.col("count")).alias("before"))
    place = F.row_number().over(Window.partitionBy("bucket").orderBy("lang", "word"))
    return found.join(before, "bucket").select((F.col("before") + place).alias("id"), "lang", "word", "f")


def _order(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """The order of the 128-bit keys (high, low): a radix sort by digits of 16 bits, the last digit first."""
    order = None
    for x in (low, high):
        top = int(x.max())
        for shift in range(0, 64, 16):
            digit = (x >> np.uint64(shift)).astype(np.uint16)
            if top >> shift == 0 or (digit == digit[0]).all():
                continue
            order = np.argsort(digit, kind="stable") if order is None else order[np.argsort(digit[order], kind="stable")]
    return np.arange(len(low)) if order is None else order


def _summed(high: np.ndarray, low: np.ndarray, n: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order with their number, or the sum of their ``n``."""
    order = _order(high, low)
    high, low = high[order], low[order]
    first = np.flatnonzero(np.append(True, (high[1:] != high[:-1]) | (low[1:] != low[:-1])))
    n = np.diff(np.append(first, len(high))) if n is None else np.add.reduceat(n[order], first)
    return high[first], low[first], n


def _rows(high: np.ndarray, low: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(high.view(np.int64)), pa.array(low.view(np.int64)), pa.array(n.astype(np.int64))], names=["hi", "lo", "n"])


KEYS = "hi long, lo long, n long"


def windows(ids: np.ndarray, ahead: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys (hi, lo) of the windows of four that begin with two words; the last ``ahead`` words begin none."""
    padded = np.concatenate([ids, np.zeros(LONGEST - 1, np.uint64)])
    at = np.flatnonzero((padded[: len(ids) - ahead] != 0) & (padded[1 : len(ids) - ahead + 1] != 0))
    third = padded[at + 2]
    fourth = np.where(third == 0, np.uint64(0), padded[at + 3])
    return (padded[at] << np.uint64(32)) | padded[at + 1], (third << np.uint64(32)) | fourth


def _count_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (ahead, codes, place, id) into window keys, summed over ROWS windows at a time."""
    highs, lows, held = [], [], 0
    for batch in batches:
        for k in range(batch.num_rows):
            ahead, codes = batch.column(0)[k].as_py(), np.frombuffer(batch.column(1)[k].as_py(), np.int32)
            place, number = (batch.column(c)[k].values.to_numpy() for c in (2, 3))
            own = np.zeros(int(codes.max(initial=0)) + 1, np.uint64)
            own[place + 1] = number
            high, low = windows(own[codes], ahead)
            highs.append(high), lows.append(low)
            held += len(high)
            if held >= ROWS:
                yield _rows(*_summed(np.concatenate(highs), np.concatenate(lows), None))
                highs, lows, held = [], [], 0
    if held:
        yield _rows(*_summed(np.concatenate(highs), np.concatenate(lows), None))


def _prefix_runs(high: np.ndarray, low: np.ndarray, n: np.ndarray, least: int, partial: bool) -> Iterator[pa.RecordBatch]:
    """Counts of the prefixes of two, three and four words of sorted keys: those of ``least`` or more, and the first and last
    run of each length, which may go on elsewhere; with ``partial`` all."""
    third = low & np.uint64(0xFFFFFFFF00000000)
    for prefix, there in ((np.zeros_like(low), None), (third, third != 0), (low, (low & np.uint64(0xFFFFFFFF)) != 0)):
        h, l, c = (high, prefix, n) if there is None else (high[there], prefix[there], n[there])
        if not len(h):
            continue
        first = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (l[1:] != l[:-1])))
        total = np.add.reduceat(c, first)
        keep = (total >= least) | partial
        keep[[0, -1]] = True
        yield _rows(h[first][keep], l[first][keep], total[keep])


def _run_lengths(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Keys sorted by hi; they are taken ROWS at a time and cut where hi changes. Where one hi has more, its counts are
        given out in parts."""
        held, size, begun = [], 0, None

        def done(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, size, begun
            high, low, n = (np.concatenate(x) for x in zip(*held, strict=True))
            cut = len(high) if last else int(np.searchsorted(high, high[-1]))
            if begun is not None:
                # the rest of a first key that was begun before
                rest = int(np.searchsorted(high, begun, side="right"))
                if rest:
                    yield from _prefix_runs(*_summed(high[:rest], low[:rest], n[:rest]), least, True)
                    high, low, n, cut = high[rest:], low[rest:], n[rest:], max(0, cut - rest)
                if len(high):
                    begun = None
            if cut:
                yield from _prefix_runs(*_summed(high[:cut], low[:cut], n[:cut]), least, False)
                high, low, n = high[cut:], low[cut:], n[cut:]
            if len(high) >= ROWS:
                begun = high[0]
                yield from _prefix_runs(*_summed(high, low, n), least, True)
                high = high[:0]
            held, size = ([(high, low, n)] if len(high) else []), len(high)

        for batch in batches:
            high, low, n = (batch.column(k).to_numpy() for k in range(3))
            held.append((high.view(np.uint64), low.view(np.uint64), n))
            size += len(high)
            if size >= ROWS:
                yield from done(False)
        if size:
            yield from done(True)

    return run


def frequent_phrases(documents: DataFrame, least: int = LEAST, size: int = BATCH) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(phrases, words, totals): ids of the phrases that occur ``least`` times as (hi, lo, f), the dictionary
    (id, lang, word, f), and (lang, n), all words of a language."""
    batches = written(batches_of(documents, size), "phrase-batches")
    totals = batches.select("lang", F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x).alias("n")).groupBy("lang").agg(F.sum("n").alias("n"))
    words = written(dictionary(batches, least), "phrase-dictionary")
    top = words.agg(F.max("id")).first()[0] or 0
    if top >= 1 << 31:
        raise ValueError(f"{top} frequent words do not fit in keys of 32 bits a word; raise least")
    own = batches.select("batch", "lang", F.posexplode("words").alias("place", "word")).join(words.select("lang", "word", "id"), ["lang", "word"])
    # one row a batch, with at most as many entries as the batch has words
    own = own.groupBy("batch").agg(F.collect_list(F.struct("place", "id")).alias("own"))
    coded = batches.select("batch", "ahead", "codes").join(own, "batch").select("ahead", "codes", F.col("own.place").alias("place"), F.col("own.id").alias("id"))
    keys = written(coded.mapInArrow(_count_windows, KEYS), "phrase-keys")
    runs = keys.repartitionByRange("hi", "lo").sortWithinPartitions("hi").mapInArrow(_run_lengths(least), KEYS)
    phrases = runs.groupBy("hi", "lo").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
    return written(phrases, "phrases"), words, totals


def _ids() -> list[Column]:
    return [F.shiftright("hi", 32), F.col("hi").bitwiseAND(0xFFFFFFFF), F.shiftright("lo", 32), F.col("lo").bitwiseAND(0xFFFFFFFF)]


def _key(ids: list[Column]) -> list[Column]:
    """hi and lo of up to four ids."""
    ids = [*ids, *[F.lit(0).cast("long")] * (LONGEST - len(ids))]
    pair = lambda a, b: F.shiftleft(a, 32).bitwiseOR(b)
    return [pair(ids[0], ids[1]).alias("hi"), pair(ids[2], ids[3]).alias("lo")]


def _length() -> Column:
    a, b, c, d = _ids()
    return F.when(d != 0, 4).when(c != 0, 3).otherwise(2)


def not_swallowed(phrases: DataFrame, percent: int = 80) -> DataFrame:
    """Phrases without those that lie in a longer one that has ``percent`` of their count.

    A longer phrase with one word more suffices: it occurs at least as often as one with two words more."""
    ids, k = _ids(), _length()
    inner = F.when(k == 4, F.array(F.struct(*_key(ids[:3])), F.struct(*_key(ids[1:])))).otherwise(F.array(F.struct(*_key(ids[:2])), F.struct(*_key(ids[1:3]))))
    longer = phrases.where(k > 2).select(F.explode(inner).alias("x"), "f").groupBy("x.hi", "x.lo").agg(F.max("f").alias("longer"))
    return phrases.join(longer, ["hi", "lo"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < percent * F.col("f"))).drop("longer")


def scored(phrases: DataFrame, kept: DataFrame, words: DataFrame) -> DataFrame:
    """``kept`` with lang, a, l, r and score of the cut that scores lowest, the first of those that tie."""
    ids, k = _ids(), _length()
    parts = []
    for n in range(2, LONGEST + 1):
        for cut in range(1, n):
            for side, part in enumerate((ids[:cut], ids[cut:n])):
                parts.append(F.when(k == n, F.struct(F.lit(2 * cut + side).alias("side"), *[x.alias(y) for x, y in zip(_key(part), ("part_hi", "part_lo"), strict=True)])))
    asked = kept.select("hi", "lo", F.col("f").alias("a"), F.explode(F.filter(F.array(*parts), lambda x: x.isNotNull())).alias("x")).select("hi", "lo", "a", "x.*")
    one = words.select(F.shiftleft("id", 32).alias("part_hi"), F.lit(0).cast("long").alias("part_lo"), F.col("f").alias("part_f"), "lang")
    known = phrases.select(F.col("hi").alias("part_hi"), F.col("lo").alias("part_lo"), F.col("f").alias("part_f"), F.lit(None).cast("string").alias("lang")).unionByName(one)
    met = asked.join(known, ["part_hi", "part_lo"])
    f = lambda s: F.max(F.when(F.col("side") == s, F.col("part_f"))).alias(f"f{s}")
    # the part before the first cut is a word, which says the language
    rows = met.groupBy("hi", "lo", "a").agg(F.max(F.when(F.col("side") == 2, F.col("lang"))).alias("lang"), *[f(s) for s in range(2, 2 * LONGEST)])
    cuts = []
    for cut in range(1, LONGEST):
        l, r = f"f{2 * cut}", f"f{2 * cut + 1}"
        score = F.expr(f"(CAST(a AS DECIMAL(38,0)) * 2000000) div CAST({l} + {r} AS DECIMAL(38,0))")
        cuts.append(F.when(F.col(l).isNotNull(), F.struct(score.alias("score"), F.lit(cut).alias("cut"), F.col(l).alias("l"), F.col(r).alias("r"))))
    return rows.withColumn("best", F.least(*cuts)).select("hi", "lo", "lang", "a", "best.l", "best.r", "best.score")


def _first(rows: DataFrame, keys: list[str], order: list[Column], most: int, ties: bool = False) -> DataFrame:
    number = (F.rank if ties else F.row_number)().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("rank", number).where(F.col("rank") <= most)


def spelled(rows: DataFrame, words: DataFrame) -> DataFrame:
    """``rows`` with ``phrase``, the words of hi and lo."""
    named = F.filter(F.array(*[F.struct(F.lit(k).alias("k"), x.alias("id")) for k, x in enumerate(_ids())]), lambda x: x["id"] != 0)
    each = rows.select("hi", "lo", F.explode(named).alias("x")).select("hi", "lo", "x.k", "x.id").join(words.select("id", "word"), "id")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "word"))), lambda x: x["word"]), " ")
    return rows.join(each.groupBy("hi", "lo").agg(text.alias("phrase")), ["hi", "lo"])


def collocations(documents: DataFrame, least: int = LEAST, most: int = MOST, percent: int = 80, size: int = BATCH) -> DataFrame:
    """The first ``most`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    with scratch(documents.sparkSession):
        phrases, words, totals = frequent_phrases(documents, least, size)
        rows = scored(phrases, written(not_swallowed(phrases, percent), "phrases-kept"), words)
        # first in parts of a language, so that no task ranks all of one
        rows = rows.withColumn("part", F.pmod(F.xxhash64("hi", "lo"), F.lit(SPREAD)))
        best = [F.desc("score"), F.desc("a")]
        rows = written(_first(rows, ["lang", "part"], best, most, ties=True), "phrases-first")
        rows = _first(spelled(rows, words), ["lang", "part"], [*best, F.asc("phrase")], most)
        rows = _first(rows, ["lang"], [*best, F.asc("phrase")], most)
        rows = rows.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
        return written(rows, "collocations", keep=True)


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p
), t AS (
  SELECT lang, sum(len(ws)) AS n FROM w GROUP BY 1
), i AS (
  SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, (VALUES (1), (2), (3), (4)) v(k) WHERE len(ws) >= k
), g AS (
  SELECT lang, k, array_to_string(ws[i : i + k - 1], ' ') AS phrase, count(*) AS f FROM i GROUP BY 1, 2, 3 HAVING count(*) >= 30
), c AS (
  SELECT lang, k, phrase, f, string_split(phrase, ' ') AS ws FROM g WHERE k > 1
), s AS (
  SELECT lang, f, k, ws, unnest(range(2, k)) AS m FROM c WHERE k > 2
), b AS (
  SELECT lang, f, ws, m, unnest(range(1, k - m + 2)) AS i FROM s
), x AS (
  SELECT lang, array_to_string(ws[i : i + m - 1], ' ') AS phrase, max(f) AS longer FROM b GROUP BY 1, 2
), y AS (
  SELECT c.*, unnest(range(1, k)) AS cut FROM c LEFT JOIN x ON c.lang = x.lang AND c.phrase = x.phrase WHERE longer IS NULL OR 100 * longer < 80 * f
), z AS (
  SELECT y.lang, y.phrase, y.f AS a, cut, l.f AS l, r.f AS r, (2000000::HUGEINT * y.f) // (l.f + r.f) AS score
  FROM y JOIN g l ON l.lang = y.lang AND l.phrase = array_to_string(y.ws[1 : cut], ' ') JOIN g r ON r.lang = y.lang AND r.phrase = array_to_string(y.ws[cut + 1 : y.k], ' ')
), m AS (
  SELECT lang, phrase, a, arg_min({'l': l, 'r': r, 'score': score}, {'score': score, 'cut': cut}) AS q FROM z GROUP BY 1, 2, 3
), o AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY q.score DESC, a DESC, phrase) AS rank, phrase, a, q.l AS l, q.r AS r, q.score AS score FROM m
)
SELECT o.lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM o JOIN t USING (lang) WHERE rank <= 2000
"""
