"""Substring dedup by sliding sentence spans.

A text is cut into sentences (at line ends and after . ! ? … before white space); its lower-cased words make a
sentence's hash. From every sentence starts a span, and at every sentence ends one, the shortest run with at least
SENTENCES sentences and WORDS words; where LONG words are reached in PAIR sentences or more, but fewer, that run is a
span too. A single sentence is none. So every sentence of
a run of SENTENCES or more with WORDS is in a span inside that run, and goes with it. Spans are joined globally by a 128-bit hash; of equal spans the first by (doc_id,
text hash, place) stays, and sentences that any other one covers are removed.

A span's hash is summed to one row (count and first holder) before rows of equal hash meet, so a passage in a third of
all texts is no hot group; what comes back to the texts are the spans to remove, in joins that adaptive execution splits.

Defined results: a null or empty text has no sentences and stays as it is; a null doc_id comes after all ids; rows
repeated in full count as one text, which stays where its first span does; an empty table gives an empty result. Long
texts are processed whole. Extra columns are kept by ``remove_repeats``, also when their names clash with those here.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from plumbline.llm.common import content_key, scratch, table, written

SENTENCES = 3
WORDS = 12
PAIR = 2
LONG = 20
#: Where a sentence ends, with the white space after it.
BREAK = re.compile(r"[.!?…]+[\"'”»)\]]*\s+|\n\s*")


def sentences(text: str | None) -> list[tuple[int, int]]:
    """(start, end) of the sentences of a text; together they are the whole text."""
    if not text:
        return []
    ends = [m.end() for m in BREAK.finditer(text)]
    if not ends or ends[-1] < len(text):
        ends.append(len(text))
    return list(zip([0, *ends[:-1]], ends, strict=True))


def spans(text: str | None, least: int = SENTENCES, words: int = WORDS, long: int = LONG) -> list[tuple[int, int, int, int]]:
    """(first sentence, number of sentences, hash high, hash low) of the spans of a text."""
    counts, hashes = [], []
    for a, b in sentences(text):
        own = text[a:b].lower().split()
        counts.append(len(own))
        hashes.append(xxhash.xxh3_128_digest(" ".join(own).encode("utf-8", "surrogatepass")))
    out, n = [], len(counts)
    upto = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    # the shortest runs from each start, and to each end: enough sentences and words, or many words in fewer
    start = np.arange(n)
    few = np.maximum(start + least, np.searchsorted(upto, upto[:-1] + words, side="left"))
    many = np.maximum(start + PAIR, np.searchsorted(upto, upto[:-1] + long, side="left"))
    end = start + 1
    back = np.minimum(end - least, np.searchsorted(upto, upto[1:] - words, side="right") - 1)
    runs = {*zip(start.tolist(), few.tolist(), strict=True), *zip(back.tolist(), end.tolist(), strict=True)}
    short = many < few
    runs.update(zip(start[short].tolist(), many[short].tolist(), strict=True))
    for i, j in sorted(runs):
        # empty sentences begin no span: it would be the span of the sentence after them
        if 0 <= i and j <= n and counts[i]:
            d = xxhash.xxh3_128_digest(b"".join(hashes[i:j]))
            out.append((i, j - i, int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:], "big", signed=True)))
    return out


def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(holder, key_hi, key_lo, text) to a row for each span."""
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            rows, take = [], []
            for i, text in enumerate(part.column(3).to_pylist()):
                own = spans(text)
                rows += own
                take += [i] * len(own)
            if rows:
                index = pa.array(take, pa.int32())
                place, count, hi, lo = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([part.column(0).take(index), part.column(1).take(index), part.column(2).take(index), pa.array(place, pa.int32()), pa.array(count, pa.int32()), pa.array(hi, pa.int64()), pa.array(lo, pa.int64())], names=["holder", "key_hi", "key_lo", "place", "n", "s_hi", "s_lo"])


NO_ID = (1 << 63) - 1


def repeated_spans(documents: DataFrame) -> DataFrame:
    """(key_hi, key_lo, holder, at: array<struct<place, n>>): spans of each text that an earlier place holds already."""
    rows = documents.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("holder"), *content_key(F.coalesce(F.col("text").cast("string"), F.lit(""))), F.col("text").cast("string").alias("text"))
    found = rows.mapInArrow(_emit, "holder long, key_hi long, key_lo long, place int, n int, s_hi long, s_lo long")
    where = F.struct("holder", "key_hi", "key_lo", "place")
    with scratch(documents.sparkSession):
        many = written(found.groupBy("s_hi", "s_lo").agg(F.count("*").alias("c"), F.min(where).alias("first")).where("c > 1").select("s_hi", "s_lo", "first"), "spans-repeated")
        later = found.join(many, ["s_hi", "s_lo"]).where(where != F.col("first"))
        return written(later.groupBy("holder", "key_hi", "key_lo").agg(F.collect_set(F.struct("place", "n")).alias("at")), "spans-removed", keep=True)


def _remove(columns: list[str]):
    where = columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept_text, total, removed = [], [], []
            arrays = batch.column(0).flatten()
            for text, at in zip(arrays[where].to_pylist(), batch.column(1).to_pylist(), strict=True):
                cuts = sentences(text)
                total.append(len(cuts))
                if not at:
                    kept_text.append(text)
                    removed.append(0)
                    continue
                edge = np.zeros(len(cuts) + 1, np.int32)
                np.add.at(edge, [r["place"] for r in at], 1)
                np.add.at(edge, [r["place"] + r["n"] for r in at], -1)
                gone = np.cumsum(edge[:-1]) > 0
                kept_text.append("".join(text[a:b] for (a, b), g in zip(cuts, gone.tolist(), strict=True) if not g))
                removed.append(int(gone.sum()))
            arrays[where] = pa.array(kept_text, pa.string())
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(total, pa.int64()), pa.array(removed, pa.int64())], names=[*columns, "_sentences", "_removed"])

    return run


def remove_repeats(documents: DataFrame) -> DataFrame:
    """All rows and columns of ``documents`` with the repeated sentences out of ``text``, and _sentences, _removed (columns
    of these two names are replaced)."""
    at = repeated_spans(documents)
    columns = [c for c in documents.columns if c not in ("_sentences", "_removed")]
    text = F.col("text").cast("string")
    # the user's row is packed, so that its names clash with none here
    row = F.struct(*[text.alias(c) if c == "text" else F.col(f"`{c}`") for c in columns]).alias("row")
    keyed = documents.select(row, F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("holder"), *content_key(F.coalesce(text, F.lit(""))))
    joined = keyed.join(at, ["holder", "key_hi", "key_lo"], "left").select("row", "at")
    schema = StructType([*joined.schema["row"].dataType.fields, StructField("_sentences", LongType()), StructField("_removed", LongType())])
    return joined.mapInArrow(_remove(columns), schema)


def op1_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("_sentences").alias("n_sentences"), F.col("_removed").alias("n_removed"), F.col("text"), F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))
