"""Language identification by error-correcting output codes.

Every language gets a codeword of +1 and -1. Each bit has a binary classifier, linear over hashed byte n-grams, that tells the
languages with +1 from those with -1; all are trained at once with numpy on a bounded sample, the same number of texts for each
language. A text is decoded to the codeword of least weighted loss: bit b counts for language l by the share of l's sample
that b's classifier gets right. Up to five languages have all distinct bits (exhaustive code); more have a random
code, the one of many draws whose closest codewords are farthest apart, so that some wrong bits do not change the result.
Where the two nearest codewords are about as near, the text is flagged as ambiguous.

Whole texts are read, in pieces; a text's feature is the root of an n-gram's share of all its n-grams. Letters are lower-cased,
all ASCII that is no letter separates words.

Defined results: a null text, or one without a letter, is ``und`` with score 0 and ambiguous, as is every text where nothing
can be learned; a null doc_id is not learned from and not held out; repeated rows are predicted alike; one learned language is
predicted for all texts, with score 1; an empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product
from math import ceil, log2

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import table

#: Bounds of the sample that the classifiers are fitted on: texts of a language, and texts in all (but ten of a language).
PER_LANGUAGE = 400
SAMPLE = 1600
BITS = 13
DIM = 1 << BITS
NGRAMS = (2, 3, 4)
PIECE = 1 << 20
#: Lead of the best language over the next below which a text is ambiguous.
LEAD = 0.5
UNKNOWN = "und"

_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[[k for k in range(128) if not chr(k).isalpha()]] = 0x20


def in_training(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 4 != 2


def _slot(gram: np.ndarray, n: int) -> np.ndarray:
    return ((gram + np.uint32((n * 0x51ED2701) & 0xFFFFFFFF)) * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)


def _count(data: np.ndarray, row: np.ndarray, rows: int, seen: int = 0) -> np.ndarray:
    """n-grams of each row by slot; those that lie in the first ``seen`` bytes were counted before."""
    out = np.zeros(rows * DIM, np.int64)
    gram = data.astype(np.uint32)
    for n in range(2, max(NGRAMS) + 1):
        gram = (gram[:-1] << np.uint32(8)) | data[n - 1 :]
        if n in NGRAMS and len(gram):
            at = max(0, seen - n + 1)
            whole = row[at : len(gram)] == row[at + n - 1 :]
            out += np.bincount((row[at : len(gram)] * DIM + _slot(gram[at:], n))[whole], minlength=rows * DIM)
    return out.reshape(rows, DIM)


def _cleaned(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words with one space between them, and which bytes those are."""
    data = _PLAIN[data]
    letter = data != 0x20
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[:1] = True
    return data[keep], keep


def histograms(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(number of the first row, n-gram counts of a run of rows); null is like an empty text."""
    column = pc.utf8_lower(pc.fill_null(column.cast(pa.large_string()), ""))
    column = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), column, pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string()))
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if len(column) else None
    row, n = 0, len(column)
    while row < n:
        stop = min(row + 128, max(row + 1, int(np.searchsorted(offsets, offsets[row] + PIECE, side="right")) - 1))
        a, b = int(offsets[row]), int(offsets[stop])
        if b - a <= PIECE:
            clean, keep = _cleaned(data[a:b])
            of = np.repeat(np.arange(stop - row), np.diff(offsets[row : stop + 1]))[keep]
            yield row, _count(clean, of, stop - row)
        else:
            total, before = np.zeros((1, DIM), np.int64), np.zeros(0, np.uint8)
            for at in range(a, b, PIECE):
                clean = _cleaned(data[at : min(b, at + PIECE)])[0]
                # a gap that goes on is one space, wherever pieces meet
                clean = np.concatenate([before, clean[1:] if len(before) and before[-1] == clean[0] == 0x20 else clean])
                total += _count(clean, np.zeros(len(clean), np.int64), 1, len(before))
                before = clean[-(max(NGRAMS) - 1) :]
            yield row, total
        row = stop


def features(counts: np.ndarray) -> np.ndarray:
    return np.sqrt(counts / np.maximum(counts.sum(1, keepdims=True), 1)).astype(np.float32)


def codewords(k: int, seed: int = 11) -> np.ndarray:
    """k rows of +1 and -1, one for each language; no column is constant, and none equals another or its opposite."""
    if k <= 5:
        rest = [c for c in product((1, -1), repeat=k - 1) if -1 in c]
        return np.array([(1, *c) for c in rest], np.int8).T.reshape(k, -1)
    rng, best, width = np.random.default_rng(seed), None, max(15, ceil(10 * log2(k)))
    for _ in range(200):
        code = rng.choice(np.array([-1, 1], np.int8), (k, width))
        code = np.unique(code * code[0], axis=1)
        code = code[:, np.abs(code.sum(0, dtype=int)) < k]
        apart = (code[:, None, :] != code[None, :, :]).sum(2) + np.eye(k, dtype=int) * width
        if best is None or apart.min() > best[0]:
            best = int(apart.min()), code
    return best[1]


def train_bits(x: np.ndarray, target: np.ndarray, weight: np.ndarray, steps: int = 150, rate: float = 0.15, decay: float = 2e-5) -> tuple[np.ndarray, np.ndarray]:
    """Logistic regressions of all bits together, by Adam over the whole sample: weights (features x bits) and biases."""
    x1 = np.concatenate([x, np.full((len(x), 1), 0.1, np.float32)], 1)
    w = np.zeros((x1.shape[1], target.shape[1]), np.float32)
    m, v = np.zeros_like(w), np.zeros_like(w)
    y, share = target.astype(np.float32), (weight / weight.sum())[:, None].astype(np.float32)
    for step in range(1, steps + 1):
        slack = -y / (1 + np.exp(np.clip(y * (x1 @ w), -30, 30)))
        grad = x1.T @ (slack * share) + decay * w
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return w[:-1], 0.1 * w[-1]


@dataclass(frozen=True)
class Model:
    """The languages, their codewords, the classifiers of the bits and how much each bit counts for each language."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray

    def decode(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number of the language, score, ambiguous) of each row of n-gram counts."""
        if len(self.languages) == 1:
            return np.zeros(len(counts), int), np.ones(len(counts)), np.zeros(len(counts), bool)
        margin = features(counts) @ self.weights + self.bias
        loss = np.logaddexp(0, -np.clip(margin, -30, 30)[:, None, :] * self.code[None])
        total = (loss * self.trust[None]).sum(2) * self.code.shape[1]
        near = np.exp(total.min(1, keepdims=True) - total)
        near /= near.sum(1, keepdims=True)
        first = total.argmin(1)
        ordered = np.sort(near, 1)
        return first, ordered[:, -1], ordered[:, -1] - ordered[:, -2] < LEAD


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, text) into n-gram counts, slots and numbers of those that are not 0."""
    for batch in batches:
        slots, numbers = [], []
        for _, counts in histograms(batch.column(1)):
            for own in counts:
                held = np.flatnonzero(own)
                slots.append(held.astype(np.int32))
                numbers.append(own[held].astype(np.int32))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(slots, pa.list_(pa.int32())), pa.array(numbers, pa.list_(pa.int32()))], names=["lang", "slots", "numbers"])


def fit(documents: DataFrame, per_language: int = PER_LANGUAGE, sample: int = SAMPLE) -> Model | None:
    """Learns from rows with a lang whose crc32(doc_id) mod 4 is not 2; None where there are none.

    How many a language has is counted over all of them; the classifiers see a draw by a hash of the id, of at most
    ``per_language`` texts of each language and about ``sample`` in all."""
    known = documents.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    known = known.where(F.col("lang").isNotNull() & in_training(F.col("doc_id")) & F.col("text").rlike(r"\p{L}"))
    # one row a language
    sizes = dict(known.groupBy("lang").count().collect())
    if not sizes:
        return None
    most = max(10, min(per_language, sample // len(sizes)))
    languages = sorted(sizes)
    code = codewords(len(languages)) if len(languages) > 1 else np.ones((1, 1), np.int8)
    if len(languages) == 1:
        return Model(languages, code, np.zeros((DIM, 1), np.float32), np.zeros(1, np.float32), np.ones((1, 1)))
    # a fifth more than wanted is drawn, so that the cut below seldom lacks any
    share = F.create_map(*[x for name, n in sizes.items() for x in (F.lit(name), F.lit(int(1e6 * min(1.0, (1.2 * most + 10) / n))))])
    drawn = known.where(F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1_000_000)) < F.try_element_at(share, F.col("lang")))
    rows = sorted(drawn.select("lang", "text").mapInArrow(_sparse, "lang string, slots array<int>, numbers array<int>").collect(), key=lambda r: (r.lang, hash(tuple(r.slots)), r.slots, r.numbers))
    held = {name: 0 for name in languages}
    chosen = []
    for r in rows:
        if held[r.lang] < most:
            held[r.lang] += 1
            chosen.append(r)
    counts = np.zeros((len(chosen), DIM), np.int32)
    for i, r in enumerate(chosen):
        counts[i, r.slots] = r.numbers
    which = np.array([languages.index(r.lang) for r in chosen])
    x = features(counts)
    weights, bias = train_bits(x, code[which], 1 / np.array([held[r.lang] for r in chosen], float))
    right = (np.sign(x @ weights + bias) == code[which]).astype(float)
    trust = np.array([right[which == k].mean(0) if (which == k).any() else np.ones(code.shape[1]) for k in range(len(languages))]) + 1e-3
    return Model(languages, code, weights, bias, trust / trust.sum(1, keepdims=True))


def predict(documents: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred, score, ambiguous of every row of ``documents``."""
    if model is None:
        return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("ambiguous"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            which, score, ambiguous = [np.zeros(0, int)], [np.zeros(0)], [np.zeros(0, bool)]
            for _, counts in histograms(batch.column(1)):
                for kept, x in zip((which, score, ambiguous), model.decode(counts), strict=True):
                    kept.append(x)
            letter = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            names = np.where(letter, np.array(model.languages, object)[np.concatenate(which)], UNKNOWN)
            columns = [batch.column(0), pa.array(names, pa.string()), pa.array(np.where(letter, np.concatenate(score), 0.0)), pa.array(np.concatenate(ambiguous) | ~letter)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score", "ambiguous"])

    text = F.col("text").cast("string")
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("letter"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double, ambiguous boolean")


def op13_language_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = predict(docs, fit(docs))
    return found.select("doc_id", F.coalesce(~in_training(F.col("doc_id")), F.lit(False)).alias("held_out"), "lang_pred", "score", "ambiguous")
