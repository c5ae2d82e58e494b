"""Toxicity by non-negative positive-unlabelled (nnPU) learning.

The classifier sees two bounded samples: confirmed toxic texts (P) and unlabelled texts (U), which hold toxic ones at
the class prior pi. Its risk estimate is ``pi * R_P(+1) + max(0, R_U(-1) - pi * R_P(-1))``: the second part estimates
the risk on clean text without a clean label. When a batch drives that part below zero the step goes uphill on it, so
that a flexible model cannot win by overfitting P.

Features are the presence of words and of word beginnings (inflected insults share a stem), selected by a two-sample
z score of their document frequency in P against that in all training texts; the sample bounds the gradient steps alone.
The model is linear and trained here with numpy.

Defined results: a null or empty text has no features and gets the bias alone; a document id that is null is never in
a sample, is scored like any other and is not held out; repeated rows are scored each; with no confirmed toxic text in the training
part every score is the prior (0 where no label exists). Extra columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import scratch, table, written

#: Bounds of what the classifier is fitted on; everything else reads all rows.
MAX_POSITIVE = 4000
MAX_UNLABELLED = 6000
MAX_FEATURES = 1000
STEMS = (4, 5, 6, 7)
MIN_DF = 3
MIN_Z = 4.0
#: Least ratio of a feature's share in P to its share in U, as a part of 1 / pi (what a feature of toxic texts alone has).
MIN_LIFT = 0.45
WORD = re.compile(r"\w+")
CACHE_WORDS = 400_000


def word_features(word: str) -> list[str]:
    """The word itself, a long one by its digest, and its beginnings, marked so that a word never equals a stem."""
    whole = word if len(word) <= 40 else "#" + hashlib.blake2b(word.encode(), digest_size=16).hexdigest()
    return ["=" + whole, *("^" + word[:n] for n in STEMS if len(word) > n)]


def in_training(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 5 != 0


@dataclass(frozen=True)
class Model:
    """``features`` maps a feature to its weight's index; a document's score is sigmoid(bias + sum of its weights)."""

    features: dict[str, int]
    weights: np.ndarray
    bias: float


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[str] = Counter()
    cache: dict[str, list[str]] = {}
    for batch in batches:
        for text in batch.column(0).to_pylist():
            own: set[str] = set()
            for word in set(WORD.findall((text or "").lower())):
                if (found := cache.get(word)) is None:
                    found = cache[word] = word_features(word)
                own.update(found)
            counts.update(own)
    names = list(counts)
    for at in range(0, len(names), 50_000):
        part = names[at : at + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([counts[x] for x in part], pa.int64())], names=["feature", "n"])


def _document_frequency(texts: DataFrame, features: list[str]) -> np.ndarray:
    """In how many of all ``texts`` each feature is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, total = _Finder({x: k for k, x in enumerate(features)}), np.zeros(len(features), np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                total[list(find(text))] += 1
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], names=["k", "n"])

    out = np.zeros(len(features))
    for r in texts.select("text").mapInArrow(run, "k int, n long").groupBy("k").agg(F.sum("n").alias("n")).collect():
        out[r.k] = r.n
    return out


class _Finder:
    """Indices of the selected features in a text; remembers what each word holds."""

    def __init__(self, features: dict[str, int]):
        self.features, self.cache = features, {}

    def __call__(self, text: str | None) -> set[int]:
        found: set[int] = set()
        for word in set(WORD.findall((text or "").lower())):
            own = self.cache.get(word)
            if own is None:
                if len(self.cache) >= CACHE_WORDS:
                    self.cache.clear()
                own = self.cache[word] = tuple(k for x in word_features(word) if (k := self.features.get(x)) is not None)
            if own:
                found.update(own)
        return found


def train_nnpu(x_p: np.ndarray, x_u: np.ndarray, prior: float, *, epochs: int = 80, batch: int = 512, rate: float = 0.05, decay: float = 1e-5, seed: int = 7) -> tuple[np.ndarray, float]:
    """Linear nnPU with the sigmoid loss, by Adam; weights stay at 0 or above, as features were chosen for pointing at P.

    ``x_p`` and ``x_u``: 0/1 matrices. Returns weights and bias.
    """
    rng = np.random.default_rng(seed)
    d = x_p.shape[1]
    w, m, v = np.zeros(d + 1), np.zeros(d + 1), np.zeros(d + 1)
    w[d] = np.log(prior / (1 - prior))
    step = 0
    parts = max(1, len(x_u) // batch)
    for _ in range(epochs):
        p_order, u_order = rng.permutation(len(x_p)), rng.permutation(len(x_u))
        for p_idx, u_idx in zip(np.array_split(p_order, parts), np.array_split(u_order, parts), strict=True):
            if not len(p_idx) or not len(u_idx):
                continue
            p, u = x_p[p_idx].astype(np.float64), x_u[u_idx].astype(np.float64)
            s_p, s_u = 1 / (1 + np.exp(-(p @ w[:d] + w[d]))), 1 / (1 + np.exp(-(u @ w[:d] + w[d])))
            # sigmoid loss: s(-f) for label +1, s(f) for label -1; derivatives -s(1 - s) and s(1 - s)
            clean_risk = s_u.mean() - prior * s_p.mean()
            g_u, g_p = s_u * (1 - s_u) / len(u), -prior * s_p * (1 - s_p) / len(p)
            if clean_risk >= 0:
                g_p = 2 * g_p
            else:
                g_u, g_p = -g_u, -g_p
            grad = np.concatenate([p.T @ g_p + u.T @ g_u, [g_p.sum() + g_u.sum()]])
            grad[:d] += decay * w[:d]
            step += 1
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
            w = w - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
            w[:d] = np.maximum(w[:d], 0)
    return w[:d], float(w[d])


def fit(documents: DataFrame, labels: DataFrame) -> Model:
    """Learns from rows whose crc32(doc_id) mod 5 is not 0: labels give P and the prior, U is drawn without labels."""
    known = labels.where(F.col("toxic").isNotNull() & in_training(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    total, toxic = known.agg(F.count("*"), F.sum((F.col("toxic") == 1).cast("long"))).first()
    docs = documents.select("doc_id", "text").where(in_training(F.col("doc_id")))
    prior = (toxic or 0) / total if total else 0.0
    if not toxic:
        return Model({}, np.zeros(0), float("-inf"))
    prior = min(max(prior, 1e-4), 0.5)
    spread = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("sample")), F.lit(1_000_000))
    # at most MAX_POSITIVE ids: a proven bound for the broadcast
    chosen = known.where((F.col("toxic") == 1) & (spread < F.lit(int(1_000_000 * min(1.0, 0.95 * MAX_POSITIVE / toxic))))).select("doc_id", F.lit(True).alias("positive")).limit(MAX_POSITIVE)
    rows = docs.count()
    share = int(1_000_000 * min(1.0, MAX_UNLABELLED / max(rows, 1)))
    sample = docs.join(F.broadcast(chosen), "doc_id", "left").where(F.col("positive") | (spread < F.lit(share))).select("text", F.coalesce("positive", F.lit(False)).alias("positive"), (spread < F.lit(share)).alias("drawn"))
    # a confirmed toxic text that the unlabelled draw also hits belongs to both
    sample = sample.select("text", F.explode(F.when(F.col("positive") & F.col("drawn"), F.array(F.lit(True), F.lit(False))).otherwise(F.array("positive"))).alias("positive"))
    with scratch(documents.sparkSession):
        return _fit_sample(written(sample, "toxicity-sample"), docs, rows, prior)


def _fit_sample(sample: DataFrame, docs: DataFrame, rows: int, prior: float) -> Model:
    """Features by their counts in P and in all of ``docs``, weights by the sample."""
    empty = Model({}, np.zeros(0), float(np.log(prior / (1 - prior))))
    n_p, n_u = sample.agg(F.sum(F.col("positive").cast("long")), F.sum((~F.col("positive")).cast("long"))).first()
    if not n_p or not n_u:
        return empty
    in_p = sample.where("positive").select("text").mapInArrow(_count_features, "feature string, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    # features of MIN_DF of at most MAX_POSITIVE texts
    known = sorted(in_p.where(F.col("n") >= min(MIN_DF, max(1, n_p // 10))).collect())
    names, p = [r[0] for r in known], np.array([r[1] for r in known], float)
    u = _document_frequency(docs, names)
    pooled = (p + u) / (n_p + rows)
    with np.errstate(divide="ignore", invalid="ignore"):
        z = (p / n_p - u / rows) / np.sqrt(pooled * (1 - pooled) * (1 / n_p + 1 / rows))
    good = np.flatnonzero((pooled < 1) & (z >= MIN_Z) & (p / n_p >= MIN_LIFT / prior * u / rows))
    features = {names[i]: k for k, i in enumerate(good[np.argsort(-z[good], kind="stable")][:MAX_FEATURES])}
    if not features:
        return empty

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = _Finder(features)
        for batch in batches:
            held = [sorted(find(t)) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.list_(pa.int32())), batch.column(1)], names=["held", "positive"])

    held = {True: [], False: []}
    for r in sorted(sample.mapInArrow(rows_of, "held array<int>, positive boolean").collect(), key=lambda r: (r.positive, r.held)):
        held[r.positive].append(r.held)

    def matrix(lists: list[list[int]]) -> np.ndarray:
        out = np.zeros((len(lists), len(features)), np.uint8)
        for i, own in enumerate(lists):
            out[i, own] = 1
        return out

    weights, bias = train_nnpu(matrix(held[True]), matrix(held[False]), prior)
    return Model(features, weights, bias)


def score(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, text untouched and ``score`` for every row of ``documents``; other columns are dropped."""
    weights = model.weights.tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = _Finder(model.features)
        for batch in batches:
            f = np.array([model.bias + sum(weights[k] for k in sorted(find(t))) for t in batch.column(1).to_pylist()], float)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(f, -60, 60))))], names=["doc_id", "score"])

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")


def op2_toxicity_nnpu(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", F.coalesce(~in_training(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``documents``, all columns, that the classifier does not reject. A row is judged by its own text."""
    model = fit(documents, labels)
    weights = model.weights.tolist()
    columns = documents.columns
    where = columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = _Finder(model.features)
        for batch in batches:
            keep = [model.bias + sum(weights[k] for k in sorted(find(t))) < 0 for t in batch.column(where).to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return documents.mapInArrow(run, documents.schema)
