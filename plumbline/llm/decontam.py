"""Benchmark decontamination by latent semantic retrieval and sequence checks.

Terms are the words of the benchmark (hashed to TERMS buckets beyond that many). All texts count passages of WINDOW
words for the document frequencies, and a distributed randomised SVD of the TF-IDF passages gives the latent space: one
pass adds Y = A^T(A G) over the partitions for a random G, and the singular vectors of A's best approximation in that
sketch (Nystrom: Y (G^T Y)^-1 Y^T) are found on the driver. Frequent terms (in more than COMMON of the passages) are
left out, but for the rarest of each item that carry SHARE of its weight: an item that leaks into many passages makes all
its own words frequent, and is still found by them.

Every window of every text, and every item, is projected. A window is a candidate for an item if their cosine reaches
COSINE and the window's part along the item is WEIGHT of the item itself, which a few chance words cannot give; around it the longest common subsequence of words (bit-parallel) is found. An item leaks if SEQUENCE of its
words are met in order, or PARAPHRASE of them with ANSWER of its last line, its answer.

What the corpus adds up to is terms x RANK numbers, summed in two levels; only items are on the driver, ITEMS at a time.

Defined results: a null or empty text, or one without words of the benchmark, leaks nothing; items that are null or have
no words are skipped; equal items are each reported; rows repeated in full are each reported; an empty benchmark or an
empty table gives no pairs. Extra columns are ignored, and kept by ``drop_leaks``.
"""

from __future__ import annotations

import string
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import scratch, table, written

#: Windows start every BLOCK words and are SCALES blocks long; passages for the statistics are as long as the longest.
#: For longer items the scales are doubled until the longest is covered; those windows start every eighth of their length.
BLOCK = 8
SCALES = (2, 4)
WINDOW = BLOCK * SCALES[-1]
TERMS = 1 << 16
RANK = 64
COMMON = 0.01
SHARE = 0.75
COSINE = 0.5
WEIGHT = 0.4
SEQUENCE, PARAPHRASE, ANSWER = 0.8, 0.65, 0.6
ITEMS = 20_000
PUNCTUATION = string.punctuation + "…“”‘’«»¿¡"


#: Marks that often hang on a word: found together with it. What hangs on other words is taken off first.
MARKS = ("", ",", ".", ";", ":", "!", "?", ")", '"', "'")
_MARK = frozenset(PUNCTUATION)


class Terms:
    """Word -> term, whatever marks are at its ends; -1 for words outside the vocabulary."""

    def __init__(self, vocabulary: dict[str, int]):
        self.bare = vocabulary.get
        self.get = {w + m: t for w, t in vocabulary.items() for m in MARKS}.get

    def of(self, text: str | None) -> np.ndarray:
        words = text.lower().split() if text else ()
        out = np.fromiter(map(self.get, words, repeat(-1)), np.int32, len(words))
        for k in np.flatnonzero(out < 0).tolist():
            word = words[k]
            if word[-1] in _MARK or word[0] in _MARK:
                out[k] = self.bare(word.strip(PUNCTUATION), -1)
        return out


def in_row(parts: list[np.ndarray], pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Terms of all texts one behind another, each filled up to a multiple of ``pad`` and one pad more; where each starts."""
    sizes = np.array([-(-len(x) // pad) * pad + pad for x in parts], np.int64)
    starts = np.cumsum(sizes) - sizes
    out = np.full(int(sizes.sum()), -1, np.int32)
    for at, own in zip(starts.tolist(), parts, strict=True):
        out[at : at + len(own)] = own
    return out, starts


def words_of(text: str) -> list[str]:
    """A text's words in lower case without marks at their ends, in place: a word of marks alone is empty."""
    return [w.strip(PUNCTUATION) for w in text.lower().split()]


def vocabulary(items: list[str]) -> tuple[dict[str, int], np.ndarray]:
    """Term of each word, and the bucket of each term in the latent space."""
    words = sorted({w for t in items for w in words_of(t) if w})
    buckets = range(len(words)) if len(words) <= TERMS else (zlib.crc32(w.encode()) % TERMS for w in words)
    return {w: k for k, w in enumerate(words)}, np.fromiter(buckets, np.int32, len(words))


def _passages(terms: np.ndarray, bucket: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(passage, bucket) of the kept terms, in passages of WINDOW words that do not overlap."""
    at = np.flatnonzero(terms >= 0)
    own = bucket[terms[at]]
    good = keep[own]
    return at[good] // WINDOW, own[good]


#: Matrices that one task adds at a time, and how often groups of so many are added: enough for two million partitions.
TOGETHER, LEVELS = 128, 3
SLICE = 512


def _total(rows: DataFrame) -> DataFrame:
    """Sums ``v`` (float64 bytes) by ``k`` over a tree: a task adds those of TOGETHER partitions, whatever their number."""

    def add(part: pa.Table) -> pa.Table:
        total = np.zeros(len(part["v"][0].as_py()) // 8)
        for v in part["v"]:
            total += np.frombuffer(v.as_py(), np.float64)
        return pa.table({"k": part["k"][:1], "salt": part["salt"][:1], "v": pa.array([total.tobytes()], pa.binary())})

    for level in range(LEVELS):
        up = F.floor(F.col("salt") / TOGETHER).cast("int") if level < LEVELS - 1 else F.lit(0)
        rows = rows.select("k", up.alias("salt"), "v").groupBy("k", "salt").applyInArrow(add, "k int, salt int, v binary")
    return rows


def _add_up(encoded: DataFrame, make, size: int, width: int) -> np.ndarray:
    """A size x width matrix summed over all texts. ``make``: () -> function that adds the terms of some texts to a matrix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total, add, seen = np.zeros((size, width)), make(), False
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                seen = True
                add(_decoded(batch.column(0).slice(at, 500)), total)
        if seen:
            rows = [a for a in range(0, size, SLICE) if total[a : a + SLICE].any()]
            salt = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array([a // SLICE for a in rows], pa.int32()), pa.array([salt] * len(rows), pa.int32()), pa.array([total[a : a + SLICE].tobytes() for a in rows], pa.binary())], names=["k", "salt", "v"])

    out = np.zeros((size, width))
    for r in _total(encoded.select("terms").mapInArrow(run, "k int, salt int, v binary")).collect():
        part = np.frombuffer(r.v, np.float64).reshape(-1, width)
        out[r.k * SLICE : r.k * SLICE + len(part)] = part
    return out


def encoded(rows: DataFrame, terms: dict[str, int]) -> DataFrame:
    """``rows`` (doc_id, text) as (doc_id, terms): texts are split into words once, and every later pass reads numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Terms(terms)
        for batch in batches:
            own = [find.of(t).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.binary())], names=["doc_id", "terms"])

    return written(rows.mapInArrow(run, "doc_id long, terms binary"), "decontam-terms")


def _decoded(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x, np.int32) for x in column.to_pylist()]


@dataclass
class Space:
    """Latent space of a set of items: ``rows[bucket]`` is idf times its coordinates; items and answers are terms."""

    terms: dict[str, int]
    bucket: np.ndarray
    rows: np.ndarray
    keep: np.ndarray
    ids: list[int]
    words: list[np.ndarray]
    answers: list[np.ndarray]
    vectors: np.ndarray


def kept_terms(items: list[np.ndarray], df: np.ndarray, n: float, idf: np.ndarray) -> np.ndarray:
    """The terms that are not frequent, and of each item the rarest ones that carry SHARE of its weight."""
    keep = df <= max(COMMON * n, 2)
    for own in items:
        own = np.unique(own)
        own = own[np.argsort(-idf[own], kind="stable")]
        weight = np.cumsum(idf[own] ** 2)
        keep[own[: np.searchsorted(weight, SHARE * weight[-1]) + 1]] = True
    return keep


def fit(texts: DataFrame, items: list[tuple[int, str]], terms: dict[str, int], bucket: np.ndarray, rank: int = RANK, seed: int = 1) -> Space:
    """The space of ``items``, all with words, by the terms of all texts (``encoded``)."""
    size = int(bucket.max()) + 1

    def frequency():
        every = np.ones(size, bool)

        def add(part: list[np.ndarray], total: np.ndarray) -> None:
            terms_of, starts = in_row(part, WINDOW)
            p, t = _passages(terms_of, bucket, every)
            if len(t):
                total[:, 0] += np.bincount(np.unique(p * size + t) % size, minlength=size)
            # every text has one passage more than it fills
            total[0, 1] += len(terms_of) // WINDOW - len(starts)

        return add

    counts = _add_up(texts, frequency, size, 2)
    df, n = counts[:, 0], counts[0, 1]
    # above 0 also for a term in every passage
    idf = np.log1p(n / (1 + df))
    words = [np.array([terms[w] for w in words_of(t) if w], np.int32) for _, t in items]
    keep = kept_terms([bucket[own] for own in words], df, n, idf)
    rng = np.random.default_rng(seed)
    rank = min(rank, size)

    def sketch(basis: np.ndarray):
        def make():
            scaled, squares = basis * idf[:, None], idf**2

            def add(part: list[np.ndarray], total: np.ndarray) -> None:
                p, t = _passages(in_row(part, WINDOW)[0], bucket, keep)
                if not len(t):
                    return
                first = np.flatnonzero(np.append(True, p[1:] != p[:-1]))
                y = np.add.reduceat(scaled[t], first)
                y /= np.maximum(np.add.reduceat(squares[t], first), 1e-18)[:, None]
                passage = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(p))))
                order = np.argsort(t, kind="stable")
                at = np.flatnonzero(np.append(True, t[order][1:] != t[order][:-1]))
                total[t[order][at]] += np.add.reduceat(y[passage[order]], at)

            return add

        return make

    g = rng.standard_normal((size, rank))
    q, _ = np.linalg.qr(g)
    y = _add_up(texts, sketch(q), size, rank) * idf[:, None]
    # Nystrom: A^T A ~ Y (Q^T Y)^-1 Y^T, shifted so that the small matrix is positive definite
    shift = 1e-8 * max(np.linalg.norm(y), 1e-12)
    y += shift * q
    small = q.T @ y
    root = np.linalg.cholesky((small + small.T) / 2 + shift * np.eye(rank))
    v, _, _ = np.linalg.svd(np.linalg.solve(root, y.T).T, full_matrices=False)
    rows = (v * (idf * keep)[:, None]).astype(np.float32)
    last = [[terms[w] for w in words_of(t.strip().split("\n")[-1]) if w] for _, t in items]
    answers = [np.array(a, np.int32) if a else own for a, own in zip(last, words, strict=True)]
    vectors = np.array([rows[bucket[own]].sum(axis=0) for own in words], np.float32)
    return Space(terms, bucket, rows, keep, [i for i, _ in items], words, answers, vectors)


def lcs(masks: dict, n: int, words: list) -> int:
    """Length of the longest common subsequence; ``masks``: word -> bits of its places in the other sequence of n words."""
    full = (1 << n) - 1
    s = full
    for w in words:
        m = masks.get(w)
        if m:
            u = s & m
            s = ((s + u) | (s - u)) & full
    return n - s.bit_count()


def word_masks(words: list) -> dict:
    out: dict = {}
    for k, w in enumerate(words):
        out[w] = out.get(w, 0) | 1 << k
    return out


class Matcher:
    """Items that leak into a text: (item, cosine, share of its words in sequence, share of its answer)."""

    def __init__(self, space: Space):
        self.space = space
        self.norms = np.maximum(np.linalg.norm(space.vectors, axis=1), 1e-9)
        self.unit = (space.vectors / self.norms[:, None]).astype(np.float32)
        self.masks: dict[int, tuple] = {}
        # the distinct terms of all items one behind another, how often the item has each, and where items begin
        own = [np.unique(w, return_counts=True) for w in space.words]
        self.own, self.times = (np.concatenate([o[k] for o in own]) for k in (0, 1))
        self.begins = np.concatenate([[0], np.cumsum([len(o[0]) for o in own])])
        self.lengths = np.array([len(w) for w in space.words])
        # the shortest scale that covers an item, in words; a scale beyond SCALES is compared with the items it is needed for
        self.covers = np.array([max(WINDOW, BLOCK << max(0, (-(-len(w) // BLOCK) - 1).bit_length())) for w in space.words])
        self.scales = list(SCALES)
        while self.scales[-1] * BLOCK < self.covers.max():
            self.scales.append(2 * self.scales[-1])
        #: Texts are filled up so that no window reaches into the next one; where windows are long, fewer are taken at once.
        self.pad = self.scales[-1] * BLOCK
        self.step = max(1, min(500, (1 << 19) // self.pad))

    def candidates(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first word of the window, item, cosine), in order of the window."""
        space = self.space
        at = np.flatnonzero(terms >= 0)
        at = at[space.keep[space.bucket[terms[at]]]]
        none = np.zeros(0, np.int64)
        if not len(at):
            return none, none, np.zeros(0)
        blocks = at // BLOCK
        first = np.flatnonzero(np.append(True, blocks[1:] != blocks[:-1]))
        windows = np.zeros((len(terms) // BLOCK + self.scales[-1], space.rows.shape[1]), np.float32)
        windows[blocks[first]] = np.add.reduceat(space.rows[space.bucket[terms[at]]], first)
        out, scale, weight = [], 1, (WEIGHT * self.norms).astype(np.float32)
        for wanted in self.scales:
            while scale < wanted:
                windows, scale = windows[:-scale] + windows[scale:], 2 * scale
            own = np.flatnonzero(self.covers >= wanted * BLOCK) if wanted > SCALES[-1] else np.arange(len(self.covers))
            stride = max(1, wanted // 8)
            unit, least, looked = self.unit[own].T, weight[own], windows[::stride]
            norm = np.sqrt(np.einsum("ij,ij->i", looked, looked))
            some = np.flatnonzero(norm > least.min())
            for a in range(0, len(some), 4096):
                part = some[a : a + 4096]
                along = looked[part] @ unit
                # the weight decides nearly all; cosines are worked out for what is left
                w, i = np.divmod(np.flatnonzero((along >= least).ravel()), len(own))
                cosine = along[w, i] / norm[part][w]
                good = cosine >= COSINE
                out.append((part[w[good]] * stride * BLOCK, own[i[good]], cosine[good]))
        if not out:
            return none, none, np.zeros(0)
        start, item, cosine = (np.concatenate(x) for x in zip(*out, strict=True))
        order = np.argsort(start, kind="stable")
        return start[order], item[order], cosine[order]

    def batch(self, parts: list[np.ndarray]) -> list[list[tuple[int, float, float, float]]]:
        """What leaks into each of some texts, given by their terms."""
        terms, starts = in_row(parts, self.pad)
        start, item, cosine = self.candidates(terms)
        # windows that start within one stretch of WINDOW words share a region, and are looked at once for each item
        stretch = start // WINDOW
        order = np.lexsort((item, self.covers[item], stretch))
        stretch, item = stretch[order], item[order]
        first = np.flatnonzero(np.append(True, (stretch[1:] != stretch[:-1]) | (item[1:] != item[:-1]))) if len(order) else order
        cosine = np.maximum.reduceat(cosine[order], first) if len(order) else cosine
        stretch, item = stretch[first], item[first]
        text = np.searchsorted(starts, stretch * WINDOW, side="right") - 1
        cover = self.covers[item]
        # no window of the item is longer than its cover, nor is the item
        low = np.maximum(starts[text], stretch * WINDOW - cover)
        high = np.minimum(starts[text] + np.array([len(x) for x in parts], np.int64)[text], (stretch + 1) * WINDOW + 2 * cover)
        # a window that starts behind a text's end and reaches the next text is met there too
        good = self._shares(terms, low, np.maximum(low, high), item)
        found: list[dict[int, tuple[float, float, float]]] = [{} for _ in parts]
        at, words = (-1, -1), []
        for t, a, b, k, c in zip(text[good].tolist(), low[good].tolist(), high[good].tolist(), item[good].tolist(), cosine[good].tolist(), strict=True):
            if (a, b) != at:
                at, words = (a, b), terms[a:b].tolist()
            self._check(words, k, c, found[t])
        return [[(k, *v) for k, v in sorted(own.items())] for own in found]

    def _shares(self, terms: np.ndarray, low: np.ndarray, high: np.ndarray, item: np.ndarray) -> np.ndarray:
        """The candidates whose region, from low to high, holds PARAPHRASE of the item's words: no sequence is longer than
        what is in common. Regions are marked in a matrix of bounded size."""
        if not len(item):
            return np.zeros(0, np.int64)
        new = np.append(True, (low[1:] != low[:-1]) | (high[1:] != high[:-1]))
        region, first = np.cumsum(new) - 1, np.flatnonzero(new)
        width = len(self.space.bucket) + 1
        most, out = max(1, (1 << 24) // width), []
        for r in range(0, len(first), most):
            a, b = low[first[r : r + most]], high[first[r : r + most]]
            mark = np.zeros((len(a), width), bool)
            spots = np.repeat(a - np.append(0, np.cumsum(b - a)[:-1]), b - a) + np.arange(int((b - a).sum()))
            # -1 marks the last column, which is no term
            mark[np.repeat(np.arange(len(a)), b - a), terms[spots]] = True
            mine = np.flatnonzero((region >= r) & (region < r + most))
            n = self.begins[item[mine] + 1] - self.begins[item[mine]]
            ends = np.cumsum(n)
            spots = np.repeat(self.begins[item[mine]] - (ends - n), n) + np.arange(int(ends[-1]))
            shared = np.add.reduceat(mark[np.repeat(region[mine] - r, n), self.own[spots]] * self.times[spots], ends - n)
            out.append(mine[shared >= PARAPHRASE * self.lengths[item[mine]]])
        return np.concatenate(out)

    def _item(self, k: int) -> tuple:
        """Masks and length of an item and of its answer."""
        if k not in self.masks:
            w, a = self.space.words[k].tolist(), self.space.answers[k].tolist()
            self.masks[k] = (word_masks(w), len(w), word_masks(a), len(a))
        return self.masks[k]

    def _check(self, words: list[int], k: int, cosine: float, found: dict[int, tuple[float, float, float]]) -> None:
        """Adds item ``k`` to ``found`` if it leaks into a region, given by its terms."""
        if k in found and found[k][1] >= 1:
            return
        masks, n, answer, n_answer = self._item(k)
        # a sequence counts where it is close together: pieces of a length and a half of the item
        best = (0.0, 0.0)
        for a in range(0, max(1, len(words) - n), max(1, n // 4)):
            piece = words[a : a + n + max(2, n // 2)]
            share = lcs(masks, n, piece) / n
            if share > best[0]:
                best = (share, lcs(answer, n_answer, piece) / n_answer)
        if best[0] >= SEQUENCE or (best[0] >= PARAPHRASE and best[1] >= ANSWER):
            if k not in found or found[k][1] < best[0]:
                found[k] = (cosine, *best)


def _spaces(documents: DataFrame, benchmark: DataFrame) -> Iterator[tuple[Space, DataFrame]]:
    """A space for each ITEMS of the benchmark, and the terms of all texts in it."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    groups = max(1, -(-rows.count() // ITEMS))
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    for g in range(groups):
        part = rows.where(F.pmod(F.xxhash64("text"), F.lit(groups)) == g).collect()
        items = sorted(((r.item_id, r.text) for r in part if any(words_of(r.text))), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        if items:
            terms, bucket = vocabulary([t for _, t in items])
            words = encoded(texts, terms)
            yield fit(words, items, terms, bucket), words


LEAKS = "doc_id long, item_id long, cosine double, lcs_share double, answer_share double"


def leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, cosine, lcs_share, answer_share of every item that leaks into a text."""
    out = documents.sparkSession.createDataFrame([], LEAKS)
    with scratch(documents.sparkSession):
        for space, words in _spaces(documents, benchmark):

            def run(batches: Iterator[pa.RecordBatch], space: Space = space) -> Iterator[pa.RecordBatch]:
                match = Matcher(space)
                for batch in batches:
                    for at in range(0, batch.num_rows, match.step):
                        part = batch.slice(at, match.step)
                        found = [(d, space.ids[k], c, s, a) for d, own in zip(part.column(0).to_pylist(), match.batch(_decoded(part.column(1))), strict=True) for k, c, s, a in own]
                        if found:
                            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*found, strict=True), (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()), strict=True)], names=["doc_id", "item_id", "cosine", "lcs_share", "answer_share"])

            out = out.unionByName(written(words.mapInArrow(run, LEAKS), "leaks", keep=True))
    return out


def drop_leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``documents``, all columns, into which no item leaks."""
    out = documents
    where = documents.columns.index("text")
    with scratch(documents.sparkSession):
        for space, _ in _spaces(documents, benchmark):

            def run(batches: Iterator[pa.RecordBatch], space: Space = space) -> Iterator[pa.RecordBatch]:
                match, find = Matcher(space), Terms(space.terms)
                for batch in batches:
                    for at in range(0, batch.num_rows, match.step):
                        part = batch.slice(at, match.step)
                        yield part.filter(pa.array([not own for own in match.batch([find.of(t) for t in part.column(where).to_pylist()])], pa.bool_()))

            out = out.mapInArrow(run, documents.schema)
    return out


def op3_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
