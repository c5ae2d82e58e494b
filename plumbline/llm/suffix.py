"""Removal of every byte that a repeated string of LENGTH bytes covers, by merging Burrows-Wheeler transforms.

1. Anchors. The anchor of a string of LENGTH bytes is its GRAM-byte substring of smallest hash, so equal strings have the
   same anchor at the same place. Text whose anchors occur once cannot repeat and goes no further; this is exact.
2. Contexts. The bytes of the strings that an anchor stands for; each string of a text is in one context. Equal contexts (by 128-bit digest) collapse to
   one with a count before anything is dealt out; a context that occurs twice repeats in full.
3. Transforms. Contexts that occur once but share their anchor with others go to ``repeated_windows``: shards of them get
   a Burrows-Wheeler transform each, and the transforms are merged by iterative refinement of their interleave, which
   starts unordered and is stably dealt by the next preceding symbol until suffixes are in order to LENGTH bytes. A suffix
   that has parted from both its neighbours leaves; intervals that no round parts are the repeated strings.
   No suffix is sorted again. A symbol is STRIDE bytes, with a string for each phase, so 25 rounds reach 200 bytes.
4. Hot anchors. Where more than HOT different contexts share an anchor, they are cut into narrower ones keyed by the
   bytes that all their strings share: first a few strings wide, then one, which its count alone decides. So no task
   meets a hot group, and the result stays exact.

Defined results: a null text is empty; texts shorter than LENGTH lose nothing; a text that occurs in several rows is
repeated in full if it is long enough; overlaps in one text count; bytes are judged on the input; an empty table gives an
empty result. Extra columns are ignored by the query and kept by ``cut_repeats``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import content_key, scratch, table, written

LENGTH = 200
GRAM = 64
STRIDE = 8
SHARDS = 4
#: Positions of one merge: their ranks fit in 16 bits.
MERGE = 64_000
HOT = 150
BUCKET = 2000
#: Bytes that are hashed at a time: what is made of them stays in a processor's cache.
PIECE = 1 << 17
WIDTHS = (8, 1)
#: Fixed pseudo-random values, one for each byte.
_BYTE = np.random.default_rng(3).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_STEP = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5, 0xD6E8FEB86659FD93)]
_LAST = np.uint64((1 << 64) - 1)


def _slide(x: np.ndarray, width: int, best) -> np.ndarray:
    """best (minimum or maximum) of each run of ``width`` values."""
    have, out = 1, x
    while have * 2 <= width:
        out = best(out[:-have], out[have:])
        have *= 2
    return best(out[: len(x) - width + 1], out[width - have :]) if have < width else out


def anchors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Positions and hashes of the anchors of texts [start, end) in one buffer, and the first and last string each stands for.

    A string's anchor is its gram of smallest hash, the leftmost of equals, so every string has one. Texts are at least
    ``length`` bytes.
    """
    h = _BYTE[data]
    size, step = 1, 0
    with np.errstate(over="ignore"):
        while size < gram:
            left = h[:-size] * _STEP[step % 6]
            left += h[size:]
            h = left
            h ^= h >> np.uint64(31)
            size, step = size * 2, step + 1
        h *= _STEP[0]
        h ^= h >> np.uint64(32)
    # a gram is good if it lies in one text, a string if it does
    good, whole = np.zeros(len(data) + 1, np.int32), np.zeros(len(data) + 1, np.int32)
    np.add.at(good, starts, 1)
    np.add.at(good, ends - gram + 1, -1)
    np.add.at(whole, starts, 1)
    np.add.at(whole, ends - length + 1, -1)
    low32 = np.uint64(0xFFFFFFFF)
    ranked = np.where(np.cumsum(good)[: len(h)] > 0, (h & ~low32) | np.arange(len(h), dtype=np.uint64), _LAST)
    best = (_slide(ranked, length - gram + 1, np.minimum) & low32).astype(np.int64)
    at = np.flatnonzero(np.cumsum(whole)[: len(best)] > 0)
    best = best[at]
    first = np.flatnonzero(np.append(True, best[1:] != best[:-1]))
    last = np.append(first[1:], len(at)) - 1
    return best[first], h[best[first]], at[first], at[last]


class Transform:
    """A shard's Burrows-Wheeler transform: for its suffixes in order to ``depth`` symbols, where each starts and what precedes it."""

    def __init__(self, symbols: np.ndarray, depth: int):
        # ranks of one symbol, three, nine and so on; suffixes go on at the front
        rank, have, groups, n = symbols, 1, -1, len(symbols)
        ring = np.arange(n)
        while (have < depth or groups < 0) and groups < n - 1:
            reach = min(depth, 3 * have)
            self.order, parted = _sorted([rank[(ring + k) % n] for k in sorted({0, min(have, reach - have), reach - have})])
            rank = np.empty(n, np.int64)
            rank[self.order] = np.cumsum(parted)
            have, groups = reach, int(parted.sum())
        self.before = symbols[self.order - 1]


def _sorted(ranks: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The places of rows of up to three ranks in stable order, and which rows in order differ from the one before.

    A row and its place are one word, as sorting words is several times as fast as finding the order of rows."""
    n = len(ranks[0])
    if n > 1 << 16:
        order = np.lexsort(ranks[::-1])
        return order, np.append(False, np.any([r[order][1:] != r[order][:-1] for r in ranks], axis=0))
    kind = np.uint32 if len(ranks) == 1 else np.uint64
    word = ranks[0].astype(kind)
    for r in ranks[1:]:
        word <<= kind(16)
        word |= r.astype(kind)
    word <<= kind(16)
    word |= np.arange(n, dtype=kind)
    word.sort()
    order = (word & kind(0xFFFF)).astype(np.int64)
    word >>= kind(16)
    parted = np.zeros(n, bool)
    np.not_equal(word[1:], word[:-1], out=parted[1:])
    return order, parted


def merge(shards: list[Transform], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merges transforms: (shard, place in the shard's order, interval) of the suffixes that share ``depth`` symbols with another, in merged order."""
    sizes = np.array([len(s.order) for s in shards], np.int64)
    begin, source = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(shards)), sizes)
    befores = np.concatenate([s.before for s in shards])
    # a shard's suffixes keep their order: where each goes among its own is the same in all rounds
    follow = np.empty(len(source), np.int64)
    for first, s in zip(begin, shards, strict=True):
        follow[first + _sorted([s.before])[0]] = np.arange(first, first + len(s.order))
    at, group, last = np.arange(len(source)), np.zeros(len(source), np.int32), (0, 0)
    for _ in range(depth):
        deal, parted = _sorted([befores[at]])
        came = group[deal]
        parted[1:] |= came[1:] != came[:-1]
        parted[:1] = True
        # what is parted stays so: who stands alone leaves, and so does what it precedes
        stay = ~parted
        stay[:-1] |= stay[1:]
        at = follow[at[deal[stay]]]
        group = np.cumsum(parted[stay], dtype=np.int32)
        # a round that parts nothing new is like all that would follow
        now = (len(group), int(group[-1]) if len(group) else 0)
        if now == last or not len(group):
            break
        last = now
    source = source[at]
    return source, at - begin[source], group


def repeated_windows(contexts: list[bytes], length: int = LENGTH, stride: int = STRIDE, n_shards: int = SHARDS) -> list[np.ndarray]:
    """For each byte string the starts of its ``length``-byte windows that also start elsewhere in the collection."""
    who, where = _repeated(contexts, length, stride, n_shards)
    return np.split(where, np.searchsorted(who, np.arange(1, len(contexts)))) if contexts else []


def _repeated(contexts: list[bytes], length: int, stride: int = STRIDE, n_shards: int = SHARDS) -> tuple[np.ndarray, np.ndarray]:
    """(string, start) of each such window, in order."""
    depth = length // stride
    if length % stride:
        raise ValueError("the length is a multiple of the stride")
    # a string for each context and phase, a 0 behind it
    sizes = np.array([len(c) for c in contexts], np.int64)
    owner, phase = np.repeat(np.arange(len(contexts)), stride), np.tile(np.arange(stride), len(contexts))
    count = (sizes[owner] - phase) // stride
    owner, phase, count = (x[count >= depth] for x in (owner, phase, count))
    if not len(owner):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ends = np.cumsum(count + 1)
    piece = np.repeat(np.arange(len(owner)), count + 1)
    nth = np.arange(ends[-1]) - (ends - count - 1)[piece]
    left = count[piece] - nth
    at = phase[piece] + stride * nth
    data = np.frombuffer(b"".join(contexts) + bytes(stride), np.uint8)
    every = np.lib.stride_tricks.sliding_window_view(data, stride)
    inside = left > 0
    symbols = np.ascontiguousarray(every[((np.cumsum(sizes) - sizes)[owner[piece]] + at)[inside]]).view(f">u{stride}").ravel().astype(f"u{stride}")
    # ranks of all symbols; 0 parts strings
    different, rank = np.unique(symbols, return_inverse=True)
    if len(different) > 65_535:
        raise ValueError("too many different symbols for one merge")
    text = np.zeros(len(piece), np.uint16)
    text[inside] = rank + 1
    transforms, maps = [], []
    for part in np.array_split(np.arange(len(owner)), min(n_shards, len(owner))):
        cut = slice(ends[part[0]] - count[part[0]] - 1, ends[part[-1]])
        t = Transform(text[cut], depth)
        transforms.append(t)
        maps.append((owner[piece[cut]][t.order], at[cut][t.order], left[cut][t.order] >= depth))
    source, place, _ = merge(transforms, depth)
    sizes = np.array([len(t.order) for t in transforms], np.int64)
    mine = (np.cumsum(sizes) - sizes)[source] + place
    own, at, whole = (np.concatenate(x) for x in zip(*maps, strict=True))
    mine = mine[whole[mine]]
    found = np.sort(own[mine] << 32 | at[mine])
    return found >> 32, found & 0xFFFFFFFF


def _parts(column: pa.Array, size: int = 2_000_000) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows of a binary column, about ``size`` bytes at a time: (first row, rows, bytes in one, where each row begins and the last one ends)."""
    bounds = np.append(0, np.cumsum(pc.binary_length(column).to_numpy(), dtype=np.int64))
    at = 0
    while at < len(column):
        n = min(max(1, int(np.searchsorted(bounds, bounds[at] + size)) - at), len(column) - at)
        data = b"".join([x.as_buffer() for x in column.slice(at, n)])
        yield at, n, np.frombuffer(data, np.uint8), bounds[at : at + n + 1] - bounds[at]
        at += n


def _listed(column: pa.Array) -> tuple[np.ndarray, list[pa.Array]]:
    """The row of each struct in a column of lists of structs, and the fields of the structs."""
    inner = column.flatten()
    return np.repeat(np.arange(len(column)), np.diff(column.offsets.to_numpy())), inner.flatten()


def _emit_anchors(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hi, lo, data = (batch.column(i) for i in range(3))
            out: list[tuple] = []
            for at, n, whole, bounds in _parts(data, PIECE):
                begin, end = bounds[:-1], bounds[1:]
                pos, h, first, last = anchors(whole, begin, end, length, gram)
                row = np.searchsorted(end, pos, side="right")
                out.append((h.view(np.int64), row + at, *((x - begin[row]).astype(np.int32) for x in (pos, first, last))))
                if len(out) == 16 or at + n == batch.num_rows:
                    h, row, *places = (np.concatenate(x) for x in zip(*out, strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(h), hi.take(pa.array(row)), lo.take(pa.array(row)), *map(pa.array, places)], names=["anchor", "key_hi", "key_lo", "pos", "first", "last"])
                    out = []

    return run


def _digests(data: list[bytes], starts: np.ndarray, stops: np.ndarray, size: int) -> np.ndarray:
    """Digests of data[start:stop] as rows of longs."""
    made = b"".join([hashlib.blake2b(d[a:b], digest_size=size).digest() for d, a, b in zip(data, starts.tolist(), stops.tolist(), strict=True)])
    return np.frombuffer(made, ">i8").reshape(-1, size // 8).astype(np.int64)


def _emit_contexts(width: int | None, length: int, gram: int):
    """Rows (key_hi, key_lo, data, at: array<struct<pos, first, last, anchor, weight>>) to contexts; width None: one for each anchor."""
    reach = length - gram
    wide = width or reach + 1
    cuts = np.arange(0, reach + 1, wide)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            rows, fields = _listed(batch.column(3))
            every = [x.to_numpy() for x in fields]
            step = max(1, 100_000 // len(cuts))
            for at in range(0, len(rows), step):
                row = rows[at : at + step]
                pos, first, last, anchor, weight = (x[at : at + step] for x in every)
                o1, o2 = np.maximum(cuts, (pos - last)[:, None]), np.minimum(cuts + wide - 1, (pos - first)[:, None])
                place, cut = np.nonzero(o1 <= o2)
                o1, o2, r = o1[place, cut], o2[place, cut], cuts[cut]
                row, pos, first, last, anchor, weight = (x[place] for x in (row, pos, first, last, anchor, weight))
                data = [texts[k] for k in row.tolist()]
                c = _digests(data, pos - o2, pos - o1 + length, 16)
                # bytes that every string of this cut holds, however the text clips it
                core = np.zeros(len(row), np.int64) if width is None else _digests(data, pos - r, pos - r - width + 1 + length, 8)[:, 0]
                hi, lo = (batch.column(k).take(pa.array(row)) for k in range(2))
                made = (hi, lo, pos, first, last, pos - o2, o2 - o1 + 1, anchor, r, core, c[:, 0], c[:, 1], weight)
                yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x.astype(t.to_pandas_dtype())) for x, t in zip(made, _CONTEXT_TYPES, strict=True)], names=_CONTEXT_NAMES)

    return run


_CONTEXT_NAMES = ["key_hi", "key_lo", "pos", "first", "last", "start", "windows", "anchor", "cut", "core", "c_hi", "c_lo", "weight"]
_CONTEXT_TYPES = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
_CONTEXT = "key_hi long, key_lo long, pos int, first int, last int, start int, windows int, anchor long, cut int, core long, c_hi long, c_lo long, weight long"


def _merge_bucket(length: int):
    def run(part: pa.Table) -> pa.Table:
        part = part.sort_by([("anchor", "ascending"), ("cut", "ascending"), ("core", "ascending")])
        anchor, cut, core, hi, lo, start, n = (part[k].to_numpy() for k in ("anchor", "cut", "core", "key_hi", "key_lo", "start", "n"))
        data = part["data"].to_pylist()
        new = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (cut[1:] != cut[:-1]) | (core[1:] != core[:-1])))
        stops = np.append(new[1:], len(data))
        sizes = np.append(0, np.cumsum([len(x) for x in data], dtype=np.int64))
        out = [(np.zeros(0, np.int64),) * 3]
        at = 0
        while at < len(data):
            # whole groups, as many as one merge takes
            end = max(int(np.searchsorted(sizes[stops], sizes[at] + MERGE, side="right")), int(np.searchsorted(stops, at, side="right")) + 1)
            end = int(stops[end - 1])
            who, where = _repeated(data[at:end], length)
            who += at
            alone = n[who] == 1
            who, where = who[alone], where[alone]
            # runs of windows
            first = np.flatnonzero(np.append(True, (np.diff(who) != 0) | (np.diff(where) != 1))[: len(who)])
            out.append((who[first], where[first], np.diff(np.append(first, len(who)))))
            at = end
        who, first, windows = (np.concatenate(x) for x in zip(*out, strict=True))
        return pa.table({"key_hi": hi[who], "key_lo": lo[who], "start": (start[who] + first).astype(np.int32), "windows": windows.astype(np.int32)})

    return run


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key_hi, key_lo, data, at) to the bytes of each wanted context."""
    for batch in batches:
        texts = batch.column(2).to_pylist()
        rows, fields = _listed(batch.column(3))
        for at in range(0, len(rows), 20_000):
            part = [x.slice(at, 20_000) for x in fields]
            start, stop = (part[k].to_pylist() for k in (2, 3))
            data = pa.array([texts[k][a:b] for k, a, b in zip(rows[at : at + 20_000].tolist(), start, stop, strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([*part, data], names=["key_hi", "key_lo", "start", "stop", "anchor", "cut", "core", "n", "data"])


def repeated_ranges(texts: DataFrame, length: int = LENGTH, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """``texts``: key_hi, key_lo, data (one or more rows a key). Returns the texts of step 2 and (key, start, windows).

    Every returned window of ``length`` bytes occurs elsewhere, in another text or at another place of its own."""
    group = ["anchor", "cut", "core"]
    long_enough = texts.where(F.octet_length("data") >= length)
    # read twice, found once
    found = written(long_enough.mapInArrow(_emit_anchors(length, gram), "anchor long, key_hi long, key_lo long, pos int, first int, last int"), "suffix-anchored")
    place = F.xxhash64("key_hi", "key_lo", "pos")
    twice = written(found.groupBy("anchor").agg(F.min(place).alias("a"), F.max(place).alias("b")).where("a <> b").select("anchor"), "suffix-anchors")
    # the copies of a text go in a step of their own: a join that nothing is grouped behind can be split where it is hot
    held_places = written(found.join(twice, "anchor"), "suffix-found")
    # the anchors of a text are at most as many as its bytes
    key = ["key_hi", "key_lo"]
    per_text = held_places.groupBy(*key).agg(F.collect_set(F.struct("pos", "first", "last", "anchor", F.lit(1).cast("long").alias("weight"))).alias("at"))
    held = written(long_enough.join(per_text, key).groupBy(*key).agg(F.first("data").alias("data"), F.first("at").alias("at")), "suffix-texts")
    # each text meets its first places where it is written, so neither is dealt out again
    placed, held = held, held.drop("at")
    results: list[DataFrame] = []
    width: int | None = None
    for level in range(len(WIDTHS) + 1):
        contexts = written(placed.select(*key, "data", "at").mapInArrow(_emit_contexts(width, length, gram), _CONTEXT), "suffix-contexts")
        counts = contexts.groupBy(*group, "c_hi", "c_lo").agg(F.sum("weight").alias("n"), F.min(F.struct("key_hi", "key_lo", "pos", "first", "last", "start", "windows")).alias("rep"))
        counts = written(counts, "suffix-counts")
        # a context that occurs twice repeats in full, wherever it is
        full = counts.where("n > 1").select(*group, "c_hi", "c_lo")
        results.append(written(contexts.where("weight = 1").join(full, [*group, "c_hi", "c_lo"]).select("key_hi", "key_lo", "start", "windows"), "suffix-full"))
        single = counts.groupBy(*group).agg(F.count("*").alias("d"), F.min("n").alias("least")).where("d > 1 and least = 1").select(*group, "d")
        last = level == len(WIDTHS)
        todo = written(counts.join(single if last else single.where(F.col("d") <= HOT), group).select(*group, "n", "rep.*"), "suffix-todo")
        todo_rows = todo.count()
        if todo_rows:
            asked = F.struct("key_hi", "key_lo", "start", (F.col("start") + F.col("windows") - 1 + length).alias("stop"), *group, "n")
            wanted = todo.groupBy("key_hi", "key_lo").agg(F.collect_list(asked).alias("at"))
            cut = held.join(wanted, ["key_hi", "key_lo"]).select("key_hi", "key_lo", "data", "at").mapInArrow(_slices, "key_hi long, key_lo long, start int, stop int, anchor long, cut int, core long, n long, data binary")
            buckets = -(-todo_rows // BUCKET)
            merged = cut.withColumn("bucket", F.pmod(F.xxhash64(*group), F.lit(buckets))).groupBy("bucket").applyInArrow(_merge_bucket(length), "key_hi long, key_lo long, start int, windows int")
            results.append(written(merged, "suffix-merged"))
        if last:
            break
        hot = single.where(F.col("d") > HOT)
        places = written(counts.join(hot, group).select("rep.key_hi", "rep.key_lo", "rep.pos", "rep.first", "rep.last", "anchor", F.least("n", F.lit(2)).alias("weight")).groupBy("key_hi", "key_lo", "pos", "first", "last", "anchor").agg(F.max("weight").alias("weight")), "suffix-hot")
        if places.isEmpty():
            break
        placed = held.join(places.groupBy(*key).agg(F.collect_list(F.struct("pos", "first", "last", "anchor", "weight")).alias("at")), key)
        width = WIDTHS[level]
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    return held, out


def _cut(length: int):
    """(key_hi, key_lo, data, at: array<struct<start, windows>>) to what is left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, fields = _listed(batch.column(3))
            start, windows = (x.to_numpy().astype(np.int64) for x in fields)
            for at, n, data, bounds in _parts(batch.column(2)):
                own = slice(*np.searchsorted(rows, [at, at + n]))
                first = bounds[rows[own] - at] + start[own]
                edge = np.bincount(first, minlength=len(data) + 1) - np.bincount(first + windows[own] - 1 + length, minlength=len(data) + 1)
                gone = np.cumsum(edge[:-1]) > 0
                # a run begins where nothing before it in its text is gone
                begins = gone.copy()
                begins[1:] &= ~gone[:-1]
                begins[bounds[:-1]] = gone[bounds[:-1]]
                removed, spans = (np.diff(np.append(0, np.cumsum(x))[bounds]) for x in (gone, begins))
                kept = data[~gone].tobytes()
                ends = np.cumsum(np.diff(bounds) - removed).tolist()
                left = pa.array([kept[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, n), batch.column(1).slice(at, n), pa.array(removed), pa.array(spans), left], names=["key_hi", "key_lo", "n_removed", "n_spans", "kept"])

    return run


def _analysed(documents: DataFrame, length: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(row, key, data): the user's row packed, so that its names clash with none here; keys that occur twice; (key,
    n_removed, n_spans, kept) of texts that lose something."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"), *content_key(text), text.cast("binary").alias("data"))
    texts = rows.select("key_hi", "key_lo", "data")
    copies = written(texts.groupBy("key_hi", "key_lo").agg(F.count("*").alias("copies")).where("copies > 1"), "suffix-copies", keep=True)
    with scratch(documents.sparkSession):
        held, ranges = repeated_ranges(texts, length)
        per_text = ranges.groupBy("key_hi", "key_lo").agg(F.collect_list(F.struct("start", "windows")).alias("at"))
        left = held.join(per_text, ["key_hi", "key_lo"]).select("key_hi", "key_lo", "data", "at").mapInArrow(_cut(length), "key_hi long, key_lo long, n_removed long, n_spans long, kept binary")
        cut = written(left, "suffix-cut", keep=True)
    return rows, copies, cut


def digests(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    rows, copies, cut = _analysed(documents.select("doc_id", "text"), LENGTH)
    # texts themselves take no part in these joins
    docs = rows.select(F.col("row.doc_id").cast("long").alias("doc_id"), "key_hi", "key_lo", F.octet_length("data").cast("long").alias("n_bytes"), F.sha2("data", 256).alias("whole"))
    part = cut.select("key_hi", "key_lo", "n_removed", "n_spans", F.sha2("kept", 256).alias("part"))
    out = docs.join(copies, ["key_hi", "key_lo"], "left").join(part, ["key_hi", "key_lo"], "left")
    all_gone = F.col("copies").isNotNull() & (F.col("n_bytes") >= LENGTH)
    pick = lambda gone, name, none: F.when(all_gone, gone).otherwise(F.coalesce(name, none))
    return out.select("doc_id", "n_bytes", pick(F.col("n_bytes"), "n_removed", F.lit(0).cast("long")).alias("n_removed"), pick(F.lit(1).cast("long"), "n_spans", F.lit(0).cast("long")).alias("n_spans"), pick(F.sha2(F.lit(b""), 256), "part", F.col("whole")).alias("kept_sha256"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))


def cut_repeats(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """``documents`` with repeated bytes taken out of ``text`` (and ``n_chars`` counted anew); characters cut in two go."""
    rows, copies, cut = _analysed(documents, length)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x.decode("utf-8", "ignore") for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["key_hi", "key_lo", "kept"])

    left = cut.select("key_hi", "key_lo", "kept").mapInArrow(decode, "key_hi long, key_lo long, kept string")
    out = rows.join(copies, ["key_hi", "key_lo"], "left").join(left, ["key_hi", "key_lo"], "left")
    all_gone = F.col("copies").isNotNull() & (F.octet_length("data") >= length)
    text = F.when(all_gone, F.lit("")).otherwise(F.coalesce("kept", "row.text"))
    new = {"text": text}
    if "n_chars" in documents.columns:
        new["n_chars"] = F.coalesce(F.length(text), F.lit(0)).cast(documents.schema["n_chars"].dataType)
    return out.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in documents.columns])
