"""Exact Jaccard join on word shingles by T-occurrence search, and its connected components.

A document's set holds the hashes of its distinct k-word shingles. Equal sets collapse to one, so copies meet once. Two
sets of n and m shingles reach the similarity when they share at least T = ceil(sim * (n + m) / (1 + sim)) shingles.

1. Prefix index: under one global order a similar pair shares a shingle among the first n - ceil(sim * n) + 1 of each,
   and behind the first one that it shares each set still has T - 1 shingles (the place filter). The order is by hash,
   with shingles that a sample of texts shows to be frequent at the end: any order is exact, this one keeps common
   passages out of the prefixes and gives edited copies, whose own shingles come first, late places.
2. Pivots: in each inverted list the member with the earliest place, the one with the fewest shingles of its own, stands
   for the rest; members linked to it need no further pair among themselves, so a group of thousands of near copies
   costs one search of a pivot and not its square.
3. The rest: members of a list outside its pivot's component meet those of other components if sizes and places allow
   T. No pair that can be linked is left out, which makes the components exact.
4. Bitmaps: a set's parity bitmap has about two to four bits a shingle. Two sets differ in at least as many shingles as
   their bitmaps in bits, which drops most candidates below the similarity before whole sets are fetched; it is exact.
5. Search: a query set meets an inverted index of the whole sets of its candidates. ``divide_skip`` heap-merges the short
   lists, probes the long ones by bisection, and keeps the members that reach T; only those links leave the task.

Candidates of a query are cut into chunks that go to different tasks. Components are found by contracting links, in
DataFrames. Shingles are compared by 64-bit hashes.

Defined results: a null text is empty; an empty document is linked with nothing; fewer words than k make one shingle;
rows repeated in full are linked like any equal texts; a null doc_id never names a component while another id is in it;
an empty table gives an empty result. Extra columns are ignored, and kept by ``one_of_each``, also when their names clash
with those here.
"""

from __future__ import annotations

import hashlib
import heapq
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plumbline.llm.common import content_key, scratch, table, written
from plumbline.llm.shingling import shingle_sets

WORDS = 5
#: The similarity as a fraction, so that all bounds are exact integers.
SIM = (4, 5)
#: One text in SAMPLE is read for the order of shingles; those found in at least OFTEN of them go last, at most MOST.
SAMPLE, OFTEN, MOST = 16, 6, 100_000
#: Candidates of a query that meet in one task, and the shingles they may have together.
CHUNK, CHUNK_SHINGLES = 256, 1 << 21
NO_ID = (1 << 63) - 1


def needed(n: int, m: int, sim: tuple[int, int] = SIM) -> int:
    """Least overlap of sets of n and m that are similar."""
    return -(-sim[0] * (n + m) // (sim[0] + sim[1]))


def prefix_length(n: int, sim: tuple[int, int] = SIM) -> int:
    return n + sim[0] * n // -sim[1] + 1


def heap_merge(lists: list[list[int]]) -> Iterator[tuple[int, int]]:
    """(id, number of lists that hold it) in order of id, from sorted lists."""
    heap = [(own[0], i, 0) for i, own in enumerate(lists) if own]
    heapq.heapify(heap)
    while heap:
        value, count = heap[0][0], 0
        while heap and heap[0][0] == value:
            _, i, at = heap[0]
            count += 1
            if at + 1 < len(lists[i]):
                heapq.heapreplace(heap, (lists[i][at + 1], i, at + 1))
            else:
                heapq.heappop(heap)
        yield value, count


def divide_skip(lists: list[list[int]], least: int, need: list[int]) -> dict[int, int]:
    """Ids in at least ``need[id]`` of the sorted inverted lists, with their counts. ``least`` is the smallest need.

    The longest lists, fewer than ``least``, are only probed: an id in none of the others cannot reach it.
    """
    lists = sorted((x for x in lists if x), key=len)
    if not lists or len(lists) < least:
        return {}
    longest = len(lists[-1])
    n_long = max(0, min(least - 1, int(least / (0.0085 * max(1, longest).bit_length() + 1))))
    short, long = lists[: len(lists) - n_long], lists[len(lists) - n_long :][::-1]
    out = {}
    for value, count in heap_merge(short):
        want, left = need[value], len(long)
        if count + left < want:
            continue
        for own in long:
            at = bisect_left(own, value)
            left -= 1
            if at < len(own) and own[at] == value:
                count += 1
            elif count + left < want:
                break
        if count >= want:
            out[value] = count
    return out


class InvertedIndex:
    """Shingle -> sorted places of the sets that hold it."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = [len(s) for s in sets]
        shingle = np.concatenate(sets)
        # stable: places ascend within a shingle
        order = np.argsort(shingle, kind="stable")
        place = np.repeat(np.arange(len(sets)), self.sizes)[order]
        shingle = shingle[order]
        cuts = np.flatnonzero(np.append(True, shingle[1:] != shingle[:-1]))
        self.shingles, self.starts, self.places = shingle[cuts], np.append(cuts, len(shingle)), place

    def search(self, query: np.ndarray, sim: tuple[int, int] = SIM) -> dict[int, int]:
        """Places of the sets similar to ``query``, with the overlap."""
        at = np.searchsorted(self.shingles, query)
        at = at[(at < len(self.shingles)) & (self.shingles[np.minimum(at, len(self.shingles) - 1)] == query)]
        lists = [self.places[self.starts[i] : self.starts[i + 1]].tolist() for i in at.tolist()]
        need = [needed(len(query), m, sim) for m in self.sizes]
        return divide_skip(lists, max(1, min(need)), need)


def components(links: DataFrame) -> DataFrame:
    """(ref, comp) of every node of ``links`` (a, b): comp is the smallest ref that links lead to.

    Each round hooks a root to its smallest neighbour, flattens, and contracts the links; roots at least halve.
    """
    labels = written(links.select(F.col("a").alias("ref")).union(links.select("b")).distinct().withColumn("comp", F.col("ref")), "cc")
    edges = links.select("a", "b")
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = written(both.groupBy("a").agg(F.min("b").alias("up")).where("up < a"), "cc-parents")
        if parent.isEmpty():
            return labels
        while True:
            above = parent.select(F.col("a").alias("up"), F.col("up").alias("top"))
            parent = written(parent.join(above, "up", "left").select("a", F.coalesce("top", "up").alias("up"), F.col("top").isNotNull().alias("moved")), "cc-parents")
            if parent.where("moved").isEmpty():
                break
            parent = parent.select("a", "up")
        hop = lambda df, c: df.join(parent.select(F.col("a").alias(c), F.col("up").alias("_up")), c, "left").withColumn(c, F.coalesce("_up", c)).drop("_up")
        labels = written(hop(labels, "comp").select("ref", "comp"), "cc")
        edges = written(hop(hop(edges, "a"), "b").where("a <> b").select("a", "b").distinct(), "cc-edges")


def _rows(documents: DataFrame) -> DataFrame:
    """holder (the id, NO_ID for null), key_hi, key_lo (of the text), text: a row is known by the first three."""
    text = F.col("text").cast("string")
    return documents.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("holder"), *content_key(F.coalesce(text, F.lit(""))), text.alias("text"))


def _among(values: np.ndarray, wanted: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Which of ``values`` are in the sorted ``wanted``; ``marks`` tells most of the others by their low 20 bits."""
    out = marks[values & np.uint64(0xFFFFF)]
    some = np.flatnonzero(out)
    if len(some):
        at = np.searchsorted(wanted, values[some])
        out[some] = wanted[np.minimum(at, len(wanted) - 1)] == values[some]
    return out


def parity_bits(own: np.ndarray) -> bytes:
    """Bit i tells whether an odd number of shingles end in i; two bits a shingle or more, a power of two."""
    size = 1 << max(6, (2 * len(own) - 1).bit_length())
    return np.packbits(np.bincount((own & np.uint64(size - 1)).view(np.int64), minlength=size) & 1).tobytes()


def differing_bits(x: bytes, y: bytes) -> int:
    """Bits in which two parity bitmaps differ, the longer one folded; the sets differ in that many shingles at least."""
    p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    if len(p) < len(q):
        p, q = q, p
    while len(p) > len(q):
        p = p[: len(p) // 2] ^ p[len(p) // 2 :]
    return int(np.bitwise_count(p ^ q).sum())


def _sets(rows: DataFrame, frequent: list[int], sim: tuple[int, int], k: int) -> DataFrame:
    """Of each row its n shingles, the digest and the bitmap of its set, and the prefix in the global order; ``n_rare``: how
    many shingles come before the frequent ones."""
    last = np.array(sorted(frequent), np.uint64)
    marks = np.zeros(1 << 20, bool)
    marks[last & np.uint64(0xFFFFF)] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, sets in shingle_sets(batch.column(3), k):
                n, rare, hi, lo, bits, prefixes = [], [], [], [], [], []
                for own in sets:
                    digest = hashlib.blake2b(own, digest_size=16).digest()
                    n.append(len(own))
                    hi.append(int.from_bytes(digest[:8], "big", signed=True))
                    lo.append(int.from_bytes(digest[8:], "big", signed=True))
                    bits.append(parity_bits(own))
                    p = prefix_length(len(own), sim) if len(own) else 0
                    late = _among(own, last, marks)
                    early = own[~late]
                    rare.append(len(early))
                    prefixes.append((early if len(early) >= p else np.concatenate([early, own[late]]))[:p])
                offsets = np.concatenate([[0], np.cumsum([len(p) for p in prefixes])]).astype(np.int32)
                prefix = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(prefixes).view(np.int64)))
                part = batch.slice(row, len(sets))
                arrays = [*(part.column(i) for i in range(3)), *(pa.array(x, t) for x, t in ((n, pa.int32()), (rare, pa.int32()), (hi, pa.int64()), (lo, pa.int64()), (bits, pa.binary()))), prefix]
                yield pa.RecordBatch.from_arrays(arrays, names=["holder", "key_hi", "key_lo", "n", "n_rare", "set_hi", "set_lo", "bits", "prefix"])

    return rows.mapInArrow(run, "holder long, key_hi long, key_lo long, n int, n_rare int, set_hi long, set_lo long, bits binary, prefix array<long>")


def frequent_shingles(rows: DataFrame, k: int) -> list[int]:
    """Shingles that many different texts hold, by a sample of the texts; at most MOST, the most frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, sets in shingle_sets(batch.column(0), k):
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets).view(np.int64))], names=["token"])

    sample = rows.where(F.pmod("key_lo", F.lit(SAMPLE)) == 0).groupBy("key_hi", "key_lo").agg(F.first("text").alias("text")).select("text")
    counts = sample.mapInArrow(run, "token long").groupBy("token").count().where(F.col("count") >= OFTEN)
    return [r.token % (1 << 64) for r in counts.orderBy(F.desc("count"), "token").limit(MOST).collect()]


def _possible(n: Column, q: Column, m: Column, r: Column, sim: tuple[int, int]) -> Column:
    """Whether sets of n and m whose first shared shingle has the places q and r can share T."""
    a, b = (F.lit(x).cast("long") for x in sim)
    size = b * F.least(n, m) >= a * F.greatest(n, m)
    return size & ((a + b) * F.least(n - q, m - r) >= a * (n + m))


def _near(pairs: DataFrame, unique: DataFrame, sim: tuple[int, int]) -> DataFrame:
    """The rows of ``pairs`` (a, b) whose bitmaps leave the similarity possible, with nb."""
    side = lambda c: unique.select(F.col("ref").alias(c), F.col("n").alias("n" + c), F.col("bits").alias("bits_" + c))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m, x, y = (batch.column(c).to_pylist() for c in ("na", "nb", "bits_a", "bits_b"))
            keep = [differing_bits(x[i], y[i]) <= n[i] + m[i] - 2 * needed(n[i], m[i], sim) for i in range(batch.num_rows)]
            yield batch.select(["a", "b", "nb"]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b").mapInArrow(run, "a long, b long, nb int")


def _verify(pairs: DataFrame, sets: DataFrame, sim: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) that are similar. ``pairs``: a, b, nb; ``sets``: ref, raw. A query's candidates come in chunks."""
    many = pairs.groupBy("a").agg(F.ceil(F.greatest(F.count("*") / CHUNK, F.sum("nb") / CHUNK_SHINGLES)).alias("chunks"))
    cut = pairs.join(many, "a").select("a", F.pmod(F.xxhash64("b"), "chunks").cast("int").alias("chunk"), "b")
    member = cut.join(sets.select(F.col("ref").alias("b"), "raw"), "b").select("a", "chunk", "b", "raw")
    query = cut.select("a", "chunk").distinct().join(sets.select(F.col("ref").alias("a"), "raw"), "a").select("a", "chunk", F.lit(None).cast("long").alias("b"), "raw")

    def run(part: pa.Table) -> pa.Table:
        b, raw = part["b"].to_pylist(), part["raw"].to_pylist()
        at = b.index(None)
        own = [i for i in range(len(b)) if i != at]
        found = InvertedIndex([np.frombuffer(raw[i], np.uint64) for i in own]).search(np.frombuffer(raw[at], np.uint64), sim) if own else {}
        hit = [b[own[i]] for i in found]
        return pa.table({"a": pa.array([part["a"][0].as_py()] * len(hit), pa.int64()), "b": pa.array(hit, pa.int64())})

    return member.unionByName(query).groupBy("a", "chunk").applyInArrow(run, "a long, b long")


def join_components(documents: DataFrame, sim: tuple[int, int] = SIM, k: int = WORDS) -> DataFrame:
    """doc_id, n_shingles, component_id and n_links (verified links of its set; copies not counted) for every row."""
    with scratch(documents.sparkSession):
        found = _grouped(_rows(documents), sim, k)
        doc_id = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
        out = found.select(doc_id("holder").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), doc_id("rep_holder").alias("component_id"), "n_links")
        return written(out, "jaccard-result", keep=True)


def _grouped(rows: DataFrame, sim: tuple[int, int] = SIM, k: int = WORDS) -> DataFrame:
    """holder, key_hi, key_lo, n, rep_holder, rep_hi, rep_lo (the least row of its component) and n_links of every row."""
    spark = rows.sparkSession
    docs = written(_sets(rows, frequent_shingles(rows, k), sim, k), "jaccard-docs")
    row = F.struct("holder", "key_hi", "key_lo")
    unique = docs.where("n > 0").groupBy("set_hi", "set_lo").agg(F.first("n").alias("n"), F.first("n_rare").alias("n_rare"), F.first("bits").alias("bits"), F.first("prefix").alias("prefix"), F.min(row).alias("least"))
    unique = written(unique.withColumn("ref", F.monotonically_increasing_id()), "jaccard-sets")
    postings = unique.select("ref", "n", "n_rare", F.posexplode("prefix").alias("q", "token"))
    # a list that one set alone is in cannot give a candidate; the frequent ones, which alone may be very long, need no count
    counted = postings.where("q < n_rare").withColumn("many", F.count(F.lit(1)).over(Window.partitionBy("token")))
    columns = ["token", "ref", "n", "q"]
    lists = written(counted.where("many > 1").select(columns).unionByName(postings.where("q >= n_rare").select(columns)), "jaccard-lists")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, sets in shingle_sets(batch.column(1), k):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(sets)), pa.array([s.tobytes() for s in sets], pa.binary())], names=["ref", "raw"])

    def similar(pairs: DataFrame) -> DataFrame:
        """The links among candidate pairs, by whole sets made again from the texts of their members alone."""
        with scratch(spark):
            pairs = written(_near(pairs, unique, sim), "jaccard-near")
            refs = pairs.select(F.col("a").alias("ref")).union(pairs.select("b")).distinct()
            members = refs.join(unique.select("ref", "least.*"), "ref")
            texts = rows.join(members, ["holder", "key_hi", "key_lo"]).groupBy("ref").agg(F.first("text").alias("text"))
            return written(_verify(pairs, written(texts.mapInArrow(whole, "ref long, raw binary"), "jaccard-members"), sim), "jaccard-links", keep=True)

    def pairs_of(met: DataFrame) -> DataFrame:
        """Each pair of ``met`` once, whichever way round."""
        return met.select(F.least("x", "y").alias("lo"), F.greatest("x", "y").alias("hi"), "x", "y").dropDuplicates(["lo", "hi"]).withColumnsRenamed({"x": "a", "y": "b"})

    side = lambda *names: F.struct(*[F.col(c) for c in names])
    earliest = F.struct((F.col("q") / F.col("n")).alias("at"), F.col("n"), F.col("ref"))
    # a pivot for each list
    pivots = lists.groupBy("token").agg(F.min_by(side("ref", "n", "q"), earliest).alias("p"))
    met = lists.join(pivots, "token").where((F.col("p.ref") != F.col("ref")) & _possible(F.col("n"), F.col("q"), F.col("p.n"), F.col("p.q"), sim))
    tried = written(pairs_of(met.select(F.col("p.ref").alias("x"), F.col("ref").alias("y"))), "jaccard-pairs")
    links = similar(tried)
    comps = components(links)
    # what is left: members outside the component of their list's pivot
    current = lists.join(comps, "ref", "left").withColumn("comp", F.coalesce("comp", "ref"))
    current = written(current, "jaccard-current")
    apart = current.groupBy("token").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.min_by("comp", earliest).alias("main")).where("c0 <> c1").select("token", "main")
    open_lists = current.join(apart, "token")
    left = open_lists.where("comp <> main").select("token", F.col("ref").alias("x"), F.col("n").alias("nx"), F.col("q").alias("qx"), F.col("comp").alias("cx"))
    right = open_lists.select("token", F.col("ref").alias("y"), F.col("n").alias("ny"), F.col("q").alias("qy"), F.col("comp").alias("cy"), (F.col("comp") == F.col("main")).alias("in_main"))
    met = left.join(right, "token").where((F.col("cx") != F.col("cy")) & (F.col("in_main") | (F.col("x") < F.col("y"))) & _possible(F.col("nx"), F.col("qx"), F.col("ny"), F.col("qy"), sim))
    # a pair that was searched before has its answer
    pairs = written(pairs_of(met).join(tried.select("lo", "hi"), ["lo", "hi"], "left_anti"), "jaccard-pairs")
    if not pairs.isEmpty():
        found = similar(pairs)
        if not found.isEmpty():
            links = links.union(found)
            comps = components(links)
    ends = links.select(F.col("a").alias("ref")).union(links.select("b")).groupBy("ref").agg(F.count("*").alias("n_links"))
    placed = unique.select("ref", "set_hi", "set_lo", "least").join(comps, "ref", "left").join(ends, "ref", "left").withColumn("comp", F.coalesce("comp", "ref"))
    least = placed.groupBy("comp").agg(F.min("least").alias("rep"))
    named = placed.join(least, "comp").select("set_hi", "set_lo", "rep", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    out = docs.select("holder", "key_hi", "key_lo", "n", "set_hi", "set_lo").join(named, ["set_hi", "set_lo"], "left")
    rep = F.coalesce("rep", row)
    return out.select("holder", "key_hi", "key_lo", "n", rep["holder"].alias("rep_holder"), rep["key_hi"].alias("rep_hi"), rep["key_lo"].alias("rep_lo"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def op10_shingle_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def one_of_each(documents: DataFrame) -> DataFrame:
    """One row of ``documents`` of each component, all columns: that of the smallest doc_id, then text hash. Rows without
    words all stay; of rows that repeat id and text one stays."""
    with scratch(documents.sparkSession):
        found = _grouped(_rows(documents))
        kept = written(found.where((F.col("holder") == F.col("rep_holder")) & (F.col("key_hi") == F.col("rep_hi")) & (F.col("key_lo") == F.col("rep_lo"))).groupBy("holder", "key_hi", "key_lo").agg((F.first("n") > 0).alias("full"), F.count("*").alias("rows")), "jaccard-kept", keep=True)
    text = F.col("text").cast("string")
    me = [F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("holder"), *content_key(F.coalesce(text, F.lit("")))]
    # the row is packed, so that its own names clash with none here
    mine = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"), *me)
    met = mine.join(kept, ["holder", "key_hi", "key_lo"])
    if kept.where("full and rows > 1").isEmpty():
        return met.select("row.*")
    twice = F.col("full") & (F.col("rows") > 1)
    repeated = met.where(twice).groupBy("holder", "key_hi", "key_lo").agg(F.first("row").alias("row"))
    return met.where(~twice).select("row.*").union(repeated.select("row.*"))


SQL = r"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), s AS (
  SELECT DISTINCT rid, doc_id, md5(array_to_string(ws[i:i + 4], ' ')) AS h
  FROM (SELECT rid, doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)
), n AS (
  SELECT rid, doc_id, count(*) AS n FROM s GROUP BY 1, 2
), l AS (
  SELECT a.rid AS x, b.rid AS y FROM s a JOIN s b ON a.h = b.h AND a.rid <> b.rid
  JOIN n p ON p.rid = a.rid JOIN n q ON q.rid = b.rid
  GROUP BY a.rid, b.rid, p.n, q.n HAVING 100 * count(*) >= 80 * (p.n + q.n - count(*))
), r(x, y) AS (
  SELECT rid, rid FROM w UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x
), c AS (
  SELECT r.x AS rid, min(w.doc_id) AS component_id FROM r JOIN w ON w.rid = r.y GROUP BY 1
)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id FROM w JOIN c USING (rid) LEFT JOIN n USING (rid)
"""
