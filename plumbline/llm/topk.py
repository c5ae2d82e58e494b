"""Exact top-k inner products over an impact-ordered, score-at-a-time index.

A vector's components become integers; each non-zero one is a posting whose quantised impact is the bit length of its
magnitude. A block of vectors keeps its postings by impact level, the highest first. A block of queries is scored a
level at a time: all segments of the level add to the accumulators. After a level the unread postings of a vector can
still add at most ``|q| * |rest|`` (Cauchy-Schwarz, with the exact norm of its unread part), so every score lies in a
known interval. A query stops once the proof leaves few possible members - vectors whose upper bound reaches the k-th
best lower bound - and only those are scored exactly; without a proof all levels are read and the scores are exact.

Blocks hold ``BLOCK`` vectors. A segment holds the postings of one level (vector, component, value), and a level is added
over the vectors and components that it holds, no others. Every query first meets one block; the k-th score it finds
there is a floor for all blocks, so most of them are given up after their first levels. Then GROUP blocks of queries at
once meet RUN blocks of rows, one after another; the best k rows so far raise the floor and go on to the next block. The
work is the stated queries times the rows, no task or driver holds more than RUN blocks of rows and GROUP blocks of queries,
and each task gives k rows at most for a query.

Defined results: vectors that are null or hold null or non-finite components take no part, nor do those whose id is
null; shorter vectors count as filled with zeros; rows with the query's own id are no candidates; repeated rows are
candidates each, ties to the smaller id; an empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.llm.common import scratch, table, written

BLOCK = 4096
QUERY_BLOCK = 1024
#: Blocks of queries that a block of rows meets in one task.
GROUP = 16
#: Blocks of rows that a task takes one after another, carrying the best rows of each query along.
RUN = 16
#: A query stops reading levels when at most this many times k rows can still be in its result.
FEW = 4


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def pack(ids: np.ndarray, vectors: list[np.ndarray]) -> tuple[bytes, bytes, int]:
    d = max(map(len, vectors), default=0)
    out = np.zeros((len(vectors), d), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    small = np.int16 if not out.size or np.abs(out).max() < 2**15 else np.int64
    return ids.astype(np.int64).tobytes(), bytes([16 if small is np.int16 else 64]) + out.astype(small).tobytes(), d


def unpack(ids: bytes, raw: bytes, d: int) -> tuple[np.ndarray, np.ndarray]:
    own = np.frombuffer(ids, np.int64)
    kind = np.int16 if raw[0] == 16 else np.int64
    return own, np.frombuffer(raw, kind, offset=1).astype(np.int64).reshape(len(own), d)


class Segments:
    """Postings of a block by quantised impact, highest first, with the norms of what is unread after each level."""

    def __init__(self, x: np.ndarray):
        self.x = x
        impact = np.frexp(np.abs(x).astype(np.float64))[1]
        #: Of each level: its vectors, its components, their values (a posting each; 0 where there is none), norms of the rest.
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        rest = (x.astype(np.float64) ** 2).sum(1)
        # impacts below the third bit are one last segment: they are many and add little
        for level in sorted(set(np.unique(impact[impact > 2]).tolist()) | {2}, reverse=True):
            vector, component = np.nonzero((impact == level) if level > 2 else (impact <= 2) & (impact > 0))
            value = x[vector, component]
            rest = rest - np.bincount(vector, value.astype(np.float64) ** 2, len(x))
            own, row = np.unique(vector, return_inverse=True)
            dims, column = np.unique(component, return_inverse=True)
            held = np.zeros((len(own), len(dims)), x.dtype)
            held[row, column] = value
            self.levels.append((own, dims, held, np.sqrt(np.maximum(rest, 0.0)) * (1 + 1e-9)))


def block_topk(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, segments: Segments, k: int, few: int = FEW, floor: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, id, score) of the k best rows of the block for each query; with ``floor``, of those that reach it."""
    x = segments.x
    d = max(q.shape[1], x.shape[1])
    # float32 holds every partial sum exactly below 2**24, float64 below 2**53; beyond that integers
    top = (float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0))) * max(d, 1)
    kind = np.float32 if top < 2**23 else np.float64 if top < 2**52 else np.int64
    if q.shape[1] != x.shape[1]:
        q = np.pad(q, ((0, 0), (0, d - q.shape[1])))
        x = np.pad(x, ((0, 0), (0, d - x.shape[1])))
    qk = q.astype(kind)
    norm = np.sqrt((q.astype(np.float64) ** 2).sum(1))
    live = np.arange(len(q))
    acc = np.zeros((len(q), len(x)), kind)
    own = q_ids[:, None] == ids[None, :]
    has_own = own.any(1)
    out_q, out_id, out_s = [], [], []

    def close(rows: np.ndarray, member: np.ndarray) -> None:
        """Exact scores of the possible members of each finished query, k best of them."""
        for r, m in zip(rows, member, strict=True):
            at = np.flatnonzero(m)
            if len(at):
                s = x[at] @ q[r]
                best = np.lexsort((ids[at], -s))[:k]
                out_q.append(np.full(len(best), r))
                out_id.append(ids[at][best])
                out_s.append(s[best])

    for n, (vectors, dims, held, rest) in enumerate(segments.levels):
        if len(vectors):
            part = qk[np.ix_(live, dims)] @ held.astype(kind).T
            if len(vectors) == acc.shape[1]:
                acc += part
            else:
                acc[:, vectors] += part
        last = n == len(segments.levels) - 1
        # a hair wider than the bound, so that its rounding cannot turn a member away
        slack = None if last else (norm[live, None] * rest[None, :] * (1 + 1e-6) + 1e-3).astype(np.float32)
        low = acc if last else acc - slack
        if has_own[live].any():
            low = np.where(own[live], np.array(-np.inf, np.float64) if kind is not np.int64 else np.iinfo(np.int64).min, low)
        if len(ids) > k:
            kth = np.partition(low, len(ids) - k, axis=1)[:, len(ids) - k]
        else:
            kth = np.full(len(live), -np.inf)
        if floor is not None:
            kth = np.maximum(kth, floor[live])
        member = ((acc if last else acc + slack) >= kth[:, None]) & ~own[live]
        done = np.ones(len(live), bool) if last else member.sum(1) <= few * k
        if done.any():
            close(live[done], member[done])
            live, acc = live[~done], acc[~done]
        if not len(live):
            break
    if not out_q:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    return np.concatenate(out_q), np.concatenate(out_id), np.concatenate(out_s).astype(np.int64)


def packed(rows: DataFrame, block: Column) -> DataFrame:
    """Rows (id, v) of each block as one row of bytes."""

    def run(part: pa.Table) -> pa.Table:
        order = np.argsort(ids := part["id"].to_numpy(), kind="stable")
        vectors = part["v"].to_pylist()
        own, raw, d = pack(ids[order], [np.array(vectors[i], np.int64) for i in order])
        return pa.table({"block": part["block"][:1], "ids": pa.array([own], pa.binary()), "raw": pa.array([raw], pa.binary()), "d": pa.array([d], pa.int32())})

    return rows.withColumn("block", block).groupBy("block").applyInArrow(run, "block long, ids binary, raw binary, d int")


def topk(candidates: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``candidates`` and ``queries``: id long, v array<long>. Returns query_id, rank, id, score."""
    with scratch(candidates.sparkSession):
        return written(_topk(candidates, queries, k), "topk", keep=True)


def _topk(candidates: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    candidates, queries = written(candidates, "topk-rows"), written(queries, "topk-queries")
    n, m = candidates.count(), queries.count()
    blocks, q_blocks = max(1, -(-n // BLOCK)), max(1, -(-m // QUERY_BLOCK))
    # by the place of a row in the written table, so rows repeated in full spread as well
    spread = F.xxhash64(F.monotonically_increasing_id())
    left = packed(candidates, F.pmod(spread, F.lit(blocks)))
    right = packed(queries, F.pmod(spread, F.lit(q_blocks))).select(F.col("block").alias("q_block"), F.col("ids").alias("q_ids"), F.col("raw").alias("q_raw"), F.col("d").alias("q_d"))
    left, right = written(left, "topk-blocks"), written(right, "topk-query-blocks")
    meet = lambda rows, asked, skip: rows.groupBy("run", "group").cogroup(asked.groupBy("run", "group")).applyInArrow(_meeting(k, skip), "query_id long, query_row long, id long, score long")
    # a block for each block of queries, whose k-th scores are the floors everywhere else
    first = right.withColumn("run", F.pmod("q_block", F.lit(blocks)).cast("long")).withColumn("group", F.col("q_block")).withColumn("floors", F.lit(None).cast("binary"))
    own = F.when(F.col("block") < q_blocks, F.sequence(F.col("block"), F.lit(q_blocks - 1).cast("long"), F.lit(blocks).cast("long")))
    found = written(meet(left.withColumn("run", F.col("block")).withColumn("group", F.explode(own)), first, None), "topk-first")
    kth = found.groupBy("query_row").agg(F.count("*").alias("n"), F.min("score").alias("s")).where(F.col("n") >= k).select((F.shiftright("query_row", 32)).alias("q_block"), F.struct(F.col("query_row").bitwiseAND((1 << 32) - 1).alias("row"), "s").alias("f"))
    floors = kth.groupBy("q_block").agg(F.collect_list("f").alias("f"))

    def as_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = []
            for ids, own in zip(batch.column(1).to_pylist(), batch.column(4).to_pylist(), strict=True):
                least = np.full(len(ids) // 8, -np.inf)
                for f in own or ():
                    least[f["row"]] = np.nextafter(float(f["s"]), -np.inf)
                raw.append(least.tobytes())
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(4)), pa.array(raw, pa.binary())], names=["q_block", "q_ids", "q_raw", "q_d", "floors"])

    # at most QUERY_BLOCK floors come together
    bounded = right.join(floors, "q_block", "left").mapInArrow(as_bytes, "q_block long, q_ids binary, q_raw binary, q_d int, floors binary")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    # a task takes RUN blocks of rows one after another, so a query has k rows for each run, not for each block
    asked = bounded.withColumn("group", F.floor(F.col("q_block") / GROUP)).withColumn("run", every(-(-blocks // RUN)))
    rest = meet(left.withColumn("run", F.floor(F.col("block") / RUN)).withColumn("group", every(-(-q_blocks // GROUP))), asked, blocks)
    w = Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "id")
    return found.unionByName(rest).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def _best(held: tuple[np.ndarray, np.ndarray, np.ndarray], k: int, queries: int) -> tuple[tuple[np.ndarray, np.ndarray, np.ndarray], np.ndarray]:
    """Of (query row, id, score) the k best of each query, and just under the k-th score of those that have k."""
    row, ids, score = held
    order = np.lexsort((ids, -score, row))
    row, ids, score = row[order], ids[order], score[order]
    begins = np.searchsorted(row, np.arange(queries + 1))
    place = np.arange(len(row)) - begins[row]
    floor = np.full(queries, -np.inf)
    kth = place == k - 1
    floor[row[kth]] = np.nextafter(score[kth].astype(np.float64), -np.inf)
    return (row[place < k], ids[place < k], score[place < k]), floor


def _meeting(k: int, skip: int | None):
    """A run of row blocks with blocks of queries to the best k rows of the run for each query.

    What a query has so far bounds what the next block may add. A block of queries does not meet the block of its own number
    modulo ``skip``, which it has met before."""

    def run(rows: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[], [], [], []]
        queries = [(a["q_block"], *unpack(a["q_ids"], a["q_raw"], a["q_d"]), a["floors"]) for a in asked.select(["q_block", "q_ids", "q_raw", "q_d", "floors"]).to_pylist()]
        floors = [np.frombuffer(f, np.float64) if f else np.full(len(ids), -np.inf) for _, ids, _, f in queries]
        held = [(np.zeros(0, np.int64),) * 3 for _ in queries]
        for at in range(rows.num_rows if queries else 0):
            r = rows.slice(at, 1).to_pylist()[0]
            ids, x = unpack(r["ids"], r["raw"], r["d"])
            segments = Segments(x)
            for n, (block, q_ids, q, _) in enumerate(queries):
                if skip is not None and block % skip == r["block"]:
                    continue
                found = block_topk(q_ids, q, ids, segments, k, floor=floors[n])
                held[n], floor = _best(tuple(np.concatenate(x) for x in zip(held[n], found, strict=True)), k, len(q_ids))
                floors[n] = np.maximum(floors[n], floor)
        for (block, q_ids, _, _), (row, ids, score) in zip(queries, held, strict=True):
            for part, one in zip(out, (q_ids[row], row + (block << 32), ids, score), strict=True):
                part.append(one)
        return pa.table({c: pa.array(np.concatenate(v) if v else np.zeros(0, np.int64), pa.int64()) for c, v in zip(("query_id", "query_row", "id", "score"), out, strict=True)})

    return run


def op4_impact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("e")).where(F.col("id").isNotNull() & usable(F.col("e")))
    rows = rows.select("id", F.transform("e", lambda x: F.floor(x * 64)).alias("v"))
    found = topk(rows, rows.where(F.col("id") % 20 == 0), 20)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 20
"""
