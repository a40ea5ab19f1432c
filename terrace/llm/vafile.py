"""Exact top-k search by vector-approximation files.

Each shard of vectors has an approximation file: every component is replaced by the number of its cell, 64 cells per
dimension with the shard's own quantiles as marks. A scan of the cells alone bounds every score from both sides; only vectors
whose upper bound reaches the k-th best lower bound of all shards stay, and their exact vectors are read from the highest upper
bound down until the k-th result is certain. The scan ships approximations and queries; exact vectors meet only candidates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.common import integer_vectors, stage

BITS = 6
SHARD = 65_536  # vectors per approximation file at most, as dealt by hash
BLOCK = 4_096  # queries that meet a file at once
LEAST = 4_096  # vectors and, an eighth, queries that are worth a task of their own
SCAN = 1 << 22  # bounds held at once
READ = 8  # exact vectors read first, times k
EXACT = float(1 << 53)  # integers below are exact doubles


def approximate(points: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cell numbers (n x d), and the least and greatest value in each cell (d x cells); cells without a member hold zeros."""
    n, dims = points.shape
    cells = 1 << bits
    codes, low, high = np.zeros((n, dims), np.uint8), np.zeros((dims, cells)), np.zeros((dims, cells))
    for d in range(dims):
        column = np.sort(points[:, d])
        marks = column[np.arange(1, cells) * n // cells]
        codes[:, d] = np.searchsorted(marks, points[:, d], side="right")
        starts = np.concatenate([[0], np.searchsorted(column, marks), [n]])
        full = np.flatnonzero(starts[:-1] < starts[1:])
        low[d, full], high[d, full] = column[starts[full]], column[starts[full + 1] - 1]
    return codes, low, high


def packed(codes: np.ndarray, bits: int = BITS) -> bytes:
    """Cell numbers at ``bits`` bits each."""
    return np.packbits(codes.reshape(-1, 1) >> np.arange(bits - 1, -1, -1) & 1).tobytes()


def unpacked(raw: bytes, n: int, dims: int, bits: int = BITS) -> np.ndarray:
    spread = np.unpackbits(np.frombuffer(raw, np.uint8), count=n * dims * bits).reshape(-1, bits)
    return (spread << np.arange(bits - 1, -1, -1)).sum(axis=1).reshape(n, dims)


def bounds(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the inner products of queries and cells (rows of least and greatest values).

    Beyond exact doubles they are widened by more than rounding can move them.
    """
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    lower, upper = up @ low.T + down @ high.T, up @ high.T + down @ low.T
    reach = np.abs(queries).sum(axis=1) * np.maximum(np.abs(low).max(initial=0), np.abs(high).max(initial=0))
    slack = np.where(reach < EXACT, 0.0, reach * 1e-11)[:, None]
    return lower - slack, upper + slack


def products(a: pa.ListArray, b: pa.ListArray) -> list[int]:
    """Integer inner products of the rows of two list columns, exactly; beyond the range of long its nearest end."""
    x, y = np.asarray(a.flatten()), np.asarray(b.flatten())
    ends = np.concatenate([[0], np.cumsum(np.asarray(a.value_lengths(), dtype=np.int64))])
    most = float(np.abs(x.astype(float)).max(initial=0)) * float(np.abs(y.astype(float)).max(initial=0)) * max(len(x), 1)
    if most >= 2.0**62:
        x, y = x.astype(object), y.astype(object)
    sums = np.concatenate([np.zeros(1, x.dtype), np.cumsum(x * y)])
    return [min(max(int(s), -(1 << 63)), (1 << 63) - 1) for s in sums[ends[1:]] - sums[ends[:-1]]]


def nodes(rows: DataFrame, k: int) -> DataFrame:
    """One row per distinct vector: ``node`` (smallest id), ``ids`` (the k + 1 smallest, ascending), ``x``.

    Its further ids can never be among the k best of any query: those k + 1 come first in every tie, and one of them at most
    is the query itself. The rank is limited before the shuffle, so a vector that many rows repeat is no hot group.
    """
    rank = F.row_number().over(Window.partitionBy("x").orderBy("id"))
    few = rows.withColumn("rank", rank).where(F.col("rank") <= k + 1)
    listed = few.groupBy("x").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    return listed.select(F.col("ids")[0].alias("node"), "ids", "x")


FILES = "dims int, shard int, n int, low binary, high binary, codes binary, least binary, safe binary"


def files(found: DataFrame, shards: int) -> DataFrame:
    """An approximation file per shard and number of dimensions.

    ``least`` is each vector's smallest id and ``safe`` one that it keeps where the query is one of its ids.
    """
    kinds = pa.schema([(n, pa.int32() if t == "int" else pa.binary()) for n, t in (c.split() for c in FILES.split(", "))])
    safe = F.when(F.size("ids") > 1, F.col("ids")[1]).otherwise(F.col("node"))
    dealt = found.select(F.size("x").alias("dims"), F.pmod(F.xxhash64("node"), F.lit(shards)).cast("int").alias("shard"), "node", safe.alias("safe"), "x")

    def build(key: tuple, part: pa.Table) -> pa.Table:
        dims, n = key[0].as_py(), len(part)
        points = np.asarray(part.column("x").combine_chunks().flatten()).reshape(n, dims)
        codes, low, high = approximate(points)
        raw = [np.asarray(part.column(c)).astype(np.int64).tobytes() for c in ("node", "safe")]
        return pa.table([[x] for x in (dims, key[1].as_py(), n, low.tobytes(), high.tobytes(), packed(codes), *raw)], schema=kinds)

    return dealt.groupBy("dims", "shard").applyInArrow(build, FILES)


def scan(asked: DataFrame, stored: DataFrame, shards: int, blocks: int, k: int) -> DataFrame:
    """Candidates of every query (``id``, ``x``) from the cells alone: query_id, node, lower, upper, safe, leads.

    Of each file those stay whose upper bound reaches its (k + 1)-th best lower bound, ties by id; the k + 1 vectors that set
    that bound ``lead``. Queries go to files in blocks; a file is one row, repeated per block.
    """
    kinds = pa.schema([("query_id", pa.int64()), ("node", pa.int64()), ("lower", pa.float64()), ("upper", pa.float64()), ("safe", pa.int64()), ("leads", pa.bool_())])
    every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    sent = asked.select(F.size("x").alias("dims"), every.alias("shard"), F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"), "id", "x")
    copies = stored.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    both = sent.unionByName(copies, allowMissingColumns=True)

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dims, file, ids, points = key[0].as_py(), None, [], []
        for batch in batches:
            own = np.asarray(batch.column("codes").is_valid())
            if own.any():
                file = batch.slice(int(own.argmax()), 1)
            rest = batch.filter(pa.array(~own))
            ids.append(np.asarray(rest.column("id")).astype(np.int64))
            points.append(np.asarray(rest.column("x").flatten()).reshape(len(rest), dims))
        ids = np.concatenate(ids)
        if file is None or not len(ids):
            return
        value = {c: file.column(c)[0].as_py() for c in file.schema.names}
        n, queries = value["n"], np.concatenate(points).astype(float)
        codes, each = unpacked(value["codes"], n, dims), np.arange(dims)
        low, high = (np.frombuffer(value[c]).reshape(dims, 1 << BITS)[each, codes] for c in ("low", "high"))
        least, safe = np.frombuffer(value["least"], np.int64), np.frombuffer(value["safe"], np.int64)
        held, size = [], 0
        for start in range(0, len(ids), step := max(1, SCAN // max(n, 1))):
            lower, upper = bounds(queries[start : start + step], low, high)
            for q, lo, up in zip(ids[start : start + step].tolist(), lower, upper, strict=True):
                if n > k + 1:
                    at = np.flatnonzero(lo >= np.partition(lo, n - k - 1)[n - k - 1])
                    lead = at[np.lexsort((safe[at], -lo[at]))[: k + 1]]
                    t, last = lo[lead[-1]], safe[lead[-1]]
                    stay = np.flatnonzero((up > t) | (up == t) & (least <= last))
                    stay = np.union1d(stay, lead)
                else:
                    stay = lead = np.arange(n)
                held.append((np.full(len(stay), q), least[stay], lo[stay], up[stay], safe[stay], np.isin(stay, lead)))
                size += len(stay)
                if size >= 1 << 18:
                    yield pa.record_batch([np.concatenate(c) for c in zip(*held, strict=True)], schema=kinds)
                    held, size = [], 0
        if held:
            yield pa.record_batch([np.concatenate(c) for c in zip(*held, strict=True)], schema=kinds)

    found = both.groupBy("dims", "shard", "block")
    return found.applyInArrow(run, "query_id bigint, node bigint, lower double, upper double, safe bigint, leads boolean")


def scored(candidates: DataFrame, asked: DataFrame, found: DataFrame) -> DataFrame:
    """Exact vectors of the candidates, read by a join, and their scores: query_id, upper, node, vec_id, score."""
    met = candidates.select("query_id", "node", "upper").join(found, "node").join(asked.select(F.col("id").alias("query_id"), F.col("x").alias("q")), "query_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = pa.array(products(b.column("x"), b.column("q")), pa.int64())
            yield pa.record_batch([*(b.column(c) for c in ("query_id", "upper", "node", "ids")), values], names=["query_id", "upper", "node", "ids", "score"])

    exact = met.select("query_id", "upper", "node", "ids", "x", "q").mapInArrow(run, "query_id bigint, upper double, node bigint, ids array<bigint>, score bigint")
    return exact.select("query_id", "upper", "node", F.explode("ids").alias("vec_id"), "score").where("vec_id <> query_id")


def search(queries: DataFrame, vectors: DataFrame, k: int = 5, key: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: exactly the k best by inner product of floor(scale * component).

    Ties go to smaller ids; a query never finds its own id; fewer candidates give fewer rows. Vectors that are NULL or hold a
    NULL or non-finite component take no part, nor do rows with a NULL id; zero and empty vectors do. Only vectors of as many
    dimensions are compared. Of rows that repeat an id the one with the greatest vector counts. Components and scores
    beyond the range of long become its nearest end. Empty tables give no rows.
    """
    rows = stage(integer_vectors(vectors, key, vector, scale), "integers")
    found = stage(nodes(rows, k), "nodes")
    asked = stage(integer_vectors(queries, key, vector, scale), "queries")
    count, wanted, tasks = found.count(), asked.count(), 2 * vectors.sparkSession.sparkContext.defaultParallelism
    # Files and blocks are as large as memory lets them be, smaller only where there would be idle cores.
    shards = max(-(-count // SHARD), min(tasks, -(-count // LEAST)), 1)
    blocks = max(-(-wanted // BLOCK), min(-(-tasks // shards), -(-wanted * 8 // LEAST)), 1)
    candidates = stage(scan(asked, stage(files(found, shards), "cells"), shards, blocks, k), "candidates")

    # The (k + 1)-th best lower bound of all files: from their leaders, a bounded number per file and query.
    best = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("lower"), "safe"))
    limit = candidates.where("leads").withColumn("rank", best).where(F.col("rank") <= k + 1)
    limit = limit.where(F.col("rank") == k + 1).select("query_id", F.col("lower").alias("t"), F.col("safe").alias("last"))
    near = candidates.join(limit, "query_id", "left").where("t IS NULL OR upper > t OR upper = t AND node <= last").select("query_id", "node", "upper")

    # From the highest upper bound down: first a few, then whatever can still beat or tie with the k-th of those.
    down = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("upper"), "node"))
    first = stage(scored(near.withColumn("place", down).where(F.col("place") <= READ * k), asked, found), "first")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    sure = first.withColumn("rank", place).where(F.col("rank") <= k).where(F.col("rank") == k).select("query_id", F.col("score").cast("double").alias("kth"))
    read = first.groupBy("query_id").agg(F.min(F.struct("upper", (-F.col("node")).alias("node"))).alias("seen"))
    rest = near.join(read, "query_id", "left").join(sure, "query_id", "left")
    rest = rest.where("(seen IS NULL OR (upper, -node) < (seen.upper, seen.node)) AND (kth IS NULL OR upper >= kth)")
    every = first.unionByName(scored(rest, asked, found))
    return every.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
