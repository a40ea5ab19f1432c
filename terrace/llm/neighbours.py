"""Approximate nearest neighbours: one hierarchical navigable small-world graph per shard, results merged.

Vectors are dealt over shards by hash. Each shard's graph is built in its task and stored as flat neighbour arrays, a row per
shard. Every query visits every shard: a task takes a block of queries and as many shards as its memory holds, so a query
crosses the wire once per group of shards and a shard once per block, both bounded by bytes. Finds are scored again exactly
and merged, within the task first.
Inner product is made a metric by one more component that gives all vectors of a shard the same length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.common import broadcast_if_small, stage

SHARD = 8192  # vectors per shard aimed at
BLOCK_BYTES = 16 << 20  # of query vectors per block aimed at
GROUP_BYTES = 64 << 20  # of vectors of the shards that one task walks through, aimed at
DEGREE = 16  # neighbours per node; twice as many on the ground layer
BUILD_WIDTH = 64
SEARCH_WIDTH = 96
BATCH = 256
EXPAND = 4
SEED = 11


def select(points: np.ndarray, base: np.ndarray, candidates: np.ndarray, degree: int) -> np.ndarray:
    """Up to ``degree`` diverse neighbours per base: a candidate stays if it is nearer to the base than to those kept.

    ``candidates``: rows of node numbers, -1 for none, at most one of each. Free places go to the nearest passed over.
    """
    rows, width = candidates.shape
    near = np.einsum("bcd,bd->bc", points[candidates], points[base])
    near[candidates < 0] = -np.inf
    order = np.argsort(-near, axis=1, kind="stable")
    candidates, near = np.take_along_axis(candidates, order, 1), np.take_along_axis(near, order, 1)
    among = np.matmul(points[candidates], points[candidates].transpose(0, 2, 1))
    kept = np.zeros((rows, width), bool)
    for c in range(width):
        hidden = (kept[:, :c] & (among[:, c, :c] >= near[:, c, None])).any(axis=1)
        kept[:, c] = ~hidden & (near[:, c] > -np.inf) & (kept[:, :c].sum(axis=1) < degree)
    rank = np.where(kept, 0, width) + np.arange(width)
    first = np.argsort(rank, axis=1, kind="stable")[:, :degree]
    return np.take_along_axis(candidates, first, 1)


def beam(points: np.ndarray, neighbours: np.ndarray, queries: np.ndarray, entries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``width`` nearest nodes found per query, nearest first, and their inner products. ``entries``: nodes per query."""
    n, rows = len(neighbours), np.arange(len(queries))[:, None]
    seen = np.zeros((len(queries), n + 1), bool)  # the last column stands for no node
    seen[:, n] = True
    found = np.full((len(queries), width), -1)
    near = np.full((len(queries), width), -np.inf, np.float32)
    found[:, : entries.shape[1]] = entries
    near[:, : entries.shape[1]] = np.where(entries >= 0, np.einsum("qcd,qd->qc", points[entries], queries), -np.inf)
    seen[rows, entries] = True
    done = np.zeros(found.shape, bool)
    active = np.arange(len(queries))
    while len(active):
        order = np.argsort(-np.where(done[active], -np.inf, near[active]), axis=1, kind="stable")[:, :EXPAND]
        open_ = np.take_along_axis(~done[active] & (found[active] >= 0), order, 1)
        going = open_.any(axis=1)
        active, order, open_ = active[going], order[going], open_[going]
        if not len(active):
            break
        chosen = np.where(open_, np.take_along_axis(found[active], order, 1), -1)
        done[active[:, None], order] |= open_
        fresh = np.where(chosen[:, :, None] >= 0, neighbours[chosen], -1).reshape(len(active), -1)
        fresh = np.sort(fresh, axis=1)
        fresh[:, 1:][fresh[:, 1:] == fresh[:, :-1]] = -1
        fresh[seen[active[:, None], fresh]] = -1
        seen[active[:, None], fresh] = True
        values = np.einsum("qcd,qd->qc", points[fresh], queries[active])
        values[fresh < 0] = -np.inf
        all_found = np.concatenate([found[active], fresh], axis=1)
        all_near = np.concatenate([near[active], values], axis=1)
        all_done = np.concatenate([done[active], np.zeros(fresh.shape, bool)], axis=1)
        best = np.argsort(-all_near, axis=1, kind="stable")[:, :width]
        found[active], near[active], done[active] = (np.take_along_axis(x, best, 1) for x in (all_found, all_near, all_done))
    return found, near


class Graph:
    """Layers of a navigable small world: per layer the member nodes and a table of neighbours over all nodes of the shard."""

    def __init__(self, vectors: np.ndarray):
        length = np.einsum("ij,ij->i", vectors, vectors)
        lift = np.sqrt(np.maximum(length.max(initial=0) - length, 0))
        self.points = np.concatenate([vectors, lift[:, None]], axis=1).astype(np.float32)
        rng = np.random.Generator(np.random.PCG64(SEED))
        level = np.minimum((-np.log(1 - rng.random(len(vectors))) / np.log(DEGREE)).astype(int), 16)
        self.layers: list[tuple[np.ndarray, np.ndarray]] = []  # from the top
        for height in range(level.max(initial=0), -1, -1):
            members = np.flatnonzero(level >= height)
            members = members[np.lexsort((members, -level[members]))]
            self._build(members, 2 * DEGREE if height == 0 else DEGREE)

    def _entries(self, queries: np.ndarray) -> np.ndarray:
        """Where to start below the layers there are: the nearest nodes found from the top down."""
        entries = np.full((len(queries), 1), self.layers[0][0][0])
        for _, neighbours in self.layers:
            entries = beam(self.points, neighbours, queries, entries, 4)[0]
        return entries

    def _build(self, members: np.ndarray, slots: int) -> None:
        neighbours = np.full((len(self.points), slots), -1)
        inside = 0
        while inside < len(members):
            batch = members[inside : inside + min(BATCH, max(16, inside))]
            own = self.points[batch]
            mates = np.argsort(-(own @ own.T), axis=1, kind="stable")[:, : BUILD_WIDTH // 4]
            candidates = batch[mates]
            if inside:
                entries = self._entries(own) if self.layers else np.full((len(batch), 1), members[0])
                present = np.zeros(len(self.points), bool)
                present[members[:inside]] = True
                entries = np.where((entries >= 0) & present[entries], entries, -1)
                entries[entries.max(axis=1) < 0, 0] = members[0]
                candidates = np.concatenate([candidates, beam(self.points, neighbours, own, entries, BUILD_WIDTH)[0]], axis=1)
            candidates[candidates == batch[:, None]] = -1
            chosen = select(self.points, batch, candidates, DEGREE)
            neighbours[batch, : chosen.shape[1]] = chosen
            self._link_back(neighbours, batch, chosen, slots)
            inside += len(batch)
        self.layers.append((members, neighbours))

    def _link_back(self, neighbours: np.ndarray, batch: np.ndarray, chosen: np.ndarray, slots: int) -> None:
        source, target = np.repeat(batch, chosen.shape[1]), chosen.ravel()
        source, target = source[target >= 0], target[target >= 0]
        known = (neighbours[target] == source[:, None]).any(axis=1)
        source, target = source[~known], target[~known]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        nodes, first, count = np.unique(target, return_index=True, return_counts=True)
        for start in range(0, len(nodes), 1024):
            part = slice(start, start + 1024)
            width = int(count[part].max())
            at = first[part, None] + np.arange(width)
            more = np.where(np.arange(width) < count[part, None], source[np.minimum(at, len(source) - 1)], -1)
            both = np.concatenate([neighbours[nodes[part]], more], axis=1)
            full = (both >= 0).sum(axis=1) > slots
            packed = np.take_along_axis(both, np.argsort(both < 0, axis=1, kind="stable"), 1)[:, :slots]
            if full.any():
                packed[full] = select(self.points, nodes[part][full], both[full], slots)
            neighbours[nodes[part]] = packed

    def flat(self) -> list[bytes]:
        """Each layer as bytes: the number of members, the members, their neighbours row by row."""
        return [np.concatenate([[len(m), nb.shape[1]], m, nb[m].ravel()]).astype(np.int32).tobytes() for m, nb in self.layers]

    @classmethod
    def stored(cls, vectors: np.ndarray, flat: list[bytes]) -> Graph:
        self = cls.__new__(cls)
        length = np.einsum("ij,ij->i", vectors, vectors)
        lift = np.sqrt(np.maximum(length.max(initial=0) - length, 0))
        self.points = np.concatenate([vectors, lift[:, None]], axis=1).astype(np.float32)
        self.layers = []
        for raw in flat:
            values = np.frombuffer(raw, np.int32)
            n, slots = int(values[0]), int(values[1])
            table = np.full((len(vectors), slots), -1)
            table[values[2 : 2 + n]] = values[2 + n :].reshape(n, slots)
            self.layers.append((values[2 : 2 + n], table))
        return self

    def search(self, queries: np.ndarray, width: int = SEARCH_WIDTH) -> np.ndarray:
        """Nodes found per query, nearest first, -1 for none."""
        lifted = np.concatenate([queries, np.zeros((len(queries), 1))], axis=1).astype(np.float32)
        entries = np.full((len(queries), 1), self.layers[0][0][0])
        for _, neighbours in self.layers[:-1]:
            entries = beam(self.points, neighbours, lifted, entries, 4)[0]
        return beam(self.points, self.layers[-1][1], lifted, entries, width)[0]


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``id`` and ``v`` (array<double>) of the rows that take part: no NULLs, no NaN or infinity, not all zero."""
    v = F.col("v")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    return rows.where(F.col("id").isNotNull() & v.isNotNull() & F.coalesce(fine, F.lit(False)))


def index(rows: DataFrame, count: int, k: int, shard: int = SHARD) -> DataFrame:
    """One row per shard and number of dimensions: ``ids`` (up to k + 1 smallest per distinct vector), ``vectors``, ``layers``.

    Equal vectors are one node. Its further ids can never be among the k nearest of any query: the k + 1 smaller ones come
    first in every tie, one of them at most being the query itself.
    """
    rank = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    few = rows.groupBy("id", "v").agg(F.lit(1).alias("one")).drop("one").withColumn("rank", rank).where(F.col("rank") <= k + 1)
    nodes = few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    shards = max(-(-count // shard), 1)
    dealt = nodes.select(F.size("v").alias("dims"), F.pmod(F.xxhash64("v"), F.lit(shards)).cast("int").alias("shard"), "ids", "v")
    kinds = pa.schema([("dims", pa.int32()), ("shard", pa.int32()), ("ids", pa.list_(pa.list_(pa.int64()))), ("vectors", pa.binary()), ("layers", pa.list_(pa.binary()))])

    def build(key: tuple, nodes: pa.Table) -> pa.Table:
        ids = nodes.column("ids").to_pylist()
        order = sorted(range(len(ids)), key=lambda i: ids[i])
        vectors = np.array(nodes.column("v").combine_chunks().flatten()).reshape(len(ids), -1)[order]
        graph = Graph(vectors)
        return pa.table([[key[0].as_py()], [key[1].as_py()], [[ids[i] for i in order]], [vectors.tobytes()], [graph.flat()]], schema=kinds)

    return dealt.groupBy("dims", "shard").applyInArrow(build, "dims int, shard int, ids array<array<bigint>>, vectors binary, layers array<binary>")


def nearest(queries: DataFrame, vectors: DataFrame, k: int = 20, key: str = "vec_id", vector: str = "embedding", shard: int = SHARD, width: int = SEARCH_WIDTH) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the k nearest found by largest inner product, ties to smaller ids.

    Scores are inner products in double precision of the original vectors. A query never finds its own id. Vectors that are
    NULL, zero or hold a NULL or non-finite component take no part, nor do rows with a NULL id; only vectors of as many
    dimensions are compared. Rows that repeat id and vector count once; fewer candidates give fewer rows.
    """
    rows = stage(usable(vectors, key, vector), "vectors")
    count, dims = rows.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(1))).first()
    shards = max(-(-count // shard), 1)
    groups = max(-(-shards * shard * dims * 8 // GROUP_BYTES), rows.sparkSession.sparkContext.defaultParallelism)
    group = F.pmod("shard", F.lit(min(groups, shards)))
    stored = stage(index(rows, count, k, shard), "graphs").withColumn("group", group)
    asked = usable(queries, key, vector).groupBy("id", "v").agg(F.size("v").alias("dims"))
    blocks = max(-(-asked.count() * dims * 8 // BLOCK_BYTES), 1)
    asked = asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    places = stored.select(F.col("dims").alias("to_dims"), F.col("group").alias("to_group")).distinct()
    sent = asked.join(broadcast_if_small(places, 64 * places.count()), F.col("dims") == F.col("to_dims"))
    copies = stored.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    kinds = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def search(sent: pa.Table, stored: pa.Table) -> pa.Table:
        if not len(sent) or not len(stored):
            return kinds.empty_table()
        graphs = []
        for ids, raw, layers in zip(*(stored.column(c).to_pylist() for c in ("ids", "vectors", "layers")), strict=True):
            points = np.frombuffer(raw).reshape(len(ids), -1)
            graphs.append((ids, points, Graph.stored(points, layers)))
        own = np.array(sent.column("id"))
        asked, same = np.unique(np.array(sent.column("v").combine_chunks().flatten()).reshape(len(own), -1), axis=0, return_inverse=True)
        askers = np.split(own[np.argsort(same.ravel(), kind="stable")], np.cumsum(np.bincount(same.ravel()))[:-1])
        out = []
        for start in range(0, len(asked), 512):
            part = asked[start : start + 512]
            near: list[list[tuple]] = [[] for _ in part]
            for ids, points, graph in graphs:
                for best, q, nodes in zip(near, part, graph.search(part, max(width, k + 1)), strict=True):
                    nodes = nodes[nodes >= 0]
                    scores = np.einsum("cd,d->c", points[nodes], q)
                    best += [(-v, i) for v, n in zip(scores.tolist(), nodes.tolist(), strict=True) for i in ids[n]]
                    best.sort()
                    del best[k + 1 :]
            found = [(q, i, -v) for best, who in zip(near, askers[start : start + 512], strict=True) for q in who.tolist() for v, i in [x for x in best if x[1] != q][:k]]
            if found:
                out.append(pa.table([list(c) for c in zip(*found, strict=True)], schema=kinds))
        return pa.concat_tables(out) if out else kinds.empty_table()

    found = sent.groupBy("to_dims", "to_group", "block").cogroup(copies.groupBy("dims", "group", "block")).applyInArrow(search, "query_id bigint, vec_id bigint, score double")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
