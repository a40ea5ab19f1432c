"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at distance ``2r`` or less share a word within ``r`` bits of both. Every distinct fingerprint emits all
words within ``r`` flipped bits; fingerprints that emit the same word are near each other, and no near pair is missed.

The emitted words are shuffled by some of their bits. Flips of all other bits leave that key alone, so the words of one
fingerprint that go to the same task travel as one row and are spelt out there, in slices of bounded size. Fingerprints that
share a word are linked to the smallest of them; any two of them are within ``2r`` bits by the triangle inequality, which is
verified again on the pair. A key with more than ``PER_TASK`` words is dealt anew by further bits of its words, until no key
has more or all bits are used, when a key is one word, which at most ``C(64, <= r)`` distinct fingerprints share. Each task passes on a spanning forest of its links, so a group of n copies gives at most n - 1.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import salted_left_join, stage, text_runs, with_text_columns
from terrace.llm.components import components

WORD = re.compile(rb"[^\x20\x09-\x0D]+").findall
UPPER = bytes(range(65, 91))
LOWER = UPPER.lower()
BITS = 64
RADIUS = 2
SLICE = 1 << 21  # words spelt out at a time
PER_KEY = 2048  # fingerprints per shuffle key aimed at
PER_TASK = 1 << 23  # words of a shuffle key from which it is dealt by further bits; twice those of PER_KEY fingerprints
FURTHER = 8  # bits by which it is dealt then


def fingerprint(text: str | None, width: int = 4, seed: int = 42) -> int:
    """SimHash of the word shingles of a whole text: a bit is set when more than half the shingle hashes have it."""
    words = WORD(text.encode("utf-8", "replace").translate(bytes.maketrans(UPPER, LOWER))) if text else []
    if not words:
        return 0
    tidy = b" ".join(words)
    ends = np.cumsum(np.array([len(w) + 1 for w in words])) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = max(len(words) - width + 1, 1)
    ends = ends[min(width, len(words)) - 1 :]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(tidy[a:b], seed) for a, b in zip(starts[:last].tolist(), ends.tolist(), strict=True)], np.uint64)
    set_bits = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        set_bits += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << b for b in np.flatnonzero(2 * set_bits > len(hashes)).tolist())


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 4) -> DataFrame:
    """``key`` and ``fp`` (the 64 bits as a signed long) of every row; texts without words, or NULL, have fingerprint 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_runs(batches, "t"):
            found = np.array([fingerprint(t, width) for t in texts], np.uint64).view(np.int64)
            yield pa.record_batch([part.column(0), pa.array(found)], names=["k", "fp"])

    cols = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    return cols.mapInArrow(run, f"k {cols.schema['k'].dataType.simpleString()}, fp bigint").withColumnRenamed("k", key)


def flips(radius: int, among: list[int]) -> np.ndarray:
    """Masks of all sets of at most ``radius`` of the bits ``among``."""
    return np.array([sum(1 << b for b in s) for k in range(radius + 1) for s in combinations(among, k)], np.uint64)


def links(prints: DataFrame, count: int, radius: int = RADIUS, per_key: int = PER_KEY, per_task: int | None = None) -> DataFrame:
    """``a`` < ``b`` (as signed longs): a spanning forest of the links between the distinct fingerprints ``fp``."""
    per_task = per_task or PER_TASK
    split = max(min(int(np.ceil(np.log2(max(count, 1) / per_key))), 32), 4)
    rng = np.random.Generator(np.random.PCG64(7))
    keyed = sorted(rng.choice(BITS, split, replace=False).tolist())
    later = rng.permutation([b for b in range(BITS) if b not in keyed]).tolist()
    dealt, found = _dealt(prints.select("fp"), [], keyed, radius), None
    while True:
        free = [b for b in range(BITS) if b not in keyed]
        hot = _heavy(dealt, keyed, radius, per_task) if free else None
        if hot is not None and hot.isEmpty():
            hot = None
        cold = dealt if hot is None else dealt.join(hot, "word_key", "left_anti")
        own = cold.groupBy("word_key").applyInArrow(_collide(keyed, radius), "a bigint, b bigint")
        found = own if found is None else found.union(own)
        if hot is None:
            return found
        before, keyed, later = keyed, sorted(keyed + later[:FURTHER]), later[FURTHER:]
        dealt = stage(_dealt(dealt.join(hot, "word_key", "left_semi"), before, keyed, radius), "dealt")


def _mask(bits: list[int]) -> np.uint64:
    return np.uint64(sum(1 << b for b in bits))


def _dealt(rows: DataFrame, before: list[int], keyed: list[int], radius: int) -> DataFrame:
    """``word_key`` (the bits ``keyed`` of words) and ``fp``: all keys that words of each fingerprint have.

    Where ``rows`` were dealt by the bits ``before``, their keys stay and only the other bits are flipped.
    """
    old, key_mask = _mask(before), _mask(keyed)
    added = [b for b in keyed if b not in before]
    masks = [flips(radius - u, added) for u in range(radius + 1)]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                part = batch.slice(start, 4096)
                own = np.array(part.column("fp")).view(np.uint64)
                flipped = (own & old) ^ np.array(part.column("word_key")).view(np.uint64) if before else np.zeros(len(own), np.uint64)
                used = np.bitwise_count(flipped)
                for u in np.unique(used).tolist():
                    at = used == u
                    keys = (((own ^ flipped)[at] & key_mask)[:, None] ^ masks[u][None, :]).ravel()
                    fps = np.repeat(own[at], len(masks[u]))
                    yield pa.record_batch([pa.array(keys.view(np.int64)), pa.array(fps.view(np.int64))], names=["word_key", "fp"])

    return rows.mapInArrow(emit, "word_key bigint, fp bigint")


def _heavy(dealt: DataFrame, keyed: list[int], radius: int, most: int) -> DataFrame:
    """``word_key`` of the keys with more than ``most`` words; counts are added up by batch before they are shuffled."""
    key_mask = _mask(keyed)
    words = np.array([len(flips(radius - u, [b for b in range(BITS) if b not in keyed])) for u in range(radius + 1)])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, fp = (np.array(batch.column(c)).view(np.uint64) for c in ("word_key", "fp"))
            keys, at = np.unique(key, return_inverse=True)
            n = np.bincount(at, words[np.bitwise_count((fp & key_mask) ^ key)], len(keys)).astype(np.int64)
            yield pa.record_batch([pa.array(keys.view(np.int64)), pa.array(n)], names=["word_key", "n"])

    counted = dealt.mapInArrow(count, "word_key bigint, n bigint").groupBy("word_key").agg(F.sum("n").alias("n"))
    return stage(counted.where(F.col("n") > most).select("word_key"), "heavy")


def _collide(keyed: list[int], radius: int):
    """Of all rows of a key: a spanning forest of the links between fingerprints that share a word with that key."""
    free, key_mask = [b for b in range(BITS) if b not in keyed], _mask(keyed)
    nothing = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})

    def collide(key: tuple, rows: pa.Table) -> pa.Table:
        fps = np.unique(rows.column("fp").to_numpy().view(np.uint64))
        if len(fps) < 2:
            return nothing
        flipped = (fps & key_mask) ^ np.int64(key[0].as_py()).astype(np.uint64)
        used, base = np.bitwise_count(flipped), fps ^ flipped
        parent = np.arange(len(fps))
        found_a, found_b = [], []
        # Words are spelt out for one value of some free bits after the other: equal words always meet in one slice.
        total = sum(int((used == u).sum()) * len(flips(radius - u, free)) for u in range(radius + 1))
        fine = max(int(np.ceil(np.log2(max(total / SLICE, 1)))), 0)
        fine_bits = free[: max(min(fine, len(free) - 1), 0)]
        fine_mask = np.uint64(sum(1 << b for b in fine_bits))
        masks = {u: flips(radius - u, free) for u in range(radius + 1)}
        for at in range(1 << len(fine_bits)):
            want = np.uint64(sum(1 << b for i, b in enumerate(fine_bits) if at >> i & 1))
            words, owners = [], []
            for u in range(radius + 1):
                rows = np.flatnonzero(used == u)
                if not len(rows):
                    continue
                mask = masks[u]
                if len(fine_bits):
                    need = (fps[rows] & fine_mask) ^ want
                    order = np.argsort(mask & fine_mask, kind="stable")
                    have = (mask & fine_mask)[order]
                    lo, hi = np.searchsorted(have, need, "left"), np.searchsorted(have, need, "right")
                    n = hi - lo
                    at_mask = order[np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())]
                    own = np.repeat(rows, n)
                else:
                    own, at_mask = np.repeat(rows, len(mask)), np.tile(np.arange(len(mask)), len(rows))
                words.append(base[own] ^ mask[at_mask])
                owners.append(own)
            if not words:
                continue
            words, owners = np.concatenate(words), np.concatenate(owners)
            order = np.argsort(words)
            words, owners = words[order], owners[order]
            same = words[1:] == words[:-1]
            if not same.any():
                continue
            group = np.concatenate([[0], np.cumsum(~same)])
            inside = np.concatenate([same, [False]]) | np.concatenate([[False], same])
            group, owners = group[inside], owners[inside]
            first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
            least = np.repeat(np.minimum.reduceat(owners, first), np.diff(np.append(first, len(owners))))
            pair = np.unique(least * len(fps) + owners)
            a, b = np.divmod(pair, len(fps))
            near = (a != b) & (np.bitwise_count(fps[a] ^ fps[b]) <= 2 * radius)
            found_a.append(a[near])
            found_b.append(b[near])
        if not found_a:
            return nothing
        pairs = np.unique(np.concatenate(found_a) * len(fps) + np.concatenate(found_b))
        a, b = np.divmod(pairs, len(fps))
        while True:  # hook to the smaller root and halve the paths until each link's ends agree
            ra, rb = parent[a], parent[b]
            open_ = ra != rb
            if not open_.any():
                break
            a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
            np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
            while (parent[parent] != parent).any():
                parent = parent[parent]
        child = np.flatnonzero(parent != np.arange(len(fps)))
        ends = np.sort(np.stack([fps[parent[child]].view(np.int64), fps[child].view(np.int64)]), axis=0)
        return pa.table({"a": pa.array(ends[0]), "b": pa.array(ends[1])})

    return collide


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 4, radius: int = RADIUS) -> DataFrame:
    """``key``, ``fingerprint`` (16 hex digits), ``component_id`` (smallest key reachable) of every row.

    Fingerprints are linked at ``2 * radius`` or fewer differing bits. Rows with equal texts share a fingerprint and hence a
    component; a NULL key belongs to its component but is never its id, unless the component has no other key.
    """
    prints = stage(fingerprints(docs, key, text, width), "prints")
    nodes = stage(prints.groupBy("fp").agg(F.min(key).alias("least")), "nodes")
    roots = components(links(nodes, nodes.count(), radius))
    labelled = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    member = labelled.select("fp", "root").join(least, "root").select("fp", "component_id")
    named = salted_left_join(prints, member, "fp", key)
    return named.select(key, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def without_near_duplicates(docs: DataFrame, shingles: Sequence[tuple[int, int]], key: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` but one document per group: that of the smallest key stays.

    Documents are linked when their fingerprints of any of the ``shingles`` (width, hash seed) differ in ``2 * radius`` bits or
    fewer; the first pair must be no repetition. A document is a key with a text: rows that repeat both stay together, different
    texts of one key are different documents. A NULL key is a key, and the smallest.
    """
    names = [f"fp{i}" for i in range(len(shingles))]

    def start():
        return lambda texts: [pa.array(np.array([fingerprint(t, *s) for t in texts], np.uint64).view(np.int64)) for s in shingles]

    cols = docs.select(F.col(key).alias("k"), F.xxhash64(text).alias("h"), F.col(text).alias("t"))
    prints = stage(with_text_columns(cols, "t", dict.fromkeys(names, "bigint"), start).drop("t"), "prints")
    edges = None
    for i, name in enumerate(names):
        nodes = stage(prints.select(F.col(name).alias("fp")).distinct(), "nodes")
        near = links(nodes, nodes.count(), radius)
        own = near.select(*(F.xxhash64(c, F.lit(i)).alias(c) for c in "ab"))
        edges = own if edges is None else edges.union(own)
    first = F.xxhash64(names[0], F.lit(0))
    for i, name in enumerate(names[1:], 1):  # the fingerprints of one text belong together
        edges = edges.union(prints.select(first.alias("a"), F.xxhash64(name, F.lit(i)).alias("b")).distinct())
    roots = components(edges)
    nodes = prints.groupBy(first.alias("node")).agg(F.min(F.struct("k", "h")).alias("least"))
    member = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    chosen = member.groupBy("root").agg(F.min("least").alias("least")).select(F.col("least.k").alias("chosen_key"), F.col("least.h").alias("chosen_hash"))
    same = docs[key].eqNullSafe(chosen["chosen_key"]) & (F.xxhash64(docs[text]) == chosen["chosen_hash"])
    return docs.join(chosen, same, "left_semi")
