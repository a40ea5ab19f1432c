"""Byte-level BPE over whole texts.

Every match of the splitting pattern is encoded by itself. A segment tree over its byte positions stores the leftmost
minimum pair rank; each merge makes three logarithmic point updates on the live neighbours.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import text_runs, unused, with_text_columns

MEMO_ENTRIES = 1 << 18
MEMO_BYTES = 64


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a ``.tiktoken`` file: a base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x.strip())}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one match: merge the leftmost pair of lowest rank until no pair has a rank."""
    find = ranks.get
    whole = find(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    size = 1 << (n - 2).bit_length()
    shift = max(14, size.bit_length())  # rank << shift | position: the minimum is the leftmost pair of lowest rank
    position, never = (1 << shift) - 1, 1 << (shift + 32)
    end = list(range(1, n + 1))  # token at i covers piece[i:end[i]]
    before = list(range(-1, n))  # start of the token left of the one at i
    tree = [never] * (2 * size)
    for i in range(n - 1):
        rank = find(piece[i : i + 2])
        if rank is not None:
            tree[size + i] = rank << shift | i
    for k in range(size - 1, 0, -1):
        left, right = tree[2 * k], tree[2 * k + 1]
        tree[k] = left if left < right else right
    least = tree[1]
    while least != never:
        i = least & position
        gone = end[i]
        end[i] = after = end[gone]
        if after < n:
            before[after] = i
            rank = find(piece[i : end[after]])
            changed = [(gone, never), (i, never if rank is None else rank << shift | i)]
        else:
            changed = [(i, never)]
            if gone < n - 1:
                changed.append((gone, never))
        if i:
            left = before[i]
            rank = find(piece[left:after])
            changed.append((left, never if rank is None else rank << shift | left))
        for at, key in changed:
            k = size + at
            if tree[k] == key:
                continue
            tree[k] = key
            while k > 1:
                other = tree[k ^ 1]
                if other < key:
                    key = other
                k >>= 1
                if tree[k] == key:
                    break
                tree[k] = key
        least = tree[1]
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : end[i]]])
        i = end[i]
    return ids


class Encoder:
    """Encoder with a memo of short matches: two generations of bounded size, so that frequent ones stay."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.split = ranks, regex.compile(pattern).findall
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def match_ids(self, match: str) -> bytes:
        ids = self.old.get(match)
        if ids is None:
            ids = array("i", merge(match.encode("utf-8", "replace"), self.ranks)).tobytes()
        if len(match) <= MEMO_BYTES:
            if len(self.young) >= MEMO_ENTRIES:
                self.old, self.young = self.young, {}
            self.young[match] = ids
        return ids

    def encode(self, text: str) -> np.ndarray:
        known, own = self.young.get, self.match_ids
        return np.frombuffer(b"".join([known(m) or own(m) for m in self.split(text)]), np.int32)


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``ids`` (array<int>) of every row.

    NULL and empty texts give an empty array; repeated rows and NULL keys are kept as they are; other columns of ``docs``
    are not returned. ``ranks`` is a fixed vocabulary, shipped to the executors once.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shipped.value, pattern)
        for part, texts in text_runs(batches, "t"):
            each = [encoder.encode(t or "") for t in texts]
            ends = np.concatenate([[0], np.cumsum([len(x) for x in each])]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(each)))
            yield pa.record_batch([part.column(0), ids], names=["k", "ids"])

    cols = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    kind = cols.schema["k"].dataType.simpleString()
    return cols.mapInArrow(run, f"k {kind}, ids array<int>").withColumnRenamed("k", key)


def decode(encoded: DataFrame, ranks: dict[bytes, int], key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key``, ``ids`` and ``decoded`` (binary): the tokens' bytes joined. A NULL array decodes to no bytes."""
    shipped = encoded.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = {rank: piece for piece, rank in shipped.value.items()}.__getitem__
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                out = [b"".join(map(token, x.values.to_numpy().tolist())) if x.is_valid else b"" for x in part.column(1)]
                yield pa.record_batch([part.column(0), part.column(1), pa.array(out, pa.binary())], names=["k", "ids", "decoded"])

    cols = encoded.select(F.col(key).alias("k"), F.col(ids).alias("ids"))
    kind = cols.schema["k"].dataType.simpleString()
    return cols.mapInArrow(run, f"k {kind}, ids array<int>, decoded binary").withColumnRenamed("k", key)


def digests(decoded: DataFrame, key: str = "doc_id") -> DataFrame:
    """Token count and SHA-256 of the decimal ids and of the decoded bytes."""
    return decoded.select(
        key, F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def with_digests(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` of the text encoded and decoded again.

    Columns of ``docs`` that have these names are replaced.
    """
    docs = docs.drop("n_tokens", "ids_sha256", "decoded_sha256")
    ids, decoded = unused(docs, "_ids", "_decoded")
    shipped = docs.sparkSession.sparkContext.broadcast(ranks)

    def start():
        ranks = shipped.value
        encoder = Encoder(ranks, pattern)
        token = {rank: piece for piece, rank in ranks.items()}.__getitem__

        def compute(texts: list) -> list[pa.Array]:
            each = [encoder.encode(t or "") for t in texts]
            ends = np.concatenate([[0], np.cumsum([len(x) for x in each])]).astype(np.int32)
            return [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(each))), pa.array([b"".join(map(token, x.tolist())) for x in each], pa.binary())]

        return compute

    coded = with_text_columns(docs, text, {ids: "array<int>", decoded: "binary"}, start)
    return coded.select(
        *(F.col(f"`{c}`") for c in docs.columns), F.size(ids).cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col(ids).cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(decoded, 256).alias("decoded_sha256"),
    )
