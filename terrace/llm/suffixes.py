"""Repeated byte strings: remove every byte covered by a fixed-length string that also starts earlier in the corpus.

Every string (window) of ``LENGTH`` bytes belongs to its anchor, the leftmost of its byte q-grams with the smallest hash.
Consecutive windows with the same anchor form a piece, so equal windows lie in pieces of equal anchor hash, at the same
distance from the anchor. Pieces that are whole copies of an earlier piece are removed outright, in the map task first and
then after a shuffle by anchor hash. What is left, different pieces that share an anchor, is a collection of short documents
of which suffix order and common prefixes are built column by column: aligned at their anchors, every round inserts one more
symbol of each piece on the left, in one sequential pass over the order and the common prefixes of the round before (a
stable distribution by the inserted symbols, which are that round's Burrows-Wheeler transform). Runs of common prefixes of
``LENGTH`` or more are equal windows; all but the earliest are removed.

The passes read and write arrays of one bucket of pieces, sequentially, in place of files: a bucket is a bounded number of
pieces, and no task keeps files on its machine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.common import stage, text_runs, unused

LENGTH = 100
GRAM = 24
BUCKET = 8192  # pieces per bucket aimed at
SPLIT = 65_536  # pieces of one anchor from which they are dealt over several buckets
BLOCK = 1 << 20  # pieces that a map task collapses at a time
LAID = 4096  # pieces of a bucket whose bytes are hashed or laid out at a time
NO_KEY = -(1 << 63)

_MULTIPLIER = 0x9E3779B97F4A7C15
_TABLE = np.random.Generator(np.random.PCG64(5)).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def gram_hashes(data: np.ndarray, width: int = GRAM) -> np.ndarray:
    """Mixed 64-bit hash of every run of ``width`` bytes."""

    def joined(left: np.ndarray, right: np.ndarray, k: int, n: int) -> np.ndarray:
        return left[:n] * np.uint64(pow(_MULTIPLIER, k, 1 << 64)) + right[-n:] if n > 0 else left[:0]

    single, size, total, done = _TABLE[data], 1, None, 0
    while size <= width:
        if width & size:
            total = single if total is None else joined(single, total, done, len(data) - done - size + 1)
            done += size
        single = joined(single, single, size, len(data) - 2 * size + 1)
        size *= 2
    x = total ^ (total >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def least_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    k = 1
    while 2 * k <= width:
        values = np.minimum(values[:-k], values[k:])
        k *= 2
    return np.minimum(values[: len(values) - (width - k)], values[width - k :]) if k < width else values


def pieces(raw: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, first window and number of windows of every piece of a text of at least ``length`` bytes."""
    hashes = gram_hashes(np.frombuffer(raw, np.uint8))
    least = least_in_windows(hashes, length - GRAM + 1)
    cut = np.flatnonzero((least[1:] != least[:-1]) | (hashes[: len(least) - 1] == least[:-1])) + 1
    start = np.concatenate([[0], cut])
    return least[start], start, np.diff(np.append(start, len(least)))


def _located(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``doc`` (a NULL key is the smallest), ``part`` (tells texts of one key apart) and ``t``."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_KEY)).alias("doc"), F.hash(body).alias("part"), body.alias("t"))


def _cut(located: DataFrame, length: int) -> DataFrame:
    """Pieces that are first of their content in their map task (``at`` >= 0), and certain removals (``at`` < 0).

    ``at`` packs the first window and the number of windows.
    """
    names = ["m", "h", "doc", "part", "at"]

    def collapse(held: list[tuple]) -> pa.RecordBatch:
        held.sort(key=lambda x: (x[0], x[1]))
        n = [len(x[2]) for x in held]
        doc, part = (np.repeat(np.array([x[i] for x in held], kind), n) for i, kind in ((0, np.int64), (1, np.int32)))
        m, h, at = (np.concatenate([x[i] for x in held]) for i in (2, 3, 4))
        order = np.argsort(h, kind="stable")
        again = np.zeros(len(h), bool)
        again[order[1:]] = (h[order[1:]] == h[order[:-1]]) & (m[order[1:]] == m[order[:-1]]) & ((doc[order[1:]] != doc[order[:-1]]) | (part[order[1:]] != part[order[:-1]]) | (at[order[1:]] != at[order[:-1]]))
        again[order[1:]] &= ~_same_as_first(order, h, m, doc, part, at)
        # Certain removals need no partner: deal them by their own place, or the copies of one piece would meet in one task.
        own = (doc.view(np.uint64) + np.uint64(1)) * np.uint64(_MULTIPLIER) ^ at.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        at, m = np.where(again, -at - 1, at), np.where(again, own ^ (own >> np.uint64(31)), m)
        return pa.record_batch([pa.array(m.view(np.int64)), pa.array(h.view(np.int64)), pa.array(doc), pa.array(part), pa.array(at)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for part, texts in text_runs(batches, "t"):
            for doc, tag, text in zip(part.column("doc").to_pylist(), part.column("part").to_pylist(), texts, strict=True):
                raw = text.encode("utf-8", "replace")
                if len(raw) < length:
                    continue
                m, start, n = pieces(raw, length)
                h = np.array([xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip(start.tolist(), (start + n + length - 1).tolist(), strict=True)], np.uint64)
                held.append((doc, tag, m, h, start << 8 | n))
                size += len(m)
                if size >= BLOCK:
                    yield collapse(held)
                    held, size = [], 0
        if held:
            yield collapse(held)

    return located.mapInArrow(run, "m bigint, h bigint, doc bigint, part int, at bigint")


def _same_as_first(order, h, m, doc, part, at) -> np.ndarray:
    """Along ``order``, from its second entry: does the entry repeat the very position that is first of its content?"""
    new = np.concatenate([[True], (h[order[1:]] != h[order[:-1]]) | (m[order[1:]] != m[order[:-1]])])
    first = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))][1:]
    own = order[1:]
    return (doc[own] == doc[first]) & (part[own] == part[first]) & (at[own] == at[first])


def _judge(cut: DataFrame) -> DataFrame:
    """From pieces sorted by anchor, content and place: ``removed`` pieces, and the others of anchors with several contents."""
    names = ["removed", "m", "doc", "part", "at"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # (m, h, doc, part, at, anchor seen before) of the latest first piece
        for batch in batches:
            m, h, doc, part, at = (batch.column(c).to_numpy() for c in ("m", "h", "doc", "part", "at"))
            sure = at < 0
            out = [(np.ones(int(sure.sum()), bool), m[sure], doc[sure], part[sure], -at[sure] - 1)]
            m, h, doc, part, at = (x[~sure] for x in (m, h, doc, part, at))
            known = 0
            if last is not None:
                m, h, doc, part, at = (np.concatenate([[v], x]).astype(x.dtype) for v, x in zip(last[:5], (m, h, doc, part, at), strict=True))
                known = 1
            if len(m):
                new = np.concatenate([[True], (m[1:] != m[:-1]) | (h[1:] != h[:-1])])
                first = np.maximum.accumulate(np.where(new, np.arange(len(m)), 0))
                again = ~new & ~((doc == doc[first]) & (part == part[first]) & (at == at[first]))
                out.append((np.ones(int(again.sum()), bool), m[again], doc[again], part[again], at[again]))
                reps = np.flatnonzero(new)
                before = np.concatenate([[bool(known and last[5])], m[reps[1:]] == m[reps[:-1]]])
                shared = before[:-1] | (m[reps[1:]] == m[reps[:-1]])
                ask = reps[:-1][shared]
                out.append((np.zeros(len(ask), bool), m[ask], doc[ask], part[ask], at[ask]))
                end = reps[-1]
                last = (m[end], h[end], doc[end], part[end], at[end], bool(before[-1]))
            yield pa.record_batch([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names=names)
        if last is not None and last[5]:
            yield pa.record_batch([pa.array([x], f.type) for x, f in zip((False, last[0], *last[2:5]), kinds, strict=True)], schema=kinds)

    kinds = pa.schema([("removed", pa.bool_()), ("m", pa.int64()), ("doc", pa.int64()), ("part", pa.int32()), ("at", pa.int64())])
    parts = max(int(cut.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    placed = cut.repartition(parts, "m").sortWithinPartitions("m", "h", "doc", "part", "at")
    return placed.mapInArrow(run, "removed boolean, m bigint, doc bigint, part int, at bigint")


def anchors_of(texts: list[bytes], hashes: np.ndarray) -> np.ndarray:
    """The place of the first gram with the anchor's hash in each piece."""
    anchors = np.empty(len(texts), np.int64)
    for at in range(0, len(texts), LAID):
        some = texts[at : at + LAID]
        grams, offset = gram_hashes(np.frombuffer(b"".join(some), np.uint8)), 0
        for i, (text, own) in enumerate(zip(some, hashes[at : at + LAID], strict=True), at):
            anchors[i] = np.argmax(grams[offset : offset + len(text) - GRAM + 1] == own)
            offset += len(text)
    return anchors


def column_wise(texts: list[bytes], anchors: np.ndarray, rank: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which windows of the pieces ``texts`` equal one of smaller ``rank``, and which are first of their content.

    ``anchors`` is the place of the anchor in each piece. Returns two arrays (pieces x columns) over window starts,
    removed and kept, and the column in which each piece begins.
    """
    n, left = len(texts), length - GRAM
    begin = left - anchors
    sizes = np.array([len(t) for t in texts])
    width = int((begin + sizes).max())
    symbols = np.zeros((width, n), np.uint16)  # column by column; 0: no symbol
    for at in range(0, n, LAID):
        own = sizes[at : at + LAID]
        flat = np.frombuffer(b"".join(texts[at : at + LAID]), np.uint8).astype(np.uint16) + 1
        row = np.repeat(np.arange(at, at + len(own)), own)
        symbols[np.arange(len(flat)) - np.repeat(np.cumsum(own) - own, own) + begin[row], row] = flat
    removed, kept = np.zeros((n, left + 1), bool), np.zeros((n, left + 1), bool)
    order, common = np.arange(n), np.zeros(n + 1, np.int32)  # common[k]: prefix shared by order[k - 1] and order[k]
    for column in range(width - 1, -1, -1):
        inserted = symbols[column][order]
        moved = np.argsort(inserted, kind="stable")
        order, inserted = order[moved], inserted[moved]
        shared = np.minimum.reduceat(common, moved + 1)[:-1] + 1
        shared[(inserted[1:] != inserted[:-1]) | (inserted[1:] == 0)] = 0
        common = np.concatenate([[0], shared, [0]]).astype(np.int32)
        if column > left:
            continue
        opens = np.flatnonzero(common[:-1] < length)
        least = np.repeat(np.minimum.reduceat(rank[order], opens), np.diff(np.append(opens, n)))
        whole = (begin[order] <= column) & (column + length <= (begin + sizes)[order])
        removed[order, column] = whole & (rank[order] > least)
        kept[order, column] = whole & (rank[order] == least)
    return removed, kept, begin


def _shared_windows(asked: DataFrame, located: DataFrame, length: int, bucket: int, split: int) -> DataFrame:
    """Spans (``doc``, ``part``, ``start``, ``size``) of windows in the asked pieces that also start earlier."""
    total = asked.count()
    buckets = max(-(-total // bucket), 1)
    many = asked.groupBy("m").agg(F.count("*").alias("n")).where(F.col("n") > split).withColumn("salts", F.ceil(F.col("n") / bucket))
    dealt = asked.join(many, "m", "left").withColumn("hot", F.col("n").isNotNull())
    salt = F.pmod(F.xxhash64("doc", "part", "at"), F.col("salts"))
    dealt = dealt.withColumn("bucket", F.when(F.col("hot"), F.xxhash64("m", salt)).otherwise(F.pmod(F.xxhash64("m"), F.lit(buckets))))
    per_doc = dealt.groupBy("doc", "part").agg(F.collect_list(F.struct("bucket", "hot", "m", "at")).alias("asked"))
    fetched = located.join(per_doc, ["doc", "part"])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_runs(batches, "t"):
            out = []
            for doc, tag, text, asked in zip(part.column("doc").to_pylist(), part.column("part").to_pylist(), texts, part.column("asked").to_pylist(), strict=True):
                raw = text.encode("utf-8", "replace")
                for a in asked:
                    start, n = a["at"] >> 8, a["at"] & 255
                    out.append((a["bucket"], a["hot"], a["m"], doc, tag, start, raw[start : start + n + length - 1]))
            if out:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), asked_of, strict=True)], schema=asked_of)

    asked_of = pa.schema([("bucket", pa.int64()), ("hot", pa.bool_()), ("m", pa.int64()), ("doc", pa.int64()), ("part", pa.int32()), ("start", pa.int64()), ("piece", pa.binary())])
    got = fetched.mapInArrow(fetch, "bucket bigint, hot boolean, m bigint, doc bigint, part int, start bigint, piece binary")

    spans_of = pa.schema([("doc", pa.int64()), ("part", pa.int32()), ("start", pa.int64()), ("size", pa.int64()), ("digest", pa.binary())])

    def build(rows: pa.Table) -> pa.Table:
        texts = rows.column("piece").to_pylist()
        m, doc, part, start = (rows.column(c).to_numpy() for c in ("m", "doc", "part", "start"))
        anchors = anchors_of(texts, m.view(np.uint64))
        by_place = np.lexsort((start + anchors, part, doc))
        d, p, s = doc[by_place], part[by_place], (start + anchors)[by_place]
        rank = np.empty(len(texts), np.int64)
        rank[by_place] = np.concatenate([[0], np.cumsum((d[1:] != d[:-1]) | (p[1:] != p[:-1]) | (s[1:] != s[:-1]))])
        removed, kept, begin = column_wise(texts, anchors, rank, length)
        edge = np.diff(np.pad(removed, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        row, first = np.nonzero(edge == 1)
        stop = np.nonzero(edge == -1)[1]
        at, size = start[row] + first - begin[row], stop - first + length - 1
        columns = [doc[row], part[row], at, size, pa.nulls(len(row), pa.binary())]
        hot = rows.column("hot").to_numpy()
        if hot.any():  # windows of an anchor dealt over several buckets meet again by their digest
            row, first = np.nonzero(kept & hot[:, None])
            at = first - begin[row]
            seen = [xxhash.xxh3_128_digest(texts[r][a : a + length]) for r, a in zip(row.tolist(), at.tolist(), strict=True)]
            more = [doc[row], part[row], start[row] + at, np.full(len(row), length), pa.array(seen, pa.binary())]
            columns = [pa.concat_arrays([pa.array(x), pa.array(y)]) for x, y in zip(columns, more, strict=True)]
        return pa.table([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], schema=spans_of)

    found = stage(got.groupBy("bucket").applyInArrow(build, "doc bigint, part int, start bigint, size bigint, digest binary"), "windows")
    again = found.where("digest IS NOT NULL").withColumn("least", F.min(F.struct("doc", "part", "start")).over(Window.partitionBy("digest")))
    later = again.where(F.struct("doc", "part", "start") > F.col("least"))
    return found.where("digest IS NULL").drop("digest").union(later.select("doc", "part", "start", "size"))


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, bucket: int = BUCKET, split: int = SPLIT) -> DataFrame:
    """Byte spans ``doc``, ``part``, ``start``, ``size`` to remove; they may overlap."""
    located = _located(docs, key, text)
    judged = stage(_judge(_cut(located, length)), "pieces")
    whole = judged.where("removed").select("doc", "part", F.shiftright("at", 8).alias("start"), (F.col("at").bitwiseAND(255) + (length - 1)).alias("size"))
    return whole.union(_shared_windows(judged.where("NOT removed").drop("removed"), located, length, bucket, split))


ADDED = ["_n_bytes", "_n_removed", "_n_spans", "_kept"]


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, bucket: int = BUCKET, split: int = SPLIT,
) -> DataFrame:
    """All columns of ``docs`` with ``_n_bytes``, ``_n_removed``, ``_n_spans``, ``_kept`` (the remaining bytes) added.

    ``key`` is a whole number. NULL and empty texts have no bytes; texts shorter than ``length`` keep all. Of equal strings
    the one with the smallest key, then the smallest start, stays. A NULL key counts as the smallest. Rows that repeat key
    and text are the same document and share their result; different texts of one key are told apart by a hash. Columns of
    ``docs`` that have the names of the added ones are replaced.
    """
    docs = docs.drop(*ADDED)
    at, part_of, found = unused(docs, "_doc", "_part", "_spans")
    spans = repeated_spans(docs, key, text, length, bucket, split)
    per_doc = spans.groupBy("doc", "part").agg(F.collect_list(F.struct("start", "size")).alias(found))
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.withColumns({at: F.coalesce(F.col(key).cast("long"), F.lit(NO_KEY)), part_of: F.hash(body)})
    joined = rows.join(per_doc.withColumnsRenamed({"doc": at, "part": part_of}), [at, part_of], "left").drop(at, part_of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_runs(batches, text):
            out = []
            for body, spans in zip(texts, part.column(found), strict=True):
                raw = (body or "").encode("utf-8", "replace")
                if not spans.is_valid or not len(spans):
                    out.append((len(raw), 0, 0, raw))
                    continue
                inside = spans.values
                start, size = (pc.struct_field(inside, c).to_numpy() for c in ("start", "size"))
                edge = np.bincount(start, minlength=len(raw) + 1) - np.bincount(start + size, minlength=len(raw) + 1)
                gone = np.cumsum(edge)[: len(raw)] > 0
                runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                out.append((len(raw), int(gone.sum()), runs, np.frombuffer(raw, np.uint8)[~gone].tobytes()))
            part = part.drop_columns([found])
            added = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)]
            yield pa.record_batch([*part.columns, *added], names=[*part.schema.names, *ADDED])

    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return joined.mapInArrow(run, f"{shape}, _n_bytes bigint, _n_removed bigint, _n_spans bigint, _kept binary")


# Whole UTF-8 characters (kept as group 1) and bytes that begin none, each byte read as one character of ISO 8859-1.
_CHARACTERS = (
    r"([\x00-\x7F]++|[\xC2-\xDF][\x80-\xBF]|\xE0[\xA0-\xBF][\x80-\xBF]|[\xE1-\xEC\xEE\xEF][\x80-\xBF]{2}|\xED[\x80-\x9F][\x80-\xBF]"
    r"|\xF0[\x90-\xBF][\x80-\xBF]{2}|[\xF1-\xF3][\x80-\xBF]{3}|\xF4[\x80-\x8F][\x80-\xBF]{2})|[\x80-\xFF]"
)


def kept_text(removed: DataFrame) -> DataFrame:
    """The result of :func:`remove_repeats` with ``_kept_text``: characters that lost only some of their bytes go whole.

    No Python pass: two in one task would hold twice the workers and copies of the texts.
    """
    kept = F.col("_kept")
    whole = F.encode(F.regexp_replace(F.decode(kept, "ISO-8859-1"), _CHARACTERS, "$1"), "ISO-8859-1")
    text = F.when(F.is_valid_utf8(kept.cast("string")), kept.cast("string")).otherwise(whole.cast("string"))
    return removed.drop("_kept_text").withColumn("_kept_text", text)
