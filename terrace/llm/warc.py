"""Dictionary-compressed WARC archives.

Each archive is one ``.warc.zst`` file of bounded size: a leading skippable frame with a Zstandard dictionary built from the
archived records, then every record as a frame of its own. Archives travel as rows (name, content), so that Spark's own
writers put them wherever the cluster stores its tables.
"""

from __future__ import annotations

import hashlib
import io
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import salted_left_join, text_runs

# Fixed values of the formats.
SKIPPABLE = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EOL = "\r\n"

ARCHIVE_BYTES = 4 << 20  # record bytes per archive: what a task holds of one, and a row of the archive table is no larger
DICTIONARY_BYTES = 32 << 10
TRAINING_BYTES = 1 << 20  # records that a dictionary is trained on, evenly spread over the archive
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"


def _headers(kind: str, fields: list[tuple[str, str | None]], size: int) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in fields if v is not None), f"Content-Length: {size}"]
    return (EOL.join(lines) + EOL * 2).encode()


def _safe(value: str) -> str:
    """Control characters percent-encoded, so that a field stays on its line."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in value) if not value.isprintable() else value


def record(key: str | None, url: str | None, date: str, payload: bytes | None, size: int, digest: str, refers_to: str | None) -> bytes:
    """One response (with its payload) or revisit (``refers_to``: HTTP headers only)."""
    http = f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}Content-Length: {size}{EOL * 2}".encode()
    block = http if refers_to is not None else http + (payload or b"")
    names = [
        ("WARC-Record-ID", f"<urn:record:{_safe(key) if key is not None else ''}>"), ("WARC-Date", date), ("WARC-Target-URI", _safe(url) if url is not None else None),
        ("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http; msgtype=response"),
        ("Record-Key", _safe(key) if key is not None else None),
    ]
    if refers_to is not None:
        names += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:record:{_safe(refers_to)}>")]
    return _headers("response" if refers_to is None else "revisit", names, len(block)) + block + (EOL * 2).encode()


def dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict:
    """A dictionary trained on an even spread of the records; where they are too few to train on, their own bytes."""
    step = max(1, -(-sum(map(len, records)) // TRAINING_BYTES))
    samples = [r[: 64 << 10] for r in records[::step]]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(samples)[-DICTIONARY_BYTES:], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def pack(records: list[bytes], name: str, date: str = DATE) -> bytes:
    """A whole archive file."""
    info = f"software: terrace{EOL}format: WARC File Format 1.1{EOL}".encode()
    first = _headers("warcinfo", [("WARC-Record-ID", f"<urn:archive:{name}>"), ("WARC-Date", date), ("WARC-Filename", name), ("Content-Type", "application/warc-fields")], len(info))
    shared = dictionary(records)
    compress = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared).compress
    raw = shared.as_bytes()
    return b"".join([struct.pack("<II", SKIPPABLE, len(raw)), raw, compress(first + info + (EOL * 2).encode()), *map(compress, records)])


def unpack(content: bytes | memoryview) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (lower-case names, ``type`` included) and block of each record of an archive file.

    The file is read where it lies, record by record: nothing but the record at hand is copied.
    """
    at, shared, view = 0, None, memoryview(content)
    if len(view) >= 8 and (found := struct.unpack_from("<II", view))[0] == SKIPPABLE:
        at = 8 + found[1]
        shared = zstandard.ZstdCompressionDict(bytes(view[8:at]))
    opened = zstandard.ZstdDecompressor(dict_data=shared).stream_reader(view[at:], read_across_frames=True)
    stream = io.BufferedReader(opened, 1 << 16)
    while stream.readline():
        fields = {}
        while line := stream.readline().rstrip(b"\r\n"):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.lower()] = value.strip()
        block = stream.read(int(fields["content-length"]))
        stream.read(4)
        yield fields, block


def write(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", least: int = 100, date: str = DATE) -> DataFrame:
    """Archives of one record per row: ``name``, ``records`` (their number), ``content`` (the file's bytes).

    The payload is the UTF-8 text, empty for NULL. Of the rows with equal payloads of at least ``least`` bytes those with
    the smallest key are responses, the others revisit it; a row with a NULL key is a revisit where its payload has a
    keyed row, and a response otherwise. Repeated rows each get a record. An empty table gives no archive.
    """
    body = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(key).alias("k"), F.col(url).alias("u"), body.alias("h"), F.sha2(body, 256).alias("d"), F.octet_length(body).alias("n"))
    digests = rows.where(F.col("n") >= least).groupBy("d").agg(F.min("k").alias("first"), F.count("*").alias("copies"))
    joined = salted_left_join(rows, digests.where("copies > 1").select("d", "first"), "d", "k")
    refers = F.when(~F.col("first").eqNullSafe(F.col("k")), F.col("first").cast("string"))
    final = joined.select(F.col("k").cast("string").alias("k"), "u", "d", "n", refers.alias("first"), F.when(refers.isNull(), F.col("h")).alias("h"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records, size = [], 0

        def close() -> pa.RecordBatch:
            name = f"{uuid.uuid4().hex}.warc.zst"
            return pa.record_batch([pa.array([name]), pa.array([len(records)], pa.int64()), pa.array([pack(records, name, date)], pa.binary())], names=["name", "records", "content"])

        for part, htmls in text_runs(batches, "h"):
            rest = (part.column(c).to_pylist() for c in ("k", "u", "d", "n", "first"))
            for k, u, d, n, first, h in zip(*rest, htmls, strict=True):
                records.append(record(k, u, date, None if h is None else h.encode(), n, d, first))
                size += len(records[-1])
                if size >= ARCHIVE_BYTES:
                    yield close()
                    records, size = [], 0
        if records:
            yield close()

    return final.mapInArrow(run, "name string, records bigint, content binary")


def read(archives: DataFrame, content: str = "content") -> DataFrame:
    """One row per response or revisit record of the archive files in ``content``; NULL contents hold no record.

    ``record_key``, ``url``, ``record_type``, ``refers_to``, ``payload_bytes`` and ``payload_digest`` (both as stated in the
    record, of the full payload), ``payload`` (NULL for revisits).
    """
    names = ["record_key", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]
    kinds = pa.schema([(n, pa.int64() if n == "payload_bytes" else pa.binary() if n == "payload" else pa.string()) for n in names])

    def rows(content: memoryview) -> Iterator[tuple]:
        for fields, block in unpack(content):
            kind = fields["warc-type"]
            if kind not in ("response", "revisit"):
                continue
            http, _, payload = block.partition(b"\r\n\r\n")
            stated = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
            digest = fields["warc-payload-digest"].removeprefix("sha256:")
            if kind == "response" and (len(payload) != stated or hashlib.sha256(payload).hexdigest() != digest):
                raise ValueError(f"damaged record {fields['warc-record-id']}")
            refers = fields.get("warc-refers-to")
            refers = refers and refers.removeprefix("<urn:record:").removesuffix(">")
            yield fields.get("record-key"), fields.get("warc-target-uri"), kind, refers, stated, digest, payload if kind == "response" else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for found in batch.column(0):
                held, size = [], 0
                for row in rows(memoryview(found.as_buffer())) if found.is_valid and found.as_buffer().size else ():
                    held.append(row)
                    size += row[4]
                    if size >= 4 << 20:
                        yield pa.record_batch([list(c) for c in zip(*held, strict=True)], schema=kinds)
                        held, size = [], 0
                if held:
                    yield pa.record_batch([list(c) for c in zip(*held, strict=True)], schema=kinds)

    schema = ", ".join(f"{n} {'bigint' if n == 'payload_bytes' else 'binary' if n == 'payload' else 'string'}" for n in names)
    return archives.select(F.col(content).alias("content")).mapInArrow(run, schema)
