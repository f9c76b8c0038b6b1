"""Zstandard-compressed WARC archives: a writer with revisit records, and a reader.

An archive is one ``.warc.zst`` stream: a leading skippable frame that holds a dictionary, then one Zstandard frame per
record, compressed with it. Spark's text writer puts the frames into files, so that commits, retries and the target
file system are Spark's own; its line separator is an empty skippable frame, which decoders ignore.

Defined cases: a null text is an empty payload; a null id is written as an empty record id, never as a revisit; rows
that share the smallest id and payload are all responses; a null URL is an empty URI; control characters in a URL are
percent-encoded; extra columns are ignored; an empty table writes no record and reads as no row.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.registry import query, table
from tidemark.plans.staging import staged_path

#: Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE_MAGICS = range(0x184D2A50, 0x184D2A60)
FRAME_MAGIC = 0xFD2FB528
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: An empty skippable frame; all of its bytes are ASCII, so it can separate "lines".
SEPARATOR = struct.pack("<II", 0x184D2A50, 0).decode("ascii")

DICTIONARY_BYTES = 32_768
#: The dictionary of an archive is trained on its first records, up to this many bytes.
TRAINING_BYTES = 2_000_000
LEVEL = 3

RECORD = (
    "archive string, position bigint, record_id string, record_type string, uri string, payload_bytes bigint, "
    "payload_digest string, refers_to string, error string"
)


# --------------------------------------------------------------------------- writing


def with_revisits(pages: DataFrame, least_bytes: int = 100) -> DataFrame:
    """page_id, url, payload, payload_digest and refers_to, the id of the first page with the same large payload.

    Equal payloads meet as digests, pre-aggregated; the payloads themselves are joined by page, which no copy skews.
    """
    rows = pages.select("page_id", "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("payload_digest", F.sha2("payload", 256))
    keys = rows.filter(F.octet_length("payload") >= least_bytes).select("page_id", "payload_digest")
    firsts = (
        keys.groupBy("payload_digest")
        .agg(F.min("page_id").alias("refers_to"), F.count("*").alias("pages"))
        .filter("pages > 1")
        .drop("pages")
    )
    revisits = keys.join(firsts, "payload_digest").filter("page_id > refers_to").distinct()
    return rows.join(revisits, ["page_id", "payload_digest"], "left")


def _clean(value: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def _record(page_id, url: str, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = [
        VERSION,
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {_clean(url)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict:
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, records)
    except zstandard.ZstdError:  # too few or too short records to train on: their bytes are the dictionary
        raw = (b"".join(records) or VERSION.encode())[-DICTIONARY_BYTES:].rjust(8, b" ")
        return zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def _frames(records: Iterator[bytes]) -> Iterator[bytes]:
    """The frames of one archive, the dictionary's first."""
    held, size = [], 0
    for record in records:
        held.append(record)
        size += len(record)
        if size >= TRAINING_BYTES:
            break
    if not held:
        return
    trained = _dictionary(held)
    stored = trained.as_bytes()
    yield struct.pack("<II", DICTIONARY_MAGIC, len(stored)) + stored
    packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_checksum=True, write_content_size=True)
    yield from map(packer.compress, held)
    held.clear()
    yield from map(packer.compress, records)


def write_archives(pages: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write one archive per partition of ``pages`` (as ``with_revisits`` returns them)."""

    def frames(batches):
        def records():
            for batch in batches:
                for row in batch.to_pylist():
                    yield _record(
                        row["page_id"], row["url"] or "", row["payload"], row["payload_digest"], row["refers_to"], date
                    )

        import pyarrow as pa

        held, size = [], 0
        for frame in _frames(records()):
            held.append(frame)
            size += len(frame)
            if size >= 1_000_000:
                yield pa.record_batch([pa.array(held, pa.binary())], names=["frame"])
                held, size = [], 0
        if held:
            yield pa.record_batch([pa.array(held, pa.binary())], names=["frame"])

    columns = pages.select("page_id", "url", "payload", "payload_digest", "refers_to")
    stream = columns.mapInArrow(frames, "frame binary").select(F.col("frame").cast("string").alias("value"))
    stream.write.option("lineSep", SEPARATOR).text(path)


# --------------------------------------------------------------------------- reading


def frame_end(data, at: int) -> int:
    """Where the Zstandard frame that begins at ``at`` ends."""
    header = zstandard.get_frame_parameters(data[at : at + 18])
    at += zstandard.frame_header_size(data[at : at + 18])
    last = False
    while not last:
        if at + 3 > len(data):
            raise ValueError("a frame is cut off")
        block = int.from_bytes(data[at : at + 3], "little")
        last = bool(block & 1)
        at += 3 + (1 if block >> 1 & 3 == 1 else block >> 3)  # a run block stores one byte
    at += 4 * header.has_checksum
    if at > len(data):
        raise ValueError("a frame is cut off")
    return at


def archive_records(data) -> Iterator[tuple[int, bytes]]:
    """(position, record) for each frame of an archive."""
    data, at, reader = memoryview(data), 0, None
    while at < len(data):
        if at + 8 > len(data):
            raise ValueError("the archive ends inside a frame")
        magic, size = struct.unpack_from("<II", data, at)
        if magic in SKIPPABLE_MAGICS:
            if at + 8 + size > len(data):
                raise ValueError("a skippable frame is cut off")
            if magic == DICTIONARY_MAGIC and at == 0:
                content = bytes(data[8 : 8 + size])
                if content[:4] == struct.pack("<I", FRAME_MAGIC):  # a dictionary may itself be compressed
                    content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
                reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content))
            at += 8 + size
            continue
        if magic != FRAME_MAGIC:
            raise ValueError(f"no frame begins at {at}")
        reader = reader or zstandard.ZstdDecompressor()
        end = frame_end(data, at)
        yield at, reader.decompressobj().decompress(data[at:end])
        at = end


def _headers(block: bytes) -> tuple[str, dict[str, str], int]:
    """First line, fields by lower-case name, and where the body begins."""
    end = block.find(b"\r\n\r\n")
    if end < 0:
        raise ValueError("the header does not end")
    first, *lines = block[:end].decode("utf-8").split("\r\n")
    fields = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon:
            raise ValueError("a header line has no colon")
        fields[name.strip().lower()] = value.strip()
    return first, fields, end + 4


def parse_record(record: bytes) -> dict:
    """The fields of one record; a ValueError or KeyError says what is wrong with it."""
    version, head, body = _headers(record)
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    kind, length = head["warc-type"], int(head["content-length"])
    if kind not in ("response", "revisit"):
        raise ValueError(f"unknown record type {kind}")
    if len(record) != body + length + 4 or record[-4:] != b"\r\n\r\n":
        raise ValueError("the record is not as long as its header says")
    status, http, at = _headers(record[body : body + length])
    if not status.startswith("HTTP/"):
        raise ValueError("no HTTP response in the record")
    payload, full = record[body + at : body + length], int(http["content-length"])
    name, _, digest = head["warc-payload-digest"].partition(":")
    if name != "sha256":
        raise ValueError(f"unknown digest {name}")
    if kind == "response" and (len(payload) != full or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError("the payload does not fit its length or digest")
    if kind == "revisit" and payload:
        raise ValueError("a revisit has a payload")
    unwrap = lambda v: v.removeprefix("<urn:page:").removesuffix(">")
    return {
        "record_id": unwrap(head["warc-record-id"]),
        "record_type": kind,
        "uri": head["warc-target-uri"],
        "payload_bytes": full,
        "payload_digest": digest,
        "refers_to": unwrap(head["warc-refers-to"]) if kind == "revisit" else None,
        "payload": payload if kind == "response" else None,
    }


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record of the archives under ``path``; ``error`` says why a record or the rest of a file is bad.

    ``payloads=False`` leaves out the payload column, whose length and digest are validated all the same.
    """
    schema = RECORD + (", payload binary" if payloads else "")
    names = [field.split()[0] for field in schema.split(", ")]

    def records(batches):
        for batch in batches:
            for name, data in zip(batch["path"], batch["content"]):
                rows, size, at = [], 0, 0
                stream = archive_records(data)
                while True:
                    row = dict.fromkeys(names) | {"archive": name, "position": at}
                    try:
                        at, record = next(stream)
                        row |= {"position": at, **parse_record(record)}
                    except StopIteration:
                        break
                    except (ValueError, KeyError, zstandard.ZstdError) as wrong:
                        row["error"] = f"{type(wrong).__name__}: {wrong}"
                    rows.append(row)
                    size += len(row.get("payload") or b"") if payloads else 200
                    if size >= 4_000_000:
                        yield pd.DataFrame(rows, columns=names)
                        rows, size = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=names)

    files = spark.read.format("binaryFile").load(path).filter("length > 0").select("path", "content")
    return files.mapInPandas(records, schema)


# --------------------------------------------------------------------------- query

SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS payload_bytes, sha256(b) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id > first THEN first END AS refers_to
FROM f
"""


@query("op9_warc_archives", SQL)
def archives(spark: SparkSession, folder: str) -> DataFrame:
    """Every page written to archives and read back from them; a bad record fails the query."""
    path = staged_path(spark, "warc")
    write_archives(with_revisits(table(spark, folder, "pages")), path)
    rows = read_archives(spark, path, payloads=False)
    checked = F.when(F.col("error").isNotNull(), F.raise_error(F.col("error"))).otherwise(F.col("record_type"))
    return rows.select(
        F.expr("try_cast(record_id AS bigint)").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        checked.cast("string").alias("record_type"),
        F.col("refers_to").cast("bigint").alias("refers_to"),
    )
