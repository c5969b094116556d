"""WARC archives with Zstandard: a dictionary in a leading skippable frame, then a frame a record.

Writing: pages with equal payloads are found by SHA-1 over the whole table; the one with the largest
page_id becomes a response record, the others revisit it.  Pages are packed into blocks first; digests
and decisions travel, payloads are read where their records are written.  Each task writes archives of
bounded size into a folder that all machines see, through Arrow's file systems, under names that no
other attempt uses; the manifest holds the names of finished archives, so files of lost tasks are
ignored.

Reading: the dictionary comes from the leading skippable frame (which may itself be compressed);
then one frame per record is decoded, and headers, lengths and digests are validated.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listweave.llm.blocks import asked_rows, described, packed, read_all
from listweave.llm.common import arrow_limits, qualified, scratch, storage, text_bytes, written

# Fixed values of the formats.
DICTIONARY_FRAME = 0x184D2A5D
ZSTD_MAGIC = 0xFD2FB528
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http; msgtype=response"

#: Uncompressed bytes of an archive, about; and what its dictionary is built from.
ARCHIVE_BYTES, SAMPLE_RECORDS, SAMPLE_BYTES, DICTIONARY_BYTES = 16_000_000, 200, 400_000, 16_384
LEVEL = 3
#: Date of all records, so that equal input gives equal archives.
DATE = "2024-01-01T00:00:00Z"


class WarcError(ValueError):
    """A record or archive that breaks the format."""


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(name: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"


def _clean(value: str) -> str:
    """A header value on one line: control characters are percent-encoded."""
    return "".join(f"%{ord(c):02X}" if c < " " or c == "\x7f" else c for c in value)


def build_record(page_id: int | None, url: str | None, payload: bytes | None, size: int, digest: str, refers_to: int | None) -> bytes:
    """One record; ``payload`` None makes a revisit, whose block keeps the HTTP header only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload or b"")
    fields = [
        ("WARC-Type", "response" if payload is not None else "revisit"),
        ("WARC-Record-ID", record_id(f"page:{page_id}:{digest}")),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"),
        ("Content-Type", HTTP_TYPE),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", _clean(url)))
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if payload is None:
        fields += [
            ("WARC-Profile", REVISIT_PROFILE),
            ("WARC-Refers-To", record_id(f"page:{refers_to}:{digest}")),
            ("X-Refers-To-Page-ID", str(refers_to)),
        ]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return f"{VERSION}\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


@dataclass
class Record:
    fields: dict[str, str]
    block: bytes

    @property
    def http(self) -> tuple[dict[str, str], bytes]:
        head, gap, payload = self.block.partition(b"\r\n\r\n")
        if not gap or not head.startswith(b"HTTP/"):
            raise WarcError("the block holds no HTTP header")
        lines = head.decode("utf-8").split("\r\n")[1:]
        return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}, payload


def parse_record(data: bytes) -> Record:
    """One record from its frame's bytes; raises WarcError if version, headers, lengths or digests are off."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not gap or lines[0] != VERSION:
        raise WarcError(f"not a {VERSION} record")
    fields: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name or name.strip() != name:
            raise WarcError(f"bad header line {line!r}")
        if name.lower() in fields:
            raise WarcError(f"header {name} comes twice")
        fields[name.lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if not fields.get(name):
            raise WarcError(f"header {name} is missing")
    if not fields["content-length"].isdigit() or len(rest) != int(fields["content-length"]) + 4:
        raise WarcError("Content-Length is not the length of the block")
    if rest[-4:] != b"\r\n\r\n":
        raise WarcError("the record does not end with two line ends")
    record = Record(fields, rest[:-4])
    digest = fields.get("warc-block-digest")
    if digest and digest != f"sha1:{sha1_base32(record.block)}":
        raise WarcError("the block does not have its digest")
    if fields["warc-type"] == "response":
        http, payload = record.http
        if "content-length" in http and int(http["content-length"]) != len(payload):
            raise WarcError("the HTTP length is not the length of the payload")
        if fields.get("warc-payload-digest") not in (None, f"sha1:{sha1_base32(payload)}"):
            raise WarcError("the payload does not have its digest")
    return record


def train_dictionary(records: list[bytes]) -> bytes:
    """Dictionary from the first records, bounded in number and bytes; empty where training is not possible."""
    sample, held = [], 0
    for r in records[:SAMPLE_RECORDS]:
        r = r[:16_384]
        if held + len(r) > SAMPLE_BYTES:
            break
        sample.append(r)
        held += len(r)
    if len(sample) < 8:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sample, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b""


def write_archive(records: list[bytes]) -> bytes:
    trained = train_dictionary(records)
    out = []
    if trained:
        packed = zstandard.ZstdCompressor(level=19).compress(trained)
        out.append(struct.pack("<II", DICTIONARY_FRAME, len(packed)) + packed)
        engine = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(trained), write_checksum=True)
    else:
        engine = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
    out += [engine.compress(r) for r in records]
    return b"".join(out)


def read_archive(data: bytes) -> Iterator[Record]:
    """The records of an archive, a frame each; raises WarcError if it is cut short or malformed."""
    at, trained = 0, None
    if len(data) >= 8 and struct.unpack_from("<I", data)[0] == DICTIONARY_FRAME:
        size = struct.unpack_from("<I", data, 4)[0]
        raw = data[8 : 8 + size]
        if len(raw) != size:
            raise WarcError("the dictionary frame is cut short")
        at = 8 + size
        if len(raw) >= 4 and struct.unpack_from("<I", raw)[0] == ZSTD_MAGIC:
            raw = zstandard.ZstdDecompressor().decompress(raw)
        trained = zstandard.ZstdCompressionDict(raw)
    engine = zstandard.ZstdDecompressor(dict_data=trained) if trained else zstandard.ZstdDecompressor()
    view = memoryview(data)
    while at < len(data):
        one = engine.decompressobj()
        try:
            # feed growing windows: a frame is far smaller than the rest of the archive
            parts, step = [], 1 << 16
            pos = at
            while not one.eof and pos < len(data):
                parts.append(one.decompress(view[pos : pos + step]))
                pos += step
                step *= 2
        except zstandard.ZstdError as e:
            raise WarcError(f"bad frame at byte {at}: {e}") from e
        if not one.eof:
            raise WarcError(f"the frame at byte {at} is cut short")
        at = min(pos, len(data)) - len(one.unused_data)
        yield parse_record(b"".join(parts))


def write_pages(pages: DataFrame, folder: str) -> DataFrame:
    """Write every row of ``pages`` as a record into archives under ``folder``; returns the manifest.

    A null html is an empty payload and a null url no target.  Of rows with equal payloads those of
    the largest page_id are responses and the others revisit it; a row with a null page_id is a
    response, which none refers to.  Whole payloads count, however long; an empty table writes no
    archive; further columns, whatever their names, are left.
    """
    spark = pages.sparkSession
    arrow_limits(spark)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    blocks = packed(rows, "warc-pages")

    def digests(batch: pa.RecordBatch) -> dict:
        return {"page_id": batch.column(0), "sha1": [hashlib.sha1(x).digest() for x in text_bytes(batch, "html")]}

    own = written(described(blocks, rows.columns, "page_id long, sha1 binary", digests), "warc-digests")
    kept = own.groupBy("sha1").agg(F.max("page_id").alias("keeper"))
    response = F.col("page_id").isNull() | (F.col("page_id") == F.col("keeper"))
    choice = own.join(kept, "sha1").select("block", "row", "sha1", F.when(~response, F.col("keeper")).alias("refers_to"))
    base = qualified(spark, folder)

    def save(records: list[bytes]) -> pa.RecordBatch:
        system, path = storage(base)
        name = f"{uuid.uuid4().hex}.warc.zst"
        data = write_archive(records)
        system.create_dir(path, recursive=True)
        with system.open_output_stream(f"{path}/{name}", compression=None) as out:
            out.write(data)
        return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([len(records)], pa.int64()), pa.array([len(data)], pa.int64())], names=["name", "records", "bytes"])

    def write(batches: Iterator[tuple[dict, pa.RecordBatch]]) -> Iterator[pa.RecordBatch]:
        records: list[bytes] = []
        held = 0
        for asked, rows in batches:
            payloads = text_bytes(rows, rows.schema.names[2])
            for a in asked["asked"].as_py():
                at, refers_to = a["row"], a["refers_to"]
                digest = base64.b32encode(a["sha1"]).decode()
                payload = payloads[at] if refers_to is None else None
                records.append(build_record(rows.column(0)[at].as_py(), rows.column(1)[at].as_py(), payload, len(payloads[at]), digest, refers_to))
                held += len(records[-1])
                if held >= ARCHIVE_BYTES:
                    yield save(records)
                    records, held = [], 0
        if records:
            yield save(records)

    return written(read_all(asked_rows(blocks, choice, "sha1", "refers_to"), "name string, records long, bytes long", write), "warc-manifest")


def read_pages(manifest: DataFrame, folder: str) -> DataFrame:
    """A row per record of the archives in ``manifest``, validated.

    Columns page_id, url, payload_bytes, payload_digest, record_type, refers_to and payload (null for
    revisits).  A malformed archive fails the job.
    """
    spark = manifest.sparkSession
    arrow_limits(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    files = files.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("content"))
    kind = pa.schema([
        ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
    ])

    def number(value: str | None) -> int | None:
        return None if value is None else int(value)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                rows: list[tuple] = []
                held = 0
                for r in read_archive(data.as_py()):
                    http, payload = r.http
                    f, response = r.fields, r.fields["warc-type"] == "response"
                    size = len(payload) if response else int(http["content-length"])
                    rows.append((number(f.get("x-page-id")), f.get("warc-target-uri"), size, f["warc-payload-digest"].removeprefix("sha1:"), f["warc-type"], number(f.get("x-refers-to-page-id")), payload if response else None))
                    held += len(payload)
                    if held > 4_000_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, x.type) for c, x in zip(zip(*rows, strict=True), kind, strict=True)], schema=kind)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, x.type) for c, x in zip(zip(*rows, strict=True), kind, strict=True)], schema=kind)

    listed = files.join(manifest.select("name"), "name", "left_semi").select("content")
    return listed.mapInArrow(read, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")


def round_trip(pages: DataFrame) -> DataFrame:
    """Archive ``pages`` in the shared folder and read the archives back."""
    spark = pages.sparkSession
    folder = scratch(spark, "warc")
    manifest = write_pages(pages, folder)
    if manifest.isEmpty():
        return spark.createDataFrame([], "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")
    return read_pages(manifest, folder)
