"""WARC archives in seekable Zstandard bundles.

Records are grouped into frames that are compressed alone; a bundle is a run of frames with
a seek table as its footer, in the public seekable format: a skippable frame with the
compressed size, the plain size and a checksum of every frame. Any Zstandard reader gives
the whole WARC file. An index maps each record to its bundle, the frame's place in it and the
record's place in the plain frame, so one record costs the read of one frame.

Bundles are files named by the attempt that wrote them, the index is a table that Spark
commits: what a lost or repeated attempt left behind is in no index and is never read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Plain bytes after which a frame is closed. A longer record is a frame of its own.
FRAME_BYTES = 1 << 20
#: Compressed bytes after which a bundle is closed.
BUNDLE_BYTES = 64 << 20
#: Rows of equal payload that one task meets at most, about.
ROWS_PER_SALT = 100_000
LEAST_SALTS = 64

# Fixed values of the formats.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80
REVISIT_PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RESPONSE, REVISIT = "response", "revisit"

_INDEX = ("page_id long, record_type string, refers_to long, bundle string, frame_start long, frame_bytes long, "
          "at long, bytes long")
_READ = ("page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, "
         "payload binary")


@dataclass(frozen=True)
class Archive:
    """An archive below `folder`, which all executors see."""

    folder: str

    @property
    def bundles(self) -> str:
        return f"{self.folder}/bundles"

    def index(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(_INDEX).parquet(f"{self.folder}/index")


def _files(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", folder))


def typed(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, digest (hex SHA-1), refers_to and revisit of every row of `pages` (page_id, url, html).

    Rows of equal payload meet as one row for each of their salts, of which a payload has at
    most as many as its rows need; so no task gathers a payload that very many pages share.
    """
    salts = max(LEAST_SALTS, pages.count() // ROWS_PER_SALT)
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload")).withColumns({
        "digest": F.sha1("payload"), "salt": F.pmod(F.xxhash64("page_id", "url"), F.lit(salts)),
    })
    salted = rows.groupBy("digest", "salt").agg(F.max("page_id").alias("first"))
    first = salted.groupBy("digest").agg(F.max("first").alias("first"))
    known = salted.select("digest", "salt").join(first, "digest")
    later = (F.octet_length("payload") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(known, ["digest", "salt"]).select(
        "page_id", "url", "payload", "digest", F.when(later, F.col("first")).alias("refers_to"), later.alias("revisit"))


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """One WARC record. A revisit carries the HTTP header alone, whose Content-Length is that of the full payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    lines = [
        b"WARC/1.1", b"WARC-Type: " + (REVISIT if revisit else RESPONSE).encode(), b"WARC-Record-ID: " + _name(page_id),
        b"WARC-Date: " + date.encode(), b"Content-Type: application/http; msgtype=response",
        b"WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)),
    ]
    if url is not None:
        safe = re.sub(rb"[\x00-\x20\x7f]", lambda m: b"%%%02X" % m[0][0], url.encode("utf-8", "surrogatepass"))
        lines.append(b"WARC-Target-URI: " + safe)
    if revisit:
        lines += [b"WARC-Refers-To: " + _name(refers_to), b"WARC-Profile: " + REVISIT_PROFILE]
    lines.append(b"Content-Length: %d" % len(block))
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def _name(page_id: int | None) -> bytes:
    return b"<urn:page:%s>" % (b"null" if page_id is None else b"%d" % page_id)


def _number(name: bytes | None) -> int | None:
    inside = (name or b"<urn:page:null>")[len(b"<urn:page:"):-1]
    return None if inside == b"null" else int(inside)


class _Bundle:
    """A bundle file under way; `entries` are (compressed size, plain size, checksum) of its frames."""

    def __init__(self, folder: str, name: str) -> None:
        self.name = name
        files, path = _files(folder)
        files.create_dir(path, recursive=True)
        self.out = files.open_output_stream(f"{path}/{name}", compression=None)  # not by the name
        self.entries: list[tuple[int, int, int]] = []
        self.size = 0

    def add(self, plain: bytes) -> tuple[int, int]:
        packed = zstandard.ZstdCompressor(level=3).compress(plain)
        start = self.size
        self.out.write(packed)
        self.size += len(packed)
        self.entries.append((len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
        return start, len(packed)

    def close(self) -> None:
        table = b"".join(struct.pack("<III", *e) for e in self.entries)
        footer = struct.pack("<IBI", len(self.entries), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table) + len(footer)) + table + footer)
        self.out.close()


def _writer(folder: str, date: str, frame_bytes: int, bundle_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        attempt = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        bundle, made = None, 0
        frame: list[bytes] = []
        places: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal bundle, made, frame, places, size
            if bundle is None:
                bundle = _Bundle(folder, f"{attempt}-{made}.warc.zst")
                made += 1
            start, length = bundle.add(b"".join(frame))
            n = len(places)
            ids, types, refers, at, sizes = map(list, zip(*places))
            out = pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array(types, pa.string()), pa.array(refers, pa.int64()),
                pa.array([bundle.name] * n), pa.array([start] * n, pa.int64()), pa.array([length] * n, pa.int64()),
                pa.array(at, pa.int64()), pa.array(sizes, pa.int64()),
            ], names=["page_id", "record_type", "refers_to", "bundle", "frame_start", "frame_bytes", "at", "bytes"])
            frame, places, size = [], [], 0
            if bundle.size >= bundle_bytes:
                bundle.close()
                bundle = None
            return out

        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "payload", "digest", "refers_to", "revisit")]
            for row in zip(*columns):
                page_id, url, payload, digest, refers_to, revisit = (v.as_py() for v in row)
                one = record(page_id, url, payload, digest, refers_to, revisit, date)
                if frame and size + len(one) > frame_bytes:
                    yield flush()
                places.append((page_id, REVISIT if revisit else RESPONSE, refers_to, size, len(one)))
                frame.append(one)
                size += len(one)
        if frame:
            yield flush()
        if bundle is not None:
            bundle.close()
    return run


def write(
    pages: DataFrame, folder: str, min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z",
    frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES,
) -> Archive:
    """Write one record for every row of `pages` (page_id, url, html) below `folder`, a new one.

    Of payloads of at least `min_bytes` that are equal, the rows with the largest page_id are
    responses and the others revisit them; all shorter ones are responses. A null html is an
    empty payload. A null page_id is smaller than any other: such a row is a response where its
    payload has no other row, and its record is named `null`. Repeated rows are written each,
    so an identifier may stand for several records. A null url has no WARC-Target-URI; white
    space and control characters in one are percent-encoded. Other columns are not read. An
    empty table gives an empty index and no bundle.
    """
    archive = Archive(folder)
    typed(pages, min_bytes).mapInArrow(_writer(archive.bundles, date, frame_bytes, bundle_bytes), _INDEX).write.parquet(
        f"{folder}/index")
    return archive


def seek_table(source: pa.NativeFile) -> list[tuple[int, int, int, int]]:
    """Start, compressed size, plain size and checksum of every frame of a bundle."""
    size = source.size()
    frames, flags, magic = struct.unpack("<IBI", source.read_at(9, size - 9))
    if magic != SEEKABLE_MAGIC or flags != CHECKSUM_FLAG:
        raise ValueError("not a seekable bundle with checksums")
    table = source.read_at(12 * frames, size - 9 - 12 * frames)
    out, start = [], 0
    for packed, plain, check in struct.iter_unpack("<III", table):
        out.append((start, packed, plain, check))
        start += packed
    return out


def records(plain: bytes) -> Iterator[tuple[dict[bytes, bytes], bytes, int]]:
    """Header fields, block and place of each record in a plain frame."""
    at = 0
    while at < len(plain):
        head_end = plain.index(b"\r\n\r\n", at)
        head = plain[at:head_end].split(b"\r\n")
        if head[0] != b"WARC/1.1":
            raise ValueError(f"no WARC record at {at}")
        fields = dict(line.split(b": ", 1) for line in head[1:])
        start = head_end + 4
        end = start + int(fields[b"Content-Length"])
        if plain[end:end + 4] != b"\r\n\r\n":
            raise ValueError(f"record at {at} does not end where it says")
        yield fields, plain[start:end], at
        at = end + 4


def _row(fields: dict[bytes, bytes], block: bytes) -> tuple:
    """A record as a row of _READ; the payload of a response must have the digest that its header gives."""
    head_end = block.index(b"\r\n\r\n") + 4
    http = dict(line.split(b": ", 1) for line in block[:head_end - 4].split(b"\r\n")[1:])
    kind = fields[b"WARC-Type"].decode()
    digest = fields[b"WARC-Payload-Digest"].removeprefix(b"sha1:").decode()
    payload = block[head_end:] if kind == RESPONSE else None
    if payload is not None and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
        raise ValueError(f"payload of {fields[b'WARC-Record-ID']!r} does not have its digest")
    url = fields.get(b"WARC-Target-URI")
    return (
        _number(fields[b"WARC-Record-ID"]), None if url is None else url.decode("utf-8", "replace"), kind,
        int(http[b"Content-Length"]), digest, _number(fields.get(b"WARC-Refers-To")), payload,
    )


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary())
    names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def _plain(packed: bytes, size: int, check: int) -> bytes:
    plain = zstandard.ZstdDecompressor().decompress(packed, max_output_size=size)
    if len(plain) != size or xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != check:
        raise ValueError("a frame does not have its checksum")
    return plain


def read(spark: SparkSession, archive: Archive) -> DataFrame:
    """Every record of the archive, read from its bundles frame by frame by their seek tables."""
    names = archive.index(spark).select("bundle").distinct()
    # bundles are of bounded size; a task reads some of them
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), names.count() // 16)
    folder = archive.bundles

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = _files(folder)
        for batch in batches:
            for name in batch.column("bundle").to_pylist():
                with files.open_input_file(f"{path}/{name}") as source:
                    for start, packed, size, check in seek_table(source):
                        plain = _plain(source.read_at(packed, start), size, check)
                        yield _batch([_row(fields, block) for fields, block, _ in records(plain)])

    return names.repartition(parts, "bundle").mapInArrow(run, _READ)


def fetch(spark: SparkSession, archive: Archive, ids: DataFrame) -> DataFrame:
    """The records of `ids` (page_id), each from its own frame; no other frame is read.

    A page_id that the archive does not hold gives no row, a repeated one is looked up once;
    null finds nothing. A revisit has no payload: fetch the record that it refers to.
    """
    folder = archive.bundles
    wanted = ids.select(F.col("page_id").cast("long").alias("page_id")).distinct()
    places = archive.index(spark).join(wanted, "page_id").select("bundle", "frame_start", "frame_bytes", "at", "bytes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = _files(folder)
        held, plain, last, source = None, b"", None, None
        for batch in batches:
            rows = []
            for place in zip(*(batch.column(c).to_pylist() for c in ("bundle", "frame_start", "frame_bytes", "at", "bytes"))):
                bundle, start, packed, at, size = place
                if bundle != last:
                    if source is not None:
                        source.close()
                    source, last = files.open_input_file(f"{path}/{bundle}"), bundle
                if (bundle, start) != held:
                    held, plain = (bundle, start), zstandard.ZstdDecompressor().decompress(source.read_at(packed, start))
                rows += [_row(fields, block) for fields, block, _ in records(plain[at:at + size])]
            if rows:
                yield _batch(rows)
        if source is not None:
            source.close()

    # a frame's records come one after the other, so it is unpacked once
    dealt = places.repartition("bundle", "frame_start").sortWithinPartitions("bundle", "frame_start", "at")
    return dealt.mapInArrow(run, _READ)
