"""Dictionary-compressed WARC archives (operator 13).

Every page becomes one WARC/1.1 record.  A run of records makes an archive in the ``.warc.zst``
layout: a leading skippable frame with a Zstandard dictionary that was built from the archive's own
records, then a ``warcinfo`` record, then one independent frame per record, so that a record can be
read on its own from its offset.  Pages with equal payloads are stored once: the one of the smallest
``page_id`` as ``response``, the others as ``revisit`` that names it.

Files are written by Spark's own committed writer, one file an archive, so a lost task leaves no
half archive and any store Spark can write to will do.  That writer ends each file with a separator;
an empty skippable frame is used, which every Zstandard reader passes over.  An archive holds at
most ``ARCHIVE_BYTES`` of record bytes (one longer record has an archive of its own), which bounds the
memory of both the writer and the reader; nothing depends on how rows fall into archives.

Which payloads repeat is found from digests alone: they are counted with a partial aggregate, so
that a payload held by a third of all pages is one row a task, and only repeated digests are
joined back, by a broadcast up to ``BROADCAST_DIGESTS`` rows and by a shuffle (split when skewed) beyond.

Defined cases: a null html is an empty payload, a null url an empty target; payloads under
``LEAST_SHARED`` bytes are always ``response``; rows that repeat the smallest id of their payload are
all ``response``; a null id counts as larger than any other and, alone with its payload, is
``response``; control characters and spaces of a url are percent-encoded; an archive of fewer records
than a dictionary can be built from has no dictionary frame; an empty table gives no archive and no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from ratesmith.llm.batches import bounded
from ratesmith.session import cut_lineage, ensure_checkpoint_dir

ARCHIVE_BYTES = 16 << 20
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
#: Payloads of fewer bytes are stored again each time.
LEAST_SHARED = 100
#: Repeated digests are broadcast up to this many (32 bytes and an id each).
BROADCAST_DIGESTS = 200_000
# Fixed values of the formats: skippable frames (dictionary; padding), WARC version and revisit profile.
DICTIONARY_MAGIC = 0x184D2A5D
PADDING_FRAME = "P*M\x18\x00\x00\x00\x00"
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD_SCHEMA = ("archive string, offset long, length long, record_type string, page_id string, url string, date string, "
                 "payload_bytes long, payload_digest string, refers_to string, payload binary")


# ---- records and archives as bytes -----------------------------------------------------------

def _encoded(url: str | None) -> str:
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url or "")


def _record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [VERSION, f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _name(page: str | None) -> str:
    return "<urn:page>" if page is None else f"<urn:page:{quote(page, safe='')}>"


def _named(uri: str | None) -> str | None:
    return unquote(uri[len("<urn:page:"):-1]) if uri and uri.startswith("<urn:page:") else None


def page_record(page: str | None, url: str | None, payload: bytes, size: int, digest: str, refers_to: str | None, date: str) -> bytes:
    """The record of one page: a response with its payload, or a revisit (``refers_to`` given) without."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    headers = [("WARC-Record-ID", _name(page)), ("WARC-Date", date), ("WARC-Target-URI", _encoded(url)),
               ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha256:{digest}")]
    if refers_to is None:
        return _record("response", headers, http + payload)
    return _record("revisit", [*headers, ("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", _name(refers_to))], http)


def train(records: list[bytes], size: int = DICTIONARY_BYTES) -> zstandard.ZstdCompressionDict | None:
    """A dictionary built from all the records, or None if they are too few or too small for one."""
    try:
        return zstandard.train_dictionary(min(size, sum(map(len, records)) // 8), records, k=256, d=8, f=18, accel=5)
    except zstandard.ZstdError:
        return None


def build_archive(records: list[bytes], date: str, level: int = LEVEL) -> bytes:
    """Dictionary frame, ``warcinfo`` frame, and one frame a record."""
    dictionary = train(records)
    parts = []
    if dictionary is not None:
        content = zstandard.ZstdCompressor(level=level).compress(dictionary.as_bytes())
        parts += [struct.pack("<II", DICTIONARY_MAGIC, len(content)), content]
    packer = zstandard.ZstdCompressor(level=level, dict_data=dictionary, write_checksum=True)
    info = _record("warcinfo", [("WARC-Record-ID", f"<urn:sha256:{hashlib.sha256(b''.join(records)).hexdigest()}>"), ("WARC-Date", date),
                                ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
    return b"".join([*parts, packer.compress(info), *map(packer.compress, records)])


def archive_dictionary(archive: bytes) -> tuple[zstandard.ZstdCompressionDict | None, int]:
    """The dictionary of the leading skippable frame and the offset of the first record."""
    if len(archive) < 8 or struct.unpack_from("<I", archive)[0] != DICTIONARY_MAGIC:
        return None, 0
    end = 8 + struct.unpack_from("<I", archive, 4)[0]
    content = archive[8:end]
    if content[:4] == struct.pack("<I", 0xFD2FB528):  # the dictionary may itself be compressed
        content = zstandard.ZstdDecompressor().decompress(content)
    return zstandard.ZstdCompressionDict(content), end


def record_frames(archive: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, record) of every frame; skippable frames are passed over."""
    dictionary, at = archive_dictionary(archive)
    unpacker = zstandard.ZstdDecompressor(dict_data=dictionary)
    view = memoryview(archive)
    while at < len(archive):
        magic = struct.unpack_from("<I", archive, at)[0]
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            at += 8 + struct.unpack_from("<I", archive, at + 4)[0]
            continue
        frame, start, out = unpacker.decompressobj(), at, []
        while not frame.eof:
            if at >= len(archive):
                raise ValueError(f"archive ends within the frame at {start}")
            piece = view[at: at + (1 << 15)]
            out.append(frame.decompress(piece))
            at += len(piece)
        at -= len(frame.unused_data)
        yield start, at - start, b"".join(out)


def read_record(archive: bytes, offset: int, length: int) -> bytes:
    """One record by its place, without reading those before it."""
    return zstandard.ZstdDecompressor(dict_data=archive_dictionary(archive)[0]).decompress(archive[offset: offset + length])


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (with the version under the empty name) and block; raises ValueError on anything else."""
    head, sep, rest = record.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    headers = {"": first, **dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)}
    size = int(headers.get("Content-Length", -1))
    if not sep or not first.startswith("WARC/") or size < 0 or rest[size:] != b"\r\n\r\n":
        raise ValueError(f"not a WARC record: {record[:80]!r}")
    return headers, rest[:size]


# ---- Spark -----------------------------------------------------------------------------------

def typed_captures(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, digest (hex), refers_to: all as the records need them."""
    slim = bounded(pages).select(F.col("page_id"), F.col("url").cast("string").alias("url"),
                                 F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"))
    slim = slim.withColumn("digest", F.sha2("payload", 256))
    repeated = (slim.where(F.octet_length("payload") >= LEAST_SHARED).groupBy(F.unhex("digest").alias("sha"))
                .agg(F.min("page_id").alias("first"), F.count("*").alias("k")).where("k > 1 AND first IS NOT NULL").select("sha", "first"))
    repeated = cut_lineage(repeated, "repeated-payloads")
    if repeated.count() <= BROADCAST_DIGESTS:
        repeated = F.broadcast(repeated)
    return (slim.join(repeated, F.unhex("digest") == F.col("sha"), "left")
            .withColumn("refers_to", F.when(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")))
            .select(F.col("page_id").cast("string").alias("page_id"), "url", F.octet_length("payload").cast("long").alias("size"),
                    F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload"), "digest",
                    F.col("refers_to").cast("string").alias("refers_to")))


def write_archives(pages: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES,
                   level: int = LEVEL) -> None:
    """Archives of all pages (page_id, url, html) as files of a new folder; ``date`` is the records' WARC-Date."""

    def pack(batches):
        held, size = [], 0
        for batch in batches:
            for page, url, n, payload, digest, target in zip(*(c.to_pylist() for c in batch.columns)):
                record = page_record(page, url, payload or b"", n, digest, target, date)
                if held and size + len(record) > archive_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([build_archive(held, date, level)], pa.binary())], names=["archive"])
                    held, size = [], 0
                held.append(record)
                size += len(record)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([build_archive(held, date, level)], pa.binary())], names=["archive"])

    (typed_captures(pages).mapInArrow(pack, "archive binary").select(F.col("archive").cast("string").alias("value"))
     .write.option("lineSep", PADDING_FRAME).option("maxRecordsPerFile", 1).option("compression", "none").text(folder))


def read_archives(spark: SparkSession, folder: str, with_payload: bool = False) -> DataFrame:
    """One row per page record of the archives, ``RECORD_SCHEMA``.

    A response's payload digest is computed again from what was read and must be the one its
    header states.  ``payload`` is null unless asked for.
    """

    names = [f.split()[0] for f in RECORD_SCHEMA.split(", ")]
    types = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 4, pa.int64(), pa.string(), pa.string(), pa.binary()]

    def rows_of(path: str, archive: bytes):
        for offset, length, record in record_frames(archive):
            headers, block = parse_record(record)
            kind = headers["WARC-Type"]
            if kind not in ("response", "revisit"):
                continue
            http, _, payload = block.partition(b"\r\n\r\n")
            size = int(next(x for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")).split(b":")[1])
            digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
            if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
                raise ValueError(f"payload of {headers['WARC-Record-ID']} in {path} is not the one its header states")
            yield (path, offset, length, kind, _named(headers["WARC-Record-ID"]), headers["WARC-Target-URI"], headers["WARC-Date"],
                   size, digest, _named(headers.get("WARC-Refers-To")), payload if with_payload and kind == "response" else None)

    def run(batches):
        for batch in batches:
            for path, archive in zip(batch.column(0), batch.column(1)):
                out, size = [], 0
                for row in rows_of(path.as_py(), archive.as_py()):
                    out.append(row)
                    size += len(row[-1] or b"") + 400
                    if size > ARCHIVE_BYTES:
                        yield _batch(out)
                        out, size = [], 0
                if out:
                    yield _batch(out)

    def _batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    files = bounded(spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder))
    return files.select("path", "content").mapInArrow(run, RECORD_SCHEMA)


def archive_report(pages: DataFrame) -> DataFrame:
    """Writes the archives of ``pages`` into the checkpoint folder, reads them back, and tells per page what they hold."""
    spark = pages.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    write_archives(pages, folder)
    kind = dict(pages.dtypes)["page_id"]
    return read_archives(spark, folder).select(
        F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"))
