"""WARC archives compressed record by record with a Zstandard dictionary of their own.

A task turns its pages into records, builds a dictionary from them, and writes files that begin with the
dictionary in a skippable frame; each record is a frame of its own, so any record can be read alone.
Pages with equal payloads are archived once; the others are revisit records.
"""

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from hirelens.llm.common import byte_steps, stage
from hirelens.llm.files import make_folder, write_file
from hirelens.operators.lookup import fits_broadcast

# Payload bytes of one archive file, and of the records that its dictionary is built from.
ARCHIVE_BYTES = 64 << 20
SAMPLE_BYTES = 4 << 20
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
READ_BYTES = 16 << 10

# Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_URN = "urn:x-page:"

RECORDS = ("page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, "
           "refers_to bigint, payload binary")
_NAMES = [c.split()[0] for c in RECORDS.split(", ")]
_TYPES = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]


# ---- records ----


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _uri(url: str | None) -> str:
    """A header value without line ends or other control characters."""
    return re.sub(r"[\x00-\x20\x7f-\x9f]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url or "")


def record(kind: str, page: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if kind == "response" else http
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{RECORD_URN}{'' if page is None else page}>", f"WARC-Date: {date}",
        *([f"WARC-Target-URI: {_uri(url)}"] if url is not None else []), f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
        *([f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{RECORD_URN}{refers_to}>"] if kind == "revisit" else []),
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes, keep_payload: bool = True) -> tuple | None:
    """The values of ``RECORDS`` of one record, None for records that hold no page; checks lengths and digests."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    length = int(fields["Content-Length"])
    if not version.startswith("WARC/") or rest[length:] != b"\r\n\r\n":
        raise ValueError("a WARC record is damaged")
    if fields["WARC-Type"] not in ("response", "revisit"):
        return None
    http, _, payload = rest[:length].partition(b"\r\n\r\n")
    size = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    whole = fields["WARC-Type"] == "response"
    if whole and (len(payload) != size or payload_digest(payload) != digest):
        raise ValueError("the payload of a WARC record is damaged")
    number = lambda name: int(n) if (n := fields.get(name, "").strip("<>").removeprefix(RECORD_URN)) else None
    return (number("WARC-Record-ID"), fields.get("WARC-Target-URI"), size, digest, fields["WARC-Type"],
            number("WARC-Refers-To"), payload if whole and keep_payload else None)


# ---- files ----


def dictionary_of(records: list[bytes], size: int = DICTIONARY_BYTES) -> zstandard.ZstdCompressionDict | None:
    """Trained on records spread evenly over the archive; None if they are too few or too short to train on."""
    step = max(1, sum(map(len, records)) // SAMPLE_BYTES)
    samples = records[::step]
    try:
        return zstandard.train_dictionary(min(size, sum(map(len, samples)) // 8), samples, k=512, d=8)
    except (zstandard.ZstdError, ValueError):
        return None


def compressed(records: list[bytes]) -> Iterator[bytes]:
    """The bytes of an archive: the dictionary in a skippable frame, then one frame per record."""
    made = dictionary_of(records)
    if made is not None:
        held = made.as_bytes()
        yield struct.pack("<II", DICTIONARY_MAGIC, len(held)) + held
    packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=made, write_content_size=True, write_checksum=True)
    for raw in records:
        yield packer.compress(raw)


def records_of(archive: memoryview) -> Iterator[bytes]:
    """The records of an archive, one at a time."""
    at, made = 0, None
    if len(archive) >= 8:
        magic, size = struct.unpack("<II", archive[:8])
        if magic == DICTIONARY_MAGIC:
            made, at = zstandard.ZstdCompressionDict(archive[8 : 8 + size].tobytes()), 8 + size
    unpacker = zstandard.ZstdDecompressor(dict_data=made)
    while at < len(archive):
        frame, parts = unpacker.decompressobj(), []
        while not frame.eof:
            if at >= len(archive):
                raise ValueError("an archive ends within a record")
            chunk = archive[at : at + READ_BYTES]
            parts.append(frame.decompress(chunk))
            at += len(chunk) - len(frame.unused_data)
        yield b"".join(parts)


# ---- the operator ----


def marked_pages(pages: DataFrame, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url",
                 html_col: str = "html") -> DataFrame:
    """``(id, url, payload, refers_to)`` of every page; ``refers_to`` is null for response records.

    Only digests are shuffled.  The digests that occur more than once are broadcast if they fit, otherwise
    pages and digests meet by a shuffle that splits hot payloads.
    """
    payload = F.coalesce(pages[html_col], F.lit(""))
    rows = pages.select(pages[id_col].cast("bigint").alias("id"), pages[url_col].alias("url"), payload.alias("payload"))
    key = F.when(F.octet_length("payload") >= min_bytes, F.unhex(F.sha2(F.col("payload").cast("binary"), 256)))
    keyed = rows.withColumn("key", key)
    groups = keyed.filter("key IS NOT NULL").groupBy("key").agg(F.max("id").alias("response"), F.count(F.lit(1)).alias("n"))
    repeated = stage(groups.filter("n > 1 AND response IS NOT NULL").select("key", "response"), "repeated_payloads")
    if fits_broadcast(repeated):
        joined = keyed.join(F.broadcast(repeated), "key", "left")
    else:
        # In a fixed order, so that a task that runs twice writes the same files.
        joined = keyed.join(repeated, "key", "left").sortWithinPartitions("key", "id", "url")
    refers = F.when(~F.col("id").eqNullSafe(F.col("response")), F.col("response"))
    return joined.select("id", "url", "payload", refers.alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES,
                   date: str = "2000-01-01T00:00:00Z", **columns: str) -> int:
    """Write a record per page to ``.warc.zst`` files in ``folder``; returns the number of files.

    Of the pages with equal payloads of at least ``min_bytes`` bytes the one with the largest id is the response (all
    of its rows, if it is repeated), the others revisit it; smaller payloads are all responses.  A null payload is
    empty.  Null ids revisit the largest id; where all ids of a payload are null, all are responses.
    An empty table writes no file.  Archives of too few bytes to train on hold no dictionary.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, files, held, size = TaskContext.get().partitionId(), 0, [], 0

        def done() -> None:
            info = "software: hirelens\r\nformat: WARC File Format 1.1\r\n"
            first = (f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:x-archive:{part}-{files}>\r\nWARC-Date: {date}\r\n"
                     f"Content-Type: application/warc-fields\r\nContent-Length: {len(info)}\r\n\r\n{info}\r\n\r\n").encode()
            write_file(folder, f"part-{part:06d}-{files:05d}.warc.zst", compressed([first, *held]))

        for step in byte_steps(batches, "payload"):
            payloads = step.column("payload").cast(pa.binary()).to_pylist()
            for page, url, payload, refers in zip(*[step.column(c).to_pylist() for c in ("id", "url")], payloads,
                                                  step.column("refers_to").to_pylist()):
                kind = "response" if refers is None else "revisit"
                held.append(record(kind, page, url, payload, refers, date))
                size += len(held[-1])
                if size >= archive_bytes:
                    done()
                    files, held, size = files + 1, [], 0
        if held:
            done()
            files += 1
        yield pa.RecordBatch.from_arrays([pa.array([files], pa.int64())], names=["files"])

    make_folder(folder)
    made = marked_pages(pages, min_bytes, **columns).mapInArrow(write, "files bigint")
    return made.agg(F.coalesce(F.sum("files"), F.lit(0))).first()[0]


def read_archives(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """The page records of a folder of archives (schema ``RECORDS``).

    Length and digest of a revisit are those of the full payload, as its headers state them; ``payload``
    is null for revisits, and for all records without ``payloads``.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder).select("content")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                held, size = [], 0
                for raw in records_of(memoryview(content.as_buffer())):
                    values = parse(raw, payloads)
                    if values is not None:
                        held.append(values)
                        size += len(values[-1] or b"") + 200
                    if size > ARCHIVE_BYTES // 16:
                        yield _batch(held)
                        held, size = [], 0
                yield _batch(held)

    return files.mapInArrow(read, RECORDS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * len(_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES)], names=_NAMES)
