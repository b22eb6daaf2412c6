"""Web archives in Zstandard: records written one frame each, read back frame by frame.

An archive begins with a skippable frame (magic 0x184D2A5D) that holds the
dictionary its records are compressed with, raw or itself compressed. Each
record behind it is one Zstandard frame.

Reading. A task opens an archive as a stream, loads the dictionary, and walks
from frame to frame by the block headers, so that it holds one record at a
time. A frame must hold exactly one record: a version line, named fields that
do not repeat, the fields the format requires, a block of ``Content-Length``
bytes, two line ends, and nothing behind them. An HTTP response must have the
payload length its own header names and the digest of its record. A bad record
fails the job (``on_error="raise"``) or becomes one row with ``error`` set; the
next frame is read either way. An archive cut off inside a frame ends with such
a row.

Writing. Payloads of at least ``MIN_REVISIT`` bytes that several pages share are
stored once, by the row with the smallest key; the other rows become ``revisit``
records that name it. Digests are grouped first (combined map-side), only those
that occur more than once are joined back, and the payload of a revisit never
leaves the scan. The join ships that small table when its stored size is below
``BROADCAST_BYTES``; beyond it, pages are dealt by digest and a salt, so that a
payload shared by a third of all pages is spread. A task writes archives of
about ``archive_bytes``. Each attempt uses file names of its own, and only the
archives of attempts that Spark committed are in the returned table: a lost
executor or a repeated task leaves a file nobody reads.

The dictionary is trained on at most ``DICTIONARY_ROWS`` payloads of 200 to 32,768
bytes (those with the smallest hash of key and URL); with fewer than 16 of them there is none.

Edge cases. A null payload is empty; a null key has record id ``<urn:x-page:>``
and never is the one others refer to; rows that repeat the smallest key are all
responses; a null URL has no ``WARC-Target-URI``, and blanks and control
characters in a URL are percent-encoded; an empty table gives no archive and no
row. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
import uuid
from typing import BinaryIO, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftwise.llm._io import materialise, prepare
from shiftwise.operators._checks import input_bytes
from shiftwise.session import scratch_path

# Fixed values of the formats.
ZSTD_MAGIC = 0xFD2FB528
DICT_FRAME_MAGIC = 0x184D2A5D
RAW_DICT_MAGIC = 0xEC30A437
VERSIONS = ("WARC/1.0", "WARC/1.1")
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"

MIN_REVISIT = 100
ARCHIVE_BYTES = 64 << 20
BROADCAST_BYTES = 8 << 20
SALTS = 16
DICTIONARY_ROWS = 400
DICTIONARY_BYTES = 1 << 16

MANIFEST = pa.schema([("archive", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])
RECORDS = pa.schema([
    ("archive", pa.string()), ("offset", pa.int64()), ("frame_bytes", pa.int64()), ("record_type", pa.string()),
    ("record_id", pa.string()), ("date", pa.string()), ("target_uri", pa.string()), ("refers_to", pa.string()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()),
    ("error", pa.string())])
MANIFEST_DDL = "archive string, records long, bytes long"
RECORDS_DDL = ("archive string, offset long, frame_bytes long, record_type string, record_id string, date string, "
               "target_uri string, refers_to string, payload_bytes long, payload_digest string, payload binary, "
               "error string")


class BadArchive(ValueError):
    """A frame or record that breaks the format."""


# --- frames -------------------------------------------------------------------------------

def _exactly(stream: BinaryIO, n: int) -> bytes:
    data = stream.read(n)
    if len(data) < n:
        raise BadArchive("the archive ends inside a frame")
    return data


def frames(stream: BinaryIO) -> Iterator[tuple[int, int, bytes]]:
    """(offset, magic number, bytes) of every frame, found by the lengths of
    their blocks; a skippable frame's bytes are its content."""
    at = 0
    while head := stream.read(4):
        if len(head) < 4:
            raise BadArchive("the archive ends inside a frame")
        (magic,) = struct.unpack("<I", head)
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            (n,) = struct.unpack("<I", _exactly(stream, 4))
            yield at, magic, _exactly(stream, n)
            at += 8 + n
            continue
        if magic != ZSTD_MAGIC:
            raise BadArchive("no frame begins here")
        descriptor = _exactly(stream, 1)
        d = descriptor[0]
        single = d >> 5 & 1
        rest = (1 - single) + (0, 1, 2, 4)[d & 3] + (single, 2, 4, 8)[d >> 6]
        parts = [head, descriptor, _exactly(stream, rest)]
        last = False
        while not last:
            block = _exactly(stream, 3)
            word = int.from_bytes(block, "little")
            last, kind, n = word & 1, word >> 1 & 3, word >> 3
            if kind == 3:
                raise BadArchive("a block of a reserved type")
            parts += [block, _exactly(stream, 1 if kind == 1 else n)]
        if d >> 2 & 1:
            parts.append(_exactly(stream, 4))
        frame = b"".join(parts)
        yield at, magic, frame
        at += len(frame)


def dictionary_of(content: bytes) -> bytes:
    """The dictionary in the leading skippable frame, decompressed if need be."""
    import zstandard

    (magic,) = struct.unpack("<I", content[:4].ljust(4, b"\0"))
    if magic == ZSTD_MAGIC:
        content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
        (magic,) = struct.unpack("<I", content[:4].ljust(4, b"\0"))
    if magic != RAW_DICT_MAGIC:
        raise BadArchive("the leading frame holds no dictionary")
    return content


# --- records ------------------------------------------------------------------------------

def _fields(lines: list[bytes]) -> dict[str, str]:
    out: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.decode("utf-8").partition(":")
        name = name.strip().lower()
        if not colon or not name:
            raise BadArchive(f"not a named field: {line[:60]!r}")
        if name in out and name != "warc-concurrent-to":
            raise BadArchive(f"field {name} repeats")
        out[name] = value.strip()
    return out


def _length(fields: dict[str, str]) -> int:
    n = fields.get("content-length", "")
    if not re.fullmatch(r"[0-9]+", n):
        raise BadArchive(f"no valid content length: {n[:20]!r}")
    return int(n)


def parse_record(data: bytes) -> dict:
    """The validated record that fills ``data``."""
    head, found, rest = data.partition(END)
    if not found:
        raise BadArchive("the header does not end")
    lines = head.split(b"\r\n")
    if lines[0].decode("latin-1") not in VERSIONS:
        raise BadArchive(f"unknown version {lines[0][:20]!r}")
    fields = _fields(lines[1:])
    missing = [k for k in REQUIRED if not fields.get(k)]
    if missing:
        raise BadArchive(f"required fields are missing: {missing}")
    n = _length(fields)
    if len(rest) != n + len(END) or rest[n:] != END:
        raise BadArchive(f"the block is not the {n} bytes that its header names")
    block, kind = rest[:n], fields["warc-type"]
    digest = fields.get("warc-payload-digest", "")
    out = {"record_type": kind, "record_id": fields["warc-record-id"], "date": fields["warc-date"],
           "target_uri": fields.get("warc-target-uri"), "refers_to": fields.get("warc-refers-to"),
           "payload_bytes": None, "payload_digest": digest.removeprefix("sha256:") or None, "payload": None}
    if kind == "revisit" and not out["refers_to"]:
        raise BadArchive("a revisit that names no record")
    if fields.get("content-type", "").startswith("application/http") and kind in ("response", "revisit"):
        http, found, payload = block.partition(END)
        if not found or not http.startswith(b"HTTP/"):
            raise BadArchive("no HTTP header in the block")
        size = _length(_fields(http.split(b"\r\n")[1:]))
        out["payload_bytes"] = size
        if kind == "response":
            if len(payload) != size:
                raise BadArchive(f"a payload of {len(payload)} bytes where {size} are named")
            if digest.startswith("sha256:") and digest[7:] != hashlib.sha256(payload).hexdigest():
                raise BadArchive("the payload has another digest")
            out["payload"] = payload
    return out


def format_record(key: bytes, url: bytes | None, payload: bytes | None, size: int, digest: str,
                  refers_to: bytes | None, date: str) -> bytes:
    """A response record, or with ``refers_to`` a revisit record without its payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = http if refers_to is not None else http + (payload or b"")
    lines = [b"WARC/1.1", b"WARC-Type: " + (b"response" if refers_to is None else b"revisit"),
             b"WARC-Record-ID: " + record_id(key), b"WARC-Date: " + date.encode()]
    if url is not None:
        lines.append(b"WARC-Target-URI: " + re.sub(rb"[\x00-\x20\x7f]", lambda m: b"%%%02X" % m[0][0], url))
    lines.append(b"WARC-Payload-Digest: sha256:" + digest.encode())
    if refers_to is not None:
        lines += [b"WARC-Profile: " + REVISIT_PROFILE.encode(), b"WARC-Refers-To: " + record_id(refers_to)]
    lines += [b"Content-Type: application/http; msgtype=response", b"Content-Length: %d" % len(block)]
    return b"\r\n".join(lines) + END + block + END


def record_id(key: bytes) -> bytes:
    return b"<urn:x-page:" + quote(key).encode() + b">"


def key_of(column: str):
    """The key inside a record id, as a string column (null for the empty key)."""
    inner = F.regexp_extract(column, "^<urn:x-page:(.*)>$", 1)
    return F.when(inner != "", F.url_decode(inner))


# --- reading ------------------------------------------------------------------------------

def _location(uri: str):
    """(pyarrow file system, path) of a URI as Spark writes it."""
    from pyarrow import fs

    uri = re.sub(r"^file:/(?!/)", "file:///", re.sub(r"^s3[an]://", "s3://", uri))
    return fs.FileSystem.from_uri(uri)


def read_stream(archive: str, stream: BinaryIO, on_error: str = "raise",
                with_payload: bool = True) -> Iterator[dict]:
    """The records of one archive, in order (``warcinfo`` records included)."""
    import zstandard

    context = zstandard.ZstdDecompressor()
    row: dict = {}
    walk = frames(stream)
    first = True
    while True:
        row = dict.fromkeys(RECORDS.names) | {"archive": archive}
        try:
            offset, magic, data = next(walk)
            row |= {"offset": offset, "frame_bytes": len(data)}
            if magic != ZSTD_MAGIC:
                if first and magic == DICT_FRAME_MAGIC:
                    context = zstandard.ZstdDecompressor(
                        dict_data=zstandard.ZstdCompressionDict(dictionary_of(data)))
                first = False
                continue
            first = False
            one = context.decompressobj()
            row |= parse_record(one.decompress(data))
        except StopIteration:
            return
        except (BadArchive, UnicodeDecodeError, zstandard.ZstdError) as e:
            if on_error == "raise":
                raise BadArchive(f"{archive}, byte {row['offset']}: {e}") from e
            row["error"] = str(e)
        if not with_payload:
            row["payload"] = None
        yield row


def _batches(rows: Iterator[dict], most_rows: int = 256, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row["payload"] or b"")
        if len(held) >= most_rows or size >= most_bytes:
            yield pa.RecordBatch.from_pylist(held, RECORDS)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, RECORDS)


def read_archives(archives: DataFrame, on_error: str = "raise", with_payload: bool = True,
                  through_spark: bool = False) -> DataFrame:
    """All records of the archives named in column ``archive``, one row each.

    Each archive is one task's stream (a file system that pyarrow knows).
    ``through_spark=True`` lets Spark fetch the files instead, whole, for stores
    that only Spark reaches and archives that fit in memory."""
    if on_error not in ("raise", "flag"):
        raise ValueError("on_error must be 'raise' or 'flag'")
    spark = archives.sparkSession
    prepare(spark)
    names = archives.select("archive")
    if through_spark:
        paths = [r["archive"] for r in names.toLocalIterator()]
        if not paths:
            return spark.createDataFrame([], RECORDS_DDL)
        whole = spark.read.format("binaryFile").load(paths).select(F.col("path").alias("archive"), "content")

        def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                    yield from _batches(read_stream(name, io.BytesIO(content.as_py()), on_error, with_payload))

        return whole.mapInArrow(unpack, RECORDS_DDL)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                system, path = _location(name)
                with system.open_input_stream(path, compression=None, buffer_size=1 << 20) as f:
                    yield from _batches(read_stream(name, f, on_error, with_payload))

    return names.repartition(max(1, names.count())).mapInArrow(stream, RECORDS_DDL)


# --- writing ------------------------------------------------------------------------------

def train_dictionary(pages: DataFrame, rows: int = DICTIONARY_ROWS, size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary from the payloads of about ``rows`` pages; empty with too few of
    them. The smallest hashes are found first, so that tasks send hashes, not
    payloads, to be ordered."""
    import zstandard

    fit = pages.filter(F.octet_length("payload").between(200, 32_768)).withColumn("h", F.xxhash64("key", "url"))
    lowest = [r["h"] for r in fit.select("h").distinct().orderBy("h").limit(rows).collect()]
    if not lowest:
        return b""
    sample = [bytes(r["payload"]) for r in fit.filter(F.col("h") <= lowest[-1]).select("h", "payload")
              .dropDuplicates(["h"]).orderBy("h").select("payload").collect()]
    if len(sample) < 16:
        return b""
    try:
        return zstandard.train_dictionary(min(size, sum(map(len, sample)) // 4), sample, k=256, d=8).as_bytes()
    except zstandard.ZstdError:  # samples too alike to train on
        return b""


def first_pages(pages: DataFrame) -> DataFrame:
    """(digest, first key) of payloads that several rows share."""
    return (pages.filter(F.col("size") >= MIN_REVISIT).groupBy("digest")
            .agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n"))
            .filter("n > 1 and first is not null").select("digest", "first"))


def with_first(pages: DataFrame, firsts: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``pages`` with the key their payload is stored under (null: no other row has it)."""
    if input_bytes(firsts) <= broadcast_bytes:
        return pages.join(F.broadcast(firsts), "digest", "left")
    salted = firsts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = pages.withColumn("salt", F.pmod(F.xxhash64("key", "url"), F.lit(SALTS)).cast("int"))
    return dealt.join(salted, ["digest", "salt"], "left").drop("salt")


def write_archives(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html",
                   folder: str | None = None, date: str = "1970-01-01T00:00:00Z",
                   archive_bytes: int = ARCHIVE_BYTES, level: int = 3,
                   broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Write one record per row below ``folder`` (default: a scratch folder) and
    return the table (archive, records, bytes) of the archives."""
    spark = pages.sparkSession
    prepare(spark)
    folder = (folder or scratch_path(spark, "warc")).rstrip("/")
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(key).alias("key"), F.col(url).cast("binary").alias("url"), body.alias("payload"))
    dictionary = train_dictionary(rows)
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("size", F.octet_length("payload"))
    firsts = materialise(first_pages(rows), "warc-firsts")
    met = with_first(rows, firsts, broadcast_bytes)
    revisit = (F.col("size") >= MIN_REVISIT) & F.col("first").isNotNull() & ~F.col("key").eqNullSafe(F.col("first"))
    ready = met.select(
        F.coalesce(F.col("key").cast("string"), F.lit("")).cast("binary").alias("key"), "url",
        F.when(~revisit, F.col("payload")).alias("payload"), F.col("size").cast("long").alias("size"), "digest",
        F.when(revisit, F.col("first").cast("string").cast("binary")).alias("refers_to"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark import TaskContext

        given = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
        context = zstandard.ZstdCompressor(level=level, write_checksum=True, **given)
        system, base = _location(folder)
        system.create_dir(base, recursive=True)
        task, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex[:12]
        out, name, n, size, made = None, "", 0, 0, 0

        def done() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pylist(
                [{"archive": f"{folder}/{name}", "records": n, "bytes": size}], MANIFEST)

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("key", "url", "payload", "size", "digest", "refers_to")]
            for row in zip(*columns):
                if out is None:
                    name, n, size = f"part-{task:05d}-{made:03d}-{attempt}.warc.zst", 0, 0
                    out, made = system.open_output_stream(f"{base}/{name}", compression=None), made + 1
                    for part in _opening(context, dictionary, date, name):
                        size += out.write(part)
                frame = context.compress(format_record(*row, date))
                size, n = size + out.write(frame), n + 1
                if size >= archive_bytes:
                    yield done()
                    out = None
        if out is not None:
            yield done()

    return materialise(ready.mapInArrow(write, MANIFEST_DDL), "warc-archives")


def _opening(context, dictionary: bytes, date: str, name: str) -> Iterator[bytes]:
    """The dictionary frame (if any) and the ``warcinfo`` record of a new archive."""
    import zstandard

    if dictionary:
        packed = zstandard.ZstdCompressor(level=19).compress(dictionary)
        yield struct.pack("<II", DICT_FRAME_MAGIC, len(packed)) + packed
    block = b"format: WARC File Format 1.1\r\n"
    lines = [b"WARC/1.1", b"WARC-Type: warcinfo", b"WARC-Record-ID: <urn:x-archive:" + quote(name).encode() + b">",
             b"WARC-Date: " + date.encode(), b"Content-Type: application/warc-fields",
             b"Content-Length: %d" % len(block)]
    yield context.compress(b"\r\n".join(lines) + END + block + END)


# --- reports ------------------------------------------------------------------------------

def unresolved_revisits(records: DataFrame) -> DataFrame:
    """Revisits whose response, with the digest they name, is in no archive."""
    responses = records.filter("record_type = 'response'").select(
        F.col("record_id").alias("refers_to"), "payload_digest").distinct()
    return records.filter("record_type = 'revisit'").join(responses, ["refers_to", "payload_digest"], "left_anti")


def page_report(records: DataFrame, key_type: str = "bigint") -> DataFrame:
    """Per page: key, payload length and digest, record type, the key a revisit refers to."""
    pages = records.filter(F.col("record_type").isin("response", "revisit"))
    return pages.select(key_of("record_id").cast(key_type).alias("page_id"), "payload_bytes", "payload_digest",
                        "record_type", key_of("refers_to").cast(key_type).alias("refers_to"))


def archive_table(spark: SparkSession, paths: list[str]) -> DataFrame:
    """A table for ``read_archives`` from a list of paths."""
    return spark.createDataFrame([(p,) for p in paths], "archive string")
