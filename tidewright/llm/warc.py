"""WARC archives compressed with Zstandard: one frame a record, and a shared dictionary.

An archive starts with a skippable frame that holds the dictionary; each record after it
is a frame of its own. Tasks write archives of a bounded size into a shared folder and
hand on a manifest; other tasks read the archives of the manifest as streams and
validate every record. A payload that has been written already is a revisit record.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewright.names import column
from tidewright.work import new_folder, stage

# The magic number of the skippable frame that holds a dictionary, and of any frame (fixed values).
_DICTIONARY_FRAME, _SKIPPABLE, _FRAME = 0x184D2A5D, range(0x184D2A50, 0x184D2A60), 0xFD2FB528
_VERSION = "WARC/1.1"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_TYPES = ("response", "revisit")
_READ_BYTES = 1 << 18


class InvalidRecord(ValueError):
    """A frame that isn't a well-formed record."""


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def _page_id(record_id: str) -> int | None:
    if not (record_id.startswith("<urn:x-page:") and record_id.endswith(">")):
        raise InvalidRecord(f"record id {record_id!r}")
    return int(record_id[12:-1]) if record_id[12:-1] else None


def encode_record(
    page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, is_revisit: bool, date: str
) -> bytes:
    """A response, or a revisit without its payload; the digest is the payload's either way."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if is_revisit else http + payload
    headers = [
        ("WARC-Type", "revisit" if is_revisit else "response"),
        ("WARC-Record-ID", _record_id(page_id)),
        ("WARC-Date", date),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}"),
        ("WARC-Block-Digest", f"sha1:{payload_digest(block)}"),
    ]
    if url is not None:
        # Nothing in a URL may end its line.
        headers.append(("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~-._")))
    if is_revisit:
        headers += [("WARC-Refers-To", _record_id(refers_to)), ("WARC-Profile", _REVISIT)]
    headers.append(("Content-Length", str(len(block))))
    head = "".join(f"{name}: {value}\r\n" for name, value in headers)
    return f"{_VERSION}\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


def decode_record(record: bytes) -> dict:
    """The fields of a record, after checking its header, lengths and digests."""
    head, found, block = record.partition(b"\r\n\r\n")
    if not found:
        raise InvalidRecord("a header without an end")
    lines = head.decode("utf-8").split("\r\n")
    if lines[0] != _VERSION:
        raise InvalidRecord(f"version {lines[0]!r}")
    headers: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name or name.lower() in headers:
            raise InvalidRecord(f"header line {line!r}")
        headers[name.lower()] = value.strip()
    if missing := {"warc-type", "warc-record-id", "warc-date", "content-length", "warc-payload-digest"} - {*headers}:
        raise InvalidRecord(f"no {sorted(missing)}")
    if headers["warc-type"] not in _TYPES:
        raise InvalidRecord(f"type {headers['warc-type']!r}")
    datetime.strptime(headers["warc-date"], "%Y-%m-%dT%H:%M:%SZ")
    length = headers["content-length"]
    if not length.isdigit() or len(block) != int(length) + 4 or block[-4:] != b"\r\n\r\n":
        raise InvalidRecord(f"{len(block) - 4} bytes where the header says {length}")
    block = block[:-4]
    if headers.get("warc-block-digest", f"sha1:{payload_digest(block)}") != f"sha1:{payload_digest(block)}":
        raise InvalidRecord("the block has another digest")
    http, found, payload = block.partition(b"\r\n\r\n")
    fields = dict(line.partition(": ")[::2] for line in http.decode("latin-1").split("\r\n")[1:])
    size = fields.get("Content-Length", "")
    if not found or not http.startswith(b"HTTP/1.") or not size.isdigit():
        raise InvalidRecord("no HTTP header")
    digest = headers["warc-payload-digest"].removeprefix("sha1:")
    is_revisit = headers["warc-type"] == "revisit"
    if is_revisit and (payload or headers.get("warc-profile") != _REVISIT or "warc-refers-to" not in headers):
        raise InvalidRecord("a revisit with a payload, or without what it refers to")
    if not is_revisit and (len(payload) != int(size) or payload_digest(payload) != digest):
        raise InvalidRecord("the payload has another length or digest")
    return {
        "page_id": _page_id(headers["warc-record-id"]),
        "url": headers.get("warc-target-uri"),
        "payload": None if is_revisit else payload,
        "payload_bytes": int(size),
        "payload_digest": digest,
        "record_type": headers["warc-type"],
        "refers_to": _page_id(headers["warc-refers-to"]) if is_revisit else None,
    }


def train_dictionary(payloads: list[bytes], dictionary_bytes: int) -> bytes:
    """A dictionary for such payloads; empty if they are too few to train one."""
    try:
        return zstandard.train_dictionary(dictionary_bytes, payloads).as_bytes() if len(payloads) >= 8 else b""
    except zstandard.ZstdError:
        return b""


def archive_head(dictionary: bytes) -> bytes:
    """The skippable frame with the dictionary, itself compressed; nothing for none."""
    if not dictionary:
        return b""
    packed = zstandard.ZstdCompressor(level=19).compress(dictionary)
    return struct.pack("<II", _DICTIONARY_FRAME, len(packed)) + packed


def compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=3, dict_data=data, write_checksum=True, write_content_size=True)


def read_archive(stream: BinaryIO) -> Iterator[dict]:
    """The records of an archive, one frame at a time, whatever its length.

    The dictionary is that of the first frame, if it is skippable, as bytes or as a frame
    of its own; other skippable frames are passed over. A frame must hold
    exactly one record and end before the archive does.
    """
    held = b""

    def at_least(n: int) -> bytes:
        nonlocal held
        while len(held) < n and (more := stream.read(max(_READ_BYTES, n - len(held)))):
            held += more
        return held

    dictionary, is_first = None, True
    while at_least(4):
        if len(held) < 4:
            raise InvalidRecord("bytes after the last frame")
        (magic,) = struct.unpack("<I", held[:4])
        if magic in _SKIPPABLE:
            (size,) = struct.unpack("<I", at_least(8)[4:8])
            if len(at_least(8 + size)) < 8 + size:
                raise InvalidRecord("a skippable frame that isn't whole")
            content, held = held[8 : 8 + size], held[8 + size :]
            if is_first and magic == _DICTIONARY_FRAME:
                if content[:4] == struct.pack("<I", _FRAME):
                    content = zstandard.ZstdDecompressor().decompress(content)
                dictionary = zstandard.ZstdCompressionDict(content)
        elif magic == _FRAME:
            frame = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
            parts = [frame.decompress(held)]
            while not frame.eof:
                if not (more := stream.read(_READ_BYTES)):
                    raise InvalidRecord("a frame that isn't whole")
                parts.append(frame.decompress(more))
            held = frame.unused_data
            yield decode_record(b"".join(parts))
        else:
            raise InvalidRecord(f"neither a frame nor skippable: {magic:#x}")
        is_first = False


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder as a URI: a path without a scheme is in Spark's default file system, not on a task's own disk."""
    if ":" in folder.partition("/")[0]:
        return folder
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def file_system(folder: str) -> tuple[pa.fs.FileSystem, str]:
    """The store of a folder given as a URI or as a path, and the path in it."""
    if ":" in folder.partition("/")[0]:
        return pa.fs.FileSystem.from_uri(folder if "://" in folder else folder.replace("file:", "file://", 1))
    return pa.fs.LocalFileSystem(), folder


def mark_revisits(df: DataFrame, id_column: str, url_column: str, payload_column: str, least_bytes: int) -> DataFrame:
    """``page_id, url, payload, keeper``: which row holds the same payload as a response.

    Of rows with equal payloads of at least ``least_bytes`` that is the largest identifier;
    smaller payloads are their own keepers. The largest is found by aggregating digests,
    combined before the shuffle; the join back lets a hot payload be split.
    """
    rows = df.select(
        column(id_column).cast("long").alias("page_id"),
        column(url_column).cast("string").alias("url"),
        F.coalesce(column(payload_column), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    keepers = rows.groupBy("digest").agg(F.max("page_id").alias("keeper"))
    own = F.octet_length("payload") < least_bytes
    return rows.join(keepers, "digest").select(
        "page_id", "url", "payload", F.when(own, F.col("page_id")).otherwise(F.col("keeper")).alias("keeper")
    )


def payload_sample(df: DataFrame, payload_column: str, rows: int, sample_bytes: int) -> list[bytes]:
    """The first ``sample_bytes`` of up to ``rows`` different payloads: those of the smallest hashes.

    Hashes are counted by their leading zeros, 65 estimates in all, so that only about as
    many payloads as are wanted, at most some thousands, leave the tasks, however many there are.
    """
    head = F.substring(F.coalesce(column(payload_column), F.lit("")).cast("binary"), 1, sample_bytes)
    heads = df.select(head.alias("head")).where("octet_length(head) > 0").select("head", F.xxhash64("head").alias("hash"))
    zeros = F.when(F.col("hash") == 0, 64).otherwise(64 - F.length(F.bin("hash")))
    counts = heads.groupBy(zeros.alias("zeros")).agg(F.approx_count_distinct("hash").alias("n")).collect()
    least, found = 64, 0
    for row in sorted(counts, key=lambda row: -row["zeros"]):
        # The estimates are within about a tenth.
        least, found = row["zeros"], found + row["n"]
        if found >= 1.25 * rows:
            break
    chosen = heads.where(zeros >= least).groupBy("hash").agg(F.any_value("head").alias("head"))
    return [bytes(row["head"]) for row in chosen.orderBy("hash").limit(rows).select("head").collect()]


def write_archives(
    df: DataFrame,
    folder: str,
    *,
    id_column: str = "page_id",
    url_column: str = "url",
    payload_column: str = "html",
    revisit_bytes: int = 0,
    archive_bytes: int = 32 << 20,
    dictionary_bytes: int = 32 << 10,
    sample_rows: int = 1_000,
    sample_bytes: int = 8 << 10,
    date: datetime = datetime(2024, 1, 1, tzinfo=timezone.utc),
) -> DataFrame:
    """Write a record for each row; the manifest (``path, records, bytes``) comes back staged.

    A null payload is empty, a null URL is left out, a null identifier is written as
    none. Repeated rows are repeated records; those with the largest identifier of
    a payload are all responses. Archives are closed at about ``archive_bytes``, a record is
    never cut. ``folder`` is a URI or a path in Spark's default file system, which all executors reach. A task that is run
    again writes other files; only those in the manifest count. The dictionary is fitted
    to the first ``sample_bytes`` of ``sample_rows`` different payloads, chosen by their hash; with few
    rows, or none, there is no dictionary. An empty table gives an empty manifest.
    """
    marked = mark_revisits(df, id_column, url_column, payload_column, revisit_bytes)
    folder = qualified(df.sparkSession, folder)
    dictionary = train_dictionary(payload_sample(df, payload_column, sample_rows, sample_bytes), dictionary_bytes)
    stamp = date.strftime("%Y-%m-%dT%H:%M:%SZ")

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = file_system(folder)
        store.create_dir(root, recursive=True)
        packer, first = compressor(dictionary), archive_head(dictionary)
        out, name, done, size, records = None, "", [], 0, 0
        for batch in batches:
            for page_id, url, payload, keeper in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    name = f"{root.rstrip('/')}/part-{uuid.uuid4().hex}.warc.zst"
                    out, size, records = store.open_output_stream(name, compression=None), len(first), 0
                    out.write(first)
                frame = packer.compress(encode_record(page_id, url, payload, keeper, page_id != keeper, stamp))
                out.write(frame)
                size, records = size + len(frame), records + 1
                if size >= archive_bytes:
                    out.close()
                    done.append((name, records, size))
                    out = None
        if out is not None:
            out.close()
            done.append((name, records, size))
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, kind) for values, kind in zip(zip(*done), (pa.string(), pa.int64(), pa.int64()))],
                ["path", "records", "bytes"],
            )

    return stage(marked.mapInArrow(written, "path string, records long, bytes long"))


_FIELDS = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
])
_BATCH_BYTES = 8 << 20


def read_archives(manifest: DataFrame, folder: str, *, payloads: bool = True) -> DataFrame:
    """The records of the archives whose ``path`` the manifest names, each validated.

    Returns ``page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to``;
    a revisit's payload is null, its length and digest are those of the full payload.
    Without ``payloads`` the payloads are checked and then dropped. An invalid
    record, or an archive with another number of records than the manifest says,
    fails the task. Archives are dealt out over the tasks and read as streams, so
    memory follows the longest record. An empty manifest gives no rows.
    """
    folder = qualified(manifest.sparkSession, folder)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = file_system(folder)
        for batch in batches:
            for path, records in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows, size, n = [], 0, 0
                with store.open_input_stream(path, compression=None) as stream:
                    for record in read_archive(stream):
                        n += 1
                        size += len(record["payload"] or b"") if payloads else 0
                        rows.append(record if payloads else record | {"payload": None})
                        if size >= _BATCH_BYTES or len(rows) >= 5_000:
                            yield pa.RecordBatch.from_pylist(rows, _FIELDS)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _FIELDS)
                if n != records:
                    raise InvalidRecord(f"{path} holds {n} records, not {records}")

    tasks = manifest.sparkSession.sparkContext.defaultParallelism
    dealt = manifest.select("path", "records").repartition(max(tasks, 1), "path")
    return dealt.mapInArrow(
        read,
        "page_id long, url string, payload binary, payload_bytes long, payload_digest string, "
        "record_type string, refers_to long",
    )


def archive_round_trip(df: DataFrame, **settings) -> DataFrame:
    """Write all rows into archives of the shared folder, and read them back without payloads."""
    folder = new_folder(df.sparkSession, "warc")
    return read_archives(write_archives(df, folder, **settings), folder, payloads=False)
