"""WARC archives in Zstandard form: write, and read back with checks.

An archive starts with a skippable frame (magic 0x184D2A5D) that holds the dictionary; each
record is a frame of its own, compressed with it. Records with equal payloads are written
once as a response; the others are revisits that refer to it and hold headers only.

Writing: each task streams its rows into archives of bounded size in the shared folder and
gives one manifest row for each. Attempts write to names of their own, and only names in the
committed manifest are read, so lost or repeated tasks leave no double records. Files go
through pyarrow's file systems, so the folder may be local, HDFS or an object store.
Reading: Spark's binary file source deals out whole archives; each is decoded frame by frame.
"""

import base64
import hashlib
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.llm.common import pick, spread
from tickforge.session import run_folder

MAGIC = 0x184D2A5D
#: Uncompressed bytes after which an archive is closed and another one begun.
ARCHIVE_BYTES = 64 << 20
#: The dictionary is trained on so many pages at most, so many bytes of each at most.
SAMPLE_PAGES, SAMPLE_BYTES, DICTIONARY_BYTES = 500, 16 << 10, 32 << 10

_VERSION = b"WARC/1.1"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class WarcError(ValueError):
    """An archive or record that does not follow the format."""


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def _clean(value) -> str:
    """A header value on one line."""
    return "".join(c if c.isprintable() else "%%%02X" % ord(c) for c in str(value or ""))


def _block(headers) -> bytes:
    return b"".join(f"{k}: {v}\r\n".encode() for k, v in headers) + b"\r\n"


def make_record(page_id, url, payload: bytes, found: str, date: str, refers_to=None) -> bytes:
    """A response record, or a revisit of the page ``refers_to``."""
    http = b"HTTP/1.1 200 OK\r\n" + _block(
        [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", len(payload))]
    )
    revisit = refers_to is not None
    block = http if revisit else http + payload
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", date),
        ("WARC-Target-URI", _clean(url)),
        ("WARC-Page-ID", page_id),
        ("WARC-Payload-Digest", f"sha1:{found}"),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", len(block)),
    ]
    if revisit:
        headers += [
            ("WARC-Profile", _PROFILE),
            ("WARC-Refers-To", record_id(refers_to)),
            ("WARC-Refers-To-Page-ID", refers_to),
        ]
    return _VERSION + b"\r\n" + _block(headers) + block + b"\r\n\r\n"


def _headers(data: bytes, end: int, start: int) -> dict[str, str]:
    out = {}
    for line in data[start:end].decode("utf-8").split("\r\n"):
        name, colon, value = line.partition(":")
        if not colon or not name or name != name.strip():
            raise WarcError(f"bad header line {line[:80]!r}")
        out[name.lower()] = value.strip()
    return out


def _length(headers, name="content-length") -> int:
    value = headers.get(name, "")
    if not value.isascii() or not value.isdigit():
        raise WarcError(f"bad length {value[:20]!r}")
    return int(value)


def parse_record(data: bytes) -> dict:
    """Headers, lengths and digests of one record, checked."""
    end = data.find(b"\r\n\r\n")
    if not data.startswith(_VERSION + b"\r\n") or end < 0:
        raise WarcError("no WARC header")
    headers = _headers(data, end, len(_VERSION) + 2)
    for name in ("warc-type", "warc-record-id", "warc-date", "warc-payload-digest"):
        if name not in headers:
            raise WarcError(f"no {name}")
    block = data[end + 4 : -4]
    if data[-4:] != b"\r\n\r\n" or len(block) != _length(headers):
        raise WarcError("the block is not as long as its header says")
    if headers.get("warc-block-digest") != f"sha1:{digest(block)}":
        raise WarcError("wrong block digest")
    cut = block.find(b"\r\n\r\n")
    if not block.startswith(b"HTTP/1.1 200") or cut < 0:
        raise WarcError("no HTTP header")
    size = _length(_headers(block, cut, block.find(b"\r\n") + 2))
    payload, kind = block[cut + 4 :], headers["warc-type"]
    if kind == "response":
        if len(payload) != size or headers["warc-payload-digest"] != f"sha1:{digest(payload)}":
            raise WarcError("the payload is not what its headers say")
    elif kind != "revisit" or payload or "warc-refers-to-page-id" not in headers:
        raise WarcError(f"bad {kind} record")
    return {
        "page_id": int(headers["warc-page-id"]),
        "url": headers.get("warc-target-uri"),
        "payload_bytes": size,
        "payload_digest": headers["warc-payload-digest"].removeprefix("sha1:"),
        "record_type": kind,
        "refers_to": int(headers["warc-refers-to-page-id"]) if kind == "revisit" else None,
        "payload": payload if kind == "response" else None,
    }


def dictionary_frame(dictionary: bytes) -> bytes:
    return MAGIC.to_bytes(4, "little") + len(dictionary).to_bytes(4, "little") + dictionary


def _decoder(data: bytes):
    """(decompressor, where the records begin)."""
    if len(data) < 8 or int.from_bytes(data[:4], "little") != MAGIC:
        raise WarcError("no leading dictionary frame")
    end = 8 + int.from_bytes(data[4:8], "little")
    if end > len(data):
        raise WarcError("the dictionary frame is cut off")
    held = data[8:end]
    if held[:4] == zstandard.FRAME_HEADER:
        held = zstandard.ZstdDecompressor().decompress(held)
    known = zstandard.ZstdCompressionDict(held) if held else None
    return zstandard.ZstdDecompressor(dict_data=known), end


def read_archive(data: bytes) -> Iterator[dict]:
    """The records of an archive, one frame each."""
    decoder, at = _decoder(data)
    view = memoryview(data)
    while at < len(data):
        one, parts = decoder.decompressobj(), []
        start = at
        while not one.eof:
            if at >= len(data):
                raise WarcError(f"the frame at {start} is cut off")
            piece = view[at : at + (1 << 16)]
            try:
                parts.append(one.decompress(piece))
            except zstandard.ZstdError as error:
                raise WarcError(f"bad frame at {start}: {error}") from error
            at += len(piece)
        at -= len(one.unused_data)
        yield parse_record(b"".join(parts))


def train_dictionary(samples: list[bytes]) -> bytes:
    """A dictionary, or plain sample bytes where there is too little to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[:DICTIONARY_BYTES]


def plan_records(pages: DataFrame, least_bytes: int) -> DataFrame:
    """(page_id, url, payload, refers_to): which record is a response and which a revisit.

    The hash of a payload and the largest id are aggregated on the map side; a payload
    that a third of all pages share is split at the join, both sides of which are shuffled.
    """
    rows = pages.withColumn("sha", F.unhex(F.sha1("payload")))
    first = rows.groupBy("sha").agg(F.max("page_id").alias("first"), F.count("*").alias("copies"))
    first = first.where("copies > 1").select("sha", "first")
    revisit = f"octet_length(payload) >= {least_bytes} and first is not null and first <> page_id"
    return rows.join(first, "sha", "left").select(
        "page_id", "url", "payload", F.expr(f"case when {revisit} then first end").alias("refers_to")
    )


def _files(folder: str):
    """File system and path of a folder URI."""
    if "://" in folder or folder.startswith("file:"):
        return fs.FileSystem.from_uri(folder)
    return fs.LocalFileSystem(), folder


def _writer(folder: str, dictionary: bytes, date: str, archive_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]):
        system, path = _files(folder)
        system.create_dir(path, recursive=True)
        packer = zstandard.ZstdCompressor(
            level=3, write_content_size=True,
            dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None,
        )
        out, name, records, size = None, None, 0, 0

        def close():
            out.close()
            return pa.RecordBatch.from_arrays(
                [pa.array([f"{folder}/{name}"]), pa.array([records], pa.int64())],
                names=["path", "records"],
            )

        for batch in batches:
            for page, url, payload, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    name, records, size = f"{uuid.uuid4().hex}.warc.zst", 0, 0
                    out = system.open_output_stream(f"{path}/{name}", compression=None)
                    out.write(dictionary_frame(dictionary))
                made = make_record(page, url, payload, digest(payload), date, refers_to)
                out.write(packer.compress(made))
                records, size = records + 1, size + len(made)
                if size >= archive_bytes:
                    yield close()
                    out = None
        if out is not None:
            yield close()

    return run


def write_archives(
    pages: DataFrame, folder: str, page_id="page_id", url="url", html="html", least_bytes=0,
    archive_bytes=ARCHIVE_BYTES,
) -> DataFrame:
    """Write the pages as archives below ``folder``; manifest: (path, records), written too.

    Payloads are the html in UTF-8, null as empty. Of payloads that are equal and have at
    least ``least_bytes`` the one with the largest page_id is the response. Rows without
    a page_id are left out. Rows that repeat an id each become a record.
    """
    spark = pages.sparkSession
    rows = pick(pages, page_id=page_id, url=url, html=html).where("page_id is not null")
    rows = rows.select(
        F.col("page_id").cast("long").alias("page_id"), "url",
        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"),
    )
    some = rows.select("page_id").orderBy(spread("page_id", 5), "page_id").limit(SAMPLE_PAGES)
    sample = rows.join(F.broadcast(some.distinct()), "page_id", "left_semi")
    sample = sample.select("page_id", F.substring("payload", 1, SAMPLE_BYTES).alias("part"))
    parts = sorted((r.page_id, bytes(r.part)) for r in sample.limit(2 * SAMPLE_PAGES).collect())
    dictionary = train_dictionary([part for _, part in parts])
    date = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    manifest = plan_records(rows, least_bytes).mapInArrow(
        _writer(f"{folder}/archives", dictionary, date, archive_bytes), "path string, records bigint"
    )
    manifest.write.parquet(f"{folder}/manifest")
    return spark.read.schema(manifest.schema).parquet(f"{folder}/manifest")


_RECORD = (
    "page_id bigint, url string, payload_bytes bigint, payload_digest string, "
    "record_type string, refers_to bigint, payload binary"
)


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """The records of the archives that the manifest names, each frame checked.

    Columns: page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload
    (null for revisits). A damaged archive fails the read. Without archives there are no rows.
    """
    spark = manifest.sparkSession
    if manifest.isEmpty():
        return spark.createDataFrame([], _RECORD)
    files = spark.read.format("binaryFile").load(f"{folder}/archives")
    named = F.element_at(F.split("path", "/"), -1)
    archives = files.select(named.alias("name"), "content").join(
        manifest.select(named.alias("name")), "name", "left_semi"
    )
    schema = pa.schema(
        [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64())]
        + [("payload_digest", pa.string()), ("record_type", pa.string())]
        + [("refers_to", pa.int64()), ("payload", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for content in batch.column(0):
                found, size = [], 0
                for record in read_archive(content.as_py()):
                    found.append(record)
                    size += len(record["payload"] or b"")
                    if len(found) >= 500 or size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(found, schema)
                        found, size = [], 0
                yield pa.RecordBatch.from_pylist(found, schema)

    # An archive has about as many bytes as Spark puts into one batch.
    return archives.select("content").mapInArrow(run, _RECORD)


def archive_folder(spark) -> str:
    return run_folder(spark, "warc")
