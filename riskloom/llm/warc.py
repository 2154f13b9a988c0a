"""WARC archives in seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each holding some whole
records, and a last skippable frame with the seek table (compressed and plain
size of every frame, then their number and the format's magic). The index maps
a record to its bundle, frame and offset inside the plain frame, so one record
costs one frame.

A page whose payload of at least ``LEAST_SHARED`` bytes equals that of a page
with a larger id is a ``revisit`` record without payload that names that page;
all others are ``response`` records. Bundles go to the shared folder under a
name of their own for each task attempt; the index names only bundles of
attempts that ended well, so a rerun task leaves no wrong record behind.

A null html is an empty payload; a null url is written as ``urn:page:<id>``.
Rows that repeat a page id write a record each; of equal large payloads every
row with the largest id is a response. Rows without page_id have responses.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from .common import arrow_map, scratch_dir, text_bytes, written

LEAST_SHARED = 1000
FRAME = 1 << 20           # plain bytes after which a frame ends
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1  # fixed values of the format

INDEX = StructType([StructField("page_id", LongType()), StructField("bundle", StringType()),
                    StructField("frame", IntegerType()), StructField("offset", LongType()),
                    StructField("length", LongType())])
RECORD = StructType([StructField("page_id", LongType()), StructField("payload_bytes", LongType()),
                     StructField("payload_digest", StringType()), StructField("record_type", StringType()),
                     StructField("refers_to", LongType())])


def record(page: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; a revisit keeps the digest and length of its payload."""
    name = f"urn:page:{page}"
    digest = hashlib.sha1(payload).hexdigest()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <{name}>", "WARC-Date: 1970-01-01T00:00:00Z",
            f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~') if url else name}",
            f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(payload)}"]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers, HTTP payload and the end of the record that starts at ``at``."""
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("no WARC record at this offset")
    head = dict(x.split(": ", 1) for x in lines[1:])
    stop = end + 4 + int(head["Content-Length"])
    body = data.index(b"\r\n\r\n", end + 4) + 4
    return head, data[body:stop], stop + 4


class BundleWriter:
    """Frames of whole records, then the seek table."""

    def __init__(self, sink, frame: int = FRAME, level: int = 3):
        self.sink, self.size, self.zstd = sink, frame, zstandard.ZstdCompressor(level=level)
        self.plain, self.held, self.table = [], 0, []

    def add(self, rec: bytes) -> tuple[int, int]:
        """Frame number and offset of the record."""
        at = (len(self.table), self.held)
        self.plain.append(rec)
        self.held += len(rec)
        if self.held >= self.size:
            self.flush()
        return at

    def flush(self) -> None:
        if self.plain:
            packed = self.zstd.compress(b"".join(self.plain))
            self.sink.write(packed)
            self.table.append((len(packed), self.held))
            self.plain, self.held = [], 0

    def close(self) -> None:
        self.flush()
        rows = b"".join(struct.pack("<II", *x) for x in self.table)
        foot = struct.pack("<IBI", len(self.table), 0, SEEKABLE)
        self.sink.write(struct.pack("<II", SKIPPABLE, len(rows) + len(foot)) + rows + foot)


class BundleReader:
    """Random access by frame through the seek table at the end of the file."""

    def __init__(self, source, size: int):
        self.source = source
        source.seek(size - 9)
        count, _, magic = struct.unpack("<IBI", source.read(9))
        if magic != SEEKABLE:
            raise ValueError("no seek table at the end of the bundle")
        source.seek(size - 9 - 8 * count)
        raw = source.read(8 * count)
        self.frames, at = [], 0
        for k in range(count):
            packed, plain = struct.unpack_from("<II", raw, 8 * k)
            self.frames.append((at, packed, plain))
            at += packed

    def frame(self, k: int) -> bytes:
        at, packed, plain = self.frames[k]
        self.source.seek(at)
        return zstandard.ZstdDecompressor().decompress(self.source.read(packed), max_output_size=plain or 1)

    def record(self, frame: int, offset: int) -> tuple[dict[str, str], bytes]:
        return parse(self.frame(frame), offset)[:2]


def _open(uri: str):
    """File system and path of a URI (a plain path is local)."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri if "://" in uri else uri.replace("file:", "", 1) if uri.startswith("file:") else uri)


def typed(pages: DataFrame) -> DataFrame:
    """The pages with ``refers_to``: the page a revisit names, else null."""
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                       F.coalesce("html", F.lit("")).cast("binary").alias("html"))
    big = (own.filter((F.octet_length("html") >= LEAST_SHARED) & F.col("page_id").isNotNull())
           .select("page_id", F.sha1("html").alias("_sha")))
    last = big.groupBy("_sha").agg(F.max("page_id").alias("_to"), F.count("*").alias("_n")).filter("_n > 1")
    # only pages that refer to another go through the join on page ids, without their html
    refers = written(big.join(last, "_sha").filter("page_id <> _to")
                     .select("page_id", "_sha", F.col("_to").alias("refers_to")).distinct())
    sha = F.when(F.octet_length("html") >= LEAST_SHARED, F.sha1("html"))
    return own.withColumn("_sha", sha).join(refers, ["page_id", "_sha"], "left").drop("_sha")


def write_bundles(pages: DataFrame, folder: str, frame: int = FRAME) -> DataFrame:
    """Writes the records of ``typed`` pages, a bundle per task; the index."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = path = sink = out = None
        try:
            for batch in batches:
                cols = batch.select(["page_id", "url", "refers_to"]).to_pydict()
                index: dict[str, list] = {f.name: [] for f in INDEX.fields}
                for page, url, to, html in zip(*cols.values(), text_bytes(batch, "html")):
                    if sink is None:
                        files, path = _open(f"{folder}/{uuid.uuid4().hex}.warc.zst")
                        sink = files.open_output_stream(path, compression=None)
                        out = BundleWriter(sink, frame)
                    rec = record(page, url, html, to)
                    k, at = out.add(rec)
                    for name, value in zip(index, (page, path.rsplit("/", 1)[-1], k, at, len(rec))):
                        index[name].append(value)
                if index["frame"]:
                    yield pa.RecordBatch.from_pydict(index, schema=_ARROW)
            if out is not None:
                out.close()
        finally:
            if sink is not None:
                sink.close()
    files, path = _open(folder)
    files.create_dir(path, recursive=True)
    return written(pages.select("page_id", "url", "refers_to", "html").mapInArrow(run, INDEX))


_ARROW = pa.schema([("page_id", pa.int64()), ("bundle", pa.string()), ("frame", pa.int32()), ("offset", pa.int64()),
                    ("length", pa.int64())])


def read_bundles(index: DataFrame, folder: str) -> DataFrame:
    """Every indexed record, read back frame by frame through the seek tables."""
    frames = index.groupBy("bundle", "frame").agg(F.sort_array(F.collect_list("offset")).alias("offsets"))

    def run(batch: pa.RecordBatch):
        name, reader, source = None, None, None
        rows: dict[str, list] = {f.name: [] for f in RECORD.fields}
        for b, k, offsets in zip(*batch.to_pydict().values()):
            if b != name:
                if source is not None:
                    source.close()
                files, path = _open(f"{folder}/{b}")
                source, name = files.open_input_file(path), b
                reader = BundleReader(source, source.size())
            data = reader.frame(k)
            for at in offsets:
                head, payload, _ = parse(data, at)
                revisit = head["WARC-Type"] == "revisit"
                digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                if not revisit and hashlib.sha1(payload).hexdigest() != digest:
                    raise ValueError(f"payload of {head['WARC-Record-ID']} doesn't match its digest")
                page = head["WARC-Record-ID"][10:-1]
                for c, value in zip(rows, (None if page == "None" else int(page), int(head["X-Payload-Length"]), digest,
                                           head["WARC-Type"], int(head["WARC-Refers-To"][10:-1]) if revisit else None)):
                    rows[c].append(value)
        if source is not None:
            source.close()
        yield rows
    return arrow_map(frames.sortWithinPartitions("bundle", "frame"), run, RECORD)


def fetch(spark: SparkSession, index: DataFrame, folder: str, page_id: int) -> tuple[dict[str, str], bytes]:
    """One record by id: an index lookup and one frame."""
    hit = index.filter(F.col("page_id") == page_id).first()
    files, path = _open(f"{folder}/{hit['bundle']}")
    with files.open_input_file(path) as source:
        return BundleReader(source, source.size()).record(hit["frame"], hit["offset"])


def archived(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes the pages as bundles and reads them back: one row per page."""
    folder = folder or scratch_dir(pages.sparkSession) + "-warc"
    return read_bundles(write_bundles(typed(pages), folder), folder)
