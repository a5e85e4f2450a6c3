"""WARC archives: writing, normalising monolithic gzip, and reading by offset.

`write_archives` writes one gzip stream over a whole archive (one record after the other), as many
tools leave them. `normalise` inflates each such stream once, piece by piece, rewrites
every record as a gzip member of its own, and writes a sidecar index (one JSON line for each record:
offset and length of the member, record id, type, page, digest). `read_archives` takes
the sidecar indexes with Spark and reads the members at their offsets. A task that is run again
writes the same files under the same names: each file is written beside its place and then moved.

Duplicates: of records with equal payloads of at least `least` bytes, that with the smallest page_id is the
response; the others are revisit records, which hold the payload's digest and size and the response's
page_id instead of the payload.

Files are opened with pyarrow's file systems, so that any folder URI that executors share will do.

Cases: a null html is an empty payload. A null url leaves its header out; control characters and
spaces in a url are percent-encoded. Null page_ids: the header is left out; such a row is a response only
if no row with an id has its payload, and then all of them are. Repeated rows that hold the smallest id are
all responses. Empty payloads and payloads shorter than `least` are always responses. An empty
table gives archives without records and an empty result. Only page_id, url and html are read.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, shared_dir, table

LEAST = 100
PAGES_PER_FILE = 4000
CHUNK = 1 << 18
STRETCH = 8 << 20
_NOW = "2024-01-01T00:00:00Z"  # fixed, so that reruns write the same bytes


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri else uri.replace("file:", "file://", 1) if uri.startswith("file:") else f"file://{uri}")


class _Placed:
    """An output file that is moved to its place when it is complete."""

    def __init__(self, uri: str) -> None:
        self.fs, self.path = _open(uri)
        self.beside = f"{self.path}.{uuid.uuid4().hex}.tmp"
        self.out: pa.NativeFile | None = None

    def there(self) -> bool:
        return self.fs.get_file_info(self.path).type == pafs.FileType.File

    def write(self, data: bytes) -> None:
        if self.out is None:
            self.out = self.fs.open_output_stream(self.beside, compression=None)
        self.out.write(data)

    def done(self) -> None:
        self.write(b"")
        self.out.close()
        self.fs.move(self.beside, self.path)


def _url(text: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in text)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None, revisit: bool) -> bytes:
    """One WARC record. A revisit has the payload's digest and size, and the page that holds it."""
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}|{url}|{digest}')}>", f"WARC-Date: {_NOW}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_url(url)}")
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    head += [f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {len(payload)}"]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Refers-To-Page: {first}"]
    block = http if revisit else http + payload
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def firsts(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """page_id, digest and the smallest page_id of the rows with an equal payload (null if the row stands alone or is small)."""
    html = F.coalesce("html", F.lit(""))
    slim = cut(pages.select("page_id", F.sha2(html, 256).alias("digest"), F.octet_length(html).alias("size")))
    same = slim.where(F.col("size") >= least).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    return slim.join(same, "digest", "left").select("page_id", "digest", "first").distinct()


def write_archives(pages: DataFrame, folder: str, files: int, least: int = LEAST) -> DataFrame:
    """Writes one monolithic gzip archive for each task and returns their names (archive)."""
    html = F.coalesce("html", F.lit(""))
    key = F.coalesce(F.col("page_id").cast("string"), F.lit("")).alias("_key")
    # both sides are dealt alike, so the payloads are shuffled once, for the join and for the files
    rows = pages.select("page_id", "url", html.alias("html"), F.sha2(html, 256).alias("digest"), key).repartition(files, "_key", "digest")
    known = firsts(pages, least).select(key, "digest", "first").repartition(files, "_key", "digest")
    rows = rows.join(known, ["_key", "digest"], "left").select("page_id", "url", "html", "digest", "first")
    rows = rows.sortWithinPartitions("page_id", "url", "digest")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = f"{folder}/whole/part-{TaskContext.get().partitionId():06d}.warc.gz"
        placed, packer = _Placed(name), zlib.compressobj(3, zlib.DEFLATED, 31)
        for b in batches:
            for page_id, url, text, digest, first in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "html", "digest", "first")), strict=True):
                again = first is not None and page_id != first
                placed.write(packer.compress(record(page_id, url, text.encode(), digest, first, again)))
        placed.write(packer.flush())
        placed.done()
        yield pa.RecordBatch.from_arrays([pa.array([name])], ["archive"])

    return rows.mapInArrow(make, "archive string")


def _records(stream: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes, bytes]]:
    """Headers, whole record and block of each record of inflated WARC bytes."""
    held = bytearray()
    more = True

    def fill(n: int) -> bool:
        nonlocal more
        while len(held) < n and more:
            part = next(stream, None)
            if part is None:
                more = False
            else:
                held.extend(part)
        return len(held) >= n

    while fill(1):
        end, n = held.find(b"\r\n\r\n"), CHUNK
        while end < 0 and fill(n):
            end, n = held.find(b"\r\n\r\n"), n + CHUNK
        if end < 0 and (end := held.find(b"\r\n\r\n")) < 0:
            raise ValueError("a record without end of headers")
        head = dict(x.split(": ", 1) for x in held[:end].decode().split("\r\n")[1:])
        size = int(head["Content-Length"])
        total = end + 4 + size + 4
        if not fill(total):
            raise ValueError("a record is cut off")
        whole = bytes(held[:total])
        del held[:total]
        yield head, whole, whole[end + 4 : end + 4 + size]


def _inflate(source: pa.NativeFile) -> Iterator[bytes]:
    """The bytes of a gzip file of one or more members, piece by piece."""
    inflater, data = zlib.decompressobj(31), source.read(CHUNK)
    while data:
        out = inflater.decompress(data, CHUNK)
        if out:
            yield out
        data = inflater.unconsumed_tail
        if inflater.eof:
            data, inflater = inflater.unused_data, zlib.decompressobj(31)
        data = data or source.read(CHUNK)
    if out := inflater.flush():
        yield out


def normalise(archives: DataFrame, folder: str, keep: bool = False) -> DataFrame:
    """Rewrites each archive with a member for each record, with a sidecar index; returns archive and records.

    archives has one name in each of its partitions, so each archive is a task of its own. A monolithic archive is deleted as soon as its
    members and index are in place (unless `keep`); a task that is run again after that takes what stands there.
    """

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name in b.column("archive").to_pylist():
                base = name.rsplit("/", 1)[1].removesuffix(".warc.gz")
                target, index = _Placed(f"{folder}/members/{base}.warc.gz"), _Placed(f"{folder}/index/{base}.jsonl")
                fs, path = _open(name)
                offset = n = 0
                if fs.get_file_info(path).type == pafs.FileType.NotFound and target.there() and index.there():
                    with index.fs.open_input_stream(index.path, compression=None) as lines:
                        n = sum(part.count(b"\n") for part in iter(lambda: lines.read(CHUNK), b""))
                    yield pa.RecordBatch.from_arrays([pa.array([base]), pa.array([n])], ["archive", "records"])
                    continue
                with fs.open_input_stream(path, compression=None) as source:
                    for head, whole, _ in _records(_inflate(source)):
                        packer = zlib.compressobj(3, zlib.DEFLATED, 31)
                        member = packer.compress(whole) + packer.flush()
                        line = {"archive": base, "offset": offset, "length": len(member), "id": head["WARC-Record-ID"], "type": head["WARC-Type"], "page": head.get("X-Page-ID"), "digest": head["WARC-Payload-Digest"]}
                        target.write(member)
                        index.write(json.dumps(line).encode() + b"\n")
                        offset, n = offset + len(member), n + 1
                target.done()
                index.done()
                if not keep:
                    fs.delete_file(path)
                yield pa.RecordBatch.from_arrays([pa.array([base]), pa.array([n])], ["archive", "records"])

    return archives.mapInArrow(make, "archive string, records long")


INDEX = "archive string, offset long, length long, id string, type string, page string, digest string"


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Every record, read at its offset: page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload.

    The payload of a response is what the archive holds, and its size and digest are counted from it; a
    revisit gives the size and digest that its headers state, and a null payload.
    """
    index = spark.read.schema(INDEX).json(f"{folder}/index")
    stretch = F.floor(F.col("offset") / STRETCH)
    rows = index.select("archive", "offset", "length")
    n = rows.select("archive", stretch).distinct().count()  # a task for each stretch of an archive, however small the index is
    rows = rows.repartition(max(1, n), "archive", stretch).sortWithinPartitions("archive", "offset")
    schema = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"
    names = [x.split()[0] for x in schema.split(", ")]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, source = None, None
        for b in batches:
            out = []
            for name, offset, length in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if name != opened:
                    fs, path = _open(f"{folder}/members/{name}.warc.gz")
                    opened, source = name, fs.open_input_file(path)
                source.seek(offset)
                ((head, _, block),) = _records(iter([zlib.decompress(source.read(length), 31)]))
                page, url, kind = head.get("X-Page-ID"), head.get("WARC-Target-URI"), head["WARC-Type"]
                page = None if page is None else int(page)
                if kind == "revisit":
                    out.append((page, url, kind, int(head["X-Refers-To-Page"]), int(head["X-Payload-Length"]), head["WARC-Payload-Digest"].split(":")[1], None))
                else:
                    payload = block[block.index(b"\r\n\r\n") + 4 :]
                    out.append((page, url, kind, None, len(payload), hashlib.sha256(payload).hexdigest(), payload))
            if out:
                types = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)], names)

    return rows.mapInArrow(make, schema)


def archive(pages: DataFrame, folder: str | None = None, least: int = LEAST, pages_per_file: int = PAGES_PER_FILE, keep: bool = False) -> str:
    """Writes pages as normalised archives and returns their folder (members/ and index/; with `keep` also the monolithic whole/)."""
    spark = pages.sparkSession
    folder = folder or f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    folder = folder if "://" in folder else "file://" + folder.removeprefix("file:")
    fs, path = _open(folder)
    for part in ("whole", "members", "index"):
        fs.create_dir(f"{path}/{part}", recursive=True)
    files = max(1, -(-pages.count() // pages_per_file))
    cut(normalise(cut(write_archives(pages, folder, files, least)), folder, keep))
    return folder


def op2_warc_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = archive(table(spark, sf_dir, "pages"))
    return read_archives(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")
