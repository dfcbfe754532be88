"""WARC archives: a deterministic sharded writer, and a reader.

Records are cut into shards by ranges of their id: the boundaries are found by counting exact
bytes, so equal input gives equal shards. Every shard is sorted and written by one task as a row
of files, a new one as soon as the compressed size reaches ``roll_bytes``. Each record is a gzip
member of its own. A file is written under a temporary name that no other attempt uses and then
renamed; its bytes depend on its records only, so a repeated task replaces a file by an equal one.
The manifest commits the archive: a table of the finished files in the archive's own folder, likewise
written under a temporary name and renamed last. Readers take the files that it names and no others; a
folder without manifest is an unfinished archive. After the commit the files of broken attempts are removed with the folder
of temporary names, so one folder has one writer at a time. A folder with a manifest is refused, not written over.

Of records with equal payloads of at least ``MIN_REVISIT`` bytes, the one with the largest id holds
the payload, the others are revisits of it. Who revisits whom is found from digests alone;
those rows travel next to the records in the one exchange that moves payloads.

Defined cases: a null html is an empty payload; a null url has no target; a record without id
comes first and can only be a revisit or unique; records with the largest id in common are all
responses; repeated rows are written as often as they occur; no rows give no files but a manifest without lines. A very
long payload is one record, packed in pieces; its task holds it a few times. Rows of one id are ordered by digest and
url, so ties give the same bytes in every run. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perkline.llm.sharding import splitters
from perkline.llm.shipping import ship_library
from perkline.llm.storage import stored

MIN_REVISIT = 1000
DATE = "2024-01-01T00:00:00Z"  # the archive's own date is a parameter, not the time of writing
PRINTABLE = "".join(map(chr, range(0x21, 0x7F))).replace("%", "")
RECORD_FRAME = 512  # bytes of headers, about
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "shard int, part int, file string, records long, bytes long, sha256 string"
MANIFEST_NAME, TEMPORARY = "manifest", "_temporary"  # folders inside the archive
RECORD = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long"


def _base32(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{digest}')}>"


def record_bytes(page_id, url, digest: str, size: int, payload: bytes | None, refers_to, date: str = DATE) -> bytes:
    """One record; without payload a revisit of the record ``refers_to``."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload or b"")
    revisit = refers_to is not None
    headers = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Date: {date}",
        f"WARC-Record-ID: {record_id(page_id, digest)}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{_base32(digest)}",
        f"WARC-Block-Digest: sha1:{_base32(hashlib.sha1(block).hexdigest())}",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        headers.append(f"WARC-Target-URI: {quote(url, safe=PRINTABLE)}")
    if page_id is not None:
        headers.append(f"Page-ID: {page_id}")
    if revisit:
        headers += [
            f"WARC-Profile: {REVISIT_PROFILE}",
            f"WARC-Refers-To: {record_id(refers_to, digest)}",
            f"Refers-To-Page-ID: {refers_to}",
        ]
    return ("\r\n".join(headers) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def _zipped(record: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)  # no time and no name in the member's header
    return packer.compress(record) + packer.flush()


def _filesystem(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


class _Files:
    """The files of one shard, one after the other."""

    def __init__(self, folder: str, roll_bytes: int):
        self.folder, self.roll_bytes = folder, roll_bytes
        self.fs, self.path = _filesystem(folder)
        self.shard, self.part, self.out = None, 0, None

    def add(self, shard: int, record: bytes) -> Iterator[tuple]:
        if shard != self.shard:
            yield from self.close()
            self.shard, self.part = shard, 0
        if self.out is None:
            self.name = f"shard-{shard:06d}-{self.part:05d}.warc.gz"
            self.temporary = f"{self.path}/{TEMPORARY}/{uuid.uuid4().hex}-{self.name}"
            self.out = self.fs.open_output_stream(self.temporary, compression=None)
            self.records, self.size, self.digest = 0, 0, hashlib.sha256()
        member = _zipped(record)
        self.out.write(member)
        self.digest.update(member)
        self.records, self.size = self.records + 1, self.size + len(member)
        if self.size >= self.roll_bytes:
            yield from self.close()

    def close(self) -> Iterator[tuple]:
        if self.out is not None:
            self.out.close()
            self.out = None
            self.fs.move(self.temporary, f"{self.path}/{self.name}")
            yield self.shard, self.part, self.name, self.records, self.size, self.digest.hexdigest()
            self.part += 1


def write_archives(
    pages: DataFrame, folder: str, shard_bytes: int = 32 << 20, roll_bytes: int = 8 << 20, date: str = DATE
) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) as archives into ``folder``, which all executors reach, and
    returns the manifest. ``roll_bytes`` counts compressed bytes."""
    ship_library(pages.sparkSession)
    payload = F.coalesce(F.col("html").cast("binary"), F.lit("").cast("binary"))
    records = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"), F.sha1(payload).alias("digest")
    )
    sizes = stored(records.select("page_id", "digest", F.octet_length("payload").cast("long").alias("size")), "warc-sizes")
    low, high, total = sizes.select(
        F.min("page_id"), F.max("page_id"), F.sum(F.col("size") + RECORD_FRAME)
    ).first()
    low, n_shards = low or 0, max(1, -(-(total or 0) // shard_bytes))
    place = F.coalesce("page_id", F.lit(low)) - F.lit(low)
    share = (total or 0) / n_shards
    weighed = sizes.select(place.alias("place"), (F.col("size") + RECORD_FRAME).alias("weight"))
    targets = [share * (i + 1) for i in range(n_shards - 1)]
    bits = max(1, ((high or 0) - low).bit_length())
    bounds = splitters(weighed, "place", "weight", targets, share / 100, bits) if targets else []

    def sharded(df: DataFrame) -> DataFrame:
        # How many boundaries are not above the record; the array is short and sorted.
        above = F.array_size(F.filter(F.lit(bounds) if bounds else F.array().cast("array<long>"), lambda b: b <= place))
        return df.withColumn("shard", above.cast("int"))

    keeper = (
        sizes.where(F.col("size") >= MIN_REVISIT)
        .groupBy("digest")
        .agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n"))
        .where("n > 1")
    )
    revisits = (
        sizes.join(keeper, "digest")
        .where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
        .select("page_id", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"), "digest", "refers_to")
        .distinct()
    )
    rows = sharded(records.withColumn("refers_to", F.lit(None).cast("long")).unionByName(revisits)).withColumn(
        "record", F.col("refers_to").isNull()
    )
    # A notice that a record revisits stands right before the record.
    exchanged = rows.repartitionById(n_shards, "shard").sortWithinPartitions("shard", "page_id", "digest", "record", "url")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = _Files(folder, roll_bytes)
        done: list[tuple] = []
        notice = (None, None, None)
        for batch in batches:
            columns = [batch.column(c) for c in ("shard", "page_id", "url", "payload", "digest", "refers_to", "record")]
            for i in range(batch.num_rows):
                shard, page_id, url, body, digest, refers_to, record = (c[i].as_py() for c in columns)
                if not record:
                    notice = (page_id, digest, refers_to)
                    continue
                refers_to = notice[2] if notice[:2] == (page_id, digest) else None
                kept = body if refers_to is None else None
                done += files.add(shard, record_bytes(page_id, url, digest, len(body), kept, refers_to, date))
        done += files.close()
        columns = list(zip(*done)) if done else [()] * 6
        kinds = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string())
        names = [c.split()[0] for c in MANIFEST.split(", ")]
        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    files, path = _filesystem(folder)
    files.create_dir(f"{path}/{TEMPORARY}", recursive=True)
    if files.get_file_info(f"{path}/{MANIFEST_NAME}").type != fs.FileType.NotFound:
        raise FileExistsError(f"{folder} holds a finished archive")
    written = stored(exchanged.mapInArrow(work, MANIFEST), "warc-files")
    _commit(written, folder, files, path)
    return read_manifest(pages.sparkSession, folder)


def _commit(written: DataFrame, folder: str, files: fs.FileSystem, path: str) -> None:
    name = f"{TEMPORARY}/{uuid.uuid4().hex}-{MANIFEST_NAME}"
    written.write.json(f"{folder}/{name}")
    files.move(f"{path}/{name}", f"{path}/{MANIFEST_NAME}")
    files.delete_dir(f"{path}/{TEMPORARY}")


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The files of a finished archive, as ``MANIFEST``; raises if it has no manifest."""
    return spark.read.schema(MANIFEST).json(f"{folder}/{MANIFEST_NAME}")


_LENGTH = re.compile(rb"(?mi)^Content-Length: *(\d+)")


def _members(stream) -> Iterator[bytes]:
    """The gzip members of a file, unpacked, without holding more than one of them."""
    unpacker, parts, rest = zlib.decompressobj(31), [], b""
    while True:
        block = rest or stream.read(1 << 20)
        if not block:
            break
        parts.append(unpacker.decompress(block))
        rest = unpacker.unused_data
        if unpacker.eof:
            yield b"".join(parts)
            unpacker, parts = zlib.decompressobj(31), []
        else:
            rest = b""
    if parts:
        raise ValueError("an archive ends inside a record")


def read_record(record: bytes) -> tuple:
    """(page_id, url, record_type, payload bytes, digest, refers_to); raises if a digest does not fit."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"not a record: {lines[0]!r}")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(headers["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(_LENGTH.search(http)[1])
    digest = base64.b32decode(headers["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    if headers["WARC-Block-Digest"] != "sha1:" + _base32(hashlib.sha1(block).hexdigest()):
        raise ValueError(f"damaged block in {headers['WARC-Record-ID']}")
    revisit = headers["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"damaged payload in {headers['WARC-Record-ID']}")
    number = lambda name: int(headers[name]) if name in headers else None
    url = unquote(headers["WARC-Target-URI"]) if "WARC-Target-URI" in headers else None
    return number("Page-ID"), url, headers["WARC-Type"], size, digest, number("Refers-To-Page-ID")


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """The records of the files that the manifest names, as ``RECORD``."""
    ship_library(manifest.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = _filesystem(folder)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                with files.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    rows = []
                    for member in _members(stream):
                        rows.append(read_record(member))
                        if len(rows) == 5000:
                            yield _record_batch(rows)
                            rows = []
                    yield _record_batch(rows)

    spread = manifest.select("file").repartition(max(1, manifest.count()), "file")
    return spread.mapInArrow(work, RECORD)


def _record_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64())
    columns = list(zip(*rows)) if rows else [()] * 6
    return pa.record_batch(
        [pa.array(c, k) for c, k in zip(columns, kinds)], names=[c.split()[0] for c in RECORD.split(", ")]
    )
