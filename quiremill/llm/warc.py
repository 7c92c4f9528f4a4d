"""WARC archives in Zstandard form: a writer and a validating reader.

An archive starts with a skippable frame (magic 0x184D2A5D) that holds the dictionary, itself
compressed or not; every record is one frame made with that dictionary, so a reader can start at
any frame.  Each writing task trains a small dictionary on its first records, rolls over to a new
archive at a size, writes under a temporary name and renames, so a task that runs again replaces
its own files.  The reader gets paths, not contents: a task streams one archive at a time.

Payloads are shuffled once, by their digest, with the id of the first record of that digest; that
id is a partial aggregate, and a payload that a third of all pages share is split by adaptive
execution.  A repeated payload is stored once.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quiremill.llm.common import new_folder, split_hint, staged, table

SKIPPABLE = 0x184D2A5D
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"


class WarcError(ValueError):
    """An archive that doesn't follow the format."""


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, salt: str = "") -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page/{page_id}{salt}')}>"


def _one_line(x: str) -> str:
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in x)


def record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {_one_line(v)}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return f"WARC/1.1\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


class ArchiveWriter:
    """Collects records and writes one archive: dictionary frame, then a frame per record."""

    def __init__(self, dict_bytes: int = 16 << 10, sample: int = 96, level: int = 3):
        self.dict_bytes, self.sample, self.level = dict_bytes, sample, level
        self.waiting: list[bytes] = []
        self.frames: list[bytes] = []
        self.size = 0
        self.count = 0
        self.compressor = None

    def add(self, raw: bytes) -> None:
        self.count += 1
        if self.compressor is None:
            self.waiting.append(raw)
            if len(self.waiting) >= self.sample or sum(map(len, self.waiting)) >= 4 << 20:
                self._begin()
        else:
            self._frame(raw)

    def _begin(self) -> None:
        samples = [x[: 64 << 10] for x in self.waiting]
        try:
            d = zstandard.train_dictionary(self.dict_bytes, samples, level=self.level)
        except zstandard.ZstdError:  # too few or too small samples: their beginning is a dictionary too
            d = zstandard.ZstdCompressionDict(b"".join(samples)[: self.dict_bytes] or b"WARC/1.1", dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        body = zstandard.ZstdCompressor().compress(d.as_bytes())
        self.compressor = zstandard.ZstdCompressor(level=self.level, dict_data=d, write_checksum=True, write_content_size=True)
        self.frames.append(struct.pack("<II", SKIPPABLE, len(body)) + body)
        self.size += len(self.frames[0])
        for raw in self.waiting:
            self._frame(raw)
        self.waiting = []

    def _frame(self, raw: bytes) -> None:
        self.frames.append(self.compressor.compress(raw))
        self.size += len(self.frames[-1])

    def finish(self) -> bytes:
        if self.compressor is None:
            self._begin()
        return b"".join(self.frames)


def parse_record(raw: bytes, where: str = "") -> tuple[dict[str, str], bytes]:
    """(fields by lower-case name, block); WarcError if version, fields or lengths are wrong."""
    head, sep, rest = raw.partition(b"\r\n\r\n")
    try:
        lines = head.decode("utf-8").split("\r\n")
    except UnicodeDecodeError as e:
        raise WarcError(f"{where}: the header isn't UTF-8") from e
    if not sep or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise WarcError(f"{where}: no WARC header")
    fields = {}
    for line in lines[1:]:
        k, colon, v = line.partition(":")
        if not colon or not k.strip():
            raise WarcError(f"{where}: bad field {line[:80]!r}")
        fields[k.strip().lower()] = v.strip()
    for need in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if need not in fields:
            raise WarcError(f"{where}: {need} is missing")
    if not fields["content-length"].isdigit() or len(rest) != int(fields["content-length"]) + 4 or rest[-4:] != b"\r\n\r\n":
        raise WarcError(f"{where}: content-length {fields['content-length']}, but {len(rest) - 4} bytes")
    return fields, rest[:-4]


def read_archive(stream, name: str = "") -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, fields, block) of each record of a file object; one frame in memory at a time."""

    def need(n: int) -> bytes:
        got = stream.read(n)
        if len(got) != n:
            raise WarcError(f"{name}: cut short")
        return bytes(got)

    head = stream.read(8)
    if not head:
        return
    magic, size = struct.unpack("<II", head) if len(head) == 8 else (0, 0)
    d, at, left = None, 0, bytes(head)
    if magic == SKIPPABLE:
        body = need(size)
        if body[:4] == ZSTD_MAGIC:
            body = zstandard.ZstdDecompressor().decompress(body)
        kind = zstandard.DICT_TYPE_FULLDICT if body[:4] == b"\x37\xa4\x30\xec" else zstandard.DICT_TYPE_RAWCONTENT
        d, at, left = zstandard.ZstdCompressionDict(body, dict_type=kind), 8 + size, b""
    decompressor = zstandard.ZstdDecompressor(dict_data=d) if d else zstandard.ZstdDecompressor()
    while True:
        obj, parts, begin = decompressor.decompressobj(), [], at
        used = 0
        while not obj.eof:
            chunk = left or stream.read(1 << 16)
            if not chunk:
                if used:
                    raise WarcError(f"{name} at {begin}: cut short")
                return
            chunk = bytes(chunk)
            try:
                parts.append(obj.decompress(chunk))
            except zstandard.ZstdError as e:
                raise WarcError(f"{name} at {begin}: {e}") from e
            left = obj.unused_data if obj.eof else b""
            used += len(chunk) - len(left)
        at += used
        fields, block = parse_record(b"".join(parts), f"{name} at {begin}")
        yield begin, fields, block


def _writer(folder: str, date: str, roll: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = fs.FileSystem.from_uri(folder)
        ctx = TaskContext.get()
        paths: list[tuple[str, int]] = []
        w = ArchiveWriter()

        def close() -> None:
            nonlocal w
            # by attempt: the manifest names those of the attempt that counts, and no other one replaces them
            name = f"{root}/part-{ctx.partitionId():06d}-{len(paths):04d}-{ctx.taskAttemptId()}.warc.zst"
            temp = f"{name}.tmp"
            with files.open_output_stream(temp, compression=None) as out:
                out.write(w.finish())
            files.move(temp, name)
            paths.append((f"{folder}/{name.rpartition('/')[2]}", w.count))
            w = ArchiveWriter()

        files.create_dir(root, recursive=True)
        for batch in batches:
            for page, url, html, digest, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                payload = (html or "").encode("utf-8", "surrogatepass")
                b32 = base64.b32encode(bytes.fromhex(digest)).decode()
                again = first is not None and page is not None and page != first
                fields = [("WARC-Type", "revisit" if again else "response"), ("WARC-Record-ID", record_id(page, f"/{b32}")), ("WARC-Date", date)]
                fields += [("WARC-Target-URI", url)] if url else []
                fields += [("Content-Type", "application/http;msgtype=response"), ("WARC-Payload-Digest", f"sha1:{b32}")]
                fields += [("X-Page-Id", str(page))] if page is not None else []
                if again:
                    fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", record_id(first, f"/{b32}")), ("X-Refers-To-Page-Id", str(first))]
                w.add(record(fields, HTTP.format(len(payload)).encode() + (b"" if again else payload)))
                if w.size >= roll:
                    close()
        if w.count:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in paths], pa.string()), pa.array([n for _, n in paths], pa.int64())], ["path", "records"])

    return run


def write_warc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z", roll_bytes: int = 24 << 20) -> DataFrame:
    """Write a record per page to archives in ``folder`` (a uri all executors reach); (path, records).

    Of records whose payloads are equal and have at least ``min_bytes`` bytes, the one with the
    smallest id is a response, the others are revisits of it, without payload; smaller payloads
    are all responses.  Null html is an empty payload; a null url gives a record without target; a
    null id never is or has a revisit; rows that repeat an id and payload are alike and share a record id, which is made of
    both, so that rows of one id with different payloads have different ones.  No pages give
    no archive.  Further columns aren't written.
    """
    p = pages.select(F.col(id_col).cast("long").alias("page"), F.col(url_col).alias("url"), F.coalesce(html_col, F.lit("")).alias("html"))
    p = p.withColumn("digest", F.sha1(F.encode("html", "UTF-8")))
    first = p.where(F.octet_length("html") >= min_bytes).groupBy("digest").agg(F.min("page").alias("first"))
    rows = split_hint(p.join(first, "digest", "left").select("page", "url", "html", "digest", "first"))
    return staged(rows.mapInArrow(_writer(folder, date, roll_bytes), "path string, records long"), "warc-manifest")


READ_SCHEMA = "archive string, offset long, warc_type string, record_id string, target_uri string, payload_digest string, refers_to string, fields map<string,string>, http_length long, payload binary"


def read_warc(paths: DataFrame, path_col: str = "path") -> DataFrame:
    """All records of the archives: place, type, main fields, all fields, HTTP length and payload.

    Digests of full payloads are verified.  A broken archive is an error that names the place.
    """
    spark = paths.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.strip().split()[0] for x in READ_SCHEMA.split(", ")]
        types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.map_(pa.string(), pa.string()), pa.int64(), pa.binary()]
        rows, size = [], 0
        flush = lambda: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                files, name = fs.FileSystem.from_uri(path)
                with files.open_input_stream(name, compression=None) as stream:
                    for at, fields, block in read_archive(stream, path):
                        head, sep, payload = block.partition(b"\r\n\r\n")
                        if not block.startswith(b"HTTP/"):
                            head, payload = b"", block
                        told = next((x.partition(b":")[2].strip() for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:")), None)
                        if told is not None and not told.isdigit():
                            raise WarcError(f"{path} at {at}: content-length {told!r}")
                        n = None if told is None else int(told)
                        kind, digest = fields["warc-type"], fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
                        if kind == "response" and (n is not None and n != len(payload) or digest and digest != base32_sha1(payload)):
                            raise WarcError(f"{path} at {at}: payload doesn't fit its length or digest")
                        rows.append((path, at, kind, fields["warc-record-id"], fields.get("warc-target-uri"), digest, fields.get("warc-refers-to"), list(fields.items()), n, payload if kind != "revisit" else None))
                        size += len(block) + 500
                        if size > 4 << 20:
                            yield flush()
                            rows, size = [], 0
        if rows:
            yield flush()

    some = paths.select(F.col(path_col).alias("path"))
    return some.repartition(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), "path").mapInArrow(run, READ_SCHEMA)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = write_warc(table(spark, sf_dir, "pages"), new_folder(spark, "warc"))
    r = read_warc(made)
    return r.select(
        F.col("fields").getItem("x-page-id").cast("long").alias("page_id"),
        F.col("http_length").alias("payload_bytes"),
        "payload_digest",
        F.col("warc_type").alias("record_type"),
        F.col("fields").getItem("x-refers-to-page-id").cast("long").alias("refers_to"),
    )


#: Base 32 of a SHA-1: eight groups of 20 bits, of four characters each.
SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS h FROM pages),
d AS (
  SELECT *, list_aggregate(list_transform(range(0, 8), lambda g: list_aggregate(list_transform([32768, 1024, 32, 1], lambda s:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (('0x' || substr(h, g * 5 + 1, 5))::INT // s % 32)::INT + 1, 1)), 'string_agg', '')), 'string_agg', '') AS digest,
    min(page_id) OVER (PARTITION BY h) AS first
  FROM p
)
SELECT page_id, n AS payload_bytes, digest AS payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to FROM d
"""
