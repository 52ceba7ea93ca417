"""WARC archives as a Spark data source, written and read.

Writing: one file a task, named after the attempt; the commit lists the files of the attempts that
count, with an entry point about every ``split_bytes``, so that a file can be read in parts.

Reading: partitions are the parts between entry points (whole files, where an archive has no
manifest).  Filters on ``record_type`` and on header columns are taken over: a record's header is parsed
first, and the payload of a record that isn't wanted, or whose payload isn't asked for, is skipped
without being read; with ``.gz`` files, whose members must be inflated to find the next, it is not kept.

Columns: record_type, record_id, target_uri, refers_to, payload_digest, payload_bytes, payload.  The
payload of an HTTP response is its body.

Defined cases: a record without a header has null there; a payload may be empty; a truncated last
record or a malformed header ends the read with an error that names file and offset; digests of
payloads that are read are verified, and a wrong one is an error too (option ``verify``).
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections import deque
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition,
                                    WriterCommitMessage)

from aurum.llm.files import listed, opened, read_manifest, write_manifest

SCHEMA = ("record_type string, record_id string, target_uri string, refers_to string, payload_digest string, "
          "payload_bytes long, payload binary")
SPLIT_BYTES = 32 << 20
BATCH_BYTES = 4 << 20

#: Names of the WARC/1.1 format.
VERSION = b"WARC/1.1"
HEADERS = {"record_type": b"warc-type", "record_id": b"warc-record-id", "target_uri": b"warc-target-uri",
           "refers_to": b"warc-refers-to", "payload_digest": b"warc-payload-digest"}
LENGTH_HEADER, PAYLOAD_LENGTH_HEADER = b"content-length", b"x-payload-length"
REVISIT_PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"
#: A record's header has fewer bytes.
MOST_HEADER = 1 << 20


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(record_type: str, record_id: str, uri: str | None, refers_to: str | None, digest: str, payload: bytes) -> bytes:
    """One record: a response with its HTTP head and body, or a revisit with the head alone."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head + payload if record_type == "response" else head
    lines = [VERSION, b"WARC-Type: " + record_type.encode(), b"WARC-Record-ID: <" + record_id.encode() + b">",
             b"WARC-Date: 1970-01-01T00:00:00Z", b"Content-Type: application/http; msgtype=response",
             b"WARC-Payload-Digest: sha1:" + digest.encode(), b"X-Payload-Length: %d" % len(payload), b"Content-Length: %d" % len(block)]
    if uri is not None:
        lines.append(b"WARC-Target-URI: " + uri.encode().replace(b"\r", b"%0D").replace(b"\n", b"%0A"))
    if record_type == "revisit":
        lines += [b"WARC-Profile: " + REVISIT_PROFILE, b"WARC-Refers-To: <" + (refers_to or "").encode() + b">"]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + END


@dataclass
class Written(WriterCommitMessage):
    file: str
    bytes: int
    entries: list[int]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path, self.gzip = options["path"], options.get("compression", "none") == "gzip"
        self.split = int(options.get("split_bytes", SPLIT_BYTES))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, base = opened(self.path)
        store.create_dir(base, recursive=True)
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc" + ".gz" * self.gzip
        size, entries = 0, []
        with store.open_output_stream(f"{base}/{name}", compression=None) as f:
            for batch in iterator:
                for row in zip(*(batch[c].to_pylist() for c in ("record_type", "record_id", "target_uri", "refers_to", "payload_digest", "payload")), strict=True):
                    data = record(*row[:5], row[5] or b"")
                    if self.gzip:
                        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                        data = packer.compress(data) + packer.flush()
                    if not entries or size - entries[-1] >= self.split:
                        entries.append(size)
                    f.write(data)
                    size += len(data)
        return Written(name, size, entries)

    def commit(self, messages: list) -> None:
        write_manifest(self.path, [{"file": m.file, "bytes": m.bytes, "entries": m.entries} for m in messages if m and m.bytes])

    def abort(self, messages: list) -> None:
        pass  # without a manifest entry no file counts


class Bytes:
    """Reads ahead over a stream; a member of a gzip file is inflated as far as it is asked for.

    What is read is kept in pieces until it is taken, so that a payload is joined once, whatever its length.
    """

    def __init__(self, stream, start: int, stop: int, gzip: bool):
        self.stream, self.at, self.stop, self.gzip = stream, start, stop, gzip
        self.pieces: deque[bytes] = deque()
        self.size, self.used = 0, 0  # bytes left, and bytes of the first piece that are taken
        self.inflater = zlib.decompressobj(31) if gzip else None
        stream.seek(start)

    def _more(self) -> bool:
        if self.gzip and self.inflater.eof:
            rest = self.inflater.unused_data
            self.inflater = zlib.decompressobj(31)
        else:
            rest = b""
        data = rest or self.stream.read(1 << 18)
        if not data:
            return False
        data = self.inflater.decompress(data) if self.gzip else data
        if data:
            self.pieces.append(data)
            self.size += len(data)
        return True

    @property
    def ended(self) -> bool:
        """Whether the next record begins at the end of the part or beyond."""
        if self.gzip:
            while not self.size:
                at = self.stream.tell() - (len(self.inflater.unused_data) if self.inflater.eof else 0)
                if at >= self.stop or not self._more():
                    return True
            return False
        return self.at >= self.stop

    def until(self, mark: bytes) -> bytes:
        while True:
            if len(self.pieces) > 1:
                self.pieces = deque([b"".join([self.pieces.popleft()[self.used:], *self.pieces])])
                self.used = 0
            found = self.pieces[0].find(mark, self.used) if self.pieces else -1
            if found >= 0:
                return self.take(found + len(mark) - self.used)
            if self.size >= MOST_HEADER:
                raise ValueError("a header without an end")
            if not self._more():
                raise ValueError("truncated header")

    def _first(self, n: int) -> bytes:
        """The rest of the next piece, or its next ``n`` bytes."""
        piece, a = self.pieces[0], self.used
        out = piece[a:a + n] if a or n < len(piece) else piece
        self.used += len(out)
        self.size -= len(out)
        if self.used == len(piece):
            self.pieces.popleft()
            self.used = 0
        return out

    def take(self, n: int) -> bytes:
        out, left = [], n
        while left:
            if not self.size and not self._more():
                raise ValueError("truncated record")
            if self.size:
                out.append(self._first(left))
                left -= len(out[-1])
        self.at += n
        return out[0] if len(out) == 1 else b"".join(out)

    def skip(self, n: int) -> None:
        if not self.gzip and n > self.size:
            self.at += n
            self.pieces.clear()
            self.size = self.used = 0
            self.stream.seek(self.at)
            return
        left = n
        while left:
            if not self.size and not self._more():
                raise ValueError("truncated record")
            if self.size:
                left -= len(self._first(left))
        self.at += n


def parsed_header(data: bytes) -> dict[bytes, bytes]:
    version, *lines = data.rstrip(b"\r\n").split(b"\r\n")
    if not version.startswith(b"WARC/"):
        raise ValueError("no WARC header")
    out = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon:
            raise ValueError("malformed header line")
        out[name.strip().lower()] = value.strip()
    return out


def _number(header: dict[bytes, bytes], name: bytes) -> int:
    value = header.get(name, b"")
    if not value.isdigit():
        raise ValueError(f"no valid {name.decode()} in a header")
    return int(value)


def records(stream, start: int, stop: int, *, gzip: bool, wanted: dict[str, set], payloads: bool, verify: bool) -> Iterator[tuple]:
    """The wanted records that begin in [start, stop)."""
    data = Bytes(stream, start, stop, gzip)
    while not data.ended:
        header = parsed_header(data.until(END))
        length = _number(header, LENGTH_HEADER)
        row = {c: header[h].decode() if h in header else None for c, h in HEADERS.items()}
        for c in ("record_id", "refers_to"):
            row[c] = row[c].strip("<>") if row[c] else row[c]
        row["payload_digest"] = row["payload_digest"].removeprefix("sha1:") if row["payload_digest"] else None
        if any(row[c] not in values for c, values in wanted.items()):
            data.skip(length + len(END))
            continue
        http = header.get(b"content-type", b"").startswith(b"application/http")
        stated = _number(header, PAYLOAD_LENGTH_HEADER) if PAYLOAD_LENGTH_HEADER in header else None
        if row["record_type"] == "revisit" or not payloads and stated is not None:
            data.skip(length + len(END))
            yield *row.values(), stated, None
            continue
        block = data.take(length)
        data.take(len(END))
        payload = block.partition(END)[2] if http else block
        if verify and row["payload_digest"] and digest_of(payload) != row["payload_digest"]:
            raise ValueError(f"wrong payload digest of {row['record_id']}")
        yield *row.values(), len(payload), payload if payloads else None


@dataclass
class Part(InputPartition):
    file: str
    start: int
    stop: int


class WarcReader(DataSourceReader):
    def __init__(self, options: dict, schema):
        self.path, self.columns = options["path"], [f.name for f in schema.fields]
        self.verify = options.get("verify", "true") == "true"
        self.payloads = options.get("payloads", "true") == "true"
        self.wanted: dict[str, set] = {}

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 and f.attribute[0] in HEADERS:
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                c = f.attribute[0]
                self.wanted[c] = self.wanted[c] & values if c in self.wanted else values
            else:
                yield f

    def partitions(self) -> Sequence[Part]:
        entries = read_manifest(self.path)
        if entries is None:
            return [Part(x["file"], 0, x["bytes"]) for x in listed(self.path, (".warc", ".warc.gz"))]
        base = opened(self.path)[1]
        return [Part(f"{base}/{x['file']}", a, b) for x in entries for a, b in zip(x["entries"], [*x["entries"][1:], x["bytes"]], strict=True)] or [Part("", 0, 0)]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        if not partition.stop:
            return
        names = [*HEADERS, "payload_bytes", "payload"]
        kinds = [pa.string()] * len(HEADERS) + [pa.int64(), pa.binary()]
        store = opened(self.path)[0]
        payloads = self.payloads and "payload" in self.columns

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            columns = {n: pa.array(c, k) for n, c, k in zip(names, zip(*rows, strict=True), kinds, strict=True)}
            return pa.RecordBatch.from_arrays([columns[c] for c in self.columns], names=self.columns)

        with store.open_input_file(partition.file) as f:
            rows, size = [], 0
            found = records(f, partition.start, partition.stop, gzip=partition.file.endswith(".gz"), wanted=self.wanted,
                            payloads=payloads or self.verify, verify=self.verify)
            try:
                for row in found:
                    rows.append(row if payloads else (*row[:-1], None))
                    size += 200 + len(rows[-1][-1] or b"")
                    if size >= BATCH_BYTES:
                        yield batch(rows)
                        rows, size = [], 0
            except ValueError as e:
                raise ValueError(f"{partition.file}, part from {partition.start}: {e}") from e
            if rows:
                yield batch(rows)


class WarcSource(DataSource):
    """``spark.read.format("warc").load(path)`` and ``df.write.format("warc")``.  Options: compression
    (none or gzip), split_bytes, verify, payloads (false leaves payloads null)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options, schema)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def base32(sha1_hex):
    """Upper-case base32 of a SHA-1 in hexadecimal: 32 groups of five bits."""
    digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    out = []
    for start in range(0, 40, 10):  # ten hexadecimal digits are eight groups
        part = F.conv(F.substring(sha1_hex, start + 1, 10), 16, 10).cast("long")
        for shift in range(35, -1, -5):
            out.append(F.substring(F.lit(digits), (F.shiftright(part, shift) % 32 + 1).cast("int"), F.lit(1)))
    return F.concat(*out)


def page_records(pages: DataFrame, *, min_revisit_bytes: int = 0) -> DataFrame:
    """The record of every page.  Of equal payloads of at least ``min_revisit_bytes``, the smallest page_id
    has the response and the others revisit it.  Rows that repeat a page_id and payload are alike; a null
    page_id comes after all others."""
    from aurum.llm.common import written

    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string").alias("target_uri"),
                        F.sha1(payload).alias("sha1"), F.length(payload).alias("n"), payload.alias("payload"))
    # ids and digests only: the payloads don't move; a group of any size is one row before the shuffle
    firsts = written(rows.where(F.col("n") >= min_revisit_bytes).groupBy("sha1").agg(F.min("page_id").alias("first"), F.count("*").alias("copies"))
                     .where("copies > 1").select("sha1", "first"), "warc-firsts")
    revisits = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(firsts, "sha1", "left").select(
        F.when(revisits, "revisit").otherwise("response").alias("record_type"),
        F.concat(F.lit("urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("null"))).alias("record_id"), "target_uri",
        F.when(revisits, F.concat(F.lit("urn:page:"), F.col("first").cast("string"))).alias("refers_to"),
        base32(F.col("sha1")).alias("payload_digest"), F.lit(None).cast("long").alias("payload_bytes"), "payload")


def roundtrip(pages: DataFrame, *, min_revisit_bytes: int = 0, compression: str = "none") -> DataFrame:
    """Write the pages as archives in the shared folder and read every record back."""
    from aurum.session import scratch_path

    spark = pages.sparkSession
    register(spark)
    path = scratch_path(spark, "warc")
    page_records(pages, min_revisit_bytes=min_revisit_bytes).write.format("warc").option("compression", compression).mode("append").save(path)
    back = spark.read.format("warc").option("payloads", "false").load(path)
    page = lambda c: F.regexp_extract(c, r"^urn:page:(-?\d+)$", 1).try_cast("long")
    return back.select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to"))
