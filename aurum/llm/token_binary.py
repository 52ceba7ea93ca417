"""Token-id files: documents encoded by a tokenizer, range-coded in blocks, in ascending doc_id order.

Format of a file (all integers little-endian): the magic ``AURTOK1\\n``; blocks, one after another, each the
range-coded form of ``BLOCK`` ids; a footer, zlib-compressed JSON-free arrays: for each document its doc_id
(int64), null flag (uint8) and number of ids (uint32), and for each block its length and CRC-32 (uint32);
then the lengths of these arrays, the footer's size and its CRC-32.  A block resets the coder, so a damaged
one is found by its checksum and spoils no other.

Order: documents are dealt by ranges of doc_id, sorted, and encoded where they arrive; a file holds one
range, so that files in the order of the manifest hold the documents in ascending order.  A file's first id
has the number of all ids of the files before it, from the manifest.

Defined cases: a null text is empty and has the end id alone; a null doc_id comes first; rows that repeat
a doc_id stand side by side, in the order of their texts; ids must be below 2**16; an empty table gives
no file and an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from aurum.llm import range_coder
from aurum.llm.bpe_replay import keep_below
from aurum.llm.common import chunked, texts
from aurum.llm.files import opened, read_manifest, write_manifest

MAGIC = b"AURTOK1\n"
END_ID = 2
STRETCH_BYTES = 4 << 20
#: Distinct chunks that one call of the tokenizer gets.
CHUNKS_AT_ONCE = 2048
#: Ids that a writer or reader holds at once.
STRETCH_IDS = range_coder.LANES * range_coder.BLOCK


#: A splitter whose pieces of a plain chunk ``PIECES`` finds too.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Chunks of visible ASCII and of Latin-1's letters with marks: each is one composed character, with a small letter of its own.
PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


class Chunks:
    """The tokenizer's ids of texts, one distinct chunk between ASCII white space at a time.

    The tokenizer's normaliser makes any white space a blank, and its splitter drops blanks, so that no
    token crosses them; ``whole`` texts are encoded at once where a tokenizer doesn't promise that.  Plain
    chunks are made small and split here, and each distinct piece goes to the tokenizer's model once; the
    whole tokenizer encodes the others.
    """

    def __init__(self, tokenizer_json: str):
        import json

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        parts = json.loads(tokenizer_json)
        kinds = [p["type"] for p in (parts["normalizer"] or {}).get("normalizers", [])]
        split = (parts["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        self.by_chunk = kinds == ["NFC", "Replace", "Lowercase"] and [p.get("type") for p in split] == ["Split", "ByteLevel"] and split[0]["behavior"] == "Removed"
        self.known: dict[bytes, bytes] = {}
        self.special = [t["content"] for t in parts["added_tokens"]]
        self.by_piece = self.by_chunk and split[0] == {"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True} \
            and not split[1]["add_prefix_space"] and not split[1]["use_regex"]
        if self.by_piece:
            from tokenizers.pre_tokenizers import ByteLevel

            level = ByteLevel(add_prefix_space=False, use_regex=False)
            self.letters = {k: level.pre_tokenize_str(chr(k))[0][0] for k in range(0xC0, 0x100)}
            self.pieces: dict[str, bytes] = {}

    def _encode(self, rows: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch(rows, add_special_tokens=False)]

    def _chunks(self, new: list[bytes]) -> list[bytes]:
        if not self.by_piece:
            return self._others([x.decode() for x in new])
        out: list[bytes] = []
        for k in range(0, len(new), CHUNKS_AT_ONCE):
            chunks = [x.decode() for x in new[k:k + CHUNKS_AT_ONCE]]
            plain = list(filter(PLAIN.fullmatch, chunks))
            joined = " ".join(plain)
            if any(s in joined for s in self.special):
                plain = [x for x in plain if not any(s in x for s in self.special)]
            ids = dict(zip(plain, self._plain(plain), strict=True))
            others = [x for x in chunks if x not in ids]
            ids.update(zip(others, self._others(others), strict=True))
            out.extend(map(ids.__getitem__, chunks))
        return out

    def _plain(self, chunks: list[str]) -> list[bytes]:
        cut = [PIECES.findall(x.lower()) for x in chunks]
        needed = set().union(*cut)
        new = needed.difference(self.pieces)
        keep_below(self.pieces, len(new), needed)
        tokens = self.tokenizer.model.tokenize
        for piece in new:
            ids = [t.id for t in tokens(piece if piece.isascii() else piece.translate(self.letters))]
            self.pieces[piece] = struct.pack(f"<{len(ids)}I", *ids)
        return [b"".join(map(self.pieces.__getitem__, own)) for own in cut]

    def _others(self, new: list[str]) -> list[bytes]:
        """Ids of chunks, many in one call of the library: blanks part them, and offsets tell which token is whose."""
        out: list[bytes] = []
        for k in range(0, len(new), CHUNKS_AT_ONCE):
            chunks = new[k:k + CHUNKS_AT_ONCE]
            joined = " ".join(chunks)
            if any(s in joined for s in self.special):  # these may take blanks beside them
                out.extend(self._encode(chunks))
                continue
            encoding = self.tokenizer.encode(joined, add_special_tokens=False)
            starts = np.cumsum([0] + [len(x) + 1 for x in chunks[:-1]])
            own = np.searchsorted(starts, np.array(encoding.offsets, np.int64).reshape(-1, 2)[:, 0], side="right") - 1
            stops = (4 * np.cumsum(np.bincount(own, minlength=len(chunks)))).tolist()
            data = np.array(encoding.ids, "<u4").tobytes()
            out.extend(data[a:b] for a, b in zip([0, *stops], stops, strict=False))
        return out

    def encode(self, rows: list[str]) -> list[bytes]:
        if not self.by_chunk:
            return self._encode(rows)
        cut = [x.encode().split() for x in rows]
        chunks = set().union(*cut)
        new = list(chunks.difference(self.known))
        keep_below(self.known, len(new), chunks)
        self.known.update(zip(new, self._chunks(new), strict=True))
        return [b"".join(map(self.known.__getitem__, own)) for own in cut]


_chunks: dict[int, Chunks] = {}


def tokenized(docs: DataFrame, tokenizer_json: str, end_id: int | None = END_ID) -> DataFrame:
    """(doc_id, ids) with ids as little-endian unsigned 32-bit integers; ``end_id`` closes each document."""
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json)  # as large as the tokenizer's file
    end = b"" if end_id is None else end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = id(shared.value)
        if key not in _chunks:
            _chunks.clear()
            _chunks[key] = Chunks(shared.value)
        encode = _chunks[key].encode
        for batch in chunked(batches, "text", STRETCH_BYTES):
            ids = [x + end for x in encode(texts(batch["text"]))]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, ids binary")


@dataclass
class Written(WriterCommitMessage):
    part: int
    file: str
    docs: int
    ids: int


class TokenWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path = options["path"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        part = TaskContext.get().partitionId()
        store, base = opened(self.path)
        store.create_dir(base, recursive=True)
        name = f"part-{part:05d}-{uuid.uuid4().hex}.tok"
        # packed: 13 bytes a document, 8 a block
        doc_ids, nulls, sizes, blocks, sums = (array(kind) for kind in "qBIII")
        held: list[np.ndarray] = []
        n_held = total = 0
        with store.open_output_stream(f"{base}/{name}", compression=None) as f:
            f.write(MAGIC)

            def put(ids: np.ndarray) -> None:
                for data in range_coder.encode(ids):
                    f.write(data)
                    blocks.append(len(data))
                    sums.append(zlib.crc32(data))

            for batch in iterator:
                for doc_id, data in zip(batch["doc_id"].to_pylist(), batch["ids"], strict=True):
                    ids = np.frombuffer(data.as_buffer() or b"", "<u4") if data.is_valid else np.empty(0, "<u4")
                    if len(ids) and ids.max() >= 1 << 16:
                        raise ValueError("ids must be below 65536")
                    doc_ids.append(doc_id or 0)
                    nulls.append(doc_id is None)
                    sizes.append(len(ids))
                    held.append(ids.astype(np.uint16))
                    n_held += len(ids)
                    if n_held >= STRETCH_IDS:
                        own = np.concatenate(held)
                        full = n_held // STRETCH_IDS * STRETCH_IDS
                        for k in range(0, full, STRETCH_IDS):
                            put(own[k:k + STRETCH_IDS])
                        held, n_held = [own[full:]], n_held - full
            if n_held:
                put(np.concatenate(held))
            total = int(np.array(sizes, np.int64).sum())
            footer = zlib.compress(b"".join(np.array(x, t).tobytes() for x, t in (
                (doc_ids, "<i8"), (nulls, "u1"), (sizes, "<u4"), (blocks, "<u4"), (sums, "<u4"))))
            f.write(footer + struct.pack("<QQQI", len(sizes), len(blocks), len(footer), zlib.crc32(footer)))
        return Written(part, name, len(sizes), total)

    def commit(self, messages: list) -> None:
        entries, start = [], 0
        for m in sorted((m for m in messages if m and m.docs), key=lambda m: m.part):
            entries.append({"file": m.file, "docs": m.docs, "ids": m.ids, "start": start})
            start += m.ids
        write_manifest(self.path, entries)

    def abort(self, messages: list) -> None:
        pass  # without a manifest entry no file counts


@dataclass
class Part(InputPartition):
    file: str
    start: int


class TokenReader(DataSourceReader):
    def __init__(self, options: dict, schema):
        self.path, self.columns = options["path"], [f.name for f in schema.fields]

    def partitions(self) -> Sequence[Part]:
        base = opened(self.path)[1]
        return [Part(f"{base}/{x['file']}", x["start"]) for x in read_manifest(self.path) or ()] or [Part("", 0)]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        if not partition.file:
            return
        with opened(self.path)[0].open_input_file(partition.file) as f:
            doc_ids, nulls, sizes, blocks, sums = self._footer(f, partition.file)
            f.seek(0)
            if f.read(len(MAGIC)) != MAGIC:
                raise ValueError(f"{partition.file}: no token file")
            left, start, doc = np.empty(0, "<u4"), partition.start, 0
            ends, total, done = np.cumsum(sizes), int(sizes.sum()), 0
            for k in range(0, len(blocks), range_coder.LANES):
                some = [f.read(int(n)) for n in blocks[k:k + range_coder.LANES]]
                for data, crc in zip(some, sums[k:k + range_coder.LANES], strict=True):
                    if zlib.crc32(data) != crc:
                        raise ValueError(f"{partition.file}: damaged block")
                n = min(len(some) * range_coder.BLOCK, total - done)
                own = np.concatenate((left, range_coder.decode(some, n).astype("<u4")))
                first, done = done - len(left), done + n
                stop = int(np.searchsorted(ends, done, side="right"))
                yield from self._rows(own, first, doc, stop, doc_ids, nulls, sizes, ends, partition.start)
                left, doc = own[(int(ends[stop - 1]) if stop else 0) - first:], stop
            if doc < len(sizes):  # documents without any id at the end
                yield from self._rows(left, done, doc, len(sizes), doc_ids, nulls, sizes, ends, partition.start)

    def _rows(self, own, first, doc, stop, doc_ids, nulls, sizes, ends, file_start) -> Iterator[pa.RecordBatch]:
        if stop == doc:
            return
        data = [own[int(ends[d] - sizes[d]) - first:int(ends[d]) - first] for d in range(doc, stop)]
        columns = {"doc_id": lambda: pa.array(doc_ids[doc:stop], mask=nulls[doc:stop]),
                   "start": lambda: pa.array(file_start + ends[doc:stop] - sizes[doc:stop]),
                   "n_tokens": lambda: pa.array(sizes[doc:stop]),
                   "ids_crc32": lambda: pa.array([zlib.crc32(x) for x in data], pa.int64()),
                   "ids": lambda: pa.array([x.astype("<i4") for x in data], pa.list_(pa.int32()))}
        yield pa.RecordBatch.from_arrays([columns[c]() for c in self.columns], names=self.columns)

    @staticmethod
    def _footer(f, name: str) -> list[np.ndarray]:
        tail = struct.calcsize("<QQQI")
        size = f.size()
        f.seek(size - tail)
        docs, blocks, length, crc = struct.unpack("<QQQI", f.read(tail))
        f.seek(size - tail - length)
        data = f.read(length)
        if zlib.crc32(data) != crc:
            raise ValueError(f"{name}: damaged footer")
        data, out, at = zlib.decompress(data), [], 0
        for n, kind, to in ((docs, "<i8", np.int64), (docs, "u1", bool), (docs, "<u4", np.int64), (blocks, "<u4", np.int64), (blocks, "<u4", np.int64)):
            stop = at + n * np.dtype(kind).itemsize
            out.append(np.frombuffer(data[at:stop], kind).astype(to))
            at = stop
        return out


class TokenSource(DataSource):
    """``spark.read.format("token_ids").load(path)``: doc_id, start, n_tokens, ids_crc32, and ids if the schema asks for them."""

    @classmethod
    def name(cls) -> str:
        return "token_ids"

    def schema(self) -> str:
        return "doc_id long, start long, n_tokens long, ids_crc32 long"

    def reader(self, schema) -> TokenReader:
        return TokenReader(self.options, schema)

    def writer(self, schema, overwrite: bool) -> TokenWriter:
        return TokenWriter(self.options)


def write_tokens(docs: DataFrame, tokenizer_json: str, path: str, *, end_id: int | None = END_ID, partitions: int | None = None) -> None:
    spark = docs.sparkSession
    spark.dataSource.register(TokenSource)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text")).repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    tokenized(ordered, tokenizer_json, end_id).write.format("token_ids").mode("append").save(path)


def roundtrip(docs: DataFrame, tokenizer_json: str) -> DataFrame:
    """Write the documents' ids to the shared folder and read them back."""
    from aurum.session import scratch_path

    path = scratch_path(docs.sparkSession, "token-ids")
    write_tokens(docs, tokenizer_json, path)
    return docs.sparkSession.read.format("token_ids").load(path)
