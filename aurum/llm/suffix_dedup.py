"""Exact removal of repeated passages with a run-length suffix index.

A byte goes if a string of ``LENGTH`` bytes that covers it starts at least at one other place too.

1. Anchors.  In each document the minimizers of 32-byte strings are taken, so that every string of
   ``LENGTH`` bytes holds an anchor whose choice depends on that string alone: two equal strings have
   the same anchor at the same place in them.  With each anchor goes a hash of its context, the
   bytes of all strings that hold it.
2. Anchors that occur once anywhere can't be part of a match.  Where a whole context occurs again, it
   is marked as it stands; such contexts are counted before any text moves, however often they occur.
3. The contexts that are left (the ends of repeated passages, places where near copies differ) are
   fetched from the texts, one of each kind, and meet by anchor.  Over those of a stretch of anchors
   a run-length index is built: the Burrows-Wheeler transform in runs, with the text position and the
   length of the match to the neighbour sampled at both ends of each run.  Inside a run the match of
   the next text position is one byte shorter, so that matching statistics of all positions stream
   from the samples alone.  Positions whose match is ``LENGTH`` bytes or more give the marks.
   An anchor with more than ``KEY_CONTEXTS`` distinct contexts is split first: a string may hold its anchor
   at any of ``LENGTH - GRAM + 1`` places, and these places are split into ``SPLIT`` ranges.  All strings of a
   range share their middle, which becomes the key, and what they cover together the context.  Step 2 is
   done anew for the new keys, and those that are still crowded are split again, down to single places, where
   equal keys are equal strings.  So no index holds more than a bounded number of contexts.
4. The marks of a document are united and its bytes removed in one more pass.

Defined cases: a null or short text has no marks; a null doc_id is an id like any other; repeated rows
are documents of their own (each makes the other's strings repeated) and get equal results; an empty
table gives an empty result; other columns are ignored; very long texts are cut nowhere.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aurum.llm.common import chunked, discard, mix64, release, utf8, written, written_at

LENGTH = 400
GRAM = 32
#: Bytes of contexts in one index; an index takes some 100 times as much while it is built.
INDEX_BYTES = 1 << 19
#: Bytes of text that are hashed at once, at some 50 bytes each.
HASHED_BYTES = 1 << 20
#: Distinct contexts that meet under one key; a key with more is split.
KEY_CONTEXTS = 1024
#: Ranges into which the places of a crowded key are split.
SPLIT = 8


def sliding(op: np.ufunc, x: np.ndarray, width: int, fill: int) -> np.ndarray:
    """``op`` over x[i:i+width] for all i, with two running passes over blocks of the width."""
    n = len(x) - width + 1
    blocks = -(-len(x) // width)
    padded = np.full(blocks * width, fill, x.dtype)
    padded[:len(x)] = x
    padded = padded.reshape(blocks, width)
    ahead = op.accumulate(padded, axis=1).ravel()
    back = op.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return op(back[:n], ahead[width - 1:width - 1 + n])


def gram_hashes(data: np.ndarray, size: int = GRAM) -> np.ndarray:
    """A 64-bit hash of each string of ``size`` bytes (a power of two)."""
    h = mix64(np.arange(256, dtype=np.uint64) + np.uint64(1))[data]
    step, factor = 1, np.uint64(0x9E3779B97F4A7C15)
    while step < size:
        h = h[:-step] * factor + h[step:]
        h ^= h >> np.uint64(29)
        step, factor = 2 * step, factor * np.uint64(0xBF58476D1CE4E5B9) | np.uint64(1)
    return mix64(h)


def anchors(hashes: np.ndarray, width: int) -> np.ndarray:
    """Positions that hold the least hash of some window of ``width`` hashes; ties all count."""
    if len(hashes) < width:
        return np.empty(0, np.int64)
    low = sliding(np.minimum, hashes, width, np.uint64(0xFFFFFFFFFFFFFFFF))
    edge = np.zeros(width - 1, np.uint64)
    high = sliding(np.maximum, np.concatenate((edge, low, edge)), width, np.uint64(0))
    return np.flatnonzero(high == hashes)


def _anchored(length: int):
    width = length - GRAM + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunked(batches, "text", HASHED_BYTES):
            data, offsets = utf8(batch["text"])
            if len(data) < length:
                continue
            with np.errstate(over="ignore"):
                hashes = gram_hashes(data)
            rows, keys, contexts, positions = [], [], [], []
            view, digest = memoryview(data), xxhash.xxh3_64_intdigest
            for k, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                if b - a < length:
                    continue
                at = anchors(hashes[a:b - GRAM + 1], width)
                rows.append(np.full(len(at), k))
                keys.append(hashes[a:b - GRAM + 1][at])
                positions.append(at)
                left = length - GRAM
                # the place of the anchor in a context cut by an end of the text is part of its hash
                contexts.extend(digest(view[max(a, p - left):min(b, p + length)], min(p - a, left)) for p in (at + a).tolist())
            if rows:
                row = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.array(contexts, np.uint64).view(np.int64)),
                     batch["doc_id"].take(row), batch["text_hash"].take(row), pa.array(np.concatenate(positions))],
                    names=["anchor", "context", "doc_id", "text_hash", "pos"])

    return run


def suffix_array(text: np.ndarray, levels: list[tuple[int, np.ndarray]] | None = None) -> np.ndarray:
    """Suffix array of small integers by prefix doubling; only positions that are still tied are sorted again.

    ``levels`` gets, for each doubling, its number of characters and the positions' ranks by that many.
    """
    n = len(text)
    bits = int(text.max() + 1).bit_length()
    at_once = min(n, 62 // bits)  # characters that the first sort compares
    x = np.zeros(n, np.int64)
    for j in range(at_once):
        x <<= bits
        x[:n - j] += text[j:] + 1
    order = np.argsort(x)  # tied ones come in any order, and get one rank
    x = x[order]
    new = np.append(True, x[1:] != x[:-1])
    head = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = head
    tied = ~new
    tied[:-1] |= tied[1:]
    place = np.flatnonzero(tied)  # in the order; ``head`` and ``at`` belong to these places
    head, at, step = head[place], order[place], at_once
    while True:
        if levels is not None:
            levels.append((step, rank.astype(np.int32)))
        if not len(place):
            return order
        after = at + step
        second = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        key = head * (n + 2) + second
        sort = np.argsort(key)
        at, key = at[sort], key[sort]
        order[place] = at
        new = np.append(True, key[1:] != key[:-1])
        head = np.maximum.accumulate(np.where(new, place, 0))
        rank[at] = head
        tied = ~new
        tied[:-1] |= tied[1:]
        place, head, at = place[tied], head[tied], at[tied]
        step *= 2


class RunLengthIndex:
    """The run-length Burrows-Wheeler transform of some strings, sampled at the ends of its runs."""

    def __init__(self, strings: list[np.ndarray], groups: np.ndarray | None = None):
        """Strings of different groups don't match: each group's bytes are characters of their own."""
        shift = np.zeros(len(strings), np.int64) if groups is None else (groups - groups.min()) * 256
        shift += len(strings)
        self.starts = np.cumsum([0] + [len(s) + 1 for s in strings[:-1]])
        self.n = int(self.starts[-1] + len(strings[-1]) + 1)
        text = np.empty(self.n, np.int64)
        for k, (a, s) in enumerate(zip(self.starts, strings, strict=True)):
            text[a:a + len(s)] = s
            text[a:a + len(s)] += shift[k]
            text[a + len(s)] = k  # each string ends in a character of its own
        self.text = text
        levels: list[tuple[int, np.ndarray]] = []
        sa = suffix_array(text, levels)
        bwt = text[sa - 1]
        heads = np.flatnonzero(np.append(True, bwt[1:] != bwt[:-1]))
        tails = np.append(heads[1:] - 1, self.n - 1)
        self.run_chars = bwt[heads]
        self.head_positions, self.tail_positions = sa[heads], sa[tails]
        # a match with the neighbour above a head, and below a tail
        self.head_matches = np.append(0, self._extension(sa[heads[1:]], sa[heads[1:] - 1], levels))
        self.tail_matches = np.append(self._extension(sa[tails[:-1]], sa[tails[:-1] + 1], levels), 0)

    def _extension(self, a: np.ndarray, b: np.ndarray, levels: list[tuple[int, np.ndarray]]) -> np.ndarray:
        """Length of the common prefix of the suffixes at a and b; the strings' own ends bound it.

        Equal ranks of a level are as many equal characters; what is left is shorter than those of the first level.
        """
        out = np.zeros(len(a), np.int64)
        for step, rank in reversed(levels):
            # no string's end is in an equal stretch, so that the text goes on behind it
            out += step * (rank[a + out] == rank[b + out])
        going = np.arange(len(a))
        while len(going):
            x, y = a[going] + out[going], b[going] + out[going]
            same = (x < self.n) & (y < self.n)
            same[same] = self.text[x[same]] == self.text[y[same]]
            going = going[same]
            out[going] += 1
        return out

    def matching_statistics(self) -> np.ndarray:
        """For each position, the longest match that starts at any other position."""
        best = np.zeros(self.n, np.int64)
        place = np.arange(self.n)
        for positions, matches in ((self.head_positions, self.head_matches), (self.tail_positions, self.tail_matches)):
            # from a sample on, each next position matches one byte less
            reach = np.full(self.n, -1, np.int64)
            reach[positions] = place[positions] + matches
            np.maximum(best, np.maximum.accumulate(reach) - place, out=best)
        return best


def _indexed(length: int):
    """Rows (anchor, doc_id, text_hash, at, single, bytes), sorted by the first four, to marks of single contexts.

    Contexts of one anchor that overlap in a document become one string, so that no place is there twice.
    """
    names = ["doc_id", "text_hash", "start", "stop"]

    def marks(rows: list[list]) -> pa.RecordBatch:
        _, groups = np.unique([r[0] for r in rows], return_inverse=True)
        index = RunLengthIndex([np.frombuffer(r[-1], np.uint8) for r in rows], groups)
        best = index.matching_statistics()
        out = []
        for a, (_, doc_id, text_hash, at, single, data) in zip(index.starts, rows, strict=True):
            if single:
                hit = best[a:a + len(data)] >= length
                edges = np.flatnonzero(np.diff(np.concatenate(([False], hit, [False])).astype(np.int8)))
                out.extend((doc_id, text_hash, int(at + s), int(at + e - 1 + length)) for s, e in edges.reshape(-1, 2))
        columns = zip(*out, strict=True) if out else [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for *key, at, single, data in zip(*(batch[c].to_pylist() for c in ("anchor", "doc_id", "text_hash", "at", "single", "bytes")), strict=True):
                if rows and rows[-1][:3] == key and at <= (end := rows[-1][3] + len(rows[-1][-1])):
                    rows[-1][4] |= single
                    rows[-1][-1] += data[end - at:]
                    continue
                if rows and rows[-1][0] != key[0] and size >= INDEX_BYTES:
                    yield marks(rows)
                    rows, size = [], 0
                rows.append([*key, at, single, data])
                size += len(data)
        if rows:
            yield marks(rows)
        release()

    return run


def _ranges(low: int, high: int) -> list[tuple[int, int]]:
    """``SPLIT`` ranges, or fewer, of the places from low to high."""
    step = -(-(high - low + 1) // SPLIT)
    return [(a, min(a + step - 1, high)) for a in range(low, high + 1, step)]


def _split(length: int):
    """Documents with crowded places to the keys and contexts of the ranges; ranges that don't fit in the text go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in chunked(batches, "text", HASHED_BYTES):
            data, offsets = utf8(batch["text"])
            view = memoryview(data)
            wanted = batch["wanted"].to_pylist()
            rows, out, hashes = [], [], []
            for k, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                for x in wanted[k]:
                    p = x["pos"] + a
                    for low, high in _ranges(x["low"], x["high"]):
                        first, last = max(low, p + length - b), min(high, p - a)
                        if first <= last:
                            rows.append(k)
                            out.append((x["pos"], low, high))
                            hashes.append((digest(view[p - low:p - high + length], low * length + high), digest(view[p - last:p - first + length], last)))
            row = pa.array(rows, pa.int64())
            key, context = np.array(hashes, np.uint64).reshape(-1, 2).T
            pos, low, high = zip(*out, strict=True) if out else [()] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.astype(np.int64)), pa.array(context.astype(np.int64)), batch["doc_id"].take(row), batch["text_hash"].take(row),
                 pa.array(pos, pa.int64()), pa.array(low, pa.int32()), pa.array(high, pa.int32())],
                names=["anchor", "context", "doc_id", "text_hash", "pos", "low", "high"])

    return run


def _contexts(length: int):
    """Documents with their wanted places to the bytes of the contexts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunked(batches, "text", HASHED_BYTES):
            data, offsets = utf8(batch["text"])
            view = memoryview(data)
            wanted = batch["wanted"].to_pylist()
            rows, out = [], []
            for k, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                for x in wanted[k]:
                    start = max(0, x["pos"] - x["high"])
                    rows.append(k)
                    out.append((x["anchor"], start, x["single"], bytes(view[a + start:min(b, a + x["pos"] - x["low"] + length)])))
            row = pa.array(rows, pa.int64())
            anchor, at, single, data = zip(*out, strict=True) if out else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor, pa.int64()), batch["doc_id"].take(row), batch["text_hash"].take(row), pa.array(at, pa.int64()),
                 pa.array(single, pa.bool_()), pa.array(data, pa.binary())],
                names=["anchor", "doc_id", "text_hash", "at", "single", "bytes"])

    return run


def united(spans: list[dict]) -> list[tuple[int, int]]:
    """Maximal runs of the marks."""
    out: list[list[int]] = []
    for a, b in sorted((s["start"], s["stop"]) for s in spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _same(a: DataFrame, b: DataFrame):
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["text_hash"] == b["text_hash"])


def _placed(found: DataFrame, key_contexts: int, name: str) -> DataFrame:
    """The rows that may be part of a match, each with ``single`` (its context is there once), ``compared``
    (the contexts of its key have to be compared) and ``crowded`` (too many of them for one index)."""
    kinds = found.groupBy("anchor", "context").agg(F.count("*").alias("n"))
    # per key: a context that occurs again is repeated as a whole; one that doesn't has to be compared with the others
    keys = kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), F.min("n").alias("fewest"), F.max("n").alias("most"))
    compared = F.expr("kinds > 1 and fewest = 1")
    used = (kinds.join(keys.where("most > 1 or kinds > 1"), "anchor")
            .select("anchor", "context", (F.col("n") == 1).alias("single"), compared.alias("compared"), (compared & (F.col("kinds") > key_contexts)).alias("crowded")))
    return written(found.join(used, ["anchor", "context"]), name)


def _compared(placed: DataFrame) -> DataFrame:
    """One place of each context to compare."""
    placed = placed.where("compared")
    one = (placed.where("not single").groupBy("anchor", "context").agg(F.min(F.struct("doc_id", "text_hash", "pos", "low", "high")).alias("one"))
           .select("one.*", "anchor", F.lit(False).alias("single")))
    return placed.where("single").select("doc_id", "text_hash", "pos", "low", "high", "anchor", "single").union(one)


def _with_texts(keyed: DataFrame, places: DataFrame) -> DataFrame:
    wanted = places.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("anchor", "pos", "low", "high", "single")).alias("wanted"))
    return keyed.join(wanted, _same(keyed, wanted), "inner").select(keyed["doc_id"], keyed["text_hash"], "text", "wanted")


def repeated_spans(docs: DataFrame, length: int = LENGTH, key_contexts: int = KEY_CONTEXTS) -> DataFrame:
    """(doc_id, text_hash, whole, parts): the marks of each text that has any; spans may overlap."""
    if length < 2 * GRAM:
        raise ValueError(f"length must be {2 * GRAM} or more")
    keyed = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text")
    columns = "anchor long, context long, doc_id long, text_hash long, pos long"
    every = {"low": F.lit(0), "high": F.lit(length - GRAM)}  # the places of an anchor, known without writing them
    found, path = written_at(keyed.mapInArrow(_anchored(length), columns), "suffix-anchors")
    first = _placed(found, key_contexts, "suffix-placed").withColumns(every)
    discard(docs.sparkSession, path)
    levels = [first]
    # ends at single places at the latest: there a key has one context
    while not levels[-1].where("crowded").isEmpty():
        crowded = _with_texts(keyed, _compared(levels[-1].where("crowded")))
        found, path = written_at(crowded.mapInArrow(_split(length), columns + ", low int, high int"), "suffix-split")
        levels.append(_placed(found, key_contexts, "suffix-split-placed"))
        discard(docs.sparkSession, path)
    places = reduce(DataFrame.union, (_compared(x.where("not crowded")) for x in levels))
    contexts = _with_texts(keyed, places).mapInArrow(_contexts(length), "anchor long, doc_id long, text_hash long, at long, single boolean, bytes binary")
    marks = (contexts.repartition("anchor").sortWithinPartitions("anchor", "doc_id", "text_hash", "at")
             .mapInArrow(_indexed(length), "doc_id long, text_hash long, start long, stop long"))
    for x in levels[1:]:
        marks = marks.union(x.where("not single").select("doc_id", "text_hash", F.expr("greatest(pos - high, 0)"), F.expr(f"pos - low + {length}")))
    whole = first.where("not single").groupBy("doc_id", "text_hash").agg(F.collect_set("pos").alias("whole"))
    parts = marks.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("start", "stop")).alias("parts"))
    both = whole.join(parts, _same(whole, parts), "full")
    return both.select(
        F.coalesce(whole["doc_id"], parts["doc_id"]).alias("doc_id"),
        F.coalesce(whole["text_hash"], parts["text_hash"]).alias("text_hash"),
        F.coalesce("whole", F.array().cast("array<bigint>")).alias("whole"),
        F.coalesce("parts", F.array().cast("array<struct<start:bigint,stop:bigint>>")).alias("parts"))


def _spans(whole: list[int], parts: list[dict], n_bytes: int, length: int) -> list[tuple[int, int]]:
    left = length - GRAM
    spans = [{"start": max(0, p - left), "stop": p + length} for p in whole or ()] + (parts or [])
    return united([{"start": x["start"], "stop": min(n_bytes, x["stop"])} for x in spans])


def _with_spans(docs: DataFrame, length: int) -> DataFrame:
    """The documents, all columns, with ``__whole`` and ``__parts``."""
    spans = repeated_spans(docs, length).select(F.col("doc_id").alias("__d"), F.col("text_hash").alias("__t"),
                                                F.col("whole").alias("__whole"), F.col("parts").alias("__parts"))
    return docs.join(spans, docs["doc_id"].cast("long").eqNullSafe(F.col("__d")) & (F.xxhash64(docs["text"]) == F.col("__t")), "left").drop("__d", "__t")


def removed_digests(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document, and whether it has repeats."""
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, has_repeats boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunked(batches, "text", HASHED_BYTES):
            data, offsets = utf8(batch["text"])
            view = memoryview(data)
            whole, parts, out = batch["__whole"].to_pylist(), batch["__parts"].to_pylist(), []
            for k, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                spans = _spans(whole[k], parts[k], b - a, length)
                kept, last = hashlib.sha256(), 0
                for s, e in spans:
                    kept.update(view[a + last:a + s])
                    last = e
                kept.update(view[a + last:b])
                out.append((b - a, sum(e - s for s, e in spans), len(spans), kept.hexdigest()))
            columns = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string()),
                                              pa.array([n > 0 for n in columns[1]], pa.bool_())],
                                             names=[x.split()[0] for x in schema.split(", ")])

    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return _with_spans(docs, length).mapInArrow(run, schema)


def without_repeats(docs: DataFrame, length: int = LENGTH, *, text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """The documents, all columns, without the repeated passages.

    A character stays if any of its bytes does, so the text stays valid UTF-8; ``n_chars`` is set
    anew where there is such a column.  A document of which nothing is left keeps its row.
    """
    names, schema = docs.columns, docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunked(batches, text):
            column = batch[text]
            data, offsets = utf8(column)
            inside = (data & 0xC0) == 0x80  # bytes that continue a character
            whole, parts, out = batch["__whole"].to_pylist(), batch["__parts"].to_pylist(), []
            for k, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                kept, last = [], a
                for s, e in _spans(whole[k], parts[k], b - a, length):
                    s, e = s + a, e + a
                    while s < e and inside[s]:
                        s += 1
                    while e < b and e > s and inside[e]:
                        e -= 1
                    kept.append(data[last:s].tobytes())
                    last = max(s, e)
                out.append(None if not column[k].is_valid else b"".join([*kept, data[last:b].tobytes()]).decode())
            columns = {c: batch[c] for c in names} | {text: pa.array(out, column.type)}
            if n_chars in columns:
                columns[n_chars] = pa.array([None if x is None else len(x) for x in out], batch[n_chars].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=names)

    return _with_spans(docs, length).mapInArrow(run, schema)
