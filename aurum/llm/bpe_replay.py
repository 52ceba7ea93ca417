"""Byte-level BPE by corpus-level merge replay, and its inverse.

A task gathers the distinct pre-tokens of a stretch of its documents and replays the merges over
all of them together: an inverted index leads from a rank to the positions whose pair merges to
that rank, the ranks are taken in order from a heap, and each merge touches only its two
neighbours.  Words seen earlier come from a bounded memory; when it is full it is emptied, which
changes the work and never the result.

Defined cases: a null text is empty (no ids, the hash of no bytes); a text without any match of
the pattern has no ids; repeated rows give equal rows; a null doc_id is carried through; an empty
table gives an empty result; a pre-token of more than LONG bytes has an index of its own, in n log n;
other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aurum.llm.common import chunked, texts

NONE = 1 << 62
#: Words of more bytes have an index of their own.
LONG = 1024
#: Bytes of the remembered words, and of the remembered pieces (with what Python adds to each).
MEMORY_BYTES = 32 << 20
ENTRY_BYTES = 150
STRETCH_BYTES = 4 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class Replay:
    """The merges of one rank file."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        # every way to put a token together from two tokens, sorted by the two ids
        found = [(left << 32 | right, rank) for token, rank in ranks.items() for k in range(1, len(token))
                 if (left := ranks.get(token[:k])) is not None and (right := ranks.get(token[k:])) is not None]
        found.sort()
        pairs = np.array(found, np.int64).reshape(-1, 2)
        self.pairs = np.append(pairs[:, 0], NONE)  # the last entry is no pair
        self.merged = np.append(pairs[:, 1], NONE)
        # tokens whose making can bring up a pair of a lower rank than their own
        parts = np.concatenate((pairs[:, 0] >> 32, pairs[:, 0] & 0xFFFFFFFF))
        self.risky = set(parts[parts > np.tile(pairs[:, 1], 2)].tolist())

    def encode(self, words: list[bytes]) -> list[bytes]:
        """For each word its ids as little-endian 32-bit integers."""
        out: list[bytes] = [b""] * len(words)
        todo = []
        for k, word in enumerate(words):
            rank = self.ranks.get(word)
            if rank is not None:
                out[k] = rank.to_bytes(4, "little")
            elif len(word) > LONG:
                out[k] = self._long(word)
            elif word:
                todo.append(k)
        if todo:
            for k, ids in zip(todo, self._merged([words[k] for k in todo]), strict=True):
                out[k] = ids
        return out

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        code = left << 32 | right
        at = np.searchsorted(self.pairs, code)
        at[self.pairs[at] != code] = -1
        return self.merged[at]

    def _long(self, word: bytes) -> bytes:
        """One long word, its own index from rank to positions being a heap of (rank, position): n log n."""
        n = len(word)
        ids = self.byte_ids[np.frombuffer(word, np.uint8)]
        ranks = self._rank(ids[:-1], ids[1:])
        at = np.flatnonzero(ranks < NONE)
        heap = (ranks[at] << 40 | at).tolist()
        heapify(heap)
        known: dict[int, int] = {}

        def rank_of(left: int, right: int) -> int:
            code = left << 32 | right
            if (rank := known.get(code)) is None:
                rank = known[code] = int(self._rank(np.array([left]), np.array([right]))[0])
            return rank

        ids, after, before = ids.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
        pair = ranks.tolist() + [NONE]  # the rank of the pair that starts at a position; NONE where a merge took it
        while heap:
            entry = heappop(heap)
            rank, p = entry >> 40, entry & (1 << 40) - 1
            if pair[p] != rank:
                continue
            gone = after[p]
            ids[p], after[p], pair[gone], ids[gone] = rank, after[gone], NONE, -1
            pair[p] = NONE
            right, left = after[p], before[p]
            if right < n:
                before[right] = p
                if (new := rank_of(rank, ids[right])) < NONE:
                    pair[p] = new
                    heappush(heap, new << 40 | p)
            if left >= 0:
                pair[left] = new = rank_of(ids[left], rank)
                if new < NONE:
                    heappush(heap, new << 40 | left)
        return np.array([i for i in ids if i >= 0], "<u4").tobytes()

    def _merged(self, words: list[bytes]) -> list[bytes]:
        flat = np.frombuffer(b"".join(words), np.uint8)
        sizes = np.array([len(w) for w in words])
        n, ends = len(flat), np.cumsum(sizes)
        word = np.repeat(np.arange(len(words)), sizes)
        ids = self.byte_ids[flat]
        alive = np.ones(n, bool)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[ends - 1] = before[ends - sizes] = -1
        rank_of = np.full(n, NONE, np.int64)
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def note(at: np.ndarray) -> None:
            """Enter the pairs that start at these positions in the index."""
            ranks = self._rank(ids[at], ids[after[at]])
            rank_of[at] = ranks
            at, ranks = at[ranks < NONE], ranks[ranks < NONE]
            if not len(at):
                return
            order = np.argsort(ranks, kind="stable")
            at, ranks = at[order], ranks[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            starts = [0, *cuts.tolist()]
            for rank, a, b in zip(ranks[starts].tolist(), starts, [*starts[1:], len(at)], strict=True):
                if rank in index:
                    index[rank].append(at[a:b])
                else:
                    index[rank] = [at[a:b]]
                    heappush(heap, rank)

        note(np.flatnonzero(after >= 0))
        while heap:
            rank = heappop(heap)
            at = index.pop(rank)
            at = at[0] if len(at) == 1 else np.concatenate(at)
            at = np.sort(at[rank_of[at] == rank])  # others went with an earlier merge
            at = at[np.append(at[:-1] != at[1:], True)] if len(at) > 1 else at
            if not len(at):
                continue
            if len(at) > 1:
                if rank in self.risky:  # the leftmost of each word; then lower ranks come first
                    first = np.append(True, word[at[1:]] != word[at[:-1]])
                    if not first.all():
                        index[rank] = [at[~first]]
                        heappush(heap, rank)
                        at = at[first]
                else:  # of pairs that overlap, every second one from the left
                    tied = np.append(False, after[at[:-1]] == at[1:])
                    if tied.any():
                        place = np.arange(len(at))
                        chain = place - np.maximum.accumulate(np.where(tied, 0, place))
                        at = at[chain % 2 == 0]
            gone = after[at]
            alive[gone] = False
            rank_of[gone] = NONE
            ids[at] = rank
            rank_of[at] = NONE
            following = after[gone]
            after[at] = following
            inner = following >= 0
            before[following[inner]] = at[inner]
            left = before[at]
            note(np.concatenate((at[inner], left[left >= 0])))
        kept = np.cumsum(alive)[ends - 1] * 4
        data, start, out = ids[alive].astype("<u4").tobytes(), 0, []
        for stop in kept.tolist():
            out.append(data[start:stop])
            start = stop
        return out


class Encoder:
    """Texts to ids, with a bounded memory of words and of pieces between spaces.

    No match of the pattern crosses the place before a single space between two other characters,
    so a text is cut there and each distinct piece is split and encoded once.  A text with a space
    next to other white space is split whole.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks, self.replay, self.split = ranks, Replay(ranks), regex.compile(pattern).findall
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes | None] = {}

    def _parts(self, piece: str) -> list[str]:
        if piece.isalpha():
            return [" " + piece]
        if piece[:-1].isalpha() and piece[-1] in ".,":
            return [" " + piece[:-1], piece[-1]]
        return self.split(" " + piece)

    def _ids(self, parts: list[list[str]]) -> Iterator[bytes]:
        words = set().union(*parts)
        new = list(words.difference(self.words))
        keep_below(self.words, len(new), words)
        self.words.update(zip(new, self.replay.encode([w.encode() for w in new]), strict=True))
        for own in parts:
            yield b"".join(map(self.words.__getitem__, own))

    def encode(self, rows: list[str]) -> list[bytes]:
        """For each text its ids as little-endian 32-bit integers."""
        cut = [x.split(" ") for x in rows]
        heads = [own[0] for own in cut]
        for own in cut:
            own[0] = ""
        pieces = set().union(*cut)
        new = list(pieces.difference(self.pieces))
        keep_below(self.pieces, len(new), pieces)
        self.pieces.update(dict.fromkeys(new))
        plain = [p for p in new if p and not p[0].isspace() and not p[-1].isspace()]
        self.pieces.update(zip(plain, self._ids(list(map(self._parts, plain))), strict=True))
        out, whole = [], []
        for k, (head, ids) in enumerate(zip(heads, self._ids(list(map(self.split, heads))), strict=True)):
            try:
                if head[-1:].isspace():
                    raise TypeError
                out.append(ids + b"".join(map(self.pieces.__getitem__, cut[k][1:])))
            except TypeError:  # the memory holds None for an irregular piece
                whole.append(k)
                out.append(b"")
        for k, ids in zip(whole, self._ids([self.split(rows[k]) for k in whole]), strict=True):
            out[k] = ids
        return out


_encoders: dict[tuple[int, str], Encoder] = {}


def encoder(ranks: dict[bytes, int], pattern: str) -> Encoder:
    """The worker's encoder; it serves all tasks that the worker runs with this vocabulary."""
    key = (id(ranks), pattern)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(ranks, pattern)
    return _encoders[key]


def keep_below(memory: dict, coming: int, needed: set) -> None:
    """Make room: forget what isn't needed now, if the memory would grow too large."""
    if (len(memory) + coming) * ENTRY_BYTES > MEMORY_BYTES:
        kept = {w: memory[w] for w in needed if w in memory}
        memory.clear()
        memory.update(kept)


def bpe_digests(docs: DataFrame, ranks: dict[bytes, int], pattern: str, *, with_ids: bool = False) -> DataFrame:
    """Encode every whole text, decode the ids again, and return the digests of both.

    ``ranks`` is a vocabulary (its file bounds its size); Spark broadcasts it once.  ``with_ids``
    adds the ids themselves as ``array<int>``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        token = dict(zip(vocabulary.values(), vocabulary.keys(), strict=True)).__getitem__
        encode = encoder(vocabulary, pattern).encode
        for batch in chunked(batches, "text", STRETCH_BYTES):
            ids = encode(texts(batch["text"]))
            decoded = [b"".join(map(token, np.frombuffer(x, "<u4").tolist())) for x in ids]
            columns = [batch["doc_id"], pa.array([len(x) // 4 for x in ids], pa.int64()),
                       pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                       pa.array([hashlib.sha256(x).hexdigest() for x in decoded], pa.string())]
            if with_ids:
                columns.append(pa.array([np.frombuffer(x, "<i4") for x in ids], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in schema.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)
