"""Quality rules: per-document base rules and cross-document line frequency.

1. One pass over the documents measures every whole text and keeps, for each distinct normalised
   line, its 64-bit hash.  The measurements are written once beside the text, so that the counts
   read a few bytes a line instead of the texts.
2. For each host (the ``source`` column) and line hash the distinct documents are counted.  Copies
   of one text count as one document: a document that was crawled often doesn't turn its own
   lines into boilerplate.
3. A line above the host's limit, ``max(min_docs, host_share * documents of the host)``, is removed
   from the texts of the host, wherever it stands; ``text`` is what is left.
   A document that loses so many words that fewer than ``min_left_words`` or less than
   ``min_left_share`` of them are left is depleted and rejected; a line's copies within one text
   count once there (``removed_words``).

Defined cases: a null text has no words (it fails the base rules); a null host is a host of its
own; a null doc_id is carried through; repeated rows are judged one by one and get equal results;
lines without a word have no weight; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aurum.llm.common import SPACES, chunked, mix64, texts, written

SYMBOLS = "[#*$%&|<>]"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

MIN_DOCS = 10
HOST_SHARE = 0.02
MIN_LEFT_WORDS = 5
MIN_LEFT_SHARE = 0.2
#: 64-bit words of the filter before the join that picks texts (256 KB).
FILTER_WORDS = 1 << 15

_MEASURES = ("doc_id long, host string, text_hash long, n_words long, word_chars long, n_symbols long, "
             "n_dup_lines long, n_repeat_words long, line_hashes array<long>, text string")
_LEFT = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
         "removed_words long, text string")


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words covered by ``window``-word windows that occur at least twice in the list."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    h = mix64(np.array(list(map(hash, words)), dtype=np.int64).view(np.uint64))
    windows = np.zeros(n, np.uint64)
    for j in range(window):
        windows *= np.uint64(0x9E3779B97F4A7C15)
        windows += h[j:j + n]
    _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
    if len(counts) == n:
        return 0
    edges = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(counts[inverse] > 1)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + window, -1)
    return int(np.count_nonzero(np.cumsum(edges)[:-1]))


def line_hash(words: list[bytes]) -> int:
    """Signed 64-bit hash of the normalised line with these words."""
    key = xxhash.xxh3_64_intdigest(b" ".join(words).decode().lower().encode())
    return key - (1 << 64) if key >> 63 else key


def without_lines(text: str, frequent: set[int]) -> tuple[str, int]:
    """The text without the lines of these hashes, and the words of the distinct ones among them."""
    gone: dict[int, int] = {}
    left = []
    for line in text.split("\n"):
        own = line.encode().split()
        key = line_hash(own) if own else None
        if key in frequent:
            gone[key] = len(own)
        else:
            left.append(line)
    return "\n".join(left), sum(gone.values())


def measure(text: str) -> tuple:
    """Base figures of one text, then the hash of each distinct normalised line."""
    data = text.encode()
    words = data.split()
    seen, duplicates = set(), 0
    lines: dict[int, None] = {}
    for line in data.split(b"\n"):
        own = line.split()
        if not own:
            continue
        if line in seen:
            duplicates += 1
            continue
        seen.add(line)
        lines[line_hash(own)] = None
    return (len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS[1:-1])),
            duplicates, repeated_words(words), list(lines))


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64()] * 5 + [pa.list_(pa.int64())]
    for batch in chunked(batches, "text"):
        rows = texts(batch["text"])
        hashes = [xxhash.xxh3_64_intdigest(x.encode()) >> 1 for x in rows]
        columns = list(zip(*map(measure, rows), strict=True))
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["host"], pa.array(hashes, pa.int64())]
            + [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)] + [batch["text"]],
            names=[x.split()[0] for x in _MEASURES.split(", ")])


def _left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in _LEFT.split(", ")]
    for batch in chunked(batches, "text"):
        rows = [(x, 0) if not f else without_lines(x, set(f))
                for x, f in zip(batch["text"].to_pylist(), batch["frequent"].to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch[n] for n in names[:-2]] + [pa.array([n for _, n in rows], pa.int64()), pa.array([x for x, _ in rows], pa.string())],
            names=names)


def maybe_touched(measured: DataFrame, frequent: DataFrame) -> DataFrame:
    """``measured`` with ``maybe``: whether one of the document's lines may be frequent, so that only such texts move in the join.

    A bit table of fixed size, a scalar subquery; with very many frequent lines it lets more through, and the join decides.
    """
    def place(line: Column) -> Column:
        return F.pmod(F.xxhash64(F.col("host"), line), F.lit(FILTER_WORDS * 64))

    def bit(line: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), (place(line) % 64).cast("int"))

    words = frequent.groupBy(F.floor(place(F.col("line")) / 64).alias("w")).agg(F.bit_or(bit(F.col("line"))).alias("bits"))
    every = frequent.sparkSession.range(FILTER_WORDS).select(F.col("id").alias("w")).join(words, "w", "left")
    table = every.agg(F.transform(F.sort_array(F.collect_list(F.struct("w", F.coalesce("bits", F.lit(0).cast("long")).alias("bits")))),
                                  lambda x: x["bits"]).alias("t")).scalar()
    return measured.withColumn("table", table).withColumn("maybe", F.exists("line_hashes", lambda x: bit(x).bitwiseAND(
        F.get("table", F.floor(place(x) / 64).cast("int"))) != 0)).drop("table")


def line_quality(docs: DataFrame, *, host: str = "source", min_docs: int = MIN_DOCS, host_share: float = HOST_SHARE,
                 min_left_words: int = MIN_LEFT_WORDS, min_left_share: float = MIN_LEFT_SHARE) -> DataFrame:
    """One row per document with its figures, the words that line removal takes, the verdict, and the text that is left."""
    measured = written(
        docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"), "text")
        .mapInArrow(_measured, _MEASURES)
        .withColumn("row", F.monotonically_increasing_id()), "line-quality")
    lines = measured.select("row", "host", "text_hash", F.explode("line_hashes").alias("line"))
    hosts = measured.groupBy("host", "text_hash").agg(F.lit(1).alias("one")).groupBy("host").agg(F.count("*").alias("n")).select(
        "host", F.greatest(F.lit(float(min_docs)), F.lit(host_share) * F.col("n")).alias("limit"))
    frequent = written(lines.groupBy("host", "line", "text_hash").agg(F.lit(1).alias("one"))
                .groupBy("host", "line").agg(F.count("*").alias("n_docs"))
                .where(F.col("n_docs") > min_docs).join(hosts, "host").where(F.col("n_docs") > F.col("limit"))
                .select("host", "line"), "line-frequent")
    # a document's own lines: the list is no longer than its text
    marked = maybe_touched(measured, frequent)
    found = (marked.where("maybe").select("row", "host", F.explode("line_hashes").alias("line")).join(frequent, ["host", "line"])
             .groupBy("row").agg(F.collect_list("line").alias("frequent")))
    rest = marked.drop("line_hashes", "host", "text_hash")
    cleaned = (rest.where("maybe").join(found, "row", "left")
               .unionByName(rest.where("not maybe").withColumn("frequent", F.lit(None).cast("array<long>")))
               .drop("row", "maybe").mapInArrow(_left, _LEFT))
    left = F.col("n_words") - F.col("removed_words")
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return (cleaned
            .withColumn("base_failed", base_failed)
            .withColumn("depleted", (left < min_left_words) | (left < min_left_share * F.col("n_words")))
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                    (~F.col("base_failed") & ~F.col("depleted")).alias("kept"), "removed_words", "text"))
