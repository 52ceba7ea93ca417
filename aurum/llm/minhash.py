"""Near-duplicates by ProbMinHash.

1. Signature: every distinct five-word shingle is an element with its count as weight.  Its arrivals
   are a Poisson process of that rate; each arrival falls into a random register, which keeps the
   earliest one.  An element stops as soon as its next arrival is later than every register's.  Two
   signatures agree in a register with a probability equal to the probability Jaccard similarity.
2. Banding: ``BANDS`` bands of ``ROWS`` registers; a pair of similarity 0.8 misses all bands once in
   300,000 times, and one of 0.9 never in practice.
3. Verification, first round: all texts of a bucket against its hub, the one that meets the most others in
   all of its buckets (of edited copies, the original).  Verified links give components.  Second round:
   buckets that hold several components are compared across components, in blocks of bounded size; long
   signatures sift the pairs where they meet, so that only those near the threshold leave the block, and
   the texts decide.  So no similar pair of a bucket is left out, although no round lists the pairs
   inside a component.
4. Components of all links (alternating large-star and small-star steps); a class is named by its
   smallest doc_id.

Equal texts meet in one node (64-bit hash of the text) before anything else.

Defined cases: words are maximal runs without ASCII white space, case counts; a text with one to four
words is a single shingle; a text without words (also null) is alone in its class, named by its own
doc_id; a null doc_id names a class only if no other member has an id; repeated rows share a class;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aurum.llm.common import chunked, mix64, texts, written

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 4
REGISTERS = BANDS * ROWS
BLOCK = 512
#: Registers of the long signatures, and how many must agree before texts are compared: at a similarity of 0.8
#: (a standard deviation of 0.0125) fewer agree once in 300,000 times.
LONG = 1024
#: 64-bit words of the filter before the join that picks texts (256 KB).
FILTER_WORDS = 1 << 15
SIFT = int((SIMILARITY - 4.5 * 0.0125) * LONG)

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str, known: dict[bytes, int], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the distinct shingles, ascending, and their counts."""
    words = text.encode().split()
    if not words:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    digest = xxhash.xxh3_64_intdigest
    h = np.fromiter([known.get(w) or known.setdefault(w, digest(w)) for w in words], np.uint64, len(words))
    size = min(size, len(h))
    out = np.zeros(len(h) - size + 1, np.uint64)
    for j in range(size):
        out = mix64(out + h[j:j + len(out)]) * _GOLDEN
    return np.unique(out, return_counts=True)


def signatures(elements: list[tuple[np.ndarray, np.ndarray]], m: int = REGISTERS) -> np.ndarray:
    """ProbMinHash signatures, one row of ``m`` registers for each list of (elements, weights)."""
    rows = len(elements)
    hashes = np.concatenate([e for e, _ in elements])
    weights = np.concatenate([w for _, w in elements]).astype(float)
    base = np.repeat(np.arange(rows) * m, [len(e) for e, _ in elements])
    earliest = np.full(rows * m, np.inf)
    signature = np.zeros(rows * m, np.uint64)
    time, draw = np.zeros(len(hashes)), np.zeros(1, np.uint64)
    while len(hashes):
        draw += _GOLDEN
        random = mix64(hashes + draw)
        time = time - np.log(((random >> np.uint64(11)).astype(float) + 1) * 2.0**-53) / weights
        at = base + (mix64(random) % np.uint64(m)).astype(np.int64)
        better = time < earliest[at]
        np.minimum.at(earliest, at[better], time[better])
        won = better & (time == earliest[at])
        signature[at[won]] = hashes[won]
        latest = earliest.reshape(rows, m).max(1)
        going = time < latest[base // m]
        hashes, weights, base, time = hashes[going], weights[going], base[going], time[going]
    return signature.reshape(rows, m)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Probability Jaccard similarity: the sum over shared d of 1 / sum_e max(a_e / a_d, b_e / b_d)."""
    shared, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(shared):
        return 0.0
    x, y = a[1][i].astype(float), b[1][j].astype(float)
    only_a, only_b = a[1].sum() - x.sum(), b[1].sum() - y.sum()
    if (a[1] == 1).all() and (b[1] == 1).all():
        return len(shared) / (len(shared) + only_a + only_b)
    # sum_e max(x_e / x_d, y_e / y_d): x_e wins where x_e / y_e >= x_d / y_d
    ratio = x / y
    order = np.argsort(ratio)
    ratio, x, y = ratio[order], x[order], y[order]
    first = np.searchsorted(ratio, ratio, side="left")
    below = np.concatenate(([0.0], np.cumsum(y)))[first]
    above = x.sum() - np.concatenate(([0.0], np.cumsum(x)))[first]
    return float((1 / ((only_a + above) / x + (only_b + below) / y)).sum())


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunked(batches, "text", 2 << 20):
        known: dict[bytes, int] = {}
        own = [shingles(x, known) for x in texts(batch["text"])]
        full = [k for k, x in enumerate(own) if len(x[0])]
        if not full:
            continue
        signed = signatures([own[k] for k in full])
        yield pa.RecordBatch.from_arrays(
            [batch["node"].take(pa.array(full)), pa.array([x.tobytes() for x in signed], pa.binary())], names=["node", "signature"])


def _long_signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Long signatures, a byte of each register."""
    for batch in chunked(batches, "text", 1 << 20):
        known: dict[bytes, int] = {}
        signed = signatures([shingles(x, known) for x in texts(batch["text"])], LONG)
        yield pa.RecordBatch.from_arrays(
            [batch["node"], batch["keys"], pa.array([x.tobytes() for x in (mix64(signed) & np.uint64(255)).astype(np.uint8)], pa.binary())],
            names=["node", "keys", "signature"])


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        signed = np.frombuffer(b"".join(batch["signature"].to_pylist()), np.uint64).reshape(-1, BANDS, ROWS)
        key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64) * _GOLDEN, signed.shape[:2])
        for r in range(ROWS):
            key = mix64(key + signed[:, :, r]) * _GOLDEN
        node = np.repeat(batch["node"].to_numpy(), BANDS)
        yield pa.RecordBatch.from_arrays([pa.array(key.ravel().view(np.int64)), pa.array(node)], names=["key", "node"])


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (a, b, text_a, text_b), those of one a together, to the linked pairs."""
    last, left = None, None
    for batch in chunked(batches, "text_b", 2 << 20):
        known: dict[bytes, int] = {}
        linked = []
        a, b = batch["a"].to_pylist(), batch["b"].to_pylist()
        for k, text in enumerate(texts(batch["text_b"])):
            if a[k] != last:
                last, left = a[k], shingles(batch["text_a"][k].as_py(), known)
            if similarity(left, shingles(text, known)) >= SIMILARITY:
                linked.append(k)
        yield pa.RecordBatch.from_pydict({"a": pa.array([a[k] for k in linked], pa.int64()), "b": pa.array([b[k] for k in linked], pa.int64())})


def _sifted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, i, j, side, node, component, keys, signature), sorted by key, i, j, to similar pairs of two components.

    A group is a pair of blocks of a bucket, of about ``BLOCK`` rows each; side says which blocks a row belongs to.
    A pair comes from the smallest of the buckets that it shares.
    """

    def pairs(key: int, rows: list[tuple]) -> set[tuple[int, int]]:
        node, comp = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
        side = np.array([r[0] for r in rows])
        signed = np.frombuffer(b"".join(r[4] for r in rows), np.uint8).reshape(len(rows), -1)
        found = set()
        for k in range(len(rows)):
            # within a block all later rows, across two blocks the rows of the other one
            others = np.flatnonzero(comp != comp[k])
            others = others[others > k] if side[k] == 2 else others[side[others] == 1] if side[k] == 0 else others[:0]
            same = (signed[others] == signed[k]).sum(1)
            own, keys = int(node[k]), set(rows[k][3])
            found.update((min(own, rows[x][1]), max(own, rows[x][1])) for x in others[same >= SIFT].tolist() if min(keys.intersection(rows[x][3])) == key)
        return found

    def out(found: set[tuple[int, int]]) -> pa.RecordBatch:
        a, b = zip(*found, strict=True) if found else ((), ())
        return pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    group, rows = None, []
    for batch in batches:
        found: set[tuple[int, int]] = set()
        for key, i, j, *row in zip(*(batch[c].to_pylist() for c in ("key", "i", "j", "side", "node", "component", "keys", "signature")), strict=True):
            if (key, i, j) != group:
                if len(rows) > 1:
                    found |= pairs(group[0], rows)
                group, rows = (key, i, j), []
            rows.append(tuple(row))
        yield out(found)
    if len(rows) > 1:
        yield out(pairs(group[0], rows))


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) of every node of the edges (a, b); a component is named by its smallest node.

    Large-star and small-star steps; each round's edges are written, so that plans stay short and
    executors may be lost.
    """
    edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    before = None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                                                               F.struct(F.col("a"), F.col("m").alias("b")))).alias("e"))
        edges = written(small.select("e.a", "e.b").where("a <> b").distinct(), name)
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select("b", "b").distinct().toDF("node", "component"))


def verified(pairs: DataFrame, node_texts: DataFrame, name: str) -> DataFrame:
    """The pairs (a, b) whose texts are similar enough."""
    pairs = written(pairs, f"{name}-pairs")  # its size is known when the joins are planned: the smaller side moves
    left, right = (node_texts.select(F.col("node").alias(c), F.col("text").alias(f"text_{c}")) for c in "ab")
    return written(pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b").mapInArrow(_verified, "a long, b long"), name)


def maybe_in(nodes: DataFrame, needed: DataFrame) -> DataFrame:
    """The rows whose node may be one of ``needed`` (some others too), before a join has to move their texts.

    A bit table of fixed size, a scalar subquery: with very many needed nodes it lets more through, and the join decides.
    """
    word = F.expr(f"pmod(node, {FILTER_WORDS * 64}L) div 64")
    bit = F.expr("shiftleft(1L, cast(pmod(node, 64L) as int))")
    words = needed.groupBy(word.alias("w")).agg(F.bit_or(bit).alias("bits"))
    every = needed.sparkSession.range(FILTER_WORDS).select(F.col("id").alias("w")).join(words, "w", "left")
    table = every.agg(F.transform(F.sort_array(F.collect_list(F.struct("w", F.coalesce("bits", F.lit(0).cast("long")).alias("bits")))),
                                  lambda x: x["bits"]).alias("t")).scalar()
    return nodes.where(bit.bitwiseAND(F.element_at(table, (word + 1).cast("int"))) != 0)


def _members(docs: DataFrame) -> DataFrame:
    """doc_id, node (the hash of the text), component and has_words of every document."""
    nodes = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("node"), "text")
    # one row for each distinct text with words
    signed = written(nodes.select("node", "text").where(F.col("text").isNotNull()).mapInArrow(_signed, "node long, signature binary")
                     .groupBy("node").agg(F.first("signature").alias("signature")), "minhash-signatures")
    banded = signed.mapInArrow(_banded, "key long, node long")
    shared = banded.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    located = written(banded.join(shared, "key"), "minhash-located")
    meets = located.groupBy("node").agg(F.sum("n").alias("meets"))
    hubs = located.join(meets, "node").groupBy("key").agg(F.max(F.struct("meets", "node"))["node"].alias("leader"))
    buckets = written(located.join(hubs, "key"), "minhash-buckets")
    needed = written(buckets.select("node").distinct(), "minhash-needed")
    node_texts = written(maybe_in(nodes.select("node", "text"), needed).join(needed, "node", "left_semi").groupBy("node").agg(F.first("text").alias("text")),
                         "minhash-texts")
    first = verified(buckets.where("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct(),
                     node_texts, "minhash-links")
    parts = components(first, "minhash-components")
    # buckets in which several components meet, in pairs of blocks
    in_parts = buckets.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = in_parts.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("key")
    n_blocks = F.ceil(F.col("n") / BLOCK)
    blocks = (in_parts.join(mixed, "key").select("key", "node", "component", n_blocks.alias("blocks"),
                                                F.pmod(F.xxhash64("node", "key"), n_blocks).alias("own"))
              .withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
              .select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                      F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"),
                      "node", "component"))
    in_mixed = in_parts.join(mixed, "key").groupBy("node").agg(F.collect_list("key").alias("keys"))  # at most BANDS keys
    long_signed = written(node_texts.join(in_mixed, "node").select("node", "keys", "text")
                          .mapInArrow(_long_signed, "node long, keys array<long>, signature binary"), "minhash-long")
    tried = buckets.where("node <> leader").select(F.least("leader", "node").alias("a"), F.greatest("leader", "node").alias("b"))
    sifted = (blocks.join(long_signed, "node").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
              .select("key", "i", "j", "side", "node", "component", "keys", "signature").mapInArrow(_sifted, "a long, b long").distinct()
              .join(tried.distinct(), ["a", "b"], "left_anti"))
    second = verified(sifted, node_texts, "minhash-more-links")
    # links between components, then the components of both rounds
    of = parts.select(F.col("node").alias("n"), "component")
    links = (second.join(of, F.col("a") == F.col("n"), "left").withColumn("ca", F.coalesce("component", "a")).select("ca", "b")
             .join(of, F.col("b") == F.col("n"), "left").withColumn("cb", F.coalesce("component", "b")).select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    joined = components(links, "minhash-joined").select(F.col("node").alias("part"), F.col("component").alias("whole"))
    alone = joined.select(F.col("part").alias("node"), F.col("part").alias("component"))  # single nodes of the second round
    final = (parts.union(alone).distinct().groupBy("node").agg(F.min("component").alias("component"))
             .join(joined, F.col("component") == F.col("part"), "left")
             .select("node", F.coalesce("whole", "component").alias("component")))
    worded = signed.select(F.col("node").alias("worded"))
    members = (nodes.select("doc_id", "node").join(final, "node", "left").join(worded, F.col("node") == F.col("worded"), "left")
               .select("doc_id", "node", F.coalesce("component", "node").alias("component"), F.col("worded").isNotNull().alias("has_words")))
    return written(members, "minhash-members")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id and class_id of every document."""
    members = _members(docs)
    classes = members.where("has_words").groupBy("component").agg(F.min("doc_id").alias("class_id"))
    return (members.join(classes, "component", "left")
            .select("doc_id", F.when(F.col("has_words"), F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id")))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents, all columns: one row of each class, that of its smallest doc_id and text hash; rows without an id stay.

    Texts without words are classes of their own; rows of equal doc_id and text count once.
    """
    members = _members(docs).where("doc_id is not null")
    first = members.where("has_words").groupBy("component").agg(F.min(F.struct("doc_id", "node")).alias("one")).select("one.*")
    kept = first.unionByName(members.where("not has_words").select("doc_id", "node")).distinct().toDF("__id", "__node")
    named = docs.withColumn("__text", F.xxhash64("text")).withColumn("__copy", F.xxhash64(*docs.columns)).join(
        kept, (F.col("doc_id") == F.col("__id")) & (F.col("__text") == F.col("__node")), "left_semi")
    rows = named.groupBy("doc_id", "__text").agg(F.min_by(F.struct(*docs.columns), "__copy").alias("__row")).select("__row.*")
    return rows.unionByName(docs.where(F.col("doc_id").isNull()))
