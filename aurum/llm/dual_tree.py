"""Vector code compression: product codes whose codebooks Lloyd rounds with two trees train in integers.

Each component x becomes the integer floor(1024 * x); vectors are cut into ``PARTS`` equal consecutive parts, each
with its own codebook of ``ENTRIES`` entries, seeded with that part of the smallest vec_ids.

Rows are packed once into blocks and written; in a block, each part position has a balanced tree (splits at the median
of the widest component), kept as the order of its points.  A round sends the codebooks to every block (their size is
fixed by ``ENTRIES`` and the vector width) and walks two trees together, the points' and the entries':

* the smallest and largest squared distances between the boxes of a pair of nodes bound all distances between them; an
  entry node whose smallest is above the least of the largest ones can't hold the nearest entry of any of the points;
* a point node that keeps one entry is assigned whole, by its cached sum and count;
* the points of a leaf that keeps several are compared with those alone, in integers; ties take the lower index.

A task returns sums and counts per entry; Spark adds them up, so that the driver sees ENTRIES * width numbers a round,
whatever the number of rows.  Bounds are exact integers: the codes equal those of an exhaustive search.

Defined cases: rows whose vector is null, empty, or holds null or non-finite components are dropped.  Seeds are taken
by vec_id, null vec_ids last, repeated vec_ids by their components.  Fewer rows than ENTRIES give as many entries as
rows.  Repeated rows are encoded each.  Errors are summed over equal labels, null labels together.  An empty table
gives no rows.  A width that differs between rows or can't be cut into equal parts, and a component of 65,536 or more
(its squared distances could leave 64 bits), are errors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aurum.llm.common import written

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
#: points of a leaf, and numbers in a block
LEAF = 32
BLOCK_NUMBERS = 1 << 19
#: labels are joined by label and this many salts, so that a hot label is several tasks
SALTS = 16
LIMIT = 1 << 26

BLOCK = T.StructType([T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("labels", T.ArrayType(T.LongType())),
                      T.StructField("order", T.BinaryType()), T.StructField("points", T.BinaryType())])


class Tree:
    """A balanced tree over rows of integers: level l cuts the ordered rows into 2**l runs."""

    def __init__(self, points: np.ndarray, levels: int, order: np.ndarray | None = None):
        n = len(points)
        cuts = [np.array([0, n])]
        for _ in range(levels):
            c = cuts[-1]
            cuts.append(np.sort(np.concatenate([c, (c[:-1] + c[1:]) // 2])))
        self.cuts = cuts
        if order is None:
            order = np.arange(n)
            for level in range(levels):
                for a, b in zip(cuts[level][:-1], cuts[level][1:]):
                    run = points[order[a:b]]
                    widest = int(np.argmax(run.max(0) - run.min(0))) if b > a else 0
                    order[a:b] = order[a:b][np.argsort(run[:, widest], kind="stable")]
            points = points[order]
        self.order, self.points = order, points

    def boxes(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        starts = self.cuts[level][:-1]
        return np.minimum.reduceat(self.points, starts), np.maximum.reduceat(self.points, starts)


def levels_for(n: int, leaf: int) -> int:
    """Halvings after which every run still has ``leaf`` rows or more (none for fewer than two leaves)."""
    return max(0, (max(1, n) // leaf).bit_length() - 1)


def _pruned(keep: np.ndarray, a: tuple, b: tuple) -> np.ndarray:
    """The pairs of boxes that may hold a nearest entry: smallest distance not above the least largest distance."""
    low_a, high_a, low_b, high_b = a[0][:, None], a[1][:, None], b[0][None], b[1][None]
    to, fro = low_b - high_a, low_a - high_b
    gap = np.maximum(np.maximum(to, fro), 0)
    least = np.einsum("ijk,ijk->ij", gap, gap)
    span = np.maximum(np.abs(high_b - low_a), np.abs(high_a - low_b))
    most = np.where(keep, np.einsum("ijk,ijk->ij", span, span), np.iinfo(np.int64).max)
    return keep & (least <= most.min(1)[:, None])


def assigned(points: Tree, entries: Tree) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(label of each ordered point, sums per entry, counts per entry)."""
    n, width = points.points.shape
    k = len(entries.points)
    labels = np.empty(n, np.int64)
    sums, counts = np.zeros((k, width), np.int64), np.zeros(k, np.int64)
    running = np.concatenate([np.zeros((1, width), np.int64), np.cumsum(points.points, 0, dtype=np.int64)])
    last, e_last = len(points.cuts) - 1, len(entries.cuts) - 1
    nodes, keep, e_level = np.array([0]), np.ones((1, len(entries.cuts[0]) - 1), bool), 0
    for level in range(last + 1):
        low, high = points.boxes(level)
        box = low[nodes], high[nodes]
        for _ in range(2 if level < last else e_last):
            if e_level == e_last:
                break
            e_level += 1
            keep = _pruned(np.repeat(keep, 2, 1), box, entries.boxes(e_level))
        if e_level == e_last:  # leaves of the entries' tree are single entries
            keep = _pruned(keep, box, entries.boxes(e_last))
            sole = keep.sum(1) == 1
            cuts = points.cuts[level]
            for node, row in zip(nodes[sole], keep[sole]):
                a, b = cuts[node], cuts[node + 1]
                label = entries.order[row.argmax()]
                labels[a:b] = label
                sums[label] += running[b] - running[a]
                counts[label] += b - a
            nodes, keep = nodes[~sole], keep[~sole]
        if not len(nodes):
            return labels, sums, counts
        if level < last:
            nodes, keep = np.stack([2 * nodes, 2 * nodes + 1], 1).ravel(), np.repeat(keep, 2, 0)
    unsure = []
    for node, row in zip(nodes, keep):
        a, b = points.cuts[last][node], points.cuts[last][node + 1]
        # entries in ascending index, so that the first smallest distance has the lowest
        of = np.sort(entries.order[row])
        c = entries.original[of]
        distance = (c * c).sum(1) - 2 * (points.points[a:b] @ c.T)
        labels[a:b] = of[distance.argmin(1)]
        unsure.append(np.arange(a, b))
    at = np.concatenate(unsure)
    counts += np.bincount(labels[at], minlength=k)
    for j in range(width):  # below 2**53: exact in doubles
        sums[:, j] += np.bincount(labels[at], points.points[at, j], k).astype(np.int64)
    return labels, sums, counts


def entry_tree(entries: np.ndarray) -> Tree:
    """The tree over a codebook, cut down to single entries (entries repeat up to a power of two)."""
    k = len(entries)
    levels = (k - 1).bit_length()
    padded = np.concatenate([np.arange(k), np.full((1 << levels) - k, k - 1)])
    tree = Tree(entries[padded], levels)
    tree.order = padded[tree.order]
    if len(padded) > k:  # the copies that fill the last level are no candidates of their own
        _, first = np.unique(tree.order, return_index=True)
        first.sort()
        tree.order, tree.points = tree.order[first], tree.points[first]
        tree.cuts = [np.arange(k + 1)]
    tree.original = entries
    return tree


def _integers(column: pa.Array, width: int) -> np.ndarray:
    lengths = np.diff(column.offsets.to_numpy())
    if (lengths != width).any():
        raise ValueError(f"vectors of {sorted({width, *lengths.tolist()})[:3]} components: all must have one width")
    x = np.floor(column.flatten().to_numpy(zero_copy_only=False) * float(SCALE))
    if (np.abs(x) >= LIMIT).any():
        raise ValueError(f"a component is {LIMIT // SCALE} or more")
    return x.astype(np.int64).reshape(-1, width)


def _blocks(width: int):
    """Packs rows into blocks with their trees' orders."""
    w, size = width // PARTS, max(LEAF, BLOCK_NUMBERS // width)

    def block(ids: list, labels: list, rows: np.ndarray) -> pa.RecordBatch:
        order, points = [], []
        for p in range(PARTS):
            tree = Tree(rows[:, p * w:(p + 1) * w], levels_for(len(rows), LEAF))
            order.append(tree.order.astype(np.int32))
            points.append(tree.points.astype(np.int32))
        return pa.RecordBatch.from_arrays(
            [pa.array([ids], pa.list_(pa.int64())), pa.array([labels], pa.list_(pa.int64())),
             pa.array([np.stack(order).tobytes()], pa.binary()), pa.array([np.stack(points).tobytes()], pa.binary())],
            names=BLOCK.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, rows = [], [], []
        for batch in batches:
            for start in range(0, batch.num_rows, size):
                part = batch.slice(start, size)
                ids += part.column(0).to_pylist()
                labels += part.column(1).to_pylist()
                rows.append(_integers(part.column(2), width))
                if len(ids) >= size:
                    held = np.concatenate(rows)
                    yield block(ids[:size], labels[:size], held[:size])
                    ids, labels, rows = ids[size:], labels[size:], [held[size:]]
        if ids:
            yield block(ids, labels, np.concatenate(rows))

    return run


def _trees(row: dict, width: int) -> list[Tree]:
    n, w = len(row["ids"]), width // PARTS
    order = np.frombuffer(row["order"], np.int32).reshape(PARTS, n)
    points = np.frombuffer(row["points"], np.int32).reshape(PARTS, n, w)
    return [Tree(points[p].astype(np.int64), levels_for(n, LEAF), order[p]) for p in range(PARTS)]


def _totals(books: np.ndarray, width: int):
    """Per task: (cell, total), a cell being a part, an entry and a component, or its count in the last place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = [entry_tree(b) for b in books]
        totals = np.zeros((PARTS, books.shape[1], width // PARTS + 1), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                for p, tree in enumerate(_trees(row, width)):
                    _, sums, counts = assigned(tree, entries[p])
                    totals[p, :, :-1] += sums
                    totals[p, :, -1] += counts
        flat = totals.ravel()
        cells = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(flat[cells])], names=["cell", "total"])

    return run


def _codes(books: np.ndarray, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = [entry_tree(b) for b in books]
        for batch in batches:
            for row in batch.to_pylist():
                n = len(row["ids"])
                codes, error = np.empty((n, PARTS), np.uint8), np.zeros(n, np.int64)
                for p, tree in enumerate(_trees(row, width)):
                    labels, _, _ = assigned(tree, entries[p])
                    off = tree.points - books[p][labels]
                    codes[tree.order, p] = labels
                    error[tree.order] += (off * off).sum(1)
                text = codes.tobytes().hex()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["ids"], pa.int64()), pa.array(row["labels"], pa.int64()),
                     pa.array([text[2 * PARTS * i:2 * PARTS * (i + 1)] for i in range(n)]), pa.array(error)],
                    names=["vec_id", "label", "code", "error"])

    return run


def kept_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, label, v): the rows with a vector of finite components."""
    v = F.col("embedding").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (embeddings.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & F.coalesce(finite, F.lit(False)))
            .select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), v.alias("v")))


def train(blocks: DataFrame, books: np.ndarray, width: int, rounds: int = ROUNDS) -> np.ndarray:
    """The codebooks after ``rounds`` rounds; an entry without parts stays."""
    for _ in range(rounds):
        sums = (blocks.mapInArrow(_totals(books, width), "cell long, total long")
                .groupBy("cell").agg(F.sum("total").alias("total")).toPandas())  # at most ENTRIES * (width + PARTS) rows
        totals = np.zeros((PARTS, books.shape[1], width // PARTS + 1), np.int64)
        totals.ravel()[sums["cell"].to_numpy(np.int64)] = sums["total"].to_numpy(np.int64)
        counts = totals[:, :, -1:]
        books = np.where(counts > 0, totals[:, :, :-1] // np.maximum(counts, 1), books)
    return books


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compressed(embeddings: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, label, code, error), codebooks as parts x entries x components) of every kept vector."""
    if entries > 256:
        raise ValueError("a code byte tells 256 entries apart")
    kept = kept_vectors(embeddings)
    seeds = kept.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    schema = "vec_id long, label long, code string, error long"
    if not seeds:
        return embeddings.sparkSession.createDataFrame([], schema), np.empty((PARTS, 0, 0), np.int64)
    width = len(seeds[0].v)
    if width % PARTS:
        raise ValueError(f"{width} components can't be cut into {PARTS} equal parts")
    first = _integers(pa.array([r.v for r in seeds], pa.list_(pa.float64())), width)
    books = np.ascontiguousarray(first.reshape(len(first), PARTS, width // PARTS).transpose(1, 0, 2))
    blocks = written(kept.mapInArrow(_blocks(width), BLOCK), "dual-tree-blocks")
    books = train(blocks, books, width, rounds)
    return blocks.mapInArrow(_codes(books, width), schema), books


def code_digests(embeddings: DataFrame) -> DataFrame:
    """Per kept vector: code, error, the error of all vectors of its label, and the digest of the codebooks."""
    codes, books = compressed(embeddings)
    codes = written(codes, "dual-tree-codes")
    by_label = (codes.groupBy("label").agg(F.sum("error").alias("label_error"))
                .select(F.col("label").alias("of_label"), "label_error", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("of_salt")))
    salted = codes.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int"))
    return (salted.join(by_label, F.col("label").eqNullSafe(F.col("of_label")) & (F.col("salt") == F.col("of_salt")))
            .select("vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256")))
