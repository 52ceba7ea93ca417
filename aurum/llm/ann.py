"""Approximate nearest neighbours by learned partitions.

Fit, on a bounded sample (``fit_rows``): a k-nearest-neighbour graph; a balanced partitioning of that graph
(recursive bisection, each by a few rounds of moving vertices to the side with more of their neighbours
while both sides stay equal); a small neural classifier that learns each vector's part from the vector.
The number of parts to probe is calibrated on the sample: the smallest that finds ``TARGET`` of the true neighbours.

Index: every vector goes to the classifier's most probable part.  Search: every query goes to its most
probable part, whose k-th best score is the floor for the query's other probable parts: these send only
what reaches it.  A part is searched in chunks of bounded size with exact inner products, and the
best of all chunks are merged.  Products are summed component by component in double precision, so
that equal vectors have equal scores wherever they lie.

Defined cases: vectors that are null, zero, or hold null or non-finite components take no part, nor do those whose
dimension isn't the most common one; fewer candidates than ``k`` are all returned; ties go to the smaller
vec_id; rows with a null vec_id take no part; rows that repeat a vec_id are candidates each, also
of one another, and queries each (20 results a row); an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from aurum.llm.common import written

K = 20
FIT_ROWS = 8_000
PART_ROWS = 128
MAX_PARTS = 256
TARGET = 0.96
CHUNK = 4_000
QUERIES_AT_ONCE = 256


def products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """All inner products in double precision, each summed in the order of the components."""
    out = np.zeros((len(queries), len(vectors)))
    columns = np.ascontiguousarray(vectors.T)
    for j in range(queries.shape[1]):
        out += queries[:, j, None] * columns[j]
    return out


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """For each vector its k nearest others (inner product), in blocks."""
    out = np.empty((len(x), k), np.int64)
    for a in range(0, len(x), 1000):
        s = x[a:a + 1000] @ x.T
        s[np.arange(len(s)), np.arange(a, a + len(s))] = -np.inf
        out[a:a + 1000] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 12) -> np.ndarray:
    """A part for each vertex, equal in size up to rounding; ``parts`` is a power of two."""
    label = np.zeros(len(x), np.int64)
    rng = np.random.default_rng(7)
    sides = 1
    while sides < parts:
        new = label * 2
        for p in range(sides):
            own = np.flatnonzero(label == p)
            if len(own) < 2:
                continue
            place = np.full(len(x), -1)
            place[own] = np.arange(len(own))
            near = place[graph[own]]
            # start from the main direction of the part, then follow the edges
            start = x[own] - x[own].mean(0)
            way = rng.standard_normal(x.shape[1])
            for _ in range(10):
                way = start.T @ (start @ way)
                way /= np.linalg.norm(way) + 1e-12
            pull = start @ way
            for _ in range(rounds):
                side = np.zeros(len(own))
                side[np.argsort(-pull, kind="stable")[:len(own) // 2]] = 1
                votes = np.where(near >= 0, np.where(side[near] > 0, 1.0, -1.0), 0.0)
                back = np.zeros(len(own))
                inside = near >= 0
                np.add.at(back, near[inside], np.repeat(2 * side - 1, inside.sum(1)))
                pull = votes.sum(1) + back + 0.5 * (2 * side - 1) + 1e-3 * (start @ way)
            new[own[np.argsort(-pull, kind="stable")[:len(own) // 2]]] += 1
        label, sides = new, sides * 2
    return label


@dataclass
class Router:
    """A network with one hidden layer: the probability of each part."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    probes: int

    @property
    def parts(self) -> int:
        return len(self.b2)

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2


def train_router(x: np.ndarray, y: np.ndarray, graph: np.ndarray, parts: int, hidden: int = 96, epochs: int = 30) -> Router:
    """Adam on the cross-entropy to the parts of a vector and of its neighbours."""
    rng = np.random.default_rng(11)
    target = np.zeros((len(x), parts))
    np.add.at(target, (np.arange(len(x)), y), 1.0)
    for c in graph.T:
        np.add.at(target, (np.arange(len(x)), y[c]), 1.0 / graph.shape[1])
    target /= target.sum(1, keepdims=True)
    p = [rng.standard_normal((x.shape[1], hidden)) * np.sqrt(2 / x.shape[1]), np.zeros(hidden),
         rng.standard_normal((hidden, parts)) * np.sqrt(1 / hidden), np.zeros(parts)]
    m, v, t = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    for epoch in range(epochs):
        rate = 0.003 * (1 - epoch / epochs)
        for rows in np.array_split(rng.permutation(len(x)), max(1, len(x) // 256)):
            h = np.maximum(x[rows] @ p[0] + p[1], 0)
            z = h @ p[2] + p[3]
            z = np.exp(z - z.max(1, keepdims=True))
            g = (z / z.sum(1, keepdims=True) - target[rows]) / len(rows)
            gh = (g @ p[2].T) * (h > 0)
            t += 1
            for k, grad in enumerate((x[rows].T @ gh, gh.sum(0), h.T @ g, g.sum(0))):
                m[k] = 0.9 * m[k] + 0.1 * grad
                v[k] = 0.999 * v[k] + 0.001 * grad**2
                p[k] -= rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
    return Router(*p, probes=parts)


def calibrated(router: Router, x: np.ndarray, graph: np.ndarray, target: float) -> Router:
    """With the fewest probes that find ``target`` of the sample's true neighbours."""
    logits = router.logits(x)
    own = logits.argmax(1)
    rank = np.argsort(np.argsort(-logits, axis=1, kind="stable"), axis=1)
    needed = np.sort(np.take_along_axis(rank, own[graph], axis=1).ravel())
    router.probes = int(needed[min(len(needed) - 1, int(np.ceil(target * len(needed))))]) + 1 if len(needed) else router.parts
    return router


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) of the vectors that take part, as doubles."""
    v = F.col("embedding").cast("array<double>")
    good = vectors.select(F.col("vec_id").cast("long"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull()
        & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists("v", lambda c: c != 0))
    sizes = good.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return good.where(F.size("v") == (sizes[0]["d"] if sizes else 0))


def fit(good: DataFrame, n: int, *, fit_rows: int = FIT_ROWS, part_rows: int = PART_ROWS, k: int = K, target: float = TARGET) -> Router | None:
    rows = good.orderBy(F.xxhash64("vec_id"), "vec_id").limit(fit_rows).select("v").collect()  # fit_rows bounds it
    x = np.array([r["v"] for r in rows])
    parts = 1
    while parts * part_rows < n and parts < MAX_PARTS and parts * 64 <= len(x):
        parts *= 2
    if parts == 1:
        return None
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph = neighbour_graph(x, min(k, len(x) - 1))
    router = train_router(x, balanced_parts(x, graph, parts), graph, parts)
    return calibrated(router, x, graph, target)


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def _routed(router: Router | None, probes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch["v"])
            if router is None:
                parts = np.zeros((len(x), 1), np.int64)
            else:
                logits = router.logits(x / np.linalg.norm(x, axis=1, keepdims=True))
                parts = np.argsort(-logits, axis=1, kind="stable")[:, :probes]
            yield pa.RecordBatch.from_arrays([batch["row"], batch["vec_id"], batch["v"], pa.array(parts.tolist(), pa.list_(pa.int32()))],
                                             names=["row", "vec_id", "v", "parts"])

    return run


_FOUND = "query long, vec_id long, score double"


def _searched(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        """The queries and the vectors of one chunk to the chunk's k best for each query, of those that reach its floor."""
        empty = pa.table({"query": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        if not left.num_rows or not right.num_rows:
            return empty
        ids, rows = right["vec_id"].to_numpy(), right["row"].to_numpy()
        order = np.argsort(ids, kind="stable")
        ids, rows, vectors = ids[order], rows[order], _matrix(right["v"])[order]
        query_rows, queries, floors, out = left["row"].to_numpy(), _matrix(left["v"]), left["floor"].to_numpy(), []
        for a in range(0, len(queries), QUERIES_AT_ONCE):
            own = query_rows[a:a + QUERIES_AT_ONCE]
            scores = products(queries[a:a + QUERIES_AT_ONCE], vectors)
            scores[own[:, None] == rows] = -np.inf  # the query's own row
            best = np.argsort(-scores, axis=1, kind="stable")[:, :k]  # vectors are in order of their ids: ties go right
            taken = np.take_along_axis(scores, best, axis=1)
            good = (taken > -np.inf) & (taken >= floors[a:a + QUERIES_AT_ONCE, None])
            out.append((np.repeat(own, good.sum(1)), ids[best][good], taken[good]))
        q, v, s = map(np.concatenate, zip(*out, strict=True))
        return pa.table({"query": q, "vec_id": v, "score": s})

    return run


def nearest(vectors: DataFrame, *, every: int = 20, k: int = K, fit_rows: int = FIT_ROWS, part_rows: int = PART_ROWS, target: float = TARGET) -> DataFrame:
    """query_id, rank, vec_id, score: for each vector whose id is divisible by ``every``, its k nearest others found."""
    good = written(usable(vectors).withColumn("row", F.monotonically_increasing_id()), "ann-vectors")
    n = good.count()
    router = fit(good, n, fit_rows=fit_rows, part_rows=part_rows, k=k, target=target) if n else None
    columns, routed = ["row", "vec_id", "v"], "row long, vec_id long, v array<double>, parts array<int>"
    index = written(good.select(*columns).mapInArrow(_routed(router, 1), routed).select(*columns, F.col("parts")[0].alias("part")), "ann-index")
    # a large part is searched in chunks, each with all of its queries
    chunks = index.groupBy("part").agg(F.ceil(F.count("*") / CHUNK).alias("chunks"))
    located = index.join(F.broadcast(chunks), "part").withColumn("chunk", F.pmod(F.xxhash64("vec_id"), "chunks"))  # at most MAX_PARTS rows
    located = located.select(*columns, "part", "chunk").groupBy("part", "chunk")
    asked = written(good.where(F.col("vec_id") % every == 0).select(*columns).mapInArrow(_routed(router, router.probes if router else 1), routed), "ann-queries")

    def searched(queries: DataFrame) -> DataFrame:
        """(query, vec_id, score) of queries (row, v, floor, part)."""
        dealt = queries.join(F.broadcast(chunks), "part").withColumn("chunk", F.explode(F.expr("sequence(0L, chunks - 1)")))
        return dealt.select("row", "v", "floor", "part", "chunk").groupBy("part", "chunk").cogroup(located).applyInArrow(_searched(k), _FOUND)

    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    # the most probable part first: its k-th score is the floor for the other parts, which send only what reaches it
    first = searched(asked.select("row", "v", F.lit(float("-inf")).alias("floor"), F.col("parts")[0].alias("part")))
    first = written(first.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "ann-first")
    floors = first.where(F.col("rank") == k).select(F.col("query").alias("row"), F.col("score").alias("floor"))
    others = asked.join(floors, "row", "left").select("row", "v", F.coalesce("floor", F.lit(float("-inf"))).alias("floor"),
                                                      F.explode(F.expr("slice(parts, 2, size(parts))")).alias("part"))
    found = first.drop("rank").unionByName(searched(others))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return (ranked.join(asked.select(F.col("row").alias("query"), F.col("vec_id").alias("query_id")), "query")
            .select("query_id", "rank", "vec_id", "score"))
