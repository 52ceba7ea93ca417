"""Conversation prefix trie: burst tries over turn ids, swept into nodes.

A turn's id is a digest of its role and text, so a conversation is a string of ids.  Equal conversations are folded
first (a copied one is a single string with a count), then the strings are dealt to containers, one per trie head:

* all strings start in the container of the root;
* a container of more than ``CAPACITY`` strings bursts: its head becomes a trie node of its own, and each string moves
  on to the container of its next turn id.  Rounds go on, with the moved strings alone, until none is oversized.  A
  round has at most ``MAX_HEADS`` bursting heads (the capacity grows with the table beyond that), which bounds the
  broadcasts;
* the remaining containers are dealt to tasks, sorted, and swept: successive strings share a prefix, so that a stack
  of open nodes gives every node once, with the totals of its subtree;
* the totals of burst heads are grouped sums of their children's, from the deepest round up.

The digest of the conversations that end at a node needs their ids in numeric order.  A range sort of (string, id)
deals a hot string to many tasks, each joins its run of ids to pieces of text, and the pieces of a string are hashed in
order; no list of ids is ever held.

Defined cases: rows with a null conv_id belong to no conversation.  Null role or text is empty.  Equal turns (and null
ones, which come first) follow role, then the digest of role and text; repeated rows are turns each.  Remainders of
negative conv_ids are those of SQL (towards zero).  An empty table has no nodes.  One conversation travels as one row of
20 bytes a turn, so it may have up to some 100 million turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aurum.llm.common import written

GROUP = 100       # conversations that share the start of one
MOST_SHARED = 6   # shared turns are crc32 modulo this
ID = 16           # bytes of a turn id
CAPACITY = 512
MAX_HEADS = 1 << 16
#: conv_ids joined to one piece of text
PIECE = 4096
NO_ENDS = hashlib.sha256(b"").hexdigest()

TOTALS = "conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
NODES = f"head binary, parent_head binary, top boolean, depth long, parent_conv_id long, {TOTALS}"
RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def _digest(x: Column) -> Column:
    return F.substring(F.sha2(x, 256), 1, 2 * ID)


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns: array of (t, n)): the shared start, then the conversation's own turns after it."""
    c, role, text = F.col("conv_id").cast("long"), F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turn = F.struct(F.col("turn").alias("turn"), role.alias("role"),
                    _digest(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("t"),
                    F.char_length(text).alias("n"))
    rows = conversations.where(F.col("conv_id").isNotNull()).select((c - c % GROUP).alias("base"), c.alias("conv_id"), turn.alias("x"))
    # dealt by the conversation whose start is shared, so that grouping and join need no other shuffle
    own = rows.repartition("base").groupBy("base", "conv_id").agg(F.sort_array(F.collect_list("x")).alias("x")).select(
        "base", "conv_id", F.transform("x", lambda x: F.struct(x["t"].alias("t"), x["n"].alias("n"))).alias("own"))
    starts = own.where(F.col("conv_id") == F.col("base")).select("base", F.slice("own", 1, MOST_SHARED).alias("start"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_SHARED).cast("int")
    none = F.slice("own", 1, 0)
    turns = F.concat(F.coalesce(F.slice("start", 1, h), none),
                     F.when(F.size("own") > h, F.slice("own", h + 1, F.size("own"))).otherwise(none))
    return own.join(starts, "base", "left").select("conv_id", turns.alias("turns"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (key, conv_id) -> (key, first id, number, ids as text) of at most PIECE ids each."""
    def out(key: bytes, ids: list[int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([ids[0]]), pa.array([len(ids)]),
                                           pa.array([",".join(map(str, ids))])], names=["key", "first", "n", "ids"])
    key, ids = None, []
    for batch in batches:
        rows: list[pa.RecordBatch] = []
        for k, i in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if ids and (k != key or len(ids) >= PIECE):
                rows.append(out(key, ids))
                ids = []
            key = k
            ids.append(i)
        if rows:
            yield pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
    if ids:
        yield out(key, ids)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by (key, first id) -> one row per key, hashed piece after piece."""
    key, first, n, state = None, 0, 0, None
    for batch in batches:
        done: list[tuple] = []
        for k, f, m, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if k != key:
                if state is not None:
                    done.append((key, first, n, state.hexdigest()))
                key, first, n, state = k, f, 0, hashlib.sha256()
            state.update(("," if n else "").encode() + ids.encode())
            n += m
        if done:
            yield _hashed_rows(done)
    if state is not None:
        yield _hashed_rows([(key, first, n, state.hexdigest())])


def _hashed_rows(rows: list[tuple]) -> pa.RecordBatch:
    k, f, n, s = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(k, pa.binary()), pa.array(f, pa.int64()), pa.array(n, pa.int64()), pa.array(s)],
                                      names=["key", "first", "n", "ends"])


def strings(conversations: DataFrame) -> DataFrame:
    """Distinct rebuilt conversations: seq (ids end to end), chars, n copies, first conv_id, ends (their digest)."""
    ids = F.unhex(F.array_join(F.transform("turns", lambda x: x["t"]), ""))
    own = rebuilt(conversations).select("conv_id", ids.alias("seq"), F.transform("turns", lambda x: x["n"]).alias("chars"))
    own = written(own.withColumn("key", F.unhex(_digest(F.col("seq")))), "trie-strings")
    ends = (own.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
            .mapInArrow(_pieces, "key binary, first long, n long, ids string")
            .repartition("key").sortWithinPartitions("key", "first")
            .mapInArrow(_hashed, "key binary, first long, n long, ends string"))
    return own.select("key", "seq", "chars").distinct().join(ends, "key").drop("key")


def _head(depth: int) -> Column:
    return F.unhex(_digest(F.substring("seq", 1, ID * depth)))


def burst(table: DataFrame, capacity: int = CAPACITY) -> tuple[list[DataFrame], list[DataFrame], list[DataFrame]]:
    """(container rows by round, burst heads by depth, the strings that end at them by depth)."""
    settled, heads, ended = [], [], []
    active, depth = table, 0
    while True:
        last = F.element_at("chars", depth) if depth else F.lit(0)
        at = active.select("*", _head(depth).alias("head"), (_head(depth - 1) if depth else F.lit(None).cast("binary")).alias("parent_head"),
                           F.lit(depth).alias("depth"), last.cast("long").alias("head_chars"))
        sizes = written(at.groupBy("head", "parent_head", "head_chars").agg(F.count(F.lit(1)).alias("size")), f"trie-sizes-{depth}")
        total, most = sizes.agg(F.sum("size"), F.max("size")).first()
        limit = max(capacity, (total or 0) // MAX_HEADS)
        if (most or 0) <= limit:
            return settled + [at], heads, ended
        big = sizes.where(F.col("size") > limit).drop("size")  # fewer than MAX_HEADS rows
        names = F.broadcast(big.select("head"))
        settled.append(at.join(names, "head", "left_anti"))
        moving = at.join(names, "head", "left_semi")
        heads.append(big)
        ended.append(moving.where(F.length("seq") == ID * depth).select("head", "n", "first", "ends"))
        active = written(moving.where(F.length("seq") > ID * depth).select(*table.columns), f"trie-moved-{depth}")
        depth += 1


class _Open:
    """A node on the sweep's stack: the totals so far, and the finished children's places in the output."""

    __slots__ = ("depth", "chars", "conv", "n", "children", "leaves", "saved", "ends", "places")

    def __init__(self, depth: int, chars: int):
        self.depth, self.chars, self.conv, self.n = depth, chars, None, 0
        self.children, self.leaves, self.saved, self.ends, self.places = 0, 0, 0, NO_ENDS, []

    def add(self, conv: int, n: int) -> None:
        self.conv = conv if self.conv is None else min(self.conv, conv)
        self.n += n


def sweep_container(head: bytes, parent: bytes | None, depth: int, head_chars: int, rows: list[tuple]) -> list[list]:
    """The nodes of one container, from its strings in order: rows of NODES."""
    out: list[list] = []
    stack = [_Open(depth, head_chars)]
    before = b""

    def close() -> None:
        node = stack.pop()
        leaves, saved = node.leaves or 1, node.saved + (node.n - 1) * node.chars
        for place in node.places:
            out[place][4] = node.conv
        out.append([head, None if stack else parent, not stack, node.depth, None, node.conv, node.n, node.children, leaves, saved, node.ends])
        if stack:
            up = stack[-1]
            up.add(node.conv, node.n)
            up.children += 1
            up.leaves += leaves
            up.saved += saved
            up.places.append(len(out) - 1)

    for seq, chars, n, first, ends in rows:
        length, same = len(seq) // ID, depth
        while same < length and seq[ID * same:ID * same + ID] == before[ID * same:ID * same + ID]:
            same += 1
        while stack[-1].depth > same:
            close()
        for d in range(same + 1, length + 1):
            stack.append(_Open(d, chars[d - 1]))
        stack[-1].add(first, n)
        stack[-1].ends = ends
        before = seq
    while stack:
        close()
    return out


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.binary(), pa.binary(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    names = [c.split()[0] for c in NODES.split(", ")]

    def batch_of(rows: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    of, rows, done = None, [], []
    for batch in batches:
        for start in range(0, batch.num_rows, 1024):
            for head, parent, depth, head_chars, *string in zip(*(c.to_pylist() for c in batch.slice(start, 1024).columns)):
                if of is not None and head != of[0]:
                    done += sweep_container(*of, rows)
                    rows = []
                of = (head, parent, depth, head_chars)
                rows.append(tuple(string))
                if len(done) >= 8192:
                    yield batch_of(done)
                    done = []
    if of is not None:
        done += sweep_container(*of, rows)
    if done:
        yield batch_of(done)


def trie(conversations: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row per node of the prefix trie of the rebuilt conversations."""
    settled, heads, ended = burst(written(strings(conversations), "trie-distinct"), capacity)
    cols = ["head", "parent_head", "depth", "head_chars", "seq", "chars", "n", "first", "ends"]
    containers = settled[0].select(*cols)
    for more in settled[1:]:
        containers = containers.unionByName(more.select(*cols))
    nodes = containers.repartition("head").sortWithinPartitions("head", "seq").mapInArrow(_sweep, NODES)
    if not heads:
        return nodes.select(*RESULT)
    nodes = written(nodes, "trie-nodes")
    totals = ["head", "parent_head", "depth", *(c.split()[0] for c in TOTALS.split(", "))]
    found = nodes.where(~F.col("top")).select(*RESULT)
    below = None
    for depth in range(len(heads) - 1, -1, -1):
        children = nodes.where(F.col("top") & (F.col("depth") == depth + 1)).select(*totals)
        if below is not None:
            children = children.unionByName(below)
        sums = children.groupBy(F.col("parent_head").alias("head")).agg(
            F.min("conv_id").alias("low"), F.sum("n_convs").alias("n_below"), F.count(F.lit(1)).alias("n_children"),
            F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved"))
        n = F.col("n_below") + F.coalesce("n", F.lit(0))
        own = heads[depth].join(sums, "head").join(ended[depth], "head", "left").select(
            "head", "parent_head", F.lit(depth).cast("long").alias("depth"), F.least("low", "first").alias("conv_id"), n.alias("n_convs"),
            "n_children", "n_leaves", (F.col("saved") + (n - 1) * F.col("head_chars")).alias("saved_tokens"),
            F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"))
        own = written(own, f"trie-heads-{depth}")
        up = F.broadcast(own.select(F.col("head").alias("parent_head"), F.col("conv_id").alias("parent_conv_id")))  # < MAX_HEADS rows
        found = found.unionByName(children.join(up, "parent_head").select(*RESULT))
        below = own
    return found.unionByName(below.withColumn("parent_conv_id", F.lit(None).cast("long")).select(*RESULT))
