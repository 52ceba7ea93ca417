"""JSON documents as elements: whole, in parallel, and with everything that doesn't fit accounted for.

A season document is one JSON value of any size, ``{"players": [{..}, ..], "teams": [..]}`` or ``[{..}, ..]``.  Spark's
multi-line reader gives such a file to one task, keeps only the declared fields, and turns a cut file into no rows at
all.  ``read_elements`` instead gives every array element as its own JSON text:

1. The file is read by Spark's text reader, split at ``}``, so that it is dealt to tasks in byte ranges like any text.
2. A task summarises each of its byte ranges without knowing where in the document it starts: for a start outside
   and for one inside of a string, how many open containers it closes and which ones (with their keys) it leaves open.
   Summaries compose, so that folding one row per range, file by file, gives the open containers at every range's
   start, and for every file whether it is whole.
3. Each range is then walked from its known start; elements that lie in it come out as they are, and the pieces of
   those that cross ranges (two a range at most) are put together by a window over the pieces.

Nothing is collected: the driver sees no element, and a range's summary is a few names.  The texts are written once, to
the shared scratch folder; what is rejected goes to its own table, with a reason:

* ``empty document``, ``truncated document``, ``unbalanced document``: the file, with each element found in it (they
  are not delivered: a cut document must not replace a whole one);
* ``malformed element``: an element of a whole document that isn't a JSON object by itself.

A key that a document lacks, and an empty or null array, give no rows and no reject.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aurum.session import materialized, path_exists, ready_workers

ROOT = ""   # the array key of a document that is an array itself
ELEMENTS = "source_file string, array_key string, raw string"
REJECTS = "source_file string, array_key string, raw string, reason string"

_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*+"|["\[\]{}:]', re.DOTALL)
_STRING_END = re.compile(r'(?:[^"\\]|\\.)*+"', re.DOTALL)
_CLOSES = {"}": "{", "]": "["}


class Walk:
    """Follows a document's brackets and strings over fragments of text.

    ``opened`` holds the containers opened here and still open, as [bracket, key]; ``closed`` the brackets of containers
    that were open before the start and end here, innermost first; ``broken`` is set when brackets don't match.
    """

    def __init__(self, inside: bool, opened: list | None = None):
        self.inside, self.opened, self.closed, self.broken = inside, list(opened or []), "", False
        self.key: str | None = None
        self.string: str | None = None

    def brackets(self, text: str) -> Iterator[tuple[int, str]]:
        """(offset, bracket) of each structural bracket of ``text``, before it takes effect."""
        at = 0
        if self.inside:
            end = _STRING_END.match(text)
            if end is None:
                return
            at, self.inside, self.string = end.end(), False, None
        while True:
            match = _TOKEN.search(text, at)
            if match is None:
                return
            token, at = match.group(), match.end()
            if token in "{[":
                yield match.start(), token
                self.opened.append([token, self.key])
                self.key = None
            elif token in "}]":
                yield match.start(), token
                if not self.opened:
                    self.closed += token
                elif self.opened.pop()[0] != _CLOSES[token]:
                    self.broken = True
                self.key = None
            elif token == ":":
                self.key = self.string
            elif token == '"':
                self.inside = True
                return
            else:
                self.string = token[1:-1]

    def run(self, text: str) -> None:
        for _ in self.brackets(text):
            pass


def _fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], list[str], pa.RecordBatch]]:
    """((file, range start), fragments, batch) for runs of rows of one range, in order."""
    for batch in batches:
        if not batch.num_rows:
            continue
        files, starts = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        texts = batch.column(0).to_pylist()
        a = 0
        for k in range(1, len(texts) + 1):
            if k == len(texts) or starts[k] != starts[a] or files[k] != files[a]:
                yield (files[a], starts[a]), texts[a:k], batch.slice(a, k - a)
                a = k


def _summarised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per byte range: its size, and its summaries for a start outside and inside of a string.

    The reader drops the ``}`` that ends a fragment; that of the range's last one is left to the fold, which knows
    whether the file goes on."""
    place, walks, size, n = None, [], 0, 0

    def row() -> pa.RecordBatch:
        found = [json.dumps([w.inside, w.closed, w.opened, w.broken]) for w in walks]
        return pa.RecordBatch.from_arrays([pa.array([place[0]]), pa.array([place[1]]), pa.array([n]), pa.array([size]),
                                           pa.array([found[0]]), pa.array([found[1]])], names=_SUMMARY.names)

    for here, texts, _ in _fragments(batches):
        if here != place:
            if place is not None:
                yield row()
            place, walks, size, n = here, [Walk(False), Walk(True)], 0, 0
        for text in texts:
            for walk in walks:
                if n:
                    walk.run("}")
                walk.run(text)
            n += 1
            size += len(text.encode())
    if place is not None:
        yield row()


_SUMMARY = T.StructType([T.StructField("file", T.StringType()), T.StructField("start", T.LongType()), T.StructField("n", T.LongType()),
                         T.StructField("size", T.LongType()), T.StructField("outside", T.StringType()), T.StructField("inside", T.StringType())])
_STATES = "file string, start long, state string, closing boolean, reason string"


def _folded(table: pa.Table) -> pa.Table:
    """The summaries of one file -> the state at each range's start, and what is wrong with the document (or null)."""
    rows = sorted(table.to_pylist(), key=lambda r: r["start"])
    inside, stack, broken, out = False, [], False, []

    def close(bracket: str) -> None:
        nonlocal broken
        if not stack or stack.pop()[0] != _CLOSES[bracket]:
            broken = True

    total, fragments = sum(r["size"] for r in rows), sum(r["n"] for r in rows)
    for k, r in enumerate(rows):
        state = json.dumps([inside, stack])
        inside, closed, opened, bad = json.loads(r["inside" if inside else "outside"])
        broken |= bad
        for bracket in closed:
            close(bracket)
        stack += opened
        last = k == len(rows) - 1
        # the file's last fragment ended with a bracket if the bytes say so, or (compressed files) if that balances it
        by_size = {total + fragments: True, total + fragments - 1: False}.get(r["file_size"])
        closing = not last or (by_size if by_size is not None else len(stack) == 1 and stack[0][0] == "{")
        out.append([r["file"], r["start"], state, closing])
        if closing and not inside:
            close("}")
    reason = "unbalanced document" if broken else "truncated document" if inside or stack else None
    cols = list(zip(*out))
    return pa.table({"file": cols[0], "start": pa.array(cols[1], pa.int64()), "state": cols[2], "closing": cols[3],
                     "reason": pa.array([reason] * len(out), pa.string())})


_PIECES = "file string, array_key string, start long, place long, kind string, raw string, reason string"


def _walked(keys: Sequence[str]):
    """Fragments with the state of their range -> elements of the arrays under ``keys``, whole or in pieces."""
    wanted = frozenset(keys)

    def array_at(stack: list, depth: int) -> str | None:
        """The key of the wanted array that the first ``depth`` open containers are, if any."""
        if depth == 1 and stack[0][0] == "[" and ROOT in wanted:
            return ROOT
        if depth == 2 and stack[0][0] == "{" and stack[1][0] == "[" and stack[1][1] in wanted:
            return stack[1][1]
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, walk, key, parts, begun, out, number, first = None, None, None, [], False, [], 0, True

        def emit(kind: str) -> None:
            nonlocal number, parts
            out.append([place[0], key, place[1], number, kind, "".join(parts), reason])
            number += 1
            parts = []

        def walk_text(text: str) -> None:
            nonlocal key, parts, begun
            taken = 0  # the part of the text that is already in ``parts``
            for at, bracket in walk.brackets(text):
                depth = len(walk.opened)
                if bracket == "{" and key is None:
                    found = array_at(walk.opened, depth) if depth in (1, 2) else None
                    if found is not None:
                        key, parts, begun, taken = found, [], True, at
                elif bracket == "}" and key is not None and array_at(walk.opened, depth - 1) is not None:
                    parts.append(text[taken:at + 1])
                    emit("whole" if begun else "head")
                    key, begun = None, False
            if key is not None:
                parts.append(text[taken:])

        def finish() -> None:
            if walk is not None:
                if closing:
                    walk_text("}")
                if key is not None:
                    emit("tail" if begun else "middle")

        def batch_of() -> pa.RecordBatch:
            cols = list(zip(*out))
            return pa.RecordBatch.from_arrays([pa.array(cols[0]), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int64()),
                                               pa.array(cols[3], pa.int64()), pa.array(cols[4]), pa.array(cols[5]),
                                               pa.array(cols[6], pa.string())], names=[c.split()[0] for c in _PIECES.split(", ")])

        reason, closing = None, False
        for here, texts, batch in _fragments(batches):
            if here != place:
                finish()
                place, number, first, parts, begun = here, 0, True, [], False
                inside, stack = json.loads(batch.column(3)[0].as_py())
                closing, reason = batch.column(4)[0].as_py(), batch.column(5)[0].as_py()
                walk = Walk(inside, stack)
                # an element that an earlier range began
                key = next((array_at(stack, d) for d in (1, 2) if len(stack) > d and stack[d][0] == "{" and array_at(stack, d) is not None), None)
            for text in texts:
                if not first:
                    walk_text("}")
                first = False
                walk_text(text)
            if sum(len(o[5]) for o in out[-64:]) > 1 << 20 or len(out) >= 4096:
                yield batch_of()
                out = []
        finish()
        if out:
            yield batch_of()

    return run


@dataclass
class Documents:
    """``elements`` (source_file, array_key, raw) and ``rejects`` (the same, with a reason)."""
    elements: DataFrame
    rejects: DataFrame


def line(raw: Column) -> Column:
    """JSON text on one line: line breaks within JSON lie between tokens."""
    return F.regexp_replace(raw, r"[\r\n]+", " ")


def object_variant(raw: Column) -> Column:
    """The JSON object as VARIANT; NULL for text that isn't one."""
    parsed = F.try_parse_json(raw)
    # JSON that begins with a brace is an object; only other text (with leading blanks, say) needs its kind looked up
    return F.when(raw.startswith("{") | F.schema_of_variant(parsed).startswith("OBJECT"), parsed)


def read_elements(spark: SparkSession, path: str | list[str], keys: Sequence[str] = (ROOT,)) -> Documents:
    """The elements of the arrays under ``keys`` (``ROOT``: of a document that is an array) of all documents at ``path``."""
    path = [p for p in ([path] if isinstance(path, str) else path) if path_exists(spark, p)]
    if not path:
        return Documents(spark.createDataFrame([], ELEMENTS), spark.createDataFrame([], REJECTS))
    ready_workers(spark)
    text = spark.read.option("lineSep", "}").text(path)
    where = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")]
    sizes = spark.read.format("binaryFile").load(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("file_size"))
    summaries = text.select("value", *where).mapInArrow(_summarised, _SUMMARY)
    # one row per byte range; a file's ranges are folded in one task
    states = materialized(sizes.join(summaries, "file").groupBy("file").applyInArrow(_folded, _STATES), "document-states")
    # as many rows as the scan has byte ranges, which the driver plans one by one itself
    known = text.select("value", *where).join(F.broadcast(states), ["file", "start"]).select(
        "value", "file", "start", "state", "closing", "reason")
    found = materialized(known.mapInArrow(_walked(keys), _PIECES), "document-elements")
    pieces = found.where(F.col("kind") != "whole")
    order = Window.partitionBy("file").orderBy("start", "place").rowsBetween(Window.unboundedPreceding, 0)
    joined = (pieces.withColumn("element", F.sum((F.col("kind") == "tail").cast("long")).over(order))
              .groupBy("file", "array_key", "reason", "element")
              .agg(F.sort_array(F.collect_list(F.struct("start", "place", "raw"))).alias("p"))
              .select("file", "array_key", F.array_join(F.transform("p", lambda p: p["raw"]), "").alias("raw"), "reason"))
    whole = found.where(F.col("kind") == "whole").select("file", "array_key", "raw", "reason")
    rows = whole.unionByName(joined).select(
        F.col("file").alias("source_file"), "array_key", line(F.col("raw")).alias("raw"),
        F.coalesce("reason", F.when(object_variant(F.col("raw")).isNull(), F.lit("malformed element"))).alias("reason"))
    rows = materialized(rows, "document-rows")
    bad = states.where(F.col("reason").isNotNull()).select(F.col("file").alias("source_file"), "reason").distinct()
    # files without a fragment: the scan's own listing of files against those that gave rows
    plain = F.regexp_replace("file", "^([a-zA-Z0-9]+):/+", "$1:/")  # the listing and the rows write a scheme differently
    listed = spark.createDataFrame([(f,) for f in text.inputFiles()], "file string").select("file", plain.alias("p"))
    empty = listed.join(states.select(plain.alias("p")).distinct(), "p", "left_anti").select(
        F.col("file").alias("source_file"), F.lit("empty document").alias("reason"))
    nothing = F.lit(None).cast("string")
    documents = bad.unionByName(empty).select("source_file", nothing.alias("array_key"), nothing.alias("raw"), "reason")
    return Documents(rows.where(F.col("reason").isNull()).drop("reason"), documents.unionByName(rows.where(F.col("reason").isNotNull())))
