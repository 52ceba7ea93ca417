"""Quality classifier: an interpolated modified Kneser-Ney model over character n-grams.

1. Blocks: each task gathers the documents that it reads into blocks of bounded size.  A block's texts go,
   compressed, into a file of the shared scratch folder; its ids and its distinct n-grams (far fewer than its
   characters) become a row.  From here on no text is shuffled: what is known of a block goes to a task that reads the file.
2. Counts: the ids are joined with the trusted ones, the n-grams of order ``ORDER`` of each block's trusted texts are counted,
   then summed by n-gram, in shards.  Lower orders count distinct continuations (the Kneser-Ney counts).
3. Discounts: three for each order, from the counts of counts.
4. Probabilities: a join of each order with its contexts and with the order below.
5. Scores: the n-grams of the blocks are joined with the sharded probabilities and meet their block's texts, where their
   logarithms are added up.
6. Thresholds: quantiles of the perplexity of the trusted documents of the same language, at both ends: what
   reads unlike the trusted text goes, and what repeats itself so that it reads too smoothly.  A
   language with few trusted documents takes the quantiles of all.

An n-gram is ``ORDER`` symbols of 16 bits in a 64-bit number; characters beyond the basic plane share a
symbol, and runs of white space are one blank.  A text begins with ``ORDER - 1`` blanks.

Defined cases: a null or blank text has perplexity null and isn't kept; a null language is a language
of its own (empty string); labels count as trusted by their rounded mean, null as no label; without any
trusted text all perplexities are null and nothing is kept; repeated rows get equal results; a null
doc_id is carried through; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import feather
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aurum.llm.common import chunked, discard, release, texts, written, written_at
from aurum.llm.files import opened
from aurum.session import delete_folder, scratch_path

ORDER = 4
LOW, HIGH = 0.001, 0.995
MIN_TRUSTED = 50
#: Bytes of text, and documents, of a block at most (a longer text is a block of its own).
BLOCK_BYTES = 12 << 20
BLOCK_DOCS = 1 << 16
#: Bytes of text whose n-grams are held at once, at some 30 bytes each.
SLICE_BYTES = 1 << 20
#: How hard texts are compressed.
PACK_LEVEL = 6
#: Tasks that blocks are dealt over at most; small results don't put many blocks into one task.
MOST_TASKS = 4096


def symbols(text: str) -> np.ndarray:
    """The symbols of a text, with the blanks that it begins with; nothing for a blank text."""
    body = " ".join(text.split())
    if not body:
        return np.empty(0, np.uint64)
    codes = np.frombuffer((" " * (ORDER - 1) + body).encode("utf-32-le"), np.uint32)
    return np.minimum(codes, 0xFFFF).astype(np.uint64)


def grams(x: np.ndarray) -> np.ndarray:
    """The n-grams of the symbols, each as one number whose last symbol is in the low bits."""
    out = np.zeros(max(0, len(x) - ORDER + 1), np.uint64)
    for j in range(ORDER):
        out = out << np.uint64(16) | x[j:j + len(out)]
    return out


def counted(rows: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of the texts and how often each occurs."""
    return np.unique(np.concatenate([np.empty(0, np.uint64), *(grams(symbols(x)) for x in rows)]), return_counts=True)


def summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """``counted`` of all texts from those of some each."""
    gram, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(gram, kind="stable")
    gram, first = np.unique(gram[order], return_index=True)
    return gram, np.add.reduceat(n[order], first) if len(first) else n


def discounts(counts: DataFrame) -> list[float]:
    """D1, D2 and D3+ from how many n-grams occur once to four times."""
    seen = dict(counts.where("n <= 4").groupBy("n").count().collect())
    n1, n2, n3, n4 = (float(seen.get(k, 0)) for k in (1, 2, 3, 4))
    if not n1 or not n2:
        return [0.5, 0.75, 0.9]
    y = n1 / (n1 + 2 * n2)
    out = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.0]
    return [min(max(d, 0.05), k - 0.05) for d, k in zip(out, (1, 2, 3), strict=True)]


def _suffix(order: int):
    """The last ``order`` symbols of an n-gram."""
    return F.col("gram").bitwiseAND(F.lit((1 << 16 * order) - 1))


def _context(gram="gram"):
    return F.shiftrightunsigned(gram, 16)


class Model:
    """For each order a table (gram, p) of interpolated probabilities and one (context, backoff)."""

    def __init__(self, counts: DataFrame):
        spark = counts.sparkSession
        levels = {ORDER: counts}
        for order in range(ORDER - 1, 0, -1):
            # in how many distinct ways an n-gram is continued to the left
            levels[order] = written(levels[order + 1].select(_suffix(order).alias("gram")).groupBy("gram").agg(F.count("*").alias("n")), f"kn-counts-{order}")
        self.symbols = levels[1].count() + 1
        self.tables: dict[int, DataFrame] = {}
        self.backoffs: dict[int, DataFrame] = {}
        lower = None
        for order in range(1, ORDER + 1):
            d1, d2, d3 = discounts(levels[order])
            discount = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
            by_context = levels[order].withColumn("context", _context())
            totals = by_context.groupBy("context").agg(F.sum("n").alias("total"), F.sum(discount).alias("spared"))
            backoff = written(totals.select("context", "total", (F.col("spared") / F.col("total")).alias("backoff")), f"kn-backoff-{order}")
            direct = by_context.join(backoff, "context").select("gram", ((F.col("n") - discount) / F.col("total")).alias("p"), "backoff")
            if lower is None:
                table = direct.select("gram", (F.col("p") + F.col("backoff") / self.symbols).alias("p"))
            else:
                below = lower.select(F.col("gram").alias("suffix"), F.col("p").alias("q"))
                table = (direct.withColumn("suffix", _suffix(order - 1)).join(below, "suffix")
                         .select("gram", (F.col("p") + F.col("backoff") * F.col("q")).alias("p")))
            lower = self.tables[order] = written(table, f"kn-probabilities-{order}")
            self.backoffs[order] = backoff.select("context", "backoff")
        del spark

    def probabilities(self, wanted: DataFrame) -> DataFrame:
        """``wanted`` (gram of the full order) with p, seen or not."""
        out = wanted.select("gram").distinct().withColumn("p1", F.lit(1.0 / self.symbols))
        for order in range(1, ORDER + 1):
            own = self.tables[order].select(F.col("gram").alias("g"), F.col("p").alias("seen"))
            back = self.backoffs[order].select(F.col("context").alias("c"), "backoff")
            out = (out.withColumn("g", _suffix(order) if order < ORDER else F.col("gram")).withColumn("c", _context("g"))
                   .join(own, "g", "left").join(back, "c", "left")
                   .select("gram", F.coalesce("seen", F.coalesce("backoff", F.lit(1.0)) * F.col("p1")).alias("p1")))
        return out.withColumnRenamed("p1", "p")


class Blocks:
    """The documents in blocks: a table (block, doc_ids, grams), and a file of doc_id, lang and text for each block.

    A block's number is random, so that an attempt that failed leaves a file that no row names.
    """

    def __init__(self, docs: DataFrame, block_bytes: int = BLOCK_BYTES):
        self.spark = docs.sparkSession
        self.path = scratch_path(self.spark, "kn-texts")
        docs = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"), F.col("text").cast("string").alias("text"))
        self.rows, self.rows_path = written_at(docs.mapInArrow(_blocked(self.path, block_bytes), "block long, doc_ids array<long>, grams array<long>"), "kn-blocks")
        self.tasks = min(max(1, self.rows.count()), MOST_TASKS)

    def dealt(self, df: DataFrame, block: str = "block") -> DataFrame:
        """``df`` over as many tasks as there are blocks, by its column ``block``, however few rows it has."""
        return df.repartition(self.tasks, block)

    def discard(self) -> None:
        delete_folder(self.spark, self.path)
        discard(self.spark, self.rows_path)


def _blocked(path: str, block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = opened(path)
        store.create_dir(base, recursive=True)

        def block(held: list[pa.RecordBatch], own: list[np.ndarray]) -> pa.RecordBatch:
            table, number = pa.Table.from_batches(held).combine_chunks(), uuid.uuid4().int >> 65
            with store.open_output_stream(f"{base}/{number}", compression=None) as f:
                feather.write_feather(table, f, compression="zstd", compression_level=PACK_LEVEL, chunksize=BLOCK_DOCS)
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([table["doc_id"].to_pylist()], pa.list_(pa.int64())),
                                               pa.array([np.unique(np.concatenate(own)).view(np.int64)], pa.list_(pa.int64()))], names=["block", "doc_ids", "grams"])

        held, own, n_bytes, n_docs = [], [], 0, 0
        for batch in chunked(batches, "text", min(SLICE_BYTES, block_bytes)):
            for some in (batch.slice(k, BLOCK_DOCS) for k in range(0, batch.num_rows, BLOCK_DOCS)):
                rows = texts(some["text"])
                size = some["text"].nbytes
                if held and (n_bytes + size > block_bytes or n_docs + len(rows) > BLOCK_DOCS):
                    yield block(held, own)
                    held, own, n_bytes, n_docs = [], [], 0, 0
                held.append(some)
                own.append(counted(rows)[0])
                n_bytes, n_docs = n_bytes + size, n_docs + len(rows)
        if held:
            yield block(held, own)
            release()

    return run


def _texts_of(path: str, block: int, columns: list[str]) -> pa.Table:
    store, base = opened(path)
    with store.open_input_file(f"{base}/{block}") as f:
        return feather.read_table(f, columns=columns, memory_map=False)


def _trusted_counts(path: str):
    """(block, places) to the n-grams of the texts at these places, with their numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, places in zip(batch["block"].to_pylist(), batch["places"].to_pylist(), strict=True):
                some = _texts_of(path, block, ["text"]).take(pa.array(places, pa.int64())).combine_chunks().to_batches()
                parts = [counted(texts(x["text"])) for x in chunked(some, "text", SLICE_BYTES)]
                if parts:
                    gram, n = summed(parts)
                    yield pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), pa.array(n.astype(np.int64))], names=["gram", "n"])

    return run


def trusted_ids(labels: DataFrame) -> DataFrame:
    """The documents that are labelled as good."""
    return labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.round(F.avg("quality")).alias("q")).where("q = 1").select("doc_id")


def train(blocks: Blocks, labels: DataFrame) -> Model:
    """The model of all texts that are labelled as good."""
    places = blocks.rows.select("block", F.posexplode("doc_ids").alias("place", "doc_id")).join(trusted_ids(labels), "doc_id", "left_semi")
    places = blocks.dealt(places).groupBy("block").agg(F.collect_list("place").alias("places"))
    counts = places.mapInArrow(_trusted_counts(blocks.path), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    return Model(written(counts, "kn-counts"))


def _scored(path: str):
    """A block and the logarithms of its n-grams to the perplexity of each of its texts."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        gram, log_p = right["gram"].to_numpy().view(np.uint64), right["log_p"].to_numpy()
        order = np.argsort(gram)
        gram, log_p = gram[order], log_p[order]
        known: dict[str, float | None] = {}  # copies are scored once
        out = []
        for block in left["own"].to_pylist():
            table = _texts_of(path, block, ["doc_id", "lang", "text"])
            values = []
            for piece in table.to_batches():
                for batch in chunked([piece], "text", SLICE_BYTES):
                    for x in texts(batch["text"]):
                        if x not in known:
                            own = grams(symbols(x))
                            known[x] = float(np.exp(-log_p[np.searchsorted(gram, own)].mean())) if len(own) and len(gram) else None
                        values.append(known[x])
            out.append(pa.table({"doc_id": table["doc_id"], "lang": table["lang"], "perplexity": pa.array(values, pa.float64())}))
        return pa.concat_tables(out)

    return run


def perplexities(blocks: Blocks, model: Model) -> DataFrame:
    """doc_id, lang and perplexity of every document."""
    wanted = blocks.rows.select("block", F.explode("grams").alias("gram"))
    known = wanted.join(model.probabilities(wanted), "gram").select("block", "gram", F.log("p").alias("log_p"))
    left, right = blocks.dealt(blocks.rows.select(F.col("block").alias("own")), "own"), blocks.dealt(known)
    return left.groupBy("own").cogroup(right.groupBy("block")).applyInArrow(_scored(blocks.path), "doc_id long, lang string, perplexity double")


def quality(docs: DataFrame, labels: DataFrame, *, low: float = LOW, high: float = HIGH, min_trusted: int = MIN_TRUSTED) -> DataFrame:
    """doc_id, perplexity, the language's bounds and ``kept``."""
    blocks = Blocks(docs)
    scored = written(perplexities(blocks, train(blocks, labels)), "kn-perplexities")
    blocks.discard()
    good = scored.where("perplexity is not null").join(trusted_ids(labels), "doc_id", "left_semi")
    bounds = lambda df: df.agg(F.percentile_approx("perplexity", F.array(F.lit(low), F.lit(high)), 10_000).alias("b"), F.count("*").alias("n"))
    by_lang = bounds(good.groupBy("lang")).where(F.col("n") >= min_trusted).select("lang", F.col("b")[0].alias("own_low"), F.col("b")[1].alias("own_high"))
    overall = bounds(good).select(F.col("b")[0].alias("any_low"), F.col("b")[1].alias("any_high")).first()
    at = lambda own, any_: F.coalesce(own, F.lit(any_).cast("double"))
    return (scored.join(by_lang, "lang", "left")
            .select("doc_id", "perplexity", at("own_low", overall["any_low"]).alias("low"), at("own_high", overall["any_high"]).alias("high"))
            .withColumn("kept", F.coalesce(F.col("perplexity").between(F.col("low"), F.col("high")), F.lit(False))))
