"""Helpers that several operators of the subpackage share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from aurum.session import delete_folder, scratch_path

#: ASCII white space: the separators between words wherever a contract says ``[^\x20\x09-\x0D]+``.
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared scratch folder.

    Cuts the lineage and fixes the rows: a lost executor makes Spark read the files again, never
    compute the rows anew with other results.
    """
    return written_at(df, name)[0]


def written_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``written``, with the table's folder, for ``discard``."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Remove a scratch table that nothing reads any more, and let Spark remove the shuffles that led to it.

    Call it when what was made of the table is written itself: a lost executor then reads that.  Spark drops the
    files of shuffles whose plans are unreachable in the driver, which a collection there finds out.
    """
    delete_folder(spark, path)
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def texts(column: pa.Array) -> list[str]:
    """Python strings of an Arrow column; null becomes the empty text."""
    return ["" if x is None else x for x in column.to_pylist()]


def release() -> None:
    """Hand freed memory back to the system: workers are kept for later stages, which need it for their own."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def chunked(batches: Iterable[pa.RecordBatch], text: str, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of the batches that hold at most ``limit`` bytes of text, or one row.

    Bounds what an operator unpacks at once; every row comes through, in order.  At the end, freed memory is released.
    """
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        ends = np.cumsum(byte_lengths(batch.column(batch.schema.get_field_index(text))))
        start = 0
        while start < n:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
    release()


def byte_lengths(column: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the n+1 offsets of its rows; null has no bytes."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mixing of 64-bit integers (a multiply-xorshift finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
