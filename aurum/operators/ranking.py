"""Ranking operators that never funnel row-level data into one task.

``rank_by`` reproduces ``RANK() OVER ([PARTITION BY p] ORDER BY m [DESC])`` as
``1 + (rows of the same partition ordered strictly before the row)``, a distributed prefix sum:

1. count rows per distinct key ``(p, m)`` (partial aggregation, so a hot partition or a
   hot metric value is pre-combined map-side);
2. cut the sorted keys into ranges at evenly spaced keys of a bounded sample, the keys with the
   smallest hashes: the sample depends on the data alone, so every evaluation of the plan
   (retries, several branches) cuts alike, for any type that Spark can sort;
3. per ``(p, range)``: running count inside the range (a window over the distinct keys of
   that range only) and the offset of the ranges before it (a window over the range totals);
4. join the rank back on ``(p, m)`` with null-safe equality (broadcast or skew-split by
   AQE at runtime).

The bounds are one scalar subquery; a key's range is found by a binary search, one fold over
its steps, so neither the plan nor the work per key grows with the number of ranges.  A plain ``Window`` would sort a whole partition (or, for a global rank, the whole
table) in a single task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MIN_BUCKETS = 32
# sampled keys for each range: ranges then differ in size by a factor of about two at most
SAMPLE_PER_BUCKET = 16
# steps of the search for a key's range (more only above 65,535 ranges): the plan is the same for any number below
HALVINGS = 16


def default_buckets(df: DataFrame) -> int:
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(MIN_BUCKETS, 2 * parts)


def range_bounds(keys: DataFrame, key: Column, buckets: int) -> Column:
    """Scalar subquery: at most ``buckets - 1`` ascending keys that cut ``keys`` into ranges of like size.

    ``keys`` holds each key once.  The sample is bounded (``SAMPLE_PER_BUCKET`` keys a range); ties of
    the hash are broken by the key itself, so it is the same in every evaluation.
    """
    # __n is named so that the sample reads the columns that the other branches read: one shared shuffle
    sample = (keys.where(F.col("__n") > 0).select(key.alias("k"))
                  .orderBy(F.xxhash64("k"), "k").limit(SAMPLE_PER_BUCKET * buckets)
                  .agg(F.sort_array(F.collect_list("k")).alias("s")))
    step = F.greatest(F.lit(1), F.ceil(F.size("s") / F.lit(buckets)))
    return sample.select(F.filter("s", lambda x, i: (i > 0) & (i % step == 0)).alias("b")).scalar()


def range_numbered(df: DataFrame, key: Column, bounds: Column, most: int, out: str) -> DataFrame:
    """``df`` with ``out``: how many of the ascending ``bounds`` (at most ``most``) are not above ``key``.

    A binary search as one fold over its steps: one expression, however many bounds.
    """
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(max(HALVINGS, most.bit_length())))])
    # past the end ``get`` is NULL, and the step isn't taken
    found = F.aggregate(steps, F.lit(0), lambda n, step: n + F.when(F.get("__bounds", n + step - 1) <= key, step).otherwise(F.lit(0)))
    return df.withColumn("__bounds", bounds).withColumn(out, found).drop("__bounds")


def value_bucket(counts: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """``counts`` (one row per distinct ``keys``) with ``__b``: the range of the key, ascending in
    Spark's sort order (NULLs first, NaN last)."""
    if buckets <= 1:
        return counts.withColumn("__b", F.lit(0))
    key = F.struct(*[F.col(k) for k in keys])
    return range_numbered(counts, key, range_bounds(counts, key, buckets), buckets, "__b")


def _rank_table(counts: DataFrame, metric: str, by: list[str], descending: bool, out: str, buckets: int) -> DataFrame:
    """(by, metric) -> rank, from counts per distinct (by, metric) (columns: by, metric, __n).

    One shuffle by (by, range) serves the in-range running count and the range totals (each
    only needs clustering on those columns).
    """
    c = value_bucket(counts, [*by, metric], buckets).repartition(*[F.col(k) for k in by], F.col("__b"))
    m = F.col(metric)
    order: Column = m.desc_nulls_last() if descending else m.asc_nulls_first()
    w_in = Window.partitionBy(*by, "__b").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    local = c.withColumn("__before", F.coalesce(F.sum("__n").over(w_in), F.lit(0)))

    # range totals from the window's input partitioning (no extra shuffle)
    totals = local.groupBy(*by, "__b").agg(F.sum("__n").alias("__bn"))
    first = F.col("__b").desc() if descending else F.col("__b").asc()
    w_off = Window.partitionBy(*by).orderBy(first).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*[F.col(k).alias(f"__o_{k}") for k in by + ["__b"]],
                            F.coalesce(F.sum("__bn").over(w_off), F.lit(0)).alias("__off"))
    if not by:
        offsets = F.broadcast(offsets)   # at most ``buckets`` rows
    cond = [F.col(k).eqNullSafe(F.col(f"__o_{k}")) for k in by + ["__b"]]
    return local.join(offsets, cond).select(
        *by, metric, (F.lit(1) + F.col("__off") + F.col("__before")).cast("long").alias(out))


def rank_columns(df: DataFrame, metric: str, ranks: Mapping[str, Sequence[str]], descending: bool = True,
                 buckets: int | None = None) -> DataFrame:
    """Several RANK() columns over the same ordering, e.g. within position and overall.

    ``ranks`` maps output name -> PARTITION BY columns.  All ranks come from one count of
    rows per distinct (all partition columns, metric) and are joined back to ``df`` once.
    """
    keys: list[str] = []
    for by in ranks.values():
        keys += [k for k in by if k not in keys]
    nb = buckets if buckets is not None else default_buckets(df)
    counts = df.groupBy(*keys, metric).agg(F.count(F.lit(1)).alias("__n"))

    # start from a rank computed at the finest grain (its rows are exactly the distinct
    # keys); coarser ranks are joined onto it by their own keys
    finest = next((o for o, by in ranks.items() if set(by) == set(keys)), None)
    table = (_rank_table(counts, metric, list(ranks[finest]), descending, finest, nb) if finest is not None
             else counts.select(*keys, metric))
    for out, by in ranks.items():
        if out == finest:
            continue
        coarser = counts.groupBy(*by, metric).agg(F.sum("__n").alias("__n"))
        r = _rank_table(coarser, metric, list(by), descending, out, nb)
        r = r.select(*[F.col(k).alias(f"__r_{k}") for k in list(by) + [metric]], out)
        cond = [table[k].eqNullSafe(r[f"__r_{k}"]) for k in list(by) + [metric]]
        table = table.join(r, cond, "left").drop(*[f"__r_{k}" for k in list(by) + [metric]])

    keyed = table.select(*[F.col(k).alias(f"__k_{k}") for k in keys + [metric]], *ranks.keys())
    cond = [df[k].eqNullSafe(keyed[f"__k_{k}"]) for k in keys + [metric]]
    return df.join(keyed, cond, "left").drop(*[f"__k_{k}" for k in keys + [metric]])


def rank_by(df: DataFrame, metric: str, partition_by: Sequence[str] = (), descending: bool = True,
            out: str = "rank", buckets: int | None = None) -> DataFrame:
    """Add ``out`` (bigint) = RANK() OVER (PARTITION BY partition_by ORDER BY metric [DESC]).

    NULL metrics sort last for DESC and first for ASC (Spark's defaults); NULL partition
    values form their own partition.
    """
    return rank_columns(df, metric, {out: list(partition_by)}, descending, buckets)


def rank_window(df: DataFrame, metric: str, partition_by: Sequence[str] = (), descending: bool = True,
                out: str = "rank") -> DataFrame:
    """Reference formulation with a plain window (used in tests as the oracle for ``rank_by``)."""
    order = F.col(metric).desc_nulls_last() if descending else F.col(metric).asc_nulls_first()
    w = Window.partitionBy(*partition_by).orderBy(order) if partition_by else Window.orderBy(order)
    return df.withColumn(out, F.rank().over(w).cast("long"))


def top_n_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int,
                    out: str = "row_no") -> DataFrame:
    """ROW_NUMBER() OVER (PARTITION BY group ORDER BY order) <= n.

    Spark plans this as a partial WindowGroupLimit before the shuffle, so every map task
    forwards at most ``n`` rows per group: a hot group costs no more shuffle than a cold one.
    ``order`` should end in a total tie-break so the kept rows are deterministic.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    rn = "__rn"
    return (df.withColumn(rn, F.row_number().over(w))
              .where(F.col(rn) <= n)
              .withColumn(out, F.col(rn).cast("long"))
              .drop(rn))


def recent_n(df: DataFrame, key: str, n: int, where: Column | None = None) -> DataFrame:
    """The ``n`` largest ``key`` values after ``where`` (ORDER BY key DESC LIMIT n).

    Planned as TakeOrderedAndProject: each task keeps its own top ``n``, no full sort.
    The result holds at most ``n`` rows, so joining it is a proven-size broadcast.
    """
    src = df.where(where) if where is not None else df
    return F.broadcast(src.select(key).orderBy(F.col(key).desc()).limit(n))
