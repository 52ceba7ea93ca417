"""Sums of doubles that don't depend on the order in which partitions are combined.

Adding doubles rounds at every step, so a distributed sum changes with the partitioning.  Here each value is an
integer times a power of two: values are put into bins of ``WIDTH`` binary exponents and scaled by their bin's
power of two, which makes them whole numbers below 2**62; those are added exactly, as decimals, per group and bin
(partial sums on the map side as in any aggregation).  A group has a few bins (263 cover all doubles); their totals
are put together with error-free additions and rounded once.  No digit is cut, whatever the scale of the values;
NULLs are ignored, NaN and infinities give what plain addition gives.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDTH = 8
# a value's last bit is at most 52 places below its first; one more for the rounding of log2
SHIFT = 53
LIMB = 1 << 48
NAN, PLUS, MINUS = 9001, 9002, 9003   # bins of what is no number


def _power(exponent: Column) -> Column:
    return F.pow(F.lit(2.0), exponent.cast("double"))


def _scaled(x: Column, exponent: Column) -> Column:
    """x * 2**exponent in two steps, since the power alone may leave the range of doubles."""
    half = F.floor(exponent / F.lit(2))
    return x * _power(half) * _power(exponent - half)


def _bin(x: Column) -> Column:
    b = F.when(x == 0, F.lit(0)).otherwise(F.floor(F.log2(F.abs(x)) / F.lit(float(WIDTH)))).cast("int")
    return (F.when(F.isnan(x), F.lit(NAN)).when(x == float("inf"), F.lit(PLUS)).when(x == float("-inf"), F.lit(MINUS)).otherwise(b))


def _whole(x: Column, b: Column) -> Column:
    return F.when(b < NAN, _scaled(x, F.lit(SHIFT) - b * WIDTH).cast("long").cast("decimal(20,0)"))


def _combined(bins: Column) -> Column:
    """The sum of bin totals (structs b, t), largest bin first, as hi + lo of error-free additions."""
    finite = F.sort_array(F.filter(bins, lambda x: x["b"] < NAN), asc=False)

    limb = F.lit(LIMB).cast("decimal(20,0)")

    def limbs(x: Column) -> Column:
        """A total as two whole doubles (below 2**53 each) at their places."""
        low, place = x["t"] % limb, x["b"] * WIDTH - SHIFT
        return F.array(_scaled(((x["t"] - low) / limb).cast("double"), place + 48), _scaled(low.cast("double"), place))

    terms = F.flatten(F.transform(finite, limbs))

    def add(acc: Column, x: Column) -> Column:
        s = acc["hi"] + x
        part = s - acc["hi"]
        return F.struct(s.alias("hi"), (acc["lo"] + ((acc["hi"] - (s - part)) + (x - part))).alias("lo"))

    total = F.aggregate(terms, F.struct(F.lit(0.0).alias("hi"), F.lit(0.0).alias("lo")), add,
                        lambda acc: F.when(F.abs(acc["hi"]) == float("inf"), acc["hi"]).otherwise(acc["hi"] + acc["lo"]))

    def has(k: int) -> Column:
        return F.exists(bins, lambda x: x["b"] == k)

    return (F.when(F.size(bins) == 0, F.lit(None).cast("double")).when(has(NAN) | (has(PLUS) & has(MINUS)), F.lit(float("nan")))
            .when(has(PLUS), F.lit(float("inf"))).when(has(MINUS), F.lit(float("-inf"))).otherwise(total))


def exact_aggregate(df: DataFrame, keys: Sequence[str], sums: Mapping[str, str | Column] | None = None,
                    avgs: Mapping[str, str | Column] | None = None, whole: Mapping[str, Column] | None = None) -> DataFrame:
    """``df`` grouped by ``keys``: exact ``sums`` and ``avgs`` of doubles (output -> column) and, in the same pass, plain
    sums of the integer columns ``whole``."""
    measures = {**(sums or {}), **(avgs or {})}
    whole = dict(whole or {})
    columns = [F.col(c) if isinstance(c, str) else c for c in measures.values()]
    wide = df.select(*keys, *[c.alias(f"__w_{o}") for o, c in whole.items()], *[c.cast("double").alias(f"__x{i}") for i, c in enumerate(columns)])
    x = F.col("__x")
    # one row a measure; the integers go with the first
    long = wide.select(*keys, F.posexplode(F.array(*[F.col(f"__x{i}") for i in range(len(columns))])).alias("__i", "__x"),
                       *[f"__w_{o}" for o in whole])
    first = F.col("__i") == 0
    binned = long.withColumn("__b", _bin(x))
    partial = binned.groupBy(*keys, "__i", "__b").agg(
        F.sum(_whole(x, F.col("__b"))).alias("__t"), F.count("__x").alias("__n"),
        *[F.sum(F.when(first, F.col(f"__w_{o}"))).alias(f"__w_{o}") for o in whole])

    def of(i: int) -> Column:
        return F.filter(F.collect_list(F.when((F.col("__i") == i) & F.col("__b").isNotNull(),
                                              F.struct(F.col("__b").alias("b"), F.col("__t").alias("t")))), lambda s: s.isNotNull())

    grouped = partial.groupBy(*keys).agg(
        *[F.sum(f"__w_{o}").alias(o) for o in whole], *[of(i).alias(f"__l{i}") for i in range(len(columns))],
        *[F.sum(F.when(F.col("__i") == i, F.col("__n"))).alias(f"__n{i}") for i in range(len(columns))])
    out = []
    for i, name in enumerate(measures):
        total = _combined(F.col(f"__l{i}"))
        out.append((total / F.nullif(F.col(f"__n{i}"), F.lit(0)) if avgs and name in avgs else total).alias(name))
    return grouped.select(*keys, *whole, *out)
