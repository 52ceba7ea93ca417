"""Sums of doubles against exact arithmetic, under any partitioning."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from aurum.operators.exact_sum import exact_aggregate


def rounded(xs):
    """The exact sum, rounded once."""
    if any(math.isnan(x) for x in xs) or {math.inf, -math.inf} <= set(xs):
        return math.nan
    if any(math.isinf(x) for x in xs):
        return next(x for x in xs if math.isinf(x))
    return float(sum(map(Fraction, xs)))


def same(a, b):
    return a == b or (a is not None and b is not None and math.isnan(a) and math.isnan(b))


@pytest.fixture(scope="module")
def values():
    rnd = random.Random(5)
    kinds = {
        "cents": lambda: round(rnd.uniform(-100, 100), 2),
        "any scale": lambda: rnd.uniform(-1, 1) * 10.0 ** rnd.randint(-300, 300),
        "subnormal": lambda: rnd.choice([5e-324, -5e-324, 2.2e-308, 1e-310, 3e-320]),
        "cancelling": lambda: rnd.choice([1e300, -1e300, 1.0, 2.0 ** -50]),
        "near powers": lambda: float(2 ** rnd.randint(-60, 60)) - rnd.choice([0, 1e-9]),
        "nulls": lambda: None,
        "nan": lambda: rnd.choice([1.0, math.nan, None]),
        "infinite": lambda: rnd.choice([1.0, -math.inf]),
        "both infinite": lambda: rnd.choice([math.inf, -math.inf]),
        "zeros": lambda: rnd.choice([0.0, -0.0, None]),
        None: lambda: rnd.choice([0.1, 0.2, 0.3]),
    }
    return [(g, f(), k % 3 == 0, k) for g, f in kinds.items() for k in range(400)]


@pytest.mark.parametrize("parts", [1, 5, 23])
def test_sums_equal_exact_arithmetic(spark, values, parts):
    df = spark.createDataFrame(values, "g string, x double, flag boolean, k long").repartition(parts)
    got = {r.g: r for r in exact_aggregate(df, ["g"], sums={"s": "x", "s2": F.col("x") * 2}, avgs={"a": "x"},
                                           whole={"n": F.lit(1).cast("long"), "flags": F.col("flag").cast("long"), "ks": F.col("k")}).collect()}
    for g in {v[0] for v in values}:
        xs = [v[1] for v in values if v[0] == g and v[1] is not None]
        want = rounded(xs) if xs else None
        assert same(got[g].s, want), (g, got[g].s, want)
        assert same(got[g].a, want / len(xs) if xs else None), g
        assert same(got[g].s2, 2 * want if xs else None), g
        assert (got[g].n, got[g].flags, got[g].ks) == (400, 134, 399 * 200)


def test_no_groups(spark):
    df = spark.createDataFrame([], "g string, x double")
    assert exact_aggregate(df, ["g"], sums={"s": "x"}).collect() == []
