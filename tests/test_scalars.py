import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from aurum.functions import scalars as X


def one(spark, expr, value, dtype=T.StringType()):
    df = spark.createDataFrame([(value,)], T.StructType([T.StructField("v", dtype)]))
    return df.select(expr.alias("r")).first()["r"]


def test_safe_double_rejects_non_numeric_text(spark):
    cases = {"": None, "abc": None, "1d": None, "2f": None, "n/a": None, None: None,
             "1.5": 1.5, " 1.5 ": 1.5, "-3": -3.0, "1e3": 1000.0, ".5": 0.5, "7.": 7.0}
    for text, want in cases.items():
        assert one(spark, X.safe_double("v"), text) == want, text
    assert one(spark, X.safe_double("v"), "NaN") != one(spark, X.safe_double("v"), "NaN")  # NaN


def test_round_half_away_from_zero(spark):
    for v, n, want in [(1.005, 2, 1.01), (0.285, 2, 0.29), (-0.125, 2, -0.13), (2.5, 0, 3.0), (-2.5, 0, -3.0)]:
        assert one(spark, X.round_half_up("v", n), v, T.DoubleType()) == want


def test_scaled_price_uses_double_division(spark):
    df = spark.createDataFrame([(105,), (-5,), (None,)], "c long")
    out = df.select(X.scaled("c", 10.0, 1).alias("p"))
    assert dict(out.dtypes)["p"] == "double"
    assert [r.p for r in out.collect()] == [10.5, -0.5, None]


def test_value_map_without_and_with_default(spark):
    m = {1: "GKP", 2: "DEF"}
    assert one(spark, X.value_map("v", m), 5, T.LongType()) is None
    assert one(spark, X.value_map("v", m), None, T.LongType()) is None
    assert one(spark, X.value_map("v", m), 2, T.LongType()) == "DEF"
    assert one(spark, X.value_map("v", {"a": "Available"}, "Unknown"), None) == "Unknown"
    assert one(spark, X.value_map("v", {"a": "Available"}, "Unknown"), "x") == "Unknown"


def test_guarded_and_nullif_ratios(spark):
    df = spark.createDataFrame([(10, 4), (10, 0), (10, None), (10, -2), (None, 3)], "n long, d long")
    rows = df.select(X.guarded_ratio("n", "d").alias("g"), X.nullif_ratio("n", "d").alias("z")).collect()
    assert [r.g for r in rows] == [2.5, 0.0, 0.0, 0.0, None]
    assert [r.z for r in rows] == [2.5, None, None, -5.0, None]


def test_weighted_sum_null_propagates(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 2.0)], "a double, b double")
    out = [r.s for r in df.select(X.weighted_sum([("a", 2.0), ("b", 0.05)]).alias("s")).collect()]
    assert out == [2.1, None]


def test_strict_concat_and_bands(spark):
    df = spark.createDataFrame([("a", "b"), (None, "b")], "x string, y string")
    assert [r.c for r in df.select(X.strict_concat("x", F.lit(" "), "y").alias("c")).collect()] == ["a b", None]
    rules = [("<=", 2, "EASY"), ("=", 3, "MEDIUM"), (">=", 4, "HARD")]
    df = spark.createDataFrame([(1,), (3,), (5,), (None,)], "d long")
    assert [r.l for r in df.select(X.bands("d", rules).alias("l")).collect()] == ["EASY", "MEDIUM", "HARD", None]


def test_positive_flag_null_is_false(spark):
    df = spark.createDataFrame([(90,), (0,), (None,)], "m long")
    assert [r.p for r in df.select(X.positive_flag("m").alias("p")).collect()] == [True, False, False]


def test_period_and_landing_dates(spark):
    df = spark.createDataFrame([(dt.datetime(1995, 1, 1),), (dt.datetime(1995, 1, 8),), (dt.datetime(1995, 1, 7, 23),)],
                               "ts timestamp_ntz")
    assert [r.p for r in df.select(X.period_of("ts").alias("p")).collect()] == [1, 2, 1]
    paths = spark.createDataFrame([("landing/players/players_03022026.json",), ("x/load_key=t_31122025/part-0.json",),
                                   ("no_date.json",)], "p string")
    got = [r.d for r in paths.select(X.date_from_name("p").alias("d")).collect()]
    assert got == [dt.date(2026, 2, 3), dt.date(2025, 12, 31), None]
    assert one(spark, X.ddmmyyyy("v"), dt.date(2026, 2, 3), T.DateType()) == "03022026"
