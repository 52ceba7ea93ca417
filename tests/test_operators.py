import random
import time

import pytest
from pyspark.sql import functions as F

from aurum.operators import lookup as L
from aurum.operators import ranking as RK
from aurum.operators import reshape as RS


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def make(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        grp = rnd.choice(["GKP", "DEF", "MID", "FWD", None, "DEF", "DEF"])  # DEF is hot
        m = rnd.choice([None, float(rnd.randint(0, 40)) / 4, rnd.random() * 100, 0.0])
        data.append((i, grp, m))
    return spark.createDataFrame(data, "id long, grp string, m double")


def test_rank_by_matches_window_rank(spark):
    df = make(spark).union(spark.createDataFrame([(-1, "MID", float("nan")), (-2, "MID", float("nan"))],
                                                 "id long, grp string, m double"))
    for by in ([], ["grp"]):
        for desc in (True, False):
            a = RK.rank_by(df, "m", by, descending=desc, out="r", buckets=8)
            b = RK.rank_window(df, "m", by, descending=desc, out="r")
            assert rows(a, "id", "r") == rows(b, "id", "r"), (by, desc)


def test_rank_by_string_metric(spark):
    df = make(spark, 500).withColumn("s", F.col("m").cast("string"))
    a = RK.rank_by(df, "s", ["grp"], out="r")
    b = RK.rank_window(df, "s", ["grp"], out="r")
    assert rows(a, "id", "r") == rows(b, "id", "r")


def single_partition_inputs(plan: str) -> list[str]:
    lines = plan.splitlines()
    return [lines[i + 1] for i, ln in enumerate(lines) if "Exchange SinglePartition" in ln]


def test_rank_by_plan_has_no_single_partition_exchange_over_rows(spark):
    df = make(spark)
    plan = RK.rank_by(df, "m", [], out="r")._jdf.queryExecution().executedPlan().toString()
    window_plan = RK.rank_window(df, "m", [], out="r")._jdf.queryExecution().executedPlan().toString()
    assert single_partition_inputs(window_plan)
    # only bounded inputs reach one task: the sampled keys (at most the limit of a task each) and the range totals
    for child in single_partition_inputs(plan):
        assert "TakeOrderedAndProject" in child or "GlobalLimit" in child or "partial_collect_list" in child or "keys=[__b" in child, child


TYPES = {
    "text": "concat('the same start of every text ', cast(id * 7919 % 83 as string))",
    "binary": "cast(concat('k', cast(id * 31 % 57 as string)) as binary)",
    "ntz": "timestampadd(MINUTE, cast(id * 13 % 240 as int), timestamp_ntz'2024-11-02 23:00:00')",  # around the end of summer time
    "tz": "timestampadd(MINUTE, cast(id * 13 % 240 as int), timestamp'2024-11-03 04:00:00Z')",
    "day": "date_add(date'1969-12-20', cast(id * 17 % 29 as int))",
    "exact": "cast(id * 97 % 41 as decimal(38,18)) / 7",
    "wide": "cast(concat('123456789012345678901234567890', cast(id % 47 as string)) as decimal(38,0))",
    "float": "case id % 5 when 0 then double('NaN') when 1 then -0.0D when 2 then 0.0D when 3 then double('-Infinity') else id % 37 / 3D end",
    "flag": "id % 3 = 0",
    "pair": "named_struct('a', id % 5, 'b', concat('x', cast(id % 7 as string)))",
    "list": "array(id % 4, id % 6)",
    "span": "make_dt_interval(0, 0, cast(id * 7 % 53 as int))",
}


@pytest.mark.parametrize("kind", TYPES)
def test_rank_of_any_orderable_type(spark, kind):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.range(600).select("id", F.expr("case when id % 3 = 0 then 'hot' when id % 7 = 0 then null else concat('p', cast(id % 4 as string)) end").alias("p"),
                                     F.expr(f"case when id % 11 = 0 then null else {TYPES[kind]} end").alias("m"))
        for by in ([], ["p"]):
            for desc in (True, False):
                got = RK.rank_by(df, "m", by, descending=desc, out="r", buckets=16)
                assert rows(got, "id", "r") == rows(RK.rank_window(df, "m", by, descending=desc, out="r"), "id", "r"), (by, desc)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_rank_plan_does_not_grow_with_the_ranges(spark):
    df = make(spark)
    sizes, before = {}, spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in (8, 4096):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            start = time.time()
            sizes[parts] = len(RK.rank_by(df, "m", ["grp"], out="r")._jdf.queryExecution().optimizedPlan().toString())
            assert time.time() - start < 10
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sizes[4096] < 1.1 * sizes[8]


@pytest.mark.parametrize("buckets", [2, 3, 7, 64, 8192])
def test_ranges_are_ascending_and_of_like_size(spark, buckets):
    counts = spark.range(20_000).select((F.col("id") * 7919 % 20_011).alias("k"), F.lit(1).alias("__n"))
    got = RK.value_bucket(counts, ["k"], buckets).groupBy("__b").agg(F.min("k").alias("a"), F.max("k").alias("z"), F.count("k").alias("n"))
    ranges = sorted(tuple(r) for r in got.collect())
    assert all(x[2] < y[1] for x, y in zip(ranges, ranges[1:])) and ranges[0][0] >= 0 and ranges[-1][0] < buckets
    if buckets <= 64:
        assert len(ranges) == buckets and max(r[3] for r in ranges) < 2.5 * 20_000 / buckets


def test_ranges_are_found_by_halving(spark):
    counts = spark.createDataFrame([("a", None, 1), (None, 3.0, 1), ("a", float("nan"), 2), ("b", -1.0, 1)], "p string, m double, __n long")
    plan = RK.value_bucket(counts, ["p", "m"], 64)._jdf.queryExecution().optimizedPlan().toString()
    assert "aggregate(" in plan and "slice(" not in plan
    whole = "b array<struct<p:string,m:double>>"
    bounds = spark.createDataFrame([([(None, 1.0), ("a", None), ("a", 2.0), ("b", -1.0)],)], whole).scalar()
    got = RK.range_numbered(counts, F.struct("p", "m"), bounds, 64, "n")
    assert [r.n for r in got.collect()] == [2, 1, 3, 4]


def test_top_n_per_group_and_group_limit(spark):
    df = make(spark)
    out = RK.top_n_per_group(df, ["grp"], [F.col("m").desc_nulls_last(), F.col("id")], 3, out="n")
    got = out.groupBy("grp").count().collect()
    assert all(r["count"] == 3 for r in got)
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_recent_n_fewer_rows_than_n(spark):
    df = spark.createDataFrame([(1, True), (2, True), (3, False)], "gw long, fin boolean")
    assert rows(RK.recent_n(df, "gw", 5, F.col("fin") == True), "gw") == [(1,), (2,)]  # noqa: E712


def test_unpivot_equals_union(spark):
    df = spark.createDataFrame([(1, 2, "a", "b"), (3, None, "c", None)], "h long, a long, hn string, an string")
    sides = ({"team": F.col("h"), "opp": F.col("an"), "venue": F.lit("HOME")},
             {"team": F.col("a"), "opp": F.col("hn"), "venue": F.lit("AWAY")})
    u1, u2 = RS.unpivot_sides(df, sides), RS.union_sides(df, sides)
    assert rows(u1, "team", "opp", "venue") == rows(u2, "team", "opp", "venue")
    assert u1.count() == 4


def test_left_lookup_keeps_unmatched_rows(spark):
    fact = spark.createDataFrame([(1, 10), (2, 99), (3, None)], "id long, team long")
    dim = spark.createDataFrame([(10, "Arsenal", "ARS")], "id long, name string, short_name string")
    out = L.left_lookup(fact, dim, "team", "id", {"name": "team_name"})
    assert rows(out, "id", "team_name") == [(1, "Arsenal"), (2, None), (3, None)]


def test_resolve_ids_four_roles(spark):
    gw = spark.createDataFrame([(1, 10, 11, 12, 99)], "gw long, a long, b long, c long, d long")
    players = spark.createDataFrame([(10, "x"), (11, "y"), (12, "z"), (13, "unused")], "pid long, name string")
    out = L.resolve_ids(gw, players, "pid", "name", {"a": "a_name", "b": "b_name", "c": "c_name", "d": "d_name"})
    r = out.first()
    assert (r.a_name, r.b_name, r.c_name, r.d_name) == ("x", "y", "z", None)


def test_lookups_run_no_job_while_planning(spark):
    sc = spark.sparkContext
    sc.setJobGroup("planning", "no job may run here")
    try:
        L.left_lookup(spark.range(1000).toDF("a"), spark.range(10).toDF("b").withColumn("c", F.col("b") * 2), "a", "b", {"c": "c"})
        assert not sc.statusTracker().getJobIdsForGroup("planning")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_spread_join_deals_one_key_over_many_tasks(spark):
    """The tasks of a key's product grow with the partitions; they were 16 at most."""
    left = spark.createDataFrame([(1, k) for k in range(3000)] + [(2, 7), (2, 7), (None, 8), (3, 9)], "a int, x int")
    right = spark.createDataFrame([(1, "p"), (1, "q"), (1, "q"), (2, "r"), (2, None), (None, "s"), (4, "t")], "b int, y string")
    plain = left.join(right, F.col("a") == F.col("b"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions, least in ((8, 30), (400, 70)):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            got = L.spread_join(left, right, "a", "b")
            assert rows(got, "a", "x", "b", "y") == rows(plain, "a", "x", "b", "y")
            tasks = got.where("a = 1").groupBy(F.spark_partition_id()).count().collect()
            assert len(tasks) >= least and sum(r["count"] for r in tasks) == 9000, len(tasks)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
