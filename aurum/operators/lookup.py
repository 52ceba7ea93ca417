"""Dimension lookups: left lookups and role-playing id resolution; joins whose result is a product for each key.

No side carries a broadcast hint: ``spark.sql.autoBroadcastJoinThreshold`` (bytes, from statistics) and
adaptive execution (from measured sizes) choose the join, at run time and anew as tables grow.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Parts at least that the rows of one key are dealt over in ``spread_join``: a task gets parts of several keys, so tasks are even.
SPREAD = 64
#: Partitions for each part of a key: with more partitions (a larger cluster or input) there are more parts.
TASKS_A_PART = 4
#: Partitions of such a join at least: the parts of a few keys are uneven, so each core gets several tasks.
LEAST_TASKS = 64


def left_lookup(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                columns: Mapping[str, str], how: str = "left") -> DataFrame:
    """``fact LEFT JOIN dim ON fact.fact_key = dim.dim_key`` adding ``columns`` (dim col -> out name).

    The dimension is projected to the key and the needed columns before the join.
    """
    return role_lookups(fact, dim, dim_key, {fact_key: columns}, how)


def role_lookups(fact: DataFrame, dim: DataFrame, dim_key: str,
                 roles: Mapping[str, Mapping[str, str]], how: str = "left") -> DataFrame:
    """One dimension looked up in several roles: ``roles`` maps each fact foreign key to the
    dimension columns it adds (dim col -> out name).
    """
    needed = sorted({src for cols in roles.values() for src in cols})
    side = dim.select(F.col(dim_key).alias("__lk"), *needed)
    out = fact
    for fk, cols in roles.items():
        key = f"__lk_{fk}"
        one = side.select(F.col("__lk").alias(key), *[F.col(src).alias(o) for src, o in cols.items()])
        out = out.join(one, out[fk] == one[key], how).drop(key)
    return out


def resolve_ids(fact: DataFrame, dim: DataFrame, dim_key: str, value_col: str,
                roles: Mapping[str, str]) -> DataFrame:
    """Role-playing lookup: for each ``fk -> out`` in ``roles`` add ``dim.value_col`` as ``out``
    via a left join on ``fact.fk = dim.dim_key``.

    The dimension is first reduced to the ids the fact references (one scan of the fact
    collects every role's ids; a semi join keeps those dimension rows), so a large
    dimension is never shipped whole: the reduced side holds at most (roles x fact rows)
    rows, and AQE broadcasts it at runtime from its measured size (or keeps a shuffle join
    when it is large).  Every role joins the same reduced side, so its exchange is reused.
    """
    fks = list(roles)
    ids = (fact.select(F.explode(F.array(*[F.col(fk) for fk in fks])).alias("__id"))
               .where(F.col("__id").isNotNull()).distinct())
    needed = (dim.select(F.col(dim_key).alias("__id"), F.col(value_col).alias("__val"))
                 .join(ids, "__id", "left_semi"))
    out = fact
    for i, (fk, name) in enumerate(roles.items()):
        side = needed.alias(f"__r{i}")
        out = (out.join(side, out[fk] == F.col(f"__r{i}.__id"), "left")
                  .select(*[out[c] for c in out.columns], F.col(f"__r{i}.__val").alias(name)))
    return out


def spread_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, parts: int | None = None) -> DataFrame:
    """``left JOIN right ON left.left_key = right.right_key`` for a key with few values and many rows on both sides.

    A key's result is the product of its rows, far more than the input from which adaptive execution sizes its tasks,
    and one task a key at most would make it.  The left rows of a key are dealt over ``parts``, its right rows (the
    fewer and smaller ones) go to each, and the number of partitions is stated, so that they are not merged again.
    The parts grow with the partitions: a single key with most of the rows is not held to a fixed number of tasks.
    """
    n = max(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), LEAST_TASKS)
    parts = parts or max(SPREAD, n // TASKS_A_PART)
    a = left.withColumn("__part", F.pmod(F.xxhash64(*left.columns), F.lit(parts)).cast("int")).repartition(n, left_key, "__part")
    b = right.withColumn("__to", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).repartition(n, right_key, "__to")
    return a.join(b, (a[left_key] == b[right_key]) & (a["__part"] == b["__to"])).drop("__part", "__to")
