"""Landed lines: each one a whole JSON object, read as declared columns beside the document itself.

A landing keeps every field that the feed delivers.  Reading projects the declared columns with ``from_json`` and keeps
the line as VARIANT in ``doc``, so that undeclared fields stay reachable (``variant_get``) and can be reported
(``schema_drift``).  Lines that are no JSON object, or whose declared fields have other types, are not delivered as NULLs
but told apart by ``reject_reason``.  Timestamps carry any zone or offset; they are delivered in UTC.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aurum.session import children, path_exists
from aurum.sources.documents import object_variant
from aurum.sources.readers import CORRUPT, JSON_READ_OPTIONS, utc_columns, utc_schema

MALFORMED, MISFIT = "malformed line", "line does not fit the schema"
LANDING_NAME = r"_([0-9]{8})$|_([0-9]{8})\."
DRIFT = "field string, status string, rows long, types string"


def declared(df: DataFrame, schema: T.StructType, raw: str = "raw") -> DataFrame:
    """``df`` with the declared columns of its JSON text, ``doc`` (VARIANT) and ``reject_reason`` (NULL: a good line).

    Each line is parsed once: through a generator, so that filters on parsed columns, which would repeat both
    parsers for every column they name, stay above it.
    """
    read = T.StructType([*utc_schema(schema).fields, T.StructField(CORRUPT, T.StringType())])
    options = {**JSON_READ_OPTIONS, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    both = F.struct(F.from_json(raw, read, options).alias("p"), object_variant(F.col(raw)).alias("doc"))
    parsed = df.select("*", F.explode(F.array(both)).alias("__b")).select(*df.columns, F.col("__b.doc").alias("doc"), F.col("__b.p").alias("__p"))
    reason = F.when(F.col("doc").isNull(), F.lit(MALFORMED)).when(F.col(CORRUPT).isNotNull(), F.lit(MISFIT))
    flat = parsed.select(*[c for c in df.columns if c not in schema.fieldNames()], "doc", "__p.*")
    return utc_columns(flat.withColumn("reject_reason", reason).drop(CORRUPT), schema)


def read_lines(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """Landed lines at ``paths`` as declared columns, ``raw``, ``doc``, ``source_file`` and ``reject_reason``."""
    paths = [p for p in paths if path_exists(spark, p)]
    if not paths:
        lines = spark.createDataFrame([], "raw string, source_file string")
    else:
        lines = spark.read.text(paths).select(F.col("value").alias("raw"), F.col("_metadata.file_path").alias("source_file"))
    return declared(lines.where(F.trim("raw") != ""), schema)


def landing_days(spark: SparkSession, base: str) -> dict[str, str | None]:
    """The landings of a table by listing its folder alone: path -> load day as yyyymmdd (None: no date in the name)."""
    import re

    days: dict[str, str | None] = {}
    for name in children(spark, base):
        if name.startswith(("_", ".")):
            continue
        found = re.search(LANDING_NAME, name)
        day = (found.group(1) or found.group(2)) if found else None
        days[f"{base.rstrip('/')}/{name}"] = day and day[4:] + day[2:4] + day[:2]
    return days


def latest_landing(spark: SparkSession, base: str) -> list[str]:
    """The paths of the latest landing day, and of everything that carries no date."""
    days = landing_days(spark, base)
    last = max((d for d in days.values() if d), default=None)
    return sorted(p for p, d in days.items() if d is None or d == last)


def _kind(value: Column) -> Column:
    """The JSON kind of a VARIANT value: STRING, BIGINT, DECIMAL, DOUBLE, BOOLEAN, OBJECT, ARRAY or VOID."""
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def schema_drift(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """What the documents hold against what is declared, one row per field: status ``declared``, ``undeclared`` or
    ``missing`` (declared, but in no document), the number of rows that carry it, and the JSON kinds seen."""
    fields = F.explode(F.expr("cast(doc as map<string, variant>)")).alias("field", "value")
    seen = (lines.where(F.col("doc").isNotNull()).select(fields).groupBy("field", _kind(F.col("value")).alias("kind"))
            .agg(F.count(F.lit(1)).alias("n"))
            .groupBy("field").agg(F.sum("n").alias("rows"), F.array_join(F.sort_array(F.collect_list("kind")), ",").alias("types")))
    names = lines.sparkSession.createDataFrame([(n,) for n in schema.fieldNames()], "name string")
    both = seen.join(names, F.col("field") == F.col("name"), "full")
    status = F.when(F.col("name").isNull(), "undeclared").when(F.col("field").isNull(), "missing").otherwise("declared")
    return both.select(F.coalesce("field", "name").alias("field"), status.alias("status"),
                       F.coalesce("rows", F.lit(0)).cast("long").alias("rows"), F.coalesce("types", F.lit("")).alias("types"))


def hoisted(df: DataFrame, struct_field: str, extra: dict[str, Column], raw: str = "raw") -> DataFrame:
    """JSON objects with the fields of ``struct_field`` hoisted to the top (they replace fields of the same name) and
    ``extra`` fields set; every other field stays.  Works on VARIANT maps, so no field needs to be declared."""
    names = F.array(*[F.lit(n) for n in extra]) if extra else F.array().cast("array<string>")
    none = F.expr("cast(map() as map<string, variant>)")
    top = F.expr("cast(__doc as map<string, variant>)")
    with_maps = df.withColumn("__doc", object_variant(F.col(raw))).withColumn("__top", top).withColumn(
        "__in", F.coalesce(F.expr(f"try_cast(element_at(__top, '{struct_field}') as map<string, variant>)"), none))
    kept = F.map_filter("__top", lambda k, v: (k != F.lit(struct_field)) & ~F.array_contains(names, k) & ~F.map_contains_key(F.col("__in"), k))
    inner = F.map_filter("__in", lambda k, v: ~F.array_contains(names, k))
    added = [x for n, c in extra.items() for x in (F.lit(n), F.parse_json(F.to_json(F.struct(c.alias("v")))))]
    more = F.create_map(*[x if i % 2 == 0 else F.variant_get(x, "$.v", "variant") for i, x in enumerate(added)]) if extra else none
    return with_maps.withColumn(raw, F.to_json(F.map_concat(kept, inner, more))).drop("__doc", "__top", "__in")
