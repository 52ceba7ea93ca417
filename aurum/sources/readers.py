"""Bronze readers: JSON lines, document payload arrays, root arrays, live documents, CSV.

All readers take an explicit schema; a missing or empty location yields an empty
DataFrame with that schema instead of an error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aurum.session import path_exists

CORRUPT = "_corrupt_record"
# full-precision timestamp text in JSON, for reading and writing (the default pattern
# keeps only milliseconds)
JSON_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
                "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
# feeds write ISO-8601 with or without a fraction, and with a "Z", an offset or no zone (which is UTC)
JSON_READ_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]['Z']",
                     "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS][XXX]", "timeZone": "UTC"}


def utc_schema(schema: T.StructType) -> T.StructType:
    """``schema`` with zone-free timestamps read as instants, so that offsets in the text count."""
    return T.StructType([T.StructField(f.name, T.TimestampType(), f.nullable) if isinstance(f.dataType, T.TimestampNTZType) else f
                         for f in schema.fields])


def utc_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The instants read for zone-free columns of ``schema``, as UTC wall-clock times (whatever the session's zone)."""
    for f in schema.fields:
        if isinstance(f.dataType, T.TimestampNTZType):
            df = df.withColumn(f.name, F.expr(f"timestampadd(MICROSECOND, unix_micros(`{f.name}`), timestamp_ntz'1970-01-01 00:00:00')"))
    return df


def _empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_json_lines(spark: SparkSession, path: str | list[str], schema: T.StructType,
                    keep_corrupt: bool = False, with_file: bool = False, fail_corrupt: bool = False) -> DataFrame:
    """Newline-delimited JSON with a fixed schema (the external bronze table).

    ``keep_corrupt`` adds ``_corrupt_record`` for lines that do not parse;
    ``with_file`` adds ``source_file`` from the hidden file metadata column;
    ``fail_corrupt`` makes such a line an error instead of a row of NULLs.
    """
    sch = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType(), True)]) if keep_corrupt else schema
    r = spark.read.schema(utc_schema(sch)).option("mode", "FAILFAST" if fail_corrupt else "PERMISSIVE").options(**JSON_READ_OPTIONS)
    if keep_corrupt:
        r = r.option("columnNameOfCorruptRecord", CORRUPT)
    paths = [path] if isinstance(path, str) else list(path)
    paths = [p for p in paths if path_exists(spark, p)]
    if not paths:
        empty = _empty(spark, sch)
        return empty.withColumn("source_file", F.lit(None).cast("string")) if with_file else empty
    df = r.json(paths if len(paths) > 1 else paths[0])
    if with_file:
        df = df.select("*", F.col("_metadata.file_path").alias("source_file"))
    return utc_columns(df, schema)


def explode_payload(spark: SparkSession, path: str, key: str, element: T.StructType,
                    multiline: bool = False) -> DataFrame:
    """Rows of the array under ``key`` in each document ({"<key>": [ {..}, .. ]}).

    A document without the key, or with a null array, contributes no rows.  Documents
    are one per line by default (splittable); ``multiline`` reads whole-file documents.
    """
    doc = T.StructType([T.StructField(key, T.ArrayType(utc_schema(element)), True)])
    reader = spark.read.schema(doc).options(**JSON_READ_OPTIONS)
    if multiline:
        reader = reader.option("multiLine", True)
    if not path_exists(spark, path):
        return _empty(spark, element)
    docs = reader.json(path)
    return utc_columns(docs.select(F.explode(F.col(key)).alias("__e")).select("__e.*"), element)


def read_root_array(spark: SparkSession, path: str, element: T.StructType,
                    period: int | None = None, period_col: str = "event") -> DataFrame:
    """Documents whose root is an array: every element is a row (JSON reader semantics).

    ``period`` optionally keeps only elements of that period.
    """
    df = read_json_lines(spark, path, element)
    return df.where(F.col(period_col) == F.lit(period)) if period is not None else df


def flatten_struct(df: DataFrame, struct_col: str = "stats") -> DataFrame:
    """Hoist the fields of ``struct_col`` to the top level and drop it.

    A struct field with the same name as a top-level column replaces that column
    (the struct's value wins); all other top-level columns are kept.
    """
    inner = [f.name for f in df.schema[struct_col].dataType.fields]
    keep = [c for c in df.columns if c != struct_col and c not in inner]
    return df.select(*keep, *[F.col(f"{struct_col}.{n}").alias(n) for n in inner])


def read_live_documents(spark: SparkSession, path: str, element: T.StructType,
                        period_col: str = "gameweek", period: int | None = None) -> DataFrame:
    """Per-period live documents {"elements": [{"id":.., "stats":{..}}]}.

    The period comes from the folder (``<period_col>=N``) or from the ``period`` literal;
    ``stats`` is flattened with stats values overriding same-named top-level fields.
    """
    doc = T.StructType([T.StructField("elements", T.ArrayType(element), True)])
    if period is None:
        doc = T.StructType(list(doc.fields) + [T.StructField(period_col, T.LongType(), True)])
    docs = spark.read.schema(doc).options(**JSON_READ_OPTIONS).json(path)
    rows = docs.select(*([F.col(period_col)] if period is None else [F.lit(period).cast("long").alias(period_col)]),
                       F.explode("elements").alias("__e"))
    flat = rows.select(period_col, "__e.*")
    return flatten_struct(flat, "stats")


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header CSV with a fixed string schema; a missing file gives an empty table."""
    if not path_exists(spark, path):
        return _empty(spark, schema)
    return spark.read.option("header", True).schema(schema).csv(path)
