"""Document collections.

A collection is read with a schema that is either given or inferred, from
all its documents unless a number is given.  Inference is a Spark job of its
own; the full scan then runs once with the fixed schema, so every executor
applies the same types.  With ``sample_size``, a field that only later documents
have is not in the schema.  A given schema is ideally *narrow*
(:func:`nestflow.sources.schemas.narrow_schema`), which is also what lets
Parquet skip the rest of a deeply nested record; what does not fit a given schema is
reported by :mod:`nestflow.sources.rescue`.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestflow.functions.clock import DEFAULT_TZ
from nestflow.operators.filters import DAY_PREFIX, stored_time, with_stored_time
from nestflow.sources.sinks import in_setting

# Documents that a schema is inferred from: None is all of them, in parallel.
# With a number, fields that only later documents have are not in the schema.
DEFAULT_SAMPLE: int | None = None


def _sample_schema(spark: SparkSession, text: DataFrame, sample_size: int | None,
                   options: Mapping[str, str] | None = None) -> T.StructType:
    """Infer with Spark's JSON reader over all strings, or the first ``sample_size``,
    passed as a ``Dataset[String]`` (``DataFrameReader.json(Dataset)``), so
    inference stays in the JVM: no RDD, no Python worker."""
    sample = (text if sample_size is None else text.limit(sample_size)).select(F.col(text.columns[0]).cast("string"))
    jvm = spark.sparkContext._jvm
    strings = getattr(sample._jdf, "as")(jvm.org.apache.spark.sql.Encoders.STRING())
    reader = spark._jsparkSession.read()
    for key, value in (options or {}).items():
        reader = reader.option(key, str(value).lower() if isinstance(value, bool) else str(value))
    inferred = reader.json(strings).schema().json()
    return T.StructType.fromJson(json.loads(inferred))


def infer_json_schema(df: DataFrame, col: str | Column, sample_size: int | None = DEFAULT_SAMPLE) -> T.StructType:
    """Schema of JSON text in ``col``, inferred from all its non-NULL
    values, or the first ``sample_size`` (the data stays distributed)."""
    c = F.col(col) if isinstance(col, str) else col
    text = df.select(c.alias("value")).filter(F.col("value").isNotNull())
    return _sample_schema(df.sparkSession, text, sample_size)


def parse_json_column(df: DataFrame, col: str, schema: T.StructType | None = None,
                      sample_size: int | None = DEFAULT_SAMPLE, keep: list[str] | None = None) -> DataFrame:
    """JSON text column -> its fields as columns, typed by ``schema`` or by
    inference.  Bad JSON gives NULL fields (never an error)."""
    schema = schema or infer_json_schema(df, col, sample_size)
    keep = [c for c in df.columns if c != col] if keep is None else keep
    parsed = F.from_json(F.col(col), schema, {"mode": "PERMISSIVE"}).alias("__doc")
    return df.select(*keep, parsed).select(*keep, "__doc.*")


def read_collection(spark: SparkSession, path: str, fmt: str = "json",
                    sample_size: int | None = DEFAULT_SAMPLE, schema: T.StructType | str | None = None,
                    options: Mapping[str, str] | None = None) -> DataFrame:
    """Load a document collection.

    ``fmt="json"`` reads JSON lines; without ``schema`` the schema is
    inferred from all lines, or the first ``sample_size``.  Self-describing formats (``parquet``,
    ``orc``) use their own schema unless a narrower one is given.  Any other
    format name (a document-store connector on the classpath) is passed
    through with its ``sampleSize`` option.
    """
    options = dict(options or {})
    reader = spark.read.options(**options)
    if schema is not None:
        return reader.schema(schema).format(fmt).load(path)
    if fmt == "json":
        inferred = _sample_schema(spark, spark.read.text(path), sample_size, options)
        return reader.schema(inferred).json(path)
    if fmt in ("parquet", "orc", "avro", "delta"):
        return reader.format(fmt).load(path)
    return reader.format(fmt).options(**({"sampleSize": str(sample_size)} if sample_size else {})).load(path)


def write_collection(df: DataFrame, path: str, fmt: str = "json", mode: str = "append",
                     options: Mapping[str, str] | None = None) -> None:
    """S3: save documents with a save mode (append, overwrite, ignore, error)."""
    df.write.format(fmt).mode(mode).options(**dict(options or {})).save(path)


def write_by_day(df: DataFrame, path: str, ts_col: str, tz: str = DEFAULT_TZ, mode: str = "append",
                 max_records_per_file: int | None = None, tasks: int | None = None) -> None:
    """S3 for daily runs: save documents as Parquet, partitioned by the day of ``ts_col``.

    Documents of one day are brought together (a very large day is split) and
    sorted by time; documents without a valid time have a partition of their own.
    ``select_run`` then reads a run's days only.  Opening a file per day is the
    work here, so tasks are not put together however small they are; ``tasks``:
    how many the days are dealt to, the session's shuffle partitions if not given.
    """
    staged = with_stored_time(df, ts_col, tz)
    day = DAY_PREFIX + ts_col
    dealt = staged.hint("rebalance", *([tasks] if tasks else []), day).sortWithinPartitions(day, stored_time(staged, ts_col))
    writer = dealt.write.mode(mode).partitionBy(day)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", str(max_records_per_file))
    with in_setting(df.sparkSession, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        writer.parquet(path)


@contextmanager
def with_views(spark: SparkSession, views: Mapping[str, DataFrame]) -> Iterator[None]:
    """Name intermediate relations for SQL callers; dropped on exit.

    ``createOrReplaceTempView`` is used so a retried job in the same session
    does not fail on a leftover name.
    """
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    try:
        yield
    finally:
        for name in views:
            spark.catalog.dropTempView(name)
