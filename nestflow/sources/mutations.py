"""Mutations of stored, partitioned tables that rewrite touched partitions only.

The table operators (:mod:`nestflow.operators.tables`) give a whole new table.
A stored table of many partitions, of which a change concerns few, is changed
in place: a semi-join on keys and partition values alone (two narrow columns
are read) finds the partitions that hold a changed row, these are rewritten by
the operator, and all others are neither read nor written.

The new rows are first written to the shared scratch folder, then put in place
of the partitions by one dynamic partition overwrite; a partition that is left
without rows is emptied.  Every mutation may be repeated after a failure and
then gives the same table.  The partition column is read as text, so
values like ``01`` stay as they are.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestflow.operators.tables import delete_where, replace_by_key, update_by_key
from nestflow.sources.sinks import PARTITION_COL, scratch_path


def read_partitioned(spark: SparkSession, path: str, part_col: str = PARTITION_COL) -> DataFrame:
    """The table, its partition column as text and last."""
    schema = spark.read.parquet(path).schema
    *data, last = schema.fields  # partition columns come last
    if last.name != part_col:
        raise ValueError(f"{path} has no partition column {part_col!r}")
    return spark.read.schema(T.StructType([*data, T.StructField(part_col, T.StringType())])).parquet(path)


def _values(rows: DataFrame, part_col: str) -> list[str | None]:
    """Partition values, NULL included: at most one for each folder of the table."""
    return [r[0] for r in rows.select(part_col).distinct().collect()]


def _in(part_col: str, values: Sequence[str | None]) -> Column:
    test = F.col(part_col).isin([v for v in values if v is not None])
    return test | F.col(part_col).isNull() if None in values else test


def _rewrite(table: DataFrame, path: str, values: list[str | None], changed: Callable[[DataFrame], DataFrame], part_col: str) -> None:
    spark = table.sparkSession
    if not values:
        return
    scratch = scratch_path(spark, "rewritten")
    changed(table.filter(_in(part_col, values))).select(*table.columns).write.parquet(scratch)
    new = spark.read.schema(table.schema).parquet(scratch)
    new.repartition(part_col).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part_col).parquet(path)
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    for value in set(values) - set(_values(new, part_col)):
        folder = escape.getPartitionPathString(part_col, value)
        new.limit(0).drop(part_col).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{folder}")


def _touched(table: DataFrame, keys: Sequence[str], rows: DataFrame, part_col: str) -> list[str | None]:
    return _values(table.select(*keys, part_col).join(rows.select(*keys).distinct(), list(keys), "left_semi"), part_col)


def update_touched(spark: SparkSession, path: str, changes: DataFrame, keys: Sequence[str], cols: Sequence[str] | None = None,
                   part_col: str = PARTITION_COL, check_unique: bool = True) -> list[str | None]:
    """M3 in place: ``update_by_key`` in the partitions that hold a key of ``changes``; those partitions' values.

    A row stays in its partition, so the partition column is no column to set.
    """
    cols = [c for c in changes.columns if c not in keys] if cols is None else list(cols)
    if part_col in cols:
        raise ValueError(f"a row's {part_col} cannot be set: replace the row instead")
    table = read_partitioned(spark, path, part_col)
    values = _touched(table, keys, changes, part_col)
    _rewrite(table, path, values, lambda rows: update_by_key(rows, changes, keys, cols, check_unique), part_col)
    return values


def delete_touched(spark: SparkSession, path: str, pred: Column, part_col: str = PARTITION_COL) -> list[str | None]:
    """M1 in place: ``delete_where`` in the partitions that hold a matching row; those partitions' values."""
    table = read_partitioned(spark, path, part_col)
    values = _values(table.filter(F.coalesce(pred, F.lit(False))), part_col)
    _rewrite(table, path, values, lambda rows: delete_where(rows, pred), part_col)
    return values


def replace_touched(spark: SparkSession, path: str, new_rows: DataFrame, keys: Sequence[str], part_col: str = PARTITION_COL) -> list[str | None]:
    """M4 in place: ``replace_by_key`` in the partitions that hold a key of ``new_rows`` or get a new row; those partitions' values."""
    table = read_partitioned(spark, path, part_col)
    new_rows = new_rows.withColumn(part_col, F.col(part_col).cast("string"))
    values = sorted(set(_touched(table, keys, new_rows, part_col)) | set(_values(new_rows, part_col)), key=lambda v: (v is None, v or ""))
    _rewrite(table, path, values, lambda rows: replace_by_key(rows, new_rows, keys), part_col)
    return values
