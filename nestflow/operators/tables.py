"""Cleaning and whole-table mutations.

The reference's mutations were driver-side client calls against a document
store; here they are declarative transforms of a DataFrame, so they run as
joins and unions on the executors.  No join is hinted: AQE picks a
broadcast at run time only when the measured side is small, and splits
skewed join partitions otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dedupe(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A2: DISTINCT rows over ``cols`` (all columns by default).

    A partial hash aggregate runs before the one exchange, so copies of a
    hot row collapse map-side and only one copy per map task is shuffled.
    """
    return (df.select(*cols) if cols else df).distinct()


def align(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """P5: the target's column order, chosen by name (never by position)."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing for target order: {missing}")
    return df.select(*columns)


def canonical_calls(df: DataFrame, mapping: Mapping[str, str],
                    keep: Sequence[str] = ()) -> DataFrame:
    """Rename provider fields to the canonical record (``{source: target}``)."""
    return df.select(*keep, *[F.col(src).alias(dst) for src, dst in mapping.items()])


def delete_where(df: DataFrame, pred: Column) -> DataFrame:
    """M1: remove every row matching ``pred``; a NULL predicate keeps the row."""
    return df.filter(~F.coalesce(pred, F.lit(False)))


def count_deleted(df: DataFrame, pred: Column, alias: str = "deleted") -> DataFrame:
    """M1's report: how many rows ``pred`` matches (one-row DataFrame)."""
    return df.agg(F.count_if(F.coalesce(pred, F.lit(False))).alias(alias))


def append_rows(df: DataFrame, rows: DataFrame) -> DataFrame:
    """M2: add rows (by column name; missing columns become NULL)."""
    return df.unionByName(rows, allowMissingColumns=True)


def update_by_key(df: DataFrame, changes: DataFrame, keys: Sequence[str],
                  cols: Sequence[str] | None = None, check_unique: bool = True) -> DataFrame:
    """M3: set ``cols`` of rows whose key appears in ``changes``.

    ``changes`` must hold at most one row per key.  That is verified first
    (one bounded action: a partial count per key, at most one offending key
    returned), and raises instead of multiplying rows;
    ``check_unique=False`` leaves the check out where keys are known unique.
    A matched row takes the new value even when it is NULL (so a field can
    be cleared).
    """
    keys = list(keys)
    if check_unique:
        dup = changes.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).collect()
        if dup:
            raise ValueError(f"changes hold more than one row for key {dup[0].asDict()}")
    cols = [c for c in changes.columns if c not in keys] if cols is None else list(cols)
    flag = "__nf_matched"
    new = changes.select(*keys, *[F.col(c).alias(f"__nf_new_{c}") for c in cols],
                         F.lit(True).alias(flag))
    joined = df.join(new, on=keys, how="left")
    out = [
        F.when(F.col(flag), F.col(f"__nf_new_{c}")).otherwise(F.col(c)).alias(c) if c in cols else F.col(c)
        for c in df.columns
    ]
    return joined.select(*out)


def replace_by_key(df: DataFrame, new_rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """M4: delete every row whose key appears in ``new_rows``, then insert
    ``new_rows`` (inserted even when nothing matched)."""
    keys = list(keys)
    kept = df.join(new_rows.select(*keys), on=keys, how="left_anti")
    return kept.unionByName(new_rows.select(*df.columns))
