"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nestflow.sources.sinks import scratch_path

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = os.path.realpath(tempfile.mkdtemp(prefix="nestflow-code-"))
    archive = os.path.join(folder, "nestflow_code.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for top, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(top, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it again.

    Cuts the lineage: whatever executor is lost later, the rows are there.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(name: str, columns: Iterable[str]) -> str:
    """``name``, made longer until no column has it (names differ in more than case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_or_empty(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def in_arrow(df: DataFrame, function, schema: str) -> DataFrame:
    """``mapInArrow`` with this package on the workers, which give memory back when a task ends."""
    ship(df.sparkSession)

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(found)
        finally:
            give_back()

    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Return this process's free memory to the system.

    A Python worker lives on after its task, idle beside the JVM's work in later stages; what the
    task has freed stays with the process otherwise.
    """
    pa.default_memory_pool().release_unused()
    if hasattr(_c_library(), "malloc_trim"):  # the GNU library's
        _c_library().malloc_trim(0)


@lru_cache(None)
def _c_library() -> ctypes.CDLL:
    return ctypes.CDLL(None)


def batches(rows: Iterable[tuple], schema: pa.Schema, max_rows: int = 2000,
            max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Record batches of bounded size from row tuples."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += sum(len(x) if isinstance(x, (bytes, str)) else 8 for x in row)
        if len(held) >= max_rows or size >= max_bytes:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(values, type=field.type) for values, field in zip(zip(*rows), schema)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, as a lambda variable."""
    return F.transform(F.array(value), body)[0]
