"""Cumulative results that are kept up instead of computed anew.

A job that loads everything created before its run day reads all history on
every day.  Where a row of the result depends on its own document only (the
period labels do: they compare a call with its document's creation time), rows
of earlier runs never change, and a run only has to add what is new.

A snapshot is a folder with a sub-folder for every run (``run=yyyyMMdd``), each
split by the day of the rows' time (``created``).  A row carries a 128-bit
hash of its columns, NULLs told apart from values.  A run

1. takes the documents from the last run's day on (or, with ``late=True``, all
   documents it is given, whenever they were created),
2. makes their rows, each different one once,
3. leaves out those whose hash an earlier run has stored, by an anti-join that
   reads the hashes of the days in question only,
4. replaces its own sub-folder, so a run that is repeated, or was lost half
   way, changes nothing else.

The snapshot of a run day is all runs up to it.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestflow.functions.clock import PARTITION_FORMAT, RunClock
from nestflow.functions.scalars import to_ts, wall_clock
from nestflow.operators.filters import before, since
from nestflow.sources.sinks import PARTITION_COL, in_setting, scratch_path

RUN_COL, CREATED_COL = "run", "created"
_HASHES = ["nf_h1", "nf_h2"]


def row_hashes(columns: Sequence[str]) -> list[Column]:
    """Two 64-bit hashes of a row; a NULL is unlike every value, wherever it stands."""
    parts = [x for c in columns for x in (F.col(c).isNull(), F.col(c))]
    return [F.xxhash64(*parts).alias(_HASHES[0]), F.xxhash64(F.lit(1), *parts).alias(_HASHES[1])]


class Snapshot:
    """The rows ``columns`` of all runs under ``path``; ``time_col`` is the creation time among them."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str, time_col: str = "create_time") -> None:
        self.spark, self.path, self.time_col = spark, path.rstrip("/"), time_col
        self.rows = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.stored = T.StructType([*self.rows.fields, *(T.StructField(h, T.LongType()) for h in _HASHES),
                                    T.StructField(RUN_COL, T.StringType()), T.StructField(CREATED_COL, T.DateType())])

    def runs(self) -> list[_dt.date]:
        """Days of the runs that were completed, oldest first."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(conf)
        if not fs.exists(root):
            return []
        found = [f.getPath() for f in fs.listStatus(root) if f.getPath().getName().startswith(f"{RUN_COL}=")]
        done = [p.getName().split("=")[1] for p in found if fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
        return sorted(_dt.datetime.strptime(x, PARTITION_FORMAT).date() for x in done)

    def _read(self, until: _dt.date, including: bool) -> DataFrame:
        own = [d for d in self.runs() if d < until or including and d == until]
        if not own:
            return self.spark.createDataFrame([], self.stored)
        folders = [f"{self.path}/{RUN_COL}={d.strftime(PARTITION_FORMAT)}" for d in own]
        return self.spark.read.option("basePath", self.path).schema(self.stored).parquet(*folders)

    def read(self, clock: RunClock) -> DataFrame:
        """The snapshot of ``clock``'s run day, tagged as a daily load is."""
        return self._read(clock.today, True).select(*self.rows.fieldNames(), F.lit(clock.partition_value).alias(PARTITION_COL))

    def new_rows(self, docs: DataFrame, rows_of: Callable[[DataFrame], DataFrame], clock: RunClock, late: bool = False) -> DataFrame:
        """What the run of ``clock`` adds: rows with their hashes and day."""
        earlier = [d for d in self.runs() if d < clock.today]
        fresh = before(docs, self.time_col, clock.today_start, clock.tz) if late or not earlier else since(docs, self.time_col, earlier[-1], clock)
        zoned = isinstance(self.rows[self.time_col].dataType, T.TimestampType)
        wall = wall_clock(self.time_col, clock.tz) if zoned else to_ts(self.time_col)
        names = self.rows.fieldNames()
        rows = rows_of(fresh).select(*names).distinct().select(*names, *row_hashes(names), wall.cast("date").alias(CREATED_COL))
        if not earlier:
            return rows
        if late:
            # The days are known once the rows are there: written, so that they are made once.
            path = scratch_path(self.spark, "late-rows")
            rows.write.parquet(path)
            rows = self.spark.read.schema(rows.schema).parquet(path)
            low, high = rows.agg(F.min(CREATED_COL), F.max(CREATED_COL)).first()
            if low is None:
                return rows
        else:
            low, high = earlier[-1], clock.yesterday
        stored = self._read(clock.today, False).where(F.col(CREATED_COL).between(F.lit(low), F.lit(high)))
        return rows.join(stored.select(*_HASHES, CREATED_COL), [*_HASHES, CREATED_COL], "left_anti").select(*names, *_HASHES, CREATED_COL)

    def advance(self, docs: DataFrame, rows_of: Callable[[DataFrame], DataFrame], clock: RunClock, late: bool = False) -> None:
        """Run once for ``clock``'s run day."""
        rows = self.new_rows(docs, rows_of, clock, late)
        # Rows of one day together, so that a day is one file or few, large days split.
        with in_setting(self.spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
            rows.hint("rebalance", CREATED_COL).write.mode("overwrite").partitionBy(CREATED_COL).parquet(f"{self.path}/{RUN_COL}={clock.today_text}")
