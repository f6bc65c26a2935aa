"""Sinks (S4-S7): partition loads, full refreshes, console output.

Targets are either catalog tables (written with ``insertInto`` after the
columns are put in the table's order *by name*) or Parquet paths.  The
daily load offers ``append`` (a re-run duplicates rows) and
an idempotent ``overwrite`` that replaces only the partition being written,
also when the day has become empty, so a retried or re-run day is safe.
"""

from __future__ import annotations

import atexit
import contextlib
import re
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PARTITION_COL = "partition_time"


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder under the cluster's shared ``spark.checkpoint.dir``.

    The setting is read from the session.  Where it is unset, a session whose
    driver and executors are one process (``local[..]``, as in tests) gets a
    scratch folder of its own; on a cluster the missing setting is an error,
    because executors do not see each other's local folders.
    """
    # The configured folder itself (shared by every job on the cluster), not
    # the per-application subfolder SparkContext creates inside it.
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        import tempfile

        base = tempfile.mkdtemp(prefix="nestflow-ckpt-")
        spark.sparkContext.setCheckpointDir(base)
        base = spark.sparkContext.getCheckpointDir() or base
    base = base.rstrip("/")
    return "/".join([base, *parts]) if parts else base


_scratch_roots: dict[str, Callable[[], None]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path in this application's part of the shared folder.

    Everything below that part lives as long as the application: it is
    removed when the driver process ends, or earlier by ``drop_scratch``.
    """
    root = shared_dir(spark, "nestflow", spark.sparkContext.applicationId)
    if root not in _scratch_roots:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

        def remove(root: str = root) -> None:
            path = jvm.org.apache.hadoop.fs.Path(root)
            path.getFileSystem(conf).delete(path, True)

        _scratch_roots[root] = remove
        atexit.register(drop_scratch, root)
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def drop_scratch(root: str | None = None) -> None:
    """Remove this application's scratch folders (all of them by default)."""
    for known in list(_scratch_roots) if root is None else [root]:
        remove = _scratch_roots.pop(known, None)
        if remove is not None:
            # The JVM may already be gone when the interpreter shuts down.
            with contextlib.suppress(Exception):
                remove()


def _is_path(target: str) -> bool:
    return "/" in target or ":" in target


def _table_columns(spark: SparkSession, table: str) -> list[str]:
    return spark.table(table).columns


def load_partition(df: DataFrame, target: str, partition_value: str, mode: str = "append",
                   columns: list[str] | None = None, max_records_per_file: int | None = None) -> None:
    """Write ``df`` into the one partition ``partition_time=value``.

    ``mode="append"`` adds rows (running a day twice duplicates them, as in
    the reference); ``mode="overwrite"`` replaces that partition only.
    ``max_records_per_file`` splits large outputs into bounded files
    without a shuffle (path targets).
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"unknown mode {mode!r}")
    spark = df.sparkSession
    value = str(partition_value)
    if not re.fullmatch(r"[A-Za-z0-9_.:-]+", value):
        raise ValueError(f"partition value {value!r} may hold letters, digits and _ . : - only")
    if _is_path(target):
        # The day's own folder: an overwrite replaces it even with no rows.
        out = df.select(*columns) if columns is not None else df
        writer = out.drop(PARTITION_COL).write.mode(mode)
        if max_records_per_file:
            writer = writer.option("maxRecordsPerFile", str(max_records_per_file))
        folder = value.replace(":", "%3A")
        writer.parquet(f"{target.rstrip('/')}/{PARTITION_COL}={folder}")
        return
    # A static partition spec: OVERWRITE replaces this partition only,
    # whatever the session's partitionOverwriteMode.
    if max_records_per_file:
        raise ValueError("max_records_per_file applies to path targets only")
    cols = [c for c in _table_columns(spark, target) if c != PARTITION_COL]
    if columns is not None and set(columns) != set(cols):
        raise ValueError(f"columns {sorted(columns)} are not those of {target}: {sorted(cols)}")
    view = f"__nf_load_{uuid.uuid4().hex[:12]}"
    df.select(*cols).createOrReplaceTempView(view)
    try:
        verb = "OVERWRITE" if mode == "overwrite" else "INTO"
        select = ", ".join(f"`{c}`" for c in cols)
        spark.sql(f"INSERT {verb} TABLE {target} PARTITION ({PARTITION_COL} = '{value}') "
                  f"SELECT {select} FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def refresh_table(df: DataFrame, target: str, columns: list[str] | None = None,
                  max_records_per_file: int | None = None) -> None:
    """Replace the whole content of an unpartitioned table."""
    if _is_path(target):
        writer = (df.select(*columns) if columns else df).write.mode("overwrite")
        if max_records_per_file:
            writer = writer.option("maxRecordsPerFile", str(max_records_per_file))
        writer.parquet(target)
        return
    order = _table_columns(df.sparkSession, target)
    if max_records_per_file:
        raise ValueError("max_records_per_file applies to path targets only")
    if columns is not None and set(columns) != set(order):
        raise ValueError(f"columns {sorted(columns)} are not those of {target}: {sorted(order)}")
    df.select(*order).write.insertInto(target, overwrite=True)


def use_database(spark: SparkSession, name: str) -> None:
    """Make ``name`` the current database (qualified names are preferred)."""
    spark.catalog.setCurrentDatabase(name)


@contextlib.contextmanager
def in_database(spark: SparkSession, name: str) -> Iterator[None]:
    """S6 for a while: ``name`` is the current database, and the earlier one again afterwards."""
    earlier = spark.catalog.currentDatabase()
    use_database(spark, name)
    try:
        yield
    finally:
        use_database(spark, earlier)


@contextlib.contextmanager
def in_setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for the time of one action."""
    earlier = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if earlier is None else spark.conf.set(key, earlier)


def show_result(df: DataFrame, n: int = 20) -> None:
    """Print the first ``n`` rows untruncated (a console report)."""
    df.show(n, truncate=False)
