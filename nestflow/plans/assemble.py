"""Bounded nesting: gather rows into arrays without an unbounded group.

Building a nested document means ``collect_list`` per key.  One key (a
customer, an order, a run of identical rows) may hold a large share of all
rows, and an array of that size in one row and one task does not survive.
So elements are gathered per ``(key, chunk)``:

* a cheap pre-pass counts elements per key (a partial aggregate: one row
  per key and map task crosses the shuffle) and keeps only keys over
  ``max_elements`` -- at most ``rows / max_elements`` of them;
* that hot-key list is written to the shared folder once; Spark broadcasts it
  if its files are small enough, and joins by shuffle otherwise;
* a hot key's elements are spread over ``ceil(n / max_elements)`` chunks by a
  hash of ``spread`` columns; every other key has chunk 0, so small data
  gives exactly one group per key.  Hash spreading makes ``max_elements`` a
  target: for a key of ``n`` elements a chunk exceeds it by about
  ``sqrt(max_elements * ln(n / max_elements))`` at most (a few percent at the
  default), never by a factor that grows with ``n``.

Tasks are bounded as well: what is gathered is dealt to ``gather_tasks``
partitions, a number that grows with the rows, so a task sorts and holds about
``ROWS_PER_TASK`` of them at any size and none has to spill.

``spread`` must separate identical rows, so for a raw scan it includes the
row's position in its input split (``monotonically_increasing_id`` taken
before any shuffle: the same on a re-run of a lost task).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nestflow.sources.sinks import scratch_path

MAX_ELEMENTS = 1024
MAX_DOC_ITEMS = 65_536
# Rows that one gathering task gets, about (100 to 200 bytes each).
ROWS_PER_TASK = 1 << 17
POSITION_COL = "__pos"


@dataclass
class HotKeys:
    keys: list[str]
    table: DataFrame | None  # keys + "__nb"; None when no key is hot
    largest: int = 0         # element count of the largest key (first limit)
    total: int = 0           # element count of all keys (first limit)

    @property
    def any(self) -> bool:
        return self.table is not None


def gather_tasks(spark: SparkSession, rows: int) -> int | None:
    """Partitions for gathering ``rows`` rows, ``ROWS_PER_TASK`` each, about; None if so
    few rows need no more than one task a core: they are dealt as Spark sees fit."""
    tasks = -(-rows // ROWS_PER_TASK)
    return tasks if tasks > spark.sparkContext.defaultParallelism else None


def dealt(df: DataFrame, tasks: int | None, *cols: str) -> DataFrame:
    """``df`` dealt by ``cols`` to ``tasks`` partitions, which Spark does not put together again; as it is if None."""
    return df.repartition(tasks, *cols) if tasks else df


def find_hot_keys(count_source: DataFrame, keys: Sequence[str],
                  max_elements: int = MAX_ELEMENTS, weight: str | None = None,
                  limits: dict[str, int] | None = None) -> HotKeys:
    """Keys of ``count_source`` with more than ``max_elements`` elements, and
    how many chunks each needs.  A row is one element, or ``weight`` of them;
    ``limits`` ({weight column: bound}) bounds several sums at once, and a key
    gets as many chunks as its tightest bound asks for."""
    return find_hot_keys_many([(count_source, keys, limits or {weight or "": max_elements})])[0]


def find_hot_keys_many(specs: Sequence[tuple]) -> list[HotKeys]:
    """Several hot-key searches.  A spec is ``(source, keys, limits)``.

    One action first asks every branch (side by side) for three numbers only
    -- how many keys are hot, how large the largest key is and how large all are -- as partial
    aggregates, so no task ever receives more than one row per partition.
    A branch with hot keys then writes them, so the search runs once; none
    of them pass through the driver.
    """
    parts, metas = [], []
    for i, spec in enumerate(specs):
        source, keys, limits = spec[:3]
        keys = list(keys)
        sums = [(F.sum(w) if w else F.count(F.lit(1))).alias(f"__n{j}") for j, w in enumerate(limits)]
        need = [F.ceil(F.col(f"__n{j}") / F.lit(bound)) for j, bound in enumerate(limits.values())]
        nb = (F.greatest(*need) if len(need) > 1 else need[0]).cast("int")
        per_key = source.groupBy(*keys).agg(*sums).select(*keys, nb.alias("__nb"), "__n0")
        hot = per_key.filter(F.col("__nb") > 1).select(*keys, "__nb")
        parts.append(per_key.agg(
            F.count_if(F.col("__nb") > 1).alias("__nhot"),
            F.max("__n0").cast("long").alias("__largest"),
            F.sum("__n0").cast("long").alias("__total"),
        ).select(F.lit(i).alias("__branch"), "__nhot", "__largest", "__total"))
        metas.append((source, keys, hot))
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    stats = {r["__branch"]: r for r in union.collect()}
    out = []
    for i, (source, keys, hot) in enumerate(metas):
        n_hot = int(stats[i]["__nhot"] or 0)
        largest, total = int(stats[i]["__largest"] or 0), int(stats[i]["__total"] or 0)
        if n_hot == 0:
            out.append(HotKeys(keys, None, largest, total))
            continue
        spark, path = source.sparkSession, scratch_path(source.sparkSession, "hot-keys")
        hot.write.parquet(path)
        out.append(HotKeys(keys, spark.read.schema(hot.schema).parquet(path), largest, total))
    return out


def _join_hot(df: DataFrame, hot: HotKeys, df_keys: Sequence[str]) -> DataFrame:
    """Left join ``df`` with the hot-key table, NULL-safe (a NULL key can be
    hot too), keeping ``__nb`` and none of the table's key columns."""
    table = hot.table.select(*[F.col(k).alias(f"__hk{i}") for i, k in enumerate(hot.keys)], "__nb")
    cond = None
    for i, k in enumerate(df_keys):
        c = df[k].eqNullSafe(table[f"__hk{i}"])
        cond = c if cond is None else cond & c
    out = df.join(table, cond, "left")
    return out.drop(*[f"__hk{i}" for i in range(len(hot.keys))])


def chunks_per_key(df: DataFrame, hot: HotKeys, key_col: str, name: str = "__w") -> DataFrame:
    """``df`` with the number of chunks its ``key_col`` value was split into
    (1 unless hot) -- the weight of that key one nesting level up."""
    if not hot.any:
        return df.withColumn(name, F.lit(1))
    return (_join_hot(df, hot, [key_col])
            .withColumn(name, F.coalesce(F.col("__nb"), F.lit(1))).drop("__nb"))


def with_chunk_copies(df: DataFrame, hot: HotKeys, key_col: str, name: str = "__chunk",
                      split: str | None = None) -> DataFrame:
    """One row per chunk of the row's key (chunk 0 only unless hot): the
    other side of a salted join with chunked rows of the same key.
    ``split`` names a column that says whether the key is hot."""
    if not hot.any:
        df = df.withColumn(name, F.lit(0))
        return df.withColumn(split, F.lit(False)) if split else df
    joined = _join_hot(df, hot, [key_col])
    if split:
        joined = joined.withColumn(split, F.col("__nb").isNotNull())
    n = F.coalesce(F.col("__nb"), F.lit(1))
    return joined.withColumn(name, F.explode(F.sequence(F.lit(0), n - 1))).drop("__nb")


def with_key_totals(df: DataFrame, hot: HotKeys, source: DataFrame, totals: dict[str, Column]) -> DataFrame:
    """``df`` (pieces of keys) with aggregates over *all* rows of the key in
    ``source``, for hot keys; NULL for keys that were not split.

    The aggregates are partial before their shuffle (one row per key and
    task); NULL is a key like any other.
    """
    keys = hot.keys
    of_hot = _join_hot(source, hot, keys).filter(F.col("__nb").isNotNull())
    found = of_hot.groupBy(*[F.col(k).alias(f"__tk{i}") for i, k in enumerate(keys)]).agg(
        *[c.alias(name) for name, c in totals.items()])
    cond = [df[k].eqNullSafe(found[f"__tk{i}"]) for i, k in enumerate(keys)]
    return df.join(found, cond, "left").drop(*[f"__tk{i}" for i in range(len(keys))])


def with_position(df: DataFrame, name: str = POSITION_COL) -> DataFrame:
    """Tag rows with their input position (call right after the scan)."""
    return df.withColumn(name, F.monotonically_increasing_id())


def with_chunk(df: DataFrame, hot: HotKeys, spread: Sequence[str | Column],
               name: str = "__chunk") -> DataFrame:
    """Add the chunk number ``name`` (0 unless the row's key is hot)."""
    if not hot.any:
        return df.withColumn(name, F.lit(0))
    joined = _join_hot(df, hot, hot.keys)
    spread_cols = [F.col(c) if isinstance(c, str) else c for c in spread]
    chunk = F.coalesce(F.pmod(F.xxhash64(*spread_cols), F.col("__nb")), F.lit(0)).cast("int")
    return joined.withColumn(name, chunk).drop("__nb")
