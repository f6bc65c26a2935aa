"""Run a document pipeline incrementally over a landing folder.

The reference's jobs are daily batches over a whole collection.  When new
documents land as files, the same DataFrame -> DataFrame pipelines can run
on only the new files: a file stream with the collection's fixed schema
(streams never infer), ``trigger(availableNow=True)`` to process what is
there and stop, a checkpoint in the cluster's shared folder so a restarted
or re-run job resumes after the last committed batch, and ``foreachBatch``
to write each batch with the batch sinks.

Each micro-batch is a plain batch DataFrame, so DISTINCT inside a pipeline
de-duplicates within one batch; ``distinct=True`` also leaves out the rows that
earlier batches have written to the same partition, as one batch over all files
would.  Batches of one day add to each other; each
batch writes its own ``__batch`` sub-partition, replaced if the batch is
retried, so a lost executor or a restarted stream never duplicates rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestflow.sources.sinks import PARTITION_COL, shared_dir


BATCH_COL = "__batch"


def _not_yet_written(out: DataFrame, target: str, batch_id: int) -> DataFrame:
    """Rows of ``out`` that no earlier batch has written, each once (NULLs are equal).

    Both sides are hashed on all columns; files of other days are pruned by the partition.
    """
    spark = out.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return out.distinct()
    stored = T.StructType([*out.schema.fields, T.StructField(BATCH_COL, T.IntegerType())])
    earlier = spark.read.schema(stored).parquet(target).filter(F.col(BATCH_COL) < batch_id).drop(BATCH_COL)
    earlier = earlier.select(*[F.col(c).alias(f"__{c}") for c in out.columns])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in out.columns])
    return out.distinct().join(earlier, same, "left_anti")


def write_batch_output(out: DataFrame, target: str, batch_id: int, distinct: bool = False) -> None:
    """Write one micro-batch idempotently: it owns the partitions
    ``(partition_time, __batch=batch_id)`` and replaces them on a retry, so
    the at-least-once ``foreachBatch`` becomes exactly-once in the table."""
    if distinct:
        out = _not_yet_written(out, target, batch_id)
    parts = [PARTITION_COL, BATCH_COL] if PARTITION_COL in out.columns else [BATCH_COL]
    (out.withColumn(BATCH_COL, F.lit(int(batch_id))).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(target))


def run_incremental(spark: SparkSession, source: str, schema: T.StructType | str,
                    pipeline: Callable[[DataFrame], DataFrame], target: str,
                    checkpoint: str | None = None, fmt: str = "json",
                    max_files_per_trigger: int | None = None, distinct: bool = False) -> int:
    """Process all files now in ``source`` not yet committed; returns the
    number of micro-batches run.  ``pipeline`` output may carry
    ``partition_time`` (the daily pipelines do); rows are appended to that
    partition of ``target``.  ``distinct``: no row is written twice, whatever
    files and batches its copies come in."""
    checkpoint = checkpoint or shared_dir(spark, "nestflow", "streams", hashlib.sha1(target.encode()).hexdigest())
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    batches = []

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        write_batch_output(pipeline(batch), target, batch_id, distinct)
        batches.append(batch_id)

    query = (reader.load(source).writeStream.foreachBatch(write_batch)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return len(batches)
