import json
import os

from nestflow.functions.clock import RunClock
from nestflow.plans import datasets as P
from nestflow.sources.sinks import scratch_path
from nestflow.streaming import run_incremental

SCHEMA = "userId string, phone string, gmtCreate timestamp_ntz"


def _land(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        for r in rows:
            f.write(json.dumps(r) + "\n")


def test_incremental_contacts(spark):
    base = scratch_path(spark, "stream").replace("file:", "")
    landing, target, ckpt = f"{base}/landing", f"{base}/target", f"{base}/ckpt"
    clock = RunClock.of("2024-01-15")
    pipeline = lambda df: P.contacts_increment(df, clock)
    _land(landing, "a.json", [{"userId": "1", "phone": "p1", "gmtCreate": "2024-01-14 08:00:00"},
                              {"userId": "2", "phone": "p2", "gmtCreate": "2024-01-14 00:00:00"}])
    assert run_incremental(spark, landing, SCHEMA, pipeline, target, ckpt) == 1
    _land(landing, "b.json", [{"userId": "3", "phone": "p3", "gmtCreate": "2024-01-14 09:00:00"}])
    run_incremental(spark, landing, SCHEMA, pipeline, target, ckpt)
    # a re-run with nothing new adds nothing
    run_incremental(spark, landing, SCHEMA, pipeline, target, ckpt)
    rows = spark.read.parquet(target).collect()
    assert sorted(r.userId for r in rows) == ["1", "3"]  # midnight row lost, as in the batch job
    assert {str(r.partition_time) for r in rows} == {"20240114"}


def test_retried_batch_is_not_duplicated(spark):
    from nestflow.streaming.incremental import write_batch_output

    target = scratch_path(spark, "retry")
    out = spark.createDataFrame([("1", "p", "20240114"), ("2", "q", "20240114")],
                                "userId string, phone string, partition_time string")
    write_batch_output(out, target, 0)
    write_batch_output(out.limit(1), target, 1)
    write_batch_output(out.limit(1), target, 1)   # batch 1 retried
    write_batch_output(out, target, 0)            # batch 0 replayed
    assert spark.read.parquet(target).count() == 3


def test_incremental_nested_documents_match_batch(spark):
    from nestflow.plans import documents as D
    from nestflow.plans.queries import M_CLOCK
    from nestflow.sources.schemas import narrow_schema

    sf = "/root/testdata/sf0.001"
    base = scratch_path(spark, "stream-m")
    landing, target = f"{base}/landing", f"{base}/target"
    docs = D.mx_documents(spark, sf)
    docs.write.json(landing)  # documents arrive as JSON lines
    pipeline = lambda df: P.provider_m_calls(df, M_CLOCK)
    run_incremental(spark, landing, narrow_schema(docs.schema, D.M_CALLS_PATHS),
                    pipeline, target, f"{base}/ckpt")
    streamed = spark.read.parquet(target).drop("partition_time", "__batch")
    batch = P.provider_m_calls(docs, M_CLOCK).drop("partition_time")
    assert streamed.count() == batch.count() > 0
    assert streamed.exceptAll(batch).count() == 0


def test_distinct_across_batches(spark):
    base = scratch_path(spark, "stream-distinct").replace("file:", "")
    landing, target = f"{base}/landing", f"{base}/target"
    clock = RunClock.of("2024-01-15")
    pipeline = lambda df: P.contacts_increment(df, clock).distinct()
    rows = [{"userId": "1", "phone": "p1", "gmtCreate": "2024-01-14 08:00:00"}, {"userId": "2", "gmtCreate": "2024-01-14 08:00:00"}]
    for name in ("a.json", "b.json", "c.json"):
        _land(landing, name, rows + [{"userId": name, "phone": "p", "gmtCreate": "2024-01-14 09:00:00"}])
    assert run_incremental(spark, landing, SCHEMA, pipeline, target, f"{base}/ckpt", max_files_per_trigger=1, distinct=True) == 3
    got = sorted((r.userId, r.phone) for r in spark.read.parquet(target).collect() if r.userId in ("1", "2"))
    assert got == [("1", "p1"), ("2", None)] and spark.read.parquet(target).count() == 5
