from nestflow.plans import datasets as P
from nestflow.plans import documents as D
from nestflow.plans.jobs import provider_m_job, provider_t_job
from nestflow.plans.queries import EVENTS_CLOCK, M_CLOCK, T_CLOCK
from nestflow.sources.sinks import scratch_path

SF = "/root/testdata/sf0.001"


def _targets(spark, names):
    return {n: scratch_path(spark, f"job-{n}") for n in names}


def test_provider_m_job_loads_and_reruns_idempotently(spark):
    docs = D.stored_collection(spark, SF, "mx")
    t = _targets(spark, ["contacts", "real_names", "bills", "calls"])
    for _ in range(2):  # a re-run of the day with overwrite changes nothing
        provider_m_job(docs, D.contacts(spark, SF), D.real_names(spark, SF), M_CLOCK, t, mode="overwrite")
    assert spark.read.parquet(t["calls"]).count() == P.provider_m_calls(docs, M_CLOCK).count() > 0
    assert spark.read.parquet(t["bills"]).count() == P.provider_m_bills(docs, M_CLOCK).count()
    assert spark.read.parquet(t["real_names"]).count() == D.real_names(spark, SF).count()
    assert {str(r.partition_time) for r in spark.read.parquet(t["calls"]).collect()} == {"20010728"}


def test_provider_t_job_append_twice_doubles(spark):
    docs = D.stored_collection(spark, SF, "tj")
    t = _targets(spark, ["bills", "calls"])
    provider_t_job(docs, T_CLOCK, t)
    provider_t_job(docs, T_CLOCK, t)
    n = P.provider_t_calls(docs, T_CLOCK).count()
    assert spark.read.parquet(t["calls"]).count() == 2 * n > 0
    assert EVENTS_CLOCK.partition_value == "20240114"
