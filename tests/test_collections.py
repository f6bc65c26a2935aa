"""Stored document collections: staged once, read narrow, filters pushed."""

from nestflow.plans import documents as D
from nestflow.plans import datasets as P
from nestflow.plans.queries import M_CLOCK
from nestflow.sources.sinks import scratch_path

SF = "/root/testdata/sf0.001"


def _plan(df):
    jvm = df.sparkSession.sparkContext._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_stage_is_idempotent_and_keyed(spark):
    a = D.stage_collection(spark, SF, "mx")
    assert D.stage_collection(spark, SF, "mx") == a
    assert D.collection_path(spark, SF, "mx") != D.collection_path(spark, "/root/testdata/sf0.01", "mx")


def test_stored_equals_built(spark):
    built = P.m_calls_flat(D.mx_documents(spark, SF))
    stored = P.m_calls_flat(D.stored_collection(spark, SF, "mx", D.M_CALLS_PATHS))
    assert built.exceptAll(stored).count() == 0 and stored.exceptAll(built).count() == 0


def test_fresh_path_staging(spark):
    path = D.stage_collection(spark, SF, "tj", path=scratch_path(spark, "tj-test"))
    assert spark.read.parquet(path).count() == D.tj_documents(spark, SF).count()


def test_daily_filter_and_narrow_schema_reach_scan(spark):
    docs = D.stored_collection(spark, SF, "mx", D.M_CALLS_PATHS)
    plan = _plan(P.provider_m_calls(docs, M_CLOCK))
    assert "PushedFilters: [IsNotNull(create_time), GreaterThanOrEqual(create_time" in plan
    # The gate reads the carried count and no bill at all.
    assert "bill_count:bigint" in plan and "bills:array" not in plan
    assert plan.count("Exchange (") == 1  # only the DISTINCT shuffles
    count_plan = _plan(P.nested_count(D.stored_collection(spark, SF, "mx", D.M_COUNT_PATHS)))
    assert "ReadSchema: struct<calls:array<struct<items:array<struct<details_id:string>>,continued:boolean>>>" in count_plan


def test_provider_t_calls_plan(spark):
    from nestflow.plans.queries import T_CLOCK

    docs = D.stored_collection(spark, SF, "tj", D.T_CALLS_PATHS)
    plan = _plan(P.provider_t_calls(docs, T_CLOCK))
    assert plan.count("Exchange (") == 1
    assert "billdata" not in plan.split("ReadSchema:")[1].split("\n")[0]


def test_no_python_evaluation_in_any_query(spark):
    import __spark_entry__ as E

    for name, q in E.queries().items():
        plan = _plan(q(spark, SF))
        for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas", "FlatMapGroupsInPandas"):
            assert node not in plan, (name, node)


def test_publish_never_nests(spark):
    import os

    a = D.stage_collection(spark, SF, "real_names", path=scratch_path(spark, "pub"))
    other = scratch_path(spark, "pub-other")
    D.real_names(spark, SF).write.parquet(other)
    assert D._publish(spark, other, a) is False  # target exists: refused
    local = a.replace("file:", "")
    assert not any(n.startswith("pub-other") for n in os.listdir(local))
    assert D.stage_collection(spark, SF, "real_names", path=a) == a
