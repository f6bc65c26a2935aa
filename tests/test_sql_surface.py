"""The registered SQL functions give the same rows as the native operators."""

from pyspark.sql import functions as F

from nestflow.functions.periods import period_fanout, time_parse
from nestflow.functions.sql import register_sql_functions
from nestflow.operators.filters import drop_label
from nestflow.operators.nested import split_explode
from nestflow.plans import datasets as P
from nestflow.plans.documents import mx_documents

SF = "/root/testdata/sf0.001"


def test_sql_functions_match_native(spark):
    register_sql_functions(spark)
    flat = P.m_calls_flat(mx_documents(spark, SF)).withColumns(
        {c: F.col(c).cast("string") for c in ("time", "create_time")})
    names = ("nf_calls", "nf_tokens")
    try:
        flat.createOrReplaceTempView(names[0])
        divided = spark.sql("SELECT *, day_divide(unix_timestamp(create_time), unix_timestamp(time)) AS tokens FROM nf_calls")
        split_explode(divided, "tokens", "token").createOrReplaceTempView(names[1])
        parsed = spark.sql("SELECT *, time_parse(token, create_time, time, unix_timestamp(time)) AS type FROM nf_tokens")
        native = period_fanout(flat, "time", "create_time")
        tagged = drop_label(parsed, "type").select(*native.columns)
        assert tagged.count() == native.count() > 0
        assert tagged.exceptAll(native).count() == 0 and native.exceptAll(tagged).count() == 0
        plan = tagged._jdf.queryExecution().executedPlan().toString()
        assert "PythonUDF" not in plan and "ScalaUDF" not in plan
    finally:
        for name in names:
            spark.catalog.dropTempView(name)


def test_time_parse_null_time(spark):
    df = spark.sql("SELECT '30' AS token, '2024-01-01 00:00:00' AS c, CAST(NULL AS STRING) AS t")
    assert df.select(time_parse("token", "c", "t").alias("x")).first().x is None


def test_sql_functions_nulls_and_yesterday(spark):
    register_sql_functions(spark)
    r = spark.sql("SELECT day_divide(NULL, 1) a, day_divide(100, 100) b, time_parse('30', 'x', 'y', NULL) c, "
                  "time_parse('0', 'x', 'y', 5) d, yesterday() = date_sub(current_date(), 1) e").first()
    assert (r.a, r.b, r.c, r.d, r.e) == (None, "0", None, "-1", True)
