"""Period tagging: the boundary table of FIXTURES.md section 3, both routes."""

import pytest
from pyspark.sql import functions as F

from nestflow.functions.periods import day_divide, period_fanout, time_parse

CREATE = "2018-07-15 10:00:00"

# time -> expected labels (empty set: no rows)
BOUNDARIES = [
    ("2018-07-15 10:00:00", {"-1"}),
    ("2018-07-15 09:59:59", {"30", "60", "90"}),
    ("2018-07-01 00:00:00", {"30", "60", "90"}),
    ("2018-06-30 23:59:59", {"30", "60", "90", "150"}),
    ("2018-06-15 10:00:00", {"60", "90", "150"}),
    ("2018-06-01 00:00:00", {"60", "90"}),
    ("2018-05-16 10:00:00", {"90", "150"}),
    ("2018-03-01 00:00:01", {"150"}),
    ("2018-03-01 00:00:00", set()),
    ("2018-01-16 10:00:00", {"-1"}),
    ("2018-01-16 10:00:01", {"150"}),
    ("2017-01-01 00:00:00", {"-1"}),
    (None, set()),
    ("bad", set()),
    ("2018-07-20 00:00:00", {"-1"}),       # after creation
    ("2018-07-15 09:59:59.9", {"30", "60", "90"}),  # fraction dropped
]


def _frame(spark, as_timestamp):
    rows = [(i, t) for i, (t, _) in enumerate(BOUNDARIES)]
    df = spark.createDataFrame(rows, "id int, time string").withColumn("create_time", F.lit(CREATE))
    if as_timestamp:
        df = df.withColumn("time", F.col("time").try_cast("timestamp_ntz")).withColumn(
            "create_time", F.col("create_time").cast("timestamp_ntz"))
    return df


@pytest.mark.parametrize("method", ["native", "tokens"])
@pytest.mark.parametrize("as_timestamp", [False, True])
def test_boundaries(spark, method, as_timestamp):
    out = period_fanout(_frame(spark, as_timestamp), "time", "create_time", method=method)
    got = {}
    for r in out.collect():
        got.setdefault(r.id, set()).add(r.type)
    for i, (t, expected) in enumerate(BOUNDARIES):
        assert got.get(i, set()) == expected, (t, got.get(i))


def test_keep_outside_false(spark):
    out = period_fanout(_frame(spark, False), "time", "create_time", keep_outside=False)
    assert "-1" not in {r.type for r in out.collect()}


def test_day_divide_tokens(spark):
    df = _frame(spark, False).select("id", day_divide("create_time", "time").alias("tok"))
    tok = {r.id: r.tok for r in df.collect()}
    assert tok[1] == "30,60,90,180"
    assert tok[4] == "60,90,180"
    assert tok[6] == "90,180"
    assert tok[7] == "180"
    assert tok[0] == "0" and tok[11] == "0"
    assert tok[12] is None and tok[13] is None


def test_time_parse_relabels(spark):
    df = spark.createDataFrame([("30",), ("60",), ("90",), ("0",), ("180",)], "tok string")
    df = df.withColumn("c", F.lit(CREATE)).withColumn("t", F.lit("2018-03-01 00:00:00"))
    got = {r.tok: r.lab for r in df.select("tok", time_parse("tok", "c", "t").alias("lab")).collect()}
    assert got == {"30": "30", "60": "60", "90": "90", "0": "-1", "180": "0"}


def test_native_form_has_no_python(spark):
    out = period_fanout(_frame(spark, True), "time", "create_time")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "Generate" in plan


def test_period_labels_column_matches_fanout(spark):
    from nestflow.functions.periods import period_labels

    df = _frame(spark, True)
    arrays = {r.id: set(r.l or []) for r in df.select("id", period_labels("create_time", "time").alias("l")).collect()}
    for i, (t, expected) in enumerate(BOUNDARIES):
        assert arrays[i] == expected, (t, arrays[i])
