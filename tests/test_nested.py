"""Nesting cases of FIXTURES.md section 4 (hand-made documents)."""

import json

import pytest

from nestflow.functions.clock import RunClock
from nestflow.operators.nested import count_nested, require_nonempty, split_explode, unnest, unnest_path
from nestflow.plans import datasets as P

M_SCHEMA = ("mobile string, user_id string, create_time string, "
            "calls array<struct<items: array<struct<peer_number: string, details_id: string, "
            "dial_type: string, duration: int, time: string>>>>, "
            "bills array<struct<total_fee: int, bill_month: string>>")
CREATE = "2018-07-15 10:00:00"


def call(i, time="2018-07-10 10:00:00"):
    return {"peer_number": f"p{i}", "details_id": f"d{i}", "dial_type": "A", "duration": i, "time": time}


BILL = {"total_fee": 5, "bill_month": "2018-06"}


def m_docs(spark, docs):
    rows = [json.dumps(d) for d in docs]
    return spark.read.schema(M_SCHEMA).json(spark.sparkContext.parallelize(rows, 1))


@pytest.fixture
def mdocs(spark):
    return m_docs(spark, [
        {"mobile": "1", "user_id": "u1", "create_time": CREATE, "calls": None, "bills": [BILL]},
        {"mobile": "2", "user_id": "u2", "create_time": CREATE, "calls": [], "bills": [BILL]},
        {"mobile": "3", "user_id": "u3", "create_time": CREATE, "calls": [{"items": None}], "bills": [BILL]},
        {"mobile": "4", "user_id": "u4", "create_time": CREATE, "calls": [{"items": []}], "bills": [BILL]},
        {"mobile": "5", "user_id": "u5", "create_time": CREATE,
         "calls": [{"items": [call(1)]}, {"items": None}], "bills": [BILL]},
        {"mobile": "6", "user_id": "u6", "create_time": CREATE, "calls": [{"items": [call(2)]}], "bills": None},
        {"mobile": "7", "user_id": "u7", "create_time": CREATE, "calls": [{"items": [call(3)]}], "bills": []},
        {"mobile": "8", "user_id": "u8", "create_time": CREATE, "calls": [{"items": [call(4)]}],
         "bills": [BILL, BILL, BILL]},
        {"mobile": "9", "user_id": "u9", "create_time": CREATE, "calls": [{"items": [call(5)]}], "bills": [None]},
        {"mobile": "10", "user_id": "u10", "create_time": CREATE,
         "calls": [{"items": [call(6), call(6)]}], "bills": [BILL, BILL]},
    ])


def test_two_level_unnest_keeps_good_sibling(mdocs):
    flat = P.m_calls_flat(mdocs)
    assert sorted(r.mobile for r in flat.collect()) == ["10", "10", "5", "6", "7", "8", "9"]


def test_gate_and_distinct(spark, mdocs):
    clock = RunClock.of("2018-07-16")
    out = P.provider_m_calls(mdocs, clock)
    got = {}
    for r in out.collect():
        got.setdefault(r.mobile, []).append(r.type)
    # 6 (bills null) and 7 (bills empty) are gated out; 8 not tripled; [null] passes.
    assert set(got) == {"5", "8", "9", "10"}
    assert sorted(got["8"]) == ["30", "60", "90"]
    assert sorted(got["10"]) == ["30", "60", "90"]  # identical calls -> one row per label
    assert {r.partition_time for r in out.collect()} == {"20180715"}


def test_gate_equals_exploded_bills(spark, mdocs):
    from pyspark.sql import functions as F

    lit = (mdocs.select("mobile", "calls", F.explode("bills").alias("b")).drop("b").distinct())
    assert sorted(r.mobile for r in lit.collect()) == sorted(
        r.mobile for r in require_nonempty(mdocs, "bills").select("mobile", "calls").collect())


def test_bills_rows_not_deduplicated(mdocs):
    out = P.provider_m_bills(mdocs, RunClock.of("2018-07-16"))
    assert sum(1 for r in out.collect() if r.mobile == "10") == 2
    assert sum(1 for r in out.collect() if r.mobile == "9") == 1  # a null bill is a row of NULLs


def test_m_bill_fee_null_stays_null(spark):
    docs = m_docs(spark, [{"mobile": "1", "user_id": "u", "create_time": CREATE, "calls": [],
                           "bills": [{"total_fee": None, "bill_month": "2018-06"}, BILL]}])
    fees = sorted((r.total_fee is None, r.total_fee) for r in P.provider_m_bills(docs, RunClock.of("2018-07-16")).collect())
    assert fees == [(False, 5), (True, None)]


def test_count_nested_counts_groups(mdocs):
    # groups with non-null items: 4 ([]), 5 (one of two), 6, 7, 8, 9, 10
    assert count_nested(mdocs, "calls.items", "details_id").first()["count"] == 7


T_SCHEMA = ("user_id string, create_time string, wd_api_mobilephone_getdatav2_response struct<data: struct<"
            "data_list: array<struct<userdata: struct<phone: string>, teldata: array<struct<items: array<struct<"
            "call_time: string, receive_phone: string, call_type: string, trade_time: string>>>>, "
            "billdata: array<struct<pay_fee: string, month: string>>>>>>")


def test_three_level_two_phones(spark):
    def el(phone, n, fees):
        items = [{"call_time": "2018-07-01 08:00:00", "receive_phone": f"r{i}", "call_type": "O",
                  "trade_time": f"{i}.5"} for i in range(n)]
        return {"userdata": {"phone": phone}, "teldata": [{"items": items}, {"items": None}],
                "billdata": [{"pay_fee": f, "month": "2018-06"} for f in fees]}

    doc = {"user_id": "u", "create_time": CREATE, "wd_api_mobilephone_getdatav2_response": {
        "data": {"data_list": [el("A", 2, ["12", "abc"]), el("B", 1, [None, "-12.9", "12.5"])]}}}
    docs = spark.read.schema(T_SCHEMA).json(spark.sparkContext.parallelize([json.dumps(doc)], 1))
    calls = P.provider_t_calls(docs, RunClock.of("2018-07-16"))
    rows = calls.collect()
    assert {r.mobile for r in rows} == {"A", "B"}
    assert {(r.mobile, r.duration) for r in rows} == {("A", 0), ("A", 1), ("B", 0)}
    bills = P.provider_t_bills(docs, RunClock.of("2018-07-16"))
    assert sorted((r.mobile, r.total_fee) for r in bills.collect()) == [
        ("A", 0), ("A", 12), ("B", -12), ("B", 0), ("B", 12)]
    # snapshot bound: a document created on the run day is not loaded
    assert P.provider_t_bills(docs, RunClock.of("2018-07-15")).count() == 0


def test_unnest_path_generic(spark):
    docs = spark.createDataFrame([(1, [[1, 2], None, []]), (2, None)], "k int, a array<array<int>>")
    assert sorted(r.v for r in unnest(docs, "a", "v", depth=2).collect()) == [1, 2]
    s = spark.createDataFrame([(1, [{"x": [{"y": 1}, {"y": 2}], "n": "p"}])],
                              "k int, a array<struct<x: array<struct<y: int>>, n: string>>")
    out = unnest_path(s, ["a", "x"], keep=["k"], carry={0: {"name": "n"}, 1: {"y": "y"}})
    assert sorted((r.name, r.y) for r in out.collect()) == [("p", 1), ("p", 2)]


def test_split_explode_null(spark):
    df = spark.createDataFrame([(1, "a,b"), (2, None)], "k int, s string")
    assert [(r.k, r.t) for r in split_explode(df, "s", "t").collect()] == [(1, "a"), (1, "b")]


def test_selection_modes(spark, mdocs):
    from pyspark.sql import functions as F

    older = mdocs.withColumn("create_time", F.when(F.col("mobile") == "8", F.lit("2018-07-01 10:00:00"))
                             .otherwise(F.col("create_time")))
    clock = RunClock.of("2018-07-16")
    inc = {r.mobile for r in P.provider_m_calls(older, clock).collect()}
    snap = {r.mobile for r in P.provider_m_calls(older, clock, selection="snapshot").collect()}
    assert inc == {"5", "9", "10"} and snap == {"5", "8", "9", "10"}
    import pytest

    with pytest.raises(ValueError):
        P.provider_m_calls(older, clock, selection="weekly")
