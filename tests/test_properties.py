"""Property tests: the Spark operators against brute-force Python statements
of the rules, on times drawn around every boundary."""

import datetime as dt
from decimal import Decimal, InvalidOperation

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from nestflow.functions.periods import day_divide, period_fanout, time_parse
from nestflow.functions.scalars import to_int

DAY = dt.timedelta(days=1)


def month_start(x):
    return x.replace(day=1, hour=0, minute=0, second=0, microsecond=0)


def expected_labels(c, t):
    if c is None or t is None:
        return set()
    c, t = c.replace(microsecond=0), t.replace(microsecond=0)
    if not (c - 180 * DAY < t < c):
        return {"-1"}
    out = {str(d) for d in (30, 60, 90) if c - d * DAY < t < c}
    if month_start(t) < t < month_start(c):
        out.add("150")
    return out


creates = st.datetimes(min_value=dt.datetime(2000, 1, 1), max_value=dt.datetime(2030, 12, 31))


@st.composite
def pair(draw):
    c = draw(creates)
    kind = draw(st.sampled_from(["days", "month", "free", "null"]))
    if kind == "days":
        t = c - draw(st.sampled_from([0, 30, 60, 90, 180, 200])) * DAY \
            + dt.timedelta(seconds=draw(st.sampled_from([-1, 0, 1])))
    elif kind == "month":
        base = month_start(c - draw(st.integers(0, 7)) * 30 * DAY)
        t = base + dt.timedelta(seconds=draw(st.sampled_from([-1, 0, 1])),
                                microseconds=draw(st.sampled_from([0, 500_000])))
    elif kind == "free":
        t = c - dt.timedelta(seconds=draw(st.integers(-86_400 * 10, 86_400 * 400)))
    else:
        t = None
    return c, t


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(pair(), min_size=20, max_size=60))
def test_period_fanout_matches_rules(spark, pairs):
    rows = [(i, c, t) for i, (c, t) in enumerate(pairs)]
    df = spark.createDataFrame(rows, "id int, c timestamp_ntz, t timestamp_ntz")
    got = {}
    for r in period_fanout(df, "t", "c").collect():
        got.setdefault(r.id, set()).add(r.type)
    literal = {}
    for r in period_fanout(df, "t", "c", method="tokens").collect():
        literal.setdefault(r.id, set()).add(r.type)
    for i, c, t in rows:
        assert got.get(i, set()) == expected_labels(c, t) == literal.get(i, set()), (c, t)


def expected_tokens(c, t):
    if c is None or t is None:
        return None
    c, t = c.replace(microsecond=0), t.replace(microsecond=0)
    for i, d in enumerate((30, 60, 90, 180)):
        if c - d * DAY < t < c:
            return ",".join(str(x) for x in (30, 60, 90, 180)[i:])
    return "0"


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(pair(), min_size=20, max_size=60))
def test_day_divide_and_time_parse_match_rules(spark, pairs):
    rows = [(i, c, t) for i, (c, t) in enumerate(pairs)]
    df = spark.createDataFrame(rows, "id int, c timestamp_ntz, t timestamp_ntz")
    out = df.select("id", "c", "t", day_divide("c", "t").alias("tok"),
                    time_parse(F.lit("180"), "c", "t").alias("m")).collect()
    for r in out:
        assert r.tok == expected_tokens(r.c, r.t), (r.c, r.t)
        if r.c is not None and r.t is not None:
            c, t = r.c.replace(microsecond=0), r.t.replace(microsecond=0)
            assert r.m == ("150" if month_start(t) < t < month_start(c) else "0")


def expected_int(s):
    """Spark 2's text-to-int: optional sign, digits, optional fraction
    (truncated), surrounding spaces; anything else or overflow is NULL."""
    if s is None:
        return None
    body = s.strip()
    sign = -1 if body.startswith("-") else 1
    body = body[1:] if body[:1] in "+-" else body
    whole, _, frac = body.partition(".")
    digits = set("0123456789")  # ASCII only, as the JVM's parser
    if not body or not set(whole + frac) <= digits or (not whole and not frac):
        return None
    try:
        v = int(Decimal(whole or "0")) * sign
    except InvalidOperation:
        return None
    return v if -2**31 <= v < 2**31 else None


texts = st.one_of(
    st.none(),
    st.from_regex(r"\A ?[+-]?[0-9]{1,12}(\.[0-9]{0,8})? ?\Z"),
    st.text(alphabet="0123456789.-+ eE", max_size=8),
)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(texts, min_size=10, max_size=40))
def test_to_int_matches_rules(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, s string")
    for r in df.select("id", "s", to_int("s").alias("v")).collect():
        assert r.v == expected_int(r.s), repr(r.s)


item = st.fixed_dictionaries({
    "peer_number": st.sampled_from(["p1", "p2"]), "details_id": st.sampled_from(["d1", "d2", "d3"]),
    "dial_type": st.just("A"), "duration": st.integers(0, 3),
    "time": st.sampled_from(["2018-07-10 10:00:00", "2018-03-01 00:00:00", "2017-01-01 00:00:00", None]),
})
group = st.fixed_dictionaries({"items": st.one_of(st.none(), st.lists(item, max_size=3))})
bill = st.one_of(st.none(), st.fixed_dictionaries({"total_fee": st.integers(0, 9), "bill_month": st.just("2018-06")}))
doc = st.fixed_dictionaries({
    "mobile": st.sampled_from(["1", "2", "3"]), "user_id": st.just("u"),
    "create_time": st.sampled_from(["2018-07-15 10:00:00", "2018-07-14 23:59:59", "2018-07-15 00:00:00"]),
    "calls": st.one_of(st.none(), st.lists(group, max_size=3)),
    "bills": st.one_of(st.none(), st.lists(bill, max_size=2)),
})


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(doc, min_size=1, max_size=12))
def test_m_calls_match_brute_force(spark, docs):
    import json

    from nestflow.functions.clock import RunClock
    from nestflow.plans import datasets as P

    schema = ("mobile string, user_id string, create_time string, calls array<struct<items: array<struct<"
              "peer_number: string, details_id: string, dial_type: string, duration: int, time: string>>>>, "
              "bills array<struct<total_fee: int, bill_month: string>>")
    df = spark.read.schema(schema).json(spark.sparkContext.parallelize([json.dumps(d) for d in docs], 1))
    clock = RunClock.of("2018-07-15")  # the day 2018-07-14, open at both ends
    got = sorted(tuple(r) for r in P.provider_m_calls(df, clock).drop("partition_time").collect())

    want = set()
    for d in docs:
        c = dt.datetime.fromisoformat(d["create_time"])
        if not (dt.datetime(2018, 7, 14) < c < dt.datetime(2018, 7, 15)) or not d["bills"]:
            continue
        for g in d["calls"] or []:
            for it in g["items"] or []:
                t = dt.datetime.fromisoformat(it["time"]) if it["time"] else None
                for label in expected_labels(c, t):
                    want.add((d["mobile"], d["create_time"], it["dial_type"], it["time"], it["peer_number"],
                              d["user_id"], it["details_id"], it["duration"], label))
    assert got == sorted(want)
