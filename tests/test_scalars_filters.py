import datetime as dt

from pyspark.sql import functions as F

from nestflow.functions.clock import RunClock, yesterday
from nestflow.functions.scalars import month_start, split_list, to_int, to_ts, zero_if_null
from nestflow.operators.filters import before, drop_label, in_day


def test_to_int_fee_text(spark):
    df = spark.createDataFrame([("12",), ("12.5",), ("abc",), (None,), ("-12.9",), (" 7 ",), ("1e3",),
                                ("99999999999",)], "s string")
    got = [r.v for r in df.select(zero_if_null(to_int("s")).alias("v")).collect()]
    assert got == [12, 12, 0, 0, -12, 7, 0, 0]


def test_to_ts_forms(spark):
    df = spark.createDataFrame([("2018-07-15 10:00:00",), ("2018-07-15 10:00:00.0",), ("bad",), (None,)], "s string")
    got = [r.t for r in df.select(to_ts("s").alias("t")).collect()]
    assert got[:2] == [dt.datetime(2018, 7, 15, 10)] * 2 and got[2:] == [None, None]


def test_month_start_and_split(spark):
    df = spark.createDataFrame([("2018-07-15 10:00:00", "30,60")], "s string, l string")
    r = df.select(month_start("s").alias("m"), split_list("l").alias("a")).first()
    assert r.m == dt.datetime(2018, 7, 1) and r.a == ["30", "60"]


def test_clock():
    c = RunClock.of("2024-01-15")
    assert c.partition_value == "20240114" and c.today_text == "20240115"
    assert c.yesterday_start == dt.datetime(2024, 1, 14)
    assert RunClock.of("20240115") == c
    assert c.epoch_seconds(c.today) == 1705248000  # 2024-01-15 00:00 Asia/Shanghai


def test_yesterday_column(spark):
    c = RunClock.of("2024-01-15")
    r = spark.range(1).select(yesterday(c).alias("y"), yesterday().alias("z"), F.current_date().alias("today")).first()
    assert r.y == dt.date(2024, 1, 14)
    assert r.z == r.today - dt.timedelta(days=1)


def _times(spark):
    rows = [("2024-01-14 00:00:00",), ("2024-01-14 00:00:00.5",), ("2024-01-14 00:00:01",),
            ("2024-01-14 23:59:59.9",), ("2024-01-15 00:00:00",), ("2024-01-13 12:00:00",)]
    return spark.createDataFrame(rows, "s string").withColumn("t", F.col("s").cast("timestamp_ntz"))


def test_in_day_open_and_text_agree(spark):
    c = RunClock.of("2024-01-15")
    df = _times(spark)
    a = sorted(r.s for r in in_day(df, "t", c).collect())
    b = sorted(r.s for r in in_day(df, "s", c).collect())
    assert a == b == ["2024-01-14 00:00:01", "2024-01-14 23:59:59.9"]
    closed = sorted(r.s for r in in_day(df, "t", c, bounds="left_closed").collect())
    assert closed[0] == "2024-01-14 00:00:00" and len(closed) == 4


def test_before(spark):
    c = RunClock.of("2024-01-15")
    df = _times(spark)
    assert before(df, "t", c.today_start).count() == before(df, "s", c.today_start).count() == 5


def test_daily_filter_pushed_to_scan(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = in_day(ev, "ts", RunClock.of("2024-01-15"))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan


def test_drop_label(spark):
    df = spark.createDataFrame([("0",), ("30",), (None,)], "t string")
    assert [r.t for r in drop_label(df, "t").collect()] == ["30"]


def test_instants_follow_the_clock_not_the_session(spark, tmp_path):
    from nestflow.functions.clock import RunClock
    from nestflow.functions.scalars import instant_of_utc, wall_clock
    from nestflow.operators.filters import before, in_day

    # On the 14th in Shanghai: 13th 16:00 to 14th 16:00 in UTC.
    texts = ["2024-01-13 15:59:59", "2024-01-13 16:00:00", "2024-01-13 16:00:01", "2024-01-14 15:59:59.9", "2024-01-14 16:00:00",
             "2018-11-04 02:30:00", "2018-02-18 02:30:00"]  # the last two are near a change of clocks in Sao Paulo
    clock, zone = RunClock.of("2024-01-15"), spark.conf.get("spark.sql.session.timeZone")
    path = str(tmp_path / "t")
    wall = F.col("s").cast("timestamp_ntz")
    spark.createDataFrame([(t,) for t in texts], "s string").select("s", instant_of_utc(wall).alias("at")).write.parquet(path)
    try:
        for session in ("UTC", "Asia/Shanghai", "America/Sao_Paulo"):
            spark.conf.set("spark.sql.session.timeZone", session)
            df = spark.read.parquet(path)
            got = in_day(df, "at", clock)
            assert {r.s for r in got.collect()} == {texts[2], texts[3]}
            assert {r.s for r in in_day(df, "at", clock, "left_closed").collect()} == {texts[1], texts[2], texts[3]}
            assert {r.s for r in before(df, "at", clock.today_start).collect()} == {*texts} - {texts[4]}
            assert "GreaterThanOrEqual(at" in got._jdf.queryExecution().executedPlan().toString()
            assert df.filter(wall_clock("at", clock.tz) != wall + F.expr("INTERVAL '8' HOUR")).count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
