"""The registered query set: one Spark plan per operator/dataset, each with
an independent DuckDB statement over the flat tables that states the same
answer (the oracle).

Every query reads the whole given tables (or documents Spark derives from
them); the run dates below are parameters of the daily jobs, not row caps.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestflow.functions.clock import RunClock, ntz_literal, yesterday
from nestflow.functions.periods import day_divide, period_fanout, time_parse
from nestflow.functions.scalars import instant_of_utc, to_int, wall_clock, zero_if_null
from nestflow.operators.filters import before, drop_label, in_day
from nestflow.operators.nested import require_nonempty, split_explode, unnest_path
from nestflow.operators.tables import (
    append_rows,
    count_deleted,
    dedupe,
    delete_where,
    replace_by_key,
    update_by_key,
)
from nestflow.plans import documents as D
from nestflow.plans import datasets as P
from nestflow.plans.jobs import provider_m_job, provider_t_job
from nestflow.sources.collections import parse_json_column, read_collection, with_views, write_collection
from nestflow.sources.mutations import delete_touched, read_partitioned, replace_touched, update_touched
from nestflow.sources.rescue import RESCUED_COL, parse_json_rescued
from nestflow.sources.sinks import in_database, load_partition, refresh_table, scratch_path
from nestflow.sources.snapshots import Snapshot

# Run parameters of the registered daily jobs.
EVENTS_CLOCK = RunClock.of("2024-01-15")      # increment = 2024-01-14
M_CLOCK = RunClock.of("2001-07-29")           # increment = 2001-07-28
T_CLOCK = RunClock.of("2000-01-01")           # snapshot of documents before 2000
SKEW_CLOCK = RunClock.of("2001-08-03")        # snapshot that has the hot customer's document
MAINTAINED_CLOCKS = [RunClock.of(d) for d in ("1999-12-20", "1999-12-31", "2000-01-01")]  # three runs of a kept-up snapshot
SHARED_CLOCK = RunClock.of("2001-07-01")      # snapshot that has documents of several phones
YESTERDAY_CLOCK = RunClock.of("1998-06-02")
MIDNIGHT_CLOCK = RunClock.of("1998-10-04")    # the day 1998-10-03
EVENTS_CREATE = "2024-02-15 00:00:00"         # creation time for tagging events

QueryFn = Callable[[SparkSession, str], DataFrame]


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return D.table(spark, sf, name)


def _orders_with_last(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with their customer's last order date as the creation time.

    The per-customer maximum is a partial aggregate (one row per customer
    and map task is shuffled); it is joined back on the customer key, a
    join AQE can split when one customer is hot.
    """
    o = _t(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    last = o.groupBy("o_custkey").agg(F.max("o_orderdate").alias("create_time"))
    return o.join(last, "o_custkey")


# --------------------------------------------------------------------------
# Spark side
# --------------------------------------------------------------------------

def q_period_fanout_orders(spark, sf):
    return period_fanout(_orders_with_last(spark, sf), "o_orderdate", "create_time").select(
        "o_custkey", "o_orderkey", "o_orderdate", "create_time", "type")


def q_period_fanout_orders_tokens(spark, sf):
    return period_fanout(_orders_with_last(spark, sf), "o_orderdate", "create_time",
                         method="tokens").select(
        "o_custkey", "o_orderkey", "o_orderdate", "create_time", "type")


def q_period_fanout_events(spark, sf):
    ev = _t(spark, sf, "events").select("event_id", "ts").withColumn(
        "create_time", F.lit(EVENTS_CREATE).cast("timestamp_ntz"))
    return period_fanout(ev, "ts", "create_time").select("event_id", "ts", "type")


def q_day_divide_tokens(spark, sf):
    return _orders_with_last(spark, sf).select(
        "o_orderkey", day_divide("create_time", "o_orderdate").alias("tokens"))


def q_time_parse_labels(spark, sf):
    o = _orders_with_last(spark, sf).select(
        "o_orderkey", "o_orderdate", "create_time",
        day_divide("create_time", "o_orderdate").alias("tokens"))
    tok = split_explode(o, "tokens", "token")
    return tok.select("o_orderkey", "token",
                      time_parse("token", "create_time", "o_orderdate").alias("label"))


def _mx(spark, sf, paths=D.M_CALLS_PATHS, kind="mx"):
    return D.stored_collection(spark, sf, kind, paths)


def _tj(spark, sf, paths=D.T_CALLS_PATHS, kind="tj"):
    return D.stored_collection(spark, sf, kind, paths)


def q_unnest_calls(spark, sf):
    return P.m_calls_flat(_mx(spark, sf))


def _skewed(spark, sf, build=D.mx_documents):
    """Documents where one order holds a third of all line items and one
    customer a third of all orders (keys remapped, every row kept): the
    hot order is split into several call groups and the hot customer into
    several documents.  No answer may change by that."""
    li = _t(spark, sf, "lineitem").withColumn(
        "l_orderkey", F.when(F.pmod("l_orderkey", F.lit(3)) == 0, F.lit(0).cast("bigint"))
        .otherwise(F.col("l_orderkey")))
    orders = _t(spark, sf, "orders").withColumn(
        "o_custkey", F.when(F.pmod("o_orderkey", F.lit(3)) == 1, F.lit(0).cast("bigint"))
        .otherwise(F.col("o_custkey")))
    return build(spark, sf, lineitem=li, orders=orders)


def q_unnest_calls_skewed(spark, sf):
    return P.m_calls_flat(_skewed(spark, sf))


def q_provider_m_calls_skewed(spark, sf):
    return P.provider_m_calls(_skewed(spark, sf), SKEW_CLOCK, selection="snapshot")


def q_provider_m_bills_skewed(spark, sf):
    return P.provider_m_bills(_skewed(spark, sf), SKEW_CLOCK, selection="snapshot")


def q_provider_t_calls_skewed(spark, sf):
    return P.provider_t_calls(_skewed(spark, sf, D.tj_documents), SKEW_CLOCK)


def q_nested_count_skewed(spark, sf):
    return P.nested_count(_skewed(spark, sf))


def q_unnest_three_level(spark, sf):
    return P.t_calls_flat(_tj(spark, sf))


def q_calls_gated_by_bills(spark, sf):
    docs = require_nonempty(_mx(spark, sf), "bills", "bill_count")
    return dedupe(P.m_calls_flat(docs), [c for c in P.M_CALL_COLUMNS if c != "type"])


def q_calls_gated_by_explode(spark, sf):
    """The reference's literal gate: explode the bills, never use them, and
    let DISTINCT remove the copies.  Same rows as the size() gate.  A piece of
    a split document may hold none of its customer's bills and stays as it is."""
    docs = _mx(spark, sf).filter("bill_count > 0")
    exploded = docs.select("mobile", "user_id", "create_time", "calls", F.explode_outer("bills").alias("__bill"))
    return dedupe(P.m_calls_flat(exploded.drop("__bill")), [c for c in P.M_CALL_COLUMNS if c != "type"])


def q_legacy_sql_call_record(spark, sf):
    """Calls tagged by the registered SQL functions, one statement for each function."""
    import uuid

    from nestflow.functions.sql import register_sql_functions

    register_sql_functions(spark)
    text = {c: F.col(c).cast("string") for c in ("time", "create_time")}
    calls = P.m_calls_flat(_mx(spark, sf)).withColumns(text)

    def add(df: DataFrame, expression: str) -> DataFrame:
        view = f"nf_m_calls_{uuid.uuid4().hex[:12]}"
        with with_views(spark, {view: df}):
            # the analysed plan no longer needs the name once spark.sql returns
            return spark.sql(f"SELECT *, {expression} FROM {view}")

    divided = add(calls, "day_divide(unix_timestamp(create_time), unix_timestamp(time)) AS tokens")
    parsed = add(split_explode(divided, "tokens", "token"),
                 "time_parse(token, create_time, time, unix_timestamp(time)) AS type")
    return drop_label(parsed, "type").select(*P.M_CALL_COLUMNS)


def q_bills_int_fee(spark, sf):
    items = unnest_path(_tj(spark, sf, D.T_BILLS_PATHS), [D.TJ_DATA_LIST, "billdata"], keep=["create_time"],
                        carry={0: {"mobile": "userdata.phone"}}, alias="item")
    return items.select("mobile", "create_time",
                        zero_if_null(to_int("item.pay_fee")).alias("total_fee"),
                        F.col("item.month").alias("bill_month"))


def q_split_explode(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return split_explode(o, "o_orderpriority", "token", sep="-", keep=["o_orderkey"])


def q_nested_group_count(spark, sf):
    return _group_and_call_counts(_mx(spark, sf, D.M_COUNT_PATHS))


def _group_and_call_counts(docs: DataFrame) -> DataFrame:
    """Both counts in one pass: a group is counted once (its first element
    row, or its lone row when empty) unless it continues another one, a call
    once per row."""
    g = docs.select(F.explode("calls").alias("g"))
    rows = g.select((F.col("g.items").isNotNull() & ~F.col("g.continued")).alias("has_items"),
                    F.posexplode_outer("g.items").alias("pos", "c"))
    return rows.agg(
        F.count_if(F.col("has_items") & (F.coalesce(F.col("pos"), F.lit(0)) == 0)).alias("n_groups"),
        F.count(F.col("c.details_id")).alias("n_calls"),
    )


def q_distinct_records(spark, sf):
    return dedupe(_t(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus", "l_suppkey"])


def q_snapshot_cutoff(spark, sf):
    return before(_t(spark, sf, "events"), "ts", EVENTS_CLOCK.today_start)


def q_daily_increment(spark, sf):
    return in_day(_t(spark, sf, "events"), "ts", EVENTS_CLOCK)


def q_daily_increment_zoned(spark, sf):
    """F2 over instants: the events' times are moments in UTC, the run day is the clock zone's."""
    ev = _t(spark, sf, "events").select("event_id", "user_id", instant_of_utc("ts").alias("at"))
    return in_day(ev, "at", EVENTS_CLOCK).select(
        "event_id", "user_id", wall_clock("at", EVENTS_CLOCK.tz).alias("local_time"))


def q_daily_increment_wrapped(spark, sf):
    """The reference's form of the day filter: the column wrapped in a
    parse and truncation, which cannot reach the Parquet scan."""
    from nestflow.functions.scalars import to_ts, trunc_second

    ev = _t(spark, sf, "events")
    t = trunc_second(to_ts(F.col("ts").cast("string")))
    return ev.filter((t > EVENTS_CLOCK.yesterday_start_col()) & (t < EVENTS_CLOCK.today_start_col()))


def q_midnight_loss(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    day = in_day(o, "o_orderdate", MIDNIGHT_CLOCK, bounds="left_closed")
    # Of the closed day, the open one lacks the whole second of midnight only.
    later = F.col("o_orderdate") >= ntz_literal(MIDNIGHT_CLOCK.yesterday_start + dt.timedelta(seconds=1))
    return day.select("o_orderkey", "o_orderdate", later.alias("in_open"))


def q_partition_tagged(spark, sf):
    ev = in_day(_t(spark, sf, "events"), "ts", EVENTS_CLOCK)
    return ev.select("event_id", "user_id", "ts", F.lit(EVENTS_CLOCK.partition_value).alias("partition_time"))


def q_provider_t_calls(spark, sf):
    return P.provider_t_calls(_tj(spark, sf), T_CLOCK)


def q_provider_t_calls_increment(spark, sf):
    return P.provider_t_calls(_tj(spark, sf, kind="tj_by_day"), M_CLOCK, selection="increment")


def q_provider_t_calls_from_json(spark, sf):
    """J1 on the three-level T collection exported as JSON lines, read with a
    schema inferred from all documents (its times and fees are text
    already, so the rows equal J1's)."""
    path = D.stage_collection(spark, sf, "tj_json")
    docs = read_collection(spark, path, fmt="json")
    return P.provider_t_calls(docs, T_CLOCK)


def q_provider_t_bills(spark, sf):
    return P.provider_t_bills(_tj(spark, sf, D.T_BILLS_PATHS), T_CLOCK)


def q_provider_m_calls(spark, sf):
    return P.provider_m_calls(_mx(spark, sf, kind="mx_by_day"), M_CLOCK)


def q_provider_m_calls_from_json(spark, sf):
    """J3 on the M collection exported as JSON lines, its schema inferred
    from all documents (times arrive as text, numbers as longs)."""
    path = D.stage_collection(spark, sf, "mx_json")
    docs = read_collection(spark, path, fmt="json")
    return P.provider_m_calls(docs, M_CLOCK)


def q_provider_m_bills(spark, sf):
    return P.provider_m_bills(_mx(spark, sf, D.M_BILLS_PATHS, "mx_by_day"), M_CLOCK)


def q_provider_t_calls_maintained(spark, sf):
    """J1 kept up over three runs: all history once, then two days that are
    added; equal to the full reload of the last day."""
    rows = ", ".join(f"{c} {'int' if c == 'duration' else 'string'}" for c in P.T_CALL_COLUMNS)
    snapshot = Snapshot(spark, scratch_path(spark, "t_calls_snapshot"), rows)
    for clock in MAINTAINED_CLOCKS:
        snapshot.advance(_tj(spark, sf, kind="tj_by_day"), lambda docs, clock=clock: P.t_call_records(docs, clock), clock)
    return snapshot.read(MAINTAINED_CLOCKS[-1])


def q_unnest_three_level_shared(spark, sf):
    return P.t_calls_flat(_tj(spark, sf, kind="tj_shared"))


def q_provider_t_calls_shared(spark, sf):
    return P.provider_t_calls(_tj(spark, sf, kind="tj_shared"), SHARED_CLOCK)


def q_provider_t_bills_shared(spark, sf):
    return P.provider_t_bills(_tj(spark, sf, D.T_BILLS_PATHS, "tj_shared"), SHARED_CLOCK)


def q_provider_t_calls_shared_skewed(spark, sf):
    return P.provider_t_calls(_skewed(spark, sf, D.tj_shared_documents), SKEW_CLOCK)


def q_provider_m_calls_left_closed(spark, sf):
    """J3 with its other options: midnight belongs to its day, and calls outside every period go."""
    return P.provider_m_calls(_mx(spark, sf, kind="mx_by_day"), M_CLOCK, bounds="left_closed", keep_outside=False)


def q_period_fanout_orders_yearly(spark, sf):
    """N11 with other periods: 7 and 365 days inside a horizon of 730."""
    return period_fanout(_orders_with_last(spark, sf), "o_orderdate", "create_time", periods=(7, 365), horizon=730).select(
        "o_custkey", "o_orderkey", "o_orderdate", "create_time", "type")


def q_yesterday_orders(spark, sf):
    """Orders of the clock's yesterday, with that day."""
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderdate", yesterday(YESTERDAY_CLOCK).alias("yesterday"))
    return o.filter(F.col("o_orderdate").cast("date") == F.col("yesterday"))


def q_contacts_increment(spark, sf):
    return P.contacts_increment(D.contacts(spark, sf), EVENTS_CLOCK)


def q_contacts_increment_streamed(spark, sf):
    """J5 run as a stream: contacts land as JSON-lines files, a file stream
    with the fixed schema processes what is there (availableNow) into the
    partitioned target, checkpointed in the shared folder."""
    from nestflow.streaming import run_incremental

    base = scratch_path(spark, "contacts_stream")
    (D.contacts(spark, sf).write.option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
     .json(f"{base}/landing"))
    run_incremental(spark, f"{base}/landing", "userId string, phone string, gmtCreate timestamp_ntz",
                    lambda df: P.contacts_increment(df, EVENTS_CLOCK), f"{base}/target",
                    checkpoint=f"{base}/checkpoint", max_files_per_trigger=4)
    return (spark.read.parquet(f"{base}/target")
            .select(*P.CONTACT_COLUMNS, F.col("partition_time").cast("string").alias("partition_time")))


def q_real_name_refresh(spark, sf):
    target = scratch_path(spark, "real_name")
    refresh_table(P.real_name_refresh(D.real_names(spark, sf)), target)
    # A second refresh replaces, it does not add.
    refresh_table(P.real_name_refresh(D.real_names(spark, sf)), target)
    return spark.read.parquet(target).select(*P.REAL_NAME_COLUMNS)


def q_nested_count(spark, sf):
    return P.nested_count(_mx(spark, sf, D.M_COUNT_PATHS))


def _customers(spark, sf):
    return _t(spark, sf, "customer")


def _supplier_rows(spark, sf, key_expr):
    return _t(spark, sf, "supplier").select(
        key_expr.alias("c_custkey"), F.col("s_name").alias("c_name"),
        F.col("s_nationkey").alias("c_nationkey"), F.col("s_acctbal").alias("c_acctbal"))


def q_delete_where(spark, sf):
    return delete_where(_customers(spark, sf), F.col("c_acctbal") < 0)


def q_count_deleted(spark, sf):
    return count_deleted(_customers(spark, sf), F.col("c_acctbal") < 0)


def q_append_rows(spark, sf):
    new = _supplier_rows(spark, sf, F.col("s_suppkey") + F.lit(1_000_000_000))
    return append_rows(_customers(spark, sf), new)


def q_update_by_key(spark, sf):
    c = _customers(spark, sf)
    changes = c.filter(F.col("c_nationkey") == 0).select(
        "c_custkey", F.lit("PRIORITY").alias("c_mktsegment"), F.lit(None).cast("double").alias("c_acctbal"))
    return update_by_key(c, changes, ["c_custkey"])


def q_replace_by_key(spark, sf):
    new = _supplier_rows(spark, sf, F.col("s_suppkey") * 15).withColumn(
        "c_mktsegment", F.lit("SUPPLIER"))
    return replace_by_key(_customers(spark, sf), new, ["c_custkey"])


def q_json_schema_sample(spark, sf):
    ev = _t(spark, sf, "events").select("event_id", "props")
    return parse_json_column(ev, "props")


def _increment(spark, sf):
    return in_day(_t(spark, sf, "events"), "ts", EVENTS_CLOCK).select("event_id", "user_id", "ts")


def _read_partitions(spark, path):
    return (spark.read.parquet(path)
            .withColumn("partition_time", F.col("partition_time").cast("string"))
            .select("event_id", "user_id", "ts", "partition_time"))


def q_load_partition_roundtrip(spark, sf):
    target = scratch_path(spark, "events_by_day")
    load_partition(_increment(spark, sf), target, EVENTS_CLOCK.partition_value, mode="overwrite")
    # Re-running the day with overwrite is idempotent.
    load_partition(_increment(spark, sf), target, EVENTS_CLOCK.partition_value, mode="overwrite")
    return _read_partitions(spark, target)


def q_load_append_twice(spark, sf):
    target = scratch_path(spark, "events_appended")
    load_partition(_increment(spark, sf), target, EVENTS_CLOCK.partition_value, mode="append")
    load_partition(_increment(spark, sf), target, EVENTS_CLOCK.partition_value, mode="append")
    return _read_partitions(spark, target)


def _database(spark: SparkSession) -> str:
    """A new database whose tables lie in this application's part of the shared folder."""
    import uuid

    name = f"nestflow_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, name)}'")
    return name


def _events_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE TABLE {name} (ts TIMESTAMP_NTZ, user_id BIGINT, event_id BIGINT, partition_time STRING) "
              "USING parquet PARTITIONED BY (partition_time)")


def q_load_catalog_partitions(spark, sf):
    """Daily loads into a catalog table, found in the current
    database, columns put in its order by name.  The increment of one
    day is appended twice, another day's replaced by itself, and a third
    day's emptied by a run that finds nothing."""
    name = _database(spark)
    days = [RunClock.of(d) for d in ("2024-01-14", "2024-01-15", "2024-01-16")]
    with in_database(spark, name):
        _events_table(spark, "events_by_day")
        inc = [in_day(_t(spark, sf, "events"), "ts", c).select("event_id", "user_id", "ts") for c in days]
        for k, mode in ((0, "append"), (0, "append"), (1, "append"), (1, "overwrite"), (2, "append")):
            load_partition(inc[k], "events_by_day", days[k].partition_value, mode=mode)
        load_partition(inc[2].filter("event_id IS NULL"), "events_by_day", days[2].partition_value, mode="overwrite")
    return spark.table(f"{name}.events_by_day").select("event_id", "user_id", "ts", "partition_time")


def q_refresh_catalog_table(spark, sf):
    """A catalog table replaced as a whole, twice, by rows in another column order."""
    name = _database(spark)
    with in_database(spark, name):
        spark.sql("CREATE TABLE real_name (userId STRING, phone STRING) USING parquet")
        refresh_table(_customers(spark, sf).select(F.col("c_name").alias("userId"), F.lit("old").alias("phone")), "real_name")
        refresh_table(P.real_name_refresh(D.real_names(spark, sf)), "real_name")
    return spark.table(f"{name}.real_name").select(*P.REAL_NAME_COLUMNS)


def _job_report(spark, targets: dict[str, str], counts: dict[str, dict[str, int]]) -> DataFrame:
    """What a job counted on its way, with the rows that its target has; one row a target."""
    seen = spark.createDataFrame([(k, v.get("selected"), v.get("bad_time"), v["written"]) for k, v in counts.items()],
                                 "target string, selected long, bad_time long, written long")
    stored = [spark.table(t).agg(F.count(F.lit(1)).alias("stored")).select(F.lit(k).alias("target"), "stored") for k, t in targets.items()]
    return seen.join(reduce(DataFrame.unionByName, stored), "target")


def _job_targets(spark, names: dict[str, str]) -> dict[str, str]:
    """Catalog tables for a job's targets, named by their columns and partitioned by the run."""
    database = _database(spark)
    for target, columns in names.items():
        part = "" if target == "real_names" else ", partition_time STRING) USING parquet PARTITIONED BY (partition_time"
        spark.sql(f"CREATE TABLE {database}.{target} ({columns}{part or ') USING parquet'}" + (")" if part else ""))
    return {target: f"{database}.{target}" for target in names}


def q_job_m_counts(spark, sf):
    """The daily M job into catalog tables; run twice, the second time replacing the day."""
    targets = _job_targets(spark, {
        "contacts": "userId STRING, phone STRING", "real_names": "phone STRING, userId STRING",
        "bills": "mobile STRING, create_time TIMESTAMP_NTZ, total_fee INT, bill_month STRING",
        "calls": "mobile STRING, create_time TIMESTAMP_NTZ, dial_type STRING, time TIMESTAMP_NTZ, peer_number STRING, "
                 "user_id STRING, details_id STRING, duration INT, type STRING"})
    docs = _mx(spark, sf, [*D.M_CALLS_PATHS, "bills.total_fee"], "mx_by_day")
    for _ in range(2):
        counts = provider_m_job(docs, D.contacts(spark, sf), D.real_names(spark, sf), M_CLOCK, targets, mode="overwrite")
    return _job_report(spark, targets, counts)


def q_job_t_counts(spark, sf):
    """The T job into catalog tables, its snapshot appended twice."""
    targets = _job_targets(spark, {
        "bills": "mobile STRING, create_time STRING, total_fee INT, bill_month STRING",
        "calls": "mobile STRING, create_time STRING, dial_type STRING, time STRING, peer_number STRING, user_id STRING, duration INT, type STRING"})
    docs = _tj(spark, sf, [*D.T_CALLS_PATHS, *D.T_BILLS_PATHS])
    for _ in range(2):
        counts = provider_t_job(docs, T_CLOCK, targets)
    return _job_report(spark, targets, counts)


def _orders_by_year(spark, sf, name: str) -> str:
    path = scratch_path(spark, name)
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", F.year("o_orderdate").alias("year"))
    o.write.partitionBy("year").parquet(path)
    return path


def q_update_touched(spark, sf):
    """M3 on a stored table: prices of the orders of one customer in ten set, in the years that have such orders."""
    path = _orders_by_year(spark, sf, "orders_updated")
    changes = (_t(spark, sf, "orders").filter("o_custkey % 10 = 0 AND year(o_orderdate) < 1997")
               .select("o_orderkey", F.lit(-1.0).cast("double").alias("o_totalprice")))
    update_touched(spark, path, changes, ["o_orderkey"], part_col="year")
    return read_partitioned(spark, path, "year")


def q_delete_touched(spark, sf):
    """M1 on a stored table: one year's large orders deleted, another year left without rows."""
    path = _orders_by_year(spark, sf, "orders_deleted")
    delete_touched(spark, path, F.expr("year = '1995' AND o_totalprice > 100000 OR year = '1996'"), part_col="year")
    return read_partitioned(spark, path, "year")


def q_replace_touched(spark, sf):
    """M4 on a stored table: some orders replaced, and moved to the next year."""
    path = _orders_by_year(spark, sf, "orders_replaced")
    moved = (_t(spark, sf, "orders").filter("o_custkey % 10 = 3 AND year(o_orderdate) = 1994")
             .select("o_orderkey", "o_custkey", F.lit(0.0).cast("double").alias("o_totalprice"), F.lit("1995").alias("year")))
    replace_touched(spark, path, moved, ["o_orderkey"], part_col="year")
    return read_partitioned(spark, path, "year")


#: The given schema of ``q_rescued_values``; the lines do not always fit it.
RESCUE_SCHEMA = "id long, customer int, parts array<struct<line: int, qty: double>>, place struct<nation: int>"


def _uneven_lines(spark, sf) -> DataFrame:
    """Orders as JSON lines, with late fields, widened numbers, text for numbers, wrong shapes and cut lines."""
    key = F.col("o_orderkey")
    text = F.concat(
        F.lit('{"id":'), key.cast("string"), F.lit(',"customer":'),
        F.when(key % 7 == 0, F.lit('"n/a"')).when(key % 11 == 0, F.lit("3000000000")).otherwise(F.col("o_custkey").cast("string")),
        F.lit(',"parts":'),
        F.when(key % 13 == 0, F.lit('{"line":1}')).when(key % 17 == 0, F.lit('[{"line":1,"qty":"many"},{"line":2,"qty":3,"note":"x"}]'))
        .otherwise(F.lit('[{"line":1,"qty":2.5}]')),
        F.when(key % 19 == 0, F.lit(',"place":{"nation":5,"city":"x"}')).when(key % 23 == 0, F.lit(',"place":[1]')).otherwise(F.lit(',"place":null')),
        F.when(key % 29 == 0, F.lit(',"added":true')).otherwise(F.lit("")),
        F.when(key % 31 == 0, F.lit("")).otherwise(F.lit("}")))
    return _t(spark, sf, "orders").select("o_orderkey", text.alias("line"))


def q_rescued_values(spark, sf):
    """S1 with a given schema: what fits of every order line, and all paths that do not."""
    schema = T.StructType.fromDDL(RESCUE_SCHEMA)
    found = parse_json_rescued(_uneven_lines(spark, sf), "line", schema)
    return found.select("o_orderkey", "customer", F.try_element_at("parts", F.lit(1))["qty"].alias("qty"),
                        F.col("place.nation").alias("nation"), F.array_join(RESCUED_COL, " ").alias("misfits"))


def q_collection_roundtrip(spark, sf):
    target = scratch_path(spark, "customer_collection")
    write_collection(_customers(spark, sf).select("c_custkey", "c_name", "c_acctbal"), target,
                     fmt="json", mode="overwrite")
    return read_collection(spark, target, fmt="json").select(
        "c_custkey", "c_name", "c_acctbal")


QUERIES: dict[str, QueryFn] = {
    "period_fanout_orders": q_period_fanout_orders,
    "period_fanout_orders_tokens": q_period_fanout_orders_tokens,
    "period_fanout_events": q_period_fanout_events,
    "day_divide_tokens": q_day_divide_tokens,
    "time_parse_labels": q_time_parse_labels,
    "unnest_calls": q_unnest_calls,
    "unnest_three_level": q_unnest_three_level,
    "unnest_calls_skewed": q_unnest_calls_skewed,
    "provider_m_calls_skewed": q_provider_m_calls_skewed,
    "provider_m_bills_skewed": q_provider_m_bills_skewed,
    "provider_t_calls_skewed": q_provider_t_calls_skewed,
    "nested_count_skewed": q_nested_count_skewed,
    "calls_gated_by_bills": q_calls_gated_by_bills,
    "calls_gated_by_explode": q_calls_gated_by_explode,
    "bills_int_fee": q_bills_int_fee,
    "legacy_sql_call_record": q_legacy_sql_call_record,
    "split_explode": q_split_explode,
    "nested_group_count": q_nested_group_count,
    "distinct_records": q_distinct_records,
    "snapshot_cutoff": q_snapshot_cutoff,
    "daily_increment": q_daily_increment,
    "daily_increment_zoned": q_daily_increment_zoned,
    "daily_increment_wrapped": q_daily_increment_wrapped,
    "midnight_loss": q_midnight_loss,
    "partition_tagged": q_partition_tagged,
    "provider_t_calls": q_provider_t_calls,
    "provider_t_calls_increment": q_provider_t_calls_increment,
    "provider_t_calls_from_json": q_provider_t_calls_from_json,
    "provider_t_bills": q_provider_t_bills,
    "provider_m_calls": q_provider_m_calls,
    "provider_m_calls_from_json": q_provider_m_calls_from_json,
    "provider_m_bills": q_provider_m_bills,
    "contacts_increment": q_contacts_increment,
    "contacts_increment_streamed": q_contacts_increment_streamed,
    "real_name_refresh": q_real_name_refresh,
    "nested_count": q_nested_count,
    "delete_where": q_delete_where,
    "count_deleted": q_count_deleted,
    "append_rows": q_append_rows,
    "update_by_key": q_update_by_key,
    "replace_by_key": q_replace_by_key,
    "json_schema_sample": q_json_schema_sample,
    "load_partition_roundtrip": q_load_partition_roundtrip,
    "load_append_twice": q_load_append_twice,
    "collection_roundtrip": q_collection_roundtrip,
    "provider_t_calls_maintained": q_provider_t_calls_maintained,
    "unnest_three_level_shared": q_unnest_three_level_shared,
    "provider_t_calls_shared": q_provider_t_calls_shared,
    "provider_t_bills_shared": q_provider_t_bills_shared,
    "provider_t_calls_shared_skewed": q_provider_t_calls_shared_skewed,
    "provider_m_calls_left_closed": q_provider_m_calls_left_closed,
    "period_fanout_orders_yearly": q_period_fanout_orders_yearly,
    "yesterday_orders": q_yesterday_orders,
    "load_catalog_partitions": q_load_catalog_partitions,
    "refresh_catalog_table": q_refresh_catalog_table,
    "job_m_counts": q_job_m_counts,
    "job_t_counts": q_job_t_counts,
    "update_touched": q_update_touched,
    "delete_touched": q_delete_touched,
    "replace_touched": q_replace_touched,
    "rescued_values": q_rescued_values,
}
