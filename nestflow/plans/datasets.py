"""The end-user datasets (J1-J7) as compositions of the operators.

Each pipeline is a pure function of its input frames and the run clock; the
load (partition append/overwrite or full refresh) is a separate, explicit
action in :mod:`nestflow.sources.sinks`.  Selections on document-level
columns (the creation time) run *before* the unnesting, so the fan-out only
touches the documents of the run and a stored collection gets the filter at
its scan; the result is the same as filtering last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestflow.functions.clock import RunClock
from nestflow.functions.periods import period_fanout
from nestflow.functions.scalars import to_int, wall_clock, zero_if_null
from nestflow.operators.filters import select_run
from nestflow.operators.nested import (
    count_nested,
    flatten_struct,
    require_nonempty,
    unnest,
    unnest_path,
)
from nestflow.operators.tables import align, canonical_calls, dedupe
from nestflow.plans.documents import TJ_DATA_LIST
from nestflow.sources.sinks import PARTITION_COL

# Fixed values that must equal the reference's for right results: the
# target tables' columns in insert order, and provider T's field names with
# the canonical call field each becomes.
M_CALL_COLUMNS = ["mobile", "create_time", "dial_type", "time", "peer_number", "user_id",
                  "details_id", "duration", "type"]
T_CALL_COLUMNS = ["mobile", "create_time", "dial_type", "time", "peer_number", "user_id",
                  "duration", "type"]
BILL_COLUMNS = ["mobile", "create_time", "total_fee", "bill_month"]
CONTACT_COLUMNS = ["userId", "phone"]
REAL_NAME_COLUMNS = ["phone", "userId"]

# Provider T field -> canonical call field.
T_CALL_FIELDS = {"trade_time": "duration", "call_type": "dial_type",
                 "receive_phone": "peer_number", "call_time": "time"}
M_CALL_FIELDS = ["peer_number", "details_id", "dial_type", "duration", "time"]


def _tag(df: DataFrame, clock: RunClock) -> DataFrame:
    return df.withColumn(PARTITION_COL, F.lit(clock.partition_value))


def _labelled(calls: DataFrame, clock: RunClock, keep_outside: bool) -> DataFrame:
    """Period labels; instants are read on the run clock's wall."""
    names = {}
    for name in ("time", "create_time"):
        zoned = isinstance(calls.schema[name].dataType, T.TimestampType)
        names[name] = f"__wall_{name}" if zoned else name
        if zoned:
            calls = calls.withColumn(names[name], wall_clock(name, clock.tz))
    return period_fanout(calls, names["time"], names["create_time"], keep_outside=keep_outside)


def m_calls_flat(docs: DataFrame) -> DataFrame:
    """P2 + G2 + P3: every call of every M document as a flat row."""
    groups = docs.select("mobile", "user_id", "create_time", F.col("calls.items").alias("__items"))
    calls = unnest(groups, "__items", "call", depth=2)
    return flatten_struct(calls, "call", M_CALL_FIELDS, keep=["mobile", "user_id", "create_time"])


def t_calls_flat(docs: DataFrame) -> DataFrame:
    """P1 + G3 + P4: every call of every T document, phone carried down."""
    items = unnest_path(docs, [TJ_DATA_LIST, "teldata", "items"], keep=["user_id", "create_time"],
                        carry={0: {"mobile": "userdata.phone"}}, alias="item")
    flat = flatten_struct(items, "item", keep=["mobile", "user_id", "create_time"])
    return canonical_calls(flat, T_CALL_FIELDS, keep=["mobile", "user_id", "create_time"])


def provider_t_calls(docs: DataFrame, clock: RunClock, keep_outside: bool = True,
                     selection: str = "snapshot", bounds: str = "open",
                     counts: Observation | None = None) -> DataFrame:
    """T call records, tagged by period, duration made int,
    de-duplicated.  The default is a cumulative ``snapshot`` of all
    documents created before the run day; ``selection="increment"`` loads
    only the day's documents, and :mod:`nestflow.sources.snapshots` keeps a
    snapshot up without reading the earlier days again.
    ``counts``: see ``operators.select_run``."""
    kept = select_run(docs, "create_time", clock, selection, bounds, counts)
    return _tag(dedupe(t_call_records(kept, clock, keep_outside), T_CALL_COLUMNS), clock)


def t_call_records(docs: DataFrame, clock: RunClock, keep_outside: bool = True) -> DataFrame:
    """The labelled, typed calls of every document, neither selected nor de-duplicated."""
    tagged = _labelled(t_calls_flat(docs), clock, keep_outside)
    return align(tagged.withColumn("duration", to_int("duration")), T_CALL_COLUMNS)


def provider_t_bills(docs: DataFrame, clock: RunClock, selection: str = "snapshot",
                     bounds: str = "open", counts: Observation | None = None) -> DataFrame:
    """T bills (no de-duplication), fee as int with 0 for missing/bad."""
    kept = select_run(docs, "create_time", clock, selection, bounds, counts)
    items = unnest_path(kept, [TJ_DATA_LIST, "billdata"], keep=["create_time"],
                        carry={0: {"mobile": "userdata.phone"}}, alias="item")
    out = items.select("mobile", "create_time",
                       zero_if_null(to_int("item.pay_fee")).alias("total_fee"),
                       F.col("item.month").alias("bill_month"))
    return _tag(align(out, BILL_COLUMNS), clock)


def provider_m_calls(docs: DataFrame, clock: RunClock, bounds: str = "open",
                     keep_outside: bool = True, selection: str = "increment",
                     counts: Observation | None = None) -> DataFrame:
    """M call records of documents created on the day before the run,
    only for documents with at least one bill, tagged and de-duplicated."""
    kept = require_nonempty(select_run(docs, "create_time", clock, selection, bounds, counts),
                            "bills", "bill_count")
    tagged = _labelled(m_calls_flat(kept), clock, keep_outside)
    return _tag(dedupe(tagged, M_CALL_COLUMNS), clock)


def provider_m_bills(docs: DataFrame, clock: RunClock, bounds: str = "open",
                     selection: str = "increment", counts: Observation | None = None) -> DataFrame:
    """M bills of the day's documents; fee neither cast nor defaulted."""
    kept = select_run(docs, "create_time", clock, selection, bounds, counts)
    bills = unnest(kept.select("mobile", "create_time", "bills"), "bills", "bill")
    return _tag(flatten_struct(bills, "bill", ["total_fee", "bill_month"],
                               keep=["mobile", "create_time"]), clock)


def contacts_increment(contacts: DataFrame, clock: RunClock, bounds: str = "open",
                       counts: Observation | None = None) -> DataFrame:
    """Contacts created on the day before the run."""
    return _tag(align(select_run(contacts, "gmtCreate", clock, "increment", bounds, counts), CONTACT_COLUMNS), clock)


def real_name_refresh(names: DataFrame) -> DataFrame:
    """The real-name dimension in target order (loaded by full refresh)."""
    return align(names, REAL_NAME_COLUMNS)


def nested_count(docs: DataFrame) -> DataFrame:
    """Count of ``calls.items`` elements with details -- call *groups*.
    Groups stored in pieces are counted once."""
    group = docs.schema["calls"].dataType.elementType
    return count_nested(docs, "calls.items", "details_id",
                        continued="continued" if "continued" in group.fieldNames() else None)
