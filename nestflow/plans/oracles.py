"""Independent DuckDB statements for the registered queries.

They state each answer over the *flat* tables -- no nested documents, no
shared code with the Spark side.  Period tagging is stated by its rules, one
predicate a label; only the queries about tokens spell tokens.  Column names
equal the Spark side's.
"""

from __future__ import annotations

import re

# Fixed values shared with the derived fixtures (see nestflow.plans.documents)
# and the period rules (see nestflow.functions.periods), restated as SQL.
_CREATE = "max(o_orderdate) + to_seconds((o_custkey % 86399) + 1)"
_IS_BILL = "o_orderstatus = 'F' AND o_totalprice > 300000"


def _tokens(t: str, c: str) -> str:
    def inside(d: int) -> str:
        return f"({c} - INTERVAL {d} DAY < {t} AND {t} < {c})"
    return (f"CASE WHEN {inside(30)} THEN '30,60,90,180' WHEN {inside(60)} THEN '60,90,180' "
            f"WHEN {inside(90)} THEN '90,180' WHEN {inside(180)} THEN '180' ELSE '0' END")


def _relabel(token: str, t: str, c: str) -> str:
    return (f"CASE WHEN {token} = '180' THEN CASE WHEN date_trunc('month', {t}) < {t} "
            f"AND {t} < date_trunc('month', {c}) THEN '150' ELSE '0' END "
            f"WHEN {token} IN ('30', '60', '90') THEN {token} ELSE '-1' END")


def _fanout(src: str, time: str, create: str, cols: str, periods: tuple[int, ...] = (30, 60, 90), horizon: int = 180,
            keep_outside: bool = True) -> str:
    """Rows of ``src`` once for each label whose rule they meet, over whole seconds."""
    def inside(days: int) -> str:
        return f"__c - INTERVAL {days} DAY < __t AND __t < __c"

    rules = {str(d): inside(d) for d in periods}
    rules["150"] = f"{inside(horizon)} AND date_trunc('month', __t) < __t AND __t < date_trunc('month', __c)"
    if keep_outside:
        rules["-1"] = f"NOT ({inside(horizon)})"
    timed = f"SELECT *, date_trunc('second', {time}) AS __t, date_trunc('second', {create}) AS __c FROM ({src}) __s"
    return "\nUNION ALL\n".join(f"SELECT {cols}, '{label}' AS type FROM ({timed}) __x WHERE {rule}" for label, rule in rules.items())


_ORDERS_LAST = """
SELECT o.o_custkey, o.o_orderkey, o.o_orderdate, m.create_time
FROM orders o JOIN (SELECT o_custkey, max(o_orderdate) AS create_time FROM orders GROUP BY o_custkey) m
  ON o.o_custkey = m.o_custkey"""

_DOCS = f"""
SELECT o_custkey, {_CREATE} AS create_time, count(*) FILTER (WHERE {_IS_BILL}) AS n_bills
FROM orders GROUP BY o_custkey"""

# Every line item as an M call of its customer's document.
_M_CALLS = f"""
SELECT CAST(d.o_custkey AS VARCHAR) AS mobile, 'U' || CAST(d.o_custkey AS VARCHAR) AS user_id,
       d.create_time, CAST(l.l_suppkey AS VARCHAR) AS peer_number,
       concat(l.l_orderkey, '-', l.l_linenumber) AS details_id, l.l_returnflag AS dial_type,
       CAST(trunc(l.l_quantity) AS INTEGER) AS duration, l.l_shipdate AS time, d.n_bills
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN ({_DOCS}) d ON d.o_custkey = o.o_custkey"""

# Every line item as a T call (times and duration as text).
_T_CALLS = f"""
SELECT CAST(d.o_custkey AS VARCHAR) AS mobile, 'U' || CAST(d.o_custkey AS VARCHAR) AS user_id,
       strftime(d.create_time, '%Y-%m-%d %H:%M:%S') AS create_time,
       CAST(l.l_quantity AS VARCHAR) AS duration, l.l_linestatus AS dial_type,
       CAST(l.l_suppkey AS VARCHAR) AS peer_number,
       strftime(l.l_shipdate, '%Y-%m-%d %H:%M:%S') AS time
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN ({_DOCS}) d ON d.o_custkey = o.o_custkey"""

_T_BILLS = f"""
SELECT CAST(d.o_custkey AS VARCHAR) AS mobile,
       strftime(d.create_time, '%Y-%m-%d %H:%M:%S') AS create_time,
       CASE WHEN o.o_orderpriority = '5-LOW' THEN 0 ELSE CAST(trunc(o.o_totalprice) AS INTEGER) END AS total_fee,
       strftime(o.o_orderdate, '%Y-%m') AS bill_month
FROM orders o JOIN ({_DOCS}) d ON d.o_custkey = o.o_custkey
WHERE o.o_orderstatus = 'F' AND o.o_totalprice > 300000"""

_M_BILLS = f"""
SELECT CAST(d.o_custkey AS VARCHAR) AS mobile, d.create_time,
       CAST(trunc(o.o_totalprice) AS INTEGER) AS total_fee, strftime(o.o_orderdate, '%Y-%m') AS bill_month
FROM orders o JOIN ({_DOCS}) d ON d.o_custkey = o.o_custkey
WHERE o.o_orderstatus = 'F' AND o.o_totalprice > 300000"""


def _open_day(col: str, lo: str, hi: str) -> str:
    c = f"date_trunc('second', {col})"
    return f"({c} > TIMESTAMP '{lo}' AND {c} < TIMESTAMP '{hi}')"


def _to_int(x: str) -> str:
    return (f"CASE WHEN regexp_full_match(CAST({x} AS VARCHAR), '\\s*[+-]?(\\d+\\.?\\d*|\\.\\d+)\\s*') "
            f"THEN TRY_CAST(trunc(TRY_CAST({x} AS DECIMAL(38,6))) AS INTEGER) END")


_EV_DAY = _open_day("ts", "2024-01-14 00:00:00", "2024-01-15 00:00:00")
_M_DAY = _open_day("create_time", "2001-07-28 00:00:00", "2001-07-29 00:00:00")
_T_BEFORE = "date_trunc('second', TRY_CAST(create_time AS TIMESTAMP)) < TIMESTAMP '2000-01-01 00:00:00'"

_ORDERS_COLS = "o_custkey, o_orderkey, o_orderdate, create_time"

ORACLES: dict[str, str] = {
    "period_fanout_orders": _fanout(_ORDERS_LAST, "o_orderdate", "create_time", _ORDERS_COLS),
    "period_fanout_orders_tokens": _fanout(_ORDERS_LAST, "o_orderdate", "create_time", _ORDERS_COLS),
    "period_fanout_events": _fanout(
        "SELECT event_id, ts, TIMESTAMP '2024-02-15 00:00:00' AS create_time FROM events",
        "ts", "create_time", "event_id, ts"),
    "day_divide_tokens": f"""
SELECT o_orderkey, {_tokens("date_trunc('second', o_orderdate)", "date_trunc('second', create_time)")} AS tokens
FROM ({_ORDERS_LAST}) s""",
    "time_parse_labels": f"""
SELECT o_orderkey, token, {_relabel('token', 'o_orderdate', 'create_time')} AS label FROM (
  SELECT o_orderkey, o_orderdate, create_time,
         unnest(string_split({_tokens('o_orderdate', 'create_time')}, ',')) AS token
  FROM ({_ORDERS_LAST}) s) x""",
    "unnest_calls": f"""
SELECT mobile, user_id, create_time, peer_number, details_id, dial_type, duration, time
FROM ({_M_CALLS}) c""",
    "unnest_three_level": f"SELECT * FROM ({_T_CALLS}) c",
    "calls_gated_by_bills": f"""
SELECT DISTINCT mobile, create_time, dial_type, time, peer_number, user_id, details_id, duration
FROM ({_M_CALLS}) c WHERE n_bills > 0""",
    "bills_int_fee": _T_BILLS,
    "split_explode": "SELECT o_orderkey, unnest(string_split(o_orderpriority, '-')) AS token FROM orders",
    "nested_group_count": """
SELECT (SELECT count(DISTINCT l.l_orderkey) FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey) AS n_groups,
       (SELECT count(*) FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey) AS n_calls""",
    "distinct_records": "SELECT DISTINCT l_returnflag, l_linestatus, l_suppkey FROM lineitem",
    "snapshot_cutoff": "SELECT * FROM events WHERE date_trunc('second', ts) < TIMESTAMP '2024-01-15 00:00:00'",
    "daily_increment": f"SELECT * FROM events WHERE {_EV_DAY}",
    "midnight_loss": f"""
SELECT o_orderkey, o_orderdate, {_open_day('o_orderdate', '1998-10-03 00:00:00', '1998-10-04 00:00:00')} AS in_open
FROM orders WHERE date_trunc('second', o_orderdate) >= TIMESTAMP '1998-10-03 00:00:00'
  AND date_trunc('second', o_orderdate) < TIMESTAMP '1998-10-04 00:00:00'""",
    "partition_tagged": f"SELECT event_id, user_id, ts, '20240114' AS partition_time FROM events WHERE {_EV_DAY}",
    "provider_t_calls": f"""
SELECT DISTINCT mobile, create_time, dial_type, time, peer_number, user_id, {_to_int('duration')} AS duration,
       type, '19991231' AS partition_time
FROM ({_fanout(f"SELECT * FROM ({_T_CALLS}) c WHERE {_T_BEFORE}", "TRY_CAST(time AS TIMESTAMP)",
               "TRY_CAST(create_time AS TIMESTAMP)",
               "mobile, create_time, dial_type, time, peer_number, user_id, duration")}) f""",
    "provider_t_bills": f"SELECT *, '19991231' AS partition_time FROM ({_T_BILLS}) b WHERE {_T_BEFORE}",
    "provider_m_calls": f"""
SELECT DISTINCT mobile, create_time, dial_type, time, peer_number, user_id, details_id, duration, type,
       '20010728' AS partition_time
FROM ({_fanout(f"SELECT * FROM ({_M_CALLS}) c WHERE n_bills > 0 AND {_M_DAY}", "time", "create_time",
               "mobile, create_time, dial_type, time, peer_number, user_id, details_id, duration")}) f""",
    "provider_m_bills": f"SELECT *, '20010728' AS partition_time FROM ({_M_BILLS}) b WHERE {_M_DAY}",
    "contacts_increment": f"""
SELECT CAST(user_id AS VARCHAR) AS userId, CAST(event_id AS VARCHAR) AS phone, '20240114' AS partition_time
FROM events WHERE {_EV_DAY}""",
    "real_name_refresh": "SELECT CAST(c_custkey AS VARCHAR) AS phone, c_name AS userId FROM customer",
    "nested_count": """
SELECT count(DISTINCT l.l_orderkey) AS "count" FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "delete_where": "SELECT * FROM customer WHERE NOT coalesce(c_acctbal < 0, false)",
    "count_deleted": "SELECT count(*) FILTER (WHERE c_acctbal < 0) AS deleted FROM customer",
    "append_rows": """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
UNION ALL
SELECT s_suppkey + 1000000000, s_name, s_nationkey, s_acctbal, NULL FROM supplier""",
    "update_by_key": """
SELECT c_custkey, c_name, c_nationkey,
       CASE WHEN c_nationkey = 0 THEN NULL ELSE c_acctbal END AS c_acctbal,
       CASE WHEN c_nationkey = 0 THEN 'PRIORITY' ELSE c_mktsegment END AS c_mktsegment
FROM customer""",
    "replace_by_key": """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
WHERE c_custkey NOT IN (SELECT s_suppkey * 15 FROM supplier)
UNION ALL
SELECT s_suppkey * 15, s_name, s_nationkey, s_acctbal, 'SUPPLIER' FROM supplier""",
    "json_schema_sample": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    "load_partition_roundtrip": f"""
SELECT event_id, user_id, ts, '20240114' AS partition_time FROM events WHERE {_EV_DAY}""",
    "load_append_twice": f"""
SELECT event_id, user_id, ts, '20240114' AS partition_time FROM events, (VALUES (1), (2)) r(copy)
WHERE {_EV_DAY}""",
    "collection_roundtrip": "SELECT c_custkey, c_name, c_acctbal FROM customer",
}
ORACLES["calls_gated_by_explode"] = ORACLES["calls_gated_by_bills"]
ORACLES["daily_increment_zoned"] = f"""
SELECT event_id, user_id, ts + INTERVAL 8 HOUR AS local_time FROM events
WHERE {_open_day("(ts + INTERVAL 8 HOUR)", "2024-01-14 00:00:00", "2024-01-15 00:00:00")}"""
ORACLES["daily_increment_wrapped"] = ORACLES["daily_increment"]
ORACLES["legacy_sql_call_record"] = _fanout(
    f"""SELECT mobile, dial_type, strftime(time, '%Y-%m-%d %H:%M:%S') AS time, peer_number, user_id,
               strftime(create_time, '%Y-%m-%d %H:%M:%S') AS create_time, details_id, duration
        FROM ({_M_CALLS}) c""",
    "CAST(time AS TIMESTAMP)", "CAST(create_time AS TIMESTAMP)",
    "mobile, dial_type, time, peer_number, user_id, create_time, details_id, duration")


def _skew(sql: str) -> str:
    """``sql`` over tables where one order and one customer hold a third of the rows."""
    li = ("(SELECT CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_orderkey END AS l_orderkey, l_linenumber, l_suppkey, "
          "l_returnflag, l_linestatus, l_quantity, l_shipdate FROM lineitem)")
    o = ("(SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 1 THEN 0 ELSE o_custkey END AS o_custkey, o_orderstatus, "
         "o_totalprice, o_orderdate, o_orderpriority FROM orders)")
    return re.sub(r"\b(FROM|JOIN) (lineitem|orders)\b( GROUP)?",
                  lambda m: f"{m[1]} {li if m[2] == 'lineitem' else o}" + (" AS t GROUP" if m[3] else ""), sql)


_SKEW_BEFORE = "date_trunc('second', TRY_CAST(create_time AS TIMESTAMP)) < TIMESTAMP '2001-08-03 00:00:00'"
ORACLES["unnest_calls_skewed"] = _skew(ORACLES["unnest_calls"])
ORACLES["nested_count_skewed"] = _skew(ORACLES["nested_count"])
ORACLES["provider_m_bills_skewed"] = _skew(
    f"SELECT *, '20010802' AS partition_time FROM ({_M_BILLS}) b WHERE {_SKEW_BEFORE}")
ORACLES["provider_m_calls_skewed"] = _skew(f"""
SELECT DISTINCT mobile, create_time, dial_type, time, peer_number, user_id, details_id, duration, type,
       '20010802' AS partition_time
FROM ({_fanout(f"SELECT * FROM ({_M_CALLS}) c WHERE n_bills > 0 AND {_SKEW_BEFORE}", "time", "create_time",
               "mobile, create_time, dial_type, time, peer_number, user_id, details_id, duration")}) f""")
ORACLES["provider_t_calls_skewed"] = _skew(f"""
SELECT DISTINCT mobile, create_time, dial_type, time, peer_number, user_id, {_to_int('duration')} AS duration,
       type, '20010802' AS partition_time
FROM ({_fanout(f"SELECT * FROM ({_T_CALLS}) c WHERE {_SKEW_BEFORE}", "TRY_CAST(time AS TIMESTAMP)",
               "TRY_CAST(create_time AS TIMESTAMP)",
               "mobile, create_time, dial_type, time, peer_number, user_id, duration")}) f""")
_T_DAY = _open_day("TRY_CAST(create_time AS TIMESTAMP)", "2001-07-28 00:00:00", "2001-07-29 00:00:00")
ORACLES["provider_t_calls_increment"] = f"""
SELECT DISTINCT mobile, create_time, dial_type, time, peer_number, user_id, {_to_int('duration')} AS duration,
       type, '20010728' AS partition_time
FROM ({_fanout(f"SELECT * FROM ({_T_CALLS}) c WHERE {_T_DAY}", "TRY_CAST(time AS TIMESTAMP)",
               "TRY_CAST(create_time AS TIMESTAMP)",
               "mobile, create_time, dial_type, time, peer_number, user_id, duration")}) f"""
ORACLES["contacts_increment_streamed"] = ORACLES["contacts_increment"]
# The same calls with JSON's types: times as text, duration as a long.
_M_CALLS_JSON = f"""
SELECT mobile, user_id, strftime(create_time, '%Y-%m-%d %H:%M:%S') AS create_time, peer_number, details_id,
       dial_type, CAST(duration AS BIGINT) AS duration, strftime(time, '%Y-%m-%d %H:%M:%S') AS time, n_bills
FROM ({_M_CALLS}) c"""
_M_DAY_TEXT = _open_day("TRY_CAST(create_time AS TIMESTAMP)", "2001-07-28 00:00:00", "2001-07-29 00:00:00")
ORACLES["provider_m_calls_from_json"] = f"""
SELECT DISTINCT mobile, create_time, dial_type, time, peer_number, user_id, details_id, duration, type,
       '20010728' AS partition_time
FROM ({_fanout(f"SELECT * FROM ({_M_CALLS_JSON}) c WHERE n_bills > 0 AND {_M_DAY_TEXT}",
               "TRY_CAST(time AS TIMESTAMP)", "TRY_CAST(create_time AS TIMESTAMP)",
               "mobile, create_time, dial_type, time, peer_number, user_id, details_id, duration")}) f"""
ORACLES["provider_t_calls_from_json"] = ORACLES["provider_t_calls"]

# Kept up or stored by day, the same rows.
ORACLES["provider_t_calls_maintained"] = ORACLES["provider_t_calls"]


def _shared(sql: str) -> str:
    """``sql`` over T documents of the customers of one key each: its latest customer's time, the key as user."""
    keyed = f"SELECT o_custkey, max(create_time) OVER (PARTITION BY o_custkey // 4) AS create_time FROM ({_DOCS}) __d"
    return sql.replace(f"({_DOCS})", f"({keyed})").replace("'U' || CAST(d.o_custkey AS VARCHAR)", "'H' || CAST(d.o_custkey // 4 AS VARCHAR)")


for _name in ("unnest_three_level", "provider_t_calls", "provider_t_bills"):
    ORACLES[f"{_name}_shared"] = _shared(ORACLES[_name]).replace("2000-01-01 00:00:00", "2001-07-01 00:00:00").replace("'19991231'", "'20010630'")
ORACLES["provider_t_calls_shared_skewed"] = _shared(ORACLES["provider_t_calls_skewed"].replace(_skew(f"({_DOCS})"), f"({_DOCS})")).replace(
    f"({_DOCS})", _skew(f"({_DOCS})"))

_M_DAY_CLOSED = _M_DAY.replace(" > ", " >= ")
ORACLES["provider_m_calls_left_closed"] = f"""
SELECT DISTINCT mobile, create_time, dial_type, time, peer_number, user_id, details_id, duration, type,
       '20010728' AS partition_time
FROM ({_fanout(f"SELECT * FROM ({_M_CALLS}) c WHERE n_bills > 0 AND {_M_DAY_CLOSED}", "time", "create_time",
               "mobile, create_time, dial_type, time, peer_number, user_id, details_id, duration", keep_outside=False)}) f"""
ORACLES["period_fanout_orders_yearly"] = _fanout(_ORDERS_LAST, "o_orderdate", "create_time", _ORDERS_COLS, (7, 365), 730)
ORACLES["yesterday_orders"] = """
SELECT o_orderkey, o_orderdate, DATE '1998-06-01' AS yesterday FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '1998-06-01'"""


def _events_day(lo: str, hi: str) -> str:
    return (f"SELECT event_id, user_id, ts, '{lo.replace('-', '')}' AS partition_time FROM events "
            f"WHERE {_open_day('ts', lo + ' 00:00:00', hi + ' 00:00:00')}")


ORACLES["load_catalog_partitions"] = "\nUNION ALL\n".join(
    [_events_day("2024-01-13", "2024-01-14")] * 2 + [_events_day("2024-01-14", "2024-01-15")])
ORACLES["refresh_catalog_table"] = ORACLES["real_name_refresh"]


def _count(sql: str) -> str:
    return f"(SELECT count(*) FROM ({sql}) __n)"


def _report(rows: list[tuple[str, str, str, str, str]]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{t}' AS target, CAST({sel} AS BIGINT) AS selected, CAST({bad} AS BIGINT) AS bad_time, "
        f"CAST({out} AS BIGINT) AS written, CAST({kept} AS BIGINT) AS stored" for t, sel, bad, out, kept in rows)


_NO_TIME = _count(f"SELECT 1 FROM ({_DOCS}) d WHERE create_time IS NULL")
_M_DOCS_DAY = _count(f"SELECT 1 FROM ({_DOCS}) d WHERE {_M_DAY}")
_M_CONTACTS = _count(f"SELECT 1 FROM events WHERE {_open_day('ts', '2001-07-28 00:00:00', '2001-07-29 00:00:00')}")
_T_DOCS = _count(f"SELECT 1 FROM ({_DOCS}) d WHERE {_T_BEFORE.replace('TRY_CAST(create_time AS TIMESTAMP)', 'create_time')}")
ORACLES["job_m_counts"] = _report([
    ("contacts", _M_CONTACTS, _count("SELECT 1 FROM events WHERE ts IS NULL"), _M_CONTACTS, _M_CONTACTS),
    ("real_names", "NULL", "NULL", _count("SELECT 1 FROM customer"), _count("SELECT 1 FROM customer")),
    ("bills", _M_DOCS_DAY, _NO_TIME, _count(ORACLES["provider_m_bills"]), _count(ORACLES["provider_m_bills"])),
    ("calls", _M_DOCS_DAY, _NO_TIME, _count(ORACLES["provider_m_calls"]), _count(ORACLES["provider_m_calls"]))])
ORACLES["job_t_counts"] = _report([
    (t, _T_DOCS, _NO_TIME, _count(ORACLES[f"provider_t_{t}"]), f"2 * {_count(ORACLES[f'provider_t_{t}'])}") for t in ("bills", "calls")])

_BY_YEAR = "SELECT o_orderkey, o_custkey, o_totalprice, CAST(year(o_orderdate) AS VARCHAR) AS year FROM orders"
ORACLES["update_touched"] = f"""
SELECT o_orderkey, o_custkey, CASE WHEN o_custkey % 10 = 0 AND year < '1997' THEN -1.0 ELSE o_totalprice END AS o_totalprice, year
FROM ({_BY_YEAR}) t"""
ORACLES["delete_touched"] = f"SELECT * FROM ({_BY_YEAR}) t WHERE NOT (year = '1995' AND o_totalprice > 100000 OR year = '1996')"
ORACLES["replace_touched"] = f"""
SELECT o_orderkey, o_custkey, CASE WHEN o_custkey % 10 = 3 AND year = '1994' THEN 0.0 ELSE o_totalprice END AS o_totalprice,
       CASE WHEN o_custkey % 10 = 3 AND year = '1994' THEN '1995' ELSE year END AS year
FROM ({_BY_YEAR}) t"""
_MISFITS = [("k % 29 = 0", "+added"), ("k % 17 = 0 AND k % 13 <> 0", "+parts[].note"), ("k % 19 = 0", "+place.city"),
            ("k % 7 = 0 OR k % 11 = 0", "customer"), ("k % 13 = 0", "parts"), ("k % 17 = 0 AND k % 13 <> 0", "parts[].qty"),
            ("k % 23 = 0 AND k % 19 <> 0", "place")]
ORACLES["rescued_values"] = f"""
SELECT k AS o_orderkey,
       CASE WHEN k % 31 = 0 OR k % 7 = 0 OR k % 11 = 0 THEN NULL ELSE CAST(o_custkey AS INTEGER) END AS customer,
       CASE WHEN k % 31 = 0 OR k % 13 = 0 OR k % 17 = 0 THEN NULL ELSE CAST(2.5 AS DOUBLE) END AS qty,
       CASE WHEN k % 31 <> 0 AND k % 19 = 0 THEN 5 END AS nation,
       CASE WHEN k % 31 = 0 THEN '$' ELSE concat_ws(' ', {", ".join(f"CASE WHEN {rule} THEN '{path}' END" for rule, path in _MISFITS)}) END AS misfits
FROM (SELECT o_orderkey AS k, o_custkey FROM orders) o"""
