"""Time selection for daily runs.

The reference compared ``unix_timestamp(col)`` -- whole seconds -- with the
epoch of midnight.  Wrapping the column in a function stops the filter from
reaching the scan.  Here, when the column already is a timestamp, the same
whole-second test is rewritten onto the raw column so Parquet receives it as
a pushed filter:

* ``trunc(t) <  hi``  <=>  ``t <  hi``          (``hi`` is a whole second)
* ``trunc(t) >  lo``  <=>  ``t >= lo + 1 s``
* ``trunc(t) >= lo``  <=>  ``t >= lo``

A ``TIMESTAMP`` column holds instants: it is compared with the instants at
which the run clock's zone reaches those bounds, whatever the session zone.

Text columns are parsed leniently first (no pushdown is possible for them),
unless the collection was staged with the parsed time beside the text
(:func:`with_stored_time`): then that typed column is compared in its place
and the filter reaches the scan, whatever the text looks like.  Where the
staged day of the time is a partition of the collection, the days of the run
are named too, so folders of other days are not opened.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestflow.functions.clock import DEFAULT_TZ, RunClock, instant_literal, ntz_literal
from nestflow.functions.scalars import to_ts, trunc_second, wall_clock


def _type(df: DataFrame, col: str) -> T.DataType:
    if "." not in col and col in df.columns:  # the frame's schema is cached
        return df.schema[col].dataType
    return df.select(F.col(col)).schema.fields[0].dataType


def _literal(kind: T.DataType, value: _dt.datetime | _dt.date | Column, tz: str) -> Column:
    """``value`` (wall clock in ``tz``) to compare a column of type ``kind`` with."""
    if isinstance(value, Column):
        return value
    return instant_literal(value, tz) if isinstance(kind, T.TimestampType) else ntz_literal(value)


_TS_TYPES = (T.TimestampNTZType, T.TimestampType)


#: Columns that staging adds for a time column, by its name.
TIME_PREFIX, DAY_PREFIX = "nf_time_of_", "nf_day_of_"


def with_stored_time(df: DataFrame, ts_col: str, tz: str = DEFAULT_TZ) -> DataFrame:
    """``df`` with the day of ``ts_col`` and, for text, the time parsed from it.

    ``nf_time_of_<ts_col>`` (text columns only) is the ``TIMESTAMP_NTZ`` the
    selections would parse, NULL for text that is no time; ``nf_day_of_<ts_col>``
    is the wall-clock date, in ``tz`` for instants.  The column itself stays as it is.
    """
    kind = _type(df, ts_col)
    if isinstance(kind, _TS_TYPES):
        wall = wall_clock(ts_col, tz) if isinstance(kind, T.TimestampType) else F.col(ts_col)
    else:
        df = df.withColumn(TIME_PREFIX + ts_col, to_ts(ts_col))
        wall = F.col(TIME_PREFIX + ts_col)
    return df.withColumn(DAY_PREFIX + ts_col, wall.cast("date"))


def stored_time(df: DataFrame, ts_col: str) -> str:
    """The column that holds the time of ``ts_col`` as a timestamp if staging has put one beside it, else ``ts_col``."""
    name = TIME_PREFIX + ts_col
    return name if name in df.columns and isinstance(df.schema[name].dataType, T.TimestampNTZType) else ts_col


def _in_days(df: DataFrame, ts_col: str, low: _dt.date | None, high: _dt.date) -> Column:
    """Days from ``low`` on and before ``high``, for partition pruning; true if the day is not stored."""
    name = DAY_PREFIX + ts_col
    if name not in df.columns or not isinstance(df.schema[name].dataType, T.DateType):
        return F.lit(True)
    before_high = F.col(name) < F.lit(high)
    return before_high if low is None else (F.col(name) >= F.lit(low)) & before_high


def _as_datetime(value: _dt.datetime | _dt.date) -> _dt.datetime:
    return value if isinstance(value, _dt.datetime) else _dt.datetime(value.year, value.month, value.day)


def _between(df: DataFrame, ts_col: str, low: _dt.datetime | None, high: _dt.datetime, tz: str, after: bool = False) -> Column:
    """Whole seconds from ``low`` on (``after``: later than it) and before ``high``, wall clock in ``tz``; both whole seconds."""
    own = stored_time(df, ts_col)
    kind = _type(df, own)
    if low is not None and after:
        low += _dt.timedelta(seconds=1)
    t = F.col(own) if isinstance(kind, _TS_TYPES) else trunc_second(to_ts(own))
    test = t < _literal(kind, high, tz)
    if low is not None:
        test = (t >= _literal(kind, low, tz)) & test
    last = high.date() if high.time() == _dt.time() else high.date() + _dt.timedelta(days=1)
    return test & _in_days(df, ts_col, low.date() if low is not None else None, last)


def before(df: DataFrame, ts_col: str, bound: _dt.datetime | _dt.date | Column, tz: str = DEFAULT_TZ) -> DataFrame:
    """whole-second ``t < bound`` (cumulative snapshot up to the bound,
    a wall-clock time in ``tz``, or a column)."""
    if not isinstance(bound, Column):
        return df.filter(_between(df, ts_col, None, _as_datetime(bound), tz))
    own = stored_time(df, ts_col)
    typed = isinstance(_type(df, own), _TS_TYPES)
    return df.filter((F.col(own) if typed else trunc_second(to_ts(own))) < bound)


def since(df: DataFrame, ts_col: str, low: _dt.date, clock: RunClock) -> DataFrame:
    """Rows from midnight of ``low`` on and before the run day: the days that a run after one of ``low`` has to add."""
    return df.filter(_between(df, ts_col, _as_datetime(low), clock.today_start, clock.tz))


def _day(df: DataFrame, ts_col: str, clock: RunClock, bounds: str) -> Column:
    if bounds not in ("open", "left_closed"):
        raise ValueError(f"unknown bounds {bounds!r}")
    return _between(df, ts_col, clock.yesterday_start, clock.today_start, clock.tz, after=bounds == "open")


def in_day(df: DataFrame, ts_col: str, clock: RunClock, bounds: str = "open") -> DataFrame:
    """rows of the day before the run day (daily increment).

    ``bounds="open"`` is the source systems' rule: strictly after yesterday's
    midnight and strictly before today's, so a row at exactly 00:00:00
    belongs to no run.  ``"left_closed"`` keeps midnight rows in their day.
    """
    return df.filter(_day(df, ts_col, clock, bounds))


def select_run(df: DataFrame, ts_col: str, clock: RunClock, selection: str = "increment",
               bounds: str = "open", counts: Observation | None = None) -> DataFrame:
    """The rows a daily run loads: ``"increment"`` -- the day before the run
    (F2) -- or ``"snapshot"`` -- everything before the run day (F1), i.e.
    the whole history again in every partition.

    ``counts`` observes, in the same scan, ``selected`` (the run's rows) and
    ``bad_time`` (rows without a valid time, which no run loads).
    """
    if selection == "increment":
        test = _day(df, ts_col, clock, bounds)
    elif selection == "snapshot":
        test = _between(df, ts_col, None, clock.today_start, clock.tz)
    else:
        raise ValueError(f"unknown selection {selection!r}")
    if counts is None:
        return df.filter(test)
    own = stored_time(df, ts_col)
    bad = F.col(own).isNull() if isinstance(_type(df, own), _TS_TYPES) else to_ts(own).isNull()
    if DAY_PREFIX + ts_col in df.columns:  # no time, no day: other days' folders stay closed
        bad = bad & F.col(DAY_PREFIX + ts_col).isNull()
    # One filter for both, so that it reaches the scan; what has no time is counted and goes.
    both = df.filter(test | bad).observe(counts, F.count_if(~bad).alias("selected"), F.count_if(bad).alias("bad_time"))
    return both.filter(~bad)


def drop_label(df: DataFrame, col: str, label: str = "0") -> DataFrame:
    """drop rows carrying a sentinel label (NULL labels are dropped too,
    as in SQL's ``col != label``)."""
    return df.filter(F.col(col) != F.lit(label))
