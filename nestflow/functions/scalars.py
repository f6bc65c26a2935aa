"""Lenient scalar functions.

Spark 4 runs with ANSI mode on, where a plain ``CAST`` or ``unix_timestamp``
raises on bad text.  Source documents hold text typed by other systems, so
every parse here is a ``try_*`` form: bad input gives NULL, never an error,
whatever the session's ANSI flag.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text accepted as a number by to_int: optional sign, digits, optional
# fraction (Spark 2's string-to-int rule, which truncates the fraction).
NUMBER_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)\s*$"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_ts(c: str | Column) -> Column:
    """Any timestamp-like value as a wall-clock ``TIMESTAMP_NTZ``.

    Text in ``yyyy-MM-dd HH:mm:ss`` (with or without a fraction, or a bare
    date) is parsed; unparseable text gives NULL.  ``TIMESTAMP_NTZ`` passes
    through, ``DATE`` becomes midnight, and ``TIMESTAMP`` is read as wall
    clock in the session zone.
    """
    return _col(c).try_cast("timestamp_ntz")


def wall_clock(c: str | Column, tz: str) -> Column:
    """A ``TIMESTAMP`` (an instant) as ``TIMESTAMP_NTZ``, the wall clock in ``tz``.

    Counted from the instant's microseconds, so the session zone plays no part.
    """
    return _epoch() + F.make_dt_interval(secs=(F.unix_micros(F.from_utc_timestamp(_col(c), tz)) / F.lit(1000000).cast("decimal(7,0)")).cast("decimal(18,6)"))


def instant_of_utc(c: str | Column) -> Column:
    """The ``TIMESTAMP`` at which the clock in UTC shows a ``TIMESTAMP_NTZ``, whatever the session zone."""
    c = _col(c)
    days = F.datediff(c.cast("date"), F.lit("1970-01-01").cast("date")).cast("decimal(18,6)")
    seconds = days * 86400 + F.hour(c) * 3600 + F.minute(c) * 60 + F.date_part(F.lit("SECOND"), c)
    return F.timestamp_micros((seconds * 1000000).cast("long"))


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def trunc_second(ts: Column) -> Column:
    """Drop the fraction of a second of a ``TIMESTAMP_NTZ`` (zone-free)."""
    sec = F.date_part(F.lit("SECOND"), ts)
    return ts - F.make_dt_interval(secs=sec - F.floor(sec))


def month_start(c: str | Column) -> Column:
    """Midnight of the first day of the value's month, as ``TIMESTAMP_NTZ``."""
    return F.trunc(to_ts(c).cast("date"), "MM").cast("timestamp_ntz")


def to_int(c: str | Column) -> Column:
    """Lenient text-to-int: ``'12'`` and ``'12.5'`` give 12, ``'-12.9'``
    gives -12, anything else (or overflow) gives NULL."""
    c = _col(c)
    return F.when(
        c.cast("string").rlike(NUMBER_TEXT),
        c.try_cast("decimal(38,6)").try_cast("int"),
    )


def zero_if_null(c: str | Column) -> Column:
    return F.coalesce(_col(c), F.lit(0))


def split_list(c: str | Column, sep: str = ",") -> Column:
    """Split delimited text into an array (``sep`` is literal, not a regex)."""
    import re

    return F.split(_col(c), re.escape(sep))
