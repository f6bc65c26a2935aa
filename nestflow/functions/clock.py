"""Run clock.

The daily jobs work on "yesterday" relative to a run day in one explicit
zone.  The run day is a parameter so that a re-run of an old day gives the
same result; ``RunClock.now`` is the only place that reads the wall clock,
and it does so once, on the driver, before any query is built.

Bounds are *wall-clock* ``TIMESTAMP_NTZ`` literals in ``tz`` for text and
``TIMESTAMP_NTZ`` columns (wall-clock times of the same zone), and the instants
at which that zone's clock shows them for ``TIMESTAMP`` columns.  Neither
depends on the session time zone.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for right results:
#   run-clock zone: Asia/Shanghai
#   partition value: the run day minus one, formatted yyyyMMdd
DEFAULT_TZ = "Asia/Shanghai"
PARTITION_FORMAT = "%Y%m%d"


def ntz_literal(value: _dt.datetime | _dt.date) -> Column:
    """A constant-folded ``TIMESTAMP_NTZ`` literal (pushes into scans)."""
    if not isinstance(value, _dt.datetime):
        value = _dt.datetime(value.year, value.month, value.day)
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def instant_literal(value: _dt.datetime | _dt.date, tz: str) -> Column:
    """The ``TIMESTAMP`` at which the clock in ``tz`` shows ``value``, constant-folded (pushes into scans)."""
    if not isinstance(value, _dt.datetime):
        value = _dt.datetime(value.year, value.month, value.day)
    return F.timestamp_seconds(F.lit(int(value.replace(tzinfo=ZoneInfo(tz)).timestamp())))


@dataclass(frozen=True)
class RunClock:
    """The run day ``as_of`` ("today") and its derived bounds."""

    as_of: _dt.date
    tz: str = DEFAULT_TZ

    @classmethod
    def of(cls, as_of: str | _dt.date | _dt.datetime, tz: str = DEFAULT_TZ) -> "RunClock":
        if isinstance(as_of, str):
            as_of = _dt.date.fromisoformat(as_of.replace("/", "-")) if "-" in as_of or "/" in as_of \
                else _dt.datetime.strptime(as_of, "%Y%m%d").date()
        elif isinstance(as_of, _dt.datetime):
            as_of = as_of.date()
        ZoneInfo(tz)  # validate early
        return cls(as_of, tz)

    @classmethod
    def now(cls, tz: str = DEFAULT_TZ) -> "RunClock":
        return cls(_dt.datetime.now(ZoneInfo(tz)).date(), tz)

    @property
    def today(self) -> _dt.date:
        return self.as_of

    @property
    def yesterday(self) -> _dt.date:
        return self.as_of - _dt.timedelta(days=1)

    @property
    def today_start(self) -> _dt.datetime:
        return _dt.datetime(self.today.year, self.today.month, self.today.day)

    @property
    def yesterday_start(self) -> _dt.datetime:
        y = self.yesterday
        return _dt.datetime(y.year, y.month, y.day)

    @property
    def today_text(self) -> str:
        return self.today.strftime(PARTITION_FORMAT)

    @property
    def yesterday_text(self) -> str:
        return self.yesterday.strftime(PARTITION_FORMAT)

    @property
    def partition_value(self) -> str:
        """Partition written by a daily run: run day minus one, ``yyyyMMdd``."""
        return self.yesterday_text

    def today_start_col(self) -> Column:
        return ntz_literal(self.today_start)

    def yesterday_start_col(self) -> Column:
        return ntz_literal(self.yesterday_start)

    def epoch_seconds(self, day: _dt.date) -> int:
        """Epoch seconds of midnight of ``day`` in ``tz`` (the reference's unit)."""
        return int(_dt.datetime(day.year, day.month, day.day, tzinfo=ZoneInfo(self.tz)).timestamp())


def yesterday(clock: RunClock | None = None) -> Column:
    """``yesterday()`` as a DATE column: from the clock if given, else the session date."""
    if clock is None:
        return F.date_sub(F.current_date(), 1)
    return F.lit(clock.yesterday.isoformat()).cast("date")
