"""Column-level functions: run clock, lenient scalars and period tagging."""

from nestflow.functions.clock import RunClock, yesterday
from nestflow.functions.periods import (
    HORIZON_DAYS,
    PERIOD_DAYS,
    day_divide,
    period_fanout,
    period_labels,
    time_parse,
)
from nestflow.functions.sql import register_sql_functions
from nestflow.functions.scalars import (
    month_start,
    split_list,
    to_int,
    to_ts,
    trunc_second,
    zero_if_null,
)

__all__ = [
    "RunClock", "yesterday", "PERIOD_DAYS", "HORIZON_DAYS", "day_divide",
    "period_fanout", "period_labels", "time_parse", "register_sql_functions", "month_start", "split_list", "to_int",
    "to_ts", "trunc_second", "zero_if_null",
]
