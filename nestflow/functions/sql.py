"""``day_divide``, ``time_parse`` and ``yesterday`` for SQL callers.

``register_sql_functions(spark)`` defines them for the session as SQL
functions (``CREATE TEMPORARY FUNCTION ... RETURN <expression>``), not UDFs:
the analyzer inlines the expression, so it is optimised, constant-folded and
code-generated like any built-in.

``day_divide(created, time)`` takes epoch seconds, with days of 86,400
seconds, and gives the comma-separated periods; ``time_parse(token,
create_time, call_time, time)`` turns one of them into a label, taking month
starts from the first seven characters of the time texts in the session time
zone.  A NULL epoch argument gives NULL.  What a caller passes is the
caller's: under ANSI mode ``unix_timestamp`` raises on text that is no time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from nestflow.functions.periods import (
    HORIZON_DAYS,
    MONTHS_LABEL,
    OUTSIDE_LABEL,
    OUTSIDE_TOKEN,
    PERIOD_DAYS,
)

DAY_SECONDS = 86_400


def day_divide_sql(periods: Sequence[int] = PERIOD_DAYS, horizon: int = HORIZON_DAYS) -> str:
    bounds = [*sorted(periods), horizon]
    whens = []
    for i, days in enumerate(bounds):
        tokens = ",".join(str(d) for d in bounds[i:])
        whens.append(f"WHEN create_time - {days * DAY_SECONDS} < time AND time < create_time THEN '{tokens}'")
    return ("CASE WHEN create_time IS NULL OR time IS NULL THEN NULL "
            + " ".join(whens) + f" ELSE '{OUTSIDE_TOKEN}' END")


def time_parse_sql(periods: Sequence[int] = PERIOD_DAYS, horizon: int = HORIZON_DAYS) -> str:
    def month(x: str) -> str:
        return f"unix_timestamp(try_to_timestamp(substr({x}, 1, 7), 'yyyy-MM'))"
    passthrough = ", ".join(f"'{d}'" for d in periods)
    return (f"CASE WHEN time IS NULL THEN NULL "
            f"WHEN types = '{horizon}' THEN CASE WHEN {month('call_time')} < time "
            f"AND time < {month('create_time')} THEN '{MONTHS_LABEL}' ELSE '{OUTSIDE_TOKEN}' END "
            f"WHEN types IN ({passthrough}) THEN types ELSE '{OUTSIDE_LABEL}' END")


def register_sql_functions(spark: SparkSession, periods: Sequence[int] = PERIOD_DAYS,
                           horizon: int = HORIZON_DAYS) -> None:
    """Define ``day_divide``, ``time_parse`` and ``yesterday`` for ``spark.sql``."""
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION day_divide(create_time BIGINT, time BIGINT) "
              f"RETURNS STRING RETURN {day_divide_sql(periods, horizon)}")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION time_parse(types STRING, create_time STRING, "
              "call_time STRING, time BIGINT) "
              f"RETURNS STRING RETURN {time_parse_sql(periods, horizon)}")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION yesterday() RETURNS DATE "
              "RETURN date_sub(current_date(), 1)")
