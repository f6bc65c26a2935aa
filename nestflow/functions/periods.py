"""Trailing-period tagging.

A record with time ``t`` in a document created at ``c`` (both truncated to
whole seconds) belongs to the trailing *d*-day period iff
``c - d days < t < c`` -- open at both ends.  Periods are cumulative: a call
10 days old is in the 30, 60 and 90 day periods.  Inside the 180-day horizon
a record also gets the calendar-month label when it lies in a whole calendar
month before the creation month: ``month_start(t) < t < month_start(c)``
(strict, so 00:00:00 on the 1st does not qualify).  A record outside the
horizon (or at/after ``c``) is kept once with the label ``-1``; a record whose
only candidate label is the month label and fails it yields no row.

All of it is native Spark expressions (a ``when`` chain and one ``explode``),
so Catalyst can fold, push filters through and code-generate it; there is no
Python UDF.  Days are fixed 86,400-second lengths, as in the reference.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestflow.functions.scalars import month_start, to_ts, trunc_second

# Fixed values that must equal the reference's for right results:
#   trailing periods in days: 30, 60, 90
#   horizon in days: 180
#   label for "whole calendar months inside the horizon": "150"
#   label for "outside every period": "-1"
#   token meaning "outside every period" before relabelling: "0"
PERIOD_DAYS: tuple[int, ...] = (30, 60, 90)
HORIZON_DAYS: int = 180
MONTHS_LABEL = "150"
OUTSIDE_LABEL = "-1"
OUTSIDE_TOKEN = "0"


def _whole_seconds(c: str | Column) -> Column:
    return trunc_second(to_ts(c))


def _inside(t: Column, c: Column, days: int) -> Column:
    return (t > c - F.make_dt_interval(F.lit(days))) & (t < c)


def _month_rule(t: Column, c: Column) -> Column:
    return (t > month_start(t)) & (t < month_start(c))


def _bounds(periods: Sequence[int], horizon: int) -> list[int]:
    return [*sorted(periods), horizon]


def _passed(t: Column, c: Column, bounds: Sequence[int]) -> Column:
    """How many bounds the age has reached: ``0`` means inside every
    period, ``len(bounds)`` outside the horizon.  A plain sum of boolean
    casts (no conditionals), so ``t`` and ``c`` are evaluated once."""
    total = None
    for days in bounds:
        reached = (t <= c - F.make_dt_interval(F.lit(days))).cast("int")
        total = reached if total is None else total + reached
    return total


def day_divide(create: str | Column, time: str | Column,
               periods: Sequence[int] = PERIOD_DAYS,
               horizon: int = HORIZON_DAYS) -> Column:
    """The comma-separated cumulative list of periods a time falls in,
    e.g. ``'60,90,180'``; ``'0'`` when outside the horizon; NULL when either
    side is NULL or unparseable."""
    t, c = _whole_seconds(time), _whole_seconds(create)
    bounds = _bounds(periods, horizon)
    tokens = [",".join(str(d) for d in bounds[i:]) for i in range(len(bounds))] + [OUTSIDE_TOKEN]
    pick = F.element_at(F.array(*[F.lit(x) for x in tokens]), _passed(t, c, bounds) + 1)
    return F.when(t < c, pick).when(t.isNotNull() & c.isNotNull(), F.lit(OUTSIDE_TOKEN))


def time_parse(token: str | Column, create: str | Column, time: str | Column,
               periods: Sequence[int] = PERIOD_DAYS,
               horizon: int = HORIZON_DAYS) -> Column:
    """One token of :func:`day_divide` to its final label."""
    token = F.col(token) if isinstance(token, str) else token
    t, c = _whole_seconds(time), _whole_seconds(create)
    month = F.when(t.isNotNull() & c.isNotNull(),
                   F.when(_month_rule(t, c), F.lit(MONTHS_LABEL)).otherwise(F.lit(OUTSIDE_TOKEN)))
    passthrough = [str(d) for d in periods]
    return (F.when(t.isNull(), F.lit(None).cast("string"))
            .when(token == F.lit(str(horizon)), month)
            .when(token.isin(passthrough), token)
            .otherwise(F.lit(OUTSIDE_LABEL)))


def _candidates(t: Column, c: Column, periods: Sequence[int], horizon: int,
                keep_outside: bool) -> Column:
    """Candidate labels from whole-second ``TIMESTAMP_NTZ`` columns ``t`` and
    ``c``; a NULL element is a label that does not apply (dropped by a filter
    after the explode -- measured faster inside the generator than building
    the exact array)."""
    inside = F.array(
        *[F.when(_inside(t, c, d), F.lit(str(d))) for d in sorted(periods)],
        F.when(_month_rule(t, c), F.lit(MONTHS_LABEL)),
    )
    outside = F.array(F.lit(OUTSIDE_LABEL) if keep_outside else F.lit(None).cast("string"))
    return (F.when(t.isNull() | c.isNull(), F.lit(None).cast("array<string>"))
            .when(_inside(t, c, horizon), inside)
            .otherwise(outside))


def period_labels(create: str | Column, time: str | Column,
                  periods: Sequence[int] = PERIOD_DAYS,
                  horizon: int = HORIZON_DAYS,
                  keep_outside: bool = True) -> Column:
    """N11 as one array expression: the final labels of a record.

    NULL when either time is missing (no rows after explode); ``['-1']``
    outside the horizon (``[]`` with ``keep_outside=False``); otherwise the
    passing period labels plus the month label when it applies.
    """
    return F.array_compact(_candidates(_whole_seconds(time), _whole_seconds(create), periods, horizon, keep_outside))


def period_fanout(df: DataFrame, time: str, create: str, out: str = "type",
                  periods: Sequence[int] = PERIOD_DAYS, horizon: int = HORIZON_DAYS,
                  keep_outside: bool = True, method: str = "native") -> DataFrame:
    """One output row per label of each input row (a narrow Generate).

    ``method="tokens"`` evaluates the reference's literal route instead --
    token string, split, explode, relabel, drop ``'0'`` -- and must give the
    same rows; it exists to test the native form against.
    """
    if method == "native":
        # Parse and truncate each time once, in a projection below the
        # generator; explode the candidates and drop the ones that do not
        # apply with a plain filter (all of it stays in generated code).
        t, c = "__nf_t", "__nf_c"
        prepared = df.select("*", _whole_seconds(time).alias(t), _whole_seconds(create).alias(c))
        labels = F.explode(_candidates(F.col(t), F.col(c), periods, horizon, keep_outside))
        exploded = prepared.select(*df.columns, labels.alias(out))
        return exploded.filter(F.col(out).isNotNull())
    if method != "tokens":
        raise ValueError(f"unknown method {method!r}")
    tok = "__period_token"
    exploded = df.select("*", F.explode(F.split(day_divide(create, time, periods, horizon), ",")).alias(tok))
    labelled = exploded.withColumn(out, time_parse(F.col(tok), create, time, periods, horizon)).drop(tok)
    kept = labelled.filter(F.col(out) != F.lit(OUTSIDE_TOKEN))
    if not keep_outside:
        kept = kept.filter(F.col(out) != F.lit(OUTSIDE_LABEL))
    return kept
