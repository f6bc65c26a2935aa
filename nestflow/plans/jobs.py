"""The two daily jobs, composed from the datasets and the sinks.

Each load is its own action, in a fixed order, so a failure leaves the
earlier loads in place; ``mode="overwrite"`` makes a re-run of the day
replace its own partitions instead of adding to them.  The datasets read
the collection separately, each with its narrow schema and pushed day
filter -- cheaper at scale than caching one wide frame for all of them.

A job returns what each load counted on its way, without another pass:
``selected`` (documents or rows of the run), ``bad_time`` (those that no run
loads, because their time is missing or no time) and ``written``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from nestflow.functions.clock import RunClock
from nestflow.plans import datasets as P
from nestflow.sources.sinks import PARTITION_COL, load_partition, refresh_table

#: Targets that are rooted in a database or a folder: a table name or a path each.
Targets = Mapping[str, str]
Counts = dict[str, dict[str, int]]


def _read(counts: Observation, *names: str) -> dict[str, int]:
    """What was observed; input that Spark knows to be empty is not even looked at."""
    return counts.get if counts._jo.getRow().length() else dict.fromkeys(names, 0)


def _counted(build: Callable[[Observation | None], DataFrame], write: Callable[[DataFrame], None], selects: bool = True) -> dict[str, int]:
    """Build a dataset, write it, and return the counts of the one action."""
    seen, done = Observation(), Observation()
    out = build(seen if selects else None).observe(done, F.count(F.lit(1)).alias("written"))
    write(out)
    return {**(_read(seen, "selected", "bad_time") if selects else {}), **_read(done, "written")}


def _load(target: str, clock: RunClock, mode: str) -> Callable[[DataFrame], None]:
    return lambda out: load_partition(out.drop(PARTITION_COL), target, clock.partition_value, mode=mode)


def provider_m_job(documents: DataFrame, contacts: DataFrame, real_names: DataFrame, clock: RunClock,
                   targets: Targets, mode: str = "append", bounds: str = "open") -> Counts:
    """Contacts increment, real-name refresh, bills and call records of the
    day before ``clock``'s run day (targets: contacts, real_names, bills,
    calls)."""
    return {
        "contacts": _counted(lambda c: P.contacts_increment(contacts, clock, bounds, c), _load(targets["contacts"], clock, mode)),
        "real_names": _counted(lambda _: P.real_name_refresh(real_names), lambda out: refresh_table(out, targets["real_names"]), selects=False),
        "bills": _counted(lambda c: P.provider_m_bills(documents, clock, bounds, counts=c), _load(targets["bills"], clock, mode)),
        "calls": _counted(lambda c: P.provider_m_calls(documents, clock, bounds, counts=c), _load(targets["calls"], clock, mode)),
    }


def provider_t_job(documents: DataFrame, clock: RunClock, targets: Targets,
                   mode: str = "append", selection: str = "snapshot", bounds: str = "open") -> Counts:
    """Bills and call records (targets: bills, calls): a cumulative ``snapshot``,
    or the day's documents only (``selection="increment"``)."""
    return {
        "bills": _counted(lambda c: P.provider_t_bills(documents, clock, selection, bounds, c), _load(targets["bills"], clock, mode)),
        "calls": _counted(lambda c: P.provider_t_calls(documents, clock, selection=selection, bounds=bounds, counts=c), _load(targets["calls"], clock, mode)),
    }
