"""nestflow: nested documents to clean, partitioned tables, on Spark.

Every operator is a plain function from DataFrame (or Column) to DataFrame
(or Column), built from native Spark expressions.  The run date is always a
parameter (:class:`nestflow.functions.clock.RunClock`), never ``now()``
inside a query.
"""

from nestflow.functions.clock import RunClock

__all__ = ["RunClock"]
__version__ = "0.1.0"
