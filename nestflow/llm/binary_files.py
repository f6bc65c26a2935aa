"""Binary files written and read through Spark's own file systems.

Executors need no mounted folder: the bytes go through Spark's writer, with
its commit protocol, so a lost executor or a repeated task leaves no half
file.  The text writer puts a fixed separator after each row; with one row a
file, that separator is the file's trailer (the formats here end with a
magic number).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_files(data: DataFrame, column: str, trailer: bytes, path: str) -> None:
    """One file for each row: its ``column`` (binary), then ``trailer``."""
    (data.select(F.col(column).cast("string"))
     .write.option("maxRecordsPerFile", 1).option("encoding", "ISO-8859-1")
     .option("lineSep", trailer.decode("latin-1")).text(path))


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """``path``, ``content`` of each file written by ``write_files``."""
    return (spark.read.schema("path string, modificationTime timestamp, length long, content binary")
            .format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content"))
