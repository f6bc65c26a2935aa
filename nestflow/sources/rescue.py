"""Documents that do not fit a given schema.

Spark's JSON parser gives NULL for a value that its type cannot hold and
passes over fields it does not know, without a trace.  Here both are named,
beside the parsed document, so nothing is lost unseen: the document goes on
with what fits, and what does not is routed to a side output.

A path is dotted, ``[]`` stands for an array's elements.  Reported are:

* ``$``: the line is no JSON object (its fields are all NULL);
* ``path``: a value is there and its type cannot hold it (a widened number,
  text for a number, an object for an array, ...);
* ``+path``: a field that the schema does not have.

All of it is built from the schema as Spark expressions; no row leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The column that holds the reported paths, sorted, each once; empty if all fits.
RESCUED_COL = "nf_rescued"
_PARSE = {"mode": "PERMISSIVE"}


def _none() -> Column:
    return F.array().cast("array<string>")


def _misfits(raw: Column, typed: Column, kind: T.DataType, path: str) -> Column:
    """Paths at and below ``path`` that do not fit; ``raw``: the value as JSON text, NULL where it is missing or null."""
    if isinstance(kind, T.StructType):
        fields = F.from_json(raw, T.MapType(T.StringType(), T.StringType()), _PARSE)
        dot = f"{path}." if path else ""
        found = [_misfits(F.element_at(fields, F.lit(f.name)), typed.getField(f.name), f.dataType, dot + f.name) for f in kind.fields]
        late = F.transform(F.array_except(F.map_keys(fields), F.array(*[F.lit(f.name) for f in kind.fields]).cast("array<string>")),
                           lambda name: F.concat(F.lit(f"+{dot}"), name))
        inside = F.concat(late, *found)
        # Fields of what is no object are all NULL; Spark gives no map for it.
        return (F.when(raw.isNull(), _none()).when(fields.isNull() | ~F.ltrim(raw).startswith("{"), F.array(F.lit(path or "$")))
                .otherwise(inside))
    if isinstance(kind, T.ArrayType):
        items = F.from_json(raw, T.ArrayType(T.StringType()), _PARSE)
        whole = F.array(F.lit(path))
        inside = F.flatten(F.transform(F.arrays_zip(items.alias("r"), typed.alias("t")),
                                       lambda x: _misfits(x["r"], x["t"], kind.elementType, f"{path}[]")))
        return (F.when(raw.isNull(), _none()).when(typed.isNull() | items.isNull() | ~F.ltrim(raw).startswith("["), whole)
                .otherwise(F.array_distinct(inside)))
    return F.when(raw.isNotNull() & typed.isNull(), F.array(F.lit(path))).otherwise(_none())


def parse_json_rescued(df: DataFrame, col: str, schema: T.StructType, keep: list[str] | None = None) -> DataFrame:
    """JSON text column -> its fields as columns (as ``parse_json_column``), with ``nf_rescued``.

    A NULL text has NULL fields and nothing to report.
    """
    keep = [c for c in df.columns if c != col] if keep is None else keep
    text = F.col(col)
    parsed = df.select(*keep, text.alias("__raw"), F.from_json(text, schema, _PARSE).alias("__doc"))
    paths = F.array_sort(F.array_distinct(_misfits(F.col("__raw"), F.col("__doc"), schema, "")))
    return parsed.select(*keep, "__raw", "__doc", paths.alias(RESCUED_COL)).select(*keep, "__doc.*", RESCUED_COL, F.col("__raw").alias(col))


def split_rescued(parsed: DataFrame, col: str) -> tuple[DataFrame, DataFrame]:
    """(documents, side output) of ``parse_json_rescued``.

    Documents are all rows without the two extra columns; a line that is no
    object is in the side output only.  The side output has, of every row
    that does not fit, all columns with the text and the paths.
    """
    broken = F.array_contains(RESCUED_COL, "$")
    documents = parsed.filter(~broken).drop(RESCUED_COL, col)
    return documents, parsed.filter(F.size(RESCUED_COL) > 0)
