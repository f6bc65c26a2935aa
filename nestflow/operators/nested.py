"""Projections through nesting and unnesting generators.

Unnesting is always an *inner* ``explode``: a NULL or empty array yields no
rows for that element, and never nulls its siblings.  Several levels are
exploded one level at a time -- never with ``flatten``, which turns the whole
outer array NULL when one inner array is NULL and so loses the good siblings.

Every step is a narrow ``Generate``: no shuffle, rows stay in the partition
that read them, and Catalyst collapses the projections in between.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cols(names: Sequence[str | Column]) -> list[Column]:
    return [F.col(n) if isinstance(n, str) else n for n in names]


def field(path: str, alias: str | None = None) -> Column:
    """A dotted path as a column.  Through an array of structs the
    result is the array of that field (``calls.items`` -> array of arrays)."""
    return F.col(path).alias(alias or path.split(".")[-1])


def flatten_struct(df: DataFrame, struct_col: str, fields: Sequence[str] | None = None,
                   keep: Sequence[str | Column] = (),
                   rename: Mapping[str, str] | None = None) -> DataFrame:
    """The fields of a struct column as flat columns (next to ``keep``)."""
    if fields is None:
        fields = [f.name for f in df.schema[struct_col].dataType.fields]
    rename = rename or {}
    return df.select(*_cols(keep), *[F.col(f"{struct_col}.{f}").alias(rename.get(f, f)) for f in fields])


def unnest(df: DataFrame, col: str | Column, alias: str,
           keep: Sequence[str | Column] | None = None, depth: int = 1) -> DataFrame:
    """Explode ``col`` ``depth`` times (array, array of arrays, ...).

    ``keep`` defaults to every other column.  A NULL or empty array at any
    level drops only the element that holds it.
    """
    if isinstance(col, str):
        src = F.col(col)
        keep = [c for c in df.columns if c != col] if keep is None else keep
    else:
        src = col
        keep = df.columns if keep is None else keep
    out = df.select(*_cols(keep), F.explode(src).alias(alias))
    kept = [c for c in out.columns if c != alias]
    for _ in range(depth - 1):
        out = out.select(*kept, F.explode(F.col(alias)).alias(alias))
    return out


def unnest_path(df: DataFrame, path: Sequence[str], keep: Sequence[str | Column] = (),
                carry: Mapping[int, Mapping[str, str]] | None = None,
                alias: str = "item") -> DataFrame:
    """Walk a path of nested arrays, one explode per level.

    ``path[0]`` is a (dotted) array column of ``df``; each following name is
    an array field of the element exploded before it.  ``carry[i]`` maps
    output names to (dotted) fields of the level-``i`` element that are kept
    on the way down, e.g. the phone stored beside the call list::

        unnest_path(docs, ["resp.data.data_list", "teldata", "items"],
                    keep=["user_id", "create_time"],
                    carry={0: {"mobile": "userdata.phone"}})
    """
    carry = carry or {}
    keep_cols = _cols(keep)
    cur = df.select(*keep_cols, F.explode(F.col(path[0])).alias("__e0"))
    kept = [c for c in cur.columns if c != "__e0"]
    for level, name in enumerate(path[1:], start=1):
        prev = f"__e{level - 1}"
        extra = [F.col(f"{prev}.{src}").alias(dst) for dst, src in carry.get(level - 1, {}).items()]
        cur = cur.select(*kept, *extra, F.explode(F.col(f"{prev}.{name}")).alias(f"__e{level}"))
        kept = [c for c in cur.columns if c != f"__e{level}"]
    last = f"__e{len(path) - 1}"
    extra = [F.col(f"{last}.{src}").alias(dst) for dst, src in carry.get(len(path) - 1, {}).items()]
    return cur.select(*kept, *extra, F.col(last).alias(alias))


def split_explode(df: DataFrame, col: str, alias: str, sep: str = ",",
                  keep: Sequence[str | Column] | None = None) -> DataFrame:
    """Split delimited text and emit one row per token (NULL -> no row)."""
    from nestflow.functions.scalars import split_list

    keep = df.columns if keep is None else keep
    return df.select(*_cols(keep), F.explode(split_list(col, sep)).alias(alias))


def require_nonempty(df: DataFrame, array_col: str, count_col: str | None = None) -> DataFrame:
    """keep documents whose array has at least one element.

    Equals exploding the array, ignoring its elements and de-duplicating
    afterwards (what the reference does), without multiplying rows first.
    ``count_col``: a column with the element count of the whole document, for
    documents that are stored in pieces; without such a column the array
    itself decides.
    """
    if count_col in df.columns:
        return df.filter(F.coalesce(F.col(count_col) > 0, F.lit(False)))
    return df.filter(F.coalesce(F.size(F.col(array_col)) > 0, F.lit(False)))


def count_nested(df: DataFrame, array_path: str, field_name: str,
                 alias: str = "count", continued: str | None = None) -> DataFrame:
    """A1: non-NULL count of ``element.field`` after ONE explode of
    ``array_path``.  Over an array of arrays (``calls.items``) an element is a
    whole inner array, so this counts call groups whose item list is not
    NULL -- not calls.  Partial counts are combined map-side: one row per
    partition crosses the shuffle.

    ``continued``: a flag beside the last array of ``array_path``; elements
    that have it set continue another one and are not counted again."""
    if continued:
        outer, inner = array_path.rsplit(".", 1)
        return (df.select(F.explode(F.col(outer)).alias("__group"))
                  .filter(~F.coalesce(F.col(f"__group.{continued}"), F.lit(False)))
                  .agg(F.count(F.col(f"__group.{inner}.{field_name}")).alias(alias)))
    return (df.select(F.explode(F.col(array_path)).alias("__item"))
              .agg(F.count(F.col(f"__item.{field_name}")).alias(alias)))
