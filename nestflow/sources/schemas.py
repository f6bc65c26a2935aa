"""Narrow read schemas from the paths that a pipeline uses.

A nested collection is read with a schema that holds only the leaves in use,
so Parquet skips the others at any depth and JSON does not build them.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import types as T

_NAME = re.compile(r"`((?:[^`]|``)+)`|([^.`]+)")


def split_path(path: str) -> list[str]:
    """The names of a dotted path; a name with dots stands in backquotes."""
    names, at = [], 0
    while True:
        found = _NAME.match(path, at)
        if not found:
            raise ValueError(f"no field path: {path!r}")
        names.append(found[1].replace("``", "`") if found[1] else found[2])
        at = found.end()
        if at == len(path):
            return names
        if path[at] != ".":
            raise ValueError(f"no field path: {path!r}")
        at += 1


def _narrow(kind: T.DataType, paths: list[list[str]], where: str) -> T.DataType:
    if any(not p for p in paths):  # the whole value is used
        return kind
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_narrow(kind.elementType, paths, where), kind.containsNull)
    if isinstance(kind, T.MapType):  # a path goes on in the values; keys are needed to tell them apart
        return T.MapType(kind.keyType, _narrow(kind.valueType, paths, where), kind.valueContainsNull)
    if not isinstance(kind, T.StructType):
        raise ValueError(f"{where or 'the schema'} has no field {paths[0][0]!r}: it is {kind.simpleString()}")
    below: dict[str, list[list[str]]] = {}
    for first, *rest in paths:
        below.setdefault(first, []).append(rest)
    if missing := sorted(set(below) - set(kind.fieldNames())):
        raise ValueError(f"{where or 'the schema'} has no field {missing[0]!r}")
    return T.StructType([T.StructField(f.name, _narrow(f.dataType, below[f.name], f"{where}.{f.name}".lstrip(".")), f.nullable, f.metadata)
                         for f in kind.fields if f.name in below])


def narrow_schema(full: T.StructType, paths: Iterable[str]) -> T.StructType:
    """The part of ``full`` that ``paths`` (dotted, through arrays and maps too) use, in its order.

    A path that ends above the leaves keeps all of them.  A path that is not in
    ``full`` raises, as a pipeline that reads it would get nothing.
    """
    wanted = [split_path(p) for p in paths]
    return _narrow(full, wanted, "") if wanted else T.StructType([])
