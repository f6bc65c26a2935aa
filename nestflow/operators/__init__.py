"""DataFrame -> DataFrame operators: unnesting, filters, cleaning, mutations."""

from nestflow.operators.filters import before, drop_label, in_day, select_run, since, with_stored_time
from nestflow.operators.nested import (
    count_nested,
    field,
    flatten_struct,
    require_nonempty,
    split_explode,
    unnest,
    unnest_path,
)
from nestflow.operators.tables import (
    align,
    append_rows,
    canonical_calls,
    count_deleted,
    dedupe,
    delete_where,
    replace_by_key,
    update_by_key,
)

__all__ = [
    "before", "drop_label", "in_day", "select_run", "since", "with_stored_time", "count_nested", "field", "flatten_struct",
    "require_nonempty", "split_explode", "unnest", "unnest_path", "align",
    "append_rows", "canonical_calls", "count_deleted", "dedupe", "delete_where",
    "replace_by_key", "update_by_key",
]
