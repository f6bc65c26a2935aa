"""Sources and sinks: collections, views, partitioned loads, refreshes."""

from nestflow.sources.collections import (
    infer_json_schema,
    parse_json_column,
    read_collection,
    with_views,
    write_by_day,
    write_collection,
)
from nestflow.sources.mutations import delete_touched, replace_touched, update_touched
from nestflow.sources.rescue import parse_json_rescued, split_rescued
from nestflow.sources.schemas import narrow_schema
from nestflow.sources.sinks import (
    in_database,
    load_partition,
    refresh_table,
    shared_dir,
    show_result,
    use_database,
)
from nestflow.sources.snapshots import Snapshot

__all__ = [
    "infer_json_schema", "parse_json_column", "read_collection", "with_views",
    "write_collection", "load_partition", "refresh_table", "shared_dir",
    "show_result", "use_database", "in_database", "write_by_day", "delete_touched", "replace_touched",
    "update_touched", "parse_json_rescued", "split_rescued", "narrow_schema", "Snapshot",
]
