from trailmark.sources.ledger import current_files, publish_load, published_loads, replace_files, sweep
from trailmark.sources.readers import (
    SUFFIX,
    read_csv_positional,
    read_json_pages,
    read_shards,
    scan_shards,
    small_table,
)
from trailmark.sources.scratch import scratch_folder
from trailmark.sources.writers import (
    LOAD_KEYS,
    drop_table,
    load_run,
    publish_view,
    table_name,
    write_files,
    write_table,
)

__all__ = [
    "LOAD_KEYS",
    "SUFFIX",
    "current_files",
    "drop_table",
    "load_run",
    "publish_load",
    "publish_view",
    "published_loads",
    "read_csv_positional",
    "read_json_pages",
    "read_shards",
    "replace_files",
    "scan_shards",
    "scratch_folder",
    "small_table",
    "sweep",
    "table_name",
    "write_files",
    "write_table",
]
