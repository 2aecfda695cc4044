"""Scans (SRC1-10) and sinks (SNK1-5)."""

from riskloom.sources.tables import (  # noqa: F401
    catalog_table,
    drop_index_columns,
    file_inventory,
    jdbc_query,
    log_lines,
    read_csv_table,
    read_day_partition,
    read_table,
    require_columns,
    state_items_for_key,
    to_string_columns,
)
from riskloom.sources.sinks import (  # noqa: F401
    append_metrics,
    overwrite_partitions,
    save_marks,
    write_csv,
)
