"""Writers of raw, formatted and usage tables, index documents and metrics."""

from feedlake.sinks.batches import (
    append_batch,
    is_noted,
    ledger,
    move_batch,
    note_batch,
    stage_batch,
)
from feedlake.sinks.documents import (
    INDEX_FIELDS,
    ZERO_INDEX_FIELDS,
    bulk_lines,
    checked_documents,
    index_mapping,
    read_rejected,
    to_documents,
    write_bulk,
    write_checked_bulk,
)
from feedlake.sinks.tables import (
    land_snapshot,
    reconcile,
    write_csv,
    write_metrics,
    write_partitioned,
    write_sorted,
    write_table,
)

__all__ = [
    "INDEX_FIELDS",
    "ZERO_INDEX_FIELDS",
    "append_batch",
    "bulk_lines",
    "checked_documents",
    "index_mapping",
    "is_noted",
    "land_snapshot",
    "ledger",
    "move_batch",
    "note_batch",
    "read_rejected",
    "reconcile",
    "stage_batch",
    "to_documents",
    "write_bulk",
    "write_checked_bulk",
    "write_csv",
    "write_metrics",
    "write_partitioned",
    "write_sorted",
    "write_table",
]
