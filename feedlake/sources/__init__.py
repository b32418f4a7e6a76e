"""Readers of raw snapshots and written tables."""

from feedlake.sources.delimited import (
    detect_separator,
    read_daily_csv,
    read_detected_csv,
    read_text_csv,
)
from feedlake.sources.inference import infer_types, read_inferred_csv
from feedlake.sources.limits import capped
from feedlake.sources.quarantine import CheckedCsv, read_checked_csv
from feedlake.sources.snapshots import (
    inputs_present,
    latest_snapshot,
    read_checked_snapshot,
    read_snapshot,
    snapshot_day,
    snapshot_path,
)

__all__ = [
    "CheckedCsv",
    "capped",
    "detect_separator",
    "infer_types",
    "inputs_present",
    "latest_snapshot",
    "read_checked_csv",
    "read_checked_snapshot",
    "read_daily_csv",
    "read_detected_csv",
    "read_inferred_csv",
    "read_snapshot",
    "read_text_csv",
    "snapshot_day",
    "snapshot_path",
]
