"""Scans: NDJSON with quarantine, catalog/path tables, month-pruned fact, test feeds."""

from strata.sources.ndjson import corrupt_text, quarantined_rows, read_ndjson, valid_rows
from strata.sources.tables import read_month_slice, read_table, register_external

__all__ = [
    "corrupt_text",
    "quarantined_rows",
    "read_month_slice",
    "read_ndjson",
    "read_table",
    "register_external",
    "valid_rows",
]
