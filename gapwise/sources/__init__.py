"""Sources, sinks, schema contracts and table adapters."""

from gapwise.sources.adapters import clicks_from_events
from gapwise.sources.contracts import (
    BASE,
    CLICK_EVENTS,
    EXTENDED,
    TEST,
    TRAIN,
    ContractError,
    check_widening,
    conform,
    merge,
    violations,
)
from gapwise.sources.io import read_csv_contract, read_table, typed_scan, write_csv, write_parquet

__all__ = [
    "BASE", "CLICK_EVENTS", "EXTENDED", "TEST", "TRAIN", "ContractError", "check_widening", "conform", "merge",
    "violations", "clicks_from_events", "read_csv_contract", "read_table", "typed_scan", "write_csv",
    "write_parquet",
]
