"""Column-level helpers (pure ``pyspark.sql.functions`` compositions, no UDFs)."""

from gapwise.functions.scalars import (
    epoch_micros,
    epoch_millis,
    floor_div,
    label_string,
    percent,
    safe_div,
    truncate_millis,
)

__all__ = ["epoch_micros", "epoch_millis", "floor_div", "label_string", "percent", "safe_div", "truncate_millis"]
