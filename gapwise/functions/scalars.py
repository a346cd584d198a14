"""Scalar expressions used by the operators.

All of them are Catalyst expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_micros(ts: ColumnOrName) -> Column:
    """Microseconds since 1970-01-01 of a naive timestamp, independent of the session zone.

    Built from zone-free fields of the ``timestamp_ntz`` value (day number,
    hour, minute, seconds with fraction), so no daylight-saving offset can
    creep in whatever ``spark.sql.session.timeZone`` is.
    """
    v = _c(ts).cast("timestamp_ntz")
    day = F.unix_date(F.to_date(v)).cast("long")
    sec = (F.date_part(F.lit("SECOND"), v) * F.lit(1_000_000)).cast("long")
    return (day * F.lit(86_400_000_000) + F.hour(v).cast("long") * F.lit(3_600_000_000)
            + F.minute(v).cast("long") * F.lit(60_000_000) + sec)


def floor_div(x: ColumnOrName, n: int) -> Column:
    """Exact integer floor division (``x // n`` for either sign); bigint in, bigint out.

    SQL ``div`` truncates toward zero, so the non-negative remainder is removed first.
    """
    x = _c(x).cast("long")
    d = F.lit(int(n)).cast("long")
    return F.call_function("div", x - F.pmod(x, d), d)


def epoch_millis(ts: ColumnOrName) -> Column:
    """Epoch milliseconds, floored (a µs clock truncated to ms, read as an integer)."""
    return floor_div(epoch_micros(ts), 1000)


def truncate_millis(ts: ColumnOrName) -> Column:
    """Cast a µs timestamp to ms precision (floor), keeping ``timestamp_ntz``."""
    c = _c(ts).cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", -F.pmod(epoch_micros(c), F.lit(1000).cast("long")), c)


def safe_div(a: ColumnOrName, b: ColumnOrName) -> Column:
    """True division that yields null instead of raising on a zero divisor (ANSI mode)."""
    return F.try_divide(_c(a).cast("double"), _c(b).cast("double"))


def percent(part: ColumnOrName, whole: ColumnOrName) -> Column:
    return safe_div(part, whole) * F.lit(100.0)


def label_string(*cols: ColumnOrName) -> Column:
    """Chart label: values cast to string and joined by one space."""
    return F.concat_ws(" ", *[_c(c).cast("string") for c in cols])
