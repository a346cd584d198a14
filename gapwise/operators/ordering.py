"""Ordering, exact ordered cuts (head-by-time, time-ordered hold-out), column order, unions.

The ordered cut never ranks the table. Time histograms (hour, second,
millisecond, microsecond) narrow the boundary; each is a small aggregate of at
most span / 3600, 3600, 1000 and 1000 rows, over a scan pruned to the bucket
above. Rows of the boundary microsecond, if several, are told apart by the
tie-break columns in turn (:func:`selection.kth_values`). Every row is then
labelled by comparing its key with the cut key: a projection, no join and no
window over rows.

Rows with a null time come first; null tie-break values come before others.
The full key (time and tie-break columns) must tell rows apart where the cut
falls; ValueError otherwise. Remove repeated rows first.
"""

from __future__ import annotations

import math
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapwise.functions.scalars import epoch_micros, floor_div
from gapwise.operators.selection import kth_values

_EPOCH = datetime(1970, 1, 1)
HOUR_US = 3_600_000_000
WIDTHS = (HOUR_US, 1_000_000, 1000, 1)
ALL = ("all",)


def sort_full_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Deterministic sort: Spark sorts are not stable, so the keys must be a full key."""
    return df.orderBy(*keys)


def _ntz(us: int) -> Column:
    return F.lit((_EPOCH + timedelta(microseconds=int(us))).isoformat(sep=" ")).cast("timestamp_ntz")


def _histogram(df: DataFrame, t: Column, width: int) -> list[tuple[int | None, int]]:
    """(bucket, rows) for ``width``-µs time buckets, ascending, a null time's bucket (None) first.

    A bounded summary: at most span / width rows of the frame given, never its rows.
    """
    hist = df.groupBy(floor_div(t, width).alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()
    return sorted(((r["b"], int(r["n"])) for r in hist), key=lambda x: (x[0] is not None, x[0] or 0))


def _locate(hist: list[tuple[int | None, int]], k: int, before: int) -> tuple[int | None, int, int] | None:
    """(bucket, rows before it, rows in it) of the k-th row; None if there are fewer than k rows."""
    for b, n in hist:
        if before + n >= k:
            return b, before, n
        before += n
    return None


def _tiebreak(df: DataFrame, time_col: str, tiebreak: str | list[str] | None) -> list[str]:
    """The tie-break columns: those given, else ``click_id`` if there is one, else all other columns."""
    if tiebreak is None:
        return ["click_id"] if "click_id" in df.columns else [c for c in df.columns if c != time_col]
    return [tiebreak] if isinstance(tiebreak, str) else list(tiebreak)


def cut_key(df: DataFrame, k: int, time_col: str = "click_time", tiebreak: str | list[str] | None = None,
            hour_hist: list[tuple[int | None, int]] | None = None):
    """Key of the k-th row (1-based): (epoch µs or None, [(column, value), ...]).

    Only the tie-break columns that were needed are listed. None if k <= 0 (no
    row is in the head); ``ALL`` if the table has at most k rows.
    """
    if k <= 0:
        return None
    t, col = epoch_micros(time_col), F.col(time_col)
    part, before, us = df, 0, None
    for width in WIDTHS:
        hist = hour_hist if width == HOUR_US and hour_hist is not None else _histogram(part, t, width)
        found = _locate(hist, k, before)
        if found is None:
            return ALL
        bucket, before, n = found
        if bucket is None:
            part, us = df.where(col.isNull()), None
            break
        us = bucket * width
        part = df.where((col >= _ntz(us)) & (col < _ntz(us + width)))
    ties = []
    for c in _tiebreak(df, time_col, tiebreak):
        if before + n == k:                 # all rows of this key belong to the head
            break
        value, less, n = kth_values(part, c, [k - before])[0]
        before += less
        part = part.where(F.col(c).eqNullSafe(F.lit(value)))
        ties.append((c, value))
    if before + n != k:
        raise ValueError(f"rows equal in {time_col} and {[c for c, _ in ties]} straddle the cut; give a key that tells them apart")
    return us, ties


def _head_flag(key, time_col: str) -> Column:
    """Whether a row's key is at or below the cut key."""
    us, ties = key
    flag = F.lit(True)
    for c, value in reversed(ties):
        col = F.col(c)
        less = F.lit(False) if value is None else col.isNull() | (col < F.lit(value))
        flag = less | (col.eqNullSafe(F.lit(value)) & flag)
    t = F.col(time_col)
    if us is None:
        return t.isNull() & flag
    return t.isNull() | (t < _ntz(us)) | ((t == _ntz(us)) & flag)


def in_first_k(df: DataFrame, k: int, time_col: str = "click_time", tiebreak: str | list[str] | None = None,
               out: str = "in_head", hour_hist: list[tuple[int | None, int]] | None = None) -> DataFrame:
    """Add a boolean column: is the row among the first ``k`` rows in (time, tie-break) order."""
    key = cut_key(df, k, time_col, tiebreak, hour_hist)
    if key is None:
        return df.withColumn(out, F.lit(False))
    if key is ALL:
        return df.withColumn(out, F.lit(True))
    return df.withColumn(out, F.coalesce(_head_flag(key, time_col), F.lit(False)))


def head_by_time(df: DataFrame, n: int, time_col: str = "click_time",
                 tiebreak: str | list[str] | None = None) -> DataFrame:
    """The earliest ``n`` rows by (time, tie-break) — a deterministic "first n rows"; the time bound reaches the scan."""
    key = cut_key(df, n, time_col, tiebreak)
    if key is None:
        return df.limit(0)
    if key is ALL:
        return df
    t = F.col(time_col)
    return df.where((t.isNull() | (t <= _ntz(key[0]))) if key[0] is not None else t.isNull()).where(_head_flag(key, time_col))


def holdout_size(n: int, test_size: float) -> int:
    """Hold-out size for a fraction: ceil(test_size · n)."""
    return int(math.ceil(test_size * n))


def _train_key(df: DataFrame, test_size: float, time_col: str, tiebreak: str | list[str] | None):
    hour_hist = _histogram(df, epoch_micros(time_col), HOUR_US)  # also gives the row count
    n = sum(c for _, c in hour_hist)
    return cut_key(df, n - holdout_size(n, test_size), time_col, tiebreak, hour_hist)


def temporal_split(df: DataFrame, test_size: float = 0.10, time_col: str = "click_time",
                   tiebreak: str | list[str] | None = None, out: str = "is_test") -> DataFrame:
    """Label the last ceil(test_size·n) rows by (time, tie-break) as test; no shuffling of rows."""
    key = _train_key(df, test_size, time_col, tiebreak)
    if key is None or key is ALL:
        return df.withColumn(out, F.lit(key is None))
    return df.withColumn(out, ~F.coalesce(_head_flag(key, time_col), F.lit(False)))


def train_test(df: DataFrame, test_size: float = 0.10, time_col: str = "click_time",
               tiebreak: str | list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """The two sides of :func:`temporal_split`; each side's time bound reaches its scan."""
    key = _train_key(df, test_size, time_col, tiebreak)
    if key is None or key is ALL:
        return (df.limit(0), df) if key is None else (df, df.limit(0))
    t, flag = F.col(time_col), F.coalesce(_head_flag(key, time_col), F.lit(False))
    if key[0] is None:
        return df.where(t.isNull() & flag), df.where(~flag)
    return df.where((t.isNull() | (t <= _ntz(key[0]))) & flag), df.where((t >= _ntz(key[0])) & ~flag)


def move_last(df: DataFrame, last: list[str]) -> DataFrame:
    """All columns except ``last``, then ``last`` in the given order."""
    return df.select(*[c for c in df.columns if c not in last], *last)


def union_tagged(frames: dict[str, DataFrame], tag: str = "tag") -> DataFrame:
    """Vertical concat by column name (duplicates kept), each part tagged with its name."""
    parts = [f.withColumn(tag, F.lit(name)) for name, f in frames.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)
