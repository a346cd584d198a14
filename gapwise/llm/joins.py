"""Broadcast joins for tables whose size has been counted, and a sieve of fixed size before joins that shuffle."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 500_000   # a side is broadcast up to so many rows of two or three longs


def sized(df: DataFrame) -> DataFrame:
    """A written table, marked for broadcast if its row count allows it; else Spark joins it by shuffle."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


SIEVE_BITS = 1 << 26       # 8 MB, whatever it holds; with more ids than about 30 million it lets more rows through
_PART = 1 << 15            # bits of a bitmap_construct_agg


def _places(column: str) -> list:
    return [F.pmod(F.xxhash64(F.lit(turn), column), F.lit(SIEVE_BITS)).cast("long") for turn in (1, 2)]


def sieved(rows: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """The rows whose ``column`` may be among that of ``ids``, and few others: all that a join would keep, before it shuffles."""
    place = ids.select(F.explode(F.array(*_places(column))).alias("p"))
    parts = (place.groupBy(F.floor(F.col("p") / _PART).cast("int").alias("part")).agg(F.bitmap_construct_agg(F.pmod("p", F.lit(_PART))).alias("bits"))
             .collect())
    bits = np.zeros(SIEVE_BITS // 8, np.uint8)
    for r in parts:
        bits[r["part"] * _PART // 8: (r["part"] + 1) * _PART // 8] = np.frombuffer(r["bits"], np.uint8)
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            for c in batch.columns[len(names):]:
                p = c.to_numpy()
                keep &= (bits[p >> 3] >> (p & 7).astype(np.uint8) & 1).astype(bool)
            yield batch.select(names).filter(pa.array(keep))
    one, two = _places(column)
    return rows.select("*", one.alias("sieve_1"), two.alias("sieve_2")).mapInArrow(run, rows.schema)
