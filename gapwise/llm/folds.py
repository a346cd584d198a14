"""Folds of documents by a checksum of their id."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def remainder(mod: int, id_col: str = "doc_id") -> Column:
    """crc32 of the id's text, modulo; null for a null id."""
    return F.crc32(F.col(id_col).cast("string")) % mod


def in_fold(mod: int, fold: int, id_col: str = "doc_id") -> Column:
    """Whether the remainder is ``fold``; false for a null id."""
    return F.coalesce(remainder(mod, id_col) == fold, F.lit(False))
