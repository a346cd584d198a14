"""Readers and writers. Reads declare their schema; writes go to the shared folder."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapwise.sources.contracts import conform

TS_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table, file schema (lazy; projection and filters reach the scan)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def typed_scan(spark: SparkSession, path: str, contract: T.StructType) -> DataFrame:
    """Parquet scan conformed to a contract: integers may widen, never narrow."""
    return conform(spark.read.parquet(path), contract)


def read_csv_contract(spark: SparkSession, path: str, contract: T.StructType,
                      timestamp_format: str = TS_FORMAT) -> DataFrame:
    """CSV with a header, read with the contract's types (no inference).

    Timestamp columns are read as text and parsed with ``timestamp_format`` so
    a malformed value fails loudly instead of silently turning into null.
    """
    text_schema = T.StructType([
        T.StructField(f.name, T.StringType() if isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType))
                      else f.dataType, True)
        for f in contract.fields])
    raw = spark.read.schema(text_schema).option("header", True).option("mode", "FAILFAST").csv(path)
    cols = []
    for f in contract.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)):
            c = F.to_timestamp_ntz(c, F.lit(timestamp_format))
        cols.append(c.cast(f.dataType).alias(f.name))
    return raw.select(cols)


@dataclass
class Ingested:
    """``good`` rows with the contract's types, ``rejected`` (line, reason), and how many of each; both lie in ``folder``."""

    good: DataFrame
    rejected: DataFrame
    n_good: int
    n_rejected: int
    folder: str


def ingest_csv(spark: SparkSession, path: str, contract: T.StructType, folder: str, timestamp_format: str = TS_FORMAT) -> Ingested:
    """CSV with a header into a table of good rows and one of rejected lines, read, told apart and counted in one pass.

    A line is rejected, with the first reason that holds: ``malformed`` (too few or
    many fields, or a value that is none of its type), ``time: c`` (no timestamp in
    ``timestamp_format``), ``null: c`` (nothing in a column that needs a value).
    """
    times = (T.TimestampNTZType, T.TimestampType)
    line = "_rejected_line"
    text_schema = T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, times) else f.dataType, True)
                                for f in contract.fields] + [T.StructField(line, T.StringType())])
    raw = (spark.read.schema(text_schema).option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", line).csv(path))
    reasons, cols = [F.when(F.col(line).isNotNull(), "malformed")], []
    for f in contract.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, times):
            legible = F.try_to_timestamp(c, F.lit(timestamp_format)).isNotNull()
            reasons.append(F.when(c.isNotNull() & ~legible, f"time: {f.name}"))
            c = F.when(legible, F.to_timestamp_ntz(c, F.lit(timestamp_format)))
        if not f.nullable:
            reasons.append(F.when(F.col(f.name).isNull(), f"null: {f.name}"))
        cols.append(c.cast(f.dataType).alias(f.name))
    whole = F.to_csv(F.struct(*[F.col(f.name) for f in contract.fields]))
    rows = raw.withColumn("_reason", F.coalesce(*reasons)).select(
        *cols, F.when(F.col("_reason").isNotNull(), F.coalesce(line, whole)).alias(line), "_reason", F.col("_reason").isNotNull().alias("_bad"))
    seen = Observation()
    rows.observe(seen, F.count_if("_bad").alias("bad"), F.count(F.lit(1)).alias("all")).write.partitionBy("_bad").parquet(folder)
    n, bad = int(seen.get.get("all") or 0), int(seen.get.get("bad") or 0)
    names = [f.name for f in contract.fields]
    back = spark.read.schema(rows.schema).parquet(folder)
    return Ingested(back.where("not _bad").select(*names), back.where("_bad").select(F.col(line).alias("line"), F.col("_reason").alias("reason")),
                    n - bad, bad, folder)


def write_parquet(df: DataFrame, path: str, compression: str = "uncompressed", mode: str = "overwrite") -> str:
    df.write.mode(mode).option("compression", compression).parquet(path)
    return path


def write_csv(df: DataFrame, path: str, single_file: bool = False, mode: str = "overwrite",
              timestamp_format: str = "yyyy-MM-dd HH:mm:ss.SSSSSS") -> str:
    """CSV with header. ``single_file`` is for result tables of a few rows only."""
    out = df.coalesce(1) if single_file else df
    (out.write.mode(mode).option("header", True)
        .option("timestampNTZFormat", timestamp_format)
        .option("timestampFormat", timestamp_format)
        .csv(path))
    return path
