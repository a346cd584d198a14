"""User-level reports built from the click table and its session features.

Per-key reports work on one row per key: either a hash aggregate of clicks
(map-side combine) or the session key summary, which comes from the chunk
table without touching per-click rows. A key that owns a third of the clicks
never becomes a hot partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapwise.functions.scalars import label_string, percent, safe_div
from gapwise.operators.profile import duplicate_count


def label_counts_nested(df: DataFrame, key: str = "ip", label: str = "is_attributed") -> DataFrame:
    """Per key, a list of (label value, count) structs.

    The list length is bounded by the number of label values, so collecting it
    per key is safe.
    """
    per_value = df.groupBy(key, label).agg(F.count(F.lit(1)).alias("count"))
    return per_value.groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct(F.col(label), F.col("count")))).alias(label))


def explode_unnest(df: DataFrame, list_col: str, key: str = "ip") -> DataFrame:
    """Explode a list of structs and unnest the struct into columns."""
    return df.select(key, F.explode(list_col).alias("_s")).select(key, "_s.*")


def label_pivot(df: DataFrame, key: str = "ip", label: str = "is_attributed") -> DataFrame:
    """(key, true, false): clicks per label value; a missing value counts 0.

    Both output columns always exist. Written as a conditional aggregate (what
    ``pivot`` with the two fixed values plans to), in one hash aggregate.
    """
    return df.groupBy(key).agg(
        F.count_if(F.col(label)).alias("true"),
        F.count_if(~F.col(label)).alias("false"))


def label_report(df: DataFrame, min_total: int, key: str = "ip", label: str = "is_attributed") -> DataFrame:
    """Chart rows for heavy keys: true, false, total, true_rel (%) for keys with total > min_total.

    The key column is replaced by the chart label "<key> <total>"; rows are
    ordered by total, descending (key as tie-break).
    """
    p = label_pivot(df, key, label).withColumn("total", F.col("true") + F.col("false"))
    p = p.withColumn("true_rel", percent("true", "total")).filter(F.col("total") > F.lit(min_total))
    return (p.orderBy(F.desc("total"), F.asc(key))
             .select(label_string(key, "total").alias(key), "true", "false", "total", "true_rel"))


def total_sessions_per_key(summary: DataFrame, key: str = "ip") -> DataFrame:
    """(key, total_sessions) per key, ordered by key (one row per key in the summary)."""
    return summary.select(key, "total_sessions").orderBy(key)


def high_session_labels(summary: DataFrame, min_sessions: int, key: str = "ip") -> DataFrame:
    """(key, true, false) for keys with at least ``min_sessions`` sessions (from a key summary)."""
    return summary.filter(F.col("total_sessions") >= F.lit(min_sessions)).select(key, "true", "false")


def high_session_share(summary: DataFrame, min_sessions: int) -> DataFrame:
    """How many keys have >= min_sessions sessions, and how many clicks they own (counts and shares)."""
    heavy = F.col("total_sessions") >= F.lit(min_sessions)
    agg = summary.agg(
        F.count_if(heavy).alias("n_high_session_ips"),
        F.count(F.lit(1)).alias("n_ips"),
        F.sum(F.when(heavy, F.col("n_clicks")).otherwise(0)).cast("long").alias("n_high_session_clicks"),
        F.sum("n_clicks").cast("long").alias("n_clicks"))
    return agg.select(
        "n_high_session_ips",
        F.round(safe_div("n_high_session_ips", "n_ips"), 4).alias("high_session_ips_rel"),
        "n_high_session_clicks",
        F.round(safe_div("n_high_session_clicks", "n_clicks"), 4).alias("high_session_clicks_rel"))


def busiest_key(summary: DataFrame, key: str = "ip") -> DataFrame:
    """The key with the most sessions (smallest key on ties) and its first / last click.

    A top-1 report: the limit is the feature (a partial top-1 per task).
    """
    return (summary.orderBy(F.desc("total_sessions"), F.asc(key)).limit(1)
            .select(key, "total_sessions", "min_date", "max_date"))


def first_session_share(sessions: DataFrame) -> DataFrame:
    """Sessions without an earlier session (their mean-of-earlier is undefined) and their share."""
    first = F.col("previous_sessions") == 0
    return sessions.agg(F.count_if(first).alias("n_first_sessions"), F.count(F.lit(1)).alias("n_sessions")).withColumn(
        "first_sessions_rel", safe_div("n_first_sessions", "n_sessions"))


def table_overview(df: DataFrame, time_col: str = "click_time", dedup_cols: list[str] | None = None) -> DataFrame:
    """Row count, nulls per nullable column, duplicates and time bounds, as one row.

    The distinct-row count is its own grouping job, attached as a scalar
    subquery (no join between one-row tables).
    """
    dup = duplicate_count(df, dedup_cols)
    nullable = [f.name for f in df.schema.fields if f.nullable]
    base = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"n_null_{c}") for c in nullable],
        F.min(time_col).alias(f"min_{time_col}"),
        F.max(time_col).alias(f"max_{time_col}"))
    return base.withColumn("n_unique_rows", dup.select("n_unique_rows").scalar()).withColumn(
        "n_duplicates", F.col("n_rows") - F.col("n_unique_rows"))


def split_is_future(train: DataFrame, test: DataFrame, time_col: str = "click_time") -> DataFrame:
    """Is every test click strictly later than every training click?"""
    max_train = train.agg(F.max(time_col)).scalar()
    return test.agg(F.min(time_col).alias("min_test")).select(
        "min_test", max_train.alias("max_train"), (F.col("min_test") > max_train).alias("is_test_in_future"))
