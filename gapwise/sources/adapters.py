"""Adapters that present driver tables as the click log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def clicks_from_events(events: DataFrame) -> DataFrame:
    """``events`` as a click table.

    click_id <- event_id, ip <- user_id, app <- event_type, channel <- props.k,
    click_time <- ts, is_attributed <- (event_type = 'purchase'),
    attributed_time <- ts for purchases, else null.
    """
    purchase = F.col("event_type") == F.lit("purchase")
    return events.select(
        F.col("event_id").alias("click_id"),
        F.col("user_id").alias("ip"),
        F.col("event_type").alias("app"),
        F.get_json_object("props", "$.k").cast("int").alias("channel"),
        F.col("ts").alias("click_time"),
        F.when(purchase, F.col("ts")).alias("attributed_time"),
        purchase.alias("is_attributed"),
    )
