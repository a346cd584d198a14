"""Closed sessions from a click stream: ``session_window`` per key with a watermark.

This is the streaming counterpart of ``operators.sessions.session_table``.
State is one open session per key (bounded), late clicks older than the
watermark are dropped, and a session is emitted once, to files, after the
watermark passes its end plus the gap. Sessions are merged inside each input
task before the shuffle, so a hot key sends its sessions, not its clicks.

Differences from the batch features (by design): the stream measures gaps
on the raw clock, not on whole seconds counted from the frame's first click,
and it cannot produce the look-ahead features (total sessions of a key,
full length of a still-open session) until the session closes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapwise.functions.scalars import epoch_micros
from gapwise.runtime import scratch_dir
from gapwise.sources.adapters import clicks_from_events


def stream_session_table(clicks: DataFrame, gap_seconds: int, watermark: str = "1 hour", key: str = "ip",
                         time_col: str = "click_time", label: str | None = "is_attributed") -> DataFrame:
    """Streaming (or batch) aggregate: one row per (key, session window)."""
    aggs = [F.count(F.lit(1)).alias("n_clicks"), F.min(time_col).alias("first_click"),
            F.max(time_col).alias("last_click")]
    if label:
        aggs.append(F.count_if(F.col(label)).alias("n_attributed"))
    # session_window needs an instant; the naive clock is UTC, converted exactly (no session-zone shift)
    ts = F.timestamp_micros(epoch_micros(time_col))
    return (clicks.withColumn("_event_time", ts)
                  .withWatermark("_event_time", watermark)
                  .groupBy(F.col(key), F.session_window("_event_time", f"{int(gap_seconds)} seconds").alias("session"))
                  .agg(*aggs)
                  .select(key, F.col("session.start").alias("session_start"), F.col("session.end").alias("session_end"),
                          *[a for a in ["n_clicks", "first_click", "last_click", "n_attributed"] if label or
                            a != "n_attributed"]))


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The driver's ``events`` table read as a file stream (schema declared, not inferred)."""
    schema = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").schema
    return (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
                 .option("maxFilesPerTrigger", 1).parquet(sf_dir))


MERGE_FIRST = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"


def run_to_files(sdf: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Drive an append-mode query over the input available now into Parquet files; return them as a batch DataFrame.

    Each session is written once, when the watermark has passed its end; open
    ones stay in the state for the next run on the same checkpoint.
    """
    spark = sdf.sparkSession
    before = spark.conf.get(MERGE_FIRST, "false")
    spark.conf.set(MERGE_FIRST, "true")
    try:
        q = (sdf.writeStream.format("parquet").outputMode("append").option("path", path)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        q.awaitTermination()
    finally:
        spark.conf.set(MERGE_FIRST, before)
    return spark.read.schema(sdf.schema).parquet(path)


GAP, WATERMARK = 21_600, "1 hour"


def q_stream_sessions(spark: SparkSession, sf: str) -> DataFrame:
    """6-hour sessions of ``events`` that the watermark has closed."""
    clicks = clicks_from_events(events_stream(spark, sf))
    out = run_to_files(stream_session_table(clicks, GAP, WATERMARK), scratch_dir(spark, "stream"), scratch_dir(spark, "stream-state"))
    return out.select("ip", "first_click", "last_click", "n_clicks", "n_attributed")


QUERIES = {"stream_sessions": q_stream_sessions}

ORACLE = {"stream_sessions": f"""
WITH c AS (SELECT user_id AS ip, ts, event_type = 'purchase' AS y FROM events),
g AS (SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER w) > {GAP * 10**6} THEN 1 ELSE 0 END AS brk
      FROM c WINDOW w AS (PARTITION BY ip ORDER BY ts)),
s AS (SELECT *, sum(brk) OVER (PARTITION BY ip ORDER BY ts ROWS UNBOUNDED PRECEDING) AS n FROM g)
SELECT ip, min(ts) AS first_click, max(ts) AS last_click, count(*) AS n_clicks, count_if(y) AS n_attributed
FROM s GROUP BY ip, n
HAVING epoch_us(max(ts)) + {GAP * 10**6} <= (SELECT max(epoch_us(ts)) FROM c) - 3600000000"""}
