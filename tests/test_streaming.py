"""Structured Streaming sessions agree with the batch session table on whole-second-safe gaps."""

from pyspark.sql import functions as F

from gapwise.operators import sessions
from gapwise.plans.catalog import clicks
from gapwise.streaming.sessions import q_stream_sessions

SF = "/root/testdata/sf0.01"


def test_closed_sessions_match_batch(spark):
    streamed = q_stream_sessions(spark, SF)
    batch = sessions.session_table(clicks(spark, SF), gap=21_600, label="is_attributed")
    a = {tuple(r) for r in streamed.select("ip", "n_clicks", "n_attributed").collect()}
    assert a and a <= {tuple(r) for r in batch.select("ip", "n_clicks", "n_attributed").collect()}
    assert 0 < streamed.agg(F.sum("n_clicks")).first()[0] <= clicks(spark, SF).count()


def test_append_mode_emits_closed_sessions_and_drops_late_clicks(spark, tmp_path):
    from datetime import datetime, timedelta

    from pyspark.sql import types as T

    from gapwise.streaming.sessions import stream_session_table

    schema = T.StructType([T.StructField("ip", T.LongType()), T.StructField("click_time", T.TimestampNTZType()),
                           T.StructField("is_attributed", T.BooleanType())])
    src, ck = tmp_path / "in", tmp_path / "ck"
    t0 = datetime(2024, 1, 1)

    def put(name, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(src / name))

    put("b1", [(1, t0, False), (1, t0 + timedelta(seconds=60), True), (2, t0, False)])
    stream = spark.readStream.schema(schema).parquet(str(src / "*"))
    sessions_df = stream_session_table(stream, gap_seconds=900, watermark="10 minutes")
    q = (sessions_df.writeStream.format("memory").queryName("append_sessions").outputMode("append")
         .option("checkpointLocation", str(ck)).start())
    try:
        q.processAllAvailable()
        assert spark.table("append_sessions").count() == 0  # nothing closed yet
        put("b2", [(1, t0 + timedelta(hours=3), False)])  # advances the watermark past both sessions
        q.processAllAvailable()
        put("b3", [(2, t0 + timedelta(seconds=30), True),    # late: older than the watermark, dropped
                   (3, t0 + timedelta(hours=6), False)])
        q.processAllAvailable()
    finally:
        q.stop()
    out = {(r["ip"], r["n_clicks"], r["n_attributed"]) for r in spark.table("append_sessions").collect()}
    assert (1, 2, 1) in out and (2, 1, 0) in out
    assert all(not (ip == 2 and n_attr == 1) for ip, _, n_attr in out)
