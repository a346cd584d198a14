"""Registered queries: name -> (Spark callable, DuckDB oracle SQL or None).

Every query reads the driver tables (``events`` through the click adapter,
``lineitem``, ``labels`` …) in full. Thresholds are parameters chosen so that
every scale factor keeps some rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapwise.operators import encoders, metrics, ordering, profile, reports, sessions
from gapwise.runtime import scratch_dir
from gapwise.sources import adapters, contracts, io

# Fixed parameters of the registered queries.
GAP_15_MIN = 900
GAP_6_H = 21_600
REPORT_MIN_TOTAL = 70        # label report: keys with more clicks than this
HIGH_SESSIONS = 40           # heavy keys: at least this many 6-hour sessions
HEAD_ROWS = 5_000            # head_by_time sample size
TEST_SIZE = 0.10             # time-ordered hold-out fraction
ENCODER_MIN_FREQUENCY = 0.0105
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

EVENTS_CONTRACT = T.StructType([
    T.StructField("event_id", T.LongType(), False),
    T.StructField("ts", T.TimestampNTZType(), False),
    T.StructField("user_id", T.LongType(), False),
    T.StructField("event_type", T.StringType(), False),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("props", T.StringType(), True),
])
LINEITEM_CONTRACT = T.StructType([
    T.StructField("l_orderkey", T.LongType()), T.StructField("l_partkey", T.LongType()),
    T.StructField("l_suppkey", T.LongType()), T.StructField("l_linenumber", T.LongType()),  # int -> bigint widening
    T.StructField("l_quantity", T.DoubleType()), T.StructField("l_extendedprice", T.DoubleType()),
    T.StructField("l_discount", T.DoubleType()), T.StructField("l_tax", T.DoubleType()),
    T.StructField("l_returnflag", T.StringType()), T.StructField("l_linestatus", T.StringType()),
    T.StructField("l_shipdate", T.TimestampNTZType()),
])


# --------------------------------------------------------------------------- inputs

def clicks(spark: SparkSession, sf: str) -> DataFrame:
    return adapters.clicks_from_events(io.read_table(spark, sf, "events"))


def features(spark: SparkSession, sf: str, gap: int) -> DataFrame:
    return clicks(spark, sf).transform(lambda d: sessions.session_features(d, gap=gap))


def summary(spark: SparkSession, sf: str, gap: int) -> DataFrame:
    """Per-key session summary (from the chunk table; no per-click join)."""
    return sessions.key_summary(clicks(spark, sf), gap=gap)


def _dedup_cols(df: DataFrame) -> DataFrame:
    return df.select("ip", "app", F.to_date("click_time").alias("click_date"))


# --------------------------------------------------------------------------- SQL fragments

CLICKS_SQL = """SELECT event_id AS click_id, user_id AS ip, event_type AS app,
  CAST(json_extract_string(props, '$.k') AS INTEGER) AS channel, ts AS click_time,
  CASE WHEN event_type = 'purchase' THEN ts END AS attributed_time,
  event_type = 'purchase' AS is_attributed
FROM events"""


def _features_sql(gap: int) -> str:
    return f"""WITH c AS ({CLICKS_SQL}),
t AS (SELECT *, (epoch_us(click_time) // 1000 - (SELECT min(epoch_us(click_time) // 1000) FROM c)) // 1000
        AS click_timestamp FROM c),
g AS (SELECT *, CASE WHEN click_timestamp - lag(click_timestamp) OVER (PARTITION BY ip ORDER BY click_time, click_id)
        >= {gap} THEN 1 ELSE 0 END AS brk FROM t),
s AS (SELECT *, CAST(sum(brk) OVER (PARTITION BY ip ORDER BY click_time, click_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS previous_sessions FROM g),
ss AS (SELECT ip, previous_sessions, min(click_timestamp) AS st, max(click_timestamp) AS en,
        count(*) AS n_clicks, count_if(is_attributed) AS n_attributed FROM s GROUP BY ip, previous_sessions),
sc AS (SELECT *, sum(en - st) OVER (PARTITION BY ip ORDER BY previous_sessions
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS cum,
        count(*) OVER (PARTITION BY ip) AS total FROM ss),
f AS (SELECT s.click_id, s.ip, s.app, s.channel, s.click_time, s.attributed_time, s.is_attributed,
        CAST(s.click_timestamp AS BIGINT) AS click_timestamp, s.previous_sessions,
        CAST(sc.total AS BIGINT) AS total_sessions,
        CAST(s.click_timestamp - sc.st AS BIGINT) AS current_session_duration_till_now,
        CAST(sc.en - sc.st AS BIGINT) AS current_session_duration,
        CASE WHEN s.previous_sessions = 0 THEN CAST(-1 AS DOUBLE)
             ELSE CAST(sc.cum AS DOUBLE) / CAST(s.previous_sessions AS DOUBLE) END AS avg_previous_sessions_duration
      FROM s JOIN sc USING (ip, previous_sessions))"""


def _sessions_sql(gap: int) -> str:
    return _features_sql(gap) + """,
st AS (SELECT ip, previous_sessions, CAST(st AS BIGINT) AS session_start, CAST(en AS BIGINT) AS session_end,
        CAST(n_clicks AS BIGINT) AS n_clicks, CAST(en - st AS BIGINT) AS current_session_duration,
        CAST(total AS BIGINT) AS total_sessions,
        CASE WHEN previous_sessions = 0 THEN CAST(-1 AS DOUBLE)
             ELSE CAST(cum AS DOUBLE) / CAST(previous_sessions AS DOUBLE) END AS avg_previous_sessions_duration,
        CAST(n_attributed AS BIGINT) AS n_attributed FROM sc)"""


def _describe_sql(base: str, cols: list[str]) -> str:
    """DuckDB form of profile.describe over integer-valued columns (same arithmetic)."""
    def stat(name: str, c: str) -> str:
        x = f'CAST("{c}" AS BIGINT)'
        n = f"count({x})"
        if name == "count":
            return f"CAST({n} AS DOUBLE)"
        if name == "null_count":
            return f"CAST(count(*) - {n} AS DOUBLE)"
        if name == "mean":
            return f"CAST(sum(CAST({x} AS HUGEINT)) AS DOUBLE) / CAST({n} AS DOUBLE)"
        if name == "std":
            d = f"(CAST({x} AS HUGEINT) - (SELECT min({x}) FROM base))"
            return (f"sqrt(CAST(CAST({n} AS HUGEINT) * sum({d} * {d}) - sum({d}) * sum({d}) AS DOUBLE) / "
                    f"CAST({n} * ({n} - 1) AS DOUBLE))")
        if name in ("min", "max"):
            return f"CAST({name}({x}) AS DOUBLE)"
        q = profile.DESCRIBE_QUANTILES[name]
        return (f"CAST(list_sort(list({x}) FILTER (WHERE {x} IS NOT NULL))"
                f"[CAST(round(({n} - 1) * {q}) AS BIGINT) + 1] AS DOUBLE)")
    selects = []
    for s in profile.DESCRIBE_STATS:
        exprs = ", ".join(f'{stat(s, c)} AS "{c}"' for c in cols)
        selects.append(f"SELECT '{s}' AS statistic, {exprs} FROM base")
    return f"WITH base AS ({base})\n" + "\nUNION ALL\n".join(selects)


def _describe_all_sql() -> str:
    """describe over whole numbers (exact arithmetic), a text column and a double column."""
    whole = ["click_id", "ip", "channel", "click_time", "attributed_time", "is_attributed"]
    base = (f"SELECT click_id, ip, app, channel, epoch_us(click_time) AS click_time, epoch_us(attributed_time) AS attributed_time, "
            f"CAST(is_attributed AS BIGINT) AS is_attributed, e.value FROM ({CLICKS_SQL}) JOIN (SELECT event_id, value FROM events) e "
            f"ON e.event_id = click_id")
    numbers = _describe_sql(base, whole)
    text = {"count": "CAST(count(app) AS VARCHAR)", "null_count": "CAST(count(*) - count(app) AS VARCHAR)", "min": "min(app)",
            "max": "max(app)"}
    double = {"count": "CAST(count(value) AS DOUBLE)", "null_count": "CAST(count(*) - count(value) AS DOUBLE)", "mean": "avg(value)",
              "std": "stddev_samp(value)", "min": "min(value)", "max": "max(value)"}
    more = []
    for stat in profile.DESCRIBE_STATS:
        q = profile.DESCRIBE_QUANTILES.get(stat)
        x = double.get(stat) or ("list_sort(list(value) FILTER (WHERE value IS NOT NULL))"
                                 f"[CAST(round((count(value) - 1) * {q}) AS BIGINT) + 1]")
        more.append(f"SELECT '{stat}' AS statistic, {text.get(stat, 'CAST(NULL AS VARCHAR)')} AS app, round({x}, 6) AS value FROM base")
    return (f"WITH base AS ({base}), m AS ({' UNION ALL '.join(more)}), w AS (SELECT * FROM ({numbers})) "
            "SELECT w.*, m.app, m.value FROM w JOIN m USING (statistic)")


def _split_sql(test_size: float = TEST_SIZE) -> str:
    return f"""WITH c AS ({CLICKS_SQL}),
r AS (SELECT *, row_number() OVER (ORDER BY click_time, click_id) AS rn, count(*) OVER () AS n FROM c)
SELECT *, rn > n - CAST(ceil({test_size} * n) AS BIGINT) AS is_test FROM r"""


def _codes_sql(col: str, min_frequency: float) -> str:
    """Rare-aware ordinal codes fitted on the training part of the time split."""
    return f"""SELECT value, CASE WHEN rare THEN n_frequent ELSE rnk END AS code FROM (
  SELECT value, rare, CAST(row_number() OVER (ORDER BY rare, value) - 1 AS INTEGER) AS rnk,
         CAST(count_if(NOT rare) OVER () AS INTEGER) AS n_frequent
  FROM (SELECT {col} AS value, count(*) < {min_frequency} * (SELECT count(*) FROM train) AS rare
        FROM train GROUP BY {col}))"""


# --------------------------------------------------------------------------- queries

def q_csv_ingest(spark, sf):
    ev = io.read_table(spark, sf, "events")
    path = io.write_csv(ev, scratch_dir(spark, "csv"))
    return io.read_csv_contract(spark, path, EVENTS_CONTRACT)


def q_typed_scan(spark, sf):
    return io.typed_scan(spark, f"{sf.rstrip('/')}/lineitem.parquet", LINEITEM_CONTRACT)


def q_parquet_roundtrip(spark, sf):
    path = io.write_parquet(profile.dedup_rows(_dedup_cols(clicks(spark, sf))), scratch_dir(spark, "parquet"))
    return spark.read.parquet(path)


def q_contract_violations(spark, sf):
    rule = {"label_matches_attributed_time": F.col("is_attributed") == F.col("attributed_time").isNotNull()}
    return contracts.violations(clicks(spark, sf), contracts.TRAIN, rule)


def q_observed_violations(spark, sf):
    """The same checks, counted while the session features are written; nothing is read for them."""
    rule = {"label_matches_attributed_time": F.col("is_attributed") == F.col("attributed_time").isNotNull()}
    watch = contracts.Watch(clicks(spark, sf), contracts.TRAIN, rule)
    io.write_parquet(watch.df, scratch_dir(spark, "observed"))
    return spark.createDataFrame(watch.counts(), contracts.VIOLATIONS)


def q_checked_features(spark, sf):
    """Session features with a contract on the clicks and one on the features, both checked as the result is written."""
    return contracts.checked(clicks(spark, sf), lambda d: sessions.session_features(d, gap=GAP_15_MIN), contracts.CLICK_EVENTS,
                             contracts.merge(contracts.CLICK_EVENTS, contracts.EXTENDED))


def q_csv_rejects(spark, sf):
    """Events through CSV with spoilt values in every 40th line: good rows, and for rejected lines their event and the reason."""
    ev = io.read_table(spark, sf, "events")
    kind = F.col("event_id") % 160
    text = ev.select(
        F.when(kind == 0, F.concat(F.lit("no. "), F.col("event_id").cast("string"))).otherwise(F.col("event_id").cast("string")).alias("event_id"),
        F.when(kind == 40, "yesterday").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")).alias("ts"),
        F.when(kind != 80, F.col("user_id").cast("string")).alias("user_id"), "event_type",
        F.when(kind == 120, "much").otherwise(F.col("value").cast("string")).alias("value"), "props")
    path = io.write_csv(text, scratch_dir(spark, "csv"))
    found = io.ingest_csv(spark, path, EVENTS_CONTRACT, scratch_dir(spark, "ingested"))
    good = found.good.withColumn("reason", F.lit(None).cast("string"))
    bad = found.rejected.select(F.regexp_extract("line", "[0-9]+", 0).cast("long").alias("event_id"), "reason")
    return good.unionByName(bad, allowMissingColumns=True).withColumn("n_rejected", F.lit(found.n_rejected))


def q_reorder_columns(spark, sf):
    return ordering.move_last(clicks(spark, sf), ["attributed_time", "is_attributed"])


def q_click_timestamp(spark, sf):
    return sessions.add_click_timestamp(clicks(spark, sf)).select("click_id", "ip", "click_time", "click_timestamp")


def q_millis_clock(spark, sf):
    from gapwise.functions.scalars import epoch_millis, truncate_millis
    c = clicks(spark, sf)
    return c.select("click_id", truncate_millis("click_time").alias("click_time_ms"),
                    epoch_millis("click_time").alias("epoch_ms"))


def q_gap_seconds(spark, sf):
    c = sessions.add_click_timestamp(clicks(spark, sf)).select("click_id", "ip", "click_time", "click_timestamp")
    return sessions.gap_to_previous(c).select("click_id", "ip", "click_timestamp", "gap_seconds")


def q_gap_multiset(spark, sf):
    """Gaps on a clock of whole hours without click ids: many clicks of a key tie, many rows are equal."""
    c = clicks(spark, sf).select("ip", "app", F.date_trunc("HOUR", "click_time").cast("timestamp_ntz").alias("click_time"))
    return sessions.gap_to_previous(sessions.add_click_timestamp(c)).select("ip", "click_timestamp", "gap_seconds")


def q_previous_sessions(spark, sf):
    return features(spark, sf, GAP_15_MIN).select("click_id", "ip", "click_timestamp", "previous_sessions")


def q_total_sessions(spark, sf):
    return features(spark, sf, GAP_6_H).select("click_id", "ip", "total_sessions")


def q_session_elapsed(spark, sf):
    return features(spark, sf, GAP_6_H).select("click_id", "ip", "previous_sessions",
                                               "current_session_duration_till_now")


def q_session_duration(spark, sf):
    return features(spark, sf, GAP_6_H).select("click_id", "ip", "previous_sessions", "current_session_duration")


def q_avg_prev_session(spark, sf):
    return features(spark, sf, GAP_6_H).select("click_id", "ip", "previous_sessions",
                                               "avg_previous_sessions_duration")


def q_session_features(spark, sf):
    return features(spark, sf, GAP_15_MIN)


def q_session_features_6h(spark, sf):
    return features(spark, sf, GAP_6_H)


def q_session_table(spark, sf):
    return sessions.session_table(clicks(spark, sf), gap=GAP_6_H, label="is_attributed")


def q_session_cumulative(spark, sf):
    from pyspark.sql import Window
    st = sessions.session_table(clicks(spark, sf), gap=GAP_6_H)
    w = Window.partitionBy("ip").orderBy("previous_sessions").rowsBetween(Window.unboundedPreceding, -1)
    return st.select("ip", "previous_sessions",
                     F.coalesce(F.sum("current_session_duration").over(w), F.lit(0)).cast("long")
                     .alias("cum_prev_duration"))


def q_session_avg_join(spark, sf):
    """Features and session table from one chunk table; the table's means are looked up for every click."""
    return sessions.sessionize(clicks(spark, sf), gap=GAP_6_H).with_means().select(
        "click_id", "ip", "previous_sessions", "avg_previous_sessions_duration")


def _store(spark, sf, cut):
    """The log's earliest time, the chunk table of the clicks before ``cut`` (a share of the time span) and the clicks from there on."""
    c = clicks(spark, sf)
    lo, hi = c.agg(F.min("click_time"), F.max("click_time")).first()
    if lo is None:
        return None, sessions.sessionize(c, gap=GAP_6_H, label="is_attributed").chunks, c
    day = (lo + (hi - lo) * cut).replace(hour=0, minute=0, second=0, microsecond=0)
    before = c.where(F.col("click_time") < F.lit(day)) if day > lo else c.where(F.col("click_time") < F.lit(lo))
    store = sessions.sessionize(before, gap=GAP_6_H, label="is_attributed", epoch=lo).chunks
    return lo, store, c.where(F.col("click_time") >= F.lit(max(day, lo)))


def q_appended_sessions(spark, sf):
    """The session table of earlier days, to which the last days are appended: that of the whole log."""
    epoch, store, late = _store(spark, sf, 0.9)
    whole, _ = sessions.append_clicks(store, late, epoch, gap=GAP_6_H, label="is_attributed")
    return sessions.table_of_chunks(whole)


def q_appended_features(spark, sf):
    """Features of all clicks when the last two days come one after the other; each day's are taken as it is appended."""
    epoch, store, late = _store(spark, sf, 0.9)
    day = F.date_trunc("DAY", "click_time")
    first = late.agg(F.min(day)).scalar()
    one, two = late.where(day == first), late.where(day > first)
    store, _ = sessions.append_clicks(store, one, epoch, gap=GAP_6_H, label="is_attributed")
    _, features_two = sessions.append_clicks(store, two, epoch, gap=GAP_6_H, label="is_attributed")
    return features_two.select("click_id", "ip", "click_timestamp", "previous_sessions", "total_sessions", "current_session_duration_till_now",
                               "current_session_duration", "avg_previous_sessions_duration")


def q_split_is_future(spark, sf):
    train, test = ordering.train_test(clicks(spark, sf), TEST_SIZE)
    return reports.split_is_future(train, test)


def q_row_counts(spark, sf):
    return profile.row_count(clicks(spark, sf))


def q_null_counts(spark, sf):
    return profile.null_counts(clicks(spark, sf))


def q_nonnull_share(spark, sf):
    return profile.nonnull_share(clicks(spark, sf), "attributed_time")


def q_duplicate_count(spark, sf):
    return profile.duplicate_count(_dedup_cols(clicks(spark, sf)))


def q_dedup_rows(spark, sf):
    return profile.dedup_rows(_dedup_cols(clicks(spark, sf)))


def q_time_bounds(spark, sf):
    return profile.time_bounds(clicks(spark, sf), "click_time")


def q_describe_table(spark, sf):
    return profile.describe(clicks(spark, sf), DESCRIBE_COLS)


DESCRIBE_COLS = ["click_id", "ip", "channel", "click_time", "attributed_time", "is_attributed"]


def q_describe_all(spark, sf):
    """Every click column and the events' double ``value``; mean and deviation of ``value`` to six digits."""
    ev = io.read_table(spark, sf, "events")
    both = clicks(spark, sf).join(ev.select(F.col("event_id").alias("click_id"), "value"), "click_id")
    return profile.describe(both, ["click_id", "ip", "app", "channel", "click_time", "attributed_time", "is_attributed", "value"]) \
        .withColumn("value", F.round("value", 6))


def q_value_counts(spark, sf):
    return profile.value_counts(clicks(spark, sf), "channel")


def q_value_proportions(spark, sf):
    return profile.value_proportions(clicks(spark, sf), "app")


def q_clicks_per_second(spark, sf):
    return profile.value_counts(sessions.add_click_timestamp(clicks(spark, sf)), "click_timestamp", sort=False)


def q_profile_columns(spark, sf):
    return profile.profile_columns(clicks(spark, sf))


def q_label_counts_nested(spark, sf):
    return reports.explode_unnest(reports.label_counts_nested(clicks(spark, sf)), "is_attributed")


def q_label_pivot(spark, sf):
    return reports.label_pivot(clicks(spark, sf))


def q_label_report(spark, sf):
    return reports.label_report(clicks(spark, sf), REPORT_MIN_TOTAL)


def q_high_session_labels(spark, sf):
    return reports.high_session_labels(summary(spark, sf, GAP_6_H), HIGH_SESSIONS)


def q_high_session_labels_describe(spark, sf):
    return profile.describe(reports.high_session_labels(summary(spark, sf, GAP_6_H), HIGH_SESSIONS),
                            ["true", "false"])


def q_high_session_share(spark, sf):
    return reports.high_session_share(summary(spark, sf, GAP_6_H), HIGH_SESSIONS)


def q_first_session_share(spark, sf):
    return reports.first_session_share(sessions.session_table(clicks(spark, sf), gap=GAP_6_H))


def q_busiest_ip(spark, sf):
    return reports.busiest_key(summary(spark, sf, GAP_6_H))


def q_total_sessions_per_ip(spark, sf):
    return reports.total_sessions_per_key(summary(spark, sf, GAP_15_MIN))


def q_total_sessions_describe(spark, sf):
    return profile.describe(reports.total_sessions_per_key(summary(spark, sf, GAP_6_H)), ["total_sessions"])


def q_sorted_clicks(spark, sf):
    return ordering.sort_full_key(clicks(spark, sf), ["ip", "click_time", "click_id"])


def q_head_by_time(spark, sf):
    return ordering.head_by_time(clicks(spark, sf), HEAD_ROWS)


def q_temporal_split(spark, sf):
    return ordering.temporal_split(clicks(spark, sf), TEST_SIZE).select("click_id", "click_time", "is_test")


def q_temporal_split_train(spark, sf):
    """The hold-out cut on a frame without a click id: the other columns break ties."""
    return ordering.temporal_split(clicks(spark, sf).drop("click_id"), TEST_SIZE)


def q_merged_contract_scan(spark, sf):
    """A scan conformed to the union of two contracts, one of which widens a type of the other."""
    first = T.StructType([T.StructField("l_orderkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType())])
    second = T.StructType([T.StructField("l_linenumber", T.LongType()), T.StructField("l_shipdate", T.TimestampNTZType())])
    return io.typed_scan(spark, f"{sf.rstrip('/')}/lineitem.parquet", contracts.merge(first, second))


def q_csv_class_weights(spark, sf):
    """A small result table through the CSV sink and back."""
    path = io.write_csv(metrics.class_weights(io.read_table(spark, sf, "labels"), "quality"), scratch_dir(spark, "weights"),
                        single_file=True)
    return spark.read.schema("quality int, count long, weight double").option("header", True).csv(path)


def _fitted_pipeline(spark, sf):
    """Feature names, a pipeline with the encoder fitted on the train side, and the test side."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler

    from gapwise.plans.featurizer import SessionFeaturizer

    train, test = ordering.train_test(clicks(spark, sf), TEST_SIZE)
    names = ["ip", *sessions.FEATURES, "channel_code"]
    model = Pipeline(stages=[
        encoders.RareOrdinalEncoder(inputCols=["channel"], outputCols=["channel_code"], minFrequency=ENCODER_MIN_FREQUENCY),
        SessionFeaturizer(gap=GAP_6_H), VectorAssembler(inputCols=names, outputCol="features")]).fit(train)
    return names, model, test


def q_pipeline_features(spark, sf):
    """Encoder fitted on the train side, session features of the test side alone, assembled and taken apart again."""
    from pyspark.ml.functions import vector_to_array

    names, model, test = _fitted_pipeline(spark, sf)
    parts = vector_to_array("features")
    return model.transform(test).select("click_id", *[parts[i].alias(n) for i, n in enumerate(names)])


def q_pipeline_reloaded(spark, sf):
    """The fitted pipeline of ``pipeline_features``, saved and loaded again."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.functions import vector_to_array

    names, model, test = _fitted_pipeline(spark, sf)
    path = scratch_dir(spark, "pipeline")
    model.save(path)
    parts = vector_to_array("features")
    return PipelineModel.load(path).transform(test).select("click_id", *[parts[i].alias(n) for i, n in enumerate(names)])


def q_union_tagged(spark, sf):
    return ordering.union_tagged({t: profile.row_count(io.read_table(spark, sf, t)) for t in TABLES}, tag="table")


def q_table_overview(spark, sf):
    return reports.table_overview(clicks(spark, sf), dedup_cols=["ip", "app", "channel", "click_time",
                                                                  "attributed_time", "is_attributed"])


def q_auc_exact(spark, sf):
    ev = io.read_table(spark, sf, "events")
    return metrics.auc_exact(ev.select((F.col("event_type") == "purchase").alias("y"), "value"), "y", "value")


def q_auc_null_scores(spark, sf):
    """Scores of one event type are null: those rows count on neither side."""
    ev = io.read_table(spark, sf, "events")
    score = F.when(F.col("event_type") != "click", F.col("value"))
    return metrics.auc_exact(ev.select((F.col("event_type") == "purchase").alias("y"), score.alias("s")), "y", "s")


def q_auc_by_group(spark, sf):
    """The AUC of two scores, the value and its distance from 50, for purchases among each other kind of event."""
    ev = io.read_table(spark, sf, "events")
    kinds = [r["event_type"] for r in ev.select("event_type").distinct().collect()]      # a handful of event types
    against = F.explode(F.when(F.col("event_type") == "purchase", F.array(*[F.lit(k) for k in kinds if k != "purchase"]))
                        .otherwise(F.array("event_type")))
    scores = F.explode(F.array(*[F.struct(F.lit(n).alias("score"), x.alias("s")) for n, x in (
        ("value", F.col("value")), ("distance", F.abs(F.col("value") - 50)))]))
    rows = (ev.select((F.col("event_type") == "purchase").alias("y"), "value", "event_type").select("y", "value", against.alias("against"))
            .select("y", "against", scores.alias("of")).select("y", "against", "of.*"))
    return metrics.auc_by_group(rows, ["against", "score"], "y", "s")


def q_class_weights(spark, sf):
    return metrics.class_weights(io.read_table(spark, sf, "labels"), "quality")


def _fit_encoder(spark, sf, cls, outs):
    train, test = ordering.train_test(clicks(spark, sf), TEST_SIZE)
    enc = cls(inputCols=["app", "channel"], outputCols=outs, minFrequency=ENCODER_MIN_FREQUENCY)
    return enc.fit(train), test


def q_ordinal_encode(spark, sf):
    model, test = _fit_encoder(spark, sf, encoders.RareOrdinalEncoder, ["app_code", "channel_code"])
    return model.transform(test).select("click_id", "app_code", "channel_code")


def q_onehot_encode(spark, sf):
    model, test = _fit_encoder(spark, sf, encoders.RareOneHotEncoder, ["app_vec", "channel_vec"])
    return model.transform(test).select("click_id", encoders.hot_slot("app_vec").alias("app_slot"),
                                        encoders.hot_slot("channel_vec").alias("channel_slot"))


# --------------------------------------------------------------------------- oracle SQL

def _train_cte() -> str:
    return f"WITH sp AS ({_split_sql()}), train AS (SELECT * FROM sp WHERE NOT is_test), test AS (SELECT * FROM sp WHERE is_test)"


ORACLE: dict[str, str] = {
    "csv_ingest": "SELECT * FROM events",
    "typed_scan": """SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
        l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate FROM lineitem""",
    "parquet_roundtrip": f"SELECT DISTINCT ip, app, CAST(click_time AS DATE) AS click_date FROM ({CLICKS_SQL})",
    "contract_violations": f"""WITH c AS ({CLICKS_SQL}), n AS (SELECT count(*) AS n FROM c),
        v AS (SELECT 'ip' AS "column", 'not_null' AS rule, (SELECT count_if(ip IS NULL) FROM c) AS n_violations
        UNION ALL SELECT 'ip', 'bounds', (SELECT count_if(ip NOT BETWEEN 0 AND 4294967295) FROM c)
        UNION ALL SELECT 'app', 'narrowing_type', (SELECT n FROM n)
        UNION ALL SELECT 'device', 'missing', (SELECT n FROM n)
        UNION ALL SELECT 'os', 'missing', (SELECT n FROM n)
        UNION ALL SELECT 'channel', 'not_null', (SELECT count_if(channel IS NULL) FROM c)
        UNION ALL SELECT 'channel', 'bounds', (SELECT count_if(channel NOT BETWEEN 0 AND 65535) FROM c)
        UNION ALL SELECT 'click_time', 'not_null', (SELECT count_if(click_time IS NULL) FROM c)
        UNION ALL SELECT 'is_attributed', 'not_null', (SELECT count_if(is_attributed IS NULL) FROM c)
        UNION ALL SELECT '*', 'label_matches_attributed_time',
            (SELECT count_if(NOT coalesce(is_attributed = (attributed_time IS NOT NULL), false)) FROM c))
        SELECT *, n_violations = 0 AS ok FROM v""",
    "reorder_columns": f"SELECT click_id, ip, app, channel, click_time, attributed_time, is_attributed FROM ({CLICKS_SQL})",
    "click_timestamp": _features_sql(GAP_15_MIN) + " SELECT click_id, ip, click_time, click_timestamp FROM f",
    "gap_seconds": f"""WITH c AS ({CLICKS_SQL}),
        t AS (SELECT *, (epoch_us(click_time) // 1000 - (SELECT min(epoch_us(click_time) // 1000) FROM c)) // 1000
              AS click_timestamp FROM c)
        SELECT click_id, ip, CAST(click_timestamp AS BIGINT) AS click_timestamp,
          CAST(coalesce(click_timestamp - lag(click_timestamp) OVER (PARTITION BY ip ORDER BY click_time, click_id), 0)
               AS BIGINT) AS gap_seconds FROM t""",
    "millis_clock": """SELECT event_id AS click_id, date_trunc('millisecond', ts) AS click_time_ms,
        epoch_us(ts) // 1000 AS epoch_ms FROM events""",
    "previous_sessions": _features_sql(GAP_15_MIN) + " SELECT click_id, ip, click_timestamp, previous_sessions FROM f",
    "total_sessions": _features_sql(GAP_6_H) + " SELECT click_id, ip, total_sessions FROM f",
    "session_elapsed": _features_sql(GAP_6_H)
    + " SELECT click_id, ip, previous_sessions, current_session_duration_till_now FROM f",
    "session_duration": _features_sql(GAP_6_H)
    + " SELECT click_id, ip, previous_sessions, current_session_duration FROM f",
    "avg_prev_session": _features_sql(GAP_6_H)
    + " SELECT click_id, ip, previous_sessions, avg_previous_sessions_duration FROM f",
    "session_features": _features_sql(GAP_15_MIN) + " SELECT * FROM f",
    "session_features_6h": _features_sql(GAP_6_H) + " SELECT * FROM f",
    "session_table": _sessions_sql(GAP_6_H) + " SELECT * FROM st",
    "session_cumulative": _sessions_sql(GAP_6_H) + """ SELECT ip, previous_sessions,
        CAST(coalesce(sum(current_session_duration) OVER (PARTITION BY ip ORDER BY previous_sessions
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS cum_prev_duration FROM st""",
    "session_avg_join": _features_sql(GAP_6_H)
    + " SELECT click_id, ip, previous_sessions, avg_previous_sessions_duration FROM f",
    "split_is_future": f"""WITH sp AS ({_split_sql()})
        SELECT min(click_time) FILTER (WHERE is_test) AS min_test, max(click_time) FILTER (WHERE NOT is_test) AS max_train,
               min(click_time) FILTER (WHERE is_test) > max(click_time) FILTER (WHERE NOT is_test) AS is_test_in_future
        FROM sp""",
    "row_counts": "SELECT count(*) AS n_rows FROM events",
    "null_counts": f"""SELECT count_if(click_id IS NULL) AS click_id, count_if(ip IS NULL) AS ip,
        count_if(app IS NULL) AS app, count_if(channel IS NULL) AS channel,
        count_if(click_time IS NULL) AS click_time, count_if(attributed_time IS NULL) AS attributed_time,
        count_if(is_attributed IS NULL) AS is_attributed FROM ({CLICKS_SQL})""",
    "nonnull_share": f"""SELECT count(attributed_time) AS attributed_time,
        CAST(count(attributed_time) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS attributed_time_relative
        FROM ({CLICKS_SQL})""",
    "duplicate_count": f"""WITH g AS (SELECT ip, app, CAST(click_time AS DATE) AS d, count(*) AS c
        FROM ({CLICKS_SQL}) GROUP BY ALL)
        SELECT CAST(sum(c) AS BIGINT) AS n_rows, count(*) AS n_unique_rows,
               CAST(sum(c) AS BIGINT) - count(*) AS n_duplicates FROM g""",
    "dedup_rows": f"SELECT DISTINCT ip, app, CAST(click_time AS DATE) AS click_date FROM ({CLICKS_SQL})",
    "time_bounds": "SELECT min(ts) AS min_click_time, max(ts) AS max_click_time FROM events",
    "describe_table": _describe_sql(
        f"SELECT click_id, ip, channel, epoch_us(click_time) AS click_time, epoch_us(attributed_time) AS attributed_time, "
        f"CAST(is_attributed AS BIGINT) AS is_attributed FROM ({CLICKS_SQL})",
        ["click_id", "ip", "channel", "click_time", "attributed_time", "is_attributed"]),
    "value_counts": f"SELECT channel, count(*) AS count FROM ({CLICKS_SQL}) GROUP BY channel",
    "value_proportions": f"""SELECT app, CAST(count(*) AS DOUBLE) / CAST((SELECT count(*) FROM events) AS DOUBLE)
        AS proportion FROM ({CLICKS_SQL}) GROUP BY app""",
    "clicks_per_second": _features_sql(GAP_15_MIN)
    + " SELECT click_timestamp, count(*) AS count FROM f GROUP BY click_timestamp",
    "profile_columns": f"""WITH c AS ({CLICKS_SQL}), n AS (SELECT count(*) AS n FROM c),
        l AS (SELECT 'ip' AS "column", CAST(ip AS VARCHAR) AS value FROM c
              UNION ALL SELECT 'click_id', CAST(click_id AS VARCHAR) FROM c
              UNION ALL SELECT 'click_time', CAST(epoch_us(click_time) AS VARCHAR) FROM c
              UNION ALL SELECT 'attributed_time', CAST(epoch_us(attributed_time) AS VARCHAR) FROM c
              UNION ALL SELECT 'app', app FROM c
              UNION ALL SELECT 'channel', CAST(channel AS VARCHAR) FROM c
              UNION ALL SELECT 'is_attributed', CAST(is_attributed AS VARCHAR) FROM c)
        SELECT "column", value, count(*) AS count,
               CAST(count(*) AS DOUBLE) / CAST((SELECT n FROM n) AS DOUBLE) AS proportion FROM l GROUP BY ALL""",
    "label_counts_nested": f"SELECT ip, is_attributed, count(*) AS count FROM ({CLICKS_SQL}) GROUP BY ALL",
    "label_pivot": f"""SELECT ip, count_if(is_attributed) AS "true", count_if(NOT is_attributed) AS "false"
        FROM ({CLICKS_SQL}) GROUP BY ip""",
    "label_report": f"""WITH p AS (SELECT ip, count_if(is_attributed) AS t, count_if(NOT is_attributed) AS f
        FROM ({CLICKS_SQL}) GROUP BY ip)
        SELECT CAST(ip AS VARCHAR) || ' ' || CAST(t + f AS VARCHAR) AS ip, t AS "true", f AS "false",
               t + f AS total, CAST(t AS DOUBLE) / CAST(t + f AS DOUBLE) * 100.0 AS true_rel
        FROM p WHERE t + f > {REPORT_MIN_TOTAL}""",
    "high_session_labels": _features_sql(GAP_6_H) + f""" SELECT ip, count_if(is_attributed) AS "true",
        count_if(NOT is_attributed) AS "false" FROM f WHERE total_sessions >= {HIGH_SESSIONS} GROUP BY ip""",
    "high_session_share": _features_sql(GAP_6_H) + f""", k AS (SELECT ip, max(total_sessions) AS ts, count(*) AS n
        FROM f GROUP BY ip)
        SELECT count_if(ts >= {HIGH_SESSIONS}) AS n_high_session_ips,
          round(CAST(count_if(ts >= {HIGH_SESSIONS}) AS DOUBLE) / CAST(count(*) AS DOUBLE), 4) AS high_session_ips_rel,
          CAST(sum(CASE WHEN ts >= {HIGH_SESSIONS} THEN n ELSE 0 END) AS BIGINT) AS n_high_session_clicks,
          round(CAST(sum(CASE WHEN ts >= {HIGH_SESSIONS} THEN n ELSE 0 END) AS DOUBLE) / CAST(sum(n) AS DOUBLE), 4)
            AS high_session_clicks_rel FROM k""",
    "first_session_share": _sessions_sql(GAP_6_H) + """ SELECT count_if(previous_sessions = 0) AS n_first_sessions,
        count(*) AS n_sessions,
        CAST(count_if(previous_sessions = 0) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS first_sessions_rel FROM st""",
    "busiest_ip": _features_sql(GAP_6_H) + """ SELECT ip, max(total_sessions) AS total_sessions,
        min(click_time) AS min_date, max(click_time) AS max_date FROM f GROUP BY ip
        ORDER BY total_sessions DESC, ip LIMIT 1""",
    "total_sessions_per_ip": _features_sql(GAP_15_MIN) + " SELECT DISTINCT ip, total_sessions FROM f",
    "total_sessions_describe": _describe_sql(
        _features_sql(GAP_6_H) + " SELECT DISTINCT ip, total_sessions FROM f", ["total_sessions"]),
    "high_session_labels_describe": _describe_sql(
        _features_sql(GAP_6_H) + f""" SELECT ip, count_if(is_attributed) AS "true",
        count_if(NOT is_attributed) AS "false" FROM f WHERE total_sessions >= {HIGH_SESSIONS} GROUP BY ip""",
        ["true", "false"]),
    "sorted_clicks": f"SELECT * FROM ({CLICKS_SQL}) ORDER BY ip, click_time, click_id",
    "head_by_time": f"SELECT * FROM ({CLICKS_SQL}) ORDER BY click_time, click_id LIMIT {HEAD_ROWS}",
    "temporal_split": f"SELECT click_id, click_time, is_test FROM ({_split_sql()})",
    "union_tagged": "\nUNION ALL\n".join(f"SELECT count(*) AS n_rows, '{t}' AS \"table\" FROM {t}" for t in TABLES),
    "table_overview": f"""WITH c AS ({CLICKS_SQL}),
        u AS (SELECT count(*) AS n_unique_rows FROM (SELECT DISTINCT ip, app, channel, click_time, attributed_time,
              is_attributed FROM c))
        SELECT count(*) AS n_rows, count_if(click_id IS NULL) AS n_null_click_id, count_if(ip IS NULL) AS n_null_ip,
          count_if(app IS NULL) AS n_null_app, count_if(channel IS NULL) AS n_null_channel,
          count_if(click_time IS NULL) AS n_null_click_time, count_if(attributed_time IS NULL) AS n_null_attributed_time,
          count_if(is_attributed IS NULL) AS n_null_is_attributed,
          min(click_time) AS min_click_time, max(click_time) AS max_click_time,
          (SELECT n_unique_rows FROM u) AS n_unique_rows, count(*) - (SELECT n_unique_rows FROM u) AS n_duplicates
        FROM c""",
    "auc_exact": """WITH s AS (SELECT CAST(value AS DOUBLE) AS s, count_if(event_type = 'purchase') AS pos,
            count_if(event_type <> 'purchase') AS neg FROM events WHERE value IS NOT NULL GROUP BY 1),
        r AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb
              FROM s)
        SELECT CAST(sum(CAST(pos AS HUGEINT) * (2 * nb + neg)) AS DOUBLE)
                 / (2.0 * CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) AS auc,
               CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg FROM r""",
    "auc_null_scores": """WITH s AS (SELECT CAST(value AS DOUBLE) AS s, count_if(event_type = 'purchase') AS pos,
            count_if(event_type <> 'purchase') AS neg FROM events WHERE event_type <> 'click' AND value IS NOT NULL GROUP BY 1),
        r AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb
              FROM s)
        SELECT CAST(sum(CAST(pos AS HUGEINT) * (2 * nb + neg)) AS DOUBLE)
                 / (2.0 * CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) AS auc,
               CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg FROM r""",
    "class_weights": """WITH c AS (SELECT quality, count(*) AS count FROM labels GROUP BY quality)
        SELECT quality, count, CAST(sum(count) OVER () AS DOUBLE) / CAST(count(*) OVER () * count AS DOUBLE) AS weight
        FROM c""",
    "ordinal_encode": _train_cte() + f""", ca AS ({_codes_sql('app', ENCODER_MIN_FREQUENCY)}),
        cc AS ({_codes_sql('channel', ENCODER_MIN_FREQUENCY)})
        SELECT t.click_id, coalesce(ca.code, -1) AS app_code, coalesce(cc.code, -1) AS channel_code
        FROM test t LEFT JOIN ca ON t.app = ca.value LEFT JOIN cc ON t.channel = cc.value""",
    "onehot_encode": _train_cte() + f""", ca AS ({_codes_sql('app', ENCODER_MIN_FREQUENCY)}),
        cc AS ({_codes_sql('channel', ENCODER_MIN_FREQUENCY)})
        SELECT t.click_id, coalesce(ca.code, -1) AS app_slot, coalesce(cc.code, -1) AS channel_slot
        FROM test t LEFT JOIN ca ON t.app = ca.value LEFT JOIN cc ON t.channel = cc.value""",
}

ORACLE |= {
    "gap_multiset": f"""WITH c AS (SELECT ip, date_trunc('hour', click_time) AS click_time FROM ({CLICKS_SQL})),
        t AS (SELECT ip, (epoch_us(click_time) - (SELECT min(epoch_us(click_time)) FROM c)) // 1000000 AS click_timestamp FROM c)
        SELECT ip, CAST(click_timestamp AS BIGINT) AS click_timestamp,
          CAST(coalesce(click_timestamp - lag(click_timestamp) OVER (PARTITION BY ip ORDER BY click_timestamp), 0) AS BIGINT)
            AS gap_seconds FROM t""",
    "temporal_split_train": f"""WITH c AS ({CLICKS_SQL}),
        r AS (SELECT * EXCLUDE (click_id), row_number() OVER (ORDER BY click_time, ip, app, channel,
                attributed_time NULLS FIRST, is_attributed) AS rn, count(*) OVER () AS n FROM c)
        SELECT * EXCLUDE (rn, n), rn > n - CAST(ceil({TEST_SIZE} * n) AS BIGINT) AS is_test FROM r""",
    "merged_contract_scan": "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_shipdate FROM lineitem",
    "csv_class_weights": ORACLE["class_weights"],
    "pipeline_features": _train_cte() + f""", cc AS ({_codes_sql('channel', ENCODER_MIN_FREQUENCY)}),
        o AS (SELECT min(epoch_us(click_time) // 1000) AS ms FROM test),
        t AS (SELECT test.*, (epoch_us(click_time) // 1000 - o.ms) // 1000 AS ts FROM test, o),
        g AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY ip ORDER BY click_time, click_id) >= {GAP_6_H}
              THEN 1 ELSE 0 END AS brk FROM t),
        s AS (SELECT *, sum(brk) OVER (PARTITION BY ip ORDER BY click_time, click_id ROWS UNBOUNDED PRECEDING) AS ps FROM g),
        ss AS (SELECT ip, ps, min(ts) AS st, max(ts) AS en FROM s GROUP BY ip, ps),
        sc AS (SELECT *, sum(en - st) OVER (PARTITION BY ip ORDER BY ps ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS cum,
               count(*) OVER (PARTITION BY ip) AS total FROM ss)
        SELECT click_id, CAST(s.ip AS DOUBLE) AS ip, CAST(ts AS DOUBLE) AS click_timestamp, CAST(ps AS DOUBLE) AS previous_sessions,
          CAST(total AS DOUBLE) AS total_sessions, CAST(ts - st AS DOUBLE) AS current_session_duration_till_now,
          CAST(en - st AS DOUBLE) AS current_session_duration,
          CASE WHEN ps = 0 THEN CAST(-1 AS DOUBLE) ELSE CAST(cum AS DOUBLE) / CAST(ps AS DOUBLE) END
            AS avg_previous_sessions_duration, CAST(coalesce(cc.code, -1) AS DOUBLE) AS channel_code
        FROM s JOIN sc USING (ip, ps) LEFT JOIN cc ON s.channel = cc.value""",
    "describe_all": _describe_all_sql(),
    "auc_by_group": """WITH k AS (SELECT DISTINCT event_type AS against FROM events WHERE event_type <> 'purchase'),
        v AS (SELECT k.against, event_type = 'purchase' AS y, value FROM events JOIN k ON event_type = k.against OR event_type = 'purchase'),
        e AS (SELECT against, y, 'value' AS score, value AS s FROM v UNION ALL SELECT against, y, 'distance', abs(value - 50) FROM v),
        c AS (SELECT against, score, s, count_if(y) AS pos, count_if(NOT y) AS neg FROM e WHERE s IS NOT NULL GROUP BY ALL),
        r AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY against, score ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb
              FROM c)
        SELECT against, score, CAST(sum(CAST(pos AS HUGEINT) * (2 * nb + neg)) AS DOUBLE)
                 / (2.0 * CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) AS auc,
               CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg FROM r GROUP BY against, score""",
}

ORACLE |= {
    "observed_violations": ORACLE["contract_violations"],
    "checked_features": ORACLE["session_features"],
    "pipeline_reloaded": ORACLE["pipeline_features"],
    "appended_sessions": ORACLE["session_table"],
    "appended_features": _features_sql(GAP_6_H) + """,
        m AS (SELECT min(click_time) AS lo, max(click_time) AS hi FROM c),
        d AS (SELECT greatest(lo, date_trunc('day', lo + to_microseconds(CAST(round(epoch_us(hi) - epoch_us(lo)) * 0.9 AS BIGINT)))) AS cut FROM m),
        o AS (SELECT min(date_trunc('day', click_time)) AS first FROM c, d WHERE click_time >= cut)
        SELECT click_id, ip, click_timestamp, previous_sessions, total_sessions, current_session_duration_till_now, current_session_duration,
          avg_previous_sessions_duration FROM f, o WHERE date_trunc('day', click_time) > o.first""",
    "csv_rejects": """WITH r AS (SELECT *, CASE event_id % 160 WHEN 0 THEN 'malformed' WHEN 40 THEN 'time: ts' WHEN 80 THEN 'null: user_id'
            WHEN 120 THEN 'malformed' END AS reason FROM events)
        SELECT event_id, CASE WHEN reason IS NULL THEN ts END AS ts, CASE WHEN reason IS NULL THEN user_id END AS user_id,
          CASE WHEN reason IS NULL THEN event_type END AS event_type, CASE WHEN reason IS NULL THEN value END AS value,
          CASE WHEN reason IS NULL THEN props END AS props, reason, count(reason) OVER () AS n_rejected FROM r""",
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
