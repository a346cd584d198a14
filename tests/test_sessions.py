"""Session features: hand fixture, order independence, metamorphic checks, brute-force equality."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from gapwise.operators import sessions

D = lambda s: datetime.fromisoformat("2020-01-01 " + s)

# (click_id, ip, time) -> expected (ts, prev, total, till_now, duration, avg_prev) with a 900 s gap
FIXTURE = [
    (1, 1, "00:00:00", (0, 0, 3, 0, 0, -1.0)),
    (2, 1, "00:15:00", (900, 1, 3, 0, 899, 0.0)),
    (3, 1, "00:29:59", (1799, 1, 3, 899, 899, 0.0)),
    (4, 1, "00:29:59", (1799, 1, 3, 899, 899, 0.0)),
    (5, 1, "01:00:00", (3600, 2, 3, 0, 0, 449.5)),
    (6, 2, "00:05:00", (300, 0, 1, 0, 0, -1.0)),
    (7, 3, "00:00:10.999", (10, 0, 2, 0, 0, -1.0)),
    (8, 3, "00:15:10.500", (910, 1, 2, 0, 0, 0.0)),
    (9, 4, "02:00:00", (7200, 0, 3, 0, 0, -1.0)),
    (10, 4, "02:20:00", (8400, 1, 3, 0, 0, 0.0)),
    (11, 4, "02:40:00", (9600, 2, 3, 0, 0, 0.0)),
]


def _fixture_df(spark, parts=1, seed=None):
    rows = [(i, ip, D(t)) for i, ip, t, _ in FIXTURE]
    if seed is not None:
        random.Random(seed).shuffle(rows)
    df = spark.createDataFrame(rows, "click_id long, ip long, click_time timestamp_ntz")
    return df.repartition(parts) if parts > 1 else df


def _collect(df):
    return {r["click_id"]: tuple(r[c] for c in sessions.FEATURES) for r in df.collect()}


@pytest.mark.parametrize("parts,seed", [(1, None), (3, 7), (5, 11)])
def test_hand_fixture(spark, parts, seed):
    got = _collect(sessions.session_features(_fixture_df(spark, parts, seed), gap=900))
    assert got == {i: exp for i, _, _, exp in FIXTURE}


def test_gap_must_be_positive(spark):
    with pytest.raises(ValueError):
        sessions.session_features(_fixture_df(spark), gap=0)


def _random_clicks(spark, n=400, keys=6, seed=1):
    r = random.Random(seed)
    t0 = datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        # heavy ties: few distinct seconds per key, plus sub-second noise
        sec = r.choice([0, 1, 2, 3, 5, 8, 13, 21, 34, 35, 36, 70, 71, 200, 201, 202, 500])
        rows.append((i, r.randrange(keys), t0 + timedelta(seconds=sec * r.choice([1, 3, 7]),
                                                           microseconds=r.randrange(1_000_000))))
    return spark.createDataFrame(rows, "click_id long, ip long, click_time timestamp_ntz").repartition(4)


def _brute_force(df, gap):
    """Direct per-key window transcription of the definitions (one window over raw clicks)."""
    rows = sessions.add_click_timestamp(df)
    w = Window.partitionBy("ip").orderBy("click_time", "click_id")
    brk = F.coalesce((F.col("click_timestamp") - F.lag("click_timestamp").over(w)) >= gap, F.lit(False))
    rows = rows.withColumn("previous_sessions",
                           F.sum(brk.cast("long")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    ws = Window.partitionBy("ip", "previous_sessions")
    rows = (rows.withColumn("_st", F.min("click_timestamp").over(ws))
                .withColumn("current_session_duration", F.max("click_timestamp").over(ws) - F.col("_st"))
                .withColumn("current_session_duration_till_now", F.col("click_timestamp") - F.col("_st"))
                .withColumn("total_sessions", F.max("previous_sessions").over(Window.partitionBy("ip")) + 1))
    st = rows.groupBy("ip", "previous_sessions").agg(F.max("current_session_duration").alias("d"))
    wc = Window.partitionBy("ip").orderBy("previous_sessions").rowsBetween(Window.unboundedPreceding, -1)
    st = st.withColumn("avg_previous_sessions_duration",
                       F.coalesce(F.try_divide(F.sum("d").over(wc).cast("double"),
                                               F.col("previous_sessions").cast("double")), F.lit(-1.0)))
    return rows.join(st.drop("d"), ["ip", "previous_sessions"])


@pytest.mark.parametrize("gap,seed", [(1, 1), (3, 2), (7, 3), (60, 4), (900, 5)])
def test_matches_brute_force(spark, gap, seed):
    df = _random_clicks(spark, seed=seed)
    assert _collect(sessions.session_features(df, gap=gap)) == _collect(_brute_force(df, gap))


def test_join_formulation_agrees(spark):
    df = _random_clicks(spark, seed=9)
    f = sessions.session_features(df, gap=7)
    j = sessions.join_session_means(f.drop("avg_previous_sessions_duration"), sessions.session_table(df, gap=7))
    a = {r["click_id"]: r["avg_previous_sessions_duration"] for r in f.collect()}
    b = {r["click_id"]: r["avg_previous_sessions_duration"] for r in j.collect()}
    assert a == b


def test_time_shift_invariance(spark):
    df = _random_clicks(spark, seed=4)
    shifted = df.withColumn("click_time", F.timestamp_add("HOUR", F.lit(5), "click_time"))
    a, b = _collect(sessions.session_features(df, gap=5)), _collect(sessions.session_features(shifted, gap=5))
    assert a == b


def test_infinite_gap_single_session(spark):
    df = _random_clicks(spark, seed=5)
    out = sessions.session_features(df, gap=10**9)
    assert {r[0] for r in out.select("total_sessions").distinct().collect()} == {1}
    assert out.filter("avg_previous_sessions_duration <> -1.0").count() == 0


def test_session_table_accounts_for_every_click(spark):
    df = _random_clicks(spark, seed=6)
    st = sessions.session_table(df, gap=3)
    assert st.agg(F.sum("n_clicks")).first()[0] == df.count()
    # sessions per key are numbered 0..total-1 without holes
    bad = st.groupBy("ip").agg((F.max("previous_sessions") + 1 - F.count("*")).alias("d"),
                               (F.max("total_sessions") - F.count("*")).alias("e")).filter("d <> 0 or e <> 0")
    assert bad.count() == 0


def test_gap_to_previous(spark):
    df = sessions.add_click_timestamp(_random_clicks(spark, seed=8))
    got = {r["click_id"]: r["gap_seconds"] for r in sessions.gap_to_previous(df).collect()}
    w = Window.partitionBy("ip").orderBy("click_time", "click_id")
    exp = df.withColumn("g", F.coalesce(F.col("click_timestamp") - F.lag("click_timestamp").over(w), F.lit(0)))
    assert got == {r["click_id"]: r["g"] for r in exp.collect()}


def test_no_window_over_raw_clicks(spark):
    """Every Window of the optimized plan has the chunk aggregate below it."""
    plan = sessions.session_features(_fixture_df(spark), gap=900)._jdf.queryExecution().optimizedPlan()

    def below(node):
        return [node, *[x for i in range(node.children().size()) for x in below(node.children().apply(i))]]

    windows = [n for n in below(plan) if n.nodeName() == "Window"]
    assert windows
    for w in windows:
        assert any(n.nodeName() == "Aggregate" and "_chunk" in n.toString() for n in below(w))


def test_one_of_equal_clicks_carries_the_gap(spark):
    rows = [(1, D("00:00:00")), (1, D("00:10:00")), (1, D("00:10:00")), (1, D("00:10:00")), (2, D("00:10:00")), (2, D("00:10:00"))]
    df = sessions.add_click_timestamp(spark.createDataFrame(rows, "ip long, click_time timestamp_ntz").repartition(4))
    got = sorted((r["ip"], r["click_timestamp"], r["gap_seconds"]) for r in sessions.gap_to_previous(df).collect())
    assert got == [(1, 0, 0), (1, 600, 0), (1, 600, 0), (1, 600, 600), (2, 600, 0), (2, 600, 0)]


def test_null_keys_and_times_are_kept(spark):
    rows = [(1, 1, D("00:00:00")), (2, None, D("00:01:00")), (3, None, D("00:30:00")), (4, 2, None)]
    df = spark.createDataFrame(rows, "click_id long, ip long, click_time timestamp_ntz")
    out = {r["click_id"]: r for r in sessions.session_features(df, gap=900).collect()}
    assert set(out) == {1, 2, 3, 4}
    assert out[3]["previous_sessions"] == 1 and out[2]["total_sessions"] == 2
    g = sessions.gap_to_previous(sessions.add_click_timestamp(df))
    assert g.count() == 4


def test_gap_to_previous_across_blocks(spark):
    r = random.Random(12)
    t0 = datetime(2024, 1, 1)
    rows = [(i, r.randrange(3), t0 + timedelta(seconds=r.choice([0, 5, 3599, 3600, 3601, 7300, 20000, 20001, 86399]),
                                                 microseconds=r.randrange(1_000_000))) for i in range(300)]
    df = sessions.add_click_timestamp(
        spark.createDataFrame(rows, "click_id long, ip long, click_time timestamp_ntz").repartition(3))
    got = {r["click_id"]: r["gap_seconds"] for r in sessions.gap_to_previous(df).collect()}
    w = Window.partitionBy("ip").orderBy("click_time", "click_id")
    exp = df.withColumn("g", F.coalesce(F.col("click_timestamp") - F.lag("click_timestamp").over(w), F.lit(0)))
    assert got == {r["click_id"]: r["g"] for r in exp.collect()}


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_click = st.tuples(st.integers(0, 3), st.integers(0, 4000), st.integers(0, 999_999))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(clicks=st.lists(_click, min_size=1, max_size=60), gap=st.integers(1, 1500), parts=st.integers(1, 4))
def test_property_matches_brute_force(spark, clicks, gap, parts):
    t0 = datetime(2024, 3, 1)
    rows = [(i, ip, t0 + timedelta(seconds=s, microseconds=us)) for i, (ip, s, us) in enumerate(clicks)]
    df = spark.createDataFrame(rows, "click_id long, ip long, click_time timestamp_ntz").repartition(parts)
    assert _collect(sessions.session_features(df, gap=gap)) == _collect(_brute_force(df, gap))


def test_new_key_does_not_change_other_keys(spark):
    df = _random_clicks(spark, seed=21)
    later = spark.createDataFrame([(10_000, 99, datetime(2024, 1, 1, 5))], "click_id long, ip long, click_time timestamp_ntz")
    a = _collect(sessions.session_features(df, gap=7))
    b = _collect(sessions.session_features(df.unionByName(later), gap=7))
    assert {k: v for k, v in b.items() if k != 10_000} == a


def test_raw_clicks_shuffle_on_key_and_chunk(spark):
    """Without a broadcast (large inputs), clicks are hash-partitioned on (key, chunk), never on the key alone."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        df = _random_clicks(spark, seed=3)
        out = sessions.session_features(df, gap=60)
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan
    import re
    parts = re.findall(r"hashpartitioning\(([^)]*?), \d+\)", plan)
    # the join inputs are partitioned on two expressions (key, chunk); the only single-key
    # exchange feeds the window over the (small) chunk table
    assert any(p.count(",") >= 1 for p in parts)


def test_hot_key_owning_over_a_third_of_clicks(spark):
    from gapwise.plans.catalog import clicks

    c = clicks(spark, "/root/testdata/sf0.01").select("click_id", "ip", "app", "click_time")
    # every 'view' and 'signup' click (about 40 % of all) moves to one hot key
    hot = c.withColumn("ip", F.when(F.col("app").isin("view", "signup"), F.lit(-1)).otherwise(F.col("ip"))).drop("app")
    gap = 900
    assert _collect(sessions.session_features(hot, gap=gap)) == _collect(_brute_force(hot, gap))
    rows = sessions.add_click_timestamp(hot)
    chunks = sessions.session_chunks(rows, gap).filter("ip = -1")
    span = rows.filter("ip = -1").agg(F.max("click_timestamp") - F.min("click_timestamp")).first()[0]
    n_hot = rows.filter("ip = -1").count()
    assert chunks.count() <= span // gap + 1 < n_hot  # the hot key's window input is bounded by span / gap
