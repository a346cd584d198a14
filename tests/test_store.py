"""Checks on the way, rejected lines, saved stages, appended clicks."""

import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapwise.operators import encoders, sessions
from gapwise.plans import catalog
from gapwise.plans.adaboost import AdaBoostModel, Stump
from gapwise.plans.featurizer import SessionFeaturizer
from gapwise.runtime import scratch_dir
from gapwise.sources import contracts, io

SF = "/root/testdata/sf0.001"


def _log(spark, n=400, seed=2):
    r = random.Random(seed)
    start = datetime(2024, 3, 1)
    rows = [(i, r.choice([1, 1, 1, 2, 3, None, *range(4, 20)]), start + timedelta(seconds=r.randrange(6 * 86400)), r.random() < 0.3) for i in range(n)]
    return spark.createDataFrame(rows, "click_id long, ip long, click_time timestamp_ntz, is_attributed boolean")


def _scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet")


# --------------------------------------------------------------------------- contracts

def test_a_watch_adds_no_scan(spark):
    plain = catalog.clicks(spark, SF)
    watched = contracts.Watch(plain, contracts.CLICK_EVENTS).df
    assert _scans(sessions.session_features(watched)) == _scans(sessions.session_features(plain))


def test_checked_write_counts_and_deletes(spark):
    df = _log(spark).withColumn("attributed_time", F.col("click_time"))
    before = T.StructType([T.StructField("click_id", T.LongType(), False), T.StructField("ip", T.LongType(), False)])
    path = scratch_dir(spark, "checked")
    broken = df.where("ip is null").count()
    with pytest.raises(contracts.ContractError, match=f"'input', 'ip', 'not_null', {broken}"):
        contracts.checked_write(df, lambda d: d, before, before, path)
    assert not os.path.exists(path)
    whole = df.where("ip is not null")
    got = contracts.checked_write(whole, sessions.session_features, before, contracts.EXTENDED, path)
    assert got.count() == whole.count() and os.path.exists(path)
    with pytest.raises(contracts.ContractError, match="'output', '\\*', 'early'"):
        contracts.checked_write(whole, sessions.session_features, before, contracts.EXTENDED, scratch_dir(spark, "checked"),
                                after_rules={"early": F.col("previous_sessions") == 0})
    with pytest.raises(contracts.ContractError, match="missing"):
        contracts.checked_write(whole, lambda d: d, contracts.TRAIN, contracts.TRAIN, scratch_dir(spark, "checked"))


def test_checks_of_no_rows(spark):
    df = _log(spark).limit(0)
    watch = contracts.Watch(df, T.StructType([T.StructField("ip", T.LongType(), False)]))
    watch.df.write.format("noop").mode("overwrite").save()
    assert watch.counts() == [("ip", "not_null", 0, True)]


# --------------------------------------------------------------------------- rejected lines

def test_rejected_lines(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text(
        "a,t,b\n1,2024-01-01 00:00:00,x\n2,yesterday,x\n3,2024-01-01 00:00:00\n4,2024-01-01 00:00:00,x,y\nnine,2024-01-01 00:00:00,x\n"
        ',2024-01-01 00:00:00,x\n6,,x\n7,2024-01-01 00:00:00.25,"a,b"\n')
    contract = T.StructType([T.StructField("a", T.LongType(), False), T.StructField("t", T.TimestampNTZType(), True),
                             T.StructField("b", T.StringType(), True)])
    got = io.ingest_csv(spark, str(tmp_path / "in"), contract, str(tmp_path / "out"))
    assert sorted(map(tuple, got.good.collect())) == [(1, datetime(2024, 1, 1), "x"), (6, None, "x"), (7, datetime(2024, 1, 1, 0, 0, 0, 250000), "a,b")]
    assert got.good.schema.simpleString() == "struct<a:bigint,t:timestamp_ntz,b:string>"
    assert sorted((r["line"].split(",")[0], r["reason"]) for r in got.rejected.collect()) == [
        ('""', "null: a") if '""' in [r["line"].split(",")[0] for r in got.rejected.collect()] else ("", "null: a"),
        ("2", "time: t"), ("3", "malformed"), ("4", "malformed"), ("nine", "malformed")]
    assert (got.n_good, got.n_rejected) == (3, 5)


def test_no_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,t\n")
    contract = T.StructType([T.StructField("a", T.LongType(), False), T.StructField("t", T.TimestampNTZType(), True)])
    got = io.ingest_csv(spark, str(tmp_path / "a.csv"), contract, str(tmp_path / "out"))
    assert (got.good.count(), got.rejected.count(), got.n_good, got.n_rejected) == (0, 0, 0, 0)


# --------------------------------------------------------------------------- saved stages

def test_stages_come_back(spark, tmp_path):
    df = _log(spark).where("ip is not null").withColumn("c", F.col("ip") % 5)
    stages = [encoders.RareOrdinalEncoder(inputCols=["c"], outputCols=["code"], minFrequency=0.1),
              encoders.RareOneHotEncoder(inputCols=["c"], outputCols=["hot"], minFrequency=0.1), SessionFeaturizer(gap=1234),
              VectorAssembler(inputCols=["code", "previous_sessions"], outputCol="features")]
    Pipeline(stages=stages).save(str(tmp_path / "stages"))
    model = Pipeline.load(str(tmp_path / "stages")).fit(df)
    model.save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model"))
    assert [s.uid for s in again.stages] == [s.uid for s in model.stages] and again.stages[2].getOrDefault("gap") == 1234
    cols = ["click_id", "code", "hot", "features"]
    other = df.withColumn("c", F.col("ip") % 7)
    assert sorted(map(tuple, again.transform(other).select(cols).collect())) == sorted(map(tuple, model.transform(other).select(cols).collect()))


def test_stumps_come_back(spark, tmp_path):
    model = AdaBoostModel([Stump(0, 1.5, 1.0, 0.0, 0.25), Stump(None, None, 0.0, 0.0, 0.1)], ["x", "y"], "features")
    model.save(spark, str(tmp_path / "stumps"))
    again = AdaBoostModel.load(spark, str(tmp_path / "stumps"))
    assert (again.stumps, again.feature_names, again.features_col) == (model.stumps, model.feature_names, model.features_col)


# --------------------------------------------------------------------------- one chunk table, appended clicks

def test_all_from_one_chunk_table(spark):
    log = _log(spark)
    s = sessions.sessionize(log, gap=7200, label="is_attributed")
    assert sorted(map(str, s.features().collect())) == sorted(map(str, sessions.session_features(log, gap=7200).collect()))
    assert sorted(map(str, s.table().collect())) == sorted(map(str, sessions.session_table(log, gap=7200, label="is_attributed").collect()))
    assert sorted(map(str, s.with_means().collect())) == sorted(map(str, s.features().collect()))
    assert _scans(s.with_means()) <= 4      # clicks, their earliest time, and the chunk table twice


def test_clicks_have_one_shuffle_at_most(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = catalog.q_session_avg_join(spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum("Exchange hashpartitioning" in line and "click_id" in line for line in plan.splitlines()) <= 1


@pytest.mark.parametrize("cut", ["click_time < '2024-03-04'", "click_id % 3 > 0", "ip <> 1", "false", "true"])
def test_appended_clicks_equal_the_whole_log(spark, cut):
    log, epoch = _log(spark), datetime(2024, 3, 1)
    cut = F.coalesce(F.expr(cut), F.lit(False))
    store = sessions.sessionize(log.where(cut), gap=7200, label="is_attributed", epoch=epoch).chunks
    whole, new = sessions.append_clicks(store, log.where(~cut), epoch, gap=7200, label="is_attributed")
    want = sessions.session_features(log, gap=7200, epoch=epoch)
    assert sorted(map(str, new.collect())) == sorted(map(str, want.where(~cut).collect()))
    table = sessions.session_table(log, gap=7200, label="is_attributed", epoch=epoch)
    assert sorted(map(str, sessions.table_of_chunks(whole).select(table.columns).collect())) == sorted(map(str, table.collect()))


def test_columns_of_any_name(spark):
    log = _log(spark)
    odd = log.select("*", F.col("click_id").alias("_k"), F.lit(1).alias("_c"), F.lit(2).alias("_chunk"), F.lit(3).alias("_t"), F.lit(4).alias("_s"),
                     F.lit(5).alias("total_sessions"))
    got = sessions.session_features(odd)
    assert got.columns[:9] == ["click_id", "ip", "click_time", "is_attributed", "_k", "_c", "_chunk", "_t", "_s"]
    plain = sessions.session_features(log)
    assert sorted(map(str, got.select(plain.columns).collect())) == sorted(map(str, plain.collect()))
    timed = sessions.add_click_timestamp(odd)
    assert sessions.gap_to_previous(timed).agg(F.sum("gap_seconds")).first() == sessions.gap_to_previous(sessions.add_click_timestamp(log)).agg(F.sum("gap_seconds")).first()
    assert sessions.join_session_means(got, sessions.session_table(log)).count() == 400
