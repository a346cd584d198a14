"""Small hand-calculated fixtures for the non-session operators (FIXTURES.md §4)."""

from datetime import datetime

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapwise.operators import encoders, metrics, ordering, profile, reports
from gapwise.sources import contracts


def test_rare_ordinal_encoder(spark):
    train = spark.createDataFrame([(v,) for v in [2, 2, 2, 10, 10, 10, 1, 7]], "c long")
    model = encoders.RareOrdinalEncoder(inputCols=["c"], outputCols=["code"], minFrequency=0.25).fit(train)
    test = spark.createDataFrame([(v,) for v in [2, 10, 1, 7, 99]], "c long")
    got = {r["c"]: r["code"] for r in model.transform(test).collect()}
    assert got == {2: 0, 10: 1, 1: 2, 7: 2, 99: -1}


def test_numeric_order_not_string_order(spark):
    train = spark.createDataFrame([(v,) for v in [1, 2, 10, 10, 2, 1]], "c long")
    model = encoders.RareOrdinalEncoder(inputCols=["c"], outputCols=["code"]).fit(train)
    assert {r["c"]: r["code"] for r in model.transform(train).collect()} == {1: 0, 2: 1, 10: 2}


def test_rare_onehot_encoder(spark):
    train = spark.createDataFrame([(v,) for v in [2, 2, 2, 10, 10, 10, 1, 7]], "c long")
    model = encoders.RareOneHotEncoder(inputCols=["c"], outputCols=["vec"], minFrequency=0.25).fit(train)
    test = spark.createDataFrame([(2,), (10,), (7,), (99,)], "c long")
    out = model.transform(test).select("c", encoders.hot_slot("vec").alias("slot"), "vec")
    got = {r["c"]: (r["slot"], r["vec"].size) for r in out.collect()}
    assert got == {2: (0, 3), 10: (1, 3), 7: (2, 3), 99: (-1, 3)}


def test_auc_fixture(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.9), (1, 0.5), (0, 0.1)], "y int, s double")
    assert metrics.auc_value(df, "y", "s") == pytest.approx(0.625, abs=1e-15)


def test_auc_matches_evaluator_without_binning(spark):
    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    df = ev.select((F.col("event_type") == "purchase").cast("double").alias("label"),
                   F.col("value").alias("rawPrediction"))
    ours = metrics.auc_value(df, "label", "rawPrediction")
    theirs = BinaryClassificationEvaluator(numBins=0).evaluate(df)
    assert ours == pytest.approx(theirs, abs=1e-12)


def test_auc_does_not_depend_on_the_number_of_ranges(spark):
    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    df = ev.select((F.col("event_type") == "click").alias("y"), "value")
    odd = spark.createDataFrame([(y, s) for y in (True, False, None) for s in (None, float("nan"), float("inf"), float("-inf"), 0.0, -0.0, 1.5)],
                                "y boolean, value double")
    for frame in (df, odd, odd.where("value is null"), odd.where("y")):
        rows = {tuple(metrics.auc_exact(frame, "y", "value", ranges=n).first()) for n in (1, 3, 500)}
        assert len(rows) == 1
    auc, n_pos, n_neg = metrics.auc_exact(odd, "y", "value").first()
    assert (n_pos, n_neg, auc) == (6, 6, 0.5)      # null scores and labels count on neither side


def test_ordered_split(spark):
    rows = [(i, datetime(2024, 1, 1, 0, 0, i % 7)) for i in range(11)]
    df = spark.createDataFrame(rows, "click_id long, click_time timestamp_ntz")
    out = ordering.temporal_split(df, 0.1)
    test_ids = sorted(r["click_id"] for r in out.filter("is_test").collect())
    ranked = sorted(rows, key=lambda r: (r[1], r[0]))
    assert test_ids == sorted(r[0] for r in ranked[-2:])
    assert out.filter("not is_test").count() == 9


def _clicks_of_one_second(spark, n=3000):
    import random

    r = random.Random(5)
    rows = [(r.randrange(40), datetime(2024, 1, 1, 0, 0, 3, r.choice([0, 7, 7, 7, 999_999])), r.choice(["a", "b", None]), i) for i in range(n)]
    rows += [(1, None, "x", -1), (2, None, None, -2)]
    return rows, spark.createDataFrame(rows, "ip int, click_time timestamp_ntz, app string, channel long").repartition(5)


def _first(rows, k):
    key = lambda r: tuple((v is not None, v if v is not None else 0) for v in (r[1], r[0], r[2], r[3]))
    return sorted(map(repr, sorted(rows, key=key)[:k]))


def test_cut_inside_one_second_without_an_id(spark):
    rows, df = _clicks_of_one_second(spark)
    for k in (1, 2, 3, 700, 1501, 2999, 3002):
        assert sorted(repr(tuple(r)) for r in ordering.head_by_time(df, k).collect()) == _first(rows, k)
    out = ordering.temporal_split(df, 0.25)
    assert sorted(repr(tuple(r)[:4]) for r in out.where("not is_test").collect()) == _first(rows, 3002 - 751)
    train, test = ordering.train_test(df, 0.25)
    assert train.count() == 3002 - 751 and test.count() == 751
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" not in plan and "Window" not in plan and "Sort" not in plan


def test_equal_rows_at_the_cut_are_refused(spark):
    df = spark.createDataFrame([(1, datetime(2024, 1, 1))] * 4, "ip long, click_time timestamp_ntz")
    with pytest.raises(ValueError, match="straddle"):
        ordering.head_by_time(df, 2)
    assert ordering.head_by_time(df, 4).count() == 4


def test_train_contract_frame_splits_and_has_gaps(spark):
    from gapwise.operators import sessions

    rows = [(i % 3, 1, 2, 3, 4, datetime(2024, 1, 1, 0, i), None, i % 5 == 0) for i in range(20)]
    df = contracts.conform(spark.createDataFrame(rows, contracts.TRAIN), contracts.TRAIN)
    assert ordering.temporal_split(df).where("is_test").count() == 2
    gaps = sessions.gap_to_previous(sessions.add_click_timestamp(df))
    assert sorted(r["gap_seconds"] for r in gaps.collect()) == [0] * 3 + [180] * 17


def test_time_bound_of_a_cut_reaches_the_scan(spark):
    from gapwise.plans.catalog import clicks

    plan = ordering.head_by_time(clicks(spark, "/root/testdata/sf0.01"), 50)._jdf.queryExecution().executedPlan().toString()
    assert "LessThan" in plan.split("PushedFilters")[1].split("ReadSchema")[0]


def test_head_by_time_bounds(spark):
    df = spark.createDataFrame([(i, datetime(2024, 1, 1, i % 3)) for i in range(10)], "click_id long, click_time timestamp_ntz")
    assert ordering.head_by_time(df, 0).count() == 0
    assert ordering.head_by_time(df, 10).count() == 10
    assert sorted(r[0] for r in ordering.head_by_time(df, 4).collect()) == [0, 3, 6, 9]


def test_label_pivot_and_report(spark):
    df = spark.createDataFrame([(1, True), (1, False), (1, False), (2, False)], "ip long, is_attributed boolean")
    assert sorted(tuple(r) for r in reports.label_pivot(df).collect()) == [(1, 1, 2), (2, 0, 1)]
    rep = reports.label_report(df, 2).collect()
    assert len(rep) == 1 and rep[0]["ip"] == "1 3" and rep[0]["true_rel"] == pytest.approx(100 / 3)


def test_duplicates_and_nulls(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "v string")
    r = profile.duplicate_count(df).first()
    assert (r["n_rows"], r["n_unique_rows"], r["n_duplicates"]) == (5, 3, 2)
    t = spark.createDataFrame([(None,), (None,), (datetime(2024, 1, 1),)], "attributed_time timestamp_ntz")
    assert profile.null_counts(t).first()["attributed_time"] == 2
    s = profile.nonnull_share(t, "attributed_time").first()
    assert s["attributed_time"] == 1 and s["attributed_time_relative"] == pytest.approx(1 / 3)


def test_future_check(spark):
    tr = spark.createDataFrame([(datetime(2024, 1, 1, 10),)], "click_time timestamp_ntz")
    same = spark.createDataFrame([(datetime(2024, 1, 1, 10),)], "click_time timestamp_ntz")
    later = spark.createDataFrame([(datetime(2024, 1, 1, 10, 1),)], "click_time timestamp_ntz")
    assert reports.split_is_future(tr, same).first()["is_test_in_future"] is False
    assert reports.split_is_future(tr, later).first()["is_test_in_future"] is True


def test_contract(spark):
    contract = T.StructType([T.StructField("a", T.IntegerType(), False), T.StructField("b", T.LongType(), True)])
    df = spark.createDataFrame([(1, 2), (None, 3)], "a int, b int")
    v = {(r["column"], r["rule"]): r["n_violations"] for r in contracts.violations(df, contract).collect()}
    assert v == {("a", "not_null"): 1}
    assert contracts.conform(df, contract).schema["b"].dataType == T.LongType()  # widening allowed
    narrow = spark.createDataFrame([(1, 2)], "a long, b long")
    with pytest.raises(contracts.ContractError):
        contracts.conform(narrow, contract)
    assert [f.name for f in contracts.merge(contracts.BASE, contracts.TEST_EXTRA).fields][-1] == "click_id"


def test_contract_bounds_and_fail_fast(spark):
    good = spark.createDataFrame([(1, 2, 3, 4, 5, datetime(2024, 1, 1))], contracts.BASE)
    assert contracts.validate(good, contracts.BASE) is good
    bad = spark.createDataFrame([(-1, 2, 70_000, 4, None, datetime(2024, 1, 1))],
                                "ip long, app long, device int, os int, channel int, click_time timestamp_ntz")
    with pytest.raises(contracts.ContractError) as e:
        contracts.validate(bad, contracts.BASE)
    assert all(x in str(e.value) for x in ("('ip', 'bounds', 1)", "('device', 'bounds', 1)", "('channel', 'not_null', 1)"))
    from gapwise.operators.sessions import session_features

    out = contracts.checked(good, session_features, contracts.BASE, contracts.EXTENDED)
    assert out.count() == 1
    with pytest.raises(contracts.ContractError):
        contracts.checked(bad, session_features, contracts.BASE, contracts.EXTENDED)


def test_null_category_is_unknown_and_moves_no_code(spark):
    train = spark.createDataFrame([(v,) for v in [None, None, 2, 2, 10, 10]], "c long")
    model = encoders.RareOrdinalEncoder(inputCols=["c"], outputCols=["code"]).fit(train)
    assert {r["c"]: r["code"] for r in model.transform(train).collect()} == {None: -1, 2: 0, 10: 1}


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 8 + [(1,)] * 2, "y int")
    got = {r["y"]: r["weight"] for r in metrics.class_weights(df, "y").collect()}
    assert got == {0: pytest.approx(0.625), 1: pytest.approx(2.5)}


def test_describe_nearest_rank(spark):
    df = spark.createDataFrame([(v,) for v in [1, 2, 3, 4]], "x long")
    stats = {r["statistic"]: r["x"] for r in profile.describe(df).collect()}
    assert stats["count"] == 4 and stats["null_count"] == 0 and stats["mean"] == 2.5
    assert stats["25%"] == 2 and stats["50%"] == 3 and stats["75%"] == 3  # round((n-1)q) indices 1, 2, 2
    assert stats["std"] == pytest.approx(1.2909944487358056)


def test_describe_deviation_is_stable(spark):
    df = spark.createDataFrame([(1e9 + 1, -2 ** 63), (1e9 + 2, 2 ** 63 - 1), (1e9 + 3, 0)], "x double, y long")
    stats = {r["statistic"]: r for r in profile.describe(df).collect()}
    assert stats["std"]["x"] == pytest.approx(1.0) and stats["std"]["y"] == pytest.approx(9.223372036854775e18, rel=1e-9)
    assert stats["50%"]["y"] == 0 and stats["50%"]["x"] == 1e9 + 2


def test_describe_of_a_month_of_microseconds(spark):
    df = spark.range(10_000_000).select(F.timestamp_micros(F.pmod(F.xxhash64("id"), F.lit(30 * 86_400_000_000)) + 1_700_000_000_000_000)
                                        .cast("timestamp_ntz").alias("t"))
    std = {r["statistic"]: r["t"] for r in profile.describe(df).collect()}["std"]
    assert std == pytest.approx(30 * 86_400e6 / 12 ** 0.5, rel=1e-2)


def test_describe_of_text_and_dates(spark):
    from datetime import date

    df = spark.createDataFrame([("b", date(2024, 1, 2), None), ("a", None, None)], "s string, d date, n long")
    stats = {r["statistic"]: r for r in profile.describe(df).collect()}
    assert (stats["min"]["s"], stats["max"]["s"], stats["count"]["s"], stats["mean"]["s"]) == ("a", "b", "2", None)
    assert (stats["null_count"]["d"], stats["max"]["d"]) == ("1", "2024-01-02") and stats["count"]["n"] == 0 and stats["50%"]["n"] is None
    assert profile.describe(df.limit(0)).count() == 9


def test_exact_quantiles_high_cardinality(spark):
    """Radix select on wide-range ints, negative values, doubles and timestamps vs sorted truth."""
    import random

    r = random.Random(3)
    rows = [(r.randrange(-2**61, 2**61), r.uniform(-1e6, 1e6), datetime(2024, 1, 1) + __import__("datetime").timedelta(
        microseconds=r.randrange(10**12))) for _ in range(3000)]
    df = spark.createDataFrame(rows, "a long, b double, c timestamp_ntz")
    got = profile.exact_quantiles(df, ["a", "b", "c"], [0.0, 0.25, 0.5, 0.999, 1.0])
    epoch = datetime(1970, 1, 1)
    truth = {"a": sorted(x[0] for x in rows), "b": sorted(x[1] for x in rows),
             "c": sorted((x[2] - epoch) // __import__("datetime").timedelta(microseconds=1) for x in rows)}
    for c, vals in truth.items():
        for q in [0.0, 0.25, 0.5, 0.999, 1.0]:
            assert got[(c, q)] == float(vals[profile.nearest_rank(len(vals), q)]), (c, q)


def test_exact_quantiles_of_many_rows_and_hot_values(spark):
    """Brackets that hold more values than a sketch gives back, one value with a third of the rows, NaN and infinities."""
    import random

    r = random.Random(6)
    wide = [r.gauss(0, 1) for _ in range(40_000)]
    rows = [(7 if i % 3 == 0 else r.randrange(50), float("nan") if i % 50 == 1 else float("-inf") if i % 50 == 2 else round(x, 2), x, None if i % 4 else x)
            for i, x in enumerate(wide)]
    df = spark.createDataFrame(rows, "a int, b double, c double, d double").repartition(8)
    qs = [0.0, 0.001, 0.25, 0.5, 0.75, 0.999, 1.0]
    old, profile._GRID = profile._GRID, 20
    try:
        got = profile.exact_quantiles(df, ["a", "b", "c", "d"], qs)
    finally:
        profile._GRID = old
    for k, c in enumerate("abcd"):
        vals = sorted((x[k] for x in rows if x[k] is not None), key=lambda v: (v != v, v))
        for q in qs:
            want = float(vals[profile.nearest_rank(len(vals), q)])
            assert got[c, q] == want or got[c, q] != got[c, q] and want != want, (c, q)
    assert set(profile.exact_quantiles(df.limit(0), ["a"], [0.5]).values()) == {None}


def test_describe_is_three_jobs(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    seen = []
    first = DataFrame.first
    monkeypatch.setattr(DataFrame, "first", lambda self: seen.append(1) or first(self))
    profile.describe(spark.range(30_000).selectExpr("id % 977 AS a", "rand(3) AS b", "id * id AS c"))
    assert len(seen) <= 3


def test_epoch_micros_ignores_session_zone(spark):
    from gapwise.functions.scalars import epoch_micros

    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("2024-07-01 12:34:56.123456",), ("1969-12-31 23:59:59.999999",),
                                    ("2024-03-10 02:30:00",)], "s string")
        got = [r[0] for r in df.select(epoch_micros(F.col("s").cast("timestamp_ntz"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [1719837296123456, -1, 1710037800000000]


def test_auc_of_groups_is_the_auc_of_each(spark):
    import random
    r = random.Random(8)
    rows = [(r.choice(["a", "b", None]), r.choice([1, 2, None]), r.choice([True, False, None]), r.choice([None, float("nan"), *(k / 7 for k in range(9))]))
            for _ in range(900)]
    df = spark.createDataFrame(rows, "g string, s int, y boolean, pos double")        # names that the operator uses itself
    for ranges in (1, 4, 60):
        got = {(x["g"], x["s"]): tuple(x)[2:] for x in metrics.auc_by_group(df, ["g", "s"], "y", "pos", ranges).collect()}
        for g in ("a", "b", None):
            for k in (1, 2, None):
                own = [(y, v) for a, b, y, v in rows if (a, b) == (g, k) and y is not None and v is not None]
                key = lambda v: float("inf") if v != v else v
                p, n = [key(v) for y, v in own if y], [key(v) for y, v in own if not y]
                wins = sum((a > b) + (a == b) / 2 for a in p for b in n)
                assert got[g, k] == (pytest.approx(wins / (len(p) * len(n))), len(p), len(n))


def test_auc_of_no_rows(spark):
    none = spark.createDataFrame([], "g string, y boolean, s double")
    assert tuple(metrics.auc_exact(none, "y", "s").first()) == (None, 0, 0)
    assert metrics.auc_by_group(none, ["g"], "y", "s").count() == 0


def test_auc_numerator_is_exact_beyond_64_bits():
    import numpy as np
    pos, neg = np.array([3 * 10**10, 1]), np.array([10**10, 7])
    assert metrics._numerator(pos, neg, 5 * 10**10) == 3 * 10**10 * 10**10 + 2 * 10**10 + 7 + 2 * 5 * 10**10 * (3 * 10**10 + 1)
