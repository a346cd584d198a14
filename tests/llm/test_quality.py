"""Positive-unlabelled quality scores: held-out accuracy and defined results at the edges."""

import numpy as np
import pyarrow as pa

from conftest import SF_ORACLE
from gapwise.llm import quality
from gapwise.llm.folds import remainder
from gapwise.llm.queries import QUERIES
from gapwise.llm.words import text_buffers


def test_held_out_accuracy(spark):
    got = QUERIES["op3_quality"](spark, SF_ORACLE)
    labels = spark.read.parquet(f"{SF_ORACLE}/labels.parquet")
    rows = got.join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 50
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) >= 0.95
    assert got.count() == spark.read.parquet(f"{SF_ORACLE}/documents.parquet").count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got.collect())


def test_prior_is_close_to_the_share_of_positives(spark):
    rng = np.random.default_rng(4)
    x = np.zeros((4000, len(quality.SHAPES)))
    good = rng.random(4000) < 0.7
    x[:, 0] = np.where(good, rng.normal(2, 1, 4000), rng.normal(-3, 1, 4000))
    rows = spark.createDataFrame([(v.tolist(),) for v in x], "x array<double>").repartition(3)
    pos = spark.createDataFrame([(v.tolist(),) for v in x[good][:800]], "x array<double>")
    basis = quality.Basis(x.mean(0), np.where(x.std(0) > 0, x.std(0), 1), np.quantile(x, quality.CUTS, axis=0))
    w = quality._newton(basis, pos, rows, 800, 4000, 0.5, False)
    prior = quality._prior(basis, w, pos, rows, 800, 4000)
    assert abs(prior - good.mean()) < 0.06
    w = quality._newton(basis, pos, rows, 800, 4000, prior, True)
    assert ((basis(x) @ w > 0) == good).mean() > 0.98


def test_edges(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g", 0), (1, "a b c d e f g", 0), (2, None, 1), (3, "", 1), (None, "#$ %&", 1)],
                                 "doc_id long, text string, label int")
    labels = spark.createDataFrame([(1, 1), (1, None), (2, 0), (None, 1)], "doc_id long, quality int")
    got = quality.score(docs, labels).collect()
    assert len(got) == 5 and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["score"] == 0.5 for r in quality.score(docs, labels.where("quality = 0")).collect())
    assert quality.score(docs.limit(0), labels).count() == 0


def test_shapes_of_a_text():
    row = dict(zip(quality.SHAPES, quality.shapes(*text_buffers(pa.array(["Ab ab 1# é."])))[0]))
    assert row["log_words"] == np.log1p(4) and row["upper"] == 1 / 9 and row["digit"] == 1 / 9
    assert row["odd"] == 1 / 9 and row["stop"] == 1 / 9 and row["wide"] == 2 / 9 and row["distinct"] == 0.75 and row["twice"] == 1 / 3


def test_remainder_is_the_checksum_of_the_text(spark):
    import zlib

    got = spark.range(50).select("id", remainder(5, "id").alias("r")).collect()
    assert all(r["r"] == zlib.crc32(str(r["id"]).encode()) % 5 for r in got)
