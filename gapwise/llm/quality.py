"""Quality scores by positive-unlabelled learning.

Trusted positive documents and unlabelled web text are enough: with the share
of positives in the web text estimated first, the risk of a classifier is
written without any negative example. The logistic loss makes that risk convex,
so Newton steps minimise it, each a sum over all unlabelled rows; a step is
shortened where the estimated risk on negatives would fall below zero.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapwise.llm.words import _IS_SPACE, shingle_sets, slices, text_buffers, word_hashes
from gapwise.runtime import drop_scratch, materialize

SHAPES = ("log_words", "word_bytes", "upper", "digit", "stop", "mark", "odd", "wide", "newline", "distinct", "top",
          "twice", "fresh")
CUTS = (0.1, 0.5, 0.9, 0.98)       # quantiles at which a shape's weight may change
STEPS = 12
RIDGE = 5e-3
THRESHOLD = 0.3

_CLASS = np.full(256, 7, np.uint8)                       # marks of no other class
for _chars, _k in ((b"abcdefghijklmnopqrstuvwxyz", 0), (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", 1), (b"0123456789", 2),
                   (b".,;:!?'\"-()", 3), (b"#$%&*|<>{}[]=_^~\\/+@`", 4), (bytes(range(128, 256)), 5), (b"\n", 6)):
    _CLASS[list(_chars)] = _k
_CLASS[_IS_SPACE] = 8
_CLASS[10] = 6


def shapes(buf: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One row of SHAPES for each text."""
    n = len(bounds) - 1
    size = np.diff(bounds)
    owner = np.repeat(np.arange(n, dtype=np.int64), size)
    kinds = np.bincount(owner * 9 + _CLASS[buf], minlength=9 * n).reshape(n, 9).astype(float)
    words, first = word_hashes(buf, bounds)
    count = np.diff(first).astype(float)
    ink = np.maximum(kinds[:, :6].sum(1) + kinds[:, 7], 1)
    distinct, top, twice, fresh = (np.zeros(n) for _ in range(4))
    for i, s in enumerate(shingle_sets(words, first)):
        own = words[first[i]: first[i + 1]]
        if len(own):
            values, times = np.unique(own, return_counts=True)
            distinct[i] = len(values) / len(own)
            top[i] = times.max() / len(own)
            twice[i] = (own[1:] == own[:-1]).mean() if len(own) > 1 else 0
            fresh[i] = len(s) / max(len(own) - 4, 1)
    return np.column_stack([
        np.log1p(count), ink / np.maximum(count, 1), kinds[:, 1] / ink, kinds[:, 2] / ink, kinds[:, 3] / ink,
        kinds[:, 7] / ink, kinds[:, 4] / ink, kinds[:, 5] / ink, kinds[:, 6] / np.maximum(count, 1),
        distinct, top, twice, fresh])


def _shape_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, 1, 2 << 20):
            x = shapes(*text_buffers(batch.column(1)))
            bounds = np.arange(len(x) + 1, dtype=np.int32) * len(SHAPES)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(bounds), pa.array(x.ravel()))],
                names=["doc_id", "x"])


class Basis:
    """Shapes as standardised values and hinges at quantiles, with a constant."""

    def __init__(self, mean: np.ndarray, std: np.ndarray, cuts: np.ndarray):
        self.mean, self.std, self.cuts = mean, std, cuts

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.std, -10, 10)
        at = np.clip((self.cuts - self.mean) / self.std, -10, 10)
        return np.column_stack([np.ones(len(x)), z, *[np.maximum(z - c, 0) for c in at]])


def _matrix(batch: pa.RecordBatch, column: str = "x") -> np.ndarray:
    return batch.column(column).flatten().to_numpy().reshape(batch.num_rows, len(SHAPES))


def _summed(rows: DataFrame, part: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """Sum of ``part`` (one vector for each batch of shapes) over all rows, added up in two levels."""
    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                total += part(_matrix(b.slice(at, 4096)))
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["s"])

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for b in batches:
            total += b.column(0).flatten().to_numpy().reshape(b.num_rows, width).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["s"])

    parts = rows.select("x").mapInArrow(first, "s array<double>")
    fewer = max(1, int(parts.rdd.getNumPartitions() ** 0.5))
    sums = parts.repartition(fewer).mapInArrow(again, "s array<double>").collect()
    return np.sum([r["s"] for r in sums], axis=0) if sums else np.zeros(width)


def _sigmoid(g: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(g / 2))


def _softplus(g: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, g)


def _newton(basis: Basis, positives: DataFrame, unlabelled: DataFrame, n_pos: float, n_unl: float, weight: float,
            bounded: bool) -> np.ndarray:
    """Minimise  mean_u softplus(g) - weight * mean_p g  (g = w . basis), by Newton steps over all rows.

    With ``bounded`` a step keeps  mean_u softplus(g) - weight * mean_p softplus(g),
    the estimated risk on negatives, at or above zero.
    """
    d = 1 + len(SHAPES) * (1 + len(CUTS))
    mean_p = _summed(positives, lambda x: basis(x).sum(0), d) / n_pos
    w = np.zeros(d)
    best = np.inf
    step = np.zeros(d)
    scale = 1.0
    for _ in range(STEPS):
        tried = w + scale * step

        def part(x: np.ndarray, tried=tried) -> np.ndarray:
            b = basis(x)
            g = b @ tried
            p = _sigmoid(g)
            h = (b * (p * (1 - p))[:, None]).T @ b
            return np.concatenate(([_softplus(g).sum()], b.T @ p, h.ravel()))

        sums = _summed(unlabelled, part, 1 + d + d * d) / n_unl
        negative = sums[0]
        if bounded:
            negative -= weight * _summed(positives, lambda x, t=tried: _softplus(basis(x) @ t).sum(keepdims=True), 1)[0] / n_pos
        risk = sums[0] - weight * mean_p @ tried + RIDGE / 2 * tried @ tried
        if risk > best + 1e-12 or bounded and negative < 0:
            scale /= 2
            continue
        w, done = tried, best - risk < 1e-6
        best = risk
        if done:
            break
        gradient = sums[1:1 + d] - weight * mean_p + RIDGE * w
        step = -np.linalg.solve(sums[1 + d:].reshape(d, d) + RIDGE * np.eye(d), gradient)
        scale = 1.0
    return w


def _prior(basis: Basis, w: np.ndarray, positives: DataFrame, unlabelled: DataFrame, n_pos: float, n_unl: float) -> float:
    """Share of positives in the unlabelled rows: the least ratio of the two sets' shares above a score.

    Half a standard error is added above and taken off below, so that the few
    rows in the tails do not set the ratio.
    """
    bins = 200

    def part(x: np.ndarray) -> np.ndarray:
        return np.bincount(np.clip((_sigmoid(basis(x) @ w) * bins).astype(int), 0, bins - 1), minlength=bins).astype(float)

    above_p = np.cumsum((_summed(positives, part, bins) / n_pos)[::-1])
    above_u = np.cumsum((_summed(unlabelled, part, bins) / n_unl)[::-1])
    top, bottom = above_u + 0.5 / np.sqrt(n_unl), above_p - 0.5 / np.sqrt(n_pos)
    enough = bottom >= 0.1
    return float(np.clip((top[enough] / bottom[enough]).min() if enough.any() else 0.5, 0.05, 0.99))


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          label_id_col: str = "doc_id") -> DataFrame:
    """Per row of ``docs``: doc_id, score (0 to 1, higher is better).

    ``labels`` are the rows that may teach; a document whose labels are all 1
    is a trusted positive. All documents are unlabelled text. Null texts count
    as empty and get a score like any other. Repeated and null ids stay; a null
    label teaches nothing. Without a positive every score is 0.5. Other columns
    are ignored. An empty table gives no rows.
    """
    spark = docs.sparkSession
    good = (labels.select(F.col(label_id_col).cast("long").alias("doc_id"), F.col(label_col).alias("label"))
            .where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.min("label").alias("label"))
            .where("label = 1").select("doc_id"))
    rows = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(_shape_rows, "doc_id long, x array<double>"))
    rows, _ = materialize(rows, "quality-shapes")
    positives, positives_at = materialize(rows.join(good, "doc_id").select("x"), "quality-positives")
    n_pos, n_unl = float(positives.count()), float(rows.count())
    if not n_pos:
        return rows.select("doc_id", F.lit(0.5).alias("score"))
    k = len(SHAPES)
    moments = _summed(rows, lambda x: np.concatenate((x.sum(0), (x * x).sum(0))), 2 * k) / n_unl
    std = np.sqrt(np.maximum(moments[k:] - moments[:k] ** 2, 0))
    cut = rows.agg(*[F.percentile_approx(F.col("x")[i], list(CUTS), 10000).alias(f"q{i}")
                     for i in range(k)]).first()
    basis = Basis(moments[:k], np.where(std > 1e-12, std, 1.0), np.array([list(cut[f"q{i}"]) for i in range(k)]).T)
    # First positives against unlabelled rows, for the class prior; then the risk with that prior.
    telling = _newton(basis, positives, rows, n_pos, n_unl, 0.5, False)
    prior = _prior(basis, telling, positives, rows, n_pos, n_unl)
    w = _newton(basis, positives, rows, n_pos, n_unl, prior, True)
    drop_scratch(spark, positives_at)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(_sigmoid(basis(_matrix(b)) @ w))], names=["doc_id", "score"])
    return rows.mapInArrow(scored, "doc_id long, score double")
