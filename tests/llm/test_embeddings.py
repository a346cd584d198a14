"""Near-duplicate vectors against all pairs."""

import math

import numpy as np
import pytest

from gapwise.llm import embeddings


def brute(rows):
    ids = [i for i, _ in rows]
    unit = {}
    for k, (_, v) in enumerate(rows):
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            a = np.array(v, float)
            unit[k] = a / np.linalg.norm(a)
    near = {k: [j for j in unit if j != k and len(unit[j]) == len(unit[k]) and unit[j] @ unit[k] >= 0.9] for k in unit}
    label = list(ids)
    changed = True
    while changed:
        changed = False
        for k, js in near.items():
            m = min([label[k], *[label[j] for j in js]])
            if m < label[k]:
                label[k], changed = m, True
    return sorted((i, len(near.get(k, [])), label[k], label[k] == i) for k, i in enumerate(ids))


def test_matches_all_pairs(spark):
    rng = np.random.default_rng(5)
    rows = []
    for copies in (250, 30, 4, 2, 1, 1, 1):
        centre = rng.normal(size=24)
        for _ in range(copies):
            rows.append((centre + rng.normal(size=24) * rng.choice([0.05, 0.25, 0.4]) * np.linalg.norm(centre) / 24 ** 0.5).tolist())
    rows += [rows[0], rows[0], [x * 3 for x in rows[1]], [], None, [0.0] * 24, [1.0, None] * 12, [float("nan")] * 24,
             [float("inf")] + [0.0] * 23, [1.0, 2.0], [2.0, 4.0], [-0.0, 1.0], [0.0, 1.0], [3.0]]
    rows = [(int(i), v) for i, v in zip(rng.permutation(len(rows)), rows)]
    df = spark.createDataFrame([(i, v, "l") for i, v in rows], "vec_id long, embedding array<double>, node string").repartition(3)
    got = sorted(tuple(r) for r in embeddings.near_duplicates(df).collect())
    want = brute(rows)
    found, real = sum(r[1] for r in got), sum(r[1] for r in want)
    assert all(g[1] <= w[1] for g, w in zip(got, want))
    assert found >= 0.99 * real
    if found == real:
        assert got == want


def test_empty_and_repeated_ids(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.0]), (None, None)], "vec_id long, embedding array<float>")
    got = sorted((tuple(r) for r in embeddings.near_duplicates(df).collect()), key=str)
    assert got == sorted([(1, 2, 1, True), (1, 2, 1, True), (None, 2, 1, False), (None, 0, None, True)], key=str)
    assert embeddings.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("d", [1, 2, 8, 64])
def test_hadamard_is_a_rotation(d):
    x = np.random.default_rng(0).normal(size=(5, d))
    y = embeddings.hadamard(x)
    assert np.allclose(embeddings.hadamard(y), x)
    assert np.allclose(np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1))


def test_recall_of_buckets_at_the_threshold():
    rng = np.random.default_rng(2)
    a = rng.normal(size=(1500, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.normal(size=a.shape)
    b -= (a * b).sum(1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    b = 0.9 * a + math.sqrt(1 - 0.81) * b
    for rotations, least in ((2, 0.99), (3, 0.9)):
        x, y = embeddings.buckets(a, rotations), embeddings.buckets(b, rotations)
        assert (x[:, :, :, None] == y[:, :, None, :]).any(axis=(1, 2, 3)).mean() >= least
