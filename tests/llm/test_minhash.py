"""Near-duplicate documents against all pairs in plain Python."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gapwise.llm import minhash
from gapwise.llm.graph import components
from test_words import plain_shingles

SCHEMA = "doc_id long, text string, node string, component_id int"


def brute(rows):
    """doc_id -> (set size, component) over rows of (id, text) with distinct ids."""
    sets = {i: plain_shingles(t) for i, t in rows}
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                a_, b_ = find(a), find(b)
                root[max(a_, b_)] = min(a_, b_)
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(seed=3):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    rows, n = [], 0
    shared = [r.choice(words) for _ in range(60)]
    for size, copies in ((120, 40), (30, 12), (8, 6), (400, 5)):
        base = [r.choice(words) for _ in range(size)]
        for c in range(copies):
            text = list(base)
            for _ in range(r.randrange(0, max(2, size // 30))):
                text[r.randrange(size)] = r.choice(words)
            rows.append((n, " ".join(text).upper() if c % 3 == 0 else "\n".join(text)))
            n += 1
    for _ in range(60):
        rows.append((n, " ".join(shared + [r.choice(words) for _ in range(r.randrange(5, 90))])))
        n += 1
    rows += [(n, "one two"), (n + 1, "ONE  two "), (n + 2, "two one"), (n + 3, ""), (n + 4, None), (n + 5, " \n"), (n + 6, "é a b c d e")]
    r.shuffle(rows)
    return rows


def test_matches_all_pairs(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA).repartition(4)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(docs).collect()}
    assert got == {i: (n, c, i == c) for i, (n, c) in brute(rows).items()}


def test_repeated_rows_null_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (2, "A B C D E F"), (None, "a b c d e f"),
                                  (None, "q"), (3, None)], "doc_id long, text string")
    got = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(1, 1, True), (1, 1, True), (2, 1, False), (None, 1, False), (None, None, True), (3, 3, True)], key=str)
    assert sorted(r["doc_id"] or 0 for r in minhash.deduplicated(docs).where("doc_id is not null").collect()) == [1, 3]
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_signature_agreement_estimates_similarity():
    rng = np.random.default_rng(1)
    for n in (3, 20, 500):
        base = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        other = np.unique(np.concatenate((base[: len(base) * 3 // 4], rng.integers(0, 1 << 63, max(1, n // 10), dtype=np.uint64))))
        both = len(np.intersect1d(base, other)) / len(np.union1d(base, other))
        same = np.mean([(minhash.signature(np.unique(base ^ np.uint64(k)), 1024) ==
                         minhash.signature(np.unique(other ^ np.uint64(k)), 1024)).mean() for k in range(1, 6)])
        assert same == pytest.approx(both, abs=0.12)
    assert len(minhash.signature(np.array([7], np.uint64))) == 128


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(60)] + [(100, 101), (101, 100), (5, 5)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
    assert components(edges.limit(0)).count() == 0


def test_links_between_members_that_are_no_centres(spark, monkeypatch):
    # Texts of one template in one bucket of 30, pairwise under the threshold; each has one near copy.
    r = random.Random(5)
    template = [f"t{i}" for i in range(200)]
    rows = []
    for g in range(15):
        text = list(template)
        for k in r.sample(range(0, 200, 5), 4):
            text[k] = f"g{g}x{k}"
        rows.append((2 * g, " ".join(text)))
        text[r.choice([2, 52, 102, 152])] = f"copy{g}"
        rows.append((2 * g + 1, " ".join(text)))
    want = brute(rows)
    assert len({c for _, c in want.values()}) > 10
    signed = minhash.signatures
    monkeypatch.setattr(minhash, "signatures", lambda *a: signed(*a).withColumn("keys", F.array(F.lit(1).cast("long"))))
    got = {x["doc_id"]: x["component_id"] for x in minhash.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert got == {i: c for i, (_, c) in want.items()}


def test_exact_join_of_unsettled_sets(spark):
    r = random.Random(9)
    rows = [(k, s) for k, s in enumerate(sorted(r.sample(range(40), r.randrange(8, 24))) for _ in range(300))]
    for k in range(300, 400):
        base = rows[r.randrange(300)][1]
        rows.append((k, sorted(set(base) - {r.choice(base)} | {r.randrange(40)})))
    rows.append((400, rows[0][1] + [99]))
    root = {k: k for k, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, x in rows:
        for b, y in rows:
            if a < b and 100 * len({*x} & {*y}) >= 75 * len({*x} | {*y}):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    sets = spark.createDataFrame(rows, "node long, shingles array<long>").repartition(3)
    start = spark.createDataFrame([(k, find(k)) for k in range(0, 100)], "node long, root long")
    sketches = sets.select("node", F.size("shingles").cast("long").alias("size"), F.lit(bytes(128)).alias("sketch"))
    for roots in (None, start):
        got = {x["node"]: x["root"] for x in minhash._settled(sets.select("node"), sets, sketches, roots).collect()}
        assert {k: got.get(k, k) for k in root} == {k: find(k) for k in root}


def test_hot_shingles_in_parts(spark, monkeypatch):
    monkeypatch.setattr(minhash, "HOT", 20)
    test_exact_join_of_unsettled_sets(spark)


def test_one_group_of_near_copies(spark, monkeypatch):
    """A group in which all texts are alike: few pairs a text, in several tasks, and all its links."""
    seen = []
    verified = minhash._verified
    monkeypatch.setattr(minhash, "STAR", 20)
    monkeypatch.setattr(minhash, "_verified", lambda pairs, *a: seen.append(pairs.count()) or verified(pairs, *a))
    r = random.Random(12)
    base = [f"w{r.randrange(3000)}" for _ in range(120)]
    rows = []
    for i in range(500):
        text = list(base)
        for k in range(r.randrange(3)):
            text[r.randrange(120)] = f"n{i}x{k}"
        rows.append((i, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {x["doc_id"]: x["component_id"] for x in minhash.near_duplicates(docs).collect()}
    assert got == {i: c for i, (_, c) in brute(rows).items()}
    assert sum(seen) < 12 * len(rows)


def test_sketches_rule_out_only_what_differs(spark):
    r = random.Random(13)
    rows = []
    for g in range(12):
        base = [f"g{g}w{k}" for k in range(700)]
        for c, edits in enumerate((0, 8, 16, 24, 60)):
            text = list(base)
            for k in r.sample(range(700), edits):
                text[k] = f"e{g}x{c}x{k}"
            rows.append((5 * g + c, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {x["doc_id"]: x["component_id"] for x in minhash.near_duplicates(docs).collect()}
    assert got == {i: c for i, (_, c) in brute(rows).items()}


def test_columns_of_any_name_stay(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", 7, "x", 1), (2, "a b c d e f", 8, "y", 2), (2, "a b c d e f", 8, "y", 2), (3, None, 9, "z", 3)],
                                 "doc_id long, text string, _id int, kept string, rows int")
    got = minhash.deduplicated(docs)
    assert got.columns == docs.columns and sorted(map(tuple, got.collect())) == [(1, "a b c d e f", 7, "x", 1), (3, None, 9, "z", 3)]


def test_a_sieve_keeps_what_a_join_keeps(spark):
    from gapwise.llm import joins

    rows = spark.createDataFrame([(i if i % 9 else None, f"t{i}", i) for i in range(5000)], "doc_id long, text string, sieve_1 int").drop("sieve_1")
    ids = spark.createDataFrame([(i,) for i in range(0, 5000, 7)] + [(-5,)], "doc_id long")
    got = joins.sieved(rows, "doc_id", ids)
    assert got.join(ids, "doc_id").count() == rows.join(ids, "doc_id").count() and got.count() < 800
    assert joins.sieved(rows, "doc_id", ids.limit(0)).count() == 0
