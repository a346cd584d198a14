"""Ranked search against scores of all documents in plain Python."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from gapwise.llm import ranking

DOCS = "doc_id long, text string, score string, rank int"
ITEMS = "item_id long, text string, doc_id string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k=10):
    own = [(i, Counter(words(t))) for i, t, *_ in docs]
    n, total = sum(bool(c) for _, c in own), sum(c.total() for _, c in own)
    df = Counter(t for _, c in own for t in c)
    out = []
    for item, text, *_ in items:
        scored = []
        for i, c in own:
            m = 25 + 75 * c.total() * n // max(1, total)
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in words(text) if c[t])
            if s > 0:
                scored.append((-s, i is None, i or 0))
        out += [(item, r, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def corpus(seed, docs, vocabulary, length):
    r = random.Random(seed)
    vocab = [f"{r.choice('abÉ日xyz')}{i}" for i in range(vocabulary)]
    rare = [1 / (i + 1) for i in range(vocabulary)]
    rows = [(i if i % 50 else None if i else 0, " ".join(r.choices(vocab, rare, k=r.randrange(length))), "x", 1) for i in range(docs)]
    rows += [(docs + i, rows[i % 7][1], "x", 1) for i in range(60)]                    # ties
    rows += [(docs + 100, None, "x", 1), (docs + 101, "  ,.\n", "x", 1), (docs + 102, "a1 " * 3000 + "É2", None, None), rows[3], rows[3]]
    r.shuffle(rows)
    items = [(i, "; ".join(r.choices(vocab, k=r.randrange(1, 30))), "x") for i in range(40)]
    items += [(None, vocab[0] + " " + vocab[1], "x"), (5, None, "x"), (6, "?!", "x"), items[2], (7, "never seen words", "x"), (8, "A1-a1 A1", "x")]
    return rows, items


def run(spark, rows, items, parts=5):
    index, _ = ranking.build(spark.createDataFrame(rows, DOCS).repartition(parts))
    out = ranking.search(index, spark.createDataFrame(items, ITEMS))
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, out.collect()), key=repr)


@pytest.mark.parametrize("block, window, shard", [(128, 4096, 16 << 20), (4, 16, 2000)])
def test_matches_all_scores(spark, monkeypatch, block, window, shard):
    monkeypatch.setattr(ranking, "BLOCK", block)
    monkeypatch.setattr(ranking, "WINDOW", window)
    monkeypatch.setattr(ranking, "SHARD_BYTES", shard)
    rows, items = corpus(1, 500, 120, 60)
    assert run(spark, rows, items) == brute(rows, items)


def test_queries_in_parts(spark, monkeypatch):
    monkeypatch.setattr(ranking, "BATCH_TERMS", 20)
    rows, items = corpus(2, 100, 60, 30)
    assert run(spark, rows, items) == brute(rows, items)


def test_added_shards(spark):
    rows, items = corpus(3, 200, 80, 30)
    parts = [ranking.build(spark.createDataFrame(rows[a::2], DOCS))[0] for a in (0, 1)]
    out = ranking.search(parts[0].unionByName(parts[1]), spark.createDataFrame(items, ITEMS), k=3)
    assert sorted(map(tuple, out.collect()), key=repr) == brute(rows, items, 3)


@pytest.mark.parametrize("rows, items", [([], [(1, "a", "x")]), ([(1, "a", "x", 1)], []), ([(1, None, "x", 1)], [(1, "a", "x")]),
                                         ([(1, "a", "x", 1)], [(1, "A", "x")])])
def test_small_tables(spark, rows, items):
    assert run(spark, rows, items, 1) == brute(rows, items)


def test_blocks_are_rejected_packed():
    """Frequent terms of a query that a rare one settles: few of their blocks are unpacked."""
    texts = ["common " * (1 + i % 3) + "filler " * 20 + ("rare " * 40 if i in (7, 77, 90) else "") for i in range(20_000)]
    hashes, first = ranking.terms(pa.array(texts))
    row = ranking.shard(list(range(len(texts))), hashes, np.diff(first))
    of = ranking.Shard(row, len(texts), len(hashes))
    asked, _ = ranking.terms(pa.array(["rare common"]))
    best = ranking.Best(3)
    weights = np.array([9000, 400])
    unpacked = ranking.search_shard(of, of.find(asked), weights, best)
    assert sorted(best.id.tolist()) == [7, 77, 90]
    common = of.blocks_of(int(of.find(asked)[1]))
    assert common.stop - common.start == 157 and unpacked < 40


def test_packed_values_come_back():
    r = np.random.default_rng(1)
    ids = sorted(r.choice(10**6, 70_000, replace=False).tolist())
    lengths = r.integers(0, 4, len(ids))
    lengths[5] = 70_000
    hashes = r.integers(0, 50, int(lengths.sum()))
    of = ranking.Shard(ranking.shard(ids, hashes, lengths), 10, 10)
    document = np.repeat(np.arange(len(ids)), lengths)
    for k, term in enumerate(of.terms):
        own = of.blocks_of(k)
        got = [of.unpack(b, own.start) for b in range(own.start, own.stop)]
        held, tf = np.unique(document[hashes == term], return_counts=True)
        assert np.array_equal(np.concatenate([g[0] for g in got]), held)
        assert np.array_equal(np.concatenate([g[1] for g in got]), 10**9 * tf // (1000 * tf + of.norm[held]))
