"""The n-gram model against a dictionary-based model in plain Python."""

import collections
import math
import random

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gapwise.llm import ngram
from gapwise.llm.ngram import _written
from gapwise.llm.eliasfano import EliasFano, encode
from gapwise.runtime import drop_scratch, materialize
from test_words import plain_words

U64 = np.uint64


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 40), st.integers(0, 2 ** 64 - 1)), max_size=300), st.lists(st.integers(0, 2 ** 64 - 1), max_size=30))
def test_elias_fano_search(values, queries):
    v = np.sort(np.array(values, U64))
    buf = np.frombuffer(encode(v), np.uint8)
    ef = EliasFano(buf)
    assert ef.end == len(buf) and (ef.get(np.arange(len(v))) == v).all()
    q = np.concatenate((v, np.array(queries, U64), np.arange(45, dtype=U64)))
    at, equal = ef.successor(q)
    assert (at == np.searchsorted(v, q)).all() and (equal == np.isin(q, v)).all()


@pytest.mark.parametrize("values", [[0, 0, 5], [0] * 300 + [1 << 40] * 200, [*range(100), 1 << 30, (1 << 30) + 1], [7] * 65 + [8] * 64 + [1 << 62]])
def test_elias_fano_neighbours_and_long_runs(values):
    v = np.array(values, U64)
    ef = EliasFano(np.frombuffer(encode(v), np.uint8))
    one, two = ef.pair(np.arange(len(v) - 1))
    assert (one == v[:-1]).all() and (two == v[1:]).all()
    q = np.unique(np.concatenate((v, v + U64(1))))
    at, equal = ef.successor(q)
    assert (at == np.searchsorted(v, q)).all() and (equal == np.isin(q, v)).all()


def test_ngrams_that_are_not_kept_are_not_written(spark, monkeypatch):
    written = {}

    def watched(df, name):
        out = written[name], _ = materialize(df, name)
        return out
    monkeypatch.setattr(ngram, "materialize", watched)
    counted = []
    monkeypatch.setattr(ngram, "_written", lambda rows, *rest: counted.append(rows.count()) or _written(rows, *rest))
    texts = spark.createDataFrame([("a b c d",), ("a b c e",), ("f g",)], "text string")
    _, folder = ngram.learn(texts)
    drop_scratch(spark, folder)
    assert counted == [8, 3, 3, 2, 2]          # words; contexts and pairs that occur twice; the same of three
    assert not [name for name in written if name.endswith("-kept")]


class Plain:
    """Interpolated absolute discounting over dictionaries, unquantised."""

    def __init__(self, texts):
        self.one, two, three = collections.Counter(), collections.Counter(), collections.Counter()
        seqs = [[*plain_words(t), None] for t in texts]
        for s in seqs:
            self.one.update(s)
        self.n, self.v = sum(self.one.values()), len(self.one)
        for s in seqs:
            s = [None, *s]
            two.update(zip(s, s[1:]))
            three.update(zip(s, s[1:], s[2:]))
        self.two = {k: c for k, c in two.items() if c >= ngram.LEAST}
        self.three = {k: c for k, c in three.items() if c >= ngram.LEAST}
        self.rest2, self.rest3 = collections.defaultdict(float), collections.defaultdict(float)
        for k, c in self.two.items():
            self.rest2[k[0]] += (c - ngram.DISCOUNT) / self.one[k[0]]
        for k, c in self.three.items():
            self.rest3[k[:2]] += (c - ngram.DISCOUNT) / self.two[k[:2]]

    def p1(self, w):
        return (self.one[w] + 0.5) / (self.n + 0.5 * (self.v + 1))

    def p2(self, v, w):
        return max(0, self.two.get((v, w), 0) - ngram.DISCOUNT) / max(self.one[v], 1) + (1 - self.rest2[v]) * self.p1(w)

    def p3(self, u, v, w):
        if (u, v) not in self.two:
            return self.p2(v, w)
        return max(0, self.three.get((u, v, w), 0) - ngram.DISCOUNT) / self.two[u, v] + (1 - self.rest3[u, v]) * self.p2(v, w)

    def score(self, text):
        s = [None, *plain_words(text), None]
        total = math.log10(self.p2(None, s[1]))
        return total + sum(math.log10(self.p3(*t)) for t in zip(s, s[1:], s[2:]))

    def base(self, text):
        return sum(math.log10(self.p1(w)) for w in [*plain_words(text), None])


def corpus():
    r = random.Random(8)
    words = [f"w{i}" for i in range(40)] + ["Ä", "ä"]
    phrase = ["w1", "w2", "w3", "W4", "w5"]
    return [" ".join(x for _ in range(r.randrange(0, 14)) for x in (phrase if r.random() < 0.3 else [r.choice(words)])) for _ in range(300)]


def test_scores_match_plain_python(spark):
    train = corpus()
    plain = Plain(train)
    df = spark.createDataFrame([(t, 1) for t in train] + [(None, 1)], "text string, n int").repartition(3)
    model, folder = ngram.learn(df.where("text is not null"))
    assert (model.total, model.kinds) == (plain.n, plain.v)
    ask = [(0, "w1 w2 w3 w4 w5 w1"), (1, "unseen w2 w3 unseen"), (2, ""), (3, None), (4, "W1\tw2"), (4, "W1\tw2"), (None, "w7"), (5, " ".join(train) )]
    got = ngram.score(spark.createDataFrame([(i, t, 0.0) for i, t in ask], "doc_id long, text string, score double").repartition(2), model).collect()
    assert len(got) == len(ask)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    for i, t in ask:
        words = plain_words(t)
        for r in by[i]:
            assert r["n_tokens"] == len(words) + 1 and r["train_tokens"] == plain.n
            assert r["n_known"] == 1 + sum(w in plain.one for w in words)
            assert r["base_score"] == pytest.approx(plain.base(t), rel=1e-12)
            assert r["score"] == pytest.approx(plain.score(t), abs=0.001 * r["n_tokens"])
    assert sum(10 ** math.log10(plain.p3("w1", "w2", w)) for w in plain.one) + plain.p2("w1", "w2") * 0 == pytest.approx(
        1 - (1 - plain.rest3["w1", "w2"]) * (1 - plain.rest2["w2"]) * plain.p1("never"), abs=1e-9)
    drop_scratch(spark, folder)


def test_no_training_text(spark):
    empty = spark.createDataFrame([], "text string")
    model, _ = ngram.learn(empty)
    got = ngram.score(spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string"), model).collect()
    assert [(r["n_tokens"], r["n_known"], r["base_score"]) for r in got] == [(3, 0, 0.0), (1, 0, 0.0)]
    assert ngram.score(spark.createDataFrame([], "doc_id long, text string"), model).count() == 0


def test_counts_of_words_in_a_file(tmp_path):
    from gapwise.llm import mapped

    keys = np.sort(np.random.default_rng(1).choice(2 ** 62, 3000, replace=False)).astype(np.int64)
    n = np.random.default_rng(2).integers(1, 600, 3000)
    words = ngram.Words(mapped.write(str(tmp_path), "w", ngram._word_file(keys, n)))
    assert (words.count(keys) == n).all() and (words.count(keys + 1)[~np.isin(keys + 1, keys)] == 0).all()


def test_level_finds_its_ngrams_only(tmp_path):
    from gapwise.llm import mapped

    r = np.random.default_rng(3)
    code = np.unique(r.integers(7, 90, 4000) << 14 | r.integers(0, 40, 4000))
    code = code[(code >> 14 < 30) | (code >> 14 > 50)]                    # contexts without children between
    context, word = code >> 14, code & 16383
    prob = r.uniform(1e-9, 1, len(code))
    level = ngram.Level(mapped.write(str(tmp_path), "t", ngram._level_file(context, word, prob, np.arange(len(code)))))
    ask = np.unique(np.concatenate((code, r.integers(context[0], context[-1] + 1, 4000) << 14 | r.integers(0, 45, 4000))))
    at, found = level.find(ask >> 14, ask & 16383)
    assert (found == np.isin(ask, code)).all() and 0 < found.sum() < len(ask)
    assert (level.counts[at[found]] == np.arange(len(code))).all() and (level.word(np.arange(len(code))) == word).all()
    assert np.abs(level.codes / -ngram.GRID - np.log10(prob)).max() <= 0.5 / ngram.GRID + 1e-12


def test_what_is_left_is_read_by_place(tmp_path):
    from gapwise.llm import mapped

    id, rest = np.array([5, 6, 9, 40]), np.array([0.5, 0.001, 1e-9, 0.75])
    got = ngram.Rests(mapped.write(str(tmp_path), "r", ngram._rest_file(id, rest)), 5).find(np.arange(5, 41))
    assert got[id - 5] == pytest.approx(np.log10(rest), abs=1 / ngram.GRID) and not got[np.isin(np.arange(5, 41), id, invert=True)].any()


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(-2 ** 62, 2 ** 62) | st.integers(0, 9), max_size=60))
def test_distinct_values(values):
    x = np.array(values, np.int64)
    unique, back = ngram.distinct(x)
    assert (unique == np.unique(x)).all() and (unique[back] == x).all()


def test_texts_do_not_share_ngrams(spark):
    # "b c" and "a b c" would be kept, were a text joined to the one before it
    texts = spark.createDataFrame([("a b",), ("c",)] * 4, "text string").coalesce(1)
    model, folder = ngram.learn(texts)
    batch = pa.RecordBatch.from_arrays([pa.array(["a b", "c"])], ["text"])
    assert len(ngram._codes(model, 2)(batch)) == 5 and len(ngram._codes(model, 3)(batch)) == 3
    drop_scratch(spark, folder)


def test_ngrams_of_rare_words(spark):
    # A phrase that occurs nine times among 200,000 tokens: its words are under 2**-14 of them.
    r = random.Random(4)
    train = [" ".join(f"c{r.randrange(30)}" for _ in range(1000)) for _ in range(200)] + ["rare1 rare2 rare3"] * 9
    model, folder = ngram.learn(spark.createDataFrame([(t,) for t in train], "text string").repartition(3))
    got = ngram.score(spark.createDataFrame([(1, "rare1 rare2 rare3")], "doc_id long, text string"), model).first()
    plain = {("rare2",): (9 - 0.75) / 9, ("rare3",): (9 - 0.75) / 9}
    assert got["base_score"] < -12
    assert got["score"] > math.log10(9 / 209) + sum(map(math.log10, plain.values())) + math.log10(8.25 / 9) - 0.3
    drop_scratch(spark, folder)


@pytest.mark.parametrize("parts", [1, 3, 64])
def test_counting_tasks_send_blocks(monkeypatch, parts):
    # A row holds all of a part's keys, not one, and a part's rows sum up to what was counted.
    monkeypatch.setattr(ngram, "_SENT", 400)
    keys = np.random.default_rng(5).integers(0, 2 ** 62, 3000) >> np.random.default_rng(6).integers(0, 60, 3000)
    batch = pa.RecordBatch.from_arrays([pa.array([""] * 3)], ["text"])
    sent = pa.Table.from_batches([b for _ in range(2) for b in ngram._summed(lambda _: keys, parts)(iter([batch]))])
    assert len(sent) <= 2 * (parts + len(keys) // 400 + 1)
    for least in (2, 4):
        got = {}
        for part in set(sent["part"].to_pylist()):
            own = ngram._totals(least)(sent.filter(pa.compute.equal(sent["part"], part)))
            got.update(zip(own["key"].to_pylist(), own["n"].to_pylist()))
        assert got == {k: 2 * n for k, n in collections.Counter(keys.tolist()).items() if 2 * n >= least}


def test_a_search_reads_a_lone_value_once(monkeypatch):
    read = []
    low = EliasFano._low
    monkeypatch.setattr(EliasFano, "_low", lambda self, i: read.append(len(i)) or low(self, i))
    v = np.arange(500, dtype=U64) * U64(1000) + U64(70)
    ef = EliasFano(np.frombuffer(encode(v), np.uint8))
    q = np.concatenate((v, [U64(0), U64(69), U64(10 ** 9), U64(2 ** 64 - 1)]))
    at, equal = ef.successor(q)
    assert at.tolist() == [*range(500), 0, 0, 500, 500] and equal.tolist() == [True] * 500 + [False] * 4
    assert sum(read) == len(v)
