"""Personal data: base patterns as given, joint decoding against exhaustive search."""

import re
from itertools import product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF_ORACLE, SF_SMALL
from gapwise.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_base(text):
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        d = [int(c) for c in m[0] if c in "0123456789"]
        total = sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(reversed(d)))
        if 14 <= len(d) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 10 <= sum(c in "0123456789" for c in m[0]) <= 15]
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


PIECE = st.sampled_from(["a", "b.c", "@", "@x.y", ".", "-", "_", " ", "  ", "+", "+1", "(", ")", "0", "255", "256", "007", "1.2.3.4", "٣", "é",
                         "4111111111111111", "4111 1111 1111 1111", "5500-0000-0000-0004", "12345678901234", "+1 (555) 010-0199", "\n", "%"])


@settings(max_examples=600, deadline=None)
@given(st.lists(PIECE, max_size=10).map("".join))
def test_base_spans_match_the_patterns(text):
    assert pii.base_spans(text) == plain_base(text)


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "a" * 100_000 + "@", "1." * 100_000, "1 " * 100_000, "+1" * 100_000):
        pii.find(text, {k: {} for k in pii.KINDS})


WEIGHTS = {"email": {"ats=1": 6.0, "bias": -3.0}, "ip": {"dots=3": 5.0, "bias": -4.0}, "card": {"digits=16": 6.0, "bias": -3.5},
           "phone": {"plus=True:True": 5.0, "digits=11": 2.0, "bias": -4.0}}


@pytest.mark.parametrize("text", ["x1@y.z 1.2.3.4", "+1 (555) 010 4444 10.0.0.1", "4111 1111 1111 1111 9", "7", "a@b"])
def test_decoding_is_the_best_joint_choice(text):
    for start, end in pii.stretches(text):
        tokens, cands = pii.candidates(text, start, end)
        scored = [(i, j, max(pii._score(WEIGHTS, k, f) for k in pii.KINDS)) for i, j, f in cands]
        scored = [s for s in scored if s[2] > 0]
        best = 0.0
        for chosen in product([0, 1], repeat=min(len(scored), 14)):
            own = sorted(s for s, c in zip(scored, chosen) if c)
            if all(a[1] <= b[0] for a, b in zip(own, own[1:])):
                best = max(best, sum(s[2] for s in own))
        if len(scored) <= 14:
            assert sum(s for *_, s in pii.decode(text, start, end, WEIGHTS)) == pytest.approx(best)


def test_training_finds_the_patterns_spans(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    w = pii.learn(docs)
    hit = total = 0
    for r in docs.where("text rlike '[0-9@]'").collect():
        base = {(a, b) for _, a, b in pii.base_spans(r["text"])}
        own = {(a, b) for x, y in pii.stretches(r["text"]) for _, a, b, _ in pii.decode(r["text"], x, y, w)}
        hit, total = hit + len(base & own), total + len(base)
        assert {s[:3] for s in pii.find(r["text"], w) if s[3]} == set(pii.base_spans(r["text"]))
    assert total > 20 and hit >= 0.9 * total


def test_mask_and_edges(spark):
    none = {k: {} for k in pii.KINDS}
    assert pii.mask("mail a@b.cd now, 1.2.3.4!", none) == "mail [EMAIL] now, [IP]!"
    assert pii.mask("call +1 555 010 0199, 4111111111111111", none) == "call [PHONE], [CARD]" and pii.mask("", none) == ""
    docs = spark.createDataFrame([(1, "x a@b.cd", "en", "s", 8), (1, "x a@b.cd", "en", "s", 8), (2, None, None, None, None), (3, "", "", "", 0),
                                  (None, "clean", "en", "s", 99)], "doc_id long, text string, lang string, source string, n_chars long")
    got = pii.masked(docs, pii.learn(docs))
    assert got.columns == docs.columns
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(
        [(1, "x [EMAIL]", "en", "s", 9)] * 2 + [(2, None, None, None, None), (3, "", "", "", 0), (None, "clean", "en", "s", 99)], key=str)
    assert pii.scan(docs.limit(0), pii.learn(docs.limit(0))).count() == 0
    clean = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("not text rlike '[0-9@]'")
    assert pii.masked(clean, none).exceptAll(clean).count() == 0
