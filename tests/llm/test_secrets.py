"""Secret scan: base patterns as given, guess costs by exhaustive segmentation."""

import hashlib
import math
import re
from functools import cache

from hypothesis import given, settings
from hypothesis import strategies as st

from gapwise.llm import secrets

RANK = {w: math.log2(i + 2) for i, w in enumerate(["the", "password", "monkey", "dragon", "love", "pass"])}


def plain_base(text):
    out = []
    for m in re.finditer(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
                         r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 8:
            out.append(("assign", *m.span()))
    for kind, pattern, least in (("access", "AKIA[A-Z0-9]+", 16), ("hex", "[0-9a-f]+", 32)):
        out += [(kind, *m.span()) for m in re.finditer(pattern, text) if m.end() - m.start() >= least]
    return sorted(out, key=lambda s: (s[1], secrets.KINDS.index(s[0])))


PIECE = st.sampled_from(["password", "PASSWD", "secret", "token", "api_key", "apikey", "API_KEY", "=", ":", " ", '"', "'", "abc", "abcdef12",
                         "AKIA", "AKIA1234567890AB", "0123456789abcdef", "deadbeef" * 4, "é", "ſecret", "toKen", "\n", "x.y-z/=+", "_"])


@settings(max_examples=400, deadline=None)
@given(st.lists(PIECE, max_size=9).map("".join))
def test_base_spans_match_the_patterns(text):
    assert [s for s in secrets.find(text, RANK) if s[0] != "guess"] == plain_base(text)


def test_added_spans():
    text = 'pwd is "kX9#mQ2$vT7!" and pass: monkey1 then token = "abcdefgh1234"; Authorization: Bearer eyJhbGciOi.x9Z_q-81'
    spans = secrets.find(text, RANK)
    assert [(k, text[a:b]) for k, a, b in spans if k == "guess"] == [("guess", "kX9#mQ2$vT7!"), ("guess", "eyJhbGciOi.x9Z_q-81")]
    assert secrets.find("", RANK) == [] and secrets.find("the quick brown fox", RANK) == []


def test_cost_prefers_cheap_explanations():
    bits = lambda v: secrets.guess_bits(v, RANK)
    assert bits("monkeydragon") < 16 < bits("mxqkwyzagvnp")
    assert bits("aaaaaaaaaaaa") < 12 and bits("qwertyuiop") < 16 and bits("1998-07-14") < 22 and bits("123456789") < 14
    assert bits("Monkey") > bits("monkey")
    assert bits("monkey1998") < bits("mqnkzy1398")


def exhaustive(value, words):
    """Cheapest segmentation by trying every span of every kind."""
    low = value.lower()
    upper = value != low
    kind = math.log2(3)

    def span(i, j):
        s, best = low[i:j], kind + sum(secrets._char_bits(c) + (upper and c != d) for c, d in zip(value[i:j], low[i:j]))
        if s in words:
            best = min(best, kind + words[s] + (0 if value[i:j] == s else 1 + (0 if value[i + 1:j] == s[1:] else j - i - 1)))
        if j - i >= 3 and len(set(s)) == 1:
            c = secrets._char_bits(value[j - 1]) + (upper and value[j - 1] != low[j - 1])
            best = min(best, kind + c + math.log2(j - i))
        if j - i >= 3 and all(a + b in secrets._NEXT for a, b in zip(s, s[1:])):
            best = min(best, kind + math.log2(94) + math.log2(j - i))
        if secrets._DATE.fullmatch(value[i:j]):
            best = min(best, kind + (math.log2(130) if j - i == 4 else math.log2(130 * 366 * 4)))
        return best

    @cache
    def rest(i):
        return 0 if i == len(value) else min(span(i, j) + rest(j) for j in range(i + 1, len(value) + 1))
    return rest(0)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["the", "Love", "monkey", "aaa", "qwe", "1999", "19990214", "x", "7", "#", "Z", "é"]), max_size=4).map("".join))
def test_cost_is_not_above_and_close_to_the_exhaustive_minimum(value):
    best = exhaustive(value, RANK)
    got = secrets.guess_bits(value, RANK)
    assert best - 1e-9 <= got <= best + 8


def test_query_rows(spark, tmp_path):
    from gapwise.llm.queries import op4_secrets

    rows = [(1, 'token = "abcdefgh1234" x', "en"), (2, None, None), (3, "", "en"), (3, "", "en"), (None, "AKIA1234567890ABCD", "x")]
    spark.createDataFrame(rows, "doc_id long, text string, spans string").write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((tuple(r) for r in op4_secrets(spark, str(tmp_path)).collect()), key=str)
    empty = hashlib.sha256(b"").hexdigest()
    assert got == sorted([
        (1, 1, 0, 0, hashlib.sha256(b"assign:0:21").hexdigest(), "assign:0:21"), (2, 0, 0, 0, empty, ""), (3, 0, 0, 0, empty, ""),
        (3, 0, 0, 0, empty, ""), (None, 0, 1, 0, hashlib.sha256(b"access:0:18").hexdigest(), "access:0:18")], key=str)
