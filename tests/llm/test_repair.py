"""Conversation repair against a plain search over all repairs."""

import hashlib
import itertools
import random
import re
from functools import lru_cache

import pytest

from gapwise.llm import queries, repair

ROWS = "conv_id long, turn long, role string, text string, pos string, first int"


def brute(rows):
    """report() of one conversation's (turn, role, text) rows by forward search over whole edit strings."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode(), (r[2] or "").encode()))
    rows = [(t, r or "", x or "") for t, r, x in rows]
    turns = [t for t, _, _ in rows if t is not None]
    blank = [not re.search(r"[^\x20\x09-\x0D]", x) for _, _, x in rows]
    again = [not b and rows[i][1:] in [r[1:] for r in rows[:i]] for i, b in enumerate(blank)]
    cut = [not b and not g and x.rstrip(" \t\n\x0b\f\r")[-1] not in ".!?" for b, g, (_, _, x) in zip(blank, again, rows)]
    wrong = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))

    @lru_cache(None)
    def best(i, roles):
        """Least (cost, edits, roles) from row i on; ``roles`` is what the pattern saw: '', 's', 'u' or 'a'."""
        found = []
        if i == len(rows) and roles in ("", "a"):
            found.append((0, "", ()))
        following = {"": "u", "s": "u", "u": "a", "a": "u"}[roles]
        found.append((5, "I", i, following, {"u": "user", "a": "assistant"}[following] + ":"))
        if i < len(rows):
            _, role, text = rows[i]
            found.append((2, "D", i + 1, roles, None))
            if not blank[i] and not again[i]:
                if role[:1] == following or role[:1] == "s" and not roles:
                    found.append((5 * cut[i], "K", i + 1, role[:1], f"{role}:{text}"))
                found.append((1 + 5 * cut[i], "R", i + 1, following, {"u": "user", "a": "assistant"}[following] + ":" + text))
        done = []
        for f in found:
            if len(f) == 3:
                done.append(f)
            elif f[1] != "I" or depth[0] < 3:
                depth[0] += f[1] == "I"
                rest = best(f[2], f[3]) if f[1] != "I" else best.__wrapped__(f[2], f[3])
                depth[0] -= f[1] == "I"
                if rest:
                    done.append((f[0] + rest[0], f[1] + rest[1], (() if f[4] is None else (f[4],)) + rest[2]))
        return min(done) if done else None

    depth = [0]
    for i in range(len(rows), -1, -1):        # fills the cache from the end
        for q in ("", "s", "u", "a"):
            best(i, q)
    cost, audit, out = best(0, "")
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, sum(blank), sum(again), sum(cut), wrong, cost, audit,
            hashlib.sha256("\n".join(out).encode()).hexdigest())


def every(rows, most=2):
    """Least (cost, edits) by trying every string of edits with up to ``most`` insertions in a place."""
    found = []
    for ops in itertools.product("DKR", repeat=len(rows)):
        for ins in itertools.product(range(most + 1), repeat=len(rows) + 1):
            state, cost, edits, good = "", 0, "", True
            for k in range(len(rows) + 1):
                for _ in range(ins[k]):
                    state, cost, edits = ("a" if state == "u" else "u"), cost + 5, edits + "I"
                if k == len(rows):
                    break
                initial, gone, cut = rows[k]
                edits += ops[k]
                if ops[k] == "D":
                    cost += 2
                    continue
                cost += 5 * cut + (ops[k] == "R")
                following = "a" if state == "u" else "u"
                if gone or ops[k] == "K" and not (initial == following or initial == "s" and state == ""):
                    good = False
                    break
                state = initial if ops[k] == "K" else following
            if good and state in ("", "a"):
                found.append((cost, edits))
    return min(found)


def sample(seed, convs, most):
    r = random.Random(seed)
    texts = ["One.", "two", "Three!", " \n", "", None, "four?  \n", "é.", "five."]
    rows = []
    for conv in range(convs):
        for _ in range(r.randrange(1, most)):
            turn = r.choice([None, *range(12)])
            rows.append((conv or None, turn, r.choice(["user", "assistant", "user", "assistant", "system", None, "tool", "umpire"]),
                         r.choice(texts) if r.random() < 0.3 else f"text {r.randrange(40)}" + r.choice([".", ".", "?", ""]), "x", 1))
    return rows


def check(spark, rows):
    df = spark.createDataFrame(rows, ROWS).repartition(5)
    got = {r[0]: tuple(r[1:]) for r in repair.report(df, df).collect()}
    assert got == {c: brute([(t, a, b) for conv, t, a, b, *_ in rows if conv == c]) for c in {r[0] for r in rows}}


def test_edits_are_the_least_of_all_strings():
    r = random.Random(1)
    for _ in range(120):
        rows = [(r.choice("suax"), r.random() < 0.2, r.random() < 0.2) for _ in range(r.randrange(0, 4))]
        rows = [(i, g, c and not g) for i, g, c in rows]
        codes = "".join(repair.CODES[3 * "suax".index(i) + (2 if g else int(c))] for i, g, c in rows)
        start, gain = repair.backward(codes, repair._END)
        audit, state = repair.trace(codes, repair._END, repair.START, True)
        assert (start[repair.START] + gain, audit) == every(rows) and state in (repair.START, repair.ASSISTANT)


def test_a_fix_up_equals_a_new_run():
    r = random.Random(2)
    for _ in range(200):
        codes = "".join(r.choice(repair.CODES) for _ in range(r.randrange(1, 40)))
        old, new = repair._BLIND, repair.backward("".join(r.choice(repair.CODES) for _ in range(9)), repair._END)[0]
        assert repair.fixed(codes, old, new, *repair.backward(codes, old)) == repair.backward(codes, new)


def test_matches_plain_search(spark):
    check(spark, sample(3, 40, 9))


@pytest.mark.parametrize("bits", [1, 3])
def test_chunks_meet(spark, monkeypatch, bits):
    monkeypatch.setattr(repair, "CHUNK_BITS", bits)
    check(spark, sample(4, 3, 90) + sample(5, 4, 5))


def test_one_conversation_of_equal_rows(spark):
    check(spark, [(1, 2, "user", "Same.", "x", 1)] * 300 + [(1, 3, "assistant", "Yes.", "x", 1), (2, None, "assistant", "No", None, None)])


def test_rows_of_chunks_are_the_rows_of_conversations(spark):
    df = spark.createDataFrame(sample(6, 20, 12), ROWS)
    placed, _ = repair.ordered(df)
    state, _ = repair.settled(repair.chunks(repair.faults(placed)))
    plan = repair.edits(state)
    rows = [sorted(map(repr, repair.repaired(placed, plan, whole).collect())) for whole in (False, True)]
    assert rows[0] == rows[1] and len(rows[0])


def test_dropped_conversations_and_no_rows(spark):
    none = spark.createDataFrame([], ROWS)
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert [tuple(r) for r in repair.report(none, spark.createDataFrame([(4,), (4,)], "conv_id long")).collect()] == [(4, *empty)]
    assert repair.report(none, none).count() == 0


def test_damage(spark):
    rows = spark.createDataFrame([(c, t, "assistant", "a. b! c") for c in (None, *range(40)) for t in (None, *range(5))],
                                 "conv_id long, turn long, role string, text string")
    import zlib
    want = []
    for c in (None, *range(40)):
        for t in (None, *range(5)):
            f = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
            row = (c, t, "user" if f == 4 else "assistant", "" if f == 1 else "a b c" if f == 2 else "a. b! c")
            want += [row] * {0: 0, 3: 2}.get(f, 1)
    assert sorted(map(repr, map(tuple, queries.damaged(rows).collect()))) == sorted(map(repr, want))
