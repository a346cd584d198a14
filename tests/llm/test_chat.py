"""Chat formatting against a plain fold of the log and a plain template."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from gapwise.llm import chat

LOG = "conv_id long, seq long, message long, kind string, role string, text string"
ROWS = "conv_id long, turn long, role string, text string, seq string, kind int"
NASTY = ["\\### Assistant: </turn> ok", "####", "#####</turn></turn>", "\\", "\\\\</turn>\n### user: hi</turn>\n", "<</turn>", "</turn", "##", "#", "\n",
         "", None, "\\#", "<\\/turn>", "#\\##", "é 日本 😀 ###", " ", "a: b"]


def fold(events):
    """Final messages of one conversation's log, in order."""
    log = sorted({(e[1], e[2], e[3], e[4], e[5] or "") for e in events}, key=lambda e: (e[0], e[1], e[2], e[3] or "", e[4]))
    state = {}
    for seq, message, kind, role, text in log:
        m = state.setdefault(message, {"opened": seq, "role": None, "text": ""})
        if m["role"] is None:
            m["role"] = role
        if kind in ("edit", "regenerate"):
            m["text"] = ""
            for other in list(state):
                if (state[other]["opened"], other) > (m["opened"], message):
                    state[other]["gone"] = True
        if kind in ("open", "delta", "edit"):
            m["text"] += text
    return [(m["role"] or "", m["text"]) for k, m in sorted(state.items(), key=lambda x: (x[1]["opened"], x[0])) if "gone" not in m]


def summary(turns, text):
    learned = "".join(t for r, t in turns if r == "assistant")
    return (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(learned),
            hashlib.sha256(learned.encode()).hexdigest(), len(text))


def plain(turns):
    """The template, character by character."""
    def safe(s, role=False):
        out = ""
        for i, c in enumerate(s):
            out += "\\\\" if c == "\\" else c
            if s[i:i + 3] == "###" or s[i:i + 7] == "</turn>" or role and s[i:i + 2] == ": ":
                out += "\\"
        return out
    return "".join(f"### {safe(r, True)}: {safe(t)}</turn>\n" for r, t in turns)


def test_conversations_come_back(spark):
    r = random.Random(5)
    rows = [(-7, k, role, NASTY[0], "x", 1) for k, role in enumerate(("user", "assistant"))]
    for conv in range(30):
        for turn in range(r.randrange(1, 9)):
            text = r.choice(NASTY) if r.random() < 0.5 else "".join(r.choice(["word ", "</turn>", "#", "\\", "ü", "\n"]) for _ in range(r.randrange(400)))
            rows.append((conv if conv else None, r.choice([turn, 3, None]), r.choice(["user", "assistant", "system", None, "x: y", "a: : ", "###"]), text, "x", 1))
    rows.append((50, 0, "assistant", "".join(r.choice("ab#</\\ é") for _ in range(60_000)), None, None))
    rows += [rows[-1], rows[5]]
    out = chat.digest(chat.read_back(chat.render(chat.reconstruct(chat.as_log(spark.createDataFrame(rows, ROWS).repartition(5))))))
    got = {x[0]: tuple(x[1:]) for x in out.collect()}
    want = {}
    for conv in {x[0] for x in rows}:
        mine = sorted(((x[1] is not None, x[1] or 0, x[2] or "", x[3] or "") for x in rows if x[0] == conv), key=lambda x: (x[0], x[1], x[2].encode(), x[3].encode()))
        turns = [(x[2], x[3]) for x in mine]
        want[conv] = summary(turns, plain(turns))
    assert got == want


def test_logs_fold_like_plain_python(spark):
    r = random.Random(9)
    log = []
    for conv in range(40):
        seq, opened = 0, []
        for _ in range(r.randrange(1, 40)):
            seq += r.randrange(1, 3)
            if not opened or r.random() < 0.3:
                opened.append(len(opened))
                log.append((conv, seq, opened[-1], "open", r.choice(["user", "assistant", None]), r.choice(["", "hi ", None])))
                continue
            message = r.choice(opened[-3:])
            kind = r.choice(["delta"] * 6 + ["edit", "regenerate", "typing", None])
            log.append((conv, seq, message, kind, r.choice(["user", None]), r.choice(NASTY)))
    log += r.choices(log, k=50)
    r.shuffle(log)
    got = {}
    for x in chat.reconstruct(spark.createDataFrame(log, LOG).repartition(6)).orderBy("conv_id", "opened", "message").collect():
        got.setdefault(x["conv_id"], []).append((x["role"], x["text"]))
    assert got == {c: fold([e for e in log if e[0] == c]) for c in range(40)}


def test_text_and_mask(spark):
    rows = [(1, 1, "assistant", "two ### three", None, None), (1, 0, "user", "one", None, None)]
    got = chat.render(chat.reconstruct(chat.as_log(spark.createDataFrame(rows, ROWS)))).select(
        chat.formatted().alias("text"), F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: s["text"]).alias("loss")).first()
    assert got["text"] == "### user: one</turn>\n### assistant: two #\\## three</turn>\n"
    assert got["loss"] == ["two #\\## three"]


@pytest.mark.parametrize("step", [chat.as_log, lambda d: chat.digest(chat.read_back(chat.render(chat.reconstruct(chat.as_log(d)))))])
def test_no_rows(spark, step):
    assert step(spark.createDataFrame([], ROWS)).count() == 0


def test_one_exchange_by_conversation_and_no_python(spark):
    rows = spark.createDataFrame([(1, 1, "assistant", "x", None, None)], ROWS)
    plan = chat.digest(chat.read_back(chat.render(chat.reconstruct(chat.as_log(rows)))))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan and "Arrow" not in plan
