"""Secrets in text: fixed patterns, and guess-cost scoring of values in a credential context.

The cost of a value is that of its cheapest segmentation, found by dynamic
programming: words (priced by their rank among the corpus words), dates,
repeats, keyboard walks and brute-force spans. A value that would take too many
guesses for a placeholder is reported.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapwise.runtime import drop_scratch, materialize

LEAST_SHARE = 1 / 200_000  # of all words; at most 200,000 words can have it, they are the dictionary
MIN_BITS = 32.0            # log2 of the guesses from which a value is a secret
KINDS = ("assign", "access", "hex", "guess")

# The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")         # the runs of 32 and more among [0-9a-f]+

# Names that announce a credential, and how a value follows.
CONTEXT = re.compile(
    r"""(?<![A-Za-z0-9])(?:password|passwd|passphrase|passcode|pwd|pass|secret|token|credentials?|authorization|auth|bearer"""
    r"""|api[ _-]?key|access[ _-]?key|private[ _-]?key|client[ _-]?secret)(?:["']?[ \t]*(?:=>|:=|[:=])[ \t]*|[ \t]+is[ \t:]+)"""
    r"""(?:bearer[ \t]+|basic[ \t]+)?["'`]?([^\s"'`<>,;]{6,})""", re.I | re.A)
_HINTS = ("pass", "pwd", "secret", "token", "credential", "auth", "bearer", "key")
_KEYWORDS = ("password", "passwd", "secret", "token", "api")
_DATE = re.compile(r"(?:(?:19|20)[0-9]{2}([-./_]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12][0-9]|3[01])"
                   r"|(?:0[1-9]|[12][0-9]|3[01])([-./_]?)(?:0[1-9]|1[0-2])\2(?:19|20)[0-9]{2}|(?:19|20)[0-9]{2})")
_ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "abcdefghijklmnopqrstuvwxyz")
_NEXT = {a + b for row in _ROWS for a, b in zip(row, row[1:])} | {b + a for row in _ROWS for a, b in zip(row, row[1:])}
_LONGEST_WORD = 20


def _char_bits(c: str) -> float:
    if c.isdigit():
        return math.log2(10)
    if c.isascii() and c.isalpha():
        return math.log2(26)
    return math.log2(33) if c.isascii() else 10.0


def guess_bits(value: str, words: dict[str, float]) -> float:
    """log2 of the guesses of the cheapest segmentation; ``words`` gives each dictionary word's bits."""
    n, low = len(value), value.lower()
    if len(low) != n:
        low = value
    cost = [0.0] + [math.inf] * n
    brute = 0.0
    upper = 1.0 if value != low else 0.0
    repeat_from = walk_from = 0
    start_cost = math.log2(3)                        # each segment says which kind it is
    brute_best = math.inf                            # cheapest way that ends inside a brute-force span
    for j in range(1, n + 1):
        c = _char_bits(value[j - 1]) + (upper if value[j - 1] != low[j - 1] else 0.0)
        brute_best = min(brute_best, cost[j - 1] + start_cost) + c
        best = brute_best
        if j > 1:
            if low[j - 1] != low[j - 2]:
                repeat_from = j - 1
            if low[j - 2:j] not in _NEXT:
                walk_from = j - 1
        if j - repeat_from >= 3:
            best = min(best, cost[repeat_from] + start_cost + c + math.log2(j - repeat_from))
        if j - walk_from >= 3:
            best = min(best, cost[walk_from] + start_cost + math.log2(47 * 2) + math.log2(j - walk_from))
        for i in range(max(0, j - _LONGEST_WORD), j - 2):
            bits = words.get(low[i:j])
            if bits is not None:
                case = 0.0 if value[i:j] == low[i:j] else 1.0 + (0 if value[i + 1:j] == low[i + 1:j] else j - i - 1)
                best = min(best, cost[i] + start_cost + bits + case)
        for size in (4, 8, 10):
            if j >= size and _DATE.fullmatch(value, j - size, j):
                best = min(best, cost[j - size] + start_cost + (math.log2(130) if size == 4 else math.log2(130 * 366 * 4)))
        cost[j] = best
    return cost[n]


def find(text: str, words: dict[str, float], min_bits: float = MIN_BITS) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind; base matches first, method spans never replace one."""
    found, low = [], text.lower()
    if any(k in low for k in _KEYWORDS):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    base = list(found)
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    if any(h in low for h in _HINTS):
        for m in CONTEXT.finditer(text):
            a, b = m.span(1)
            covered = any(x <= a and b <= y for _, x, y in base)
            if not covered and guess_bits(m[1], words) >= min_bits:
                found.append(("guess", a, b))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def _scan(words: dict[str, float], min_bits: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for x in batch.column(1):
                spans = find(x.as_py() or "", words, min_bits)
                rows.append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], names=["doc_id", "spans"])
    return run


def dictionary(docs: DataFrame, text_col: str = "text", least_share: float = LEAST_SHARE) -> dict[str, float]:
    """log2 rank of the frequent lower-case words of the corpus (runs of letters a-z, 3 to 20 of them).

    A word is frequent if it makes up ``least_share`` of all of them, so the
    number of words that reach the driver has a bound whatever the corpus.
    """
    counts = (docs.select(F.explode(F.split(F.lower(text_col), "[^a-z]+")).alias("word")).where("length(word) between 3 and 20")
              .groupBy("word").agg(F.count("*").alias("n")))
    counts, at = materialize(counts, "secret-words")
    total = counts.agg(F.sum("n")).first()[0] or 0
    top = sorted(((-r["n"], r["word"]) for r in counts.where(F.col("n") >= least_share * total).collect()))
    drop_scratch(docs.sparkSession, at)
    return {word: math.log2(i + 2) for i, (_, word) in enumerate(top)}


def scan(docs: DataFrame, words: dict[str, float], id_col: str = "doc_id", text_col: str = "text",
         min_bits: float = MIN_BITS) -> DataFrame:
    """Per input row: doc_id, spans (array of kind, start, end in code points, end exclusive).

    Kinds assign, access and hex are the fixed patterns, guess the values whose
    guess cost reaches ``min_bits`` in a credential context; a value inside an
    assign or access span is not repeated. Null and empty texts have no spans.
    Rows are kept as they are, repeated and null ids included; other columns
    are ignored.
    """
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        _scan(words, min_bits), "doc_id long, spans array<struct<kind:string,start:long,end:long>>")

