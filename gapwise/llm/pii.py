"""Personal data in text: fixed patterns plus a semi-Markov conditional random field.

The field scores whole candidate spans (digit counts and groups, separators,
checksum, neighbours) and chooses boundaries and types of all spans of a
stretch of text jointly, by dynamic programming over entities of bounded
length. Its weights maximise the likelihood of the fixed patterns' spans on a
bounded sample of stretches, so that it also finds spans which the patterns cut
differently.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapwise.llm.words import slices

KINDS = ("email", "ip", "card", "phone")
SAMPLE = 800               # stretches of text that the weights are fitted on
SAMPLE_CHARS = 300         # longer stretches are not used for fitting
EPOCHS = 6
MAX_TOKENS = 24            # of one entity
MARGIN = 2.0               # log-odds over leaving a span out that an added span needs

# The base patterns. Lookbehinds and possessive runs only save attempts that cannot match.
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_ANCHOR = re.compile(r"[0-9@]")
_CHUNK = re.compile(r"\S+")
_TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|\s|.", re.S)
_NOT_DIGIT = re.compile(r"[^0-9]")
_CUES = {"phone", "tel", "telephone", "mobile", "fax", "call", "email", "mail", "ip", "address", "host", "card", "visa",
         "mastercard", "iban", "ssn"}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns, by start, then kind."""
    found = []
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            found.append(("email", start, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    if _ANCHOR.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                found.append(("ip", m.start(), m.end()))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = _NOT_DIGIT.sub("", m[0])
                if 14 <= len(digits) <= 19 and luhn(digits):
                    found.append(("card", m.start(), m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                    found.append(("phone", m.start(), m.end()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def stretches(text: str) -> Iterator[tuple[int, int]]:
    """Runs of chunks that hold a digit or an at sign, a single white space apart."""
    if not _ANCHOR.search(text):
        return
    start = end = None
    for m in _CHUNK.finditer(text):
        if not _ANCHOR.search(text, m.start(), m.end()):
            continue
        if start is not None and m.start() == end + 1:
            end = m.end()
            continue
        if start is not None:
            yield start, end
        start, end = m.span()
    if start is not None:
        yield start, end


def _bucket(n: int) -> str:
    for most in (0, 3, 6, 9, 11, 13, 15, 16, 19):
        if n <= most:
            return str(most)
    return "more"


def features(span: str, before: str, after: str, cue: str) -> list[str]:
    """Features of a whole span and its two neighbouring characters."""
    digits = _NOT_DIGIT.sub("", span)
    groups = re.findall("[0-9]+", span)
    letters = any(map(str.isalpha, span))
    dots, ats = span.count("."), span.count("@")
    out = [f"digits={_bucket(len(digits))}", f"groups={min(len(groups), 6)}", f"letters={letters}", f"dots={min(dots, 5)}",
           f"ats={min(ats, 2)}", f"first={span[0] if not span[0].isalnum() else 'x'}", f"plus={span[0] == '+'}:{len(groups) > 1}",
           "seps=" + "".join(sorted({c for c in span if not c.isalnum()}))[:6],
           f"before={'s' if not before or before.isspace() else 'd' if before.isdigit() else 'a' if before.isalpha() else before}",
           f"after={'s' if not after or after.isspace() else 'd' if after.isdigit() else 'a' if after.isalpha() else after}"]
    if ats == 1:
        name, _, host = span.partition("@")
        out.append(f"mail={bool(name) and '.' in host.strip('.')}:{' ' in span}")
    if not letters and not ats and len(groups) == 4 and dots == 3 and len(span) == len(digits) + 3:
        out.append(f"quad={all(len(g) <= 3 and int(g) <= 255 for g in groups)}")
    if not letters and 12 <= len(digits) <= 19:
        out.append(f"sum={luhn(digits)}:{span[0].isdigit()}:{set(span) <= set('0123456789 -')}")
    if cue:
        out.append(f"cue={cue}")
    return out


def candidates(text: str, start: int, end: int):
    """Token bounds of a stretch, and (i, j, features) of every possible entity over tokens i to j."""
    tokens = [m.span() for m in _TOKEN.finditer(text, start, end)]
    words = re.findall(r"[^\W\d_]+", text[max(0, start - 24):start])
    cue = words[-1].lower() if words and words[-1].lower() in _CUES else ""
    out = []
    opens = [text[a].isalnum() or text[a] in "+(" for a, _ in tokens]
    closes = [text[b - 1].isalnum() for _, b in tokens]
    anchor = [text[a].isdigit() or text[a] == "@" for a, _ in tokens]
    for i, (a, _) in enumerate(tokens):
        if not opens[i]:
            continue
        weight = 0
        for j in range(i, min(len(tokens), i + MAX_TOKENS)):
            b = tokens[j][1]
            weight += (b - tokens[j][0]) if anchor[j] else 0
            if closes[j] and (weight >= 4 or "@" in text[a:b]):
                out.append((i, j + 1, features(text[a:b], text[a - 1:a], text[b:b + 1], cue)))
    return tokens, out


Weights = dict[str, dict[str, float]]


def _score(w: Weights, kind: str, feats: list[str]) -> float:
    own = w[kind]
    return sum(own.get(f, 0.0) for f in feats) + own.get("bias", -4.0)


def decode(text: str, start: int, end: int, w: Weights) -> list[tuple[str, int, int, float]]:
    """Best joint choice of non-overlapping entities of a stretch, each with its score; outside tokens score 0."""
    tokens, cands = candidates(text, start, end)
    ending = defaultdict(list)
    for i, j, feats in cands:
        for kind in KINDS:
            s = _score(w, kind, feats)
            if s > 0:
                ending[j].append((i, kind, s))
    best, back = [0.0], [None]
    for j in range(1, len(tokens) + 1):
        top, how = best[j - 1], None
        for i, kind, s in ending[j]:
            if best[i] + s > top:
                top, how = best[i] + s, (i, kind, s)
        best.append(top)
        back.append(how)
    out, j = [], len(tokens)
    while j:
        if back[j] is None:
            j -= 1
        else:
            i, kind, s = back[j]
            out.append((kind, tokens[i][0], tokens[j - 1][1], s))
            j = i
    return out[::-1]


def _logadd(a: float, b: float) -> float:
    if a < b:
        a, b = b, a
    return a + math.log1p(math.exp(b - a)) if b > -math.inf else a


def fit(sample: list[tuple[str, int, int, list[tuple[str, int, int]]]], epochs: int = EPOCHS) -> Weights:
    """Weights that raise the likelihood of the given spans, by AdaGrad over the stretches.

    ``sample`` holds (text, start, end, spans). Without any span the weights
    choose nothing.
    """
    w: Weights = {k: defaultdict(float, bias=-4.0) for k in KINDS}
    power: Weights = {k: defaultdict(float) for k in KINDS}
    prepared = []
    for text, start, end, spans in sample:
        tokens, cands = candidates(text, start, end)
        starts, ends = {a: i for i, (a, _) in enumerate(tokens)}, {b: i + 1 for i, (_, b) in enumerate(tokens)}
        gold = {(starts.get(a), ends.get(b), k) for k, a, b in spans}
        prepared.append((len(tokens), cands, gold))
    for _ in range(epochs):
        for n, cands, gold in prepared:
            segs = [(i, j, k, _score(w, k, f), f) for i, j, f in cands for k in KINDS]
            into, out = defaultdict(list), defaultdict(list)
            for s in segs:
                into[s[1]].append(s)
                out[s[0]].append(s)
            ahead, behind = [0.0], [0.0] * (n + 1)
            for j in range(1, n + 1):
                total = ahead[j - 1]
                for i, _, _, s, _ in into[j]:
                    total = _logadd(total, ahead[i] + s)
                ahead.append(total)
            for i in range(n - 1, -1, -1):
                total = behind[i + 1]
                for _, j, _, s, _ in out[i]:
                    total = _logadd(total, behind[j] + s)
                behind[i] = total
            for i, j, k, s, feats in segs:
                g = ((i, j, k) in gold) - math.exp(min(0.0, ahead[i] + s + behind[j] - ahead[n]))
                if abs(g) > 1e-3:
                    for f in (*feats, "bias"):
                        power[k][f] += g * g
                        w[k][f] += 0.5 * g / math.sqrt(power[k][f] + 1e-6)
    return {k: dict(v) for k, v in w.items()}


def _draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Short stretches with their context and the base spans inside."""
    for batch in batches:
        rows = []
        for x in batch.column(0):
            text = x.as_py() or ""
            base = None
            for start, end in stretches(text):
                if end - start > SAMPLE_CHARS:
                    continue
                base = base_spans(text) if base is None else base
                lo, hi = max(0, start - 24), min(len(text), end + 1)
                own = [s for s in base if start <= s[1] and s[2] <= end]
                rows.append((text[lo:hi], start - lo, end - lo, [f"{k}:{a - lo}:{b - lo}" for k, a, b in own]))
        cols = list(zip(*rows)) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()),
                                          pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.list_(pa.string()))],
                                         names=["text", "start", "end", "spans"])


def learn(docs: DataFrame, text_col: str = "text") -> Weights:
    """Fit the field on at most SAMPLE distinct stretches, drawn by hash, labelled by the base patterns.

    Stretches are cut from about 4 * SAMPLE of the texts with a digit or an at
    sign, drawn by a hash of the text; copies of a text give theirs once.
    """
    texts = docs.select(F.col(text_col).alias("text")).where(F.col("text").rlike("[0-9@]"))
    share = 4 * SAMPLE / max(texts.count(), 1)
    buckets = 1 << 30
    drawn = (texts.where(F.pmod(F.xxhash64("text"), F.lit(buckets)) < min(buckets, int(buckets * share) + 1))
             .dropDuplicates(["text"]).mapInArrow(_draw, "text string, start long, end long, spans array<string>"))
    rows = (drawn.withColumn("h", F.xxhash64("text", "start")).dropDuplicates(["text", "start"])
            .orderBy("h", "text", "start", "end").limit(SAMPLE).collect())
    sample = []
    for r in rows:
        spans = [s.split(":") for s in r["spans"]]
        sample.append((r["text"], r["start"], r["end"], [(k, int(a), int(b)) for k, a, b in spans]))
    return fit(sample)


def find(text: str, w: Weights) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, base) by start, then kind; added spans never touch a base span."""
    base = base_spans(text)
    out = [(*s, True) for s in base]
    k = 0
    for start, end in stretches(text):
        for kind, a, b, s in decode(text, start, end, w):
            if s < MARGIN:
                continue
            while k < len(base) and base[k][2] <= a:
                k += 1
            if not any(x < b and a < y for _, x, y in base[max(0, k - 4):k + 8]):
                out.append((kind, a, b, False))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))


def _scan(w: Weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1):
                rows = [[{"kind": k, "start": a, "end": b, "base": base} for k, a, b, base in find(x.as_py() or "", w)]
                        for x in batch.column(1)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, _SPANS)], names=["doc_id", "spans"])
    return run


def scan(docs: DataFrame, weights: Weights, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row: doc_id, spans (array of kind, start, end, base; code points, end exclusive).

    base marks the fixed patterns' spans, the others are the field's; those
    overlap no base span. Null and empty texts have no spans. Rows are kept as
    they are, repeated and null ids included; other columns are ignored.
    """
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        _scan(weights), "doc_id long, spans array<struct<kind:string,start:long,end:long,base:boolean>>")


def mask(text: str, w: Weights) -> str:
    """The text with each span (or run of overlapping spans) replaced by its kind in brackets."""
    out, at, label, stop = [], 0, None, 0
    for kind, a, b, _ in find(text, w):
        if label is not None and a < stop:
            stop = max(stop, b)
            continue
        if label is not None:
            out.append(f"[{label.upper()}]")
            at = stop
        out.append(text[at:a])
        label, stop = kind, b
    if label is not None:
        out.append(f"[{label.upper()}]")
        at = stop
    return "".join(out) + text[at:]


def masked(docs: DataFrame, weights: Weights, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """The rows of ``docs`` with every span in the text replaced by its kind, as in ``[EMAIL]``.

    ``length_col``, if the table has it, follows a changed text's length. Null
    texts, clean texts and all other columns stay as they are.
    """
    at = docs.columns.index(text_col)
    size_at = docs.columns.index(length_col) if length_col in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, at):
                old = batch.column(at).to_pylist()
                new = [x and mask(x, weights) for x in old]
                cols = list(batch.columns)
                cols[at] = pa.array(new, cols[at].type)
                if size_at is not None:
                    sizes = cols[size_at].to_pylist()
                    cols[size_at] = pa.array([len(b) if a != b else n for a, b, n in zip(old, new, sizes)], cols[size_at].type)
                yield pa.RecordBatch.from_arrays(cols, schema=batch.schema)
    return docs.mapInArrow(run, docs.schema)
