"""Cheapest repairs of damaged conversations, by a Viterbi search that runs in chunks side by side.

The role initials of a repaired conversation are ``(s?(ua)+)?``. Rows are kept, given
another role or deleted, empty turns are inserted; each edit has a cost. Backward costs
over the four states of that pattern settle the cheapest edits. Rows get a position in
one global order, and every 4,096 positions are a chunk, so that a long conversation is
many chunks. A chunk starts from a speculative cost vector at its end; fix-up passes run
it again from its successor's vector, backward until the new vector differs from the
old one by a constant only, and repeat until no chunk's end changes. Then chunks name
the state that each entry state leads to, these maps are strung together, and each chunk
traces its edits forward along the stitched costs, the ASCII-least of equal ones.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gapwise.runtime import drop_scratch, materialize

CHUNK_BITS = 12
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
BLANKS = " \t\n\x0b\f\r"
START, SYSTEM, USER, ASSISTANT = range(4)     # what was emitted last
_AFTER = (USER, USER, ASSISTANT, USER)        # state after one more user or assistant
_KEPT = {(START, 0): SYSTEM, (START, 1): USER, (SYSTEM, 1): USER, (ASSISTANT, 1): USER, (USER, 2): ASSISTANT}
_END = (0, 2 * INSERT, INSERT, 0)             # to an accepting state
_BLIND = (0, 0, 0, 0)
#: A row's code: three letters for each initial (s, u, a, other), for a sound, a truncated and a row that must go.
CODES = "abcdefghijkl"
_LEGAL = {(0, 1), (1, 2), (2, 1)}


# --------------------------------------------------------------------------- costs of one conversation or chunk

@cache
def _options(code: str, after: tuple[int, ...]) -> tuple[tuple[int, ...], tuple]:
    """Costs before a row, by state, and per state the edits (letter, cost, next state) that end with the row."""
    kind, fault = divmod(CODES.index(code), 3)
    edits = []
    for q in range(4):
        own = [("D", DELETE + after[q], q)]
        if fault < 2:
            extra = TRUNCATED * fault
            if (q, kind) in _KEPT:
                own.append(("K", KEEP + extra + after[_KEPT[q, kind]], _KEPT[q, kind]))
            own.append(("R", REROLE + extra + after[_AFTER[q]], _AFTER[q]))
        edits.append(own)
    cost = [min(c for _, c, _ in own) for own in edits]
    for _ in range(3):
        cost = [min(c, INSERT + cost[_AFTER[q]]) for q, c in enumerate(cost)]
    return tuple(cost), tuple(edits)


@cache
def _step(code: str, after: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    """The cost vector before a row, its least entry taken off, and that entry."""
    cost, _ = _options(code, after)
    least = min(cost)
    return tuple(c - least for c in cost), least


@cache
def _choice(code: str, after: tuple[int, ...], state: int) -> tuple[str, int]:
    """The ASCII-least cheapest edits up to and with this row, and the state behind it."""
    cost, edits = _options(code, after)
    letters = ""
    while True:
        best = [(letter, to) for letter, c, to in edits[state] if c == cost[state]]
        if INSERT + cost[_AFTER[state]] == cost[state]:
            best.append(("I", _AFTER[state]))
        letter, to = min(best)
        letters += letter
        state = to
        if letter != "I":
            return letters, state


def backward(codes: str, end: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    """Cost vector at a chunk's start and what was taken off, from the vector at its end."""
    vector, gain = end, 0
    for code in reversed(codes):
        vector, least = _step(code, vector)
        gain += least
    return vector, gain


def fixed(codes: str, old: tuple[int, ...], new: tuple[int, ...], start: tuple[int, ...], gain: int) -> tuple[tuple[int, ...], int]:
    """:func:`backward` from ``new``, given its result from ``old``; stops where both vectors differ by a constant."""
    for code in reversed(codes):
        old, a = _step(code, old)
        new, b = _step(code, new)
        gain += b - a
        if old == new:
            return start, gain
    return new, gain


def trace(codes: str, end: tuple[int, ...], entry: int, last: bool) -> tuple[str, int]:
    """The edits of a chunk entered in a state, and the state behind it; the last chunk also closes the conversation."""
    vectors = [end]
    for code in reversed(codes):
        vectors.append(_step(code, vectors[-1])[0])
    out, state = [], entry
    for k, code in enumerate(codes):
        letters, state = _choice(code, vectors[len(codes) - 1 - k], state)
        out.append(letters)
    while last and _END[state]:
        out.append("I")
        state = _AFTER[state]
    return "".join(out), state


def illegal(codes: str) -> int:
    """Adjacent rows whose initials may not follow each other."""
    kinds = [CODES.index(c) // 3 for c in codes]
    return sum(pair not in _LEGAL for pair in zip(kinds, kinds[1:]))


# --------------------------------------------------------------------------- rows, faults and chunks

def ordered(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, str]:
    """(pos, conv_id, turn, role, text) written in the order of conversation, turn (nulls first), role and text, and its folder.

    Null roles and texts are empty. ``pos`` ascends over the whole table. Ranges cut
    conversations, turns and runs of equal rows alike, so that none is in one task.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["conv_id", "turn", "role", "text", "_row"]
    out = (rows.select(F.col(conv).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
                       F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
           .withColumn("_row", F.monotonically_increasing_id())
           .repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn("pos", F.monotonically_increasing_id()))
    return materialize(out.select("pos", "conv_id", "turn", "role", "text"), "repair-rows")


def faults(rows: DataFrame) -> DataFrame:
    """(pos, conv_id, turn, initial, fault) of :func:`ordered` rows; the fault is blank, duplicate, truncated or null.

    Of rows with equal role and text in a conversation all but the first are
    duplicates: firsts are summed up by a digest, and marked by their positions.
    """
    bare = F.rtrim("text", F.lit(BLANKS))
    mark = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    narrow = rows.select("pos", "conv_id", "turn", F.left("role", F.lit(1)).alias("initial"), (bare == "").alias("blank"),
                         (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("open"), mark.alias("mark"))
    firsts = narrow.groupBy("conv_id", "mark").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("first"))
    fault = (F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(F.col("open"), "truncated"))
    return narrow.join(firsts, "pos", "left").select("pos", "conv_id", "turn", "initial", fault.alias("fault"))


def chunks(found: DataFrame) -> DataFrame:
    """(conv_id, first, codes): each chunk of a conversation, its first position and a letter for each of its rows."""
    kind = F.when(F.col("initial") == "s", 0).when(F.col("initial") == "u", 1).when(F.col("initial") == "a", 2).otherwise(3)
    fault = F.when(F.col("fault").isin("blank", "duplicate"), 2).when(F.col("fault") == "truncated", 1).otherwise(0)
    code = F.substring(F.lit(CODES), kind * 3 + fault + 1, F.lit(1))
    cells = F.array_sort(F.collect_list(F.struct("pos", code.alias("code"))))
    return (found.groupBy("conv_id", F.shiftright("pos", CHUNK_BITS).alias("chunk")).agg(F.min("pos").alias("first"), cells.alias("cells"))
            .select("conv_id", "first", F.array_join(F.transform("cells", lambda c: c["code"]), "").alias("codes")))


def _mapped(df: DataFrame, columns: str, schema: str, one) -> DataFrame:
    """A row of ``schema`` for each row; ``one`` gets the values of ``columns``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [one(*row) for row in zip(*(c.to_pylist() for c in batch.columns))]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(arrow)], schema=arrow)
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string
    arrow = to_arrow_schema(_parse_datatype_string(schema))
    return df.select(*columns.split()).mapInArrow(run, schema)


_CHUNK = "conv_id long, first long, codes string, last boolean, end array<int>, start array<int>, gain long"


def settled(pieces: DataFrame) -> tuple[DataFrame, str]:
    """:func:`chunks` with right vectors (end, start) up to a constant, what the chunk adds (gain) and illegal pairs; its folder.

    Only chunks whose successor has got another vector run again; conversations of
    one chunk never do.
    """
    spark = pieces.sparkSession
    order = Window.partitionBy("conv_id").orderBy("first")
    kinds = F.translate(F.concat(F.lag(F.right("codes", F.lit(1))).over(order), F.left("codes", F.lit(1))), CODES, "sssuuuaaaxxx")
    known = pieces.withColumn("last", F.lead("first").over(order).isNull()).withColumn("seam", F.coalesce(~kinds.isin("su", "ua", "au"), F.lit(False)))

    def first(conv, at, codes, last, seam):
        end = _END if last else _BLIND
        start, gain = backward(codes, end)
        return conv, at, codes, last, end, start, gain, illegal(codes) + seam
    state, at = materialize(_mapped(known, "conv_id first codes last seam", f"{_CHUNK}, illegal long", first), "repair-chunks")

    def again(conv, at, codes, last, end, start, gain, wrong, wanted):
        if wanted is not None and wanted != end:
            start, gain = fixed(codes, tuple(end), tuple(wanted), tuple(start), gain)
            end = wanted
        return conv, at, codes, last, end, start, gain, wrong
    while True:
        wanted = state.withColumn("wanted", F.lead("start").over(order))
        if not wanted.where("not last and wanted <> end").limit(1).count():
            return state, at
        state, new = materialize(_mapped(wanted, "conv_id first codes last end start gain illegal wanted", f"{_CHUNK}, illegal long", again),
                                 "repair-chunks")
        drop_scratch(spark, at)
        at = new


def edits(state: DataFrame) -> DataFrame:
    """(conv_id, first, entry, audit): the state in which each settled chunk is entered and its cheapest edits."""
    def leads(conv, at, codes, last, end):
        return conv, at, "".join(str(trace(codes, tuple(end), q, False)[1]) for q in range(4))
    maps = _mapped(state, "conv_id first codes last end", "conv_id long, first long, leads string", leads)

    def strung(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, q, begun = None, START, False
        for batch in batches:
            entries = []
            for of, lead in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if of != conv or not begun:
                    conv, q, begun = of, START, True
                entries.append(q)
                q = int(lead[q])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(entries, pa.int32())], names=["conv_id", "first", "entry"])
    entry = (maps.repartition("conv_id").sortWithinPartitions("conv_id", "first")
             .mapInArrow(strung, "conv_id long, first long, entry int").select("first", "entry"))

    def audit(conv, at, codes, last, end, entry):
        return conv, at, entry, trace(codes, tuple(end), entry, last)[0]
    return _mapped(state.join(entry, "first"), "conv_id first codes last end entry", "conv_id long, first long, entry int, audit string", audit)


def repaired(rows: DataFrame, plan: DataFrame, whole: bool = False) -> DataFrame:
    """(conv_id, pos, edit, role, text): :func:`ordered` rows after the edits, in order inside each partition.

    Inserted turns have the position of the row that they precede or, at a
    conversation's end, follow, and empty text. Chunks are dealt to partitions, or
    with ``whole`` conversations.
    """
    key = "conv_id" if whole else "chunk"
    both = (rows.select(F.shiftright("pos", CHUNK_BITS).alias("chunk"), "conv_id", "pos", F.lit(1).alias("kind"), "role", "text",
                        F.lit(0).alias("entry"))
            .unionByName(plan.select(F.shiftright("first", CHUNK_BITS).alias("chunk"), "conv_id", F.col("first").alias("pos"), F.lit(0).alias("kind"),
                                     F.lit("").alias("role"), F.col("audit").alias("text"), "entry")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, at, rows_left, state = "", 0, 0, START
        for batch in batches:
            out = []
            for conv, pos, kind, role, text, entry in zip(*(c.to_pylist() for c in batch.columns[1:])):
                if not kind:
                    audit, at, rows_left, state = text, 0, len(text) - text.count("I"), entry
                    continue
                rows_left -= 1
                open_ = True
                while at < len(audit) and (open_ or not rows_left):     # what follows the last row is inserted
                    letter = audit[at]
                    at += 1
                    if letter == "K":
                        state = _KEPT[state, "sua".index(role[0])]
                        out.append((conv, pos, letter, role, text))
                    elif letter != "D":
                        state = _AFTER[state]
                        out.append((conv, pos, letter, "user" if state == USER else "assistant", text if letter == "R" else ""))
                    open_ = open_ and letter == "I"
            cols = list(zip(*out)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                                              *(pa.array(c, pa.string()) for c in cols[2:])], names=["conv_id", "pos", "edit", "role", "text"])
    return (both.repartition(key).sortWithinPartitions("conv_id", "pos", "kind")
            .mapInArrow(run, "conv_id long, pos long, edit string, role string, text string"))


def digests(whole: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of rows whose conversations are whole and in order in a partition; a digest is fed row by row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(conv, sha):
            return pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([sha.hexdigest()])], names=["conv_id", "repaired_sha256"])
        conv, sha = None, None
        for batch in batches:
            for of, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if sha is None or of != conv:
                    if sha is not None:
                        yield row(conv, sha)
                    conv, sha, mark = of, hashlib.sha256(), ""
                sha.update(f"{mark}{role}:{text}".encode())
                mark = "\n"
        if sha is not None:
            yield row(conv, sha)
    return whole.select("conv_id", "role", "text").mapInArrow(run, "conv_id long, repaired_sha256 string")


def report(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """Per conversation of ``conversations`` (conv_id): gaps, faults, illegal pairs, cost, audit and digest of its repaired ``rows``.

    ``rows`` has conv_id, turn, role and text; other columns are ignored. Null ids are one
    conversation, null turns come first and make no gap, null texts are blank, null
    roles are empty and cannot be kept. Rows that repeat are duplicates, whatever their
    turn. The digest is of one text for each conversation, which no two tasks can
    share: it is fed row by row in one.
    """
    spark = rows.sparkSession
    placed, placed_at = ordered(rows)
    found, found_at = materialize(faults(placed), "repair-faults")
    turns = found.groupBy("conv_id", "turn").agg(*[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")])
    counts = turns.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"),
        *[F.sum(f).cast("long").alias(f) for f in ("blank", "duplicate", "truncated")])
    state, state_at = settled(chunks(found))
    plan, plan_at = materialize(edits(state), "repair-edits")
    begin = F.min_by("start", "first")[START]
    costs = state.groupBy("conv_id").agg(F.sum("illegal").cast("long").alias("illegal"), (F.sum("gain") + begin).cast("long").alias("cost"))
    audits = plan.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("first", "audit"))), lambda p: p["audit"]), "").alias("audit"))
    hashes = digests(repaired(placed, plan, whole=True))
    out = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    for part in (counts, costs, audits, hashes):
        other = part.withColumnRenamed("conv_id", "_other")
        out = out.join(other, out["conv_id"].eqNullSafe(other["_other"]), "left").drop("_other")
    zeros: dict[str, Column] = {c: F.coalesce(c, F.lit(0).cast("long")) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    out = out.select("conv_id", *[c.alias(n) for n, c in zeros.items()], F.coalesce("audit", F.lit("")).alias("audit"),
                     F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
    result, _ = materialize(out, "repair-report")
    drop_scratch(spark, placed_at, found_at, state_at, plan_at)
    return result
