"""Chat formatting from event logs.

A conversation arrives as a log: messages are opened, their text comes in streamed
deltas, an edit replaces it, a regeneration drops it before new deltas follow. Events
are gathered by conversation and message, sorted by sequence and folded into final
messages, which a template renders. Everything is DataFrame functions. A log that is
already partitioned by conversation is not dealt again; in any other the messages of a
large conversation are folded in many tasks and meet as finished texts.

The template writes a turn as ``### role: text</turn>`` and a line feed. Inside texts
a backslash is doubled, and one is put into ``###`` after each ``#`` that two more
follow, into ``</turn>`` after the ``<``, and in roles into ``: `` after the colon, so
that no control string of the template occurs in a text, and taking out the backslashes
gives the text back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, DELTA, EDIT, REGENERATE = "open", "delta", "edit", "regenerate"
END = "</turn>\n"
LEARNED = "assistant"      # the role whose text is under the loss mask
PIECE = 64                 # characters of a delta, at least
PIECES = 200               # deltas of a message, at most: pieces of a longer text are longer
_STEP = 1024               # sequence numbers of a message in a log made from finished messages
_EVENT = "struct<seq: bigint, message: bigint, kind: string, role: string, text: string>"


def escaped(text: Column) -> Column:
    """The text without control strings of the template; :func:`unescaped` is its inverse."""
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), "#(?=##)|<(?=/turn>)", "$0\\\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def as_log(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, seq, message, kind, role, text): the log that leads to these messages.

    Messages follow each other by turn (nulls first), then role and text. An
    assistant's first half is streamed, dropped by a regeneration and streamed anew; a
    user's first half is replaced by an edit; other messages are streamed once. Null
    texts and roles are empty.
    """
    rows = messages.select(F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("turn"),
                           F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text")).cast("long")
    size = F.greatest(F.lit(PIECE), F.ceil(F.length("text") / PIECES)).cast("int")
    count = F.ceil(F.length("text") / F.col("size")).cast("int")

    def event(kind: str, words: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), words.alias("text"))
    pieces = F.transform(F.when(F.col("count") > 0, F.sequence(F.lit(0), F.col("count") - 1)).otherwise(F.array().cast("array<int>")),
                         lambda k: event(DELTA, F.substring(F.col("text"), k * F.col("size") + 1, F.col("size"))))
    half = event(DELTA, F.substring(F.col("text"), F.lit(1), (F.length("text") / 2).cast("int")))
    opened = event(OPEN, F.lit(""))
    events = (F.when(F.col("role") == LEARNED, F.concat(F.array(opened, half, event(REGENERATE, F.lit(""))), pieces))
              .when(F.col("role") == "user", F.array(opened, half, event(EDIT, F.col("text"))))
              .otherwise(F.concat(F.array(opened), pieces)))
    return (rows.withColumn("message", place).withColumn("size", size).withColumn("count", count)
            .select("conv_id", "message", "role", F.posexplode(events).alias("at", "event"))
            .select("conv_id", (F.col("message") * _STEP + F.col("at")).alias("seq"), "message", F.col("event.kind").alias("kind"),
                    "role", F.col("event.text").alias("text")))


def reconstruct(events: DataFrame) -> DataFrame:
    """(conv_id, opened, message, role, text): the final messages of a log, in the order (opened, message).

    Events (conv_id, seq, message, kind, role, text) may come in any order and may
    repeat; equal ones count once. A message's text is what follows its last edit or
    regeneration in sequence, the edit's own text included. Either also takes back
    the messages that were opened earlier in sequence but after the message itself.
    A null text is empty, a null role is that of the message's first event that has one, or
    empty; a null sequence number comes first; other kinds change nothing.
    """
    resets = F.filter("log", lambda e: e["kind"].isin(EDIT, REGENERATE))
    last = F.array_max(F.transform(resets, lambda e: e["seq"]))
    wanted = F.filter("log", lambda e: e["kind"].isin(OPEN, DELTA, EDIT) & (F.col("reset").isNull() | (e["seq"] >= F.col("reset"))))
    event = F.struct(F.col("seq").cast("long").alias("seq"), F.col("message").cast("long").alias("message"), "kind", "role",
                     F.coalesce("text", F.lit("")).alias("text")).cast(_EVENT)
    folded = (events.select(F.col("conv_id").cast("long").alias("conv_id"), event.alias("e"))
              .groupBy("conv_id", F.col("e.message").alias("message")).agg(F.sort_array(F.collect_set("e")).alias("log"))
              .withColumn("reset", last)
              .select("conv_id", "message", "reset", F.get(F.col("log"), F.lit(0))["seq"].alias("opened"),
                      F.coalesce(F.get(F.filter(F.transform("log", lambda e: e["role"]), lambda r: r.isNotNull()), F.lit(0)), F.lit("")).alias("role"),
                      F.array_join(F.transform(wanted, lambda e: e["text"]), "").alias("text")))
    before = Window.partitionBy("conv_id").orderBy("opened", "message").rowsBetween(Window.unboundedPreceding, -1)
    return (folded.withColumn("rewound", F.max("reset").over(before))
            .where("rewound is null or opened is null or rewound < opened").select("conv_id", "opened", "message", "role", "text"))


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, segments): each conversation's formatted text as segments (text, loss); their texts joined are the output.

    ``loss`` marks an assistant's text, without its header and end mark. A
    conversation is one row, so that its text must fit into one.
    """
    role = F.regexp_replace(escaped(F.col("role")), ":(?= )", "$0\\\\")
    learned = F.col("role") == LEARNED
    parts = F.array(F.struct(F.concat(F.lit("### "), role, F.lit(": ")).alias("text"), F.lit(False).alias("loss")),
                    F.struct(escaped(F.col("text")).alias("text"), learned.alias("loss")),
                    F.struct(F.lit(END).alias("text"), F.lit(False).alias("loss")))
    turns = F.sort_array(F.collect_list(F.struct("opened", "message", parts.alias("parts"))))
    return (messages.groupBy("conv_id").agg(turns.alias("turns"))
            .select("conv_id", F.flatten(F.transform("turns", lambda t: t["parts"])).alias("segments")))


def formatted(segments: str | Column = "segments") -> Column:
    """The output text."""
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def read_back(rendered: DataFrame) -> DataFrame:
    """(conv_id, formatted, turns, learned): the turns (role, text) read from the output text, and all text under the loss mask."""
    blocks = F.split("formatted", END)
    turns = F.transform(F.slice(blocks, F.lit(1), F.size(blocks) - 1), lambda b: F.struct(
        unescaped(F.substring(b, F.lit(5), F.instr(b, ": ") - 5)).alias("role"),
        unescaped(F.substring(b, F.instr(b, ": ") + 2, F.length(b))).alias("text")))
    learned = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescaped(s["text"]))
    return (rendered.withColumn("formatted", formatted())
            .select("conv_id", "formatted", turns.alias("turns"), F.array_join(learned, "").alias("learned")))


def digest(read: DataFrame) -> DataFrame:
    """Per conversation of :func:`read_back`: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
                       F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))
