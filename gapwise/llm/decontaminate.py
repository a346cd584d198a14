"""Benchmark passages in training documents, found by spaced seeds.

Fixed masks pick some of the words in a window and ignore the others; the hash
of the picked words is a seed. Seeds of documents and benchmark items are
joined, and around every hit the two texts are compared word by word on the
hit's diagonal, so that replaced words do not hide a passage. Whichever three of
thirteen words are replaced, a mask fits between them, so that no passage is
missed. An item of fewer words is cut into one piece more than words may be
replaced, of which one is whole, and the pieces are its seeds. DataFrame functions only.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapwise.llm import joins
from gapwise.runtime import drop_scratch, materialize

MASKS = ("1110101", "1001000111", "1010010011")     # 1: the word counts, 0: any word
WINDOW = 13                # aligned words compared around a hit
MATCHES = 10               # of them that must be equal


def words(text: Column) -> Column:
    """Hashes of the lower-case words, in order; null for a null text."""
    return F.transform(F.filter(F.split(F.lower(text), "[\\x20\\x09-\\x0D]+"), lambda w: w != ""), lambda w: F.xxhash64(w))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once for a row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def needed(size: int) -> int:
    """How many words of a window must be equal."""
    return -(-MATCHES * size // WINDOW)


def pieces(size: int) -> list[tuple[int, int]]:
    """(start, words) of the pieces of an item that is shorter than a window."""
    n = size - needed(size) + 1
    bounds = [size * k // n for k in range(n + 1)]
    return [(a, b - a) for a, b in zip(bounds, bounds[1:])]


def _at(h: Column, number: int, i, places) -> Column:
    return F.xxhash64(F.lit(number), *[F.get(h, i + p) for p in places])


def _seeds(hashes: Column, lengths: list[int]) -> Column:
    """For every mask, and for pieces of the given lengths, the array of seeds by position."""
    shapes = [(k, len(m), [i for i, c in enumerate(m) if c == "1"]) for k, m in enumerate(MASKS)] + [(100 + n, n, list(range(n))) for n in lengths]

    def of(number: int, span: int, places: list[int]):
        return lambda h: F.when(F.size(h) >= span, F.transform(F.sequence(F.lit(0), F.size(h) - span), lambda i: _at(h, number, i, places)))
    return _let(hashes, lambda h: F.array(*[of(*s)(h) for s in shapes]))


def _exploded(rows: DataFrame, key: str, text: str, pos: str, lengths: list[int]) -> DataFrame:
    """(key, seed, pos) of every mask or piece and position."""
    each = rows.select(key, F.explode(_seeds(words(F.col(text)), lengths)).alias("seeds"))
    return each.select(key, F.posexplode("seeds").alias(pos, "seed"))


def _known(items: DataFrame, sizes: list[int]) -> DataFrame:
    """(item_id, at, seed) of benchmark items (item_id, there); ``sizes`` are those below a window."""
    whole = items.where(F.size("there") >= WINDOW).select("item_id", F.explode(_seeds(F.col("there"), [])).alias("seeds")).select(
        "item_id", F.posexplode("seeds").alias("at", "seed"))
    for size in sizes:
        cut = F.array(*[F.struct(F.lit(a).alias("at"), _at(F.col("there"), 100 + n, F.lit(a), range(n)).alias("seed")) for a, n in pieces(size)])
        whole = whole.unionByName(items.where(F.size("there") == size).select("item_id", F.explode(cut).alias("s")).select("item_id", "s.at", "s.seed"))
    return whole


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row for each document and benchmark item with a shared passage.

    Columns: doc_id, item_id, matched (most equal words in a window of 13
    aligned ones), doc_start (the first word of that window, 0-based). A passage
    is reported if at least 10 of 13 aligned words are equal (items of under 13
    words: as large a share of all their words, under 5 all of them).
    Words are lower-case. Null and wordless texts and rows with a null id find nothing. Repeated ids count as one document
    with several texts; other columns are ignored. Without a leak, and for
    empty tables, there is no row.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id is not null")
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).alias("item")).where(
        "item_id is not null")
    items = items.select("item_id", words(F.col("item")).alias("there")).where("size(there) > 0")
    sizes = sorted(r[0] for r in items.where(F.size("there") < WINDOW).select(F.size("there")).distinct().collect())     # twelve at most
    lengths = sorted({n for size in sizes for _, n in pieces(size)})
    known, known_at = materialize(_known(items, sizes).distinct(), "seeds")
    hits = (_exploded(texts, "doc_id", "text", "pos", lengths).join(joins.sized(known), "seed")
            .select("doc_id", "item_id", (F.col("pos") - F.col("at")).alias("shift")).distinct())
    hits, hits_at = materialize(hits, "seed-hits")
    drop_scratch(spark, known_at)
    wanted, wanted_at = materialize(hits.select("doc_id").distinct(), "seed-docs")
    held = texts.join(joins.sized(wanted), "doc_id").select("doc_id", words(F.col("text")).alias("here"))
    pairs = held.join(hits.join(items, "item_id"), "doc_id")
    equal = F.transform("there", lambda w, j: F.when(F.get("here", j + F.col("shift")) == w, 1).otherwise(0))
    size = F.least(F.lit(WINDOW), F.size("there"))
    best = _let(equal, lambda e: F.array_max(F.transform(
        F.sequence(F.lit(1), F.size(e) - size + 1),
        lambda a: F.struct(F.aggregate(F.slice(e, a, size), F.lit(0), lambda s, x: s + x).alias("matched"),
                           (-a).alias("back")))))
    found = (pairs.withColumn("best", best).where(F.col("best.matched") * WINDOW >= F.lit(MATCHES) * size)
             .select("doc_id", "item_id", F.col("best.matched").alias("matched"),
                     (F.col("shift") - F.col("best.back") - 1).alias("doc_start")))
    out = found.groupBy("doc_id", "item_id").agg(
        F.max(F.struct("matched", (-F.col("doc_start")).alias("back"))).alias("m"))
    return out.select("doc_id", "item_id", F.col("m.matched").cast("long").alias("matched"),
                      (-F.col("m.back")).cast("long").alias("doc_start"))


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without a benchmark passage, all columns; rows with a null id stay."""
    own = f"id_{uuid.uuid4().hex}"              # no column of the documents
    found, _ = materialize(leaks(docs, benchmark, id_col, text_col).select(F.col("doc_id").alias(own)).distinct(), "leaks")
    return docs.join(joins.sized(found), F.col(id_col).cast("long") == F.col(own), "left_anti")
