"""Best-fit packing of tokenised documents into sequences of bounded length.

Minimum bin slack on the histogram of piece lengths: each bin starts with the
longest piece left and a bitset subset-sum finds the fullest combination of
further lengths; it is removed as often as the counts allow. The histogram and
the list of combinations are bounded by the sequence length, not by the data.
Pieces then take the places of their length by their rank among equal lengths.
"""

from __future__ import annotations

import codecs
import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gapwise.llm.words import slices
from gapwise.runtime import materialize

CAPACITY = 4096
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
_CACHED_WORDS = 120_000    # of one generation
_CACHED_BYTES = 64          # longer words are encoded each time they occur
_SALT_ROWS = 20_000

# Marks that may follow a letter or digit as a token of their own; < and > may be part of a special token.
_MARKS = b"!#$%&*+,-./:;=?"
# The byte-level alphabet of the tokenizer: printable bytes stand for themselves, the others are counted from 256.
_PLAIN = {*range(33, 127), *range(161, 173), *range(174, 256)}
_OTHERS = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _PLAIN)}
_ALPHABET = "".join(chr(_OTHERS.get(b, b)) for b in range(256))
_DOTTED = "\u0130".encode()                                      # its small form is two characters
_FAR = re.compile("[\u0130\u0250-\U0010ffff]").search
_PACKERS = [struct.Struct(f"<{n}I").pack for n in range(32)]


class WordEncoder:
    """Ids of texts, word by word; words met lately are kept, in two generations of bounded size."""

    def __init__(self, name: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"           # Spark's tasks share the cores already
        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        self.model = self.tokenizer.model
        self.known: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}
        self.end = struct.pack("<I", END_ID)

    def word(self, w: bytes) -> bytes:
        """Ids of a text without ASCII white space.

        Letters below U+0250 are one token sequence of the model, as the
        normaliser only folds their case; marks that end a word after an ASCII
        letter or digit never merge with it. All else goes through the whole tokenizer.
        """
        if w.isalpha():                                          # of bytes: ASCII letters only, which stand for themselves
            return self._packed([t.id for t in self.model.tokenize(w.lower().decode())])
        stem = w.rstrip(_MARKS)
        if 0 < len(stem) < len(w) and b"<" not in w and _DOTTED not in w and (
                stem[-1:].isalnum() or stem.decode()[-1].isalpha()):
            return self.ids(stem) + self.ids(w[len(stem):])
        u = w.decode()
        if u.isalpha() and not _FAR(u):
            spelling, _ = codecs.charmap_decode(u.lower().encode(), "strict", _ALPHABET)
            return self._packed([t.id for t in self.model.tokenize(spelling)])
        return self._packed(self.tokenizer.encode(u, add_special_tokens=False).ids)

    @staticmethod
    def _packed(ids: list[int]) -> bytes:
        return _PACKERS[len(ids)](*ids) if len(ids) < len(_PACKERS) else struct.pack(f"<{len(ids)}I", *ids)

    def ids(self, w: bytes) -> bytes:
        code = self.known.get(w)
        if code is None:
            code = self.before.get(w)
            if code is None:
                code = self.word(w)
            if len(w) <= _CACHED_BYTES:
                if len(self.known) >= _CACHED_WORDS:
                    self.known, self.before = {}, self.known
                self.known[w] = code
        return code

    def text(self, raw: bytes) -> bytes:
        """Little-endian 32-bit ids of a UTF-8 text, END_ID added.

        The tokenizer drops white space and letter case and never merges across
        white space, so a text's ids are those of its words one after the other.
        """
        words = (raw if b"<|" in raw else raw.lower()).split()   # special tokens are spelt in lower case only
        codes = list(map(self.known.get, words))
        for i in [i for i, c in enumerate(codes) if c is None]:
            codes[i] = self.ids(words[i])
        codes.append(self.end)
        return b"".join(codes)


@cache
def encoder(name: str = TOKENIZER) -> WordEncoder:
    """Kept by a Python worker between tasks."""
    return WordEncoder(name)


def _pieces(name: str, capacity: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1, 1 << 20):
                texts = [x.as_py() or b"" for x in batch.column(1).cast(pa.binary())]
                rows: list[tuple] = []
                ids: list[np.ndarray] = []
                for doc_id, data in zip(batch.column(0).to_pylist(), map(encoder(name).text, texts)):
                    for k, at in enumerate(range(0, len(data), 4 * capacity)):
                        part = data[at: at + 4 * capacity]
                        rows.append((doc_id, k, at // 4, len(part) // 4, zlib.crc32(part)))
                        if with_ids:
                            ids.append(np.frombuffer(part, "<i4"))
                cols = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    bounds = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                    cols.append(pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(ids))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)
    return run


def token_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER,
                 capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Per piece of each row's ids: doc_id, piece, start, length, ids_crc32 and, if asked for, ids."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        _pieces(tokenizer, capacity, with_ids), schema)


def fullest(counts: dict[int, int], room: int) -> list[tuple[int, int]]:
    """(length, times) of a combination of the available lengths that fills ``room`` best.

    One bitset holds the reachable sums; it grows by each length in turn,
    longest first, until the room can be filled.
    """
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length in sorted((x for x, n in counts.items() if n and x <= room), reverse=True):
        left, take = min(counts[length], room // length), 1
        while left and not reach >> room & 1:
            take = min(take, left)
            steps.append((length, take, reach))
            reach |= reach << (length * take) & mask
            left -= take
            take *= 2
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    used: dict[int, int] = {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            total -= length * take
            used[length] = used.get(length, 0) + take
    return sorted(used.items(), reverse=True)


def combinations(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[tuple[int, int]], int]]:
    """([(length, times), ...], bins) in the order of packing; every piece is used once."""
    counts = {x: n for x, n in histogram.items() if n}
    out = []
    for seed in sorted(counts, reverse=True):
        while counts[seed]:
            counts[seed] -= 1
            parts = dict(fullest(counts, capacity - seed))
            counts[seed] += 1
            parts[seed] = parts.get(seed, 0) + 1
            bins = min(counts[x] // times for x, times in parts.items())
            for x, times in parts.items():
                counts[x] -= bins * times
            out.append((sorted(parts.items(), reverse=True), bins))
    return out


def _places(packed: list[tuple[list[tuple[int, int]], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length, by combination: first rank, times in a bin, first sequence, first offset."""
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for parts, bins in packed:
        offset = 0
        for length, times in parts:
            rows.setdefault(length, []).append((used.get(length, 0), times, sequence, offset))
            used[length] = used.get(length, 0) + times * bins
            offset += length * times
        sequence += bins
    return {k: tuple(np.array(c, np.int64) for c in zip(*v)) for k, v in rows.items()}


def _place(places: dict[int, tuple[np.ndarray, ...]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for x in np.unique(length):
                at = np.flatnonzero(length == x)
                first, times, seq, off = places[int(x)]
                k = np.searchsorted(first, rank[at], side="right") - 1
                turn = rank[at] - first[k]
                sequence[at] = seq[k] + turn // times[k]
                offset[at] = off[k] + turn % times[k] * x
            cols = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(sequence), pa.array(offset)],
                                             names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])
    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER,
         capacity: int = CAPACITY) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A row's ids are its text's (null: none) and END_ID; only longer ones are cut
    into pieces of ``capacity`` ids. Pieces fill their sequence from 0 without
    gaps. Rows that repeat a doc_id, or have none, are documents of their own.
    Other columns are ignored. An empty table gives no rows.
    """
    pieces, _ = materialize(token_pieces(docs, id_col, text_col, tokenizer, capacity), "pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    salts = max(64, sum(histogram.values()) // _SALT_ROWS)
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = (salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
              .select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")))
    own = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (salted.withColumn("nth", F.row_number().over(own)).join(starts, ["length", "salt"])
              .withColumn("rank", F.col("first") + F.col("nth") - 1)
              .select("doc_id", "piece", "start", "length", "ids_crc32", F.col("rank").cast("long").alias("rank")))
    return ranked.mapInArrow(_place(_places(combinations(histogram, capacity))),
                             "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def sequences(placed: DataFrame, pieces: DataFrame) -> DataFrame:
    """Per sequence: sequence_id, ids, doc_ids; ``pieces`` is token_pieces(..., with_ids=True) of the same documents."""
    rows = placed.join(pieces.select("doc_id", "piece", "ids_crc32", "ids"), ["doc_id", "piece", "ids_crc32"])
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return rows.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.doc_id").alias("doc_ids"))
