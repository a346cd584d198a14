"""Language model of words in an Elias-Fano n-gram trie.

Level one holds every training word with its count; a word's id is its place
there. On the levels above, a context's place one level below leads to a pointer,
and the words between it and the next pointer are the context's children. Their ids
are kept as distances from the last value of the context before, so the whole level
ascends and compresses to a few bits, and a child is found by a successor search
relative to the context. Probabilities are interpolated absolute discounting, their
logarithms quantised to two bytes, as is what discounting leaves of each context,
which is read by place. Every level is cut into key ranges; a range is a file that
the tasks which count the next level, and those that score, map into memory.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapwise.llm import mapped
from gapwise.llm.eliasfano import EliasFano, encode
from gapwise.llm.words import U64, mix, slices, text_buffers, word_hashes
from gapwise.runtime import drop_scratch, materialize, scratch_dir

DISCOUNT = 0.75
LEAST = 2                  # occurrences of a kept longer n-gram
SHARD_WORDS = 2_000_000    # keys in a file, about
END = int(mix(np.array([0x656E64], U64))[0] >> U64(1))
GRID = 4000                # steps of a quantised log10, whose 65,536 codes reach down to 1e-16
PART_KEYS = 500_000        # n-grams that are summed up at once, at most on average
_PENDING = 3_000_000       # n-grams that a counting task holds before it sums them up
_SENT = 500_000            # of them in a batch, about
_SCATTER = U64(0x9E3779B97F4A7C15)                  # keys times this are spread evenly over 64 bits ...
_GATHER = U64(pow(int(_SCATTER), -1, 1 << 64))      # ... and come back


def _tokens(batch: pa.RecordBatch, column: int) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts with END after each, and the bounds of the texts (non-negative 63-bit ints)."""
    words, first = word_hashes(*text_buffers(batch.column(column)))
    words = (words >> U64(1)).astype(np.int64)
    n = batch.num_rows
    out = np.full(len(words) + n, END, np.int64)
    spot = np.ones(len(out), bool)
    bounds = first + np.arange(n + 1)
    spot[bounds[1:] - 1] = False
    out[spot] = words
    return out, bounds


def _summed(of: Callable[[pa.RecordBatch], np.ndarray], parts: int):
    """Counting task: distinct keys of its texts and how often they occur, a row for each part of the range of scattered keys."""
    edges = np.array([-(-(i << 64) // parts) for i in range(parts)], U64)

    def rows(keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        keys, n = np.unique(keys.astype(U64) * _SCATTER, return_counts=True)
        cuts, part = [*np.searchsorted(keys, edges), len(keys)], 0
        while part < parts:
            row, size = [], 0
            while part < parts and size < _SENT:
                for a in range(cuts[part], cuts[part + 1], _SENT):
                    to = min(a + _SENT, cuts[part + 1])
                    row.append((part, keys[a:to].tobytes(), n[a:to].tobytes()))
                    size += to - a
                part += 1
            if row:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*row), (pa.int32(), pa.binary(), pa.binary()))],
                                                 names=["part", "keys", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for whole in batches:
            for batch in slices(whole, 0):
                held.append(of(batch))
                size += len(held[-1])
                if size > _PENDING:
                    yield from rows(np.concatenate(held))
                    held, size = [], 0
        if held:
            yield from rows(np.concatenate(held))
    return run


def _totals(least: int):
    """Sums of a part's counts by key; of those, the keys that occur ``least`` times."""
    def run(part: pa.Table) -> pa.Table:
        keys, n = (np.concatenate([np.frombuffer(x.as_buffer(), t) for x in part.column(c)]) for c, t in (("keys", U64), ("n", np.int64)))
        order = np.argsort(keys)
        keys = keys[order]
        new = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        n = np.add.reduceat(n[order], new)
        some = n >= least
        return pa.table({"key": (keys[new[some]] * _GATHER).astype(np.int64), "n": n[some]})
    return run


def distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values and each value's place among them."""
    order = np.argsort(x)
    ascending = x[order]
    new = np.ones(len(x), bool)
    np.not_equal(ascending[1:], ascending[:-1], out=new[1:])
    rank = np.empty(len(x), np.int64)
    rank[order] = np.cumsum(new) - 1
    return ascending[new], rank


def _quantised(p: np.ndarray) -> bytes:
    """Codes of -log10 of probabilities."""
    return np.clip(np.rint(np.log10(p) * -GRID), 0, 65535).astype(np.uint16).tobytes()


def _counted(texts: DataFrame, of: Callable[[pa.RecordBatch], np.ndarray], name: str, total: int = 0, least: int = 1) -> tuple[DataFrame, str]:
    """(key, n) of the keys that occur ``least`` times; ``total``: how many there are with repeats, at most.

    Tasks send sorted keys and counts as bytes, a row for each part of the keys, and a part is summed up at once.
    """
    parts = max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // PART_KEYS + 1)
    counts = texts.mapInArrow(_summed(of, parts), "part int, keys binary, n binary")
    return materialize(counts.groupBy("part").applyInArrow(_totals(least), "key long, n long"), name)


def _written(rows: DataFrame, shards: int, key: str, columns: list[str], folder: str, name: str,
             build: Callable[..., list[bytes]]) -> list[tuple[int, int, int, str]]:
    """Write each key range as a file; (first key, last key, place of the first key, path) in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            cols = [np.concatenate([b.column(c).to_numpy() for b in held]) for c in columns]
            path = mapped.write(folder, name, build(*cols))
            yield pa.RecordBatch.from_arrays([pa.array([cols[0][0]]), pa.array([cols[0][-1]]),
                                              pa.array([len(cols[0])], pa.int64()), pa.array([path])],
                                             names=["lo", "hi", "rows", "path"])
    files = (rows.select(*columns).repartitionByRange(shards, key).sortWithinPartitions(key)
             .mapInArrow(run, "lo long, hi long, rows long, path string").collect())
    files = sorted((r["lo"], r["hi"], r["rows"], r["path"]) for r in files)
    at = np.cumsum([0, *[f[2] for f in files]])
    return [(lo, hi, int(a), path) for (lo, hi, _, path), a in zip(files, at)]


def _word_file(key: np.ndarray, n: np.ndarray) -> list[bytes]:
    large = np.flatnonzero(n >= 255)
    return [encode(key.astype(U64)), np.minimum(n, 255).astype(np.uint8).tobytes(), encode(large.astype(U64)),
            n[large].astype(np.int64).tobytes()]


def _rest_file(id: np.ndarray, rest: np.ndarray) -> list[bytes]:
    """Codes of all places between the first and the last; a context without children leaves one."""
    dense = np.ones(id[-1] - id[0] + 1)
    dense[id - id[0]] = rest
    return [_quantised(dense)]


def _level_file(context: np.ndarray, word: np.ndarray, p: np.ndarray, n: np.ndarray | None = None) -> list[bytes]:
    """A range of n-grams, ascending by context and word: pointers by context, children, codes and, if given, counts."""
    new = np.flatnonzero(np.concatenate(([True], context[1:] != context[:-1])))
    last = np.concatenate((word[new[1:] - 1], word[-1:])).astype(U64) + U64(1)     # children count from one
    before = np.cumsum(last, dtype=U64) - last
    size = np.diff(np.concatenate((new, [len(context)])))
    pointers = np.searchsorted(context, np.arange(context[0], context[-1] + 2))
    return [np.array([context[0]], np.int64).tobytes(), encode(pointers.astype(U64)),
            encode(np.repeat(before, size) + word.astype(U64) + U64(1)), _quantised(p),
            b"" if n is None else n.astype(np.int64).tobytes()]


class Words:
    """Level one of a key range; ``first`` is the id of its first word."""

    def __init__(self, path: str, first: int = 0):
        keys, self.small, large, self.counts = mapped.read(path)
        self.keys, self.large, self.first = EliasFano(keys), EliasFano(large), first
        self.counts = self.counts.view(np.int64)

    def at(self, place: np.ndarray) -> np.ndarray:
        """Counts by place in the file."""
        out = self.small[place].astype(np.int64)
        over = np.flatnonzero(out == 255)
        out[over] = self.counts[self.large.successor(place[over])[0]]
        return out

    def find(self, key: np.ndarray) -> list[np.ndarray]:
        """Counts and ids of words; zero for others."""
        at, found = self.keys.successor(key)
        n = np.zeros(len(key), np.int64)
        n[found] = self.at(at[found])
        return [n, np.where(found, at + self.first, 0)]

    def count(self, key: np.ndarray) -> np.ndarray:
        return self.find(key)[0]


class Rests:
    """What discounting leaves of each context in a range, as log10; zero of the others."""

    def __init__(self, path: str, first: int):
        self.codes, self.first = mapped.read(path)[0].view(np.uint16), first

    def find(self, id: np.ndarray) -> np.ndarray:
        return self.codes[id - self.first] / -GRID


class Level:
    """A range of n-grams; ``first`` is the place of its first one in the whole level."""

    def __init__(self, path: str, first: int = 0):
        start, pointers, children, codes, counts = mapped.read(path)
        self.start, self.first = int(start.view(np.int64)[0]), first
        self.pointers, self.children = EliasFano(pointers), EliasFano(children)
        self.codes, self.counts = codes.view(np.uint16), counts.view(np.int64)

    def _before(self, at: np.ndarray) -> np.ndarray:
        """Last value of the contexts before those whose children begin at ``at``."""
        out = np.zeros(len(at), np.int64)
        later = np.flatnonzero(at)
        out[later] = self.children.get(at[later] - 1).astype(np.int64)
        return out

    def find(self, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in the file of each n-gram, and whether it is there; contexts ascend and lie in the file's range."""
        new = np.concatenate(([True], context[1:] != context[:-1]))
        which = np.cumsum(new) - 1
        own = context[new] - self.start
        lo, hi = (x.astype(np.int64) for x in self.pointers.pair(own))
        at, equal = self.children.successor(self._before(lo)[which] + word + 1)
        return at, equal & (at >= lo[which]) & (at < hi[which])

    def word(self, at: np.ndarray) -> np.ndarray:
        """Last words of the n-grams at these places of the file."""
        own = self.pointers.successor(at + 1)[0] - 1
        return self.children.get(at).astype(np.int64) - self._before(self.pointers.get(own).astype(np.int64)) - 1


def _lookup(files: list[tuple[int, int, object]], key: np.ndarray, width: int,
            one: Callable[[object, np.ndarray], list[np.ndarray]], kind: type = np.int64) -> list[np.ndarray]:
    """Answers for sorted keys from the files whose range holds them; zero elsewhere."""
    out = [np.zeros(len(key), kind) for _ in range(width)]
    for lo, hi, file in files:
        a, b = np.searchsorted(key, lo), np.searchsorted(key, hi, side="right")
        if b > a:
            for o, x in zip(out, one(file, key[a:b])):
                o[a:b] = x
    return out


def _ranked(files: list[tuple[int, int, object]], place: np.ndarray, of: Callable[[object, np.ndarray], np.ndarray]) -> np.ndarray:
    """Values by place in a whole level: ``of`` gets a file and places in it."""
    unique, back = distinct(place)
    out = np.zeros(len(unique), np.int64)
    cuts = np.searchsorted(unique, [f.first for _, _, f in files])
    for (_, _, file), a, b in zip(files, cuts, [*cuts[1:], len(unique)]):
        if b > a:
            out[a:b] = of(file, unique[a:b] - file.first)
    return out[back]


class Model:
    """What counting and scoring need: totals, bits of a word's id and the files of each level.

    ``words``, ``pairs`` and ``triples`` are the levels, ``rest1`` and ``rest2`` what is left of contexts of one and two words.
    """

    def __init__(self, total: int, kinds: int):
        self.total, self.kinds, self.bits = total, kinds, max(1, kinds.bit_length())
        if 2 * self.bits > 62:
            raise ValueError(f"{kinds} words: codes of two have no room in a long")
        self.words, self.pairs, self.triples, self.rest1, self.rest2 = [], [], [], [], []

    def opened(self) -> Opened:
        return Opened(self)


class Opened:
    """A model's files, mapped by a task."""

    def __init__(self, model: Model):
        self.model, self.bits = model, model.bits
        self.words = [(lo, hi, Words(p, at)) for lo, hi, at, p in model.words]
        self.pairs, self.triples = ([(lo, hi, Level(p, at)) for lo, hi, at, p in fs] for fs in (model.pairs, model.triples))
        self.rest1, self.rest2 = ([(lo, hi, Rests(p, lo)) for lo, hi, _, p in fs] for fs in (model.rest1, model.rest2))

    def rest(self, files: list, place: np.ndarray) -> np.ndarray:
        """log10 of what discounting leaves of contexts, by ascending place."""
        return _lookup(files, place, 1, lambda f, k: [f.find(k)], float)[0]

    def unit(self, count: np.ndarray) -> np.ndarray:
        return (count + 0.5) / (self.model.total + 0.5 * (self.model.kinds + 1))

    def count(self, id: np.ndarray) -> np.ndarray:
        return _ranked(self.words, id, lambda f, at: f.at(at))

    def found(self, level: list, code: np.ndarray, rest: list = ()) -> tuple[np.ndarray, ...]:
        """Whether each code is in a level, its place there, its log10 probability and what it leaves as a context."""
        mask = (1 << self.bits) - 1

        def one(file: Level, key: np.ndarray) -> list[np.ndarray]:
            at, found = file.find(key >> self.bits, key & mask)
            at = np.where(found, at, 0)
            return [found, (at + file.first) * found, file.codes[at] * found]

        unique, back = distinct(code)
        found, place, prob = _lookup(level, unique, 3, one)
        found = found > 0
        left = np.zeros(len(unique))
        if rest:
            left[found] = self.rest(rest, place[found])
        return found[back], place[back], (prob / -GRID)[back], left[back]

    def read(self, batch: pa.RecordBatch, column: int) -> tuple[np.ndarray, ...]:
        """Bounds, counts, ids (opened, -1: no longer n-gram can be kept), which are tokens of a text, and log10 of
        what each id leaves as a context."""
        tokens, bounds = _tokens(batch, column)
        unique, place = distinct(tokens)
        count, id = _lookup(self.words, unique, 2, lambda f, k: f.find(k))
        some = np.flatnonzero(count >= LEAST)
        left = np.zeros(len(unique))
        left[some] = self.rest(self.rest1, id[some])
        id = np.where(count >= LEAST, id, -1)
        end = np.searchsorted(unique, END)
        keep = np.ones(len(tokens) + len(bounds) - 1, bool)
        keep[bounds[:-1] + np.arange(len(bounds) - 1)] = False
        spots = np.full(len(keep), end, np.int64)
        spots[keep] = place
        return bounds, count[place], id[spots], keep, left[spots]

    def pair(self, ids: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions that end two words with ids in one text, and the codes of these two."""
        before = np.concatenate(([-1], ids[:-1]))
        spots = np.flatnonzero(keep & (before >= 0) & (ids >= 0))
        return spots, before[spots] << self.bits | ids[spots]

    def triple(self, ids: np.ndarray, keep: np.ndarray, held: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions after a kept pair (``held``, at ``place``) whose word has an id, and the codes of the three."""
        spots = np.flatnonzero(held[:-1] & keep[1:] & (ids[1:] >= 0)) + 1
        return spots, place[spots - 1] << self.bits | ids[spots]


def _codes(model: Model, order: int):
    """Codes of a batch's n-grams whose parts are all kept; files are opened once a task."""
    opened = []

    def of(batch: pa.RecordBatch) -> np.ndarray:
        if not opened:
            opened.append(model.opened())
        m = opened[0]
        _, _, ids, keep, _ = m.read(batch, 0)
        spots, code = m.pair(ids, keep)
        if order == 2:
            return code
        held, place = np.zeros(len(ids), bool), np.zeros(len(ids), np.int64)
        held[spots], place[spots], _, _ = m.found(m.pairs, code)
        spots, code = m.triple(ids, keep, held, place)
        return code[held[spots]]           # the last two words are kept as well, or the three occur too seldom
    return of


def _shares(rows: DataFrame, model: Model, count: Callable[[Opened, np.ndarray], np.ndarray]) -> DataFrame:
    """(key, p) of the contexts of rows of (key, n): p is what discounting leaves; ``count`` gives a context's occurrences."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = model.opened()
        for batch in batches:
            p = 1 - batch.column(1).to_numpy() / count(opened, batch.column(0).to_numpy())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p, pa.float64())], names=["key", "p"])
    mass = F.sum(F.col("n") - F.lit(DISCOUNT)).cast("double").alias("mass")
    return rows.groupBy(F.shiftright("key", model.bits).alias("key")).agg(mass).mapInArrow(run, "key long, p double")


def learn(texts: DataFrame, text_col: str = "text") -> tuple[Model, str]:
    """Count all words and n-grams of the texts and write the levels; the model and its folder.

    Null texts are empty. All n-grams of two and three words that occur at least
    twice are kept.
    """
    spark = texts.sparkSession
    texts = texts.select(F.col(text_col).alias("text"))
    folder = scratch_dir(spark, "trie")

    def shards(rows: int) -> int:
        return max(8, rows // SHARD_WORDS + 1)

    words, words_at = _counted(texts, lambda b: _tokens(b, 0)[0], "lm-words")
    size = words.agg(F.sum("n"), F.count("*")).first()
    model = Model(int(size[0] or 0), int(size[1]))
    bits, mask = model.bits, (1 << model.bits) - 1
    model.words = _written(words, shards(model.kinds), "key", ["key", "n"], folder, "words", _word_file)
    drop_scratch(spark, words_at)

    def level(order: int, weigh: Callable[[Opened, np.ndarray, np.ndarray], np.ndarray],
              count: Callable[[Opened, np.ndarray], np.ndarray]) -> tuple[list, int]:
        """Files of a level and its number of n-grams; files of what it leaves of its contexts are written before."""
        kept, kept_at = _counted(texts, _codes(model, order), f"lm-{order}", model.total, LEAST)
        rest, rest_at = materialize(_shares(kept, model, count), f"lm-{order}-rest")
        rests = _written(rest, shards(rest.count()), "key", ["key", "p"], folder, f"rest{order}", _rest_file)
        setattr(model, f"rest{order - 1}", rests)

        def coded(key: np.ndarray, n: np.ndarray) -> list[bytes]:
            return _level_file(key >> bits, key & mask, weigh(model.opened(), key, n.astype(float)), n if order == 2 else None)
        rows = kept.count()
        files = _written(kept, shards(rows), "key", ["key", "n"], folder, f"order{order}", coded)
        drop_scratch(spark, kept_at, rest_at)
        return files, rows

    def two(m: Opened, key: np.ndarray, n: np.ndarray) -> np.ndarray:
        v, w = key >> bits, key & mask
        return (n - DISCOUNT) / m.count(v) + 10 ** m.rest(m.rest1, v) * m.unit(m.count(w))

    model.pairs, kept = level(2, two, lambda m, v: m.count(v))
    if kept.bit_length() + bits > 63:
        raise ValueError(f"{kept} pairs of {model.kinds} words: codes of three have no room in a long")

    def occurrences(m: Opened, uv: np.ndarray) -> np.ndarray:
        return _ranked(m.pairs, uv, lambda f, at: f.counts[at])

    def three(m: Opened, key: np.ndarray, n: np.ndarray) -> np.ndarray:
        uv, w = key >> bits, key & mask
        v = _ranked(m.pairs, uv, lambda f, at: f.word(at))
        return (n - DISCOUNT) / occurrences(m, uv) + 10 ** (m.rest(m.rest2, uv) + m.found(m.pairs, v << bits | w)[2])

    model.triples, _ = level(3, three, occurrences)
    return model, folder


def _score(batch: pa.RecordBatch, m: Opened) -> tuple[np.ndarray, ...]:
    """(tokens, known tokens, base score, model score) of each text."""
    bounds, count, ids, keep, left = m.read(batch, 1)
    base = np.log10(m.unit(count))
    n = len(ids)
    score = np.zeros(n)
    score[keep] = base
    score[1:] += left[:-1] * keep[1:]
    spots, code = m.pair(ids, keep)
    held, place, after = np.zeros(n, bool), np.zeros(n, np.int64), np.zeros(n)   # positions that end a kept pair
    found, place[spots], prob, after[spots] = m.found(m.pairs, code, m.rest2)
    held[spots] = found
    score[spots[found]] = prob[found]
    score[1:] += after[:-1] * keep[1:]
    spots, code = m.triple(ids, keep, held, place)
    found, _, prob, _ = m.found(m.triples, code)
    score[spots[found]] = prob[found]

    def per_text(x: np.ndarray) -> np.ndarray:
        return np.add.reduceat(x, bounds[:-1]) if len(x) else np.zeros(0)
    return np.diff(bounds), per_text((count > 0).astype(np.int64)), per_text(base), per_text(score[keep])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row: doc_id, n_tokens, n_known, train_tokens, base_score, score.

    Scores are log10 probabilities of the text's words (outside \\x20 \\x09-\\x0D,
    A-Z folded) and its end: base_score of the add-half word model, score of the
    n-gram model, whose unknown words have the word model's probability. Null
    and empty texts are an end alone. Rows stay as they are, repeated and null
    ids included; other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = model.opened()
        for whole in batches:
            for batch in slices(whole, 1):
                n, known, base, own = _score(batch, opened)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(n, pa.int64()), pa.array(known, pa.int64()),
                     pa.array(np.full(len(n), model.total), pa.int64()), pa.array(base, pa.float64()),
                     pa.array(own, pa.float64())],
                    names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")
