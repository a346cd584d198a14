"""Ranked lexical search over an inverted index in shards, by Block-Max MaxScore.

Index: a task turns about 16 MB of text at a time into a shard, one row. It holds the
documents by ascending id, their lengths, the hashes of all terms, and for each term its
postings in blocks of 128: gaps between documents and occurrences in as many bytes as
the block needs, and per block its last document, most occurrences and least length.
Weights and lengths' influence follow from totals over all shards, so that shards can be
added at any time.

Search: a task takes shard by shard and keeps the best of each query, so that later
shards start from a threshold. In a shard, lists whose bounds together stay below it
are non-essential. Documents of the essential lists are the candidates; block maxima of the
other lists reject most of them before a block is unpacked, and the rest are scored list
by list, best bounds first. The tasks' bests are merged by query.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gapwise.llm.words import slices, text_buffers, word_hashes
from gapwise.runtime import materialize

BLOCK = 128
WINDOW = 4096              # documents that are scored at once
SHARD_BYTES = 16 << 20     # of text, about
BATCH_TERMS = 1 << 18      # of the queries that are answered in one pass over the index, about
_SCALE = 1_000_000_000

_TERM = np.full(256, 0x20, np.uint8)       # bytes outside terms become spaces
for _part in (range(0x30, 0x3A), range(0x41, 0x5B), range(0x61, 0x7B), range(0x80, 0x100)):
    _TERM[list(_part)] = list(_part)


def terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the terms of all texts and the bounds of the texts; null has none.

    A term is a maximal run of ASCII letters, digits and other than ASCII characters; A-Z count as a-z.
    """
    buf, bounds = text_buffers(column)
    found, first = word_hashes(_TERM[buf], bounds)
    return found.view(np.int64), first


# --------------------------------------------------------------------------- index

_WIDTHS = (np.uint8, np.uint16, np.uint32)
_PARTS = ("ids", "nulls", "lengths", "terms", "lists", "blocks", "last", "most", "least", "gap_at", "gap_1", "gap_2", "gap_4",
          "tf_at", "tf_1", "tf_2", "tf_4")
INDEX = "documents long, total long, n_terms binary, " + ", ".join(f"{p} binary" for p in _PARTS)


def _packed(values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Blocks of values in the narrowest of three widths: per block (place << 2 | width), and a stream for each width."""
    width = np.searchsorted([0xFF, 0xFFFF], np.maximum.reduceat(values, starts)) if len(starts) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(starts, len(values)))
    place, streams = np.zeros(len(starts), np.int64), []
    each = np.repeat(width, sizes)
    for w, kind in enumerate(_WIDTHS):
        mine = width == w
        place[mine] = np.cumsum(sizes[mine]) - sizes[mine]
        streams.append(values[each == w].astype(kind))
    return place << 2 | width, streams


def shard(ids: list[int | None], hashes: np.ndarray, lengths: np.ndarray) -> dict[str, object]:
    """The index row of documents; ``hashes`` are their terms, document after document."""
    null = np.array([i is None for i in ids], bool)
    key = np.array([0 if i is None else i for i in ids], np.int64)
    order = np.lexsort((key, null))                   # null ids come last
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    document = np.repeat(rank, lengths)
    by = np.lexsort((document, hashes))
    term, document = hashes[by], document[by]
    fresh = np.ones(len(term), bool)
    fresh[1:] = (term[1:] != term[:-1]) | (document[1:] != document[:-1])
    at = np.flatnonzero(fresh)
    tf = np.diff(np.append(at, len(term)))
    term, document = term[at], document[at]
    new = np.ones(len(term), bool)
    new[1:] = term[1:] != term[:-1]
    lists = np.flatnonzero(new)
    inside = np.arange(len(term)) - np.repeat(lists, np.diff(np.append(lists, len(term))))
    blocks = np.flatnonzero(inside % BLOCK == 0)
    gap = document - np.concatenate(([0], document[:-1]))[: len(document)]
    gap[new] = document[new]
    lengths = lengths[order]
    gap_at, gaps = _packed(gap, blocks)
    tf_at, tfs = _packed(tf, blocks)
    ends = np.append(blocks[1:], len(term))[: len(blocks)]
    parts = {"ids": key[order], "nulls": null[order], "lengths": lengths.astype(np.int64), "terms": term[lists], "lists": lists.astype(np.int64),
             "blocks": blocks.astype(np.int64), "last": document[ends - 1], "most": np.maximum.reduceat(tf, blocks) if len(blocks) else tf,
             "least": np.minimum.reduceat(lengths[document], blocks) if len(blocks) else tf, "gap_at": gap_at, "tf_at": tf_at,
             **{f"gap_{w.itemsize}": g for w, g in zip(map(np.dtype, _WIDTHS), gaps)},
             **{f"tf_{w.itemsize}": t for w, t in zip(map(np.dtype, _WIDTHS), tfs)}}
    sizes = np.diff(np.append(lists, len(term)))
    return {"documents": int((lengths > 0).sum()), "total": int(lengths.sum()), "n_terms": sizes.astype(np.int64).tobytes(),
            **{p: np.ascontiguousarray(parts[p]).tobytes() for p in _PARTS}}


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, str]:
    """The index of all texts, one row for each shard, and the folder that holds it. Rows of an index may be added to another's."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string
    arrow = to_arrow_schema(_parse_datatype_string(INDEX))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, hashes, lengths, size = [], [], [], 0

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([shard(ids, np.concatenate(hashes), np.concatenate(lengths))], schema=arrow)
        for whole in batches:
            for batch in slices(whole, 1):
                found, first = terms(batch.column(1))
                ids += batch.column(0).to_pylist()
                hashes.append(found)
                lengths.append(np.diff(first))
                size += batch.column(1).nbytes
                if size >= SHARD_BYTES:
                    yield row()
                    ids, hashes, lengths, size = [], [], [], 0
        if ids:
            yield row()
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return materialize(texts.mapInArrow(run, INDEX), "index")


# --------------------------------------------------------------------------- search

class Shard:
    """A shard's lists as arrays; postings stay packed until asked for."""

    def __init__(self, row: dict[str, bytes], n: int, total: int):
        for p in _PARTS:
            kind = {"nulls": bool, "gap_1": np.uint8, "gap_2": np.uint16, "gap_4": np.uint32, "tf_1": np.uint8, "tf_2": np.uint16,
                    "tf_4": np.uint32}.get(p, np.int64)
            setattr(self, p, np.frombuffer(row[p], kind))
        self.gaps, self.tfs = (self.gap_1, self.gap_2, self.gap_4), (self.tf_1, self.tf_2, self.tf_4)
        self.n, self.total = n, total
        self.norm = self.norms(self.lengths)

    def norms(self, lengths: np.ndarray) -> np.ndarray:
        """Eight times what a document's length weighs against its occurrences."""
        return 8 * (25 + 75 * lengths * self.n // max(1, self.total))

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The list of each term, -1 without one."""
        at = np.searchsorted(self.terms, hashes)
        at[at == len(self.terms)] = 0
        return np.where(self.terms[at] == hashes, at, -1) if len(self.terms) else np.full(len(hashes), -1)

    def blocks_of(self, k: int) -> slice:
        a = int(self.lists[k])
        b = int(self.lists[k + 1]) if k + 1 < len(self.lists) else None
        lo = int(np.searchsorted(self.blocks, a))
        return slice(lo, len(self.blocks) if b is None else int(np.searchsorted(self.blocks, b)))

    def unpack(self, block: int, first: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and what each adds, before the weight, of a block of the list whose first block is ``first``."""
        size = int((self.blocks[block + 1] if block + 1 < len(self.blocks) else self.postings()) - self.blocks[block])
        at, tf_at = int(self.gap_at[block]), int(self.tf_at[block])
        gap = self.gaps[at & 3][at >> 2: (at >> 2) + size].astype(np.int64)
        tf = self.tfs[tf_at & 3][tf_at >> 2: (tf_at >> 2) + size].astype(np.int64)
        document = np.cumsum(gap)
        if block > first:
            document += self.last[block - 1]
        return document, _SCALE * tf // (1000 * tf + self.norm[document])

    def postings(self) -> int:
        return sum(map(len, self.gaps))


class _List:
    """A query term's list in a shard with the bounds of its blocks."""

    def __init__(self, of: Shard, k: int, weight: int):
        own = of.blocks_of(k)
        self.of, self.weight, self.first, self.last = of, weight, own.start, of.last[own]
        most = of.most[own]
        self.bounds = weight * (_SCALE * most // (1000 * most + of.norms(of.least[own])))
        self.bound = int(self.bounds.max())

    def block(self, document: np.ndarray) -> np.ndarray:
        """The block that may hold each document; one past the last where none does."""
        return np.searchsorted(self.last, document)

    def unpack(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        document, share = self.of.unpack(self.first + b, self.first)
        return document, self.weight * share


class Best:
    """The k best (score, id) of a query so far; of equal scores the smallest ids, null ids last."""

    def __init__(self, k: int):
        self.k = k
        self.score, self.id, self.null = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    @property
    def least(self) -> int:
        """What a document needs at least; equal scores may still win by their id."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, id: np.ndarray, null: np.ndarray) -> None:
        enough = score >= self.least
        score, id, null = (np.concatenate(x) for x in ((self.score, score[enough]), (self.id, id[enough]), (self.null, null[enough])))
        top = np.lexsort((id, null, -score))[: self.k]
        self.score, self.id, self.null = score[top], id[top], null[top]


def search_shard(of: Shard, found: np.ndarray, weights: np.ndarray, best: Best) -> int:
    """Bring a shard's documents into a query's best; the number of blocks that were unpacked.

    ``found`` are the lists of the query's terms, ``weights`` what each term weighs, repeats included.
    """
    lists = sorted((_List(of, int(k), int(w)) for k, w in zip(found, weights) if k >= 0 and w > 0), key=lambda x: x.bound)
    sums = np.cumsum([x.bound for x in lists])
    unpacked = 0
    for begin in range(0, len(of.ids), WINDOW):
        end = min(begin + WINDOW, len(of.ids))
        split = int(np.searchsorted(sums, best.least))     # lists before it cannot reach the threshold together
        if split == len(lists):
            break
        total = np.zeros(end - begin, np.int64)
        for x in lists[split:]:
            for b in range(int(x.block(begin)), min(int(x.block(end - 1)) + 1, len(x.last))):
                document, share = x.unpack(b)
                unpacked += 1
                inside = (document >= begin) & (document < end)
                total[document[inside] - begin] += share[inside]
        document = np.flatnonzero(total)
        total = total[document]
        document += begin
        rest = lists[:split][::-1]
        places = [x.block(document) for x in rest]
        bounds = [np.append(x.bounds, 0)[p] for x, p in zip(rest, places)]
        limit = total + sum(bounds)
        for k, x in enumerate(rest):
            alive = limit >= best.least
            if not alive.all():
                document, total, limit = document[alive], total[alive], limit[alive]
                places, bounds = [p[alive] for p in places], [c[alive] for c in bounds]
            if not len(document):
                break
            limit -= bounds[k]
            for b in np.unique(places[k][bounds[k] > 0]):
                mine = np.flatnonzero(places[k] == b)
                held, share = x.unpack(int(b))
                unpacked += 1
                at = np.searchsorted(held, document[mine])
                hit = held[at] == document[mine]
                total[mine[hit]] += share[at[hit]]
                limit[mine[hit]] += share[at[hit]]
        if len(document):
            best.add(total, of.ids[document], of.nulls[document])
    return unpacked


def _queries(items: DataFrame, n: int, spread: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(query, distinct terms, repeats) of the n-th of ``spread`` parts of the queries, at the driver."""
    out = []
    table = items.where((F.col("query") % spread) == n).select("query", "text").toArrow()
    found, first = terms(table.column("text").combine_chunks() if table.num_rows else pa.array([], pa.string()))
    for q, a, b in zip(table.column("query").to_pylist(), first[:-1], first[1:]):
        out.append((q, *np.unique(found[a:b], return_counts=True)))
    return out


def _frequencies(index: DataFrame, wanted: np.ndarray) -> np.ndarray:
    """Documents that hold each of the wanted terms, over all shards."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(wanted), np.int64)
        for batch in batches:
            for own, sizes in zip(*(c.to_pylist() for c in batch.columns)):
                own, sizes = np.frombuffer(own, np.int64), np.frombuffer(sizes, np.int64)
                at = np.searchsorted(own, wanted)
                at[at == len(own)] = 0
                if len(own):
                    counts += np.where(own[at] == wanted, sizes[at], 0)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["term", "n"])
    rows = (index.select("terms", "n_terms").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect())
    out = np.zeros(len(wanted), np.int64)
    for r in rows:
        out[r["term"]] = r["n"]
    return out


def search(index: DataFrame, items: DataFrame, k: int = 10, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each query, scores above zero only.

    score sums w * ((10**9 * tf) div (1000 * tf + 8 * m)) over the query's terms with
    repeats: tf the term's occurrences in the document, w = floor(1000 ln((2N + 2) /
    (2 df + 1))), m = 25 + (75 n N) div L; N documents with a term, L terms of all, n of
    the document, df documents with the term. Equal scores rank by ascending doc_id,
    null ids last. Each row of ``items`` is a query, repeated and null ids included;
    a null text, or one without terms, finds nothing. Queries are answered in parts
    of about ``BATCH_TERMS`` terms, with a pass over the index for each part; what a
    task holds is one shard and the bests of a part.
    """
    spark = index.sparkSession
    size = index.agg(F.sum("documents"), F.sum("total")).first()
    n, total = int(size[0] or 0), int(size[1] or 0)
    asked, _ = materialize(items.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text"))
                           .withColumn("query", F.monotonically_increasing_id()), "queries")
    spread = int(asked.agg(F.sum(F.length("text"))).first()[0] or 0) // (4 * BATCH_TERMS) + 1
    parts = []
    for part in range(spread):
        own = [(q, t, c) for q, t, c in _queries(asked, part, spread) if len(t)]
        wanted = np.unique(np.concatenate([t for _, t, _ in own])) if own else np.zeros(0, np.int64)
        df = _frequencies(index, wanted)
        weight = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * int(d) + 1))) if d else 0 for d in df], np.int64)
        asks = [(q, at, weight[at] * c) for q, t, c in own for at in [np.searchsorted(wanted, t)]]
        parts.append(_searched(index, wanted, asks, n, total, k))
    best = parts[0]
    for more in parts[1:]:
        best = best.unionByName(more)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return asked.select("query", "item_id").join(ranked, "query").select("item_id", "rank", "doc_id", "score")


def _searched(index: DataFrame, wanted: np.ndarray, asks: list[tuple[int, np.ndarray, np.ndarray]], n: int, total: int, k: int) -> DataFrame:
    """(query, doc_id, score): the best of each query in each task's shards."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bests = [Best(k) for _ in asks]
        for batch in batches:
            for i in range(batch.num_rows):
                of = Shard({name: batch.column(c)[i].as_buffer() for c, name in enumerate(batch.schema.names)}, n, total)
                lists = of.find(wanted)
                for (_, at, weights), best in zip(asks, bests):
                    search_shard(of, lists[at], weights, best)
        query = np.repeat(np.array([q for q, _, _ in asks], np.int64), [len(b.score) for b in bests])
        ids, nulls, scores = (np.concatenate([getattr(b, c) for b in bests] or [np.zeros(0, np.int64)]) for c in ("id", "null", "score"))
        yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(ids.astype(np.int64), mask=nulls.astype(bool)), pa.array(scores.astype(np.int64))],
                                         names=["query", "doc_id", "score"])
    return index.select(*_PARTS).mapInArrow(run, "query long, doc_id long, score long")
