"""Near-duplicate documents by one-permutation MinHash.

One pass hashes each document's shingles once: the 64-bit range is cut into
bins and each bin keeps its smallest hash. Empty bins borrow from other bins
of the same document along a fixed probe sequence per bin (optimal
densification). Bands of the signature are bucket keys. Documents with equal
shingle sets are one node from then on. In every bucket of several components one
node is the centre of a star: first the one with most company in its buckets, then
one drawn by a hash of the node and the round alone, so that buckets of the same
texts agree on it. Pairs of a centre and a member are verified on the full shingle sets,
unless a sketch of long sets rules them out, and each pair once. Rounds go on while at
least one in a hundred of their pairs is a link. What still shares a bucket with
another component is joined exactly, on the rarest shingles of each text, which finds
all at once what further rounds would find one by one.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapwise.llm import joins
from gapwise.llm.graph import components
from gapwise.llm.words import U64, mix, shingle_sets, slices, text_buffers, word_hashes
from gapwise.runtime import drop_scratch, materialize

SHINGLE_WORDS = 5
THRESHOLD_PCT = 75
BANDS = 32
ROWS = 4
STAR = 256                 # members that are compared with their centre in one task, about
SKETCHED = 256             # shingles of a set that its sketch stands for; smaller ones are always compared
ALIKE = 64                 # of 128 bytes that sketches of linked sets share: 96 are expected at 75 %, with a deviation of 5
WORTH = 100                # pairs of a round for each link that it must find to be followed by another
HOT = 1000                 # rows of a shingle that are joined in one task, about

@cache
def _probe(t: int, bins: int) -> np.ndarray:
    """The bin that each empty bin tries in its t-th attempt."""
    i = np.arange(bins, dtype=U64) * U64(0x9E3779B97F4A7C15)
    turn = mix(np.array([t + 1], U64))
    return (mix(i + turn) % U64(bins)).astype(np.int64)


def signature(hashes: np.ndarray, bins: int = BANDS * ROWS) -> np.ndarray:
    """One-permutation MinHash of a sorted set, one value for each bin."""
    edges = (np.arange(1, bins, dtype=U64) * U64((1 << 64) // bins))
    cut = np.concatenate(([0], np.searchsorted(hashes, edges), [len(hashes)]))
    full = cut[1:] > cut[:-1]
    src = np.arange(bins)
    empty = np.flatnonzero(~full)
    t = 0
    while len(empty):
        tried = _probe(t, bins)[empty]
        hit = full[tried]
        src[empty[hit]] = tried[hit]
        empty = empty[~hit]
        t += 1
    return hashes[cut[:-1][src]]


def band_keys(sig: np.ndarray, bands: int = BANDS) -> np.ndarray:
    rows = sig.reshape(bands, -1)
    key = np.arange(1, bands + 1, dtype=U64) * U64(0xA24BAED4963EE407)
    for j in range(rows.shape[1]):
        key = mix(key + rows[:, j])
    return key


def _node(shingles: np.ndarray) -> int | None:
    """The name of a shingle set; None for the empty one."""
    if len(shingles):
        return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)
    return None


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, 1, 2 << 20):
            words, first = word_hashes(*text_buffers(batch.column(1)))
            sizes, nodes, keys, at, sketches = [], [], [], [0], []
            for s in shingle_sets(words, first, SHINGLE_WORDS):
                sizes.append(len(s))
                nodes.append(_node(s))
                sig = signature(s) if len(s) else None
                sketches.append(None if sig is None else (sig & U64(255)).astype(np.uint8).tobytes())
                if len(s):
                    keys.append(band_keys(sig))
                at.append(at[-1] + (BANDS if len(s) else 0))
            flat = np.concatenate(keys).view(np.int64) if keys else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat)), pa.array(sketches, pa.binary())],
                names=["doc_id", "n_shingles", "node", "keys", "sketch"])


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_shingles, node (hash of its shingle set, null if empty), keys (one for each band), sketch (a byte for each bin)."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        _sign, "doc_id long, n_shingles long, node long, keys array<long>, sketch binary")


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, 1, 1 << 20):
            words, first = word_hashes(*text_buffers(batch.column(1)))
            nodes, sets = [], []
            for node, s in zip(batch.column(0).to_pylist(), shingle_sets(words, first, SHINGLE_WORDS)):
                if _node(s) == node:          # a repeated doc_id may bring in another text
                    nodes.append(node)
                    sets.append(s.view(np.int64))
            at = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            flat = np.concatenate(sets) if sets else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.int64()), pa.ListArray.from_arrays(pa.array(at), pa.array(flat))],
                names=["node", "shingles"])


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs but for those of long sets whose sketches differ too much."""
    for batch in batches:
        one, two = (np.frombuffer(b"".join(c.to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in batch.columns[2:4])
        keep = ((one == two).sum(axis=1) >= ALIKE) | (batch.column(4).to_numpy() < SKETCHED)
        yield batch.select([0, 1]).filter(pa.array(keep))


def _verified(pairs: DataFrame, sets: DataFrame, sketches: DataFrame) -> DataFrame:
    """(a, b) of the pairs (node, centre) whose full shingle sets are similar enough.

    A centre of many members is dealt to several tasks, each of which gets its set
    and those of some members.
    """
    def of(end: str) -> DataFrame:
        return sketches.select(F.col("node").alias(end), F.col("sketch").alias(f"{end}_sketch"), F.col("size").alias(f"{end}_size"))
    likely = (pairs.join(of("node"), "node").join(of("centre"), "centre")
              .select("node", "centre", "node_sketch", "centre_sketch", F.least("node_size", "centre_size").alias("size"))
              .mapInArrow(_alike, "node long, centre long"))
    parts = likely.groupBy("centre").agg(F.ceil(F.count("*") / STAR).alias("parts"))
    members = (likely.join(parts, "centre").select("node", "centre", F.pmod(F.xxhash64("node"), "parts").alias("part"))
               .join(sets, "node").select("node", "centre", "part", F.col("shingles").alias("of_a")))
    centres = (parts.join(sets.select(F.col("node").alias("centre"), F.col("shingles").alias("of_b")), "centre")
               .select("centre", "of_b", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part")))
    same = F.size(F.array_intersect("of_a", "of_b"))
    return (members.join(centres, ["centre", "part"])
            .where(100 * same >= THRESHOLD_PCT * (F.size("of_a") + F.size("of_b") - same))
            .select(F.col("node").alias("a"), F.col("centre").alias("b")))


def _members(rows: DataFrame, name: str) -> tuple[DataFrame, str]:
    """(key, node, size, weight) of the nodes in buckets of several; weight is the population of a node's buckets."""
    crowded = rows.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    shared, at = materialize(rows.join(crowded, "key"), f"{name}-shared")
    weight = shared.groupBy("node").agg(F.sum("members").alias("weight"))
    out = materialize(shared.join(weight, "node").select("key", "node", "size", "weight"), name)
    drop_scratch(rows.sparkSession, at)
    return out


def _rooted(members: DataFrame, roots: DataFrame | None) -> DataFrame:
    if roots is None:
        return members.withColumn("root", F.col("node"))
    return members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _linked(members: DataFrame, sets: DataFrame, sketches: DataFrame) -> DataFrame | None:
    """(node, root) of all nodes that rounds of stars link; None without a link. :func:`_settled` finds the links that they leave."""
    spark, turn, roots, tried, folders = members.sparkSession, 0, None, None, []
    while True:
        pool = _rooted(members, roots)
        order = [F.xxhash64(F.lit(turn), "node").alias("h")] if turn else [F.col("weight")]
        stars = (pool.groupBy("key").agg(F.max(F.struct(*order, "node", "size", "root")).alias("c"), F.min("root").alias("least"), F.max("root").alias("most"))
                 .where("least <> most").select("key", F.col("c.node").alias("centre"), F.col("c.size").alias("centre_size"), F.col("c.root").alias("centre_root")))
        pairs = (pool.join(stars, "key").where((F.col("root") != F.col("centre_root")) & (
            100 * F.least("size", "centre_size") >= THRESHOLD_PCT * F.greatest("size", "centre_size"))).select("node", "centre").distinct())
        if tried is not None:
            pairs = pairs.join(tried, ["node", "centre"], "left_anti")
        pairs, pairs_at = materialize(pairs, "minhash-pairs")
        found, at = materialize(_verified(pairs, sets, sketches), "minhash-links")
        links = found.count()
        if links:
            roots = _joined(roots, found)
        drop_scratch(spark, at)
        folders.append(pairs_at)
        if WORTH * links <= pairs.count():
            drop_scratch(spark, *folders)
            return roots
        both = pairs.union(pairs.select("centre", "node"))
        tried = both if tried is None else tried.union(both)
        turn += 1


def _joined(roots: DataFrame | None, found: DataFrame) -> DataFrame:
    """The components after more links; those so far are as good as all their links."""
    known = [] if roots is None else [roots.select(F.col("root").alias("a"), F.col("node").alias("b"))]
    return components(reduce(DataFrame.union, known, found))


def _settled(unsettled: DataFrame, sets: DataFrame, sketches: DataFrame, roots: DataFrame | None) -> DataFrame | None:
    """``roots`` with every link between different components of the ``unsettled`` nodes (node).

    Exact, by prefixes: shingles are ordered from rare to frequent. Of two sets
    that share at least c of n and m shingles, the first shared one is among the
    first n - c + 1 and m - c + 1. For each shingle only pairs with a node
    outside its commonest component are formed; those of a frequent shingle in several
    tasks.
    """
    spark = sets.sparkSession
    each = sets.join(unsettled, "node").select("node", F.size("shingles").cast("long").alias("size"), F.explode("shingles").alias("token"))
    shared = each.groupBy("token").agg(F.count("*").alias("n")).where("n > 1")
    ranked = (each.join(shared, "token").groupBy("node", "size").agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("tokens"))
              .withColumn("alone", F.col("size") - F.size("tokens")))      # shingles of no other node come first
    reach = F.floor(F.col("size") * (100 - THRESHOLD_PCT) / 100) + 1 - F.col("alone")
    prefix = (_rooted(ranked, roots).where(reach > 0)
              .select("node", "size", "root", "alone", F.posexplode(F.slice("tokens", F.lit(1), reach.cast("int"))).alias("pos", "of"))
              .select("node", "size", "root", (F.col("alone") + F.col("pos")).alias("pos"), F.col("of.token").alias("token")))
    prefix, prefix_at = materialize(prefix, "minhash-prefix")
    mixed = (prefix.groupBy("token", "root").agg(F.count("*").alias("n")).groupBy("token")
             .agg(F.max(F.struct("n", "root")).alias("main"), F.count("*").alias("roots"), F.ceil(F.sum("n") / HOT).alias("parts")).where("roots > 1")
             .select("token", F.col("main.root").alias("main"), "parts"))
    open_, open_at = materialize(prefix.join(mixed, "token").withColumn("part", F.pmod(F.xxhash64("node"), "parts")), "minhash-open")
    one = open_.where("root <> main").select("token", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"),
                                             *[F.col(c).alias(f"{c}_1") for c in ("node", "size", "root", "pos")])
    sum_ = F.col("size") + F.col("size_1")
    need = F.ceil(THRESHOLD_PCT * sum_ / (100 + THRESHOLD_PCT) - 1e-6)     # shingles that a link shares at least
    pairs = (open_.join(one, ["token", "part"]).where((F.col("root") != F.col("root_1")) & (F.col("pos") + need <= F.col("size"))
                                            & (F.col("pos_1") + need <= F.col("size_1")))
             .select(F.least("node", "node_1").alias("node"), F.greatest("node", "node_1").alias("centre")).distinct())
    pairs, pairs_at = materialize(pairs, "minhash-pairs")
    found, found_at = materialize(_verified(pairs, sets, sketches), "minhash-links")
    if found.limit(1).count():
        roots = _joined(roots, found)
    drop_scratch(spark, prefix_at, open_at, pairs_at, found_at)
    return roots


def _mixed(members: DataFrame, roots: DataFrame | None) -> tuple[DataFrame, str]:
    """The nodes (node) in buckets of several components and more than two members, and the folder that holds them."""
    keys = (_rooted(members, roots).groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b"), F.count("*").alias("n"))
            .where("a <> b and n > 2").select("key"))
    return materialize(members.join(keys, "key").select("node").distinct(), "minhash-unsettled")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row: doc_id, n_shingles, component_id, kept.

    Rows of texts with equal shingle sets are linked; other texts are linked if
    100 * intersection >= 75 * union of their sets of distinct five-word
    shingles (A-Z folded to a-z; fewer words: the whole sequence). component_id
    is the smallest doc_id reachable; kept marks it. Null and wordless texts
    are linked with nothing and kept. Rows that repeat a doc_id stay, each with
    its own text's component. A row with a null doc_id is linked by equal sets
    only, and kept if its component has no id. Other columns are ignored. An
    empty table gives no rows.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signed, signed_at = materialize(signatures(texts), "minhash")
    nodes = (signed.where("node is not null").groupBy("node")
             .agg(F.min("doc_id").alias("first_doc"), F.first("n_shingles").alias("size"), F.first("keys").alias("keys"), F.first("sketch").alias("sketch")))
    nodes, nodes_at = materialize(nodes, "minhash-nodes")
    signed, _ = materialize(signed.select("doc_id", "n_shingles", "node"), "minhash-docs")
    drop_scratch(spark, signed_at)
    rows = nodes.select("node", "size", F.explode("keys").alias("key"))
    members, members_at = _members(rows, "minhash-members")
    wanted = members.select("node").distinct().join(nodes, "node").select("node", F.col("first_doc").alias("doc_id"), "size", "sketch")
    sketches, sketches_at = materialize(wanted, "minhash-sketches")
    nodes, _ = materialize(nodes.select("node", "first_doc"), "minhash-nodes")
    drop_scratch(spark, nodes_at)
    few = joins.sieved(texts, "doc_id", sketches)
    sets, sets_at = materialize(few.join(sketches.select("node", "doc_id"), "doc_id").select("node", "text")
                                .mapInArrow(_sets, "node long, shingles array<long>"), "minhash-sets")
    roots = _linked(members, sets, sketches)
    unsettled, unsettled_at = _mixed(members, roots)
    if unsettled.limit(1).count():
        roots = _settled(unsettled, sets, sketches, roots)
    drop_scratch(spark, members_at, unsettled_at, sketches_at, sets_at)
    named = nodes.select("node", F.col("first_doc").alias("component"))
    if roots is not None:
        placed = nodes.select("node", "first_doc").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        least = placed.groupBy("root").agg(F.min("first_doc").alias("component"))
        named = placed.join(least, "root").select("node", "component")
    return (signed.select("doc_id", "n_shingles", "node").join(named, "node", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, with one document of each group of near-duplicates.

    An id with several rows stays if one of them is kept; of its rows that repeat
    the text, too, one stays. Rows with a null id are one such id.
    """
    spark = docs.sparkSession
    own = f"id_{uuid.uuid4().hex}"              # no column of the documents
    ids = (near_duplicates(docs, id_col, text_col).groupBy(F.col("doc_id").alias(own))
           .agg(F.max("kept").alias("kept"), F.count("*").alias("rows")))
    ids, at = materialize(ids, "minhash-ids")
    gone, _ = materialize(ids.where("not kept").select(own), "minhash-gone")
    twice, _ = materialize(ids.where("kept and rows > 1").select(own), "minhash-twice")
    drop_scratch(spark, at)
    same = F.col(id_col).cast("long").eqNullSafe(F.col(own))
    left = docs.join(joins.sized(gone), same, "left_anti")
    if not twice.limit(1).count():
        return left
    twice = joins.sized(twice)
    return left.join(twice, same, "left_anti").unionByName(
        left.join(twice, same, "left_semi").dropDuplicates([id_col, text_col]))
