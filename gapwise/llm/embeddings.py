"""Near-duplicate embeddings by cross-polytope hashing.

A unit vector is turned by pseudo-random rotations, each three rounds of a
random sign flip and a fast Walsh-Hadamard transform. The signed coordinate of
largest magnitude names the nearest vertex of the cross-polytope. A table's
bucket is the vertices of several rotations; multiprobe adds the buckets of
next-nearest vertices. Vectors that share a bucket are compared in blocks of
bounded size and verified by their cosine.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapwise.llm.graph import components
from gapwise.llm.words import U64, mix
from gapwise.runtime import drop_scratch, materialize

COSINE = 0.9
TABLES = 16
PROBES = 4
BLOCK = 200               # vectors of one side of a comparison
_ROUNDS = 3


def hadamard(x: np.ndarray) -> np.ndarray:
    """Orthonormal fast Walsh-Hadamard transform of each row (a power of two wide)."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack((x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]), axis=2).reshape(n, d)
        h *= 2
    return x / math.sqrt(d)


def rotation_count(n: int, dim: int) -> int:
    """Rotations for each table: about one bucket for every vector."""
    return max(2, 1 + int(math.log(max(n, 1)) / math.log(2 * _width(dim))))


def _width(dim: int) -> int:
    return max(2, 1 << (dim - 1).bit_length())


def buckets(unit: np.ndarray, rotations: int, tables: int = TABLES, probes: int = PROBES) -> np.ndarray:
    """(vectors, tables, probes) bucket keys; the first probe is the nearest vertices' bucket."""
    n, dim = unit.shape
    d = _width(dim)
    x = np.zeros((n, d))
    x[:, :dim] = unit
    out = np.empty((n, tables, probes), U64)
    depth = min(3, d)
    ways = np.array(list(product(range(depth), repeat=rotations)))
    ways = ways[np.argsort(ways.sum(1), kind="stable")][:64]
    rows = np.arange(n)[:, None]
    for t in range(tables):
        vertex = np.empty((n, rotations, depth), np.int64)
        loss = np.empty((n, rotations, depth))
        for j in range(rotations):
            signs = np.random.default_rng((t, j, d)).choice((-1.0, 1.0), (_ROUNDS, d))
            y = x
            for s in signs:
                y = hadamard(y * s)
            near = np.argsort(-np.abs(y), axis=1, kind="stable")[:, :depth]
            top = y[rows, near]
            vertex[:, j] = 2 * near + (top < 0)
            loss[:, j] = (np.abs(top[:, :1]) - np.abs(top)) ** 2
        cost = sum(loss[:, j][:, ways[:, j]] for j in range(rotations))
        best = np.argsort(cost, axis=1, kind="stable")[:, :probes]
        if best.shape[1] < probes:
            best = np.pad(best, ((0, 0), (0, probes - best.shape[1])), mode="edge")
        key = np.full((n, probes), (t + 1) * 0x9E3779B97F4A7C15 + dim & (1 << 64) - 1, U64)
        for j in range(rotations):
            key = mix(key * U64(0xD1B54A32D192ED03) + vertex[:, j][rows, ways[:, j][best]].astype(U64) + U64(1))
        out[:, t] = key
    return out


def _units(column: pa.Array) -> np.ndarray:
    """Unit rows of a list column whose lists are all of one length and neither zero nor non-finite."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _runs(lengths: np.ndarray) -> Iterator[slice]:
    """Runs of equal values."""
    cut = np.flatnonzero(np.diff(lengths)) + 1
    for a, b in zip([0, *cut], [*cut, len(lengths)]):
        if b > a:
            yield slice(int(a), int(b))


def _keys(n_vectors: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                part = whole.slice(at, 2000)
                sizes = np.array([len(v) for v in part.column(1)]) if part.num_rows else np.zeros(0, int)
                for run_of in _runs(sizes):
                    batch = part.slice(run_of.start, run_of.stop - run_of.start)
                    dim = int(sizes[run_of.start])
                    keys = buckets(_units(batch.column(1)), rotation_count(n_vectors, dim)).view(np.int64)
                    flat = keys.reshape(batch.num_rows, -1)
                    bounds = np.arange(batch.num_rows + 1, dtype=np.int32) * flat.shape[1]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0), batch.column(1), batch.column(2),
                         pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat.ravel()))],
                        names=["node", "embedding", "copies", "keys"])
    return run


def _labels(near: np.ndarray) -> np.ndarray:
    """Smallest row index reachable in a symmetric boolean matrix."""
    label = np.arange(len(near))
    while True:
        new = np.minimum(label, np.where(near, label[None, :], len(near)).min(axis=1, initial=len(near)))
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def _same_table(keys: np.ndarray, i: np.ndarray, j: np.ndarray, table: int, key: int) -> np.ndarray:
    """Pairs whose smallest shared bucket of this table is ``key``."""
    same = keys[i][:, table, :, None] == keys[j][:, table, None, :]
    least = np.where(same, keys[i][:, table, :, None], np.iinfo(np.int64).max).min(axis=(1, 2))
    return least == key


def _compare(probes: int, tables: int):
    def group(part: pa.RecordBatch):
        keys = part.column("keys").flatten().to_numpy().reshape(part.num_rows, tables, probes)
        node = part.column("node").to_numpy()
        side = part.column("side").to_numpy()
        copies = part.column("copies").to_numpy().astype(np.int64)
        unit = _units(part.column("embedding"))
        key, table = part.column("key")[0].as_py(), part.column("tab")[0].as_py()
        own = part.column("lo")[0].as_py() == part.column("hi")[0].as_py()
        near = unit @ unit.T >= COSINE
        if own:
            np.fill_diagonal(near, False)
        else:
            near &= side[:, None] != side[None, :]
        i, j = np.nonzero(np.triu(near))
        for a in range(0, len(i), 4096):
            p, q = i[a:a + 4096], j[a:a + 4096]
            drop = ~_same_table(keys, p, q, table, key)
            if table:
                drop |= (keys[p][:, :table, :, None] == keys[q][:, :table, None, :]).any(axis=(1, 2, 3))
            near[p[drop], q[drop]] = near[q[drop], p[drop]] = False
        some = np.flatnonzero(near.any(axis=1))
        label = _labels(near[np.ix_(some, some)])
        return node[some], near[some].astype(np.int64) @ copies, node[some[label]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None

        def done(batch: pa.RecordBatch, last: bool):
            """Links of the whole groups in a batch, and the rows of a group that may go on."""
            k = np.stack([batch.column(c).to_numpy() for c in ("key", "lo", "hi")])
            cut = np.flatnonzero((k[:, 1:] != k[:, :-1]).any(axis=0)) + 1
            cut = [0, *cut.tolist(), *([batch.num_rows] if last else [])]
            found = [group(batch.slice(a, b - a)) for a, b in zip(cut[:-1], cut[1:]) if b - a > 1]
            found = [x for x in found if len(x[0])]
            out = [np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0, np.int64)] * 3
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["node", "links", "near"]), \
                batch.slice(cut[-1])

        for batch in batches:
            if held is not None and held.num_rows:
                batch = pa.concat_batches([held, batch])
            if batch.num_rows:
                out, held = done(batch, False)
                yield out
        if held is not None and held.num_rows:
            yield done(held, True)[0]
    return run


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Per input row: vec_id, n_links, component_id, kept.

    Two vectors of one length are linked if their cosine in double precision is
    at least 0.9. n_links counts the other rows linked directly, component_id is
    the smallest vec_id reachable, kept marks it. Null, empty and zero vectors
    and those with a null or non-finite part are linked with nothing. Equal
    vectors are one node with a number of copies. Repeated vec_ids stay, a null
    vec_id names no component unless it is alone. An empty table gives no rows.
    Other columns are ignored.
    """
    v = F.col("embedding")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("embedding"))
    sound = F.coalesce(F.size(v) > 0, F.lit(False)) & F.forall(
        v, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False))) & F.exists(v, lambda x: x != 0)
    rows = rows.select("vec_id", F.when(sound, F.transform(v, lambda x: x + F.lit(0.0))).alias("embedding")) \
        .withColumn("node", F.when(F.col("embedding").isNotNull(), F.xxhash64("embedding")))
    nodes = (rows.where("node is not null").groupBy("node", "embedding")
             .agg(F.count("*").alias("copies"), F.min("vec_id").alias("first_vec")))
    nodes, nodes_at = materialize(nodes, "vec-nodes")
    keyed = nodes.select("node", "embedding", "copies").mapInArrow(
        _keys(nodes.count()), "node long, embedding array<double>, copies long, keys array<long>")
    keyed, keyed_at = materialize(keyed, "vec-keys")
    slots = (keyed.select("node", F.posexplode("keys").alias("pos", "key"))
             .groupBy("key", "node").agg(F.min("pos").alias("pos")))
    crowded = slots.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    members = slots.join(crowded, "key").select(
        "node", "key", (F.col("pos") / PROBES).cast("int").alias("tab"),
        F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks"))
    members = members.withColumn("side", F.pmod(F.xxhash64("node", "key"), F.col("blocks")).cast("int"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "node", "key", "tab", "side", F.least("side", "other").alias("lo"), F.greatest("side", "other").alias("hi"))
    blocks = members.join(keyed, "node")
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = (blocks.repartition(parts, "key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
             .mapInArrow(_compare(PROBES, TABLES), "node long, links long, near long"))
    found, found_at = materialize(found, "vec-links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("node").alias("a"), F.col("near").alias("b")))
    drop_scratch(vectors.sparkSession, keyed_at)
    placed = (nodes.select("node", "copies", "first_vec").join(roots, "node", "left").join(links, "node", "left")
              .select("node", "first_vec", F.coalesce("root", "node").alias("root"),
                      (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    least = placed.groupBy("root").agg(F.min("first_vec").alias("component"))
    named = placed.join(least, "root").select("node", "n_links", "component")
    return (rows.select("vec_id", "node").join(named, "node", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("component_id").isNull())))
