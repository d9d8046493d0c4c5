"""Near-duplicate embeddings by cross-polytope hashing.

A hash rotates a vector by three rounds of random signs and a fast Hadamard
transform, and names the coordinate of largest size with its sign: the
nearest vertex of the cross-polytope. A table's key joins ``K`` hashes. Each
vector enters its own bucket and, as probes, those in which one hash takes
the next-nearest vertex, the cheapest first. Pairs that share a bucket are
verified by cosine in double precision, in blocks; of a pair that shares
several buckets, the one with the least key counts it.

Equal vectors are one node with a count, so copies never meet in a bucket,
and a block returns degrees and a spanning forest, never its pairs. Buckets
are counted and dealt into blocks by node numbers alone; keys are computed
once and stored, and vectors, in the table's own type, join the entries that
share a bucket with another vector.

``K`` grows with the number of vectors (``hashes``), and ``TABLES`` with K,
so buckets stay small and recall high; the tests measure recall against
brute force.

Defined results: vectors that are null, empty, zero or hold null or
non-finite components link with nothing; vectors of different lengths never
link; repeated rows count as other vectors; a null vec_id takes part but
names no component unless its component has no other; other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heartwood.llm.common import store
from heartwood.llm.components import components
from heartwood.llm.simhash import chunked, forest

COSINE, PROBES, SEED, CHUNK, TILE = 0.95, 3, 7, 256, 2048
#: Tables for one, two, three, ... hashes a table.
TABLES = (3, 4, 8, 16)


def hashes(n: int, dim: int) -> int:
    """Hashes a table, so that n vectors of ``dim`` components fill about as many buckets."""
    k = 1
    while k < len(TABLES) and (2 * dim) ** k < n / 16:
        k += 1
    return k


def hadamard(x: np.ndarray) -> np.ndarray:
    """The orthonormal Walsh-Hadamard transform over the last axis, whose length is a power of two."""
    d = x.shape[-1]
    h = 1
    while h < d:
        y = x.reshape(*x.shape[:-1], d // (2 * h), 2, h)
        x = np.stack((y[..., 0, :] + y[..., 1, :], y[..., 0, :] - y[..., 1, :]), axis=-2).reshape(*x.shape[:-1], d)
        h *= 2
    return x / np.sqrt(d)


def bucket_keys(x: np.ndarray, k: int, tables: int, probes: int = PROBES, seed: int = SEED) -> np.ndarray:
    """(n, tables * probes) bucket keys of the rows of x."""
    n, dim = x.shape
    d = 1 << max(0, dim - 1).bit_length()
    rng = np.random.default_rng((seed, d))
    padded = np.zeros((n, d))
    padded[:, :dim] = x
    out = np.empty((n, tables, probes), np.uint64)
    rows = np.arange(n)
    for t in range(tables):
        codes, loss, second = [], [], []
        for _ in range(k):
            y = padded
            for _ in range(3):
                y = hadamard(y * rng.choice((-1.0, 1.0), d))
            size = np.abs(y)
            order = np.argsort(-size, axis=1, kind="stable")[:, : max(2, probes)]
            names = order * 2 + (np.take_along_axis(y, order, 1) < 0)
            top = np.take_along_axis(size, order, 1)
            codes.append(names[:, 0])
            second.append(names[:, 1:])
            loss.append((top[:, :1] - top[:, 1:]) ** 2)
        base = np.stack(codes, 1).astype(np.uint64)
        cost, alternative = np.concatenate(loss, 1), np.concatenate(second, 1).astype(np.uint64)
        width = second[0].shape[1]
        cheapest = np.argsort(cost, axis=1, kind="stable")[:, : probes - 1]
        for p in range(probes):
            key = base.copy()
            if p:
                # a vector of one or two components has fewer probes; it repeats its last
                at = cheapest[:, min(p, cheapest.shape[1]) - 1]
                key[rows, at // width] = alternative[rows, at]
            h = np.full(n, (t * 0x9E3779B97F4A7C15 + dim) & (2**64 - 1), np.uint64)
            for c in key.T:
                h = (h ^ (c + np.uint64(1))) * np.uint64(0xBF58476D1CE4E5B9)
                h ^= h >> np.uint64(29)
            out[:, t, p] = h
    return out.reshape(n, -1).view(np.int64)


def _vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column and the offsets of its rows."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False).astype(np.float64), offsets


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def usable(vector: str = "embedding", zero: bool = False) -> F.Column:
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    some = F.lit(True) if zero else F.exists(vector, lambda c: c != 0)
    return F.coalesce(F.col(vector).isNotNull() & ~bad & some, F.lit(False))


def _bucketed(nodes: DataFrame, n: int, k: int | None, tables: int | None, probes: int) -> DataFrame:
    """(node, keys) of every node."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values, offsets = _vectors(b.column(1))
            dims = np.diff(offsets)
            for dim in np.unique(dims):
                own = np.flatnonzero(dims == dim)
                kk = k or hashes(n, int(dim))
                x = _unit(np.stack([values[offsets[i]:offsets[i] + dim] for i in own]))
                keys = bucket_keys(x, kk, tables or TABLES[kk - 1], probes)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(own) + 1) * keys.shape[1], pa.int32()), pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(own)), lists], names=["node", "keys"])

    return nodes.select("node", "vector").mapInArrow(run, "node long, keys array<long>")


def _arrow_tiles(batches: Iterator[pa.RecordBatch], key: str, tile: int) -> Iterator[pa.Table]:
    """Whole groups of rows with equal ``key``, gathered to tables of about ``tile`` rows; input is sorted by key."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for b in batches:
        held.append(b)
        rows += b.num_rows
        if rows < tile:
            continue
        t = pa.Table.from_batches(held)
        ids = t.column(key).to_numpy()
        cut = int(np.searchsorted(ids, ids[-1]))
        if cut:
            yield t.slice(0, cut)
        rest = t.slice(cut).combine_chunks()
        held, rows = rest.to_batches(), rest.num_rows
    if rows:
        yield pa.Table.from_batches(held)


def link_blocks(nodes: DataFrame, n: int, cosine: float = COSINE, k: int | None = None, tables: int | None = None, probes: int = PROBES, chunk: int = CHUNK) -> DataFrame:
    """(u, v, n): a spanning forest of the links, with n null, and the degrees that blocks count, with v null."""
    keys = store(_bucketed(nodes, n, k, tables, probes), "vector-keys")
    dealt = chunked(keys.select("node", F.explode(F.array_distinct("keys")).alias("bucket")), chunk, "node")
    whole = store(nodes.join(keys, "node"), "vector-rows")
    blocks = dealt.join(whole, "node").repartition("block").sortWithinPartitions("block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _arrow_tiles(batches, "block", TILE):
            t = t.combine_chunks()
            block, node, copies, bucket = (t.column(c).to_numpy() for c in ("block", "node", "copies", "bucket"))
            mine, other, m = (t.column(c).to_numpy() for c in ("mine", "other", "m"))
            values, at = _vectors(t.column("vector"))
            lists = t.column("keys").combine_chunks()
            keys, key_at = lists.values.to_numpy(), lists.offsets.to_numpy()
            u, v, deg_node, deg = [], [], [], []
            edges = np.flatnonzero(np.diff(block)) + 1
            for s, e in zip(np.concatenate(([0], edges)), np.concatenate((edges, [len(block)])), strict=True):
                dims = np.diff(at[s:e + 1])
                for dim in np.unique(dims):  # vectors of different lengths share a block only where hashes collide
                    own = s + np.flatnonzero(dims == dim)
                    if len(own) < 2:
                        continue
                    x = _unit(values[at[own][:, None] + np.arange(dim)])
                    i, j = np.nonzero(np.triu(x @ x.T >= cosine, 1))
                    if not len(i):
                        continue
                    root = forest(i, j, len(own))
                    tied = np.flatnonzero(root != np.arange(len(own)))
                    u.append(node[own[tied]])
                    v.append(node[own[root[tied]]])
                    i, j = own[i], own[j]
                    # count a pair in one block of one bucket only
                    once = (mine[i] != mine[j]) | (m[i] == 1) | (other[i] == (mine[i] + 1) % m[i])
                    i, j = i[once], j[once]
                    least = np.full(len(i), np.iinfo(np.int64).max)
                    width = key_at[own[0] + 1] - key_at[own[0]]  # vectors of a length have equally many keys
                    for a in range(width):
                        for c in range(width):
                            ka = keys[key_at[i] + a]
                            least = np.where((ka == keys[key_at[j] + c]) & (ka < least), ka, least)
                    chosen = least == bucket[i]
                    i, j = i[chosen], j[chosen]
                    both, weight = np.concatenate((i, j)), np.concatenate((copies[j], copies[i]))
                    total = np.bincount(both - s, weights=weight, minlength=e - s).astype(np.int64)
                    deg_node.append(node[s:e][total > 0])
                    deg.append(total[total > 0])
            if u:
                fu, fv, dn, dg = (np.concatenate(z) for z in (u, v, deg_node, deg))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate((fu, dn))), pa.array(np.concatenate((fv, np.zeros(len(dn), np.int64))), mask=np.concatenate((np.zeros(len(fu), bool), np.ones(len(dn), bool)))),
                     pa.array(np.concatenate((np.zeros(len(fu), np.int64), dg)), mask=np.concatenate((np.ones(len(fu), bool), np.zeros(len(dn), bool))))], names=["u", "v", "n"])

    return blocks.select("block", "bucket", "node", "copies", "vector", "keys", "mine", "other", "m").mapInArrow(run, "u long, v long, n long")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, **tuning: int) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    rows = vectors.select("vec_id", F.col("embedding").alias("vector")).withColumn("ok", usable("vector"))
    good = rows.where("ok").select("vec_id", "vector")
    same = good.groupBy("vector").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"))
    nodes = store(same.select(F.monotonically_increasing_id().alias("node"), "copies", "vector", "least"), "vectors")
    found = store(link_blocks(nodes.select("node", "copies", "vector"), nodes.count(), cosine, **tuning), "vector-links")
    degrees = found.where("n is not null").groupBy("u").agg(F.sum("n").alias("linked"))
    roots = store(components(found.where("v is not null").select("u", "v")), "vector-components")
    merged = store(roots.join(nodes.select("node", "least"), "node").groupBy("root").agg(F.min("least").alias("component")), "vector-roots")
    named = roots.join(merged, "root").select("node", "component")
    info = nodes.join(degrees.withColumnRenamed("u", "node"), "node", "left").join(named, "node", "left")
    info = info.select("vector", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), F.coalesce("component", "least").alias("component_id"))
    # stored, so that the joins have two exchanges of their own, of which Spark can split a large partition
    info = store(info, "vector-info")
    linked = good.join(info, "vector").select("vec_id", "n_links", "component_id")
    alone = rows.where("not ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def brute_force(vectors: pd.DataFrame, cosine: float = COSINE) -> np.ndarray:
    """The full link matrix, for measuring recall on small tables."""
    x = _unit(np.stack(vectors["embedding"].to_numpy()).astype(np.float64))
    near = x @ x.T >= cosine
    np.fill_diagonal(near, False)
    return near
