"""SimHash near-duplicates with bit-sliced comparison.

``near_duplicates`` links close fingerprints; ``deduplicate`` keeps one text of
each class of near copies, for which fingerprints within a wider radius are
only candidates that whole shingle sets decide.

A document's fingerprint has 64 bits; bit b is 1 if more than half of its
word shingles' hashes have it set. Two fingerprints link if they differ in at
most ``RADIUS`` bits. By the pigeonhole principle, linked fingerprints agree
on BANDS - RADIUS of BANDS bit bands, so each fingerprint enters one bucket
for every such choice of bands; buckets of more than ``CHUNK`` fingerprints
are dealt into chunks and every pair of chunks is compared once.

Comparison is bit-sliced: 64 fingerprints of a block stand in one machine
word per bit (plane). A probe adds its difference to the plane, bit by bit,
into carry-save counters (one for each bit of the radius, and a sticky
overflow), which counts 64 distances at once; a block is abandoned as soon as all its lanes exceed the
radius. Only a spanning forest of a block's links leaves the task, so a group
of copies costs edges in proportion to its size.

Defined results: null, empty and blank texts have fingerprint zero, linked
like any other; a null doc_id never becomes a component_id unless its whole
component has none; repeated rows share a component; other columns are not
read by ``near_duplicates``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heartwood.llm import shingles
from heartwood.llm.common import anew, release, small_batches, store
from heartwood.llm.components import components

RADIUS, BANDS, WORDS, SEED = 2, 4, 3, 42
#: Near copies: the least similarity of shingle sets, and the most of 128 bits that their fingerprints differ in.
LEAST, NEAR_RADIUS, NEAR_CHUNK = (4, 5), 40, 128
#: Fingerprints of a bucket that are compared in one block; rows that a tile of whole groups holds at most.
CHUNK, TILE = 512, 4096


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """The fingerprint of a text: words are lower-cased over A-Z and split at ASCII white space."""
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    if len(parts) < words:
        hashes = [xxhash.xxh64_intdigest(b" ".join(parts), SEED)]
    else:
        flat = b" ".join(parts)
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
        starts = np.concatenate(([0], ends[:-words] + 1)).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(flat[a:b], SEED) for a, b in zip(starts, ends[words - 1:].tolist(), strict=True)]
    h = np.array(hashes, np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 14):
        ones += np.unpackbits(h[i:i + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, fp long) of every document; fp holds the 64 bits as a signed integer."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), words) for t in b.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fp long")


def _planes(fps: np.ndarray) -> np.ndarray:
    """Bit planes (64, words) of fingerprints: bit i of word w of plane b is bit b of fingerprint 64 w + i."""
    n = -(-len(fps) // 64) * 64
    padded = np.zeros(n, np.uint64)
    padded[: len(fps)] = fps
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view(np.uint64)


def compare(fps: np.ndarray, first: np.ndarray, last: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i, j), i < j, within ``radius`` bits; row i of ``fps`` (64-bit words) is compared with the rows first[i] <= j < last[i].

    The counters hold the bits of 64 distances at once: adding a plane's
    differences carries from one counter into the next, and what leaves the
    last one is beyond the radius for good.
    """
    fps = fps.reshape(len(fps), -1)
    planes = np.concatenate([_planes(np.ascontiguousarray(c)) for c in fps.T])
    full = np.uint64(2**64 - 1)
    w0, w1 = first // 64, (last - 1) // 64
    count = w1 - w0 + 1
    probe = np.repeat(np.arange(len(fps)), count)
    word = np.arange(len(probe)) - np.repeat(np.cumsum(count) - count, count) + w0[probe]
    # lanes outside the probe's group count as beyond the radius from the start
    lo, hi = np.clip(first[probe] - 64 * word, 0, 64).astype(np.uint64), np.clip(last[probe] - 64 * word, 0, 64).astype(np.uint64)
    below = lambda n: np.where(n >= 64, full, (np.uint64(1) << np.minimum(n, np.uint64(63))) - np.uint64(1))
    dead = ~(below(hi) & ~below(lo))
    counters = [np.zeros_like(dead) for _ in range(radius.bit_length())]
    sign = np.concatenate([(np.uint64(0) - ((c[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1))).T for c in fps.T])

    def beyond() -> np.ndarray:
        over, level = dead, full
        for k in reversed(range(len(counters))):
            if radius >> k & 1:
                level = level & counters[k]
            else:
                over, level = over | level & counters[k], level & ~counters[k]
        return over

    look = 4 if radius < 8 else 16
    for b in range(len(planes)):
        x = planes[b, word] ^ sign[b, probe]
        for k, c in enumerate(counters):
            counters[k], x = c ^ x, c & x
        dead = dead | x
        if b % look == look - 1:
            live = beyond() != full
            if not live.all():
                probe, word, dead, counters = probe[live], word[live], dead[live], [c[live] for c in counters]
                if not len(probe):
                    break
    hits = np.unpackbits((~beyond()).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    k, lane = np.nonzero(hits)
    i, j = probe[k], 64 * word[k] + lane
    keep = i < j
    return i[keep], j[keep]


def forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """For links (i, j) among n rows, the least row that each row reaches."""
    root = np.arange(n)
    while len(i):
        a, b = root[i], root[j]
        differ = a != b
        if not differ.any():
            break
        i, j, a, b = i[differ], j[differ], a[differ], b[differ]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root != (up := root[root])).any():
            root = up
    return root


def _tiles(batches: Iterator[pd.DataFrame], key: str, tile: int) -> Iterator[pd.DataFrame]:
    """Whole groups of rows with equal ``key``, gathered to tiles of about ``tile`` rows; input is sorted by key."""
    held: list[pd.DataFrame] = []
    rows = 0
    for b in batches:
        held.append(b)
        rows += len(b)
        if rows < tile:
            continue
        t = pd.concat(held, ignore_index=True)
        ids = t[key].to_numpy()
        cut = int(np.searchsorted(ids, ids[-1]))  # the last group may go on
        if cut:
            yield t.iloc[:cut]
        held, rows = [t.iloc[cut:]], len(t) - cut
    if rows:
        yield pd.concat(held, ignore_index=True)


def chunked(keyed: DataFrame, chunk: int, spread: str) -> DataFrame:
    """Deal buckets into blocks to compare: adds block, m, mine and other to ``keyed`` (bucket, ...).

    A bucket of one row goes. One of up to ``chunk`` rows is one block (m is
    1). A larger one is dealt by ``spread`` into m chunks, with a block for
    every pair (mine, other) of chunks, so a block holds about two chunks at
    most. Rows of one chunk meet in every block of that chunk; to count a
    pair once, count those only where other is (mine + 1) mod m. ``block`` is
    a 64-bit hash; blocks that collide are only compared in vain.
    """
    sizes = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # dealt anew, so that Spark can split the partition of a frequent bucket
    sizes = sizes.select(anew("bucket").alias("b"), "n")
    rows = keyed.join(sizes, F.col("bucket") == F.col("b")).drop("b").withColumn("m", F.ceil(F.col("n") / chunk).cast("int"))
    rows = rows.withColumn("mine", F.pmod(F.xxhash64(spread, F.lit(1)), "m").cast("int")).drop("n")
    others = F.filter(F.sequence(F.lit(0), F.col("m") - 1), lambda o: (o != F.col("mine")) | (F.col("m") == 1))
    return rows.withColumn("other", F.explode(others)).withColumn("block", F.xxhash64("bucket", F.least("mine", "other"), F.greatest("mine", "other")))


def links(fps: DataFrame, radius: int = RADIUS, bands: int = BANDS, chunk: int = CHUNK) -> DataFrame:
    """(u, v): a spanning forest of the links among distinct fingerprints ``fps`` (fp)."""
    cuts = [64 * i // bands for i in range(bands + 1)]
    keys = []
    for c, chosen in enumerate(combinations(range(bands), bands - radius)):
        mask = sum(((1 << cuts[b + 1]) - (1 << cuts[b])) for b in chosen)
        keys.append(F.xxhash64(F.lit(c), F.col("fp").bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask))))
    keyed = fps.select("fp", F.explode(F.array(*keys)).alias("bucket"))
    blocks = chunked(keyed, chunk, "fp").select("block", "fp").repartition("block").sortWithinPartitions("block")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in _tiles(batches, "block", TILE):
            block, values = t["block"].to_numpy(), t["fp"].to_numpy()
            first, last = np.searchsorted(block, block, "left"), np.searchsorted(block, block, "right")
            i, j = compare(values.view(np.uint64), first, last, radius)
            root = forest(i, j, len(values))
            tied = root != np.arange(len(values))
            yield pd.DataFrame({"u": values[tied], "v": values[root[tied]]})

    return blocks.mapInPandas(run, "u long, v long")


def _classes(fps: DataFrame, radius: int, bands: int) -> DataFrame:
    """(fp, root, component_id) of every distinct fingerprint of (doc_id, fp)."""
    groups = store(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "fingerprint-groups")
    nodes = store(components(links(groups.select("fp"), radius, bands)), "fingerprint-components")
    found = store(nodes.join(groups, nodes["node"] == groups["fp"]).groupBy("root").agg(F.min("rep").alias("least")), "fingerprint-least")
    merged = nodes.join(found, "root").select(F.col("node").alias("fp"), "root", "least")
    classes = groups.join(merged, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), F.coalesce("least", "rep").alias("component_id"))
    # stored, so that a join with it has two exchanges of its own, of which Spark can split a large partition
    return store(classes, "fingerprint-classes")


def near_duplicates(docs: DataFrame, words: int = WORDS, radius: int = RADIUS, bands: int = BANDS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every document."""
    fps = store(fingerprints(docs, words), "fingerprints")
    classes = _classes(fps, radius, bands).select("fp", "component_id")
    return fps.join(classes, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _near(t: pd.DataFrame, radius: int, least: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of one block with fingerprints within the radius, sizes that allow the similarity, and different roots."""
    block, size, root = (t[c].to_numpy() for c in ("block", "size", "root"))
    first, last = np.searchsorted(block, block, "left"), np.searchsorted(block, block, "right")
    i, j = compare(t[["f0", "f1"]].to_numpy().view(np.uint64), first, last, radius)
    a, b = size[i].astype(np.int64), size[j].astype(np.int64)
    keep = (root[i] != root[j]) & (np.minimum(a, b) * least[1] >= np.maximum(a, b) * least[0])
    return i[keep], j[keep]


def _opposed(rows: DataFrame, chunk: int) -> DataFrame:
    """Deal the buckets of ``rows`` (bucket, node, root) that hold several classes into blocks of two chunks each.

    The largest class of a bucket meets only the others, as it is one already.
    A bucket costs as much as its rows times those outside its largest class,
    divided by the chunk: linear where one class fills it, quadratic where
    many texts that are no near copies share it.
    """
    classes = rows.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n"))
    tops = classes.groupBy("bucket").agg(F.max(F.struct("n", "root")).alias("top"), F.sum("n").alias("all")).where("all > top.n")
    parts = lambda n: F.ceil(n / chunk).cast("int")
    df = rows.join(tops.select(anew("bucket").alias("b"), "top", "all"), F.col("bucket") == F.col("b")).withColumns({"large": F.col("root") == F.col("top.root"), "ml": parts(F.col("top.n")), "mo": parts(F.col("all") - F.col("top.n"))})
    df = df.withColumn("mine", F.pmod(F.xxhash64("node", F.lit(1)), F.when(F.col("large"), F.col("ml")).otherwise(F.col("mo"))).cast("int"))
    upto = lambda n: F.sequence(F.lit(0), n - 1)
    met = F.when(F.col("large"), F.transform(upto(F.col("mo")), lambda o: F.xxhash64("bucket", F.lit(0), "mine", o))).otherwise(F.concat(
        F.transform(upto(F.col("ml")), lambda o: F.xxhash64("bucket", F.lit(0), o, "mine")), F.transform(upto(F.col("mo")), lambda o: F.xxhash64("bucket", F.lit(1), F.least("mine", o), F.greatest("mine", o)))))
    return df.select(F.explode(met).alias("block"), "node", "root")


def near_links(docs: DataFrame, nodes: DataFrame, words: int = shingles.WORDS, least: tuple[int, int] = LEAST, radius: int = NEAR_RADIUS, chunk: int = NEAR_CHUNK) -> DataFrame:
    """(u, v): links that join all ``nodes`` which pairs of similarity ``least`` in common buckets connect.

    First every member of a bucket is held against the bucket's least member,
    in time linear in the bucket. Buckets that then still hold several classes
    are compared bit-sliced, class against class, and the pairs within the
    radius are decided on the whole shingle sets. Buckets are dealt by node
    numbers; fingerprints join what is left.
    """
    fps = nodes.select("node", "f0", "f1", "size")
    keyed = nodes.select("node", F.explode(F.array_distinct("buckets")).alias("bucket"))
    heads = keyed.groupBy("bucket").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1").select(anew("bucket").alias("b"), "head", "n")
    rows = store(keyed.join(heads, F.col("bucket") == F.col("b")).drop("b"), "near-buckets")
    pairs = rows.where("node <> head").select(F.col("head").alias("u"), F.col("node").alias("v")).distinct()
    both = pairs.join(fps.select(F.col("node").alias("u"), F.struct("f0", "f1", "size").alias("a")), "u").join(fps.select(F.col("node").alias("v"), F.struct("f0", "f1", "size").alias("b")), "v")
    apart = F.bit_count(F.col("a.f0").bitwiseXOR(F.col("b.f0"))) + F.bit_count(F.col("a.f1").bitwiseXOR(F.col("b.f1")))
    sizes = F.least("a.size", "b.size") * least[1] >= F.greatest("a.size", "b.size") * least[0]
    found = store(shingles.verified(docs, nodes, both.where((apart <= radius) & sizes).select("u", "v"), least, words), "near-links")
    rest = rows.where("n > 2").select("bucket", "node").join(store(components(found), "near-roots"), "node", "left")
    rest = store(rest.withColumn("root", F.coalesce("root", "node")), "near-rest")
    dealt = lambda df: df.repartition("block").sortWithinPartitions("block")

    def close(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in _tiles(batches, "block", TILE):
            yield t.iloc[np.unique(np.concatenate(_near(t, radius, least)))]

    def decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in _tiles(batches, "block", TILE):
            i, j = _near(t, radius, least)
            node, grams, up = t["node"].to_numpy(), t["grams"].to_numpy(), dict(zip(*[t["root"]] * 2, strict=True))
            roots = t["root"].to_numpy()

            def top(x: int) -> int:
                while up[x] != x:
                    up[x] = x = up[up[x]]
                return x

            out = []
            for a, b in zip(i, j, strict=True):
                x, y = top(roots[a]), top(roots[b])
                if x != y and shingles.similar(grams[a], grams[b], least):
                    up[x] = y
                    out.append((node[a], node[b]))
            yield pd.DataFrame(out, columns=["u", "v"], dtype="int64")

    left = store(dealt(_opposed(rest, chunk).join(fps, "node").select("block", "node", "root", "f0", "f1", "size")).mapInPandas(close, "block long, node long, root long, f0 long, f1 long, size int"), "near-left")
    if left.isEmpty():
        return found
    sets = shingles.sets(docs, nodes.select("node", "doc_id", "digest").join(left.select("node").distinct(), "node"), words)
    return found.unionByName(dealt(left.join(sets, "node")).mapInPandas(decide, "u long, v long"))


def deduplicate(docs: DataFrame, words: int = shingles.WORDS, least: tuple[int, int] = LEAST, radius: int = NEAR_RADIUS) -> DataFrame:
    """One document of each class of near copies, the one with the least doc_id (null last), with all its columns.

    Two texts are near copies if their sets of ``words``-word shingles have a
    similarity of ``least`` or more. Candidates share a bucket (see
    ``shingles``) and differ in ``radius`` of 128 fingerprint bits at most, far
    beyond what such copies do; the sets themselves decide. Equal texts are one
    node.
    """
    rows = store(shingles.signed(docs, words), "near-rows")
    least_id = rows.groupBy("digest", "doc_id").agg(F.count(F.lit(1)).alias("copies")).groupBy("digest").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "copies")).alias("k"))
    features = rows.groupBy("digest").agg(*(F.first(c).alias(c) for c in ("f0", "f1", "size", "buckets")))
    nodes = store(features.join(least_id, "digest").select(F.monotonically_increasing_id().alias("node"), "digest", "k.none", "k.doc_id", "k.copies", "f0", "f1", "size", "buckets"), "near-nodes")
    release(rows)
    classes = store(components(near_links(docs, nodes, words, least, radius)), "near-classes")
    ranked = nodes.select("node", "digest", "none", "doc_id", "copies").join(classes, "node", "left").withColumn("root", F.coalesce("root", "node"))
    kept = ranked.groupBy("root").agg(F.min(F.struct("none", "doc_id", "node", "digest", "copies")).alias("k"))
    kept = store(kept.select(F.col("k.doc_id").alias("__id"), F.col("k.digest").alias("__kept"), F.col("k.copies").alias("__n")), "near-kept")
    marked = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", shingles.digest().alias("digest"))
    match = lambda k: [marked["doc_id"].eqNullSafe(k["__id"]), marked["digest"] == k["__kept"]]
    one, many = kept.where("__n = 1"), kept.where("__n > 1")
    out = marked.join(one, match(one), "left_semi")
    if not many.isEmpty():  # rows that repeat their id and text
        out = out.unionByName(marked.join(many, match(many), "left_semi").dropDuplicates(["doc_id", "digest"]))
    return out.select("row.*")
