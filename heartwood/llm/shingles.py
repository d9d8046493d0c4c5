"""Word shingles of near copies: features for candidate search, and whole sets for the decision.

``simhash.deduplicate`` is built on these. Words are lower-cased over A-Z and
split at ASCII white space; a text shorter than a shingle is one shingle; null,
empty and blank texts have none, and are alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heartwood.llm.common import small_batches, store

WORDS, SEED = 5, 42
#: Buckets of a text, and minima in the key of each: a pair of similarity s shares one with probability 1 - (1 - s^ROWS)^BANDS, 0.9996 at 0.8.
ROWS, BANDS = 5, 20
_SALTS = np.random.default_rng(SEED).integers(0, 2**63, (2, ROWS * BANDS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Hashes of a text's distinct shingles, sorted."""
    parts = (text or "").encode().lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    flat = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    n = min(words, len(parts))
    starts = np.concatenate(([0], ends[: len(ends) - n] + 1)).tolist()
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(flat[a:b], SEED) for a, b in zip(starts, ends[n - 1:].tolist(), strict=True)], np.uint64))


def buckets(grams: np.ndarray) -> np.ndarray:
    """The keys of a set's buckets, one for each band."""
    low = np.full(ROWS * BANDS, 2**64 - 1, np.uint64)
    for i in range(0, len(grams), 1024):
        x = grams[i:i + 1024, None]
        np.minimum(low, ((x ^ x >> np.uint64(29) ^ _SALTS[0]) * _SALTS[1]).min(0), out=low)
    keys = _BAND.copy()
    for column in low.reshape(BANDS, ROWS).T:
        keys = (keys ^ column ^ column >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9)
        keys ^= keys >> np.uint64(27)
    return keys


def wide(grams: np.ndarray) -> np.ndarray:
    """A fingerprint of 128 bits in two words: the majority of the shingles' hashes, and of another mixing of these."""
    out = np.zeros(2, np.uint64)
    for k in range(2):
        h = grams
        if k:
            h = (grams ^ grams >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
            h = (h ^ h >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
        ones = np.zeros(64, np.int64)
        for i in range(0, len(h), 1 << 14):
            ones += np.unpackbits(h[i:i + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        out[k] = int.from_bytes(np.packbits(2 * ones > len(h), bitorder="little").tobytes(), "little")
    return out


def digest() -> Column:
    """128 bits that stand for a text; null is the empty text."""
    return F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary")))


def signed(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, digest, f0, f1, size, buckets) of every document: its fingerprint, number of shingles, and bucket keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [shingles(t.as_py(), words) for t in b.column(2)]
            fps = np.array([wide(g) for g in found], np.uint64).reshape(-1, 2).view(np.int64)
            keys = np.array([buckets(g) for g in found], np.uint64).reshape(-1).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(keys) + 1, BANDS), pa.int32()), pa.array(keys))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps[:, 0].copy()), pa.array(fps[:, 1].copy()), pa.array([len(g) for g in found], pa.int32()), lists], names=["doc_id", "digest", "f0", "f1", "size", "buckets"])

    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", digest().alias("digest"), "text").mapInArrow(run, f"doc_id {kind}, digest binary, f0 long, f1 long, size int, buckets array<long>")


def sets(docs: DataFrame, nodes: DataFrame, words: int = WORDS) -> DataFrame:
    """(node, grams) of ``nodes`` (node, doc_id, digest), each from the one text that has its id and digest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [shingles(t.as_py(), words).view(np.int64) for t in b.column(1)]
            ends = np.concatenate(([0], np.cumsum([len(x) for x in found])))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *found])))
            yield pa.RecordBatch.from_arrays([b.column(0), lists], names=["node", "grams"])

    texts = docs.select(F.col("doc_id").alias("__id"), digest().alias("__digest"), "text")
    named = texts.join(nodes, texts["__id"].eqNullSafe(nodes["doc_id"]) & (texts["__digest"] == nodes["digest"])).select("node", "text").dropDuplicates(["node"])
    return store(named.mapInArrow(run, "node long, grams array<long>"), "shingle-sets")


def similar(a: np.ndarray, b: np.ndarray, least: tuple[int, int]) -> bool:
    """Whether two sorted sets' Jaccard similarity is at least the fraction ``least``, in whole numbers."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common * least[1] >= (len(a) + len(b) - common) * least[0]


def verified(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, least: tuple[int, int], words: int = WORDS) -> DataFrame:
    """The pairs (u, v) of ``nodes`` whose shingle sets' similarity is at least the fraction ``least``."""
    pairs = store(pairs, "shingle-pairs")
    named = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    found = sets(docs, nodes.select("node", "doc_id", "digest").join(named, "node"), words)
    one = pairs.join(found.select(F.col("node").alias("u"), F.col("grams").alias("a")), "u")
    both = one.join(found.select(F.col("node").alias("v"), F.col("grams").alias("b")), "v")
    common = F.size(F.array_intersect("a", "b"))
    return both.where(common * least[1] >= (F.size("a") + F.size("b") - common) * least[0]).select("u", "v")
