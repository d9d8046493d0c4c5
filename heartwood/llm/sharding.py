"""Sharding by a Feistel permutation with cycle walking over global row numbers.

The law is ``rows``: the counts of two shards differ by one at most. Row r of
N (in the order of doc_id, text checksum and size) goes to place p(r), where
p is a keyed permutation of 0..N-1; its shard is p mod shards and its slot
p div shards. Both directions are computable: ``permute`` gives the place of
a row number and ``invert`` the row number at a place, so a reader finds the
row for any (shard, slot) without a lookup table.

Defined results: null text has 0 bytes and checksum 0; null doc_ids come
first in the numbering; equal rows are interchangeable; equal texts are not
kept together, since this law deals rows, not groups; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heartwood.llm.common import store

SHARDS, ROUNDS, KEY = 24, 6, 20_240_229


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    """A 64-bit finaliser (multiply and shift) of x under a round key."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((key * 0x9E3779B97F4A7C15) & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _halves(n: int) -> tuple[int, int]:
    bits = max(2, int(n - 1).bit_length())
    return bits // 2, bits - bits // 2


def _encrypt(x: np.ndarray, a: int, b: int, key: int, back: bool) -> np.ndarray:
    """Alternating Feistel rounds on a left half of ``a`` and a right half of ``b`` bits."""
    low, high = np.uint64((1 << b) - 1), np.uint64((1 << a) - 1)
    left, right = x >> np.uint64(b), x & low
    for r in reversed(range(ROUNDS)) if back else range(ROUNDS):
        if r % 2:
            right = right ^ (_mix(left, key + r) & low)
        else:
            left = left ^ (_mix(right, key + r) & high)
    return (left << np.uint64(b)) | right


def permute(rows: np.ndarray, n: int, key: int = KEY, back: bool = False) -> np.ndarray:
    """The place of each row number below n; a value outside is walked along its cycle until it falls inside."""
    out = np.asarray(rows).astype(np.uint64)
    if n > 1:
        a, b = _halves(n)
        out = _encrypt(out, a, b, key, back)
        while (far := out >= np.uint64(n)).any():
            out[far] = _encrypt(out[far], a, b, key, back)
    return out.astype(np.int64)


def invert(places: np.ndarray, n: int, key: int = KEY) -> np.ndarray:
    return permute(places, n, key, back=True)


def numbered(df: DataFrame, order: list[str], column: str, name: str) -> tuple[DataFrame, int]:
    """Add the global row number in ``order``; also the number of rows.

    Rows are range-partitioned, sorted and stored with their place in their
    part; parts are counted, and their offsets (a row for each part) joined.
    Rows equal in ``order`` are dealt by their place in the input, so however
    many they are, they fill several ranges; among them, numbers are
    interchangeable.
    """
    order = [*order, "__tie"]
    df = df.withColumn("__tie", F.monotonically_increasing_id())
    sorted_parts = df.repartitionByRange(*order).sortWithinPartitions(*order).drop("__tie")
    mid = F.monotonically_increasing_id()
    laid = store(sorted_parts.select("*", F.shiftright(mid, 33).alias("__part"), mid.bitwiseAND((1 << 33) - 1).alias("__place")), name)
    counts = laid.groupBy("__part").count().orderBy("__part").collect()  # one row for each part of the table
    total, offsets = 0, []
    for r in counts:
        offsets.append((r["__part"], total))
        total += r["count"]
    parts = df.sparkSession.createDataFrame(offsets, "__part long, __offset long")
    return laid.join(F.broadcast(parts), "__part").withColumn(column, F.col("__offset") + F.col("__place")).drop("__part", "__offset", "__place"), total


def shard(docs: DataFrame, shards: int = SHARDS, key: int = KEY) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every document."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).cast("long").alias("text_crc32"))
    rows, n = numbered(rows, ["doc_id", "text_crc32", "size"], "row", "shard-rows")

    def places(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series(permute(s.to_numpy(), n, key))

    place = F.pandas_udf(places, "long")
    df = rows.withColumn("place", place("row"))
    return df.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), (F.col("place") % shards).cast("int").alias("shard"),
        F.floor(F.col("place") / shards).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "row",
    )
