"""Ranks in a global order, and a hash tree over ordered records.

Records are dealt to partitions by ranges of their order and sorted there; a
partition's rows are numbered in place, and the partitions before it are
counted. So a rank costs one shuffle, whatever the number of records, and no
window over all of them. A salt follows the order, so that many equal rows,
whose order among them does not matter, are several partitions' work.

The sorted rows are stored once, as ranges are found by sampling: numbers and
counts must come from the same ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heartwood.sources import sinks

#: Bits of a row's number within its partition (as ``monotonically_increasing_id`` defines it).
ROW_BITS = 33
FANOUT = 1024


def ranked(df: DataFrame, *order: str | Column, name: str = "rank") -> DataFrame:
    """``df`` with each row's rank from 0 in the order of these columns; equal rows in any order among them."""
    spark, path = df.sparkSession, sinks.scratch(df.sparkSession)
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    rows = df.select(F.struct("*").alias("row"), F.struct(*keys).alias("key"), F.rand(7).alias("salt"))
    rows.repartitionByRange("key", "salt").sortWithinPartitions("key", "salt").select("row", F.monotonically_increasing_id().alias("at")).write.parquet(path)
    stored = spark.read.schema(rows.select("row").withColumn("at", F.lit(0).cast("long")).schema).parquet(path)
    part, place = F.shiftright("at", ROW_BITS), F.col("at").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    sizes = stored.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))  # a row for each partition
    before = sizes.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return stored.withColumn("part", part).join(F.broadcast(before), "part").select("row.*", (F.col("before") + place).alias(name))


def folded(nodes: DataFrame, group: list[str], fanout: int = FANOUT) -> DataFrame:
    """(group, n, hash): the root of each group's tree, from its nodes (group, place from 0, n, hash).

    ``fanout`` consecutive nodes become the SHA-256 of their hashes; a node
    left alone is the root. A level's work is a ``fanout``-th of the last's,
    and no row holds more than ``fanout`` hashes.
    """
    most = nodes.agg(F.max("place")).first()[0] or 0  # the places of the largest group decide the number of levels
    while most > 0:
        item = F.struct("place", "hash")
        up = nodes.groupBy(*group, F.floor(F.col("place") / fanout).alias("up")).agg(F.sum("n").alias("n"), F.array_sort(F.collect_list(item)).alias("c"))
        whole = F.sha2(F.array_join(F.transform("c", lambda x: x["hash"]), ""), 256)
        nodes = up.select(*group, F.col("up").alias("place"), "n", F.when((F.size("c") == 1) & (F.col("up") == 0), F.col("c")[0]["hash"]).otherwise(whole).alias("hash"))
        most //= fanout
    return nodes.drop("place")


def grouped_hashes(df: DataFrame, group: list[str], content: Column, *order: str | Column, fanout: int = FANOUT) -> DataFrame:
    """(group, n, hash): a hash of each group's rows in order, the same for any partitioning; two sets differ in the groups whose hashes do."""
    rows = ranked(df.select(*group, F.sha2(content, 256).alias("hash"), F.struct(*order).alias("order")), *group, "order")
    first = rows.groupBy(*group).agg(F.min("rank").alias("first"))
    nodes = rows.join(first, group).select(*group, (F.col("rank") - F.col("first")).alias("place"), F.lit(1).cast("long").alias("n"), "hash")
    return folded(nodes, group, fanout)


def root(groups: DataFrame, group: list[str], fanout: int = FANOUT) -> DataFrame:
    """(n, hash): one hash of all groups' keys and hashes, in the order of their keys."""
    key = F.sha2(F.concat_ws("\u0001", *(F.col(c) for c in group), F.col("hash")), 256)
    nodes = ranked(groups.select(*group, "n", key.alias("hash")), *group, name="place").select(F.lit(0).alias("all"), "place", "n", "hash")
    return folded(nodes, ["all"], fanout).drop("all")
