"""A registry kept as mergeable statistics: a batch touches only the buckets that its observations fall into.

A (session, value) is held by its count, the sums and sums of squares of its
significances and resistances as whole numbers of four places, its first and
last moment and the set of its document types. Such rows add up in any order
and any split, to the last digit, so a registry over all observations follows
from them without reading one again.

The table is partitioned by a hash bucket of its key. ``update`` reads the
buckets that a batch touches, merges, and overwrites those partitions alone.
Every bucket carries the number of the last batch that went into it; it is
swapped as a whole, so a batch that is run again, after whatever part of it
was written, adds nothing to the buckets that have it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heartwood.operators import registry

KEY = ["session_id", "value_name"]
PLACES, BUCKETS = 10_000, 64
SCHEMA = "session_id string, value_name string, n long, s1 decimal(38,0), r1 decimal(38,0), r2 decimal(38,0), first_ts double, last_ts double, kinds array<string>, batch long, bucket int"


def statistics(observations: DataFrame) -> DataFrame:
    """(session_id, value_name, n, s1, r1, r2, first_ts, last_ts, kinds) of observations."""
    whole = lambda c: F.round(F.col(c) * PLACES).cast("decimal(18,0)")
    o = observations.select(*KEY, "ts", "doc_type", whole("significance").alias("s"), whole("resistance").alias("r"))
    return o.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("n"), F.sum("s").cast("decimal(38,0)").alias("s1"), F.sum("r").cast("decimal(38,0)").alias("r1"), F.sum(F.col("r") * F.col("r")).cast("decimal(38,0)").alias("r2"),
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.sort_array(F.collect_set("doc_type")).alias("kinds"),
    )


def merged(*parts: DataFrame) -> DataFrame:
    """Statistics of several batches as those of all their observations."""
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    add = lambda c: F.sum(c).cast("decimal(38,0)").alias(c)
    return every.groupBy(*KEY).agg(
        F.sum("n").alias("n"), add("s1"), add("r1"), add("r2"), F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"), F.sort_array(F.array_distinct(F.flatten(F.collect_list("kinds")))).alias("kinds"),
    )


def profiles(stats: DataFrame) -> DataFrame:
    """The registry that the statistics stand for."""
    spread = (F.col("n") * F.col("r2") - F.col("r1") * F.col("r1")).cast("double")
    mean = lambda c: F.col(c).cast("double") / F.col("n") / PLACES
    return registry.profiled(stats.select(
        *KEY, F.col("n").alias("demonstrations"), mean("s1").alias("sig"), mean("r1").alias("res"), (F.sqrt(spread) / F.col("n") / PLACES).alias("sigma"),
        F.col("first_ts").alias("first_seen_ts"), F.col("last_ts").alias("last_seen_ts"), F.size("kinds").alias("types"),
    ))


def stored(spark: SparkSession, path: str) -> DataFrame:
    """The statistics kept at ``path``; none where nothing was written yet."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(path)


def update(observations: DataFrame, path: str, batch: int, buckets: int = BUCKETS) -> None:
    """Merge a batch of new observations, numbered from 0 upwards, into the statistics at ``path``."""
    spark = observations.sparkSession
    bucket = F.pmod(F.xxhash64(*KEY), F.lit(buckets)).cast("int")
    new = statistics(observations).withColumn("bucket", bucket)
    touched = [r["bucket"] for r in new.select("bucket").distinct().collect()]  # ``buckets`` numbers at most
    if not touched:
        return
    old = stored(spark, path).where(F.col("bucket").isin(touched))
    last = {r["bucket"]: r["batch"] for r in old.groupBy("bucket").agg(F.max("batch").alias("batch")).collect()}
    open_ = [b for b in touched if last.get(b, -1) < batch]
    if not open_:
        return
    parts = [df.where(F.col("bucket").isin(open_)).drop("bucket", "batch") for df in (old, new)]
    out = merged(*parts).withColumn("batch", F.lit(batch).cast("long")).withColumn("bucket", bucket)
    # a task writes whole buckets, and only the partitions that it has are overwritten
    out.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)
