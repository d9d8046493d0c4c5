"""Structured Streaming: incremental extraction, registries and pressure context.

A checkpoint's offsets take the place of high-water marks, so nothing at a
mark's edge is lost. ``available_now`` runs what is there and ends.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heartwood.operators import registry as batch_registry
from heartwood.operators import statistics
from heartwood.sources import sinks
from heartwood.streaming import ledger

KEYS = ["session_id", "record_id", "value_name"]


def source(spark: SparkSession, path: str, schema, files: int = 200) -> DataFrame:
    """A Parquet folder as a stream, ``files`` files at a time."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def run(df: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(sink).start().awaitTermination()


def ingest(observations: DataFrame, table: str, checkpoint: str, order: list[str] | None = None) -> None:
    """Append new observations to a table; a repeated batch, or a repeated observation, adds nothing; of a batch's repeats the first in ``order`` stays."""
    run(observations, lambda batch, _: sinks.append_new(batch, table, KEYS, order), checkpoint)


def ingest_once(observations: DataFrame, table: str, checkpoint: str, query: str, at: str = "at", late: str = "72 hours") -> None:
    """Add new observations to a ledger's table, each batch once; an observation repeated within ``late`` of event time (column ``at``) counts once, which no look at the table's rows decides."""
    run(observations.withWatermark(at, late).dropDuplicatesWithinWatermark(KEYS), ledger.sink(table, query), checkpoint)


def fed(parts: list[DataFrame], build: Callable[[DataFrame], DataFrame], folder: str, sink: Callable[[DataFrame, int], None], checkpoint: str) -> int:
    """Run ``build`` over a stream that runs on while ``parts`` arrive one after another, in append mode; returns the rows dropped as too late, from the query's progress."""
    spark = parts[0].sparkSession
    parts[0].limit(0).write.mode("append").parquet(folder)
    query = build(source(spark, folder, parts[0].schema)).writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(sink).start()
    seen: dict[int, int] = {}
    try:
        for part in parts:
            part.write.mode("append").parquet(folder)
            query.processAllAvailable()
            # a batch's progress stands once; a dropped row counts at the first operator that drops it
            seen |= {p.batchId: sum(s.numRowsDroppedByWatermark for s in p.stateOperators) for p in query.recentProgress}
    finally:
        query.stop()
    return sum(seen.values())


def registry_table(observations: DataFrame, path: str, checkpoint: str) -> None:
    """Keep the statistics of a registry at ``path`` (``statistics.profiles`` reads it): a batch touches its own buckets, and a repeated one adds nothing."""
    run(observations, lambda batch, number: statistics.update(batch, path, number), checkpoint)


def registry(observations: DataFrame) -> DataFrame:
    """The registry of each (session, value) so far, as in batch: means, consistency and weight; for complete or update mode."""
    g = observations.groupBy("session_id", "value_name").agg(
        F.count(F.lit(1)).alias("demonstrations"), F.avg("significance").alias("sig"), F.avg("resistance").alias("res"), F.stddev_pop("resistance").alias("sigma"),
        F.min("ts").alias("first_seen_ts"), F.max("ts").alias("last_seen_ts"), F.size(F.collect_set("doc_type")).alias("types"))
    return batch_registry.profiled(g)


def _marked(events: DataFrame, late: str | None) -> DataFrame:
    return events.withWatermark("ts", late) if late else events


def windowed(events: DataFrame, late: str | None = "72 hours", size: str = "1 hour", key: str = "event_type") -> DataFrame:
    """Event-time windows with a watermark; rows later than that are dropped. Without ``late`` the events have their watermark already."""
    return _marked(events, late).groupBy(F.window("ts", size), key).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), key, "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str | None = "72 hours", key: str = "user_id") -> DataFrame:
    return _marked(events, late).groupBy(F.session_window("ts", gap), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), key, "n")

