"""A table that takes each batch of a stream once, whatever is killed in between.

A batch writes its rows into a folder of its own and then, last of all, its
entry into the ledger beside them. Readers see the batches that the ledger
names. A batch that is run again after it was committed is skipped by its
entry alone, without a look at the table's rows; one that was killed before
its entry, with some or all of its rows written, is invisible and is written
anew. ``table`` may take several queries: (query, batch) names an entry.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from heartwood.sources import sinks


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def commit(batch: DataFrame, table: str, query: str, number: int) -> bool:
    """Add a batch's rows to the table; False if it holds them already."""
    spark, entry = batch.sparkSession, f"{table}/ledger/{query}-{number}"
    if _exists(spark, entry):
        return False
    batch.write.mode("overwrite").parquet(f"{table}/rows/query={query}/batch={number}")
    # written aside and renamed, so an entry is there whole or not at all
    aside = f"{table}/aside/{query}-{number}"
    sinks.write_text(spark, aside, f"{query},{number}\n")
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(entry).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path(f"{table}/ledger"))
    if not fs.rename(path(aside), path(entry)) and not fs.exists(path(entry)):
        raise OSError(f"batch {number} of {query} could not be entered into {table}")
    return True


def sink(table: str, query: str) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: ``query`` must stay the same for a checkpoint, and differ between checkpoints."""
    return lambda batch, number: commit(batch, table, query, number) and None


def read(spark: SparkSession, table: str, schema: str) -> DataFrame:
    """The rows of all committed batches; none before the first."""
    if not _exists(spark, f"{table}/ledger"):
        return spark.createDataFrame([], schema)
    entries = spark.read.schema("query string, batch long").csv(f"{table}/ledger")
    rows = spark.read.schema(f"{schema}, query string, batch long").parquet(f"{table}/rows")
    return rows.join(entries, ["query", "batch"], "left_semi").drop("query", "batch")
