"""Writers: record files, reports, tables and cards."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def append(df: DataFrame, path: str, by: str | None = None) -> None:
    w = df.write.mode("append")
    (w.partitionBy(by) if by else w).parquet(path)


BUCKETS = 64


def append_new(df: DataFrame, path: str, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """Append the rows whose keys the table does not hold yet; returns them. The first write creates the table.

    Of rows with equal keys the first in ``order`` stays (else the least of
    all columns), so a rerun keeps the same. The table is partitioned by
    ``BUCKETS`` hashes of the first key: a batch reads the buckets it has rows
    for, not the whole table.
    """
    spark = df.sparkSession
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*(order or rest))) if rest else F.lit(None)
    fresh = df.groupBy(*keys).agg(first.alias("_r")).select(*keys, *(["_r.*"] if rest else [])).select(*df.columns)
    fresh = fresh.withColumn("bucket", F.pmod(F.hash(keys[0]), F.lit(BUCKETS)))
    if p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        some = [r["bucket"] for r in fresh.select("bucket").distinct().collect()]  # BUCKETS at most
        known = spark.read.parquet(path).where(F.col("bucket").isin(some)).select(*keys)
        fresh = fresh.join(known, keys, "left_anti")
    fresh.write.mode("append").partitionBy("bucket").parquet(path)
    return fresh.drop("bucket")


def prototypes(centroids: DataFrame, path: str) -> None:
    """The prototype vectors (label, centroid) as a table; a new build takes the place of the last."""
    centroids.write.mode("overwrite").parquet(path)


def report(records: DataFrame, path: str) -> None:
    """The export report as one JSON file."""
    from heartwood.operators import labels

    labels.report(records).coalesce(1).write.mode("overwrite").text(path)  # one row


def training_files(records: DataFrame, path: str, include_ambiguous: bool = False) -> None:
    """JSON lines: a folder for each figure, the positive records, and the negative ones."""
    own = records if include_ambiguous else records.where("label <> 'AMBIGUOUS'")
    own.write.mode("overwrite").partitionBy("figure_name").json(f"{path}/by_figure")
    records.where("label = 'P1'").write.mode("overwrite").json(f"{path}/positive")
    records.where("label in ('P0', 'APY')").write.mode("overwrite").json(f"{path}/negative")


def threshold_csv(sweep: DataFrame, path: str) -> None:
    sweep.coalesce(1).write.mode("overwrite").option("header", True).csv(path)  # 48 rows at most


def gold_files(gold: DataFrame, path: str) -> None:
    """Gold as JSON lines, and its distinct texts as one block each."""
    gold.write.mode("overwrite").json(f"{path}/gold")
    gold.select(F.concat("text_excerpt", F.lit("\n")).alias("value")).distinct().write.mode("overwrite").text(f"{path}/texts")


def certificate(profile: DataFrame, entity: str, issued_at: float) -> DataFrame:
    """One row: the profile's held values as JSON, its score, and a signature over both."""
    held = profile.groupBy().agg(
        F.to_json(F.array_sort(F.collect_list("value_name"))).alias("values_certified"),
        F.coalesce(F.round(F.avg("score"), 4), F.lit(0.0)).alias("score"),
    )
    payload = F.to_json(F.struct(F.lit(entity).alias("entity"), F.lit(float(issued_at)).alias("issued_at"), "score", "values_certified"))
    return held.select(F.lit(entity).alias("entity"), F.lit(float(issued_at)).alias("issued_at"), "score", "values_certified", payload.alias("payload")).withColumn("signature", F.sha2("payload", 256))


def certificates(table: DataFrame, entity: str | None = None, limit: int = 50) -> DataFrame:
    """The latest certificates, 100 at most (the feature of this read)."""
    t = table.where(F.col("entity") == entity) if entity else table
    return t.orderBy(F.desc("issued_at"), "entity").limit(min(limit, 100))


_own: dict[str, str] = {}


def scratch(spark: SparkSession) -> str:
    """A new folder that driver and executors share: under ``spark.checkpoint.dir``; a temporary one only where all runs on this machine."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base and spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not base:
        base = _own.setdefault(spark.sparkContext.applicationId, "file://" + tempfile.mkdtemp(prefix="heartwood-"))
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def write_text(spark: SparkSession, path: str, body: str) -> None:
    """One small file in any file system that Spark reaches."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    try:
        out.write(body.encode())
    finally:
        out.close()
