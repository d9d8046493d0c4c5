"""What the training-data operators share: table access and durable intermediate tables."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_fallback: dict[str, str] = {}
_written: list[tuple[object, str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; a temporary one only where all runs on this machine."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _fallback:
        _fallback[app] = "file://" + tempfile.mkdtemp(prefix="heartwood-")
    return _fallback[app]


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    This cuts the lineage: a lost executor costs at most the tasks that were
    running, and what follows never recomputes what came before. The tables
    go when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/heartwood-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def anew(key: str) -> Column:
    """A long key's equal that the planner takes for another expression.

    A grouped table is already dealt by its key, so a join on the key itself
    would use that dealing, and the partition of a frequent key could not be
    split. A join on this one deals both sides anew, and Spark can split them.
    """
    return F.shiftleft(key, 0)


def small_batches(spark: SparkSession) -> None:
    """Hand texts to Python by the thousand rows, since workers hold a batch several times over.

    The plan reads the setting when it runs, so it stays set for the session;
    a session that has set it itself, to whatever value, keeps its own.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not spark._jsparkSession.conf().contains(key):
        spark.conf.set(key, "1000")


def release(df: DataFrame) -> None:
    """Delete the stored tables that ``df`` reads; for those that nothing needs any more."""
    files = df.inputFiles()
    for spark, path in list(_written):
        leaf = path.rsplit("/", 1)[1]
        if any(f"/{leaf}/" in f for f in files):
            _delete(spark, path)
            _written.remove((spark, path))


def _delete(spark, path: str) -> None:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@atexit.register
def _clean() -> None:
    for spark, path in _written:
        try:
            if spark.sparkContext._jsc is not None:
                _delete(spark, path)
        except Exception:  # the JVM may be gone already; nothing else depends on this
            return
