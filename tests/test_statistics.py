"""Mergeable statistics: any split into batches gives the registry of all observations."""

import os
import random

import pytest
from pyspark.sql import functions as F

from heartwood.operators import registry, statistics
from heartwood.streaming import jobs

SCHEMA = "session_id string, record_id string, value_name string, ts double, significance double, resistance double, doc_type string"


def observations(spark, n=400, seed=1):
    rng = random.Random(seed)
    rows = [(f"figure:{rng.choice('abcdefgh')}", f"r{i}", rng.choice(["love", "courage", "growth"]), float(rng.randint(-10**9, 10**9)), rng.choice([0.7, 0.85, 0.9]), round(rng.random(), 4), rng.choice(["letter", "speech", "action", None])) for i in range(n)]
    return spark.createDataFrame([*rows, ("figure:alone", "x", "love", 1.0, 0.5, 0.5, None)], SCHEMA)


def table(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("batches", [1, 3, 7])
def test_any_split_is_the_registry(spark, tmp_path, batches):
    o = observations(spark)
    rng = random.Random(batches)
    rows = o.collect()
    rng.shuffle(rows)
    for k in range(batches):
        part = rows[k::batches]
        statistics.update(spark.createDataFrame(part, SCHEMA), f"{tmp_path}/s", k, 8)
    assert table(statistics.profiles(statistics.stored(spark, f"{tmp_path}/s"))) == table(registry.registry(o))


def files(path):
    return {b: sorted(f for f in os.listdir(f"{path}/{b}") if f.endswith(".parquet")) for b in os.listdir(path) if b.startswith("bucket=")}


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    path, o = f"{tmp_path}/s", observations(spark)
    statistics.update(o, path, 0, 32)
    before = files(path)
    one = o.where("session_id = 'figure:a' and value_name = 'love'")
    statistics.update(one.withColumn("record_id", F.concat(F.lit("again"), "record_id")), path, 1, 32)
    after = files(path)
    assert set(before) == set(after) and len([b for b in before if before[b] != after[b]]) == 1
    statistics.update(o.limit(0), path, 2, 32)
    assert files(path) == after


def test_a_repeated_batch_adds_nothing(spark, tmp_path):
    path, o = f"{tmp_path}/s", observations(spark)
    first, second = o.where("record_id < 'r2'"), o.where("record_id >= 'r2'")
    statistics.update(first, path, 0, 8)
    statistics.update(second, path, 1, 8)
    before = files(path)
    statistics.update(second, path, 1, 8)
    statistics.update(first, path, 0, 8)
    assert files(path) == before


def test_a_batch_that_was_half_written(spark, tmp_path):
    """Some buckets hold a batch and some do not, as after a driver that was lost while it wrote."""
    whole, half, o = f"{tmp_path}/whole", f"{tmp_path}/half", observations(spark)
    first, second = o.where("record_id < 'r2'"), o.where("record_id >= 'r2'")
    for path in (whole, half):
        statistics.update(first, path, 0, 8)
    some = second.where(F.pmod(F.xxhash64(*statistics.KEY), F.lit(8)) < 4)
    statistics.update(some, half, 1, 8)  # the buckets that were written
    statistics.update(second, half, 1, 8)  # the batch runs again
    statistics.update(second, whole, 1, 8)
    want = table(registry.registry(o))
    assert table(statistics.profiles(statistics.stored(spark, half))) == table(statistics.profiles(statistics.stored(spark, whole))) == want


def test_stream(spark, tmp_path):
    o = observations(spark)
    o.where("record_id < 'r2'").write.parquet(f"{tmp_path}/in")
    for _ in range(2):
        jobs.registry_table(jobs.source(spark, f"{tmp_path}/in", o.schema, 1), f"{tmp_path}/s", f"{tmp_path}/c")
        if not os.path.exists(f"{tmp_path}/more"):
            os.mkdir(f"{tmp_path}/more")
            o.where("record_id >= 'r2'").write.mode("append").parquet(f"{tmp_path}/in")
    assert table(statistics.profiles(statistics.stored(spark, f"{tmp_path}/s"))) == table(registry.registry(o))
