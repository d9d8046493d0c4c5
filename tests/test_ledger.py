"""Streams that run on: batches entered once, late rows, and pressure state with timers."""

import datetime

import pytest
from pyspark.sql import functions as F

from heartwood.config import EngineConfig
from heartwood.operators import labels
from heartwood.streaming import jobs, ledger, pressure

OBS = "session_id string, record_id string, value_name string, at timestamp"


def _at(seconds):
    return datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=seconds)


def test_a_batch_killed_before_its_entry_counts_once(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([("s", str(i % 6), "love", _at(i)) for i in range(9)], OBS)
    rows.coalesce(1).write.parquet(f"{tmp_path}/in")
    go = lambda: jobs.ingest_once(jobs.source(spark, f"{tmp_path}/in", rows.schema), f"{tmp_path}/t", f"{tmp_path}/c", "obs")
    whole = ledger.sinks.write_text

    def killed(*_):
        raise RuntimeError("killed")

    monkeypatch.setattr(ledger.sinks, "write_text", killed)
    with pytest.raises(Exception, match="killed"):
        go()
    assert ledger.read(spark, f"{tmp_path}/t", OBS).count() == 0  # its rows are written, but not entered
    monkeypatch.setattr(ledger.sinks, "write_text", whole)
    go()
    assert ledger.read(spark, f"{tmp_path}/t", OBS).count() == 6
    go()
    assert ledger.read(spark, f"{tmp_path}/t", OBS).count() == 6


def test_a_batch_run_again_is_skipped(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "k string, x int")
    assert ledger.read(spark, f"{tmp_path}/t", "k string, x int").count() == 0
    assert ledger.commit(df, f"{tmp_path}/t", "q", 0)
    assert not ledger.commit(df.union(df), f"{tmp_path}/t", "q", 0)
    assert ledger.commit(df.where("x > 1"), f"{tmp_path}/t", "q", 1) and ledger.commit(df, f"{tmp_path}/t", "other", 0)
    assert [tuple(r) for r in ledger.read(spark, f"{tmp_path}/t", "k string, x int").collect()] == [("a", 1), ("a", 1)]


def test_late_rows_are_counted_from_the_progress(spark, tmp_path):
    cols, day = "ts timestamp, event_type string, value double", 86_400
    parts = [spark.createDataFrame([(_at(s), "a", 1.0) for s in part], cols) for part in ((0, day), (9 * day,), (day + 5, 8 * day, 2 * day), (60 * day,))]
    late = jobs.fed(parts, lambda e: jobs.windowed(e, "72 hours", "1 day"), f"{tmp_path}/in", ledger.sink(f"{tmp_path}/t", "w"), f"{tmp_path}/c")
    got = ledger.read(spark, f"{tmp_path}/t", "start timestamp, event_type string, n long, total double")
    assert sorted(((r["start"] - _at(0)).days, r["n"]) for r in got.collect()) == [(0, 1), (1, 1), (8, 1), (9, 1)] and late == 2


ROWS = "session_id string, record_id string, ts double, passage_idx int, kind string, at timestamp"


@pytest.fixture
def rocks(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, pressure.STATE_STORE)
    yield
    spark.conf.set(key, before)


def _run(spark, tmp_path, parts, seconds, within=5, forget=None):
    make = lambda rows: spark.createDataFrame([(*r, _at(r[2])) for r in rows], ROWS)
    build = lambda e: pressure.pressure(e.withWatermark("at", "200 seconds"), cfg=EngineConfig(pressure_seconds=seconds, pressure_passages=within), forget=forget)
    jobs.fed([make(p) for p in parts], build, f"{tmp_path}/in", ledger.sink(f"{tmp_path}/t", "p"), f"{tmp_path}/c")
    return make([r for p in parts for r in p]), ledger.read(spark, f"{tmp_path}/t", "session_id string, record_id string, pressure_source_id string, lag_s double, lag_n int")


def test_pressure_state_equals_the_as_of_join(spark, tmp_path, rocks):
    """Rows in any order within the watermark, over several batches."""
    rows = [(f"s{i % 3}", f"{'p' if i * 7 % 4 else 'f'}{i}", float(i * 11 % 97 + i), i % 40 if i % 3 == 1 else -1, "pressure" if i * 7 % 4 else "failed") for i in range(60)]
    every, got = _run(spark, tmp_path, [rows[k::3] for k in range(3)] + [[("z", "end", 9_000.0, -1, "pressure")]], seconds=12.0, within=2)
    old = labels.with_pressure(every.where("kind = 'failed'").drop("kind", "at"), every.where("kind = 'pressure'").drop("kind", "at"), 12.0, 2, span=10.0).where("pressure_source_id is not null")
    want = sorted(tuple(r) for r in old.select("session_id", "record_id", "pressure_source_id", "deferred_apy_lag_s", "deferred_apy_lag_n").collect())
    assert sorted(tuple(r) for r in got.collect()) == want and len(want) > 3


def test_pressure_state_is_bounded_and_expires(spark, tmp_path, rocks):
    many = [("s", f"p{i}", float(i), -1, "pressure") for i in range(300)]
    placed = [("s", f"q{i}", float(i), i, "pressure") for i in range(300)]
    # between the parts the watermark passes: 5 rows are held of the first, none once their time is over
    parts = [many, [("t", "x", 900.0, -1, "pressure")], [("s", "f", 901.0, -1, "failed")], [("t", "end", 9_000.0, -1, "pressure")]]
    _, got = _run(spark, tmp_path / "a", parts, seconds=50.0)
    assert got.count() == 0
    _, got = _run(spark, tmp_path / "b", [placed, *parts[1:3], [("s", "g", 1_000.0, 301, "failed")], parts[3]], seconds=50.0)
    assert [tuple(r) for r in got.collect()] == [("s", "g", "q299", 701.0, 2)]
    _, got = _run(spark, tmp_path / "c", [placed, *parts[1:3], [("s", "g", 1_000.0, 301, "failed")], parts[3]], seconds=50.0, forget=60.0)
    assert got.count() == 0
    held = spark.read.format("statestore").option("stateVarName", "held").load(f"{tmp_path}/b/c")
    assert held.where("key.session_id = 's'").count() == 5
