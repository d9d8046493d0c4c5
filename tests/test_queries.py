"""Registered queries against their SQL in DuckDB, over the smallest tables."""

import duckdb
import pytest

from heartwood.plans import catalog, oracles

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
#: One for each family; the driver compares all of them.
CHOSEN = [
    "q_flagship", "q_segment", "q_calibrated", "q_archaic", "q_keyword_hits", "q_lexicon_signals", "q_polarity", "q_phrase_signals", "q_merge_confidence", "q_observations", "q_pressure", "q_training_records", "q_report", "q_record_files", "q_lexicon_files", "q_gold_match", "q_languages", "q_registry", "q_running_registry", "q_figures", "q_apy_upgrade", "q_event_asof", "q_tension", "q_label_cube",
    "q_corpus_quality", "q_threshold_sweep", "q_semantic_topk", "q_stream_pressure", "q_event_sessions", "q_set_operations",
]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", CHOSEN)
def test_query(spark, duck, name):
    df = catalog.QUERIES[name](spark, DATA)
    res = duck.execute(oracles.ORACLES[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted(tuple(str(r[names.index(c)]) for c in sorted(names)) for r in res.fetchall())
    got = sorted(tuple(str(r[c]) for c in sorted(names)) for r in df.collect())
    assert got == want and got


def test_entry_registers_every_query():
    import __spark_entry__ as e

    assert set(catalog.QUERIES) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())
