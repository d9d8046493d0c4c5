import zlib

import duckdb
import numpy as np
import pytest

from heartwood.llm import mixing, sharding


@pytest.mark.parametrize("n", [1, 2, 3, 5, 24, 1000, 4097])
def test_permutation(n):
    p = sharding.permute(np.arange(n), n)
    assert sorted(p.tolist()) == list(range(n))
    assert (sharding.invert(p, n) == np.arange(n)).all()


def check_shards(rows, docs):
    rows = [r.asDict() for r in rows]
    assert len(rows) == len(docs)
    want = sorted((r["doc_id"] if r["doc_id"] is not None else -1, len((r["text"] or "").encode()) + 8, zlib.crc32((r["text"] or "").encode())) for r in docs)
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["size"], r["text_crc32"]) for r in rows) == want
    counts = np.bincount([r["shard"] for r in rows], minlength=24)
    assert counts.max() - counts.min() <= 1
    for s in range(24):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(counts[s]))
    for r in rows:
        assert sharding.invert(np.array([r["slot"] * 24 + r["shard"]]), len(rows))[0] == r["row"]


def test_shards(docs, odd, none):
    check_shards(sharding.shard(docs).collect(), docs.collect())
    check_shards(sharding.shard(odd).collect(), odd.collect())
    assert sharding.shard(none).count() == 0
    again = lambda: sorted(map(tuple, sharding.shard(docs.repartition(7)).select("doc_id", "shard", "slot").collect()))
    assert again() == again()


def test_mix_matches_sql(docs):
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    res = con.execute(mixing.ORACLE)
    names = [d[0] for d in res.description]
    want = sorted(tuple(str(v) for v in row) for row in res.fetchall())
    assert sorted(tuple(str(r[n]) for n in names) for r in mixing.digest(docs).collect()) == want


def test_targets_water_fill(spark):
    sizes = {"a": 10, "b": 1000, "c": 3, None: 500, "d": 0}
    got = {r["source"]: r["target"] for r in mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    weights = dict(zip(["a", "b", "c", "d", None], [1, 2, 3, 1, 2], strict=True))
    want, total, free = dict.fromkeys(sizes, 0.0), sum(sizes.values()), set(sizes)
    while True:
        level = (total - sum(3 * sizes[s] for s in sizes if s not in free)) / sum(weights[s] for s in free)
        above = {s for s in free if level * weights[s] > 3 * sizes[s]}
        if not above:
            break
        free -= above
    for s in sizes:
        want[s] = level * weights[s] if s in free else 3.0 * sizes[s]
    assert got == pytest.approx(want)


def test_mix_odd(odd, none):
    rows = mixing.digest(odd).collect()
    assert len(rows) == odd.count()
    for source in {r["source"] for r in rows}:
        own = [r for r in rows if r["source"] == source]
        assert sum(r["taken"] for r in own) == round(own[0]["target"])
        assert sum(r["size"] for r in own) == own[0]["source_size"]
        assert all(0 <= r["taken"] <= 3 * r["size"] for r in own)
    assert mixing.digest(none).count() == 0


def test_mixed_documents_hold_the_words_taken(docs, odd):
    for table in (docs, odd):
        words = mixing.mixed(table).select(mixing.n_words(mixing.F.col("text")).alias("n")).groupBy().sum("n").first()[0]
        taken = mixing.digest(table).groupBy().sum("taken").first()[0]
        assert words == taken
        assert mixing.mixed(table).columns == table.columns


def test_deep_buckets_agree(docs, monkeypatch):
    want = sorted(map(tuple, mixing.digest(docs).collect()), key=str)
    monkeypatch.setattr(mixing, "ROWS", 0.001)  # five digits: two levels of offsets
    assert sorted(map(tuple, mixing.digest(docs).collect()), key=str) == want
