import math

import duckdb
import numpy as np
import pandas as pd
import pytest

from heartwood.llm import embeddings, topk
from tests.llm import brute

SCHEMA = "vec_id long, embedding array<float>, label int, node string, copies int"


def planted(seed=5, n=1500, d=64):
    """Random vectors, chains and clouds of near copies, exact copies and scaled copies."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    for g in range(0, 600, 20):
        for i in range(1, 20):
            noise = rng.normal(size=d)
            base = x[g + i - 1] if g % 40 else x[g]  # a chain, or a cloud
            x[g + i] = base / np.linalg.norm(base) + noise / np.linalg.norm(noise) * rng.uniform(0.05, 0.33)
    x[700:720] = x[700]
    x[720] = 3 * x[700]
    return x.astype(np.float32)


def as_rows(x):
    return [(i, [float(c) for c in v], 0, "n", 1) for i, v in enumerate(x)]


def test_hadamard():
    h = embeddings.hadamard(np.eye(8))
    assert np.allclose(h @ h.T, np.eye(8)) and np.allclose(np.abs(h), 1 / math.sqrt(8))


def check_links(rows, x, recall):
    near = embeddings.brute_force(pd.DataFrame({"embedding": list(x)}))
    got = {r["vec_id"]: r for r in rows}
    found = sum(r["n_links"] for r in rows)
    assert found >= recall * near.sum()
    assert all(got[i]["n_links"] <= near[i].sum() for i in range(len(x)))
    if found == near.sum():
        want = brute.components(range(len(x)), list(zip(*np.nonzero(near), strict=True)))
        assert {i: got[i]["component_id"] for i in got} == want
        assert all(got[i]["kept"] == (want[i] == i) for i in got)
    return found / max(1, near.sum())


def test_links_of_planted_vectors(spark):
    """Recall stays above 0.9 where links lie just above the threshold, and no pair below it links."""
    x = planted()
    df = spark.createDataFrame(as_rows(x), SCHEMA)
    check_links(embeddings.near_duplicates(df).collect(), x, 0.9)
    # small blocks count the same pairs once
    a = sorted(map(tuple, embeddings.near_duplicates(df).collect()))
    assert sorted(map(tuple, embeddings.near_duplicates(df, chunk=16).collect())) == a


def test_links_of_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    x = [r["embedding"] for r in df.orderBy("vec_id").collect()]
    check_links(embeddings.near_duplicates(df).collect(), np.array(x), 0.99)


ODD = [
    (0, None, 0, "n", 1), (1, [], 0, "n", 1), (2, [0.0, 0.0], 0, "n", 1), (3, [1.0, None], 0, "n", 1), (4, [float("nan"), 1.0], 0, "n", 1), (5, [float("inf"), 1.0], 0, "n", 1),
    (6, [1.0, 0.0], 0, "n", 1), (7, [2.0, 0.0], 0, "n", 1), (8, [1.0, 0.0], 0, "n", 1), (8, [1.0, 0.0], 0, "n", 1), (9, [1.0, 0.0, 0.0], 0, "n", 1), (None, [-1.0, 0.0], 0, "n", 1),
    (50, [0.5, 0.25], 0, "n", 1), (100, [-0.1, 0.7], 0, "n", 1), (150, [0.0, 0.0], 0, "n", 1),
]


def test_odd_vectors(spark):
    df = spark.createDataFrame(ODD, SCHEMA)
    rows = embeddings.near_duplicates(df).collect()
    assert len(rows) == len(ODD)
    by = {}
    for r in rows:
        by[r["vec_id"]] = (r["n_links"], r["component_id"], r["kept"])
    for i in (0, 1, 2, 3, 4, 5, 9):
        assert by[i] == (0, i, True)
    assert by[6] == (3, 6, True) and by[7] == (3, 6, False) and by[8] == (3, 6, False) and by[None] == (0, None, True)
    assert embeddings.near_duplicates(df.where("false")).count() == 0
    assert topk.top_k(df.where("false")).count() == 0


def brute_top(rows, k=5):
    good = [(i, [math.floor(256 * c) for c in v]) for i, v, *_ in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for a, (q, x) in enumerate(good):
        if q is None or q % 50:
            continue
        scored = [(-sum(c * d for c, d in zip(x, y, strict=True)), i is None, i or 0) for b, (i, y) in enumerate(good) if b != a and len(y) == len(x)]
        out += [(q, n + 1, None if missing else i, -s) for n, (s, missing, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def test_top_of_odd_vectors(spark):
    got = sorted(map(tuple, topk.top_k(spark.createDataFrame(ODD, SCHEMA)).collect()), key=str)
    assert got == brute_top(ODD)


@pytest.mark.parametrize("block", [8192, 100])
def test_top_of_random_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", block)
    x = np.random.default_rng(2).integers(-3, 4, (700, 5)) / 256  # many ties
    rows = as_rows(x)
    assert sorted(map(tuple, topk.top_k(spark.createDataFrame(rows, SCHEMA)).collect()), key=str) == brute_top(rows)


def scored(data, queries, k=5, floor=None):
    """The fraction of candidates that the queries score."""
    lists = topk.Lists(data, np.arange(len(data)), np.arange(len(data)))
    return sum(lists.search(data[q], q, k, floor)[2] for q in queries) / (len(queries) * (len(data) - 1))


def test_top_stops_early(spark):
    """Where few components make a score, the heads of the lists do; a floor from another block stops even before; random directions need all."""
    rng = np.random.default_rng(1)
    data = np.floor(256 * rng.exponential(size=(20_000, 3)) ** 3)
    assert scored(data, range(20)) < 0.3
    spread = np.floor(256 * rng.normal(size=(4000, 32)) * 0.6 ** np.arange(32))
    assert scored(spread, range(40)) < 0.9
    q = data[0]
    lists = topk.Lists(data[1:], np.arange(1, len(data)), np.arange(1, len(data)))
    assert lists.search(q, 0, 5, floor=int(1e15))[2] <= 3 * topk.STEP
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("embedding").toPandas()["embedding"]
    even = np.floor(256 * np.stack(table.to_numpy()).astype(float))
    print("fraction scored on the table:", scored(even, range(0, len(even), 50)))


def test_huge_components_stay_exact(spark):
    rows = [(i, [float(2**20 + i) + 1 / 256, float(2**19 - 3 * i), 1.0], 0, "n", 1) for i in range(0, 120, 10)]
    got = sorted(map(tuple, topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, node string, copies int")).collect()), key=str)
    assert got == brute_top(rows)


def test_top_matches_sql(spark):
    con = duckdb.connect()
    con.execute("CREATE VIEW embeddings AS SELECT * FROM '/root/testdata/sf0.001/embeddings.parquet'")
    want = sorted(con.execute(topk.ORACLE).fetchall())
    assert sorted(map(tuple, topk.top_k(spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")).collect())) == want


def test_vectors_of_two_lengths(spark):
    rng = np.random.default_rng(4)
    rows = []
    for dim in (2, 8):
        base = rng.normal(size=(20, dim))
        rows += [(len(rows) + k, (base[k % 20] + 0.01 * rng.normal(size=dim)).tolist()) for k in range(60)]
    got = {r["vec_id"]: r for r in embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    near = np.zeros((120, 120), bool)
    for s in (0, 60):
        near[s:s + 60, s:s + 60] = embeddings.brute_force(pd.DataFrame({"embedding": [v for _, v in rows[s:s + 60]]}))
    links = [(int(i), int(j)) for i, j in zip(*np.nonzero(near), strict=True)]
    assert {k: r["n_links"] for k, r in got.items()} == {k: int(near[k].sum()) for k in range(120)}
    want = brute.components(list(range(120)), links)
    assert {k: r["component_id"] for k, r in got.items()} == want
    assert all(want[k] // 60 == k // 60 for k in want)
