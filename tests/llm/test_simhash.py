import random

import numpy as np

from heartwood.llm import simhash
from tests.llm import brute


def got(df):
    return {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in df.collect()}


def test_documents(docs):
    assert got(simhash.near_duplicates(docs)) == brute.simhash([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_odd_rows(odd, none):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    want = brute.simhash([(r["doc_id"] if r["doc_id"] is not None else 10**9, r["text"]) for r in odd.collect()])
    for r in rows:
        f, c = want[r["doc_id"] if r["doc_id"] is not None else 10**9]
        assert r["fingerprint"] == f and (r["component_id"] == c or c == 10**9 and r["component_id"] is None)
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.deduplicate(odd).columns == odd.columns


def test_compare_finds_all_pairs():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    fps = np.concatenate([base[rng.integers(0, 40, 300)] ^ (np.uint64(1) << rng.integers(0, 63, 300, dtype=np.uint64)) for _ in range(2)])
    group = np.sort(rng.integers(0, 9, len(fps)))
    first, last = np.searchsorted(group, group), np.searchsorted(group, group, "right")
    for radius in (0, 1, 2, 3, 5, 12):
        i, j = simhash.compare(fps, first, last, radius)
        want = {(a, b) for a in range(len(fps)) for b in range(a + 1, last[a]) if int(fps[a] ^ fps[b]).bit_count() <= radius}
        assert set(zip(i.tolist(), j.tolist(), strict=True)) == want


def test_large_bucket_is_chunked(spark):
    """A group far larger than a chunk, whose links only chain through one another, stays whole."""
    rng = random.Random(3)
    fps, x = [], rng.getrandbits(64)
    for _ in range(400):
        x ^= 1 << rng.randrange(64)
        fps.append(x - 2**64 if x >> 63 else x)
    fps = sorted(set(fps))
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    links = [(r["u"], r["v"]) for r in simhash.links(df, chunk=16).collect()]
    want = brute.components(fps, [(a, b) for a in fps for b in fps if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 2])
    assert brute.components(fps, links) == want
    found = {r["node"]: r["root"] for r in simhash.components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert {f: found.get(f, f) for f in fps} == want


def test_compare_wide_fingerprints():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**63, (6, 2), dtype=np.uint64)
    fps = base[rng.integers(0, 6, 200)]
    for _ in range(20):
        fps[np.arange(200), rng.integers(0, 2, 200)] ^= np.uint64(1) << rng.integers(0, 64, 200).astype(np.uint64)
    first, last = np.zeros(200, np.int64), np.full(200, 200)
    for radius in (7, 16, 31, 40, 63):
        i, j = simhash.compare(fps, first, last, radius)
        want = {(a, b) for a in range(200) for b in range(a + 1, 200) if sum(int(x).bit_count() for x in fps[a] ^ fps[b]) <= radius}
        assert set(zip(i.tolist(), j.tolist(), strict=True)) == want
