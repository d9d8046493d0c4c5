import zlib
from hashlib import sha256

import duckdb
import pytest

from heartwood.llm import manifest

H = lambda *x: sha256("".join(x).encode()).hexdigest()


def leaf(r, text):
    enc = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return H(*(enc(text if c == "text" else r[c]) for c in manifest.FIELDS))


def tree(level):
    """Levels from the leaves to the root, by the contract."""
    out = [level]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i:i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def path(levels, i):
    """Pairs of the siblings before and after, level by level."""
    out = []
    for level in levels[:-1]:
        s = i // 3 * 3
        out.append((level[s:i], level[i + 1:s + 3]))
        i //= 3
    return out


def brute(rows):
    by_source = {}
    for r in rows:
        by_source.setdefault(r["source"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"]), r))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(by_source[s], key=lambda x: x[:3])]) for s in order}
    top = tree([trees[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for i, (*_, own, r) in enumerate(sorted(by_source[s], key=lambda x: x[:3])):
            beside = path(trees[s], i) + path(top, k)
            folded = own
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0 and r["text"] is not None:
                folded = leaf(r, r["text"].replace("\n", ""))
            for before, after in beside:
                folded = H(*before, folded, *after)
            out.append((str(r["doc_id"]), own, trees[s][-1][0], top[-1][0], H(*(x for a, b in beside for x in a + b)), folded, folded == top[-1][0]))
    return sorted(out)


def got(df):
    return sorted((str(r[0]), *r[1:]) for r in df.collect())


def test_whole_table_by_contract_and_sql(docs):
    want = brute([r.asDict() for r in docs.collect()])
    assert got(manifest.digest(docs)) == want
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    res = con.execute(manifest.ORACLE)
    assert [d[0] for d in res.description] == manifest.digest(docs.limit(1)).columns
    assert sorted((str(r[0]), *r[1:]) for r in res.fetchall()) == want


@pytest.mark.parametrize("tuning", [{"digits": 1}, {"digits": 2, "fill": 3, "heavy": 4}])
def test_odd(odd, none, tuning):
    want = brute([r.asDict() for r in odd.collect()])
    assert got(manifest.proofs(odd, paths=False, **tuning)) == want
    assert manifest.digest(none).count() == 0


def test_sparse_and_repeated_ids(spark):
    ids = [*range(-40, 40), *(2**62 + 7 * i for i in range(60)), *[5] * 30, *[None] * 25, -(2**63), 2**63 - 1]
    rows = [(d, "t\nu" if i % 3 else f"text {i % 7}", "en", "abc"[i % 3] if i % 5 else None, i % 2) for i, d in enumerate(ids)]
    rows += [(1, None, None, "é", None), (1, "alone", None, "", 3), *[(9, "same", "x", "b", 1)] * 20]
    df = spark.createDataFrame([(*r, "extra") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, rank string")
    want = brute([r.asDict() for r in df.collect()])
    assert got(manifest.proofs(df, paths=False, digits=1, fill=2, heavy=5)) == want
    assert got(manifest.proofs(df.repartition(5), paths=False)) == want


def test_many_sources(spark):
    rows = [(i, f"t{i}", "en", f"s{i % 40}", i) for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    want = brute([r.asDict() for r in df.collect()])
    assert got(manifest.proofs(df, paths=False, digits=2)) == want
    found = {r["source"]: r for r in manifest.roots(df).collect()}
    assert len(found) == 40 and {r["root"] for r in found.values()} == {want[0][3]}


def test_a_proof_verifies_by_itself(docs):
    some = {r["doc_id"]: r for r in docs.limit(30).collect()}
    for r in manifest.proofs(docs).where("doc_id < 400").collect():
        if r["doc_id"] not in some:
            continue
        own, left = leaf(some[r["doc_id"]].asDict(), some[r["doc_id"]]["text"]), list(r["siblings"])
        assert own == r["leaf"] and H(*left) == r["proof_sha256"]
        for before, after in zip(r["before"], r["after"], strict=True):
            own, left = H(*left[:before], own, *left[before:before + after]), left[before + after:]
        assert own == r["root"] and not left
