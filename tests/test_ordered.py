"""Global ranks, hash trees over ordered records, and what rests on them."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from heartwood.operators import ordered, quality


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree(leaves, fanout):
    """Plain Python: consecutive runs become one node until one is left."""
    while len(leaves) > 1:
        leaves = [sha("".join(leaves[i : i + fanout])) for i in range(0, len(leaves), fanout)]
    return leaves[0]


@pytest.mark.parametrize("n", [0, 1, 7, 500])
def test_ranks(spark, n):
    rows = [(i * 7919 % 101, str(i)) for i in range(n)]
    got = ordered.ranked(spark.createDataFrame(rows, "x int, rank_ string").repartition(5), "x", F.length("rank_")).collect()
    assert sorted(r["rank"] for r in got) == list(range(n))
    assert [(r["x"], len(r["rank_"])) for r in sorted(got, key=lambda r: r["rank"])] == sorted((x, len(s)) for x, s in rows)


def test_ranks_with_nulls_and_a_value_of_a_third_of_all_rows(spark):
    rows = [(None,)] * 40 + [(5,)] * 300 + [(i,) for i in range(560)]
    got = ordered.ranked(spark.createDataFrame(rows, "x int").repartition(7), "x").collect()
    assert [r["x"] for r in sorted(got, key=lambda r: r["rank"])] == [None] * 40 + sorted(x for (x,) in rows[40:])


@pytest.mark.parametrize("fanout", [2, 3, 10])
def test_hash_tree(spark, fanout):
    sizes = {"a": 1, "b": 2, "c": 9, "d": 28, "e": 100}
    rows = [(g, i, f"{g}-{i * i % 17}") for g, n in sizes.items() for i in range(n)]
    random.Random(3).shuffle(rows)
    want = {g: tree([sha(f"{g}-{i * i % 17}") for i in range(n)], fanout) for g, n in sizes.items()}
    for parts in (1, 6):
        df = spark.createDataFrame(rows, "g string, i int, t string").repartition(parts)
        groups = ordered.grouped_hashes(df, ["g"], F.col("t"), "i", fanout=fanout)
        assert {r["g"]: (r["n"], r["hash"]) for r in groups.collect()} == {g: (n, want[g]) for g, n in sizes.items()}
        top = ordered.root(groups, ["g"], fanout).first()
        assert (top["n"], top["hash"]) == (140, tree([sha(f"{g}\u0001{h}") for g, h in sorted(want.items())], fanout))


FIELDS = "figure string, value_name string, label string, label_reason string, document_type string, text_excerpt string, confidence double, resistance double, disambiguation_confidence double, observation_consistency double, ts double"


def _records(spark, n=40, **changed):
    rows = [[f"f{i % 3}", f"v{i % 7}", "P1", "", "letter", f"text {i % 11} of some length", (i * 37 % 100) / 100, 0.5, 0.9, 0.6, float(i * 13 % 40)] for i in range(n)]
    for i, label in changed.items():
        rows[int(i[1:])][2] = label
    return spark.createDataFrame([tuple(r) for r in rows], FIELDS)


def test_digest_and_differing_ranges(spark):
    r = _records(spark)
    assert quality.digest(r).first() == quality.digest(r.repartition(7, "ts")).first() and len(quality.digest(r).first()[0]) == 16
    assert quality.differing(r, r.orderBy(F.desc("ts"))).count() == 0
    other = _records(spark, 41, i5="P0", i8="APY")  # rows 5 and 8 have another label, row 40 is new
    assert sorted(tuple(x) for x in quality.differing(r, other).collect()) == [("f1", "v5", 1, 2), ("f2", "v1", 2, 2), ("f2", "v5", 2, 2)]
    # the order of moments counts: two records of one range trade theirs
    swap = r.withColumn("ts", F.when((F.col("figure") == "f0") & (F.col("value_name") == "v0"), 99 - F.col("ts")).otherwise(F.col("ts")))
    assert quality.differing(r.withColumn("text_excerpt", F.lit("one")), swap.withColumn("text_excerpt", F.lit("one"))).count() == 1
    assert quality.digest(r.limit(0)).count() == 0


def test_halves_by_global_parity(spark):
    rows = sorted((tuple(x) for x in _records(spark).collect()), key=lambda x: (x[0], x[1], x[5][:40], x[10], x[2], x[6]))
    got = {r["half"]: (r["value_coverage"], r["avg_confidence"]) for r in quality.halves(_records(spark).repartition(5)).collect()}
    for half in (0, 1):
        own = rows[half::2]
        assert got[half][0] == len({x[1] for x in own}) and got[half][1] == pytest.approx(sum(x[6] for x in own) / len(own))
    none = _records(spark).withColumns({"text_excerpt": F.lit(None).cast("string"), "value_name": F.lit(None).cast("string"), "ts": F.lit(None).cast("double")})
    assert quality.halves(none).count() == 2 and quality.digest(none).count() == 1
