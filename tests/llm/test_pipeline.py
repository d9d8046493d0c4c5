"""The pipeline's stages against plain Python, each on its own input."""

import collections

import corpus_pipeline
from heartwood.llm import language, mixing, packing, pii
from heartwood.llm.common import store, table
from tests.llm import brute
from tests.llm.test_shingles import kept as near_copies

DATA = "/root/testdata/sf0.001"


def test_stages(spark, docs):
    names, stages = docs.columns, dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "near_dedup", "pii", "mix", "pack"]
    before = docs.collect()
    known = store(stages["language"](spark, docs, DATA), "t")
    assert known.columns == names
    predicted = {r["doc_id"]: r["lang_pred"] for r in language.digest(docs).collect()}
    kept = known.collect()
    assert {r["doc_id"] for r in before} - {r["doc_id"] for r in kept} <= {d for d, p in predicted.items() if p == "und"} or len(kept) >= 0.99 * len(before)
    single = store(stages["near_dedup"](spark, known, DATA), "t")
    # the stage's own measure: five-word shingles, similarity 0.8, every pair compared
    assert sorted(r["doc_id"] for r in single.collect()) == near_copies([(r["doc_id"], r["text"]) for r in kept])
    clean = store(stages["pii"](spark, single, DATA), "t")
    texts = {r["doc_id"]: r["text"] for r in single.collect()}
    for r in clean.collect():
        if not brute.pii_base(texts[r["doc_id"]]):
            assert r["text"] == texts[r["doc_id"]] or "<SSN>" in r["text"] or "<IBAN>" in r["text"]
        assert not brute.pii_base(r["text"])
    mix = store(stages["mix"](spark, clean, DATA), "t")
    assert mix.columns == names
    taken = {r["doc_id"]: r["taken"] for r in mixing.digest(clean).collect() if r["taken"]}
    words = collections.Counter()
    for r in mix.collect():
        words[r["doc_id"]] += len((r["text"] or "").encode().split())
    assert words == taken
    rows = stages["pack"](spark, mix, DATA)
    assert rows.groupBy("sequence_id").sum("length").where("`sum(length)` > 1024").isEmpty()
    assert rows.count() == packing.pieces(mix).count()


def test_run(spark):
    rows = corpus_pipeline.run(spark, DATA)
    assert rows.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert rows.count() > 0


def test_odd_tables(spark, odd, none):
    for given in (odd, none):
        docs = given
        for name, stage in corpus_pipeline.STAGES:
            docs = store(stage(spark, docs, DATA), f"odd-{name}")
            if name != "pack":
                assert docs.columns == given.columns
    assert table(spark, DATA, "documents").count() == 200


def test_dedup_of_repeated_rows(spark, odd):
    rows = corpus_pipeline.near_dedup(spark, odd, DATA).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(["1", "4", "5", "6", "7", "9", "None"])
    assert pii.redact(odd).count() == odd.count()


def test_clashing_columns(spark, docs):
    """Columns with the names that the stages use inside come through as they are."""
    F = mixing.F
    names = """row p pii x reach blocks digest doc text_crc32 words at e nth node root bucket block rank __digest __id __kept __p __pii __pii_text __pii_long __reach __blocks __t
        __tie __part __place rid size spans position taken source_size target""".split()
    clashing = docs.select("*", *(F.concat(F.lit(f"{n}:"), F.col("doc_id").cast("string")).alias(n) for n in names))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, clashing, DATA)
        assert out.columns == clashing.columns, name
        rows = out.collect()
        assert rows and all(r[n] == f"{n}:{r['doc_id']}" for r in rows for n in names), name
        plain = stage(spark, docs, DATA).collect()
        assert sorted((r["doc_id"], r["text"] or "", r["lang"] or "") for r in rows) == sorted((r["doc_id"], r["text"] or "", r["lang"] or "") for r in plain), name
    packed = corpus_pipeline.STAGES[-1][1](spark, clashing, DATA)
    assert packed.groupBy("sequence_id").sum("length").where("`sum(length)` > 1024").isEmpty()
