"""Texts are read and looked through once for each layer, and what is cheap to ask is asked first."""

import re

import pytest
from pyspark.sql import functions as F

from heartwood.functions import gates, text
from heartwood.operators import embedding, extract, ingest, signals
from heartwood.plans import binding, catalog

TEXTS = ["I would rather die than lie.", "They insisted, and I yielded.", "Ştories of mercy.", "İN WINTER. Kin.", "WEAK", "Onth thandin ering.", "It was unfair", "", None]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def docs(spark):
    rows = [(i, "a", f"{t} A second sentence stands here, so that it is long enough. " if t is not None else None) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, figure string, text string")


def test_a_text_is_cut_once(spark):
    assert "(size(" not in plan(ingest.passages(docs(spark), 1e9))


def test_weights_read_texts_once(spark):
    assert plan(embedding.weights(docs(spark))).count("MapInArrow") == 1


def test_merging_is_not_asked_for_twice(spark, monkeypatch):
    monkeypatch.setattr(binding, "likeness", lambda s, d: None)
    monkeypatch.setattr(binding, "passages", lambda s, d: ingest.passages(docs(s).withColumn("pronoun", F.lit("i")), 1e9))
    joins = [line for line in plan(binding.merged(spark, "/nowhere")).split("\n") if "Join" in line]
    assert joins and max(map(len, joins)) < 5000


def test_facts_are_scored_once(spark):
    p = ingest.passages(docs(spark), 1e9)
    assert "Filter (cast(FLOOR" not in plan(extract.facts(p)) and not re.search(r"Filter [^\n]*isnan", plan(extract.facts(p)))
    marked = extract.marked(p, binding.lexicon(spark), binding.strength(spark))
    key = lambda df: sorted(map(str, df.collect()))
    assert key(extract.facts(p)) == key(extract.facts(marked)) and marked.where("not loud").count()


def test_classifier_scores_need_no_vectors(spark, monkeypatch):
    monkeypatch.setattr(binding, "passages", lambda s, d: s.range(40).selectExpr("cast(id as string) id", "id doc_id", "0 place"))
    monkeypatch.setattr(binding, "component_weights", lambda s, d: pytest.fail("weights are read"))
    monkeypatch.setattr(binding, "prototypes", lambda s, d: pytest.fail("prototypes are read"))
    assert catalog.q_classifier_signals(spark, "/nowhere").count()


def test_no_word_is_lost(spark):
    words = ["winter", "weak", "mercy", "unfair"]
    df = spark.createDataFrame([(t,) for t in TEXTS if t], "t string").select("t", F.coalesce(gates.may(F.col("t"), [], words), F.lit(True)).alias("may"), text.tokens(F.col("t")).alias("k"))
    rows = df.collect()
    assert all(r["may"] for r in rows if set(r["k"]) & set(words)) and not all(r["may"] for r in rows)


def plainly(t, size=450, shortest=30):
    """Sentences packed one after another."""
    out, cur = [], ""
    for s in re.split(r"(?<=[.!?])\s+", (t or "").strip(" \t\n\x0b\f\r"), flags=re.ASCII):
        if cur and len(cur) + 1 + len(s) > size:
            out.append(cur)
            cur = s
        else:
            cur = f"{cur} {s}" if cur else s
    return [p for p in [*out, cur] if len(p) >= shortest]


def test_passages_are_sentences_in_order(spark):
    odd = [None, "", " \t\n", "a.", "A. b! C?  d.\n\n e " * 80, "x" * 1000 + ". y. " + "z" * 449 + ". w", "!!! ... ??? " * 200, "é\U0001d54f. " * 300, "no end at all " * 100, "a" * 449 + ". b", "a" * 448 + ". b. ", "x. " * 149 + "yy. end"]
    got = {r["i"]: r["p"] for r in spark.createDataFrame(list(enumerate(odd)), "i int, t string").select("i", text.passages(F.col("t")).alias("p")).collect()}
    assert got == {i: plainly(t) for i, t in enumerate(odd)}


def test_layers_read_only_what_asks_for_them(spark):
    """Marks stored with the passages leave the layers fewer texts to read, and all their signals."""
    v, lex, strength = binding.vocabulary(spark), binding.lexicon(spark), binding.strength(spark)
    rows = [(i, "a", f"{t} And a second sentence stands here, so that it is long enough. ", "i") for i, t in enumerate([*binding.TEMPLATES, *(t for t in TEXTS if t)])]
    p = ingest.passages(spark.createDataFrame(rows, "doc_id long, figure string, text string, pronoun string"), 1e9).cache()
    marked = extract.marked(p, lex, strength, v).cache()
    for bit in (extract.WORDED, extract.NAMED, extract.ASKED.index(extract.fixed.PRESSURE_MARKERS)):
        assert 0 < extract._asking(marked, bit).count() < p.count()
    key = lambda df: sorted(map(str, df.collect()))
    assert key(extract.merged_signals(p, v, lex, strength)) == key(extract.merged_signals(marked, v, lex, strength))
    assert key(extract.pressure(p)) == key(extract.pressure(marked)) and key(extract.facts(p)) == key(extract.facts(marked))


def test_archaic_forms_are_looked_for_in_batches(spark):
    odd = ["Thou art", "thouä", "hast́ hast", "nay²", "xthou 'tis", "x'tis", "Kthou", "THÉE thee", "thou", "", None, "yeax yea"]
    df = spark.createDataFrame(list(enumerate(odd)), "i int, t string").select("i", text.modernised(F.col("t")).alias("n"))
    assert "ArrowEvalPython" in plan(df) and "regexp_extract_all" not in plan(df)
    assert [r["n"] for r in df.orderBy("i").collect()] == ["You are", "thouä", "hast́ have", "no²", "xthou it is", "x'tis", "Kyou", "THÉE you", "you", "", None, "yeax yes"]


def test_features_are_hashed_once(spark, monkeypatch, tmp_path):
    """Weights and likeness read the stored features, which hold what the texts do: wide sums, and components whose signs cancel."""
    import numpy as np

    texts = [*TEXTS, "word " * 3000, "the honest man kept his promise " * 3]
    p = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "id string, text string")
    monkeypatch.setattr(binding, "passages", lambda s, d: p)
    f = binding.features(spark, str(tmp_path))
    rows = {r["id"]: bytes(r["features"]) for r in f.collect()}
    assert {len(r) for r in rows.values()} == {embedding.DIM, 4 * embedding.DIM}
    each = [rows[str(i)] for i in range(len(texts))]
    x, has = (np.concatenate(c) for c in list(zip(*embedding._stored(each, embedding.DIM), strict=True))[2:])
    assert (x == embedding.sums(texts)).all() and (has.sum(0) == embedding.present(texts)).all() and (has & (x == 0)).any()
    assert sorted(embedding.weights(f, "features").collect()) == sorted(embedding.weights(p).collect())
    monkeypatch.setattr(binding, "passages", lambda s, d: pytest.fail("texts are read again"))
    assert binding.likeness(spark, str(tmp_path)).columns == ["id", "value_name", "confidence"]


def test_joined_rows_are_not_dealt_again(spark):
    """Verdicts join while rows lie by passage and value, places while they lie by passage: two shuffles of all rows less than 13."""
    rows = [(i, "a", f"{t} A second sentence stands here.", "i") for i, t in enumerate(binding.TEMPLATES)]
    p = ingest.passages(spark.createDataFrame(rows, "doc_id long, figure string, text string, pronoun string"), 1e9)
    verdicts = p.select("id", F.when(F.col("doc_id") % 2 == 0, "courage").otherwise("love").alias("value_name"), F.lit("P1").alias("verdict"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = extract.extract(p, binding.vocabulary(spark), binding.lexicon(spark), binding.strength(spark), verdicts=verdicts)
        assert plan(found).count("Exchange hashpartitioning") == 11
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_repeated_signals_are_read_once(spark, monkeypatch, tmp_path):
    rows = [("figure:a", f"r{i}", v, 0.5 + i / 100, 1 if i % 3 else -1, "x" * (195 + i), "letter") for i in range(12) for v in ("courage", "love")]
    spark.createDataFrame(rows, "session_id string, record_id string, value_name string, resistance double, value_polarity int, text_excerpt string, doc_type string").write.parquet(str(tmp_path / "o"))
    monkeypatch.setattr(binding, "observations", lambda s, d: s.read.parquet(str(tmp_path / "o")))
    df = catalog.q_new_observations(spark, "/nowhere")
    shown = plan(df)
    shown = shown.split("== Initial Plan ==")[-1]
    assert shown.count("FileScan parquet") == 2 and "doc_type" not in shown  # the signals, and those that are known
    assert sorted(map(tuple, df.collect())) == sorted((s, r, v, res, 1.0, min(len(t), 200)) for s, r, v, res, p, t, _ in rows if p > 0)


def test_values_that_are_only_raised_end_before_the_joins(spark):
    """A score too low to stand alone raises another layer's signal and gives none itself, so its rows meet neither verdicts nor facts."""
    frame = lambda rows, kind: spark.createDataFrame(rows, kind)
    near = "struct<polarity:int,confidence:double>"
    kw = frame([("a", "love", 0.6, 3, "x", None)], f"id string, value_name string, confidence double, match_idx int, text_excerpt string, around {near}")
    lex = frame([("b", "love", "virtue", 0.1, "lexicon"), ("c", "love", "vice", 0.1, "lexicon_vice"), ("d", "love", "vice", 0.9, "lexicon_vice")], "id string, value_name string, polarity string, confidence double, source string")
    said = frame([("e", "love", -1, 2, 0.5, "phrase_layer")], "id string, value_name string, polarity_hint int, match_idx int, confidence double, source string")
    sem = frame([("f", "love", 0.4), ("b", "hope", 0.4)], "id string, value_name string, confidence double")
    zs = frame([("a", "love", 0.5), ("g", "love", 0.5), ("h", "love", 0.7), ("i", "love", 0.1), ("j", "love", None)], "id string, value_name string, confidence double")
    cl = frame([("a", "love", 0, 0.65), ("k", "love", 0, 0.65), ("l", "love", 0, 0.65), ("l", "love", 1, 0.85)], "id string, value_name string, ord int, score double")
    facts = frame([(c, 0.25) for c in "abcdefghijkl"], "id string, struct_score double")
    got = signals.merge(kw, lex, said, sem, facts, zs, cl)
    assert sorted((r["id"], r["value_name"], r["source"]) for r in got.collect()) == [
        ("a", "love", "keyword+structural+zeroshot+mft"), ("b", "hope", "semantic+structural"), ("d", "love", "lexicon_vice"), ("e", "love", "phrase_layer+structural"),
        ("f", "love", "semantic+structural"), ("h", "love", "zeroshot"), ("l", "love", "mft"),
    ]
    ahead = plan(got).split("Join")[-1]
    assert "Filter" in ahead and "isnotnull(kw" in ahead
