"""Operators on small tables."""

import json

import pytest
from pyspark.sql import functions as F

from heartwood.config import EngineConfig
from heartwood.operators import corpus, extract, gold, ingest, labels, quality, registry, semantic, signals
from heartwood.plans import binding


def note(spark, *texts, kind="journal", figure="src", pronoun="unknown"):
    return spark.createDataFrame([(str(i), t, kind, 0.9, figure, pronoun) for i, t in enumerate(texts)], "id string, text string, doc_type string, significance double, figure string, pronoun string")


def keywords(spark, text, value, **kw):
    rows = signals.keyword_signals(note(spark, text, **kw), binding.vocabulary(spark)).where(F.col("value_name") == value).collect()
    return (rows[0]["keyword"], rows[0]["confidence"]) if rows else None


@pytest.mark.parametrize(
    ("text", "value", "kind", "want"),
    [
        ("I was brave", "courage", "journal", ("brave", 1.0)), ("I was not brave", "courage", "journal", None), ("She was brave", "courage", "journal", None), ("She was brave", "courage", "action", ("brave", 0.7)),
        ("I put on a brave face", "courage", "journal", None), ("I never fled", "courage", "journal", ("fled", 1.0)), ("The dishonest man", "integrity", "journal", None), ("An honest man", "integrity", "journal", ("honest", 0.6)),
        ("We won't give up", "commitment", "journal", ("won't give up", 1.0)), ("fair weather", "fairness", "journal", None), ("fair weather, but justice", "fairness", "journal", ("justice", 0.6)), ("my patients waited, waiting", "patience", "journal", ("waiting", 1.0)),
    ],
)
def test_keywords(spark, text, value, kind, want):
    assert keywords(spark, text, value, kind=kind) == want


def test_lexicon(spark):
    rows = {(r["value_name"], r["polarity"]): (r["confidence"], r["source"]) for r in signals.lexicon_signals(note(spark, "Mercy and weak lies"), binding.lexicon(spark), binding.strength(spark)).collect()}
    assert rows["compassion", "virtue"] == (0.67, "lexicon+ms")
    assert rows["compassion", "vice"] == (round(0.55 * 3.5 / 4.5, 4), "lexicon+ms_vice")
    assert rows["fairness", "vice"] == (0.55, "lexicon_vice")


@pytest.mark.parametrize(
    ("text", "pronoun", "hint"),
    [
        ("He committed cruelty", "he", -1), ("They committed cruelty", "he", None), ("They committed cruelty", "unknown", -1), ("men committed cruelty against him", "he", None), ("men committed cruelty against her", "he", -1),
        ("Src ordered cruelty", "he", -1), ("She opposed cruelty", "he", 1), ("cruelty came", "he", None), ("I inflicted cruelty", "i", -1),
    ],
)
def test_phrases(spark, text, pronoun, hint):
    rows = signals.phrase_signals(note(spark, text, pronoun=pronoun), binding.lexicon(spark)).collect()
    assert {r["polarity_hint"] for r in rows} == ({hint} if hint else set())
    assert all(r["match_idx"] == text.lower().index("cruelty") for r in rows)


def test_merge(spark):
    df = lambda rows, cols: spark.createDataFrame(rows, cols)
    kw = df([("1", "courage", 0.6, 4, "an excerpt", (1, 0.8))], "id string, value_name string, confidence double, match_idx int, text_excerpt string, around struct<polarity:int,confidence:double>")
    lex = [("1", "courage", "virtue", 0.55, "lexicon"), ("1", "love", "virtue", 0.55, "lexicon+ms"), ("1", "growth", "virtue", 0.5, "lexicon"), ("1", "fairness", "vice", 0.55, "lexicon_vice"), ("1", "courage", "vice", 0.55, "lexicon_vice")]
    lex = df(lex, "id string, value_name string, polarity string, confidence double, source string")
    ph = df([("1", "courage", -1, 0.58, 9, "phrase_layer"), ("1", "courage", 1, 0.58, 2, "phrase_layer")], "id string, value_name string, polarity_hint int, confidence double, match_idx int, source string")
    score = lambda *rows: df([("1", *r) for r in rows], "id string, value_name string, confidence double")
    sem, zs = score(("love", 0.5), ("humility", 0.4)), score(("love", 0.4), ("patience", 0.7), ("growth", 0.5), ("humility", 0.3))
    st = df([("1", 0.5, "kept")], "id string, struct_score double, extra string")
    cl = df([("1", "humility", 0, 0.6), ("1", "loyalty", 2, 0.6), ("1", "loyalty", 4, 0.8), ("1", "loyalty", 6, 0.9)], "id string, value_name string, ord int, score double")
    out = signals.merge(kw, lex, ph, sem, st, zs, cl).collect()
    assert {r["extra"] for r in out} == {"kept"}
    rows = {(r["value_name"], r["layer"], r["signal_ord"]): (r["confidence"], r["source"], r["polarity_hint"]) for r in out}
    assert rows == {
        ("courage", 0, 0): (pytest.approx(0.7575), "keyword+lexicon+structural", None), ("courage", 2, 1): (pytest.approx(0.655), "phrase_layer+structural", 1), ("courage", 2, 2): (pytest.approx(0.655), "phrase_layer+structural", -1),
        ("love", 1, 0): (pytest.approx(0.785), "lexicon+ms+semantic+structural+zeroshot", None), ("humility", 3, 0): (pytest.approx(0.535), "semantic+structural+mft", None), ("patience", 4, 0): (0.7, "zeroshot", None),
        ("loyalty", 5, 0): (pytest.approx(0.49), "mft", None), ("fairness", 6, 0): (0.55, "lexicon_vice", -1),
    }
    verdicts = df([("1", "courage", "tension"), ("1", "love", "P0"), ("1", "patience", "discard"), ("1", "loyalty", "skip")], "id string, value_name string, verdict string")
    got = {(r["value_name"], r["signal_ord"]): (r["polarity_hint"], r["source"].endswith("+panel")) for r in signals.verified(signals.merge(kw, lex, ph, sem, st, zs, cl), verdicts).collect()}
    assert got["courage", 0] == (1, True) and got["courage", 1] == (-1, True) and got["love", 0] == (-1, True) and got["loyalty", 0] == (None, False)
    assert not any(v == "patience" for v, _ in got)


def test_classifier(spark):
    s = spark.createDataFrame([("a", "LABEL_0", 0.61), ("a", "LABEL_2", 0.59), ("a", "LABEL_7", 0.9), ("a", "LABEL_1", 0.86), ("a", "other", 1.0)], "id string, label string, score double")
    assert {(r["value_name"], r["score"]) for r in signals.classifier_signals(s).collect()} == {("compassion", 0.61), ("love", 0.61), ("gratitude", 0.61), ("independence", 0.63)}
    assert {(r["foundation"], r["score"]) for r in signals.vice_flags(s).collect()} == {("authority", 0.9), ("care", 0.86)}


def passages_of(spark, *rows):
    cols = "id string, session_id string, figure string, text string, doc_type string, significance double, ts double, source_authenticity double, pub_year int, pronoun string"
    return spark.createDataFrame([(f"p{i}", "figure:src", "src", t, kind, sig, ts, auth, year, "i") for i, (t, kind, sig, ts, auth, year) in enumerate(rows)], cols)


def test_extraction(spark):
    """Gates, calibration, modulation, polarity around the keyword, hints, excerpts and places, from texts to observations."""
    p = passages_of(
        spark, ("I was brave and honest, and I stood firm despite the risk, for justice.", "journal", 0.9, 1.0, 1.0, None), ("I was brave.", "journal", 0.05, 2.0, 1.0, None),
        ("I was brave.", "unknown", 0.2, 3.0, 1.0, None), ("I was brave." + " filler" * 60 + " tyranny", "journal", 0.9, 4.0, 0.7, 1500), ("The men resisted cruelty under pressure.", "letter", 0.8, 5.0, 1.0, None),
    )
    o = {(r["record_id"], r["value_name"]): r for r in extract.extract(p, binding.vocabulary(spark), binding.lexicon(spark), binding.strength(spark)).collect()}
    first = o["p0", "courage"]
    assert (first["passage_idx"], first["source"], first["value_polarity"], first["polarity_confidence"]) == (0, "keyword+structural", 1, 0.8)
    assert first["resistance"] == pytest.approx(0.57 * round(0.85 + 0.15 * 0.2375, 4), abs=1e-4)
    assert not [k for k in o if k[0] in ("p1", "p2")]  # under the significance and the resistance gate
    far = o["p3", "courage"]
    assert (far["value_polarity"], far["passage_idx"], far["disambiguation_confidence"]) == (0, 2, 0.56) and far["text_excerpt"].endswith("...")
    against = o["p4", "compassion"]
    assert (against["value_polarity"], against["source"], against["polarity_confidence"]) == (1, "phrase_layer+structural", 0.6044)
    assert [(r["record_id"], r["markers"], r["passage_idx"]) for r in extract.pressure(p).collect()] == [("p4", "under pressure", 3)]


def test_places(spark):
    rows = [(f"id{i}", "figure:" + "ab"[i % 2], float(i // 6), "text", 0.5 if i % 5 else 0.05) for i in range(40)]
    p = spark.createDataFrame(rows, "id string, session_id string, ts double, text string, significance double")
    got = {r["id"]: r["passage_idx"] for r in ingest.places(p).collect()}
    for s in ("figure:a", "figure:b"):
        kept = sorted((r[2], r[0]) for r in rows if r[1] == s and r[4] >= 0.1)
        assert [got[i] for _, i in kept] == list(range(len(kept)))


def test_marks_and_batches(spark):
    docs = spark.createDataFrame([("Ann", "a", 1, "A sentence that is long enough to count.", 1900, None), ("Bea", "b", 2, "A sentence that is long enough to count.", 1900, None), ("Bea", "c", 3, None, None, "file not found"), ("x y", "d", 4, "A sentence that is long enough to count.", 1900, None)], "figure string, file string, doc_id long, text string, pub_year int, error string")
    marks = spark.createDataFrame([("figure:ann", 5.0)], "session_id string, mark double")
    good, bad = ingest.batch(docs, 1e9, marks)
    assert {r["figure"]: r["ts"] for r in good.collect()} == {"Ann": 6.0, "Bea": -2208988800.0}
    assert {(r["file"], r["error"]) for r in bad.collect()} == {("c", "file not found"), ("d", "invalid figure name")}


def test_languages_without_a_label(spark):
    docs = spark.createDataFrame([("f", 1, "The cat and the dog in the house of the man."), ("f", 2, "Der Hund und die Katze und das Haus mit dem Tor."), ("f", 3, "xyz xyz xyz xyz xyz xyz xyz xyz xyz")], "figure string, doc_id long, text string")
    assert {r["doc_id"]: r["source_lang"] for r in ingest.passages(docs, 1e9).collect()} == {1: "en", 2: "de", 3: "unknown"}


def test_settings():
    assert EngineConfig(p1=0.6).p1 == 0.6
    for wrong in ({"p0": 0.55}, {"min_resistance": 1.2}, {"min_observations": 0}, {"pressure_seconds": -1.0}):
        with pytest.raises(ValueError):
            EngineConfig(**wrong)


def test_records_and_report(spark):
    o = obs(spark, ("courage", 1, 0, "I gave in", 0.5, "k", 0), ("patience", 1, 0, "I stood firm", 0.7, "k", 0)).withColumn("record_id", F.lit("r")).withColumns({"observation_consistency": F.lit(0.5), "figure_name": F.lit("X"), "document_type": F.lit("letter"), "source_obs_id": F.concat_ws("|", "record_id", "value_name"), "polarity_confidence": F.lit(None).cast("double")})
    ctx = spark.createDataFrame([("figure:x", "p", 0.0, 0)], "session_id string, record_id string, ts double, passage_idx int")
    r = labels.upgraded(labels.classified(o), ctx)
    t = {x["value_name"]: x for x in labels.training_records(r).collect()}
    assert len(labels.RECORD) == 28 and t["courage"]["pressure_context"] and t["courage"]["failure_markers"] == ["gave in"] and t["patience"]["polarity_confidence"] == 0.0
    j = json.loads(labels.report(r).first()["value"])
    assert j["by_figure"] == {"X": {"P1": 1, "P0": 0, "APY": 1}} and j["co_occurrence"]["courage||patience"]["mixed"] == 1 and j["total_classified"] == 2
    more = ctx.union(spark.createDataFrame([("figure:x", "q", 5.0, 9), ("figure:y", "z", 5.0, 9)], ctx.schema))
    assert [x["record_id"] for x in labels.pressure_context(more, "figure:x").collect()] == ["q", "p"]
    assert [x["record_id"] for x in labels.pressure_context(more, "figure:x", from_idx=9, from_ts=99.0).collect()] == ["q"]


def test_gold_from_paragraphs(spark):
    stems = spark.createDataFrame([("courag", "courage"), ("honest", "integrity")], "stem string, value_name string")
    long = "He wrote of courage: " + '"the weight of this promise is mine alone to carry"' + " and left it there for others."
    rows = [(1, "[SECTION: courage]"), (2, long), (3, "honest but short"), (4, long), (5, "An honest paragraph that is long enough to be taken whole, without any quotation in it at all.")]
    got = {(r["text_excerpt"][:20], r["value_name"], r["mode"]) for r in gold.from_paragraphs(spark.createDataFrame(rows, "para_id long, paragraph string"), stems).collect()}
    assert got == {("the weight of this p", "courage", "quote"), ("He wrote of courage:", "courage", "paragraph"), ("An honest paragraph ", "integrity", "paragraph")}


def test_stats_profiles_and_prototypes(spark):
    o = obs(spark, ("courage", 1, 0, "t", 0.5, "k", 0), ("courage", 2, 1, "t", 0.5, "k", 0), ("love", 3, 2, "t", 0.5, "k", 0))
    reg = registry.registry(o)
    s = corpus.stats(o, reg, spark.createDataFrame([("figure:x",)], "session_id string")).first()
    assert (s["total_observations"], s["figure_count"], json.loads(s["top_values"])[0]) == (3, 1, {"value_name": "courage", "demonstrations": 2})
    assert [r["value_name"] for r in registry.figure_profile(reg, "X").collect()] == ["courage", "love"] and registry.universal_profile(reg, 2).count() == 1
    seeds = spark.createDataFrame([("love", "hold", [1.0, 0.0]), ("love", "hold", [0.0, 1.0]), ("love", "failure", [0.0, -1.0])], "value_name string, kind string, embedding array<double>")
    held, failed = semantic.prototypes(seeds)
    assert held.first()["centroid"] == [pytest.approx(0.5**0.5)] * 2 and failed.first()["centroid"] == [0.0, -1.0]


def test_running_in_pieces(spark):
    """Histories cut into pieces give what one window gives."""
    o = obs(spark, *[("courage", i * 1e7 - 5e7, i, "t", round(0.2 + 0.07 * (i % 9), 4), "k", 0) for i in range(25)]).withColumn("doc_type", F.when(F.col("ts") > 1e8, "speech").otherwise("letter"))
    got = [tuple(r) for r in registry.running(o).orderBy("n").collect()]
    assert got == [tuple(r) for r in registry.running(o, 1e12).orderBy("n").collect()] and [r[4] for r in got] == list(range(1, 26))
    last, want = got[-1], registry.registry(o).first()
    assert last[6:] == (want["avg_resistance"], want["consistency"])


def test_observations_and_append(spark):
    rows = [("s", "r", "v", 1, "b" * 300, 2.0), ("s", "r", "v", 0, "a" * 300, -1.0)]
    got = signals.observations(spark.createDataFrame(rows, "session_id string, record_id string, value_name string, signal_ord int, text_excerpt string, polarity_confidence double"))
    r = got.first()
    assert (r["text_excerpt"], r["polarity_confidence"]) == ("a" * 200, 0.0)
    assert signals.append_new(got, got).count() == 0


def test_ingest(spark):
    docs = spark.createDataFrame([(1, "Gandhi", "This is a sentence that is long enough. Thou art here.", 1700, None), (2, "bad name", "text " * 10, None, None), (3, "Ok", " ", None, None), (4, "Ok", "short", None, None), (5, "Ok", "Long enough to be a passage of thirty.", None, "zz")], "doc_id long, figure string, text string, pub_year int, pronoun string")
    p = ingest.passages(docs, 1e9).collect()
    assert [r["doc_id"] for r in p] == [1] and "You are here" in p[0]["text"]
    assert p[0]["ts"] == -8520336000.0 and (p[0]["source_lang"], p[0]["source_authenticity"]) == ("en", 1.0) and p[0]["significance"] == 0.75
    assert {r["doc_id"]: r["error"] for r in ingest.checked(docs).collect()} == {1: None, 2: "invalid figure name", 3: "empty text", 4: "no passages", 5: "invalid pronoun"}
    assert [r["passage_idx"] for r in ingest.numbered(ingest.passages(docs, 1e9)).collect()] == [0]
    first = {r["id"] for r in ingest.passages(docs, 1e9).collect()}
    assert first == {r["id"] for r in ingest.passages(docs, 1e9).collect()}


def test_year_start(spark):
    df = spark.createDataFrame([(65,), (0,), (-5,), (None,)], "y int")
    assert [r[0] for r in df.select(ingest.year_start(F.col("y"))).collect()] == [-60115910400.0, None, None, None]


def test_sources_and_documents(spark):
    log = spark.createDataFrame([(1, "Ann", "a", "journal", 2, "unknown", 1.0), (2, "ann", "a", "letter", 3, "she", 2.0), (3, "ann", "", "letter", 1, "unknown", 3.0), (4, "ann", "", "letter", 1, "unknown", 4.0)], "log_id long, figure string, doc_title string, document_type string, passage_count long, pronoun string, ingested_at double")
    r = ingest.figure_sources(log).first()
    assert (r["session_id"], r["document_type"], r["passage_count"], r["pronoun"], r["ingested_at"]) == ("figure:ann", "mixed", 7, "she", 4.0)
    assert sorted(x["log_id"] for x in ingest.figure_documents(log).collect()) == [1, 3, 4]


OBS = "session_id string, record_id string, value_name string, ts double, passage_idx int, text_excerpt string, doc_type string, significance double, resistance double, disambiguation_confidence double, source string, value_polarity int"


def obs(spark, *rows):
    return spark.createDataFrame([("figure:x", str(i), v, float(ts), idx, t, "letter", 0.8, r, 1.0, s, p) for i, (v, ts, idx, t, r, s, p) in enumerate(rows)], OBS)


def test_registry(spark):
    o = obs(spark, *[("courage", i * 31_536_000, i, "t", 0.5, "k", 0) for i in range(10)])
    r = registry.registry(o).first()
    assert (r["demonstrations"], r["avg_resistance"], r["consistency"]) == (10, 0.5, pytest.approx(0.9))
    assert r["weight"] == pytest.approx(10 * 0.8 * 0.5 * 0.9)
    run = registry.running(o).orderBy("n").collect()
    assert run[0]["consistency"] == 0.08 and run[-1]["consistency"] == r["consistency"]
    assert registry.stepwise(o).first()["avg_resistance"] == 0.5
    assert registry.scan(o, since=31_536_000.0, limit=3).count() == 3
    assert registry.strongest(registry.registry(o), 11).count() == 0


@pytest.mark.parametrize(("lag_s", "lag_n", "hit"), [(72 * 3600, 99, True), (73 * 3600, 99, False), (73 * 3600, 5, True), (73 * 3600, 6, False), (0, 0, True), (-1, -1, False)])
def test_pressure_boundaries(spark, lag_s, lag_n, hit):
    base = 1e6
    rec = labels.classified(obs(spark, ("courage", base + lag_s, 100 + lag_n, "I gave in", 0.5, "k", 0)).withColumn("observation_consistency", F.lit(0.5)))
    ctx = spark.createDataFrame([("figure:x", "p", base, 100)], "session_id string, record_id string, ts double, passage_idx int")
    r = labels.upgraded(rec, ctx).first()
    assert (r["label"] == "APY") == hit
    assert r["pressure_source_id"] == ("p" if hit else None)
    if hit:
        assert (r["confidence"], r["deferred_apy_lag_s"], r["deferred_apy_lag_n"], r["fail_mode"]) == (0.85, lag_s, lag_n, "APY")


def test_latest_pressure_wins_and_window_keeps_five(spark):
    ctx = spark.createDataFrame([("figure:x", f"p{i}", float(i), i) for i in range(8)], "session_id string, record_id string, ts double, passage_idx int")
    assert sorted(r["record_id"] for r in labels.pressure_window(ctx).collect()) == [f"p{i}" for i in range(3, 8)]
    rec = labels.classified(obs(spark, ("courage", 5.5, 6, "I gave in", 0.5, "k", 0)).withColumn("observation_consistency", F.lit(0.5)))
    assert labels.upgraded(rec, ctx).first()["pressure_source_id"] == "p5"


def test_panel_override_and_filters(spark):
    o = obs(spark, ("courage", 0, 0, "plain", 0.4, "keyword+panel", -1), ("courage", 1, 1, "plain", 0.4, "panel", 1), ("love", 2, 2, "plain", 0.4, "panel", 0)).withColumn("observation_consistency", F.lit(0.5))
    rows = {r["record_id"]: r for r in labels.classified(o).collect()}
    assert (rows["0"]["label"], rows["0"]["fail_mode"], rows["1"]["label"], rows["2"]["label"]) == ("P0", "UA", "P1", "AMBIGUOUS")
    assert labels.classified(o, least=2).count() == 2 and labels.classified(o, consistency=0.6).count() == 0


def test_pairs(spark):
    rows = [("courage", "P1"), ("patience", "P0"), ("love", "APY")]
    df = spark.createDataFrame([("s", "r", v, l, 0.0, 0.5, 1.0, "t") for v, l in rows], "session_id string, record_id string, value_name string, label string, ts double, resistance double, training_weight double, text_excerpt string")
    co = {(r["value_a"], r["value_b"]): (r["both_p1"], r["mixed"], r["both_p0"]) for r in labels.cooccurrence(df).collect()}
    assert co == {("courage", "love"): (0, 1, 0), ("courage", "patience"): (0, 1, 0), ("love", "patience"): (0, 0, 1)}
    t = labels.tensions(df).collect()
    assert [(r["value_held"], r["value_failed"], r["training_weight"]) for r in t] == [("courage", "patience", 1.5)]


def test_panel_votes(spark):
    v = lambda i, *votes: [(i, "v", h, x) for h, x in votes]
    rows = v("a", (True, False), (True, False), (None, None)) + v("b", (False, True), (False, True), (False, False)) + v("c", (True, True), (True, True), (None, None)) + v("d", (True, False), (None, None), (None, None)) + v("e", (True, False), (False, True), (False, False))
    got = {r["id"]: r["verdict"] for r in labels.panel_votes(spark.createDataFrame(rows, "id string, value_name string, holds boolean, violates boolean")).collect()}
    assert got == {"a": "P1", "b": "P0", "c": "tension", "d": "skip", "e": "discard"}


def records(spark, good=True):
    values = ["courage", "love", "growth", "loyalty", "humility"] if good else ["love"]
    rows = [(f"f{i % 3}", values[i % len(values)], "P1" if i % 2 or not good else "P0", "high_resistance_held" if i % 2 or not good else "failure_markers_present", ("letter", "journal")[i % 2] if good else "unknown", "an excerpt that is long enough to count", 0.9 if good else 0.4, 0.9 if i % 2 else 0.3, 0.95 if good else 0.3, 0.6, float(i)) for i in range(30 if good else 8)]
    return spark.createDataFrame(rows, "figure string, value_name string, label string, label_reason string, document_type string, text_excerpt string, confidence double, resistance double, disambiguation_confidence double, observation_consistency double, ts double")


def test_quality(spark):
    assert quality.grade(records(spark)).first()["grade"] == "CERTIFIED"
    assert quality.grade(records(spark, False)).first()["grade"] == "FAILED"
    assert quality.grade(records(spark).limit(0)).first()["grade"] == "ERROR"
    assert quality.grade(records(spark), {"min_records": 31}).first()["failed"] == 1
    r = records(spark)
    assert quality.digest(r).first() == quality.digest(r.orderBy(F.desc("ts"))).first()
    assert quality.digest(r).first() != quality.digest(r.where("ts > 0")).first()


def test_corpus_tiers(spark):
    docs = spark.createDataFrame([("A", "1", "letter"), ("A", "2", "journal"), ("A", "3", "letter"), ("b", "1", "letter"), ("b", "2", "letter"), ("c", "1", "letter")], "figure_name string, doc_title string, doc_type string")
    got = {r["figure_name"]: (r["confidence_tier"], r["approved_for_export"]) for r in corpus.corpus_quality(docs, docs.select("figure_name").union(spark.createDataFrame([("d",)], "figure_name string"))).collect()}
    assert got == {"a": ("confident", True), "b": ("partial", False), "c": ("preliminary", False), "d": ("preliminary", False)}


def test_gold(spark):
    a = spark.createDataFrame([("t", "v", "P1"), ("t", "v", "P1"), ("t", "v", "P0"), ("u", "v", "P1"), ("u", "v", "P0"), ("", "v", "P0")], "text_excerpt string, value_name string, label string")
    got = {r["key"]: (r["label"], r["n_annotators"], r["vote_counts"]) for r in gold.merge_gold(a).collect()}
    assert got == {"t": ("P1", 3, '{"P0":1,"P1":2}'), "u": ("AMBIGUOUS", 2, '{"P0":1,"P1":1}')}
    m = spark.createDataFrame([("P1", "P1"), ("P1", "P0"), ("P0", "P1"), ("P0", "P0"), ("P0", None)], "label string, gold string")
    r = gold.scores(m).first()
    assert (r["n_matched"], r["p1_precision"], r["p1_recall"], r["p1_f1"], r["accuracy"], r["apy_f1"]) == (4, 0.5, 0.5, 0.5, 0.5, 0.0)


def test_sweep_agrees_with_labels(spark):
    o = obs(spark, *[("courage", i, i, t, r, "k", 0) for i, (t, r) in enumerate([("plain", 0.1), ("plain", 0.4), ("plain", 0.6), ("I persevered", 0.6), ("I gave in", 0.9), ("under pressure", 0.1)])]).withColumn("gold", F.when(F.col("passage_idx") % 2 == 0, "P1").otherwise("P0"))
    got = {(r["p1_threshold"], r["p0_threshold"]): r for r in gold.sweep(o).collect()}
    assert len(got) == 42
    for (p1, p0), r in list(got.items())[::7]:
        want = gold.scores(labels.classified(o.drop("gold").withColumn("observation_consistency", F.lit(0.5)), p1, p0).join(o.select("record_id", "gold"), "record_id")).first()
        assert all(r[c] == pytest.approx(want[c]) for c in ("n_matched", "p1_precision", "p1_recall", "p1_f1", "p0_f1", "apy_f1", "accuracy"))


def test_semantic(spark):
    v = spark.createDataFrame([(0, [1.0, 0.0], 0), (1, [0.6, 0.8], 1), (2, [0.0, 1.0], 1)], "vec_id long, embedding array<float>, label int")
    c = {r["label"]: r["centroid"] for r in semantic.centroids(v).collect()}
    assert c[0] == [1.0, 0.0] and sum(x * x for x in c[1]) == pytest.approx(1)
    near = semantic.nearest(v, semantic.centroids(v), k=1).orderBy("vec_id").collect()
    assert [(r["vec_id"], r["label"]) for r in near] == [(0, 0), (1, 1), (2, 1)]
    s = semantic.semantic_signals(near_hold=spark.createDataFrame([(1, "a", 0.8), (1, "b", 0.5)], "vec_id long, label string, score double"), near_failure=spark.createDataFrame([(1, "a", 0.4), (1, "b", 0.6)], "vec_id long, label string, score double")).collect()
    assert [(r["value_name"], r["confidence"]) for r in s] == [("a", 0.48)]


def test_settings_decide_the_labels(spark):
    o = obs(spark, ("courage", 0, 0, "plain", 0.5, "k", 0), ("courage", 10, 1, "plain", 0.5, "k", 0), ("love", 10, 1, "plain", 0.1, "k", 0))
    src = spark.createDataFrame([("figure:x", "X", "letter")], "session_id string, figure_name string, document_type string")
    p = spark.createDataFrame([("figure:x", "p", 9.0, 0)], "session_id string, record_id string, ts double, passage_idx int")
    got = lambda **c: sorted((r["value_name"], r["label"]) for r in labels.labelled(o, src, registry.registry(o), p, EngineConfig(**c)).collect())
    assert got() == [("courage", "AMBIGUOUS")] * 2 + [("love", "APY")]
    assert got(p1=0.45) == [("courage", "P1")] * 2 + [("love", "APY")]
    assert got(pressure_seconds=0.5, pressure_passages=0) == [("courage", "AMBIGUOUS")] * 2 + [("love", "P0")]
    assert got(min_observations=2) == [("courage", "AMBIGUOUS")] * 2
    assert got(min_consistency=1.0) == []
