"""Vectors and languages of texts, against plain Python."""

import math
from collections import Counter
from hashlib import md5

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from heartwood.config import EngineConfig
from heartwood.operators import embedding, ingest, profiles, semantic

DATA = "/root/testdata/sf0.01"
TEXTS = ["The honest man kept his promise.", "the the THE", "Élan vital, naïve café 12 x²", "", None, " \t\n", "I lied, and I would lie again to them.", "word " * 3000]


def plain(text, dim=embedding.DIM):
    """Sums of signs by component, from the definition."""
    out = Counter()
    word = ""
    for c in (text or "").lower() + " ":
        if c.isalnum():
            word += c
            continue
        if word:
            marked = f"_{word}_"
            for f in [f"w:{word}"] + [f"g:{marked[i:i + 3]}" for i in range(len(word))]:
                h = md5(f.encode()).hexdigest()
                out[int(h[:8], 16) % dim] += 1 if int(h[8:10], 16) % 2 else -1
        word = ""
    return out


def test_vectors(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id long, text string")
    got = {r["d"]: r["weight"] for r in embedding.weights(df.repartition(3)).collect()}
    vectors = [plain(t) for t in TEXTS]
    for d in range(embedding.DIM):
        assert got[d] == pytest.approx(math.log((1 + len(TEXTS)) / (1 + sum(d in v for v in vectors))) + 1)
    weight = embedding.vector(embedding.weights(df))
    for r in df.select("id", embedding.encode(F.col("text"), weight).alias("v")).collect():
        raw = np.zeros(embedding.DIM)
        for d, n in vectors[r["id"]].items():
            raw[d] = n * weight[d]
        norm = np.linalg.norm(raw)
        assert r["v"] == pytest.approx(list(raw / norm if norm else raw))


def signals_of(spark, texts):
    seeds = spark.createDataFrame([
        ("honesty", "hold", "I told the honest truth."), ("honesty", "hold", "The truth, honest and plain."), ("honesty", "failure", "I lied to them."), ("courage", "hold", "I stood firm against the danger."),
    ], "value_name string, kind string, sentence string")
    p = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    weighted = embedding.weights(p)
    stored = semantic.seed_prototypes(seeds, weighted)
    return {(r["id"], r["value_name"]): r["confidence"] for r in semantic.text_signals(p, stored, weighted, cfg=EngineConfig(semantic_threshold=0.3)).collect()}, stored, embedding.vector(weighted)


def test_signals_follow_the_text(spark):
    texts = ["He told the honest truth.", "He lied to them, and lied.", "They stood firm in danger.", "The weather was mild.", None, ""]
    got, stored, weight = signals_of(spark, texts)
    assert (0, "honesty") in got and (1, "honesty") not in got and (2, "courage") in got and not {k for k in got if k[0] > 2}
    c = {(r["label"], r["kind"]): np.array(r["centroid"]) for r in stored.collect()}
    for (i, value), confidence in got.items():
        raw = np.zeros(embedding.DIM)
        for d, n in plain(texts[i]).items():
            raw[d] = n * weight[d]
        x = raw / np.linalg.norm(raw)
        hold, fail = x @ c[value, "hold"], x @ c[value, "failure"] if (value, "failure") in c else 0.0
        assert confidence == pytest.approx((hold - 0.5 * fail) * 0.8, abs=2e-4)
    changed, *_ = signals_of(spark, ["He told of the weather.", *texts[1:]])
    assert (0, "honesty") not in changed


def learned(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    return docs, profiles.learn(docs.where("doc_id % 4 <> 2"))


def test_profiles_and_scores(spark):
    rows = [("en", "the cat the hat"), ("en", "then"), ("de", "die katze"), (None, "x"), ("fr", None)]
    model = profiles.tables(profiles.learn(spark.createDataFrame(rows, "lang string, text string").repartition(3), top=3))
    counts = {"en": Counter(), "de": Counter()}
    for lang, t in rows[:3]:
        for w in t.split():
            counts[lang].update(f" {w} "[i:i + 3] for i in range(len(w)))
    assert set(model) == {"en", "de"}
    for lang, n in counts.items():
        below = sum(n.values()) + 0.5 * len(n)
        best = dict(sorted(n.items(), key=lambda x: (-x[1], x[0]))[:3])
        assert model[lang] == pytest.approx({g: math.log((k + 0.5) / below) for g, k in best.items()} | {"": math.log(0.5 / below)})


def test_held_out_languages(spark):
    docs, model = learned(spark)
    model = profiles.tables(model)
    rows = docs.where("doc_id % 4 = 2 and lang is not null").select("lang", "text", profiles.detected(F.col("text"), model).alias("l")).collect()
    spoken = [r for r in rows if r["l"]["lang"] != "unknown"]
    assert len(spoken) >= 0.95 * len(rows)
    assert sum(r["l"]["lang"] == r["lang"] for r in spoken) >= 0.95 * len(spoken)
    assert sum(r["l"]["lang"] == r["lang"] for r in rows) >= 0.95 * len(rows)


def test_unknown_below_the_margin(spark):
    _, model = learned(spark)
    df = spark.createDataFrame([(t,) for t in (None, "", "12 345", "ab", "zzqx xqzz qzxz")], "text string")
    table = profiles.tables(model)
    assert {r["l"]["lang"] for r in df.limit(4).select(profiles.detected(F.col("text"), table).alias("l")).collect()} == {"unknown"}
    assert {r["l"]["lang"] for r in df.select(profiles.detected(F.col("text"), table, margin=98.0).alias("l")).collect()} == {"unknown"}
    alone = {"en": table["en"]}  # one language: whatever speaks enough is it
    assert df.where("text like 'zz%'").select(profiles.detected(F.col("text"), alone).alias("l")).first()["l"]["lang"] == "en"


def test_documents_without_a_language_get_one(spark):
    docs, model = learned(spark)
    some = docs.where("doc_id % 4 = 2 and lang is not null and length(text) > 200").limit(40).select("doc_id", F.lit("ann").alias("figure"), "text", F.col("lang").alias("own"))
    got = {r["doc_id"]: r["source_lang"] for r in ingest.passages(some, 1e9, languages=model).collect()}
    own = {r["doc_id"]: r["own"] for r in some.collect()}
    assert sum(got[d] == own[d] for d in got) >= 0.95 * len(got)


def test_windows_are_hashed_once(monkeypatch):
    """A worker takes one digest for each distinct word and window, however many words share it; sums in parts are the whole's."""
    taken = []
    digest = embedding._digest
    monkeypatch.setattr(embedding, "_digest", lambda f, dim: taken.append(f) or digest(f, dim))
    monkeypatch.setattr(embedding, "_hashed", {})
    monkeypatch.setattr(embedding, "_windows", {})
    texts = [f"{w}ing {w}ings {w}" for w in ("stand", "land", "hand", "band")] * 50
    for at_once in (1, 7, 10_000):
        monkeypatch.setattr(embedding, "AT_ONCE", at_once)
        got = embedding.sums(texts)
        assert [dict(zip(np.flatnonzero(row).tolist(), row[row != 0].tolist(), strict=True)) for row in got[:4]] == [{d: float(n) for d, n in plain(t).items() if n} for t in texts[:4]]
        assert (embedding.present(texts) == (np.array([[d in plain(t) for d in range(embedding.DIM)] for t in texts[:4]]) * 50).sum(0)).all()
    assert len(taken) == len(set(taken))


def test_words_are_hashed_as_arrays(monkeypatch):
    """Short words take no call each, whatever their script, and have the digests that a call gives; long ones take one each."""
    words = ["a", "stand", "ß", "İ".lower(), "中文", "𝒳é", "0123", "x" * 53, "é" * 26 + "x", *(f"w{i}" for i in range(5000))]
    long = ["x" * 54, "é" * 27, "y" * 300]
    taken, digest = [], embedding._digest
    monkeypatch.setattr(embedding, "_digest", lambda f, dim: taken.append(f) or digest(f, dim))
    monkeypatch.setattr(embedding, "_hashed", {})
    both = pa.array([*words, *long, *words])
    assert embedding._digests(both, 512).tolist() == [digest(f"w:{w}", 512) for w in both.to_pylist()]
    assert embedding._digests(both.slice(3, 20), 31).tolist() == [digest(f"w:{w}", 31) for w in both.to_pylist()[3:23]]
    assert taken == [f"w:{w}" for w in long]
    assert embedding._digests(pa.array([], pa.string()), 512).tolist() == []
