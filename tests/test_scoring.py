"""Text and scoring functions, with expectations worked out from their definitions."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from heartwood.functions import fixed, scoring, text


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {t}" for k, t in zip(values, ("string" if isinstance(v, str) or v is None else "double" for v in values.values()), strict=True))).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("passage", "raw"),
    [
        ("A plain day.", 0.28), ("Despite the rain we went.", 0.52), ("Despite it all, nevertheless we went.", 0.57), ("They were exiled.", 0.64), ("Exiled, I stood firm.", 0.69),
        ("I would rather die.", 0.90), ("I would rather die; I stood firm.", 0.95), ("Exiled, I gave in.", 0.28), ("Exiled, I stood firm and gave in.", 0.28), ("Despite it I gave in.", 0.28),
        ("Despite it I gave in, then stood firm.", 0.57), ("I would rather die, but gave in.", 0.90),
    ],
)
def test_resistance_tiers(spark, passage, raw):
    got = one(spark, scoring.resistance(F.col("t"), F.col("s"), F.lit("journal")), t=passage, s=0.9)
    assert got == pytest.approx(raw)


def test_resistance_of_odd_significance(spark):
    got = one(spark, scoring.resistance(F.col("t"), F.col("s"), F.lit(None).cast("string")), t="plain", s=float("nan"))
    assert got == pytest.approx(0.12 + 0.12 + 0.02)
    assert one(spark, scoring.resistance(F.col("t"), F.lit(0.0), F.lit(" Action ")), t="plain", s=0.0) == pytest.approx(0.17)


@pytest.mark.parametrize(("passage", "score"), [("", 0.0), ("although", 0.075), ("risking everything", 0.25), ("I refused to betray them at gunpoint, risking my life; I did not betray", 1.0), ("I refused to yield under fire; they ordered me to go", 0.65)])
def test_structure(spark, passage, score):
    assert one(spark, scoring.structural(F.col("t")), t=passage) == pytest.approx(score)


@pytest.mark.parametrize(
    ("excerpt", "res", "label", "reason"),
    [
        ("under pressure I gave in", 0.9, "APY", "pressure_detected_value_failed"), ("under pressure I spoke", 0.1, "P1", "apy_resistance_held_under_pressure"), ("I gave in", 0.9, "P0", "failure_markers_present"),
        ("I persevered", 0.55, "P1", "high_resistance_hold_marker"), ("plain", 0.55, "P1", "high_resistance_held"), ("plain", 0.349, "P0", "low_resistance_no_hold"), ("plain", 0.35, "AMBIGUOUS", "insufficient_signal"),
    ],
)
def test_labels(spark, excerpt, res, label, reason):
    got = one(spark, scoring.label(F.col("t"), F.col("r")), t=excerpt, r=res)
    assert (got["label"], got["label_reason"]) == (label, reason)


@pytest.mark.parametrize(
    ("passage", "polarity", "confidence"),
    [
        ("he fought against tyranny", 1, 0.68), ("he loved liberty", 1, 0.80), ("he resisted justice", -1, 0.68), ("tyranny and fraud", -1, 0.80), ("tyranny beside justice and peace", 1, 0.60), ("tyranny beside justice", 0, 0.0), ("affair and untruth", 0, 0.0),
        ("He resisted the long and very winding road that led to peace", 1, 0.80), ("atrocities", -1, 0.80),
    ],
)
def test_polarity(spark, passage, polarity, confidence):
    got = one(spark, scoring.tier1_polarity(F.col("t")), t=passage)
    assert (got["polarity"], got["confidence"]) == (polarity, pytest.approx(confidence))


@pytest.mark.parametrize(("p", "c", "vice", "virtue", "want"), [(1, 0.8, 0.0, 0.0, (1, 0.8)), (0, 0.0, 0.6, 0.0, (-1, 0.45)), (0, 0.0, 0.0, 0.9, (1, 0.6)), (0, 0.0, 0.3, 0.0, (0, 0.0)), (-1, 0.8, 0.5, 0.0, (-1, 0.875)), (1, 0.5, 0.7, 0.0, (-1, 0.455)), (1, 0.8, 0.7, 0.0, (1, 0.8))])
def test_polarity_with_lexicon(spark, p, c, vice, virtue, want):
    first = F.struct(F.lit(p).alias("polarity"), F.lit(c).alias("confidence"))
    got = spark.range(1).select(scoring.polarity(first, F.lit(vice), F.lit(virtue)).alias("x")).first()["x"]
    assert (got["polarity"], got["confidence"]) == (want[0], pytest.approx(want[1]))


def test_passages(spark):
    body = "  One short. " + "A sentence of some words here! " * 30 + "\n" + "x" * 600 + ". Tiny."
    got = one(spark, text.passages(F.col("t")), t=body)
    sentences = [s for s in ["One short."] + ["A sentence of some words here!"] * 30 + ["x" * 600 + ".", "Tiny."]]
    want, cur = [], ""
    for s in sentences:
        if cur and len(cur) + 1 + len(s) > 450:
            want.append(cur)
            cur = s
        else:
            cur = f"{cur} {s}".strip()
    want.append(cur)
    assert got == [p for p in want if len(p) >= 30]
    assert one(spark, text.passages(F.col("t")), t=" \n ") == []


def test_positions_and_windows(spark):
    t = "éa 𝔘a aa"
    got = one(spark, text.positions(F.col("t"), "a"), t=t)
    assert [(m["s"], m["e"]) for m in got] == [(i, i + 1) for i, c in enumerate(t) if c == "a"]
    assert one(spark, text.window(F.col("t"), F.lit(-5), F.lit(2)), t=t) == "éa"


def test_archaic_forms_keep_case(spark):
    got = one(spark, text.modernised(F.col("t")), t="'Tis thou; THOU hast, Thy art. Smart YE wilt'st 'twas")
    assert got == "it is you; YOU have, Your are. Smart YOU will'st it was"


def test_calibration(spark):
    c = lambda auth, year: spark.range(1).select(scoring.calibrated(F.lit(0.7), F.lit(auth), F.lit(year).cast("int"))).first()[0]
    assert c(1.0, None) == 0.7 and c(0.85, None) == 0.595 and c(0.7, 1399) == 0.343 and c(1.0, 1850) == 0.7
    assert [fixed.TRAINING_WEIGHT[k] for k in ("action", "speech")] == [1.2, 0.9]
    w = spark.range(1).select(scoring.training_weight(F.lit(0.9), F.lit("mixed"))).first()[0]
    assert w == 0.9


def test_consistency(spark):
    f = lambda n, s, m, span, k: spark.range(1).select(scoring.consistency(*(F.lit(float(x)) for x in (n, s, m, span, k)))).first()[0]
    assert f(1, 0, 0.5, 0, 1) == 0.08
    assert f(10, 0, 0.5, 31_536_000, 3) == 1.0
    assert f(2, 0.4, 0.5, 0, 1) == 0.11
    assert f(5, 0.2, 0.0, 0, 2) == 0.25


def test_safe_double(spark):
    df = spark.createDataFrame([("0.5",), ("x",), (None,), ("NaN",), ("Infinity",)], "v string")
    assert [r[0] for r in df.select(scoring.safe_double(F.col("v"), 9.0)).collect()] == [0.5, 9.0, 9.0, 9.0, 9.0]


def plain_passages(body, size=450, shortest=30):
    out, cur = [], ""
    for s in filter(None, (x.strip() for x in re.split(r"(?<=[.!?])\s+", body.strip()))):
        if cur and len(cur) + 1 + len(s) > size:
            out.append(cur)
            cur = s
        else:
            cur = f"{cur} {s}" if cur else s
    return [p for p in [*out, cur] if len(p) >= shortest]


def test_long_texts_are_cut_in_time(spark):
    """Passages and positions of texts of any length, as plain Python has them; 40,000 sentences within seconds."""
    rng = random.Random(8)
    sentence = lambda: " ".join("w" * rng.randint(1, 9) for _ in range(rng.randint(1, 40))) + rng.choice(".!?")
    texts = ["", " ", "one", *(" ".join(sentence() for _ in range(n)) for n in (1, 2, 7, 50, 400)), "A bit of text. " * 40_000]
    began = time.perf_counter()
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", text.passages(F.col("t")).alias("p"), F.size(text.positions(F.col("t"), "bit")).alias("n"), F.get(text.positions(F.col("t"), "w+"), 3)["s"].alias("s")).collect()
    assert time.perf_counter() - began < 60
    for r in rows:
        assert r["p"] == plain_passages(texts[r["i"]])
        assert r["n"] == texts[r["i"]].count("bit")
        starts = [m.start() for m in re.finditer("w+", texts[r["i"]])]
        assert r["s"] == (starts[3] if len(starts) > 3 else None)


def test_trie():
    words = ["fair", "fairness", "unfair", "a.b", "a", "won't give up"]
    p = re.compile(text.trie(words))
    assert [p.match(w).group() for w in words] == words and not p.match("xyz") and not re.search(text.trie([]), "anything")
    assert p.findall("fairness unfair a.b") == ["fairness", "unfair", "a.b"]
