"""Extraction: passages to observations, through all layers, their merge, calibration, the resistance gate and polarity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heartwood.config import DEFAULT, EngineConfig
from heartwood.functions import fixed, scoring, text
from heartwood.functions.gates import marks, may_hold, spoken, told, wider
from heartwood.operators import ingest, signals

HEAD, KEPT = 150, 200


#: What marks speak of, in the order of their bits: what a passage is scored by and pressure is read from, then what matters only beside these.
ASKED = [*scoring.SPOKEN, fixed.PRESSURE_MARKERS, fixed.RESISTANCE_HOLD, fixed.RESISTANCE_FAILURE, fixed.INVERSION]
LOUD = len(scoring.SPOKEN) + 1
WORDED, NAMED = len(ASKED), len(ASKED) + 1


def marked(passages: DataFrame, lexicon: DataFrame, strength: DataFrame, vocabulary: DataFrame | None = None) -> DataFrame:
    """Passages with ``marks`` of what they may hold: each pattern of ``ASKED``, a word of the lexicons, a keyword of the vocabulary (else, it is not known).

    One pass over a text for all of them, stored with the passage; the layers
    that read the same lexicons and vocabulary then leave other texts unread.
    ``loud`` is false only where the text holds no word of the lexicons and
    nothing that pressure or scores are read from.
    """
    named = "" if vocabulary is None else spoken(signals.keys(vocabulary), inside=True)
    df = passages.withColumn("marks", marks(F.col("text"), [*map(wider, ASKED), spoken(signals.words(lexicon, strength)), named]))
    return df.withColumn("loud", F.col("marks").bitwiseAND(F.lit((1 << LOUD) - 1 | 1 << WORDED)) != 0)


def _asking(passages: DataFrame, bit: int) -> DataFrame:
    """The passages that a layer has to read; all, if they bear no marks."""
    return passages.where(F.col("marks").bitwiseAND(F.lit(1 << bit)) != 0) if "marks" in passages.columns else passages


def facts(passages: DataFrame, cfg: EngineConfig = DEFAULT, keep: tuple[str, ...] = ()) -> DataFrame:
    """What a passage says by itself, from its row alone: resistance, structure, polarity of the whole text, and its beginning.

    Passages under the resistance gate stay out; the texts end here, so what
    follows joins and groups short rows. Most texts hold no beginning of any
    of the patterns, which one pass over the text tells for all of them.
    ``keep`` names further columns to stand beside the facts.
    """
    body, loud = F.col("text"), F.col("loud") if "loud" in passages.columns else may_hold(F.col("text"), *scoring.SPOKEN)
    may = told(F.col("marks"), ASKED) if "marks" in passages.columns else None
    scores = lambda t, m: F.struct(
        scoring.resistance(t, F.col("significance"), F.col("doc_type"), m).alias("raw"), scoring.structural(t, m).alias("struct_score"), scoring.tier1_polarity(t, may=m).alias("whole"))
    # a filter on a column would be tried below it, with the patterns once more, so the gate is in the row
    said = F.filter(F.array(F.when(F.coalesce(loud, F.lit(True)), scores(body, may)).otherwise(scores(F.lit(""), None))), lambda x: x["raw"] >= cfg.min_resistance)
    df = passages.select("id", "session_id", "ts", "doc_type", "significance", "source_authenticity", "pub_year", *keep, "text", F.explode(said).alias("f"))
    return df.select(*(c for c in df.columns if c not in ("text", "f")), "f.*", F.substring(body, 1, KEPT).alias("start"))


def scored(merged: DataFrame, cfg: EngineConfig = DEFAULT) -> DataFrame:
    """Merged signals beside their ``facts`` with calibrated confidence, modulated resistance, polarity and excerpt."""
    confidence = scoring.calibrated(F.col("confidence"), F.col("source_authenticity"), F.col("pub_year"))
    df = merged.withColumn("disambiguation_confidence", confidence).withColumn("resistance", scoring.modulated(F.col("raw"), F.col("struct_score")))
    found = scoring.polarity(F.coalesce("around", "whole"), F.col("vice"), F.col("virtue"))
    df = df.withColumn("p", F.when(F.col("polarity_hint").isNotNull(), F.struct(F.col("polarity_hint").alias("polarity"), F.col("disambiguation_confidence").alias("confidence"))).otherwise(found))
    return df.withColumns({
        "value_polarity": F.col("p.polarity"), "polarity_confidence": scoring.clip(F.col("p.confidence")),
        "text_excerpt": F.coalesce("own_excerpt", F.when(F.col("layer") == 5, F.col("start")).otherwise(text.excerpt(F.col("start"), HEAD))),  # cut as the whole text would be
    }).drop("p")


def merged_signals(passages: DataFrame, vocabulary: DataFrame, lexicon: DataFrame, strength: DataFrame, semantic: DataFrame | None = None, zeroshot: DataFrame | None = None, classifier: DataFrame | None = None, verdicts: DataFrame | None = None, cfg: EngineConfig = DEFAULT, keep: tuple[str, ...] = ()) -> DataFrame:
    """All signals of the passages that pass both gates, in merge order, scored.

    ``classifier`` has a classifier's scores (id, label, score), ``verdicts`` a panel's (id, value_name, verdict).
    """
    passages = passages.where((F.col("significance") >= cfg.min_significance) & (F.col("text") != ""))
    worded = _asking(passages, WORDED)
    merged = signals.merge(
        signals.keyword_signals(_asking(passages, NAMED), vocabulary, reach=cfg.polarity_reach), signals.lexicon_signals(worded, lexicon, strength), signals.phrase_signals(worded, lexicon), semantic, facts(passages, cfg, keep), zeroshot,
        None if classifier is None else signals.classifier_signals(classifier, cfg), cfg, verdicts,
    ).where("session_id is not null")
    return scored(merged if verdicts is None else signals.verified(merged), cfg)


def extract(passages: DataFrame, vocabulary: DataFrame, lexicon: DataFrame, strength: DataFrame, semantic: DataFrame | None = None, zeroshot: DataFrame | None = None, classifier: DataFrame | None = None, verdicts: DataFrame | None = None, cfg: EngineConfig = DEFAULT, keep: tuple[str, ...] = ()) -> DataFrame:
    """Observations: the first signal of each passage and value in merge order, numbered by its passage's place in its session.

    ``passages`` as from ``ingest.passages``, or ``marked`` by the same lexicons and vocabulary. A passage under a gate gives
    none; tables of scores that are left out are layers that are off. ``keep``
    names further columns of a passage that its observations shall have.
    """
    signals_ = merged_signals(passages, vocabulary, lexicon, strength, semantic, zeroshot, classifier, verdicts, cfg, keep).where("signal_ord = 0")
    first = signals_.select(
        "session_id", F.col("id").alias("record_id"), "value_name", "ts", F.substring("text_excerpt", 1, KEPT).alias("text_excerpt"), "doc_type", "significance", "resistance", "disambiguation_confidence", "source", "value_polarity", "polarity_confidence",
        F.concat_ws("|", "id", "value_name").alias("source_obs_id"), *keep,
    )
    return first.join(ingest.places(passages, cfg.min_significance).withColumnRenamed("id", "record_id"), "record_id")


def pressure(passages: DataFrame, cfg: EngineConfig = DEFAULT) -> DataFrame:
    """(session_id, record_id, ts, passage_idx, markers) of the passages with pressure markers, whatever their resistance."""
    rows = _asking(passages, ASKED.index(fixed.PRESSURE_MARKERS))
    rows = rows.where((F.col("significance") >= cfg.min_significance) & may_hold(F.col("text"), fixed.PRESSURE_MARKERS) & text.found(F.col("text"), fixed.PRESSURE_MARKERS))
    rows = rows.select("session_id", F.col("id").alias("record_id"), "ts", F.array_join(text.markers(F.col("text"), fixed.PRESSURE_MARKERS), ", ").alias("markers"))
    return rows.join(ingest.places(passages, cfg.min_significance).withColumnRenamed("id", "record_id"), "record_id").select("session_id", "record_id", "ts", "passage_idx", "markers")
