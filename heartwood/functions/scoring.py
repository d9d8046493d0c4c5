"""Scores and labels as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from heartwood.functions import fixed, text
from heartwood.functions.arrays import let
from heartwood.functions.gates import may_hold


def round4(x: Column | str) -> Column:
    """Four places; a decimal tie goes up, whatever the last bit of its double (so sums in any order agree)."""
    x = F.col(x) if isinstance(x, str) else x
    return F.floor(x * 10_000 + 0.500_000_1) / 10_000


def by_type(doc_type: Column, table: dict[str, float], other: float) -> Column:
    kind = F.lower(F.trim(F.coalesce(doc_type, F.lit("unknown"))))
    out = F.lit(other)
    for name, value in table.items():
        out = F.when(kind == name, value).otherwise(out)
    return out


def nudge(doc_type: Column) -> Column:
    return by_type(doc_type, fixed.RESISTANCE_NUDGE, fixed.RESISTANCE_NUDGE["unknown"])


def default_significance(doc_type: Column) -> Column:
    return by_type(doc_type, fixed.DEFAULT_SIGNIFICANCE, fixed.DEFAULT_SIGNIFICANCE["unknown"])


def clip(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def _asked(passage: Column, may: Callable[..., Column] | None) -> tuple[Callable[..., Column], Callable[[str], Column]]:
    """Whether some patterns may be in a text, and whether one is; ``may`` answers the first from stored marks (``gates.told``)."""
    if may is None:
        return (lambda *p: may_hold(passage, *p)), (lambda p: text.found(passage, p))
    return may, (lambda p: may(p) & text.found(passage, p))


def resistance(passage: Column, significance: Column, doc_type: Column, may: Callable[..., Column] | None = None) -> Column:
    """The cost of holding a value: a base, significance, document type, and the highest tier of adversity that applies."""
    may, found = _asked(passage, may)
    hold, fail = found(fixed.RESISTANCE_HOLD), found(fixed.RESISTANCE_FAILURE)
    extra = F.when(hold, fixed.HOLD_EXTRA).otherwise(0.0)
    tier = (
        F.when(~may(fixed.MORTAL, fixed.HIGH_ADVERSITY, fixed.ADVERSITY), 0.0)
        .when(found(fixed.MORTAL), fixed.MORTAL_BONUS + extra)
        .when(found(fixed.HIGH_ADVERSITY), F.when(fail, 0.0).otherwise(fixed.HIGH_BONUS + extra))
        .when(found(fixed.ADVERSITY), F.when(fail & ~hold, 0.0).otherwise(fixed.ADVERSITY_BONUS + extra))
        .otherwise(0.0)
    )
    worth = F.when(F.isnan(significance), fixed.SIG_CAP).otherwise(F.least(significance * fixed.SIG_SCALE, F.lit(fixed.SIG_CAP)))
    return round4(clip(fixed.BASE + worth + nudge(doc_type) + tier))


def structural(passage: Column, may: Callable[..., Column] | None = None) -> Column:
    """Mean over four classes of the highest tier that matches."""
    (may, found), total = _asked(passage, may), F.lit(0.0)
    for low, mid, high in fixed.STRUCTURE.values():
        a, b, c = fixed.TIERS
        total = total + F.when(found(high), c).when(found(mid), b).when(found(low), a).otherwise(0.0)
    every = [p for tiers in fixed.STRUCTURE.values() for p in tiers]
    return F.when(~may(*every), 0.0).otherwise(round4(total / 4))


def modulated(res: Column, struct: Column) -> Column:
    return round4(res * round4(0.85 + 0.15 * struct))


def authenticity(lang: Column, translated: Column) -> Column:
    return (
        F.when(translated, fixed.TRANSLATED).when(~translated, fixed.AUTHENTIC)
        .when(lang == "en", fixed.AUTHENTIC).otherwise(fixed.UNCERTAIN)
    )


def year_discount(year: Column) -> Column:
    out = F.lit(1.0)
    for below, factor in reversed(fixed.YEAR_DISCOUNT):
        out = F.when(year < below, factor).otherwise(out)
    return F.when(year.isNull(), 1.0).otherwise(out)


def calibrated(confidence: Column, auth: Column, year: Column) -> Column:
    """Confidence scaled by authenticity and age; untouched where neither says anything."""
    scaled = round4(clip(confidence * auth * year_discount(year)))
    return F.when((auth < 1.0) | year.isNotNull(), scaled).otherwise(confidence)


def training_weight(significance: Column, doc_type: Column) -> Column:
    return round4(by_type(doc_type, fixed.TRAINING_WEIGHT, 1.0) * significance)


#: All that a passage is scored by: a text without a beginning of one of these scores as an empty one does.
POSITIVE, NEGATIVE = text.any_of(fixed.POSITIVE_TARGETS), text.any_of(fixed.NEGATIVE_TARGETS)
SPOKEN = (fixed.MORTAL, fixed.HIGH_ADVERSITY, fixed.ADVERSITY, *(p for tiers in fixed.STRUCTURE.values() for p in tiers), POSITIVE, NEGATIVE)
#: What labels are read from.
MARKERS = (fixed.PRESSURE_MARKERS, fixed.FAILURE_MARKERS, fixed.HOLD_MARKERS)


def label(excerpt: Column, res: Column, p1: float | Column = fixed.P1, p0: float | Column = fixed.P0, may: Callable[..., Column] | None = None) -> Column:
    """struct(label, label_reason, confidence) of an observation, from its excerpt's markers and its resistance."""
    may, found = _asked(excerpt, may)
    pressed, failed, held = map(found, MARKERS)

    def says(name: str, reason: str, confidence: float) -> Column:
        return F.struct(F.lit(name).alias("label"), F.lit(reason).alias("label_reason"), F.lit(confidence).alias("confidence"))

    quiet = ~may(*MARKERS)
    return (
        F.when(quiet & (res >= p1), says("P1", "high_resistance_held", 0.75))
        .when(quiet & (res < p0), says("P0", "low_resistance_no_hold", 0.55))
        .when(quiet, says("AMBIGUOUS", "insufficient_signal", 0.40))
        .when(pressed & failed, says("APY", "pressure_detected_value_failed", 0.95))
        .when(pressed, says("P1", "apy_resistance_held_under_pressure", 0.95))
        .when(failed, says("P0", "failure_markers_present", 0.85))
        .when((res >= p1) & held, says("P1", "high_resistance_hold_marker", 0.90))
        .when(res >= p1, says("P1", "high_resistance_held", 0.75))
        .when(res < p0, says("P0", "low_resistance_no_hold", 0.55))
        .otherwise(says("AMBIGUOUS", "insufficient_signal", 0.40))
    )


def fail_mode(name: Column, excerpt: Column, may: Callable[..., Column] | None = None) -> Column:
    return F.when(name == "APY", "APY").when(name == "P0", F.when(_asked(excerpt, may)[1](fixed.FAILURE_MARKERS), "SO").otherwise("UA")).otherwise("")


def tier1_polarity(passage: Column, at: Column | None = None, reach: int = 120, near: int = 30, may: Callable[..., Column] | None = None) -> Column:
    """struct(polarity, confidence) from target words near the match, turned by an opposing verb close to a target; ``may`` speaks of the whole passage."""
    around = F.lower(passage if at is None else F.when(at.isNull(), passage).otherwise(text.window(passage, at - reach, at + reach)))
    nowhere = F.expr("cast(array() as array<struct<s:int,e:int>>)")
    places = text.positions if may is None else lambda t, p: F.when(may(p), text.positions(t, p)).otherwise(nowhere)

    def told(v: Column) -> Column:
        pos, neg, inv = v["pos"], v["neg"], places(v["around"], fixed.INVERSION)
        turned = F.exists(inv, lambda i: F.exists(F.concat(pos, neg), lambda t: F.abs(i["s"] - t["s"]) <= near))
        return let(F.struct(F.size(pos).alias("n"), F.size(neg).alias("m"), turned.alias("turned")), said)

    def said(v: Column) -> Column:
        n, m = v["n"], v["m"]
        sign, alone = F.when(v["turned"], -1).otherwise(1), F.when(v["turned"], 0.68).otherwise(0.80)
        polarity = F.when(n > m, sign).when(m > n, -sign).otherwise(0)
        confidence = F.when(n == m, 0.0).when((n > 0) & (m > 0), 0.60).otherwise(alone)
        return F.struct(polarity.cast("int").alias("polarity"), confidence.alias("confidence"))

    none = F.struct(F.lit(0).alias("polarity"), F.lit(0.0).alias("confidence"))
    found = let(F.struct(around.alias("around"), places(around, POSITIVE).alias("pos"), places(around, NEGATIVE).alias("neg")), told)
    return F.when(~_asked(around, may)[0](POSITIVE, NEGATIVE), none).otherwise(found)


def polarity(first: Column, vice: Column, virtue: Column) -> Column:
    """struct(polarity, confidence): the first tier, confirmed or overridden by the lexicon's vice and virtue scores."""
    p, c = first["polarity"], first["confidence"]
    give = lambda a, b: F.struct(F.lit(a).cast("int").alias("polarity") if isinstance(a, int) else a.alias("polarity"), b.alias("confidence"))
    raised = lambda s: round4(F.least(F.lit(1.0), c + s * 0.15))
    return (
        F.when((vice <= 0) & (virtue <= 0), give(p, c))
        .when((p == 0) & (vice > virtue) & (vice >= 0.40), give(-1, F.least(vice * 0.75, F.lit(0.60))))
        .when((p == 0) & (virtue > vice) & (virtue >= 0.40), give(1, F.least(virtue * 0.75, F.lit(0.60))))
        .when(p == 0, give(0, F.lit(0.0)))
        .when((p == -1) & (vice > 0), give(-1, raised(vice)))
        .when((p == 1) & (virtue > 0), give(1, raised(virtue)))
        .when((p == 1) & (vice > c), give(-1, round4(vice * 0.65)))
        .when((p == -1) & (virtue > c), give(1, round4(virtue * 0.65)))
        .otherwise(give(p, c))
    )


def consistency(n: Column, sigma: Column, mean: Column, span: Column, types: Column) -> Column:
    """Volume, stability, spread over time and diversity of sources, weighted."""
    volume = F.least(F.lit(1.0), n / 10.0)
    stable = F.when((n < 2) | (mean == 0), 0.0).otherwise(F.greatest(F.lit(0.0), 1 - sigma / 0.40))
    spread = F.least(F.lit(1.0), span / 31_536_000.0)
    diverse = F.least(F.lit(1.0), types / 3.0)
    return round4(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 0.30 * volume + 0.30 * stable + 0.25 * spread + 0.15 * diverse)))


def cosine(a: Column, b: Column) -> Column:
    """Inner product of two unit vectors."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def safe_double(x: Column, other: float) -> Column:
    v = x.try_cast("double")
    return F.when(v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")), other).otherwise(v)
