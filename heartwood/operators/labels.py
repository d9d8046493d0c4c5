"""Training records: labels of observations, the upgrade of failures under recent pressure, pairs, tension and exports.

Observations as in ``registry``, with text_excerpt,
disambiguation_confidence, source, value_polarity and passage_idx.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heartwood.config import DEFAULT, EngineConfig
from heartwood.functions import fixed, scoring, text
from heartwood.functions.gates import marks, told, wider

LABELS = ("P1", "P0", "APY", "AMBIGUOUS")


def enriched(observations: DataFrame, sources: DataFrame, reg: DataFrame) -> DataFrame:
    """Observations with figure, document type and consistency; both sides are dimensions, joined on their keys."""
    out = observations.join(sources.select("session_id", "figure_name", "document_type"), "session_id", "left")
    out = out.join(reg.select("session_id", "value_name", F.col("consistency").alias("observation_consistency")), ["session_id", "value_name"], "left")
    return out.withColumns({
        "figure_name": F.coalesce("figure_name", F.expr("substring(session_id, 8)")), "document_type": F.coalesce("document_type", F.lit("unknown")),
        "observation_consistency": F.coalesce("observation_consistency", F.lit(0.5)), "disambiguation_confidence": F.coalesce("disambiguation_confidence", F.lit(1.0)),
    })


def classified(observations: DataFrame, p1: float = fixed.P1, p0: float = fixed.P0, least: int = 1, consistency: float = 0.0) -> DataFrame:
    """label, label_reason, confidence, fail_mode, markers and training_weight of each observation that passes the group filters."""
    if not 0 <= p0 < p1 <= 1:
        raise ValueError(f"the thresholds must be 0 <= {p0} < {p1} <= 1")
    df = observations
    if least > 1:  # counted by partial aggregates, so a frequent value of a session is no one task's work
        often = observations.groupBy("session_id", "value_name").agg(F.count(F.lit(1)).alias("obs_count")).where(F.col("obs_count") >= least)
        df = df.join(often, ["session_id", "value_name"]).drop("obs_count")
    if consistency > 0:
        df = df.where(F.col("observation_consistency") >= consistency)
    # one pass over an excerpt tells which markers it may hold; the column is not written into what asks for it
    df = df.withColumn("_m", marks(F.col("text_excerpt"), list(map(wider, scoring.MARKERS))))
    may, excerpt = told(F.col("_m"), list(scoring.MARKERS)), F.col("text_excerpt")
    df = df.withColumn("_l", scoring.label(excerpt, F.col("resistance"), p1, p0, may))
    panel = F.coalesce(F.col("source").contains("panel"), F.lit(False)) & (F.col("value_polarity") != 0) & (F.col("_l.label") != "APY")
    won = F.col("value_polarity") > 0
    df = df.withColumns({
        "label": F.when(panel, F.when(won, "P1").otherwise("P0")).otherwise(F.col("_l.label")),
        "label_reason": F.when(panel, F.when(won, "panel_confirmed_p1").otherwise("panel_confirmed_p0")).otherwise(F.col("_l.label_reason")),
        "confidence": F.col("_l.confidence"),
        "pressure_markers": text.markers(excerpt, fixed.PRESSURE_MARKERS, may(fixed.PRESSURE_MARKERS)), "failure_markers": text.markers(excerpt, fixed.FAILURE_MARKERS, may(fixed.FAILURE_MARKERS)),
        "hold_markers": text.markers(excerpt, fixed.HOLD_MARKERS, may(fixed.HOLD_MARKERS)), "training_weight": scoring.training_weight(F.col("significance"), F.col("doc_type")),
    }).drop("_l")
    return df.withColumn("fail_mode", scoring.fail_mode(F.col("label"), excerpt, may)).drop("_m")


def pressure_window(pressure: DataFrame, kept: int = fixed.PRESSURE_KEPT) -> DataFrame:
    """The last ``kept`` pressure rows (session_id, record_id, ts, passage_idx) of each session; Spark keeps that many before it shuffles."""
    w = Window.partitionBy("session_id").orderBy(F.desc("passage_idx"), F.desc("ts"), F.desc("record_id"))
    return pressure.withColumn("n", F.row_number().over(w)).where(F.col("n") <= kept).drop("n")


def with_pressure(records: DataFrame, pressure: DataFrame, seconds: float = fixed.PRESSURE_SECONDS, within: int = fixed.PRESSURE_PASSAGES, span: float = 86_400.0) -> DataFrame:
    """Each record with the latest pressure row of its session at or before it, if that lies near in time or passages.

    An as-of join without a range join: both sides are put in one order and
    the last pressure row is carried forward, which is linear whatever the
    number of pressure rows. Sessions are cut into pieces of ``span`` seconds,
    so a large session is many tasks' work; a piece starts from the last
    pressure row of the pieces before it, found from one row for each piece.
    """
    ctx = F.struct("ts", "passage_idx", F.col("record_id").alias("id"))
    right = pressure.select("session_id", "ts", "passage_idx", F.lit(0).alias("side"), ctx.alias("ctx"), F.lit(None).cast(records.select(F.struct("*")).schema[0].dataType).alias("rec"))
    left = records.select("session_id", "ts", "passage_idx", F.lit(1).alias("side"), F.lit(None).cast(right.schema["ctx"].dataType).alias("ctx"), F.struct("*").alias("rec"))
    both = right.unionByName(left).withColumn("piece", F.floor(F.col("ts") / span))
    earlier = Window.partitionBy("session_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = both.groupBy("session_id", "piece").agg(F.max("ctx").alias("own"))
    carried = pieces.select("session_id", "piece", F.last("own", ignorenulls=True).over(earlier).alias("before"))
    w = Window.partitionBy("session_id", "piece").orderBy("ts", "side", "passage_idx").rowsBetween(Window.unboundedPreceding, 0)
    seen = both.withColumn("last", F.last("ctx", ignorenulls=True).over(w)).where("side = 1").join(carried, ["session_id", "piece"])
    seen = seen.withColumn("last", F.coalesce("last", "before"))
    lag_s, lag_n = F.col("ts") - F.col("last.ts"), F.col("passage_idx") - F.col("last.passage_idx")
    near = F.coalesce((lag_s <= seconds) | ((F.col("passage_idx") >= 0) & (F.col("last.passage_idx") >= 0) & (lag_n <= within)), F.lit(False))
    return seen.select("rec.*", F.when(near, F.col("last.id")).alias("pressure_source_id"), F.when(near, F.round(lag_s, 1)).alias("deferred_apy_lag_s"), F.when(near, F.greatest(F.lit(0), lag_n)).alias("deferred_apy_lag_n"))


def upgraded(records: DataFrame, pressure: DataFrame, cfg: EngineConfig = DEFAULT) -> DataFrame:
    """Failures (P0) under recent pressure become APY; all other records pass unchanged."""
    other = records.where("label <> 'P0'").withColumns({"pressure_source_id": F.lit(None).cast(pressure.schema["record_id"].dataType), "deferred_apy_lag_s": F.lit(None).cast("double"), "deferred_apy_lag_n": F.lit(None).cast("int")})
    failed = with_pressure(records.where("label = 'P0'"), pressure, cfg.pressure_seconds, cfg.pressure_passages)
    hit = F.col("pressure_source_id").isNotNull()
    failed = failed.withColumns({
        "label": F.when(hit, "APY").otherwise("P0"), "label_reason": F.when(hit, "cross_passage_apy_pressure_context").otherwise(F.col("label_reason")),
        "confidence": F.when(hit, 0.85).otherwise(F.col("confidence")), "fail_mode": F.when(hit, "APY").otherwise(F.col("fail_mode")),
    }).withColumn("deferred_apy_lag_n", F.col("deferred_apy_lag_n").cast("int"))
    return other.unionByName(failed)


def labelled(observations: DataFrame, sources: DataFrame, reg: DataFrame, pressure: DataFrame, cfg: EngineConfig = DEFAULT) -> DataFrame:
    """Observations to labelled records by the engine's settings: enriched, filtered by group, classified, and upgraded by pressure."""
    return upgraded(classified(enriched(observations, sources, reg), cfg.p1, cfg.p0, cfg.min_observations, cfg.min_consistency), pressure, cfg)


def contrastive(records: DataFrame, passages: DataFrame) -> DataFrame:
    """Upgraded failures paired with the passage in which the pressure occurred; those without one go."""
    source = passages.select(F.col("id").alias("pressure_source_id"), F.substring("text", 1, 500).alias("pressure_text"))
    return records.where("label = 'APY' and pressure_source_id is not null").join(source, "pressure_source_id").select("session_id", "record_id", "value_name", "pressure_source_id", "pressure_text", "text_excerpt")


def _pairs(records: DataFrame) -> DataFrame:
    """Unordered pairs of values in one passage: gathered once, paired inside the row (15 values at most, so 105 pairs)."""
    item = F.struct("value_name", "label", "ts", "resistance", "training_weight", "text_excerpt")
    together = records.groupBy("session_id", "record_id").agg(F.array_sort(F.collect_list(item)).alias("v")).where(F.size("v") > 1)
    first = together.select("session_id", "record_id", "v", F.posexplode("v").alias("i", "a"))
    return first.select("session_id", "record_id", "a", F.explode(F.expr("slice(v, i + 2, size(v))")).alias("b"))


def cooccurrence(records: DataFrame) -> DataFrame:
    """Value pairs in one passage: how often, and with which labels."""
    a, b = F.col("a.label") == "P1", F.col("b.label") == "P1"
    return _pairs(records).groupBy(F.col("a.value_name").alias("value_a"), F.col("b.value_name").alias("value_b")).agg(
        F.count(F.lit(1)).alias("both_detected"), F.count_if(a & b).alias("both_p1"), F.count_if(a != b).alias("mixed"), F.count_if(~a & ~b).alias("both_p0"),
    )


def tensions(records: DataFrame) -> DataFrame:
    """Passages where one value of a tension pair is held and the other is not."""
    pairs = [tuple(sorted(p)) for p in fixed.TENSION_PAIRS]
    opposed = F.concat_ws("|", "a.value_name", "b.value_name").isin(*("|".join(p) for p in pairs)) & ((F.col("a.label") == "P1") != (F.col("b.label") == "P1"))
    held = F.when(F.col("a.label") == "P1", F.col("a")).otherwise(F.col("b"))
    failed = F.when(F.col("a.label") == "P1", F.col("b")).otherwise(F.col("a"))
    out = _pairs(records).where(opposed).select("session_id", "record_id", held.alias("h"), failed.alias("f"))
    return out.select(
        "session_id", "record_id", F.col("h.ts").alias("ts"), F.col("h.value_name").alias("value_held"), F.col("f.value_name").alias("value_failed"), scoring.round4("h.resistance").alias("resistance"),
        F.substring("h.text_excerpt", 1, 300).alias("text_excerpt"), F.col("h.label").alias("held_label"), F.col("f.label").alias("failed_label"), scoring.round4(F.col("h.training_weight") * 1.5).alias("training_weight"),
    ).dropDuplicates(["session_id", "record_id", "value_held", "value_failed"])


def label_pivot(records: DataFrame, by: str) -> DataFrame:
    """Labels counted for each figure or value, with the sum of weights."""
    counts = [F.count_if(F.col("label") == name).alias(name.lower()) for name in LABELS]
    return records.groupBy(by).agg(*counts, F.count(F.lit(1)).alias("total"), scoring.round4(F.sum("training_weight")).alias("total_weight"))


def label_cube(records: DataFrame) -> DataFrame:
    return records.cube("session_id", "value_name", "label").agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("level"))


def panel_votes(votes: DataFrame) -> DataFrame:
    """Three models' votes (id, value_name, holds, violates; null abstains) to a verdict: two agreeing ones decide."""
    g = votes.groupBy("id", "value_name").agg(F.count_if(F.col("holds").isNotNull() | F.col("violates").isNotNull()).alias("active"), F.count_if("holds").alias("h"), F.count_if("violates").alias("v"))
    verdict = F.when(F.col("active") < 2, "skip").when((F.col("h") >= 2) & (F.col("v") >= 2), "tension").when(F.col("h") >= 2, "P1").when(F.col("v") >= 2, "P0").otherwise("discard")
    return g.select("id", "value_name", F.col("h").alias("holds"), F.col("v").alias("violates"), "active", verdict.alias("verdict"))


def exportable(records: DataFrame, quality: DataFrame) -> DataFrame:
    """Records whose figure has no documents registered, or more than a preliminary corpus; with its tier."""
    q = quality.select(F.lower("figure_name").alias("_f"), F.col("confidence_tier").alias("corpus_confidence"), "document_count")
    out = records.join(q, F.lower(F.col("figure_name")) == F.col("_f"), "left").drop("_f")
    blocked = (F.col("corpus_confidence") == "preliminary") & (F.col("document_count") > 0)
    return out.where(~F.coalesce(blocked, F.lit(False))).drop("document_count")


#: Columns of a training record, in order.
RECORD = (
    "id", "source_obs_id", "figure", "session_id", "record_id", "ts", "value_name", "text_excerpt", "document_type", "significance", "resistance", "label", "label_reason", "fail_mode", "training_weight", "confidence",
    "pressure_markers", "failure_markers", "hold_markers", "source", "disambiguation_confidence", "observation_consistency", "value_polarity", "polarity_confidence", "pressure_source_id", "pressure_context", "deferred_apy_lag_s", "deferred_apy_lag_n",
)


def training_records(records: DataFrame) -> DataFrame:
    """Classified and upgraded observations as training records of 28 fields; ids are hashes of the observation."""
    r4 = scoring.round4
    df = records.withColumns({
        "id": F.sha2(F.concat(F.lit("record|"), "source_obs_id"), 256), "figure": F.col("figure_name"), "confidence": F.round("confidence", 2), "source": F.coalesce("source", F.lit("")),
        "significance": r4("significance"), "resistance": r4("resistance"), "disambiguation_confidence": r4("disambiguation_confidence"), "observation_consistency": r4("observation_consistency"),
        "value_polarity": F.coalesce("value_polarity", F.lit(0)), "polarity_confidence": r4(F.coalesce("polarity_confidence", F.lit(0.0))), "pressure_context": F.col("pressure_source_id").isNotNull(),
    })
    return df.select(*RECORD)


def report(records: DataFrame, by: str = "figure_name", p1: float = fixed.P1, p0: float = fixed.P0) -> DataFrame:
    """(value): the export report as one JSON text: totals, label counts by figure and value, weights, and pairs of values seen together."""
    counts = [F.count_if(F.col("label") == name).alias(name) for name in LABELS]
    weight = lambda *names: F.coalesce(F.round(F.sum(F.when(F.col("label").isin(*names), F.col("training_weight"))), 3), F.lit(0.0))
    total = records.agg(F.count(F.lit(1)).alias("total_classified"), F.struct(*counts).alias("by_label"), weight("P1").alias("total_weight_positive"), weight("P0", "APY").alias("total_weight_negative"))

    def pivot(column: str, name: str) -> DataFrame:
        g = records.groupBy(column).agg(F.struct(*counts[:3]).alias("c"))
        return g.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(column).alias("k"), "c")))).alias(name))  # a row for each figure or value

    pairs = cooccurrence(records).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.concat_ws("||", "value_a", "value_b").alias("k"), F.struct("both_detected", "both_p1", "mixed", "both_p0").alias("c"))))).alias("co_occurrence"))
    one = total
    for part in (pivot(by, "by_figure"), pivot("value_name", "by_value"), pairs):
        one = one.join(F.broadcast(part), F.lit(True))
    return one.select(F.to_json(F.struct(F.lit(p1).alias("p1_threshold"), F.lit(p0).alias("p0_threshold"), *one.columns)).alias("value"))


def pressure_context(pressure: DataFrame, session_id: str, from_idx: int | None = None, from_ts: float | None = None) -> DataFrame:
    """A session's pressure rows, the latest first; with bounds, those at or past either."""
    rows = pressure.where(F.col("session_id") == session_id)
    bounds = [F.col(c) >= x for c, x in (("passage_idx", from_idx), ("ts", from_ts)) if x is not None]
    if bounds:
        rows = rows.where(bounds[0] if len(bounds) == 1 else bounds[0] | bounds[1])
    return rows.orderBy(F.desc("passage_idx"), F.desc("ts"), "record_id")
