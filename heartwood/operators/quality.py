"""Quality of a training set: metrics, graded checks, stability and a reproducible digest.

Records: figure, value_name, label, label_reason, document_type,
text_excerpt, confidence, resistance, disambiguation_confidence,
observation_consistency, ts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heartwood.functions import fixed, scoring
from heartwood.operators import ordered


def cleaned(records: DataFrame) -> DataFrame:
    d = scoring.safe_double
    return records.withColumns({
        "confidence": d(F.col("confidence"), 0.0), "resistance": d(F.col("resistance"), 0.0), "disambiguation_confidence": d(F.col("disambiguation_confidence"), 1.0),
        "observation_consistency": d(F.col("observation_consistency"), 0.5), "text_excerpt": F.coalesce("text_excerpt", F.lit("")), "label": F.coalesce("label", F.lit("UNKNOWN")),
        "figure": F.coalesce("figure", F.lit("unknown")), "label_reason": F.coalesce("label_reason", F.lit("")),
    })


def metrics(records: DataFrame, shortest: int = fixed.QUALITY["text_quality_min_chars"]) -> DataFrame:
    """One row of metrics: a single pass, joined with the small per-label and per-figure counts."""
    r = cleaned(records)
    real = F.when(F.lower("document_type") != "unknown", F.col("document_type"))
    share = lambda test: scoring.round4(F.count_if(test) / F.count(F.lit(1)))
    one = r.agg(
        F.count(F.lit(1)).alias("record_count"), F.count_distinct(F.when(F.col("value_name") != "", F.col("value_name"))).alias("value_coverage"), scoring.round4(F.avg("confidence")).alias("avg_confidence"),
        scoring.round4(F.avg("resistance")).alias("resistance_mean"), scoring.round4(F.stddev_pop("resistance")).alias("resistance_spread"), F.count_distinct(real).alias("source_diversity"),
        share(F.col("disambiguation_confidence") >= 0.8).alias("disambiguation_rate"), scoring.round4(F.percentile("observation_consistency", 0.05)).alias("consistency_pct5"), share(F.length("text_excerpt") >= shortest).alias("text_quality_rate"),
        (F.count_if(F.col("label") == "P1") > 0).alias("has_p1"), (F.count_if(F.col("label") == "P0") > 0).alias("has_p0"),
    )
    labels = r.groupBy("label").count().agg(F.max("count").alias("m"), F.min_by("label", F.struct(-F.col("count"), "label")).alias("max_label_name"), F.count_if(F.col("count") >= 2).alias("distinct_labels_with_mass"))
    figures = r.groupBy("figure").count().agg(F.min("count").alias("min_figure_records"), F.min_by("figure", F.struct("count", "figure")).alias("weakest_figure"))
    out = one.join(F.broadcast(labels), F.lit(True)).join(F.broadcast(figures), F.lit(True))
    return out.withColumn("max_label_pct", scoring.round4(F.try_divide("m", "record_count"))).drop("m").where("record_count > 0")


def breakdown(records: DataFrame, by: str) -> DataFrame:
    return cleaned(records).groupBy(by, "label").count().withColumnRenamed("count", "n")


def ranges(records: DataFrame) -> DataFrame:
    """(figure, value_name, n, hash): a hash of each figure's records of a value, in the order of excerpt and moment."""
    r = cleaned(records).withColumns({"value_name": F.coalesce("value_name", F.lit("")), "excerpt": F.substring("text_excerpt", 1, 80), "moment": scoring.safe_double(F.col("ts"), 0.0)})
    said = [F.format_string("%.4f", scoring.round4("resistance")).alias("r"), F.format_string("%.2f", F.round("confidence", 2)).alias("c")]
    content = F.concat_ws("\u0001", "figure", "value_name", "excerpt", "label", *said)
    return ordered.grouped_hashes(r, ["figure", "value_name"], content, "excerpt", "moment", "label", *said)


def digest(records: DataFrame) -> DataFrame:
    """One hash of the sorted records, the same however they are dealt and in whatever order they come."""
    return ordered.root(ranges(records), ["figure", "value_name"]).select(F.substring("hash", 1, 16).alias("reproducibility_hash"))


def differing(one: DataFrame, other: DataFrame) -> DataFrame:
    """(figure, value_name, n_one, n_other): the ranges in which two sets of records differ."""
    a, b = (ranges(r).select("figure", "value_name", F.struct("n", "hash").alias(side)) for r, side in ((one, "a"), (other, "b")))
    both = a.join(b, ["figure", "value_name"], "full").where(~F.col("a.hash").eqNullSafe(F.col("b.hash")))
    return both.select("figure", "value_name", F.coalesce("a.n", F.lit(0)).alias("n_one"), F.coalesce("b.n", F.lit(0)).alias("n_other"))


def _check(layer: str, metric: str, value: Column, op: str, threshold: float) -> Column:
    passed = value >= threshold if op == ">=" else value <= threshold
    return F.struct(F.lit(layer).alias("layer"), F.lit(metric).alias("metric"), scoring.round4(value.cast("double")).alias("value"), F.lit(op).alias("op"), F.lit(float(threshold)).alias("threshold"), passed.alias("passed"))


def without_one_figure(records: DataFrame) -> DataFrame:
    """(figure, remaining): distinct values left when a figure's records go. A value is lost if only that figure has it."""
    pairs = cleaned(records).where("value_name <> ''").select("figure", "value_name").distinct()
    owners = pairs.groupBy("value_name").agg(F.count(F.lit(1)).alias("n"), F.min("figure").alias("only"))
    lost = owners.where("n = 1").groupBy(F.col("only").alias("figure")).agg(F.count(F.lit(1)).alias("lost"))
    total = owners.agg(F.count(F.lit(1)).alias("total"))
    every = cleaned(records).select("figure").distinct()
    return every.join(lost, "figure", "left").join(F.broadcast(total), F.lit(True)).select("figure", (F.col("total") - F.coalesce("lost", F.lit(0))).alias("remaining"))


def halves(records: DataFrame) -> DataFrame:
    """Coverage and mean confidence of the two halves by the parity of each row's rank among all records."""
    r = cleaned(records).withColumns({"value_name": F.coalesce("value_name", F.lit("")), "moment": scoring.safe_double(F.col("ts"), 0.0)})
    keys = ("figure", "value_name", F.substring("text_excerpt", 1, 40).alias("excerpt"), "moment", "label", "confidence")
    half = ordered.ranked(r.select(*keys), "figure", "value_name", "excerpt", "moment", "label", "confidence")
    return half.groupBy((F.col("rank") % 2).cast("int").alias("half")).agg(F.count_distinct(F.when(F.col("value_name") != "", F.col("value_name"))).alias("value_coverage"), F.avg("confidence").alias("avg_confidence"))


def checks(records: DataFrame, thresholds: dict[str, float] | None = None) -> DataFrame:
    """All checks of the three layers as rows: layer, metric, value, op, threshold, passed."""
    t = {**fixed.QUALITY, **(thresholds or {})}
    m = metrics(records, int(t["text_quality_min_chars"]))
    first = [
        ("Record Count", F.col("record_count"), ">=", "min_records"), ("Value Coverage", F.col("value_coverage"), ">=", "value_coverage_min"), ("Label Balance", F.col("max_label_pct"), "<=", "label_max_pct"),
        ("Avg Confidence", F.col("avg_confidence"), ">=", "avg_confidence_min"), ("Resistance Spread", F.col("resistance_spread"), ">=", "resistance_spread_min"), ("Source Diversity", F.col("source_diversity"), ">=", "source_diversity_min"),
        ("Disambiguation Rate", F.col("disambiguation_rate"), ">=", "disambiguation_rate_min"), ("Consistency Floor", F.col("consistency_pct5"), ">=", "consistency_pct5_min"), ("Text Quality", F.col("text_quality_rate"), ">=", "text_quality_rate_min"),
        ("Per-Figure Minimum", F.col("min_figure_records"), ">=", "per_figure_min_records"),
    ]
    shape = [_check("L1", name, value, op, t[key]) for name, value, op, key in first]
    shape.insert(3, _check("L1", "P1+P0 Present", (F.col("has_p1") & F.col("has_p0")).cast("int"), ">=", 1))
    l1 = m.select(F.explode(F.array(*shape)).alias("c"))
    r = cleaned(records)
    low = (F.col("resistance") < fixed.P1) & ~F.col("label_reason").isin(*fixed.MARKER_REASONS)
    says = lambda word: F.lower("label_reason").contains(word)
    mismatch = (
        F.when(F.col("label_reason") == "", False).when((F.col("label") == "P1") & says("p0") & ~says("pressure"), True)
        .when((F.col("label") == "P0") & says("held") & ~says("panel"), True).when((F.col("label") == "APY") & says("held") & ~says("pressure"), True).otherwise(False)
    )
    inner = r.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") == "P1").alias("p1"), F.count_if((F.col("label") == "P1") & low).alias("weak"), F.count_if(mismatch).alias("wrong"),
        F.count_if((F.col("confidence") >= 0.80) & (F.col("disambiguation_confidence") < 0.50)).alias("conflict"),
    ).where("n > 0")
    coherent = F.when(F.col("p1") > 0, _check("L2", "P1 Resistance Coherence", scoring.round4(1 - F.try_divide("weak", "p1")), ">=", t["p1_coherence_min"]))
    l2 = inner.select(F.explode(F.array_compact(F.array(coherent, _check("L2", "Label-Reason Coherence", scoring.round4(1 - F.col("wrong") / F.col("n")), ">=", t["reason_coherence_min"]), _check("L2", "Signal Conflict Rate", scoring.round4(F.col("conflict") / F.col("n")), "<=", t["conflict_max"])))).alias("c"))
    fine = (F.col("value_coverage") >= t["value_coverage_min"]) & (F.col("avg_confidence") >= t["avg_confidence_min"])
    split = halves(records).agg((F.count_if(fine) >= 2).cast("int").alias("ok"))
    alone = without_one_figure(records).agg(((F.count(F.lit(1)) < 2) | (F.count_if(F.col("remaining") < t["value_coverage_min"]) == 0)).cast("int").alias("ok"))
    size = m.select("record_count")
    l3 = [df.join(F.broadcast(size), F.lit(True)).where("record_count >= 10").select(_check("L3", name, F.col("ok"), ">=", 1).alias("c")) for name, df in (("Split-Half Consistency", split), ("Figure Independence", alone))]
    return l1.unionByName(l2).unionByName(l3[0]).unionByName(l3[1]).select("c.*")


def grade(records: DataFrame, thresholds: dict[str, float] | None = None) -> DataFrame:
    """CERTIFIED if every check passes, FAILED if one does not, ERROR without records."""
    c = checks(records, thresholds).agg(F.count(F.lit(1)).alias("n"), F.count_if("passed").alias("passed"), F.count_if(~F.col("passed")).alias("failed"))
    return c.select(F.when(F.col("n") == 0, "ERROR").when(F.col("failed") == 0, "CERTIFIED").otherwise("FAILED").alias("grade"), "passed", "failed")
