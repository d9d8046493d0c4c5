"""Gold labels: merging annotators, matching, thresholds and audits of the scoring formula."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heartwood.functions import fixed, scoring
from heartwood.operators import signals
from heartwood.sources import readers


def merge_gold(annotations: DataFrame) -> DataFrame:
    """Majority label of each (text_excerpt start, value_name); a tie is AMBIGUOUS. Vote counts as JSON."""
    votes = annotations.where("text_excerpt <> '' and value_name <> '' and label <> ''").groupBy(F.substring("text_excerpt", 1, 80).alias("key"), "value_name", "label").agg(F.count(F.lit(1)).alias("n"))
    g = votes.groupBy("key", "value_name").agg(F.array_sort(F.collect_list(F.struct("label", "n"))).alias("v"), F.max("n").alias("top"), F.sum("n").alias("n_annotators"))
    winners = F.filter("v", lambda x: x["n"] == F.col("top"))
    return g.select(
        "key", "value_name", F.when(F.size(winners) == 1, winners[0]["label"]).otherwise("AMBIGUOUS").alias("label"), F.to_json(F.map_from_entries("v")).alias("vote_counts"), "n_annotators", (F.size("v") == 1).alias("agreed"),
    )


def matched(records: DataFrame, gold_by_id: DataFrame, gold_by_text: DataFrame) -> DataFrame:
    """Records with their gold label: by source_obs_id, else by excerpt start and value; null where neither matches."""
    a = gold_by_id.select(F.col("observation_id").alias("source_obs_id"), F.col("label").alias("g1"))
    b = gold_by_text.select("key", "value_name", F.col("label").alias("g2"))
    out = records.join(a, "source_obs_id", "left").withColumn("key", F.substring("text_excerpt", 1, 80)).join(b, ["key", "value_name"], "left")
    return out.withColumn("gold", F.coalesce("g1", "g2")).drop("g1", "g2", "key")


def class_metrics(pred: str, gold: str, name: str) -> list:
    """Columns precision, recall, f1 of one label against the rest."""
    p, g = F.col(pred) == name, F.col(gold) == name
    tp, fp, fn = F.count_if(p & g), F.count_if(p & ~g), F.count_if(~p & g)
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    pre, rec = ratio(tp, tp + fp), ratio(tp, tp + fn)
    low = name.lower()
    return [scoring.round4(pre).alias(f"{low}_precision"), scoring.round4(rec).alias(f"{low}_recall"), scoring.round4(ratio(2 * pre * rec, pre + rec)).alias(f"{low}_f1")]


def scores(matched: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Metrics for P1, P0 and APY, confusion counts for P1, and how many records had no gold label."""
    hit = matched.groupBy(*(by or []))  # a row without gold compares to null, which no count counts
    p, g = F.col("label") == "P1", F.col("gold") == "P1"
    parts = [c for name in ("P1", "P0", "APY") for c in class_metrics("label", "gold", name)]
    return hit.agg(
        F.count("gold").alias("n_matched"), F.count_if(F.col("gold").isNull()).alias("n_unmatched"), *parts, scoring.round4(F.try_divide(F.count_if(p == g), F.count("gold"))).alias("accuracy"),
        F.count_if(p & g).alias("tp"), F.count_if(p & ~g).alias("fp"), F.count_if(~p & g).alias("fn"), F.count_if(~p & ~g).alias("tn"),
    )


def sweep(observations: DataFrame, p1s: tuple[float, ...] = fixed.SWEEP_P1, p0s: tuple[float, ...] = fixed.SWEEP_P0) -> DataFrame:
    """Metrics of every threshold pair with p0 < p1 over observations with ``gold``.

    The markers do not depend on thresholds, so observations are first
    counted by what the label depends on; the grid then meets counts of
    distinct resistances, not texts.
    """
    spark = observations.sparkSession
    grid = spark.createDataFrame([(a, b) for a in p1s for b in p0s if b < a], "p1_threshold double, p0_threshold double")
    # what the markers alone decide; AMBIGUOUS where they leave it to the thresholds
    low = scoring.label(F.col("text_excerpt"), F.lit(0.5), 2.0, 0.0)
    kinds = observations.where("gold is not null").select("gold", "resistance", low["label"].alias("by_marker")).groupBy("gold", "resistance", "by_marker").agg(F.count(F.lit(1)).alias("n"))
    open_ = F.col("by_marker") == "AMBIGUOUS"
    label = F.when(~open_, F.col("by_marker")).when(F.col("resistance") >= F.col("p1_threshold"), "P1").when(F.col("resistance") < F.col("p0_threshold"), "P0").otherwise("AMBIGUOUS")
    rows = kinds.join(F.broadcast(grid), F.lit(True)).withColumn("label", label)
    total = lambda test: F.sum(F.when(test, F.col("n")).otherwise(0))
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    out = [F.sum("n").alias("n_matched")]
    for name in ("P1", "P0", "APY"):
        p, g = F.col("label") == name, F.col("gold") == name
        tp, fp, fn = total(p & g), total(p & ~g), total(~p & g)
        pre, rec = ratio(tp, tp + fp), ratio(tp, tp + fn)
        k = name.lower()
        out += [scoring.round4(pre).alias(f"{k}_precision"), scoring.round4(rec).alias(f"{k}_recall"), scoring.round4(ratio(2 * pre * rec, pre + rec)).alias(f"{k}_f1")]
    same = (F.col("label") == "P1") == (F.col("gold") == "P1")
    out.append(scoring.round4(total(same) / F.sum("n")).alias("accuracy"))
    return rows.groupBy("p1_threshold", "p0_threshold").agg(*out).orderBy(F.desc("p1_f1"), "p1_threshold", "p0_threshold")


def formula_audit(scored: DataFrame) -> DataFrame:
    """Mean error of ``computed`` against ``human`` resistance, over all, P1 and failures, with counts of large errors."""
    d = F.col("computed") - F.col("human")
    bad = F.col("label").isin("P0", "APY")
    mae = lambda test: scoring.round4(F.avg(F.when(test, F.abs(d))))
    return scored.agg(
        F.count(F.lit(1)).alias("n"), scoring.round4(F.avg(F.abs(d))).alias("mae"), mae(F.col("label") == "P1").alias("mae_p1"), mae(bad).alias("mae_p0"),
        F.count_if(d > 0.10).alias("over"), F.count_if(d < -0.10).alias("under"), F.count_if(F.abs(d) > 0.15).alias("flag_mild"), F.count_if(F.abs(d) > 0.30).alias("flag_severe"),
    )


def from_paragraphs(paragraphs: DataFrame, stems: DataFrame, least: int = 1) -> DataFrame:
    """Gold rows (text_excerpt, value_name, label, mode) of ``paragraphs`` (para_id, paragraph) that speak of a value.

    ``stems`` (stem, value_name) are beginnings of words, a bounded dimension
    that is packed into one row. Mode ``quote`` takes a quoted passage whose
    surroundings hold a stem; mode ``paragraph`` a paragraph of 80 characters
    or more whose stems name ``least`` values or more, repeats included. Of
    equal beginnings of a value the first stays: quotes before paragraphs,
    then by paragraph.
    """
    packed = F.broadcast(signals.dimension(stems).agg(F.array_sort(F.collect_list(F.struct("stem", "value_name"))).alias("stems")))
    rows = paragraphs.where(~F.col("paragraph").startswith("[SECTION:")).join(packed, F.lit(True))
    told = lambda body: F.transform(F.filter("stems", lambda s: F.instr(F.lower(body), s["stem"]) > 0), lambda s: s["value_name"])
    quotes = rows.select("para_id", "stems", F.posexplode(readers.quoted(F.col("paragraph"))).alias("at", "q")).select("para_id", "at", F.substring("q.quote", 1, 200).alias("text_excerpt"), F.explode(F.array_distinct(told(F.col("q.context")))).alias("value_name"), F.lit("quote").alias("mode"))
    whole = rows.where(F.length("paragraph") >= 80).withColumn("told", told(F.col("paragraph"))).where(F.size("told") >= least)
    whole = whole.select("para_id", F.lit(1_000_000).alias("at"), F.substring("paragraph", 1, 300).alias("text_excerpt"), F.explode(F.array_distinct("told")).alias("value_name"), F.lit("paragraph").alias("mode"))
    # within a paragraph its quotes come first, so order by paragraph, then place
    first = quotes.unionByName(whole).groupBy(F.substring("text_excerpt", 1, 80).alias("key"), "value_name").agg(F.min_by(F.struct("text_excerpt", "mode"), F.struct("para_id", "at")).alias("b"))
    return first.select("b.text_excerpt", "value_name", F.lit("P1").alias("label"), "b.mode")
