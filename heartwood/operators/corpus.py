"""Corpus reports over passages, observations, registries and registered documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heartwood.functions import scoring
from heartwood.operators.registry import across, figures_only, top_values


def overview(passages: DataFrame, observations: DataFrame) -> DataFrame:
    """One row of totals; every part is a partial aggregate, joined as single rows."""
    p = figures_only(passages).agg(F.count(F.lit(1)).alias("total_passages"), F.count_distinct("session_id").alias("figure_count"))
    o = figures_only(observations).agg(F.count(F.lit(1)).alias("total_observations"), F.count_distinct("value_name").alias("unique_values"), F.count_distinct("session_id", "record_id").alias("covered"))
    kinds = figures_only(passages).groupBy("doc_type").count().agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("doc_type", "count"))))).alias("doc_types"))
    rate = F.coalesce(scoring.round4(F.try_divide("covered", "total_passages")), F.lit(0.0)).alias("coverage_rate")
    times = figures_only(observations).agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    one = p.join(F.broadcast(o), F.lit(True)).join(F.broadcast(kinds), F.lit(True)).join(F.broadcast(times), F.lit(True))
    return one.select("figure_count", "total_passages", "total_observations", "unique_values", rate, "doc_types", "first_ts", "last_ts")


def stats(observations: DataFrame, reg: DataFrame, sources: DataFrame, k: int = 5) -> DataFrame:
    """One row: observations, figures, and the k values demonstrated most, ties by name, as JSON."""
    top = figures_only(reg).groupBy("value_name").agg(F.sum("demonstrations").alias("demonstrations")).orderBy(F.desc("demonstrations"), "value_name").limit(k)
    packed = top.agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("demonstrations")).alias("d"), "value_name"))), lambda x: F.struct(x["value_name"].alias("value_name"), (-x["d"]).alias("demonstrations")))).alias("top_values"))
    one = observations.agg(F.count(F.lit(1)).alias("total_observations")).join(F.broadcast(sources.agg(F.count(F.lit(1)).alias("figure_count"))), F.lit(True))
    return one.join(F.broadcast(packed), F.lit(True))


def document_list(passages: DataFrame) -> DataFrame:
    """Each session's figure, number of passages and documents, and first moment."""
    return passages.groupBy("session_id").agg(F.min("figure").alias("figure"), F.count(F.lit(1)).alias("passage_count"), F.count_distinct("doc_id").alias("document_count"), F.min("ts").alias("first_ts"))


def figure_summaries(passages: DataFrame, observations: DataFrame, reg: DataFrame, k: int = 5) -> DataFrame:
    """Per figure: counts, means and top values, in one grouped pass each."""
    p = figures_only(passages).groupBy("session_id").agg(F.count(F.lit(1)).alias("passage_count"))
    o = figures_only(observations).groupBy("session_id").agg(
        F.count(F.lit(1)).alias("observation_count"), F.count_distinct("value_name").alias("value_count"), scoring.round4(F.avg("resistance")).alias("avg_resistance"), scoring.round4(F.avg("significance")).alias("avg_significance"))
    t = top_values(reg, k).groupBy("session_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "value_name"))), lambda x: x["value_name"]), ",").alias("top_values"))
    return p.join(o, "session_id", "left").join(t, "session_id", "left")


def value_distribution(reg: DataFrame) -> DataFrame:
    return across(reg)


def distribution(observations: DataFrame, column: str) -> DataFrame:
    """Mean, population deviation, range, exact median and five buckets; the last bucket is open above."""
    c, df = F.col(column), figures_only(observations)
    edges = (0.0, 0.2, 0.4, 0.6, 0.8, None)
    parts = [F.count_if((c >= lo) & (c < hi) if hi is not None else c >= lo).alias(f"bucket_{i}") for i, (lo, hi) in enumerate(zip(edges, edges[1:], strict=False))]
    return df.agg(F.count(F.lit(1)).alias("n"), scoring.round4(F.avg(c)).alias("mean"), scoring.round4(F.stddev_pop(c)).alias("std"), F.min(c).alias("min"), F.max(c).alias("max"), scoring.round4(F.median(c)).alias("median"), *parts)


def corpus_quality(documents: DataFrame, figures: DataFrame | None = None) -> DataFrame:
    """Tier of each figure's registered documents (figure_name, doc_title, doc_type, ...); ``figures`` without any are preliminary."""
    g = documents.groupBy(F.lower("figure_name").alias("figure_name")).agg(F.count(F.lit(1)).alias("document_count"), F.array_sort(F.collect_set("doc_type")).alias("types"))
    if figures is not None:
        legacy = figures.select(F.lower("figure_name").alias("figure_name")).distinct().join(g, "figure_name", "left_anti")
        g = g.unionByName(legacy.select("figure_name", F.lit(0).cast("long").alias("document_count"), F.expr("cast(array() as array<string>)").alias("types")))
    n, kinds = F.col("document_count"), F.size("types")
    tier = F.when((n >= 3) & (kinds >= 2), "confident").when(n >= 2, "partial").otherwise("preliminary")
    need_docs, need_kinds = F.greatest(F.lit(0), 3 - n), F.greatest(F.lit(0), 2 - kinds)
    wanted = F.concat_ws(" and ", F.when(need_docs > 0, F.concat(need_docs.cast("string"), F.lit(" more document(s)"))), F.when(need_kinds > 0, F.concat(need_kinds.cast("string"), F.lit(" more document type(s)"))))
    note = F.when(n == 0, "no documents registered").when((n >= 3) & (kinds >= 2), "").otherwise(F.concat(F.lit("needs "), wanted))
    return g.select("figure_name", "document_count", F.array_join("types", ",").alias("doc_types"), kinds.alias("distinct_doc_type_count"), tier.alias("confidence_tier"), ((n >= 3) & (kinds >= 2)).alias("approved_for_export"), note.alias("notes"))


def full_report(passages: DataFrame, observations: DataFrame, reg: DataFrame, documents: DataFrame) -> dict[str, DataFrame]:
    """All sections as DataFrames; nothing runs until one is read."""
    return {
        "overview": overview(passages, observations), "figures": figure_summaries(passages, observations, reg), "values": value_distribution(reg),
        "resistance": distribution(observations, "resistance"), "significance": distribution(observations, "significance"),
        "cross_figure": across(reg, figures=2), "quality": corpus_quality(documents),
    }


def render(report: dict[str, DataFrame], rows: int = 20) -> str:
    """The report as Markdown; each section shows ``rows`` rows at most (a display)."""
    out = []
    for name, df in report.items():
        shown = df.limit(rows).collect()
        out += [f"## {name}", "", "| " + " | ".join(df.columns) + " |", "|" + " --- |" * len(df.columns)]
        out += ["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in shown] + [""]
    return "\n".join(out)
