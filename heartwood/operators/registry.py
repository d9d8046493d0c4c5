"""Registries over observations: running and final profiles of each figure's values, and across figures.

Observations: session_id, record_id, value_name, ts, significance,
resistance, doc_type. Figure sessions start with ``figure:``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heartwood.functions import scoring


def figures_only(df: DataFrame) -> DataFrame:
    return df.where(F.col("session_id").startswith("figure:"))


def registry(observations: DataFrame) -> DataFrame:
    """One row for each (session, value): counts, means, consistency and weight, from exact aggregates."""
    g = observations.groupBy("session_id", "value_name").agg(
        F.count(F.lit(1)).alias("demonstrations"), F.avg("significance").alias("sig"), F.avg("resistance").alias("res"), F.stddev_pop("resistance").alias("sigma"),
        F.min("ts").alias("first_seen_ts"), F.max("ts").alias("last_seen_ts"), F.count_distinct("doc_type").alias("types"),
    )
    return profiled(g)


def profiled(g: DataFrame) -> DataFrame:
    """Registry rows from a group's demonstrations, sig, res, sigma, first_seen_ts, last_seen_ts and types."""
    c = scoring.consistency(F.col("demonstrations"), F.col("sigma"), F.col("res"), F.col("last_seen_ts") - F.col("first_seen_ts"), F.col("types"))
    g = g.withColumn("consistency", c)
    return g.select(
        "session_id", "value_name", "demonstrations", scoring.round4("sig").alias("avg_significance"), scoring.round4("res").alias("avg_resistance"), "consistency",
        scoring.round4(F.col("demonstrations") * F.col("sig") * F.col("res") * F.col("consistency")).alias("weight"), "first_seen_ts", "last_seen_ts",
    )


def running(observations: DataFrame, span: float = 31_536_000.0) -> DataFrame:
    """The registry as it stood after each observation, in order of (ts, record_id).

    A value's history is cut into pieces of ``span`` seconds: sums inside a
    piece are running, those of the pieces before it come as one row, so a
    long history is many tasks' work. Resistances have four places, so their
    sums and sums of squares are whole numbers and the deviation is exact.
    """
    key = ["session_id", "value_name"]
    r = F.round(F.col("resistance") * 10_000).cast("decimal(20,0)")
    o = observations.select(*key, "record_id", "ts", "significance", "doc_type", r.alias("r"), F.floor(F.col("ts") / span).alias("piece"))
    inside = Window.partitionBy(*key, "piece").orderBy("ts", "record_id").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*key).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    parts = {"n": F.count(F.lit(1)), "s": F.sum("significance"), "r1": F.sum("r"), "r2": F.sum(F.col("r") * F.col("r")), "lo": F.min("ts"), "kinds": F.collect_set("doc_type")}
    pieces = o.groupBy(*key, "piece").agg(*(c.alias(name) for name, c in parts.items()))
    earlier = {"n": F.sum("n"), "s": F.sum("s"), "r1": F.sum("r1"), "r2": F.sum("r2"), "lo": F.min("lo"), "kinds": F.collect_list("kinds")}
    pieces = pieces.select(*key, "piece", *(c.over(before).alias(f"b_{name}") for name, c in earlier.items())).withColumn("b_kinds", F.flatten("b_kinds"))
    df = o.select(*key, "record_id", "ts", "piece", *(c.over(inside).alias(name) for name, c in parts.items())).join(pieces, [*key, "piece"])
    add = lambda name: F.col(name) + F.coalesce(f"b_{name}", F.lit(0))
    n = add("n")
    mean = add("r1").cast("double") / n / 10_000
    spread = (n * add("r2") - add("r1") * add("r1")).cast("double")
    types = F.size(F.array_distinct(F.concat("kinds", F.coalesce("b_kinds", F.array().cast("array<string>")))))
    c = scoring.consistency(n, F.sqrt(spread) / n / 10_000, mean, F.col("ts") - F.least("lo", F.coalesce("b_lo", "lo")), types)
    return df.select(*key, "record_id", "ts", n.alias("n"), scoring.round4(add("s") / n).alias("avg_significance"), scoring.round4(mean).alias("avg_resistance"), c.alias("consistency"))


def stepwise(observations: DataFrame) -> DataFrame:
    """Means rounded to four places at every step, as an incremental store keeps them.

    Order matters, so this is a fold: rows are sorted within their partition
    and read as a stream, with one value's state at a time.
    """
    rows = observations.select("session_id", "value_name", "ts", "record_id", "significance", "resistance").repartition("session_id", "value_name").sortWithinPartitions("session_id", "value_name", "ts", "record_id")

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, n, s, r = None, 0, 0.0, 0.0
        for b in batches:
            done = []
            for row in b.itertuples(index=False):
                if (row.session_id, row.value_name) != key:
                    done += [(*key, n, s, r)] if key else []
                    key, n, s, r = (row.session_id, row.value_name), 0, 0.0, 0.0
                s, r = (math.floor((old * n + new) / (n + 1) * 10_000 + 0.500_000_1) / 10_000 for old, new in ((s, row.significance), (r, row.resistance)))
                n += 1
            yield pd.DataFrame(done, columns=["session_id", "value_name", "demonstrations", "avg_significance", "avg_resistance"])
        if key:
            yield pd.DataFrame([(*key, n, s, r)], columns=["session_id", "value_name", "demonstrations", "avg_significance", "avg_resistance"])

    return rows.mapInPandas(fold, "session_id string, value_name string, demonstrations int, avg_significance double, avg_resistance double")


def strongest(reg: DataFrame, least: int = 1) -> DataFrame:
    return reg.where(F.col("demonstrations") >= least).orderBy(F.desc("weight"), F.desc("demonstrations"), "session_id", "value_name")


def across(reg: DataFrame, least: int = 1, figures: int = 1) -> DataFrame:
    """Values over all figures: demonstrations, mean weight and scores, number of figures."""
    g = figures_only(reg).groupBy("value_name").agg(
        F.sum("demonstrations").alias("total_demonstrations"), scoring.round4(F.avg("weight")).alias("avg_weight"), scoring.round4(F.avg("avg_significance")).alias("avg_significance"),
        scoring.round4(F.avg("avg_resistance")).alias("avg_resistance"), F.count_distinct("session_id").alias("figure_count"),
    )
    return g.where((F.col("total_demonstrations") >= least) & (F.col("figure_count") >= figures)).orderBy(F.desc("total_demonstrations"), "value_name")


def top_values(reg: DataFrame, k: int = 5) -> DataFrame:
    """The k values of largest weight in each session; ties by demonstrations, then name."""
    w = Window.partitionBy("session_id").orderBy(F.desc("weight"), F.desc("demonstrations"), "value_name")
    return reg.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("session_id", "rank", "value_name", "weight", "demonstrations")


def figure_list(sources: DataFrame, reg: DataFrame) -> DataFrame:
    """Figures with their totals and their top value; a figure without observations stays."""
    best = top_values(reg, 1).select("session_id", F.col("value_name").alias("top_value"))
    totals = reg.groupBy("session_id").agg(F.sum("demonstrations").alias("total_observations"), F.count(F.lit(1)).alias("value_count"))
    out = sources.join(totals, "session_id", "left").join(best, "session_id", "left")
    return out.withColumns({"total_observations": F.coalesce("total_observations", F.lit(0)), "value_count": F.coalesce("value_count", F.lit(0))})


def scan(observations: DataFrame, session_id: str | None = None, value: str | None = None, since: float | None = None, limit: int = 100) -> DataFrame:
    """The latest observations under optional predicates, 500 at most (the feature of this read)."""
    df = observations
    for column, wanted in (("session_id", session_id), ("value_name", value)):
        df = df.where(F.col(column) == wanted) if wanted is not None else df
    df = df.where(F.col("ts") > since) if since is not None else df
    return df.orderBy(F.desc("ts"), "session_id", "record_id", "value_name").limit(min(limit, 500))


def figure_profile(reg: DataFrame, figure: str) -> DataFrame:
    """One figure's values, the weightiest first."""
    return strongest(reg.where(F.col("session_id") == "figure:" + figure.lower()))


def universal_profile(reg: DataFrame, least: int = 1) -> DataFrame:
    """Values over all figures, the most demonstrated first."""
    return across(reg, least)
