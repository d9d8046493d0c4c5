"""Prototype vectors and the passages near them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heartwood.config import DEFAULT, EngineConfig
from heartwood.functions import fixed, scoring
from heartwood.operators import embedding, signals


def centroids(vectors: DataFrame, label: str = "label", vector: str = "embedding") -> DataFrame:
    """(label, centroid): the mean vector of each label, scaled to unit length. Components are averaged as rows, so no label gathers."""
    each = vectors.where(F.col(vector).isNotNull()).select(label, F.posexplode(F.transform(vector, lambda c: c.cast("double"))).alias("i", "c"))
    mean = each.groupBy(label, "i").agg(F.avg("c").alias("c"))
    rows = mean.groupBy(label).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "c"))), lambda x: x["c"]).alias("v"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    return rows.select(label, F.transform("v", lambda x: F.try_divide(x, norm)).alias("centroid"))


def nearest(vectors: DataFrame, prototypes: DataFrame, key: str = "vec_id", k: int = fixed.SEMANTIC_TOP, least: float = fixed.SEMANTIC_THRESHOLD) -> DataFrame:
    """(key, rank, label, score): the k prototypes most like each vector, from ``least`` on.

    Prototypes are a fixed dimension (one for each value and direction) and
    are packed into one broadcast row, so scoring and the choice of the best
    stay inside a vector's row: no shuffle.
    """
    packed = signals.dimension(prototypes, 10_000).agg(F.array_sort(F.collect_list(F.struct("label", "centroid"))).alias("p"))
    rows = vectors.select(key, "embedding").join(F.broadcast(packed), F.lit(True))
    scored = F.transform("p", lambda x: F.struct((-scoring.round4(scoring.cosine(F.col("embedding"), x["centroid"]))).alias("neg"), x["label"].alias("label")))
    best = F.slice(F.array_sort(F.filter(scored, lambda x: -x["neg"] >= least)), 1, k)
    return rows.select(key, F.posexplode(best).alias("r", "b")).select(key, (F.col("r") + 1).alias("rank"), F.col("b.label").alias("label"), (-F.col("b.neg")).alias("score"))


def semantic_signals(near_hold: DataFrame, near_failure: DataFrame, key: str = "vec_id") -> DataFrame:
    """Signals where a value's hold prototype scores above its failure prototype; the failure takes half its score away."""
    a = near_hold.select(key, "label", F.col("score").alias("hold"))
    b = near_failure.select(key, "label", F.col("score").alias("fail"))
    j = a.join(b, [key, "label"], "left").withColumn("fail", F.coalesce("fail", F.lit(0.0))).where("hold > fail")
    return j.select(key, F.col("label").alias("value_name"), scoring.round4((F.col("hold") - 0.5 * F.col("fail")) * 0.8).alias("confidence"))


def seed_prototypes(seeds: DataFrame, weighted: DataFrame) -> DataFrame:
    """(label, kind, centroid) of seed sentences (value_name, kind, sentence), encoded with the corpus's weights."""
    rows = seeds.withColumn("embedding", embedding.encode(F.col("sentence"), embedding.vector(weighted)))
    held, failed = prototypes(rows)
    return held.withColumn("kind", F.lit("hold")).unionByName(failed.withColumn("kind", F.lit("failure")))


def text_signals(passages: DataFrame, stored: DataFrame, weighted: DataFrame, key: str = "id", k: int = fixed.SEMANTIC_TOP, cfg: EngineConfig = DEFAULT, column: str = "text") -> DataFrame:
    """(key, value_name, confidence): signals of passages (key, ``column``: text, or its stored features) by their likeness to the stored prototypes (label, kind, centroid).

    Of the ``k`` held prototypes most like a passage, from the threshold on,
    those count that are more like it than their failure is. Prototypes are a
    fixed dimension, so all of it stays in the passage's row.
    """
    found = {kind: {r["label"]: r["centroid"] for r in signals.dimension(stored.where(F.col("kind") == kind), 10_000).collect()} for kind in ("hold", "failure")}
    near = embedding.likeness(F.col(column), found["hold"], found["failure"], embedding.vector(weighted), cfg.semantic_threshold)
    scored = F.transform("near", lambda x: F.struct((-scoring.round4(x["hold"])).alias("neg"), x["label"].alias("label"), scoring.round4(x["fail"]).alias("fail")))
    best = F.slice(F.array_sort(F.filter(scored, lambda x: -x["neg"] >= cfg.semantic_threshold)), 1, k)
    rows = passages.select(key, near.alias("near")).select(key, F.explode(best).alias("b")).select(key, F.col("b.label").alias("value_name"), (-F.col("b.neg")).alias("hold"), F.col("b.fail").alias("fail"))
    return rows.where("hold > fail").select(key, "value_name", scoring.round4((F.col("hold") - 0.5 * F.col("fail")) * cfg.semantic_weight).alias("confidence"))


def best_label(vectors: DataFrame, prototypes: DataFrame, key: str = "vec_id") -> DataFrame:
    return nearest(vectors, prototypes, key, 1, -2.0)


def prototypes(seeds: DataFrame, vector: str = "embedding") -> tuple[DataFrame, DataFrame]:
    """(held, failed): each value's centroid of its seed sentences' vectors (value_name, kind, embedding)."""
    of = lambda kind: centroids(seeds.where(F.col("kind") == kind), "value_name", vector).withColumnRenamed("value_name", "label")
    return of("hold"), of("failure")
