"""Language of texts by ranked character n-gram profiles.

A language's profile is the ``TOP`` most frequent n-grams of its labelled
texts with their smoothed log probabilities; an n-gram outside the profile has
the probability of one that was never seen. A text speaks the language under
which its n-grams are most probable on average, or none, ``unknown``, where
the second language is within ``MARGIN`` or fewer than ``LEAST`` n-grams speak.

Learning is one pass over all labelled texts: tasks count n-grams, and only
counts are shuffled. A profile is a bounded table, and scoring stays in the
text's row.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heartwood.operators import signals

GRAM, TOP, SMOOTH = 3, 400, 0.5
#: Average log probabilities nearer than this, or texts of fewer n-grams, leave a language unknown.
MARGIN, LEAST = 0.02, 8
#: Languages that a session may hold profiles of.
LANGUAGES = 500
_letters = re.compile(r"[^\W\d_]+").findall


def grams(text: str | None) -> Counter:
    """Counts of the n-grams of a text's words, each between spaces."""
    found: Counter = Counter()
    for word, n in Counter(_letters((text or "").lower())).items():
        marked = f" {word} "
        for i in range(len(word)):
            found[marked[i:i + GRAM]] += n
    return found


def learn(docs: DataFrame, top: int = TOP) -> DataFrame:
    """(lang, gram, logp): the profiles of labelled texts (lang, text); gram '' has the log probability of n-grams outside the profile."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                held.setdefault(lang, Counter()).update(grams(text))
        rows = [(lang, g, n) for lang, found in held.items() for g, n in found.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64()))], names=["lang", "gram", "n"])

    counts = docs.where("lang is not null and text is not null").select("lang", "text").mapInArrow(run, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
    ranked = counts.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))).where(F.col("rank") <= top)
    logp = lambda n: F.log((n + SMOOTH) / (F.col("total") + SMOOTH * F.col("kinds")))
    seen = ranked.join(totals, "lang").select("lang", "gram", logp(F.col("n")).alias("logp"))
    return seen.unionByName(totals.select("lang", F.lit("").alias("gram"), logp(F.lit(0)).alias("logp")))


def tables(profiles: DataFrame) -> dict[str, dict[str, float]]:
    """The profiles as tables: at most ``LANGUAGES`` times ``TOP`` rows."""
    out: dict[str, dict[str, float]] = {}
    for r in signals.dimension(profiles, LANGUAGES * (TOP + 1)).collect():
        out.setdefault(r["lang"], {})[r["gram"]] = r["logp"]
    return out


def score(text: str | None, model: dict[str, dict[str, float]]) -> list[tuple[float, str]]:
    """Average log probabilities of a text's n-grams, the best language first; empty where too few speak."""
    found = grams(text)
    total = sum(found.values())
    if total < LEAST:
        return []
    return sorted(((-math.fsum(n * p.get(g, p[""]) for g, n in found.items()) / total, lang) for lang, p in model.items()))


def detected(text: Column, model: dict[str, dict[str, float]], margin: float = MARGIN) -> Column:
    """struct(lang, margin): the language of a text and how far the second one is behind; ``unknown`` with what was found."""
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            rows = []
            for t in s:
                best = score(t if isinstance(t, str) else None, model)
                apart = best[1][0] - best[0][0] if len(best) > 1 else math.inf if best else 0.0
                rows.append((best[0][1] if best and apart >= margin else "unknown", min(apart, 99.0)))
            yield pd.DataFrame(rows, columns=["lang", "margin"])

    return F.pandas_udf(run, "lang string, margin double")(text)
