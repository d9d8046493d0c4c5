"""Mixing sources to target weights along a time-varying curriculum. Built-in functions only.

Targets: the sources in code-point order (null last) weigh 1, 2, 3,
repeating, and share all words; a target stops at ``CAP`` times its source's
size and the excess is reshared by weight until none is above. That is the
level L with sum(min(L * weight, CAP * size)) = all words, found from the
sources sorted by CAP * size / weight.

Order: a source's documents follow a digest of their id and text, so reruns
agree. With words x before it, copy e of a document covers the demand
[e * S + x, e * S + x + size) of a source of S words; what lies below the
target is taken. The one document at a source's boundary is taken in part,
so that the taken words equal the rounded target.

Curriculum: a source's weight over training time t in [0, 1] is
target * (1 + a * (2t - 1)) with slope a of -0.5, 0 or 0.5 by the source's
place; its integral target * ((1 - a) t + a t^2) is inverted at x to give the
first copy's position, and the result is range-sorted by position.

Prefix sums are hierarchical: digits of the digest split a source into
buckets of about ``ROWS`` rows, so no source meets in one task.

Defined results: null text has size 0; size-0 documents take 0 words and have
no position; equal rows are interchangeable; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heartwood.llm.common import store

CAP, ROWS, WORDS = 3, 1000, r"[^\x20\x09-\x0D]++"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target, slope), one row per source of ``sizes`` (source, source_size).

    The sources are sorted in one task: a row each, so millions of them at
    most, however many documents there are.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    s = sizes.withColumn("place", place).withColumn("w", (F.col("place") % 3 + 1).cast("double"))
    by_ratio = Window.orderBy((CAP * F.col("source_size")).cast("double") / F.col("w"), "place").rowsBetween(Window.unboundedPreceding, -1)
    everywhere = Window.partitionBy()
    level = (F.sum("source_size").over(everywhere) - CAP * F.coalesce(F.sum("source_size").over(by_ratio), F.lit(0))).cast("double") / (F.sum("w").over(everywhere) - F.coalesce(F.sum("w").over(by_ratio), F.lit(0.0)))
    s = s.withColumn("own_level", level)
    s = s.withColumn("level", F.max("own_level").over(everywhere))
    target = F.least((CAP * F.col("source_size")).cast("double"), F.col("level") * F.col("w"))
    return s.select("source", "source_size", target.alias("target"), ((F.col("place") % 3 - 1) * 0.5).alias("slope"))


def _before(fine: DataFrame, digits: int) -> DataFrame:
    """(src, bucket, before): words of a source before each bucket, from (src, bucket, words) with ``digits`` digits."""
    if digits <= 3:
        w = Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        return fine.select("src", "bucket", F.coalesce(F.sum("words").over(w), F.lit(0)).alias("before"))
    up = F.substring("bucket", 1, digits - 3)
    coarse = fine.groupBy("src", up.alias("bucket")).agg(F.sum("words").alias("words"))
    above = _before(coarse, digits - 3).select(F.col("src"), F.col("bucket").alias("up"), F.col("before").alias("base"))
    w = Window.partitionBy("src", "up").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    within = fine.withColumn("up", up).select("src", "up", "bucket", F.coalesce(F.sum("words").over(w), F.lit(0)).alias("inner"))
    return within.join(above, ["src", "up"]).select("src", "bucket", (F.col("base") + F.col("inner")).alias("before"))


def _digest() -> Column:
    return F.md5(F.concat_ws("\n", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit(""))).cast("binary"))


def _key() -> Column:
    """A source's key: null and a text must differ."""
    return F.when(F.col("source").isNull(), "n").otherwise(F.concat(F.lit("s"), "source"))


def copy_words(e: int | Column) -> Column:
    """Words that copy e of a document gives to the mix."""
    return F.greatest(F.lit(0), F.least(F.col("size"), F.round("target").cast("long") - (e * F.col("source_size") + F.col("x"))))


def copy_position(e: int | Column) -> Column:
    """Training time at which copy e begins: the inverse of the source's cumulative demand."""
    y, a = F.try_divide(e * F.col("source_size") + F.col("x"), "target"), F.col("slope")
    return F.round(F.when((a == 0) | (y == 0), y).otherwise((F.sqrt((1 - a) * (1 - a) + 4 * a * y) - (1 - a)) / (2 * a)), 9)


def plan(docs: DataFrame) -> DataFrame:
    """(doc_id, source, digest, size, x, source_size, target, slope, taken, position) of every document of (doc_id, text, source)."""
    sized = store(docs.select("doc_id", "source", _key().alias("src"), n_words(F.col("text")).alias("size"), _digest().alias("digest")), "mix-sizes")
    digits = max(1, math.ceil(math.log(max(1, sized.count() / ROWS), 16)))
    sized = sized.withColumn("bucket", F.substring("digest", 1, digits))
    fine = store(sized.groupBy("src", "bucket").agg(F.sum("size").alias("words"), F.first("source").alias("source")), "mix-buckets")
    per_source = fine.groupBy("src").agg(F.first("source").alias("source"), F.sum("words").alias("source_size"))
    goals = targets(per_source.select("source", "source_size")).withColumn("src", _key()).drop("source")
    offsets = _before(fine, digits).join(goals, "src")
    w = Window.partitionBy("src", "bucket").orderBy("digest", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    inner = sized.withColumn("inner", F.coalesce(F.sum("size").over(w), F.lit(0)))
    df = inner.join(offsets, ["src", "bucket"]).withColumn("x", F.col("before") + F.col("inner"))
    df = df.withColumn("taken", sum((copy_words(e) for e in range(1, CAP)), copy_words(0)).cast("long"))
    return df.withColumn("position", F.when(F.col("taken") > 0, copy_position(0))).drop("src", "bucket", "before", "inner")


def digest(docs: DataFrame) -> DataFrame:
    """The whole mix, range-sorted by position; documents of which nothing is taken follow, spread by their place in the source."""
    late = 1 + F.col("x") / F.greatest(F.col("source_size"), F.lit(1))
    mix = plan(docs.select("doc_id", "text", "source"))
    return mix.orderBy(F.coalesce("position", late), "doc_id").select("doc_id", "size", "source_size", "target", "taken", "source", "position")


def mixed(docs: DataFrame) -> DataFrame:
    """The documents as the mix takes them, a row for each copy, range-sorted by the copies' positions.

    A copy that a source's target cuts holds its leading words.
    """
    names = docs.columns
    mix = store(plan(docs.select("doc_id", "text", "source")).where("taken > 0").select("doc_id", "digest", "size", "x", "source_size", "target", "slope"), "mix-plan")
    marked = docs.select(F.struct(*names).alias("doc"), "doc_id", _digest().alias("digest"))
    on = ["doc_id", "digest"]
    if not mix.groupBy(*on).count().where("count > 1").isEmpty():  # repeated rows: the n-th meets the n-th
        nth = F.row_number().over(Window.partitionBy(*on).orderBy("x"))
        mix, marked = mix.withColumn("nth", nth), marked.withColumn("x", F.lit(0)).withColumn("nth", nth).drop("x")
        on = [*on, "nth"]
    m = mix.select(*(F.col(c).alias(f"__{c}") if c in on else F.col(c) for c in mix.columns))
    match = [marked[c].eqNullSafe(m[f"__{c}"]) for c in on]
    taking = marked.join(m, match).select("doc", "size", "x", "source_size", "target", "slope", F.explode(F.sequence(F.lit(0), F.lit(CAP - 1))).alias("e"))
    taking = taking.withColumn("words", copy_words(F.col("e"))).where("words > 0").withColumn("at", copy_position(F.col("e")))
    heads = F.split(F.col("doc.text"), r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    text = F.when(F.col("words") < F.col("size"), F.array_join(F.slice(heads, 1, F.col("words").cast("int")), "")).otherwise(F.col("doc.text"))
    out = taking.select("doc", text.alias("text"), "at").orderBy("at", "doc.doc_id")
    return out.select(*(F.col("text") if c == "text" else F.col(f"doc.{c}").alias(c) for c in names))


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(concat(coalesce(doc_id::VARCHAR, ''), chr(10), coalesce(text, ''))) AS digest
  FROM documents),
sums AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
placed AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM sums),
weighed AS (SELECT *, (place % 3 + 1)::DOUBLE AS w FROM placed),
levels AS (
  SELECT *, (sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER r, 0))::DOUBLE / (sum(w) OVER () - coalesce(sum(w) OVER r, 0)) AS own
  FROM weighed WINDOW r AS (ORDER BY (3 * source_size)::DOUBLE / w, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
goals AS (
  SELECT source, source_size, least((3 * source_size)::DOUBLE, max(own) OVER () * w) AS target, (place % 3 - 1) * 0.5::DOUBLE AS a FROM levels),
laid AS (
  SELECT s.doc_id, s.source, s.size, g.source_size, g.target, g.a,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.digest, s.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS x
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source),
taking AS (
  SELECT *, (greatest(0, least(size, round(target)::BIGINT - x)) + greatest(0, least(size, round(target)::BIGINT - source_size - x))
           + greatest(0, least(size, round(target)::BIGINT - 2 * source_size - x)))::BIGINT AS taken
  FROM laid)
SELECT doc_id, size, source_size, target, taken, source,
       CASE WHEN taken > 0 THEN round(CASE WHEN a = 0 OR x = 0 THEN x / target ELSE (sqrt((1 - a) * (1 - a) + 4 * a * (x / target)) - (1 - a)) / (2 * a) END, 9) END AS position
FROM taking
"""
