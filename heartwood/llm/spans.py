"""Character spans of regular-expression matches, with built-in functions only.

Positions come from the pieces between matches: the i-th match starts after
the first i+1 pieces and the first i matches. Lengths count code points.

Running sums are taken in groups of about the square root of their number, so
a text of n matches costs n^1.5 short copies, not n^2; and windows are cut
from blocks of the text, so a far one is not reached from the text's start.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heartwood.functions.arrays import running

#: Characters in a block that windows are cut from.
BLOCK = 2048


def blocks(text: Column) -> Column:
    """The text in blocks of ``BLOCK`` characters, the last one shorter."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))


def cut(parts: Column, lo: Column, hi: Column) -> Column:
    """Characters [lo, hi) of the text that ``parts`` are the ``blocks`` of; hi may lie past its end."""
    at = lambda i: F.coalesce(F.get(parts, i), F.lit(""))
    a, b = F.floor(lo / BLOCK).cast("int"), F.floor(hi / BLOCK).cast("int")
    first = F.substring(at(a), lo % BLOCK + 1, F.least(hi - lo, F.lit(BLOCK)))
    between = F.when(b - a > 1, F.array_join(F.slice(parts, a + 2, b - a - 1), "")).otherwise("")
    return F.when(hi <= lo, "").when(a == b, first).otherwise(F.concat(first, between, F.substring(at(b), F.lit(1), hi % BLOCK)))


def with_matches(df: DataFrame, col: str, text: Column, pattern: str, maybe: Column) -> DataFrame:
    """Add ``col``: array of struct(s, e, m) for the leftmost non-overlapping matches of ``pattern``.

    ``maybe`` is a cheap necessary condition; the pattern runs only where it holds.
    """
    ms, parts, none = f"__{col}_m", f"__{col}_p", F.expr("cast(array() as array<string>)")
    df = df.withColumn(ms, F.when(maybe, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none))
    df = df.withColumn(parts, F.when(F.size(ms) > 0, F.split(text, pattern, -1)).otherwise(none))
    # the end of a match is the sum of all pieces and matches up to it; its start is that less its own length
    steps = F.zip_with(F.slice(parts, 1, F.size(ms)), F.col(ms), lambda p, m: F.length(p) + F.length(m))
    before = running(steps, lambda a, x: a + x)
    starts = F.zip_with(before, F.slice(parts, 1, F.size(ms)), lambda b, p: b + F.length(p))
    found = F.zip_with(starts, F.col(ms), lambda s, m: F.struct(s.alias("s"), (s + F.length(m)).alias("e"), m.alias("m")))
    empty = F.expr("cast(array() as array<struct<s:int,e:int,m:string>>)")
    return df.withColumn(col, F.when(F.size(ms) > 0, found).otherwise(empty)).drop(ms, parts)


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")
