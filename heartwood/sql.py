"""SQL surface: scoring functions, a table function for passages, and views of the derived tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from heartwood.functions import fixed


def _round4(x: str) -> str:
    """Four places, by the law of ``scoring.round4``."""
    return f"floor(({x}) * 10000D + 0.5000001D) / 10000D"


#: The passages of ``t``, as ``text.passages`` cuts them.
PASSAGES = r"""filter(aggregate(
  filter(transform(split(regexp_replace(t, r'^\s+|\s+$', ''), r'(?<=[.!?])\s+'), s -> regexp_replace(s, r'^\s+|\s+$', '')), s -> s <> ''),
  named_struct('done', cast(array() as array<string>), 'cur', ''),
  (a, s) -> if(a.cur = '' or length(a.cur) + 1 + length(s) <= 450, named_struct('done', a.done, 'cur', if(a.cur = '', s, concat(a.cur, ' ', s))), named_struct('done', concat(a.done, array(a.cur)), 'cur', s)),
  a -> concat(a.done, array(a.cur))), p -> length(p) >= 30)"""


def _found(arg: str, pattern: str) -> str:
    return f"coalesce({arg} rlike r'(?i){pattern}', false)"


def resistance_sql(t: str, sig: str, kind: str) -> str:
    """The resistance formula as a SQL expression over text, significance and document type."""
    hold, fail = _found(t, fixed.RESISTANCE_HOLD), _found(t, fixed.RESISTANCE_FAILURE)
    extra = f"CASE WHEN {hold} THEN {fixed.HOLD_EXTRA}D ELSE 0D END"
    nudge = "CASE lower(trim(%s)) %s ELSE %sD END" % (kind, " ".join(f"WHEN '{k}' THEN {v}D" for k, v in fixed.RESISTANCE_NUDGE.items()), fixed.RESISTANCE_NUDGE["unknown"])
    tier = (
        f"CASE WHEN {_found(t, fixed.MORTAL)} THEN {fixed.MORTAL_BONUS}D + {extra} WHEN {_found(t, fixed.HIGH_ADVERSITY)} THEN CASE WHEN {fail} THEN 0D ELSE {fixed.HIGH_BONUS}D + {extra} END "
        f"WHEN {_found(t, fixed.ADVERSITY)} THEN CASE WHEN {fail} AND NOT {hold} THEN 0D ELSE {fixed.ADVERSITY_BONUS}D + {extra} END ELSE 0D END"
    )
    return _round4(f"greatest(0D, least(1D, {fixed.BASE}D + CASE WHEN isnan({sig}) THEN {fixed.SIG_CAP}D ELSE least({sig} * {fixed.SIG_SCALE}D, {fixed.SIG_CAP}D) END + {nudge} + {tier}))")


def structural_sql(t: str) -> str:
    parts = []
    for low, mid, high in fixed.STRUCTURE.values():
        a, b, c = fixed.TIERS
        parts.append(f"CASE WHEN {_found(t, high)} THEN {c}D WHEN {_found(t, mid)} THEN {b}D WHEN {_found(t, low)} THEN {a}D ELSE 0D END")
    return _round4(f"({' + '.join(parts)}) / 4")


def register(spark: SparkSession, views: dict[str, DataFrame] | None = None) -> None:
    """Temporary SQL functions value_resistance(text, significance, doc_type), value_structure(text), value_passages(text), and views.

    The functions are SQL expressions, so they run inside the JVM and the
    optimizer sees through them.
    """
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION value_structure(t STRING) RETURNS DOUBLE RETURN {_escaped(structural_sql('t'))}")
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION value_resistance(t STRING, s DOUBLE, k STRING) RETURNS DOUBLE RETURN {_escaped(resistance_sql('t', 's', 'k'))}")

    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION value_passages(t STRING) RETURNS TABLE (place INT, passage STRING) RETURN SELECT posexplode({PASSAGES})")
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)


def _escaped(expression: str) -> str:
    """Raw literals hold the patterns' apostrophes as regular-expression escapes."""
    return expression.replace("won'?t", r"won\x27?t")
