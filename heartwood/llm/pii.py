"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust a score. Built-in functions only.

Base kinds (email, ip, card, phone) keep every valid match. The method adds
two kinds that a pattern alone could not decide: ``iban``, confirmed by
mod-97, and ``ssn``, accepted only where its score with context reaches
``ACCEPT``.

Defined results: a null or empty text has no spans; ties between kinds at
one start follow the order of ``KINDS``; repeated rows give repeated
results; other columns are not read, so clashing names do no harm.
Patterns are written so that each takes time linear in the text: a run that
cannot match is entered only at its start (or where the last match ended),
and repeated groups are possessive, which the engine runs as a loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heartwood.llm.spans import blocks, cut, joined, running, with_matches

KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE = KINDS[:4]
#: Score of a confirmed pattern before its context is read.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.95, "ssn": 0.4}
#: Words within WINDOW characters before or after a span that raise or lower its score.
RAISES = {
    "email": r"\b(e-?mail|contact|write to|mailto|reach)\b",
    "ip": r"\b(ip|host|server|address|login|client)\b",
    "card": r"\b(card|visa|mastercard|amex|credit|debit|payment)\b",
    "phone": r"\b(phone|call|tel|telephone|mobile|fax|whatsapp)\b",
    "iban": r"\b(iban|bank|account|transfer|konto|compte|cuenta)\b",
    "ssn": r"\b(ssn|social security)\b",
}
LOWERS = r"\b(example|sample|version|release|isbn|order no|invoice no|test data)\b"
RAISE, LOWER, WINDOW, ACCEPT = 0.2, 0.3, 40, 0.5

_LOCAL = "A-Za-z0-9._%+-"
EMAIL = rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[ -]?[0-9])++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,4})?)(?![A-Za-z0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])?"


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    def step(acc: Column, c: Column) -> Column:
        d = c.cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return F.struct((acc["sum"] + F.when(acc["odd"], twice).otherwise(d)).alias("sum"), (~acc["odd"]).alias("odd"))

    zero = F.struct(F.lit(0).alias("sum"), F.lit(False).alias("odd"))
    return F.aggregate(F.split(F.reverse(digits), ""), zero, step, lambda a: a["sum"] % 10 == 0)


def mod97(iban: Column) -> Column:
    """Whether the letters and digits of an account number pass the mod-97 check."""
    moved = F.concat(F.substring(iban, 5, 64), F.substring(iban, 1, 4))

    def step(acc: Column, c: Column) -> Column:
        letter = F.ascii(c) - 55
        return F.when(c.between("0", "9"), (acc * 10 + (F.ascii(c) - 48)) % 97).otherwise((acc * 100 + letter) % 97)

    return F.aggregate(F.split(moved, ""), F.lit(0), step) == 1


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        return m.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return F.length(_digits(m)).between(14, 19) & luhn(_digits(m))
    if kind == "phone":
        return F.length(_digits(m)).between(10, 15)
    if kind == "iban":
        return mod97(F.regexp_replace(m, " ", ""))
    return F.lit(True)


def _score(kind: str, parts: Column, x: Column) -> Column:
    lo = F.greatest(x["s"] - WINDOW, F.lit(0))
    near = F.lower(F.concat(cut(parts, lo, x["s"]), F.lit(" "), cut(parts, x["e"], x["e"] + WINDOW)))
    up = F.when(near.rlike(RAISES[kind]), RAISE).otherwise(0.0)
    down = F.when(near.rlike(LOWERS), LOWER).otherwise(0.0)
    return F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.lit(PRIOR[kind]) + up - down)), 2)


def with_pii(df: DataFrame, text: str = "text", out: str = "pii") -> DataFrame:
    """Add ``out``: array of struct(s, k, e, kind, score), ordered by start and kind.

    ``s`` and ``e`` are code-point offsets, end exclusive; ``k`` is the kind's
    place in ``KINDS``.
    """
    t = "__pii_text"
    df = df.withColumn(t, F.coalesce(F.col(text), F.lit("")))
    x = F.col(t)
    df = df.withColumn("__pii_long", x.rlike(r"[0-9](?:[ -]?[0-9]){13}"))
    dotted = x.rlike(r"[0-9]\.[0-9]++\.[0-9]")
    for kind, pattern, maybe in (
        ("email", EMAIL, x.contains("@")),
        ("ip", IP, dotted),
        ("card", CARD, F.col("__pii_long")),
        ("phone", PHONE, x.contains("+")),
        ("iban", IBAN, x.rlike(r"[A-Z]{2}[0-9]{2}[ A-Z0-9]{11}")),
        ("ssn", SSN, x.rlike(r"[0-9]{3}-[0-9]{2}-[0-9]{4}")),
    ):
        df = with_matches(df, f"__pii_{kind}", x, pattern, maybe)
    df = df.withColumn("__pii_blocks", blocks(x))
    each = []
    for k, kind in enumerate(KINDS):
        valid = F.filter(F.col(f"__pii_{kind}"), lambda m: _valid(kind, m["m"]))
        made = F.transform(valid, lambda m: F.struct(m["s"].alias("s"), F.lit(k).alias("k"), m["e"].alias("e"), F.lit(kind).alias("kind"), _score(kind, F.col("__pii_blocks"), m).alias("score")))
        if kind not in BASE:
            made = F.filter(made, lambda m: m["score"] >= ACCEPT)
        each.append(made)
    df = df.withColumn(out, F.array_sort(F.concat(*each)))
    return df.drop(t, "__pii_long", "__pii_blocks", *(f"__pii_{kind}" for kind in KINDS))


def digest(df: DataFrame) -> DataFrame:
    """One row per document: counts, the digest of the base spans, all spans and their scores."""
    df = with_pii(df.select("doc_id", "text"), "text", "pii")
    base = F.filter("pii", lambda x: x["k"] < len(BASE))
    count = lambda kind: F.size(F.filter("pii", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return df.select(
        "doc_id",
        *(count(kind) for kind in BASE),
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("pii")).alias("spans"),
        F.array_join(F.transform("pii", lambda x: x["score"].cast("string")), ",").alias("scores"),
        *(count(kind) for kind in KINDS[len(BASE):]),
    )


def redact(df: DataFrame, text: str = "text") -> DataFrame:
    """Replace each span, or union of overlapping spans, by its first kind in angle brackets; null texts stay null."""
    names = df.columns
    df = with_pii(df.select(F.struct(*names).alias("row"), F.col(text).alias("x")), "x", "pii")
    x = F.col("x")
    # a span that starts where all before it have ended replaces the text from there on
    reach = running(F.transform("pii", lambda m: m["e"]), lambda a, e: F.greatest(a, e))
    df = df.withColumn("reach", reach).withColumn("blocks", F.when(F.size("pii") > 0, blocks(x)))
    fresh = F.filter(F.arrays_zip(F.col("pii").alias("m"), F.col("reach").alias("r")), lambda z: z["m"]["s"] >= z["r"])
    pieces = F.transform(fresh, lambda z: F.concat(cut(F.col("blocks"), z["r"], z["m"]["s"]), F.lit("<"), F.upper(z["m"]["kind"]), F.lit(">")))
    last = F.array_max(F.transform("pii", lambda m: m["e"]))
    done = F.concat(F.array_join(pieces, ""), cut(F.col("blocks"), last, F.length(x)))
    return df.select(*(F.when(F.size("pii") > 0, done).otherwise(x).alias(c) if c == text else F.col(f"row.{c}") for c in names))
