"""Text functions as column expressions: sentences, passages, markers, match positions and archaic forms."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from heartwood.functions import fixed
from heartwood.functions.arrays import let, running
from heartwood.functions.gates import may_hold

PASSAGE, SHORTEST = 450, 30


def found(text: Column, pattern: str) -> Column:
    """Whether a pattern occurs, whatever the case; null text holds nothing."""
    return F.coalesce(text.rlike("(?i)" + pattern), F.lit(False))


def markers(text: Column, pattern: str, may: Column | None = None) -> Column:
    """All matches in order, lower-cased, repeats included; ``may`` is false only where there is none."""
    hits = F.transform(F.regexp_extract_all(text, F.lit("(?i)" + pattern), F.lit(0)), F.lower)
    return F.coalesce(F.when(may_hold(text, pattern) if may is None else may, hits), F.array().cast("array<string>"))


def positions(text: Column, pattern: str | Column) -> Column:
    """array of struct(s, e): 0-based spans of all matches, from the lengths of the pieces between them."""
    p = F.lit("(?i)" + pattern) if isinstance(pattern, str) else F.concat(F.lit("(?i)"), pattern)

    def spans(v: Column) -> Column:
        steps = F.zip_with(v["gaps"], v["hits"], lambda g, h: g + h)
        return F.zip_with(F.zip_with(running(steps, lambda a, x: a + x), v["gaps"], lambda b, g: b + g), v["hits"], lambda s, h: F.struct(s.alias("s"), (s + h).alias("e")))

    def both(hits: Column) -> Column:
        gaps = F.transform(F.slice(F.split(text, p, -1), 1, F.size(hits)), F.length)
        return F.when(F.size(hits) > 0, let(F.struct(gaps.alias("gaps"), hits.alias("hits")), spans)).otherwise(F.expr("cast(array() as array<struct<s:int,e:int>>)"))

    return let(F.transform(F.regexp_extract_all(text, p, F.lit(0)), F.length), both)


def window(text: Column, lo: Column, hi: Column) -> Column:
    """Characters [lo, hi) with 0-based ends clipped to the text's."""
    lo = F.greatest(lo, F.lit(0))
    return F.substring(text, lo + 1, F.greatest(hi - lo, F.lit(0)))


def strip(text: Column) -> Column:
    """White space (that of patterns' ``\\s``) taken off both ends."""
    return F.btrim(text, F.lit(" \t\n\x0b\f\r"))


def sentences(text: Column) -> Column:
    """Sentences: split after ., ! or ? and white space; empty ones go."""
    return F.filter(F.transform(F.split(strip(text), r"(?<=[.!?])\s+"), strip), lambda s: s != "")


def passages(text: Column, size: int = PASSAGE, shortest: int = SHORTEST) -> Column:
    """Sentences packed in order into passages of ``size`` characters at most; a longer sentence stays whole, a short passage goes.

    With one blank between sentences, a passage is the longest run of ``size``
    characters that ends where a sentence does, so one pattern finds them all.
    """
    end = r"(?:(?<=[.!?])(?= )|\z)"
    joined = F.regexp_replace(strip(text), r"(?<=[.!?])\s+", " ")
    packed = F.regexp_extract_all(joined, F.lit(rf"(?s)(.{{1,{size}}}{end}|.+?{end}) ?"), F.lit(1))
    return F.filter(F.coalesce(packed, F.expr("cast(array() as array<string>)")), lambda p: F.length(p) >= shortest)


def trie(words: list[str]) -> str:
    """A pattern for any of ``words``, the longest that fits, in which words share their beginnings."""
    def built(group: list[str]) -> str:
        heads: dict[str, list[str]] = {}
        for w in group:
            if w:
                heads.setdefault(w[0], []).append(w[1:])
        parts = [re.escape(c) + built(rest) for c, rest in sorted(heads.items())]
        if not parts:
            return ""
        body = parts[0] if len(parts) == 1 and "" not in group else "(?:" + "|".join(parts) + ")"
        return body + "?" if "" in group else body

    return built(sorted(set(words))) if any(words) else "(?!)"


#: Any archaic form. No modern form holds one, so all are replaced at once, as one after another would do.
_ARCHAIC = trie([old for old, _ in fixed.ARCHAIC])
ARCHAIC_FORM = re.compile(rf"(?<!\w){_ARCHAIC}(?![a-zA-Z0-9_])", re.IGNORECASE | re.ASCII)
#: What every text with such a form matches, as Arrow's patterns have it; one pass that is far cheaper than the form's own.
ARCHAIC_GATE = rf"(?:^|[^0-9A-Za-z_])(?i:{_ARCHAIC})(?:[^0-9A-Za-z_]|\z)"
MODERN = dict(fixed.ARCHAIC)
#: Kinds of characters that go on with a word: letters, digits and marks on letters.
WORDED = frozenset({"Lu", "Ll", "Lt", "Lm", "Lo", "Nd", "Mn"})


def _modern(m: re.Match) -> str:
    old, after = m[0], m.string[m.end():m.end() + 1]
    if after and unicodedata.category(after) in WORDED:
        return old
    new = MODERN[old.lower()]
    # an apostrophe has no case, so only capitals throughout count
    if old == old.upper():
        return new.upper()
    return new[0].upper() + new[1:] if old[0] != "'" and old[0] == old[0].upper() else new


def modernised(text: Column) -> Column:
    """Archaic forms replaced, keeping capitals and capitalisation; texts without one, which Arrow tells for a whole batch, pass as they are."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for s in batches:
            old = pc.fill_null(pc.match_substring_regex(s, ARCHAIC_GATE), False)
            new = [ARCHAIC_FORM.sub(_modern, t.decode("utf-8", "replace")) for t in s.filter(old).cast(pa.binary()).to_pylist()]
            yield pc.replace_with_mask(s, old, pa.array(new, s.type)) if new else s

    return F.arrow_udf(run, "string")(text)


def excerpt(text: Column, size: int = 150) -> Column:
    """The text, or its first ``size`` - 3 characters and an ellipsis."""
    return F.when(F.length(text) <= size, text).otherwise(F.concat(F.substring(text, 1, size - 3), F.lit("...")))


def keyword_excerpt(text: Column, at: Column, length: Column, before: int = 40, after: int = 60) -> Column:
    """The text around a keyword, with an ellipsis on each cut side."""
    lo, hi = F.greatest(at - before, F.lit(0)), F.least(at + length + after, F.length(text))
    return F.substring(F.concat(F.when(lo > 0, "...").otherwise(""), strip(window(text, lo, hi)), F.when(hi < F.length(text), "...").otherwise("")), 1, 150)


def any_of(words: tuple[str, ...]) -> str:
    """Word-bounded alternation, longest first, so phrases win over their parts."""
    return r"\b(?:" + "|".join(sorted(words, key=len, reverse=True)) + r")\b"


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"\b[a-z][a-z\-']{1,}\b"), F.lit(0))


#: Frequent short words of some languages, for texts whose language is not given.
COMMON = {
    "en": ("the", "and", "of", "to", "in", "that", "is", "was", "for", "with"), "de": ("der", "die", "und", "das", "nicht", "ist", "ein", "mit", "den", "zu"),
    "fr": ("le", "la", "les", "et", "des", "est", "une", "dans", "que", "pour"), "es": ("el", "los", "las", "y", "que", "del", "una", "por", "con", "para"),
}


def language(text: Column, least: int = 3) -> Column:
    """struct(lang, share): the language with the most frequent short words among ``least`` or more; ``unknown`` with 0 otherwise."""
    counts = F.array(*(F.struct(F.regexp_count(F.lower(text), F.lit(r"\b(?:" + "|".join(w) + r")\b")).alias("n"), F.lit(name).alias("lang")) for name, w in COMMON.items()))

    def best(c: Column) -> Column:
        top, total = F.array_max(c), F.aggregate(c, F.lit(0), lambda a, x: a + x["n"])
        return F.when(top["n"] >= least, F.struct(top["lang"].alias("lang"), F.round(top["n"] / total, 4).alias("share"))).otherwise(F.struct(F.lit("unknown").alias("lang"), F.lit(0.0).alias("share")))

    return F.when(text.isNull(), F.struct(F.lit("unknown").alias("lang"), F.lit(0.0).alias("share"))).otherwise(let(counts, best))
