"""Cheap necessary conditions: one pattern for the beginnings of many, so most texts meet none of the many.

A pattern's beginnings are read from its parse: letters, small classes and
white space up to ``REACH`` steps, alternatives and optional parts spread out.
Every match of the pattern starts with one of them at a word boundary, so a
text without a beginning holds no match, and nothing else may be concluded.
The beginnings of all patterns share one trie, which is one pass over a text
however many alternatives there are.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from re import _constants as op
from re import _parser

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Steps of a beginning, and how many beginnings a pattern may have before they are cut to a single step.
REACH, MOST = 10, 4000
SPACE = " "


class Unbounded(ValueError):
    """The pattern need not start at a word boundary with a known letter."""


def _spread(items: list, starts: set[tuple[str, bool]]) -> set[tuple[str, bool]]:
    """``starts`` of (beginning, whether it may grow) continued by a parsed sequence."""
    for kind, arg in items:
        growing = {s for s, more in starts if more}
        if not growing:
            break
        done = {(s, False) for s, more in starts if not more}
        if kind is op.AT:  # \\b and anchors take no character
            continue
        if kind is op.LITERAL:
            starts = done | {(s + chr(arg).lower(), True) for s in growing}
        elif kind is op.SUBPATTERN:
            starts = done | _spread(arg[-1], {(s, True) for s in growing})
        elif kind is op.BRANCH:
            starts = done.union(*(_spread(part, {(s, True) for s in growing}) for part in arg[1]))
        elif kind is op.IN and all(k is op.LITERAL for k, _ in arg):
            starts = done | {(s + chr(c).lower(), True) for s in growing for _, c in arg}
        elif kind is op.MAX_REPEAT and arg[0] == 1 and list(arg[2]) == [(op.IN, [(op.CATEGORY, op.CATEGORY_SPACE)])]:
            starts = done | {(s + SPACE, True) for s in growing}
        elif kind is op.MAX_REPEAT and arg[:2] == (0, 1):
            starts = done | {(s, True) for s in growing} | _spread(arg[2], {(s, True) for s in growing})
        else:
            return done | {(s, False) for s in growing}
        starts = {(s[:REACH], more and len(s) < REACH) for s, more in starts}
    return starts


def beginnings(pattern: str) -> set[str]:
    """What every match of a pattern without capitals starts with: lower-case letters, and blanks for white space."""
    parsed = list(_parser.parse(pattern))
    if not parsed or parsed[0] != (op.AT, op.AT_BOUNDARY):
        raise Unbounded(pattern)
    found = {s.rstrip(SPACE) for s, _ in _spread(parsed, {("", True)})}
    if len(found) > MOST:
        found = {s[:1] for s in found}
    if not all(s and s[0].isascii() and s[0].isalpha() for s in found):
        raise Unbounded(pattern)
    return found


#: What stands before a beginning: a set is far cheaper to try at each place than a word boundary, and misses none.
BEFORE = "[^a-zA-Z]"


#: Letters of other alphabets whose small letters are, or begin with, those of a to z.
MADE = "\u0130\u212a"


def gate(*patterns: str) -> str:
    """A pattern that each text with a match of one of ``patterns`` matches too once a blank stands before it, whatever the case."""
    return _begins(sorted(set().union(*map(beginnings, patterns))))


def _begins(every: list[str]) -> str:
    known = set(every)
    kept = [s for s in every if not any(s[:n] in known for n in range(1, len(s)))]  # a shorter beginning speaks for longer ones

    def built(group: list[str]) -> str:
        heads: dict[str, list[str]] = {}
        for s in group:
            if not s:
                return ""
            heads.setdefault(s[0], []).append(s[1:])
        parts = [(r"\s+" if c == SPACE else re.escape(c)) + built(rest) for c, rest in sorted(heads.items())]
        return parts[0] if len(parts) == 1 else "(?:" + "|".join(parts) + ")"

    return f"{BEFORE}(?i:{built(kept)})"


def may_hold(text: Column, *patterns: str) -> Column:
    """False, or null for a null text, only where none of ``patterns`` is in the text; true throughout if their beginnings are not known."""
    try:
        return F.concat(F.lit(" "), text).rlike(gate(*patterns))
    except Unbounded:
        return F.lit(True)


def may(text: Column, patterns: list[str], words: list[str]) -> Column:
    """False, or null for a null text, only where none of ``patterns`` is in the text and none of ``words`` stands in it, or in its lower-cased text, with no letter before it."""
    known = set().union({w.lower() for w in words if w}, *map(beginnings, patterns))
    if not known:
        return F.lit(False)
    begins = _begins(sorted(known)).removeprefix(BEFORE)
    return F.concat(F.lit(" "), text, F.lit(" ")).rlike(f"{BEFORE}(?:{begins}|(?<=[{MADE}]))")


def may_begin(text: Column, words: list[str]) -> Column:
    """False, or null for a null text, only where none of ``words`` stands in the text with no letter before it."""
    known = sorted({w.lower() for w in words if w})
    return F.concat(F.lit(" "), text).rlike(_begins(known)) if known else F.lit(False)


#: What tells apart a pattern's matches by more than their characters, or by characters that it does not name: such a pattern has no wider one.
NARROW = re.compile(r"\[\^|\(\?[^:]|\\[BAZzDSW1-9]|(?<!\\)[\^$]")


def wider(pattern: str) -> str:
    """A pattern for Arrow (RE2, linear in the text) that matches wherever ``pattern`` does, whatever the case; all of it if there is none.

    Word boundaries go, and a vertical tab counts as white space. Texts with letters whose small
    letters are, or begin with, ASCII ones match too, as they may match once lower-cased.
    """
    if NARROW.search(pattern):
        return ""
    out, inside, i = [], False, 0
    while i < len(pattern):
        c = pattern[i:i + 2] if pattern[i] == "\\" else pattern[i]
        inside = (inside or c == "[") and c != "]"
        out.append({r"\b": r"\x08" if inside else "", r"\s": r"\s\x0b" if inside else r"[\s\x0b]"}.get(c, c))
        i += len(c)
    return f"(?i:{''.join(out)})|[{MADE}]"


def spoken(words: list[str], inside: bool = False) -> str:
    """The same for texts with one of ``words`` that no letter precedes, or, with ``inside``, anywhere."""
    known = sorted({w.lower() for w in words if w})
    if not known:
        return r"[^\x00-\x{10FFFF}]"  # no text
    return f"{'' if inside else '(?:^|[^a-zA-Z])'}(?i:{'|'.join(map(re.escape, known))})|[{MADE}]"


def _matched(texts: pa.Array, pattern: str) -> np.ndarray:
    try:
        return pc.fill_null(pc.match_substring_regex(texts, pattern), True).to_numpy(zero_copy_only=False)
    except pa.ArrowInvalid:  # a pattern beyond what Arrow takes
        return np.ones(len(texts), bool)


def marks(text: Column, wide: list[str]) -> Column:
    """long: bit i is set in every text that matches the i-th of at most 63 Arrow patterns, as ``wider`` makes them; a null text has all bits."""
    every = "|".join(f"(?:{p})" for p in wide)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for s in batches:
            out = np.zeros(len(s), np.int64)
            at = np.flatnonzero(_matched(s, every))  # most texts match none, which one pass tells
            some = s.take(pa.array(at))
            for i, p in enumerate(wide if len(at) else []):
                out[at[_matched(some, p)]] |= 1 << i
            yield pa.array(out)

    return F.arrow_udf(run, "long")(text)


def told(column: Column, patterns: list[str]) -> Callable[..., Column]:
    """``may_hold`` for a text whose ``marks`` by these patterns are at hand: a function of some of the patterns."""
    def may(*some: str) -> Column:
        return column.bitwiseAND(F.lit(sum(1 << patterns.index(p) for p in set(some)))) != 0

    return may
