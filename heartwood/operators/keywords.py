"""A vocabulary's keywords in texts: one automaton finds them all, in one pass over a text.

The automaton (Aho-Corasick) holds every keyword, so its time depends on the
text and not on how many keywords there are. A task builds it once and runs it
over Arrow batches; the checks of a hit look at windows around it, and a
value's disqualifying phrases are sought once a text, where the value occurs.
Only hits become rows, and a signal is the first valid keyword in its value's
order, chosen before it becomes one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heartwood.functions import fixed

FOUND = "value_name string, keyword string, kw_ord int, match_idx int, valid boolean, confidence double"
_pattern = lambda p: re.compile(p, re.IGNORECASE | re.ASCII)


class Scanner:
    """An automaton of keywords, (value, order) of each, and the checks of their hits."""

    def __init__(self, vocabulary: list[tuple[str, str, int]]):
        import ahocorasick

        self.terms: dict[str, list[tuple[str, int]]] = {}
        for value, keyword, order in vocabulary:
            if keyword:
                self.terms.setdefault(keyword, []).append((value, order))
        self.automaton = ahocorasick.Automaton()
        for keyword in self.terms:
            self.automaton.add_word(keyword, keyword)
        if self.terms:
            self.automaton.make_automaton()
        self.prefix, self.negation, self.negated, self.person = map(_pattern, (fixed.NEGATING_PREFIX, fixed.NEGATION, fixed.NEGATED_KEYWORD, fixed.FIRST_PERSON))
        self.barred = {value: _pattern(p) for value, p in fixed.DISQUALIFIERS.items()}
        self.failing, self.personal = frozenset(fixed.FAILURE_KEYWORDS), frozenset(fixed.FIRST_PERSON_VALUES)

    def first(self, low: str) -> dict[str, int]:
        """Where each keyword first occurs in a lower-cased text."""
        found: dict[str, int] = {}
        if self.terms:
            for end, keyword in self.automaton.iter(low):
                if keyword not in found:
                    found[keyword] = end + 1 - len(keyword)
        return found

    def hits(self, low: str, action: bool) -> Iterator[tuple[str, str, int, int, bool, float]]:
        """The columns ``FOUND`` of every keyword that a lower-cased text holds, at its first occurrence."""
        phrases: dict[str, list[tuple[int, int]]] = {}
        for keyword, at in self.first(low).items():
            end = at + len(keyword)
            clean = keyword in self.failing or not (self.prefix.search(low[max(at - 4, 0):at]) or (not self.negated.search(keyword) and self.negation.search(low[max(at - 30, 0):at])))
            person = bool(self.person.search(low[max(at - 80, 0):end + 80]))
            for value, order in self.terms[keyword]:
                if value not in phrases:
                    phrases[value] = [m.span() for m in self.barred[value].finditer(low)] if value in self.barred else []
                needs = value in self.personal
                valid = clean and not any(s < end and e > at for s, e in phrases[value]) and (not needs or person or action)
                yield value, keyword, order, at, valid, 1.0 if person else 0.7 if needs else 0.6

    def signals(self, low: str, action: bool) -> list[tuple[str, str, int, int, bool, float]]:
        """The first valid hit of each value, in the value's order."""
        best: dict[str, tuple] = {}
        for hit in self.hits(low, action):
            if hit[4] and (hit[0] not in best or (hit[2], hit[1]) < (best[hit[0]][2], best[hit[0]][1])):
                best[hit[0]] = hit
        return list(best.values())


def scan(passages: DataFrame, vocabulary: list[tuple[str, str, int]], keep: tuple[str, ...], best: bool) -> DataFrame:
    """``passages`` (keep, text, doc_type, significance), a row for each hit with the columns ``FOUND``; with ``best`` only signals."""
    names = [*keep, "text", "doc_type", "significance"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(vocabulary)
        look = scanner.signals if best else scanner.hits
        types = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.bool_(), pa.float64()]
        for b in batches:
            at, rows = [], []
            for i, (low, kind) in enumerate(zip(b.column("low").to_pylist(), b.column("doc_type").to_pylist(), strict=True)):
                found = list(look(low or "", (kind or "").strip(" ").lower() == "action"))
                at += [i] * len(found)
                rows += found
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(types)
            held = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([*(b.column(c).take(held) for c in names), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names=[*names, *(f.split()[0] for f in FOUND.split(", "))])

    kinds = "".join(f"{c} {passages.schema[c].dataType.simpleString()}, " for c in names)
    return passages.select(*names, F.lower("text").alias("low")).mapInArrow(run, kinds + FOUND)
