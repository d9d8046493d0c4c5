"""Language identification by cross-parsing entropy over suffix automata.

A suffix automaton of some labelled text of a language accepts every string
that occurs in it. A text is parsed greedily into phrases, each the longest
match that the automaton allows; the language whose text needs the fewest
phrases, normalised by that language's phrases for text of its own kind,
wins. Texts of any length are parsed whole, many in step as rows of an array.

Training uses a bounded sample of labelled rows: for each language, of the
rows with a text and a label that are not held out, the one with the least
hash in each of ``ROWS`` buckets, and of these rows' normalised texts
``CHARS`` characters at most. That bounds the broadcast automata by languages
times CHARS; every letter of the sample counts, however many a script has.
Nothing else about a row is looked at. Of rows that share an id, the text
that sorts first is taken, so reruns agree.

Texts are normalised to lower-case letters with single spaces for all else.

Defined results: a null text, or one without a letter, is ``und`` with score
0, as is every text if nothing could be learned; ties go to the language
that sorts first; a null doc_id is not held out and not learned from; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heartwood.llm.common import small_batches

ROWS, CHARS = 32, 24_000
FOLDS, HELD = 4, 2
#: Characters parsed at once, and in one row of the parse.
BATCH, STEP = 1 << 18, 256
#: A row of the sample gives at least so many characters.
SHARE = 256
_classes: list[np.ndarray] = []


def held_out(folds: int = FOLDS, held: int = HELD) -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == held, F.lit(False))


def _letters() -> np.ndarray:
    """For every code point, the lower-case letter it stands for, or a space."""
    if not _classes:
        t = np.full(0x110000, 32, np.uint32)
        for c in range(sys.maxunicode + 1):
            x = chr(c)
            if x.isalpha():
                low = x.lower()
                t[c] = ord(low) if len(low) == 1 else c
        _classes.append(t)
    return _classes[0]


def normalise(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The normalised code points of all texts, one after the other, and where each begins."""
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    x = _letters()[points]
    keep = np.ones(len(x), bool)
    keep[1:] = (x[1:] != 32) | (x[:-1] != 32)
    starts = np.concatenate(([0], np.cumsum(lengths)))
    kept = np.concatenate(([0], np.cumsum(keep)))
    return x[keep], kept[starts]


def automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a sequence; state 0 is the root."""
    step: list[dict[int, int]] = [{}]
    link, size, last = [-1], [0], 0
    for c in codes:
        new = len(step)
        step.append({})
        size.append(size[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if size[q] != size[p] + 1:
                twin = len(step)
                step.append(dict(step[q]))
                size.append(size[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = twin
                    p = link[p]
                link[q] = twin
                link[new] = twin
            else:
                link[new] = q
        last = new
    return step


class Table:
    """The transitions of an automaton in three arrays: state s goes on ``code`` at place ``base[s] + code`` if that place belongs to s.

    Rows share the arrays by displacement, so a table takes room for its
    transitions, whatever the number of letters. ``after`` gives twice the
    next state, plus one if the character begins a phrase; from the root
    every character does.
    """

    def __init__(self, step: list[dict[int, int]], width: int):
        self.base = np.zeros(len(step), np.int32)
        used = bytearray(sum(map(len, step)) + 2 * width)
        owner: list[tuple[int, int, int]] = []
        at, degree = 0, 0
        for s in sorted(range(1, len(step)), key=lambda s: -len(step[s])):
            to = step[s]
            if len(to) != degree:
                at, degree = 0, len(to)
            if not to:
                break
            first, *more = to
            while True:  # the first place from ``at`` on where all of the row's places are free
                at = used.find(0, at)
                if at < 0:
                    at = len(used)
                    used += bytes(width + 1)
                b = at - first
                if at + width >= len(used):
                    used += bytes(2 * width)
                if not more or (b >= 0 and not any(used[b + c] for c in more)):
                    break
                at += 1
            self.base[s] = b
            for c, q in to.items():
                used[b + c] = 1
                owner.append((b + c, s, q))
        places = np.array(owner, np.int32).reshape(-1, 3)
        # a base below zero reaches round the end at most ``width`` places, where nothing is
        size = (int(places[:, 0].max()) if len(places) else 0) + 2 * width + 2
        self.owner, self.to = np.full(size, -1, np.int32), np.zeros(size, np.int32)
        self.owner[places[:, 0]], self.to[places[:, 0]] = places[:, 1], 2 * places[:, 2]
        self.again = np.ones(width, np.int32)
        for c, q in step[0].items():
            self.again[c] = 2 * q + 1

    def after(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        place = self.base[state] + code
        return np.where(self.owner[place] == state, self.to[place], self.again[code])


class Model:
    """Parsing tables of all languages over one alphabet, which holds every letter of the sample."""

    def __init__(self, texts: dict[str, np.ndarray], chars: int = CHARS):
        self.names = sorted(texts)
        every = np.concatenate([texts[n][:chars] for n in self.names]) if texts else np.empty(0, np.uint32)
        self.alphabet = np.union1d(every, [32]).astype(np.uint32)
        self.unknown = len(self.alphabet)
        self.tables = [Table(automaton(self.codes(texts[n][:chars]).tolist()), self.unknown + 1) for n in self.names]
        self.usual = []
        for i, n in enumerate(self.names):
            # phrases for a character of fresh text of the language: the text past what was learned, else 1
            fresh = texts[n][chars:2 * chars]
            self.usual.append(self.phrases(fresh, np.array([0, len(fresh)]))[0, i] / len(fresh) if len(fresh) >= chars // 4 else None)
        known = [u for u in self.usual if u]
        typical = float(np.mean(known)) if known else 1.0
        self.usual = np.array([u or typical for u in self.usual])

    def codes(self, points: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.alphabet, points), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == points, at, self.unknown).astype(np.int32)

    def phrases(self, points: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """(texts, languages) phrase counts of the texts that begin at ``starts`` (one more than texts).

        Texts are cut into parts that are parsed in step, each as if it began
        a phrase. Then the state in which the part before really ended is
        carried on into a part, until the parse meets the one already made;
        where it does not within the part, the next part follows, and so on.
        The counts are those of one parse from end to end.
        """
        lengths = np.diff(starts)
        parts = -(-lengths // STEP)
        text = np.repeat(np.arange(len(lengths)), parts)
        offset = (np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts)) * STEP
        begin, size = starts[text] + offset, np.minimum(STEP, lengths[text] - offset)
        # longest first, so that each step works on those not yet at their end
        order = np.argsort(-size, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        before = np.where(offset > 0, np.concatenate(([0], place[:-1])) if len(place) else place, -1)[order]
        behind = np.full(len(order), -1)
        behind[before[before >= 0]] = np.flatnonzero(before >= 0)
        begin, size, text = begin[order], size[order], text[order]
        codes = self.codes(points)
        out = np.zeros((len(lengths), len(self.names)), np.int64)
        live = np.searchsorted(-size, -np.arange(STEP), "left")  # how many are longer than i
        grid = [codes[begin[: live[i]] + i] for i in range(STEP) if live[i]]
        for n, table in enumerate(self.tables):
            end = np.zeros(len(begin), np.int32)
            seen = []
            for i, code in enumerate(grid):
                v = table.after(end[: live[i]], code)
                seen.append(v)
                end[: live[i]] = v >> 1
            rest = np.flatnonzero(before >= 0)
            while len(rest):
                at, state, turned = rest, end[before[rest]], []
                for i in range(STEP + 1):
                    over = size[at] <= i
                    if over.any():
                        gone, last = at[over], state[over]
                        differ = end[gone] != last
                        end[gone[differ]] = last[differ]
                        turned.append(gone[differ])
                        at, state = at[~over], state[~over]
                    if not len(at):
                        break
                    v = table.after(state, grid[i][at])
                    differ = (v >> 1) != (seen[i][at] >> 1)
                    seen[i][at] = v
                    at, state = at[differ], (v >> 1)[differ]
                changed = np.concatenate([*turned, np.empty(0, np.int64)]).astype(np.int64)
                rest = behind[changed]
                rest = rest[rest >= 0]
            count = np.zeros(len(begin), np.int64)
            for i, v in enumerate(seen):
                count[: live[i]] += v & 1
            out[:, n] = np.bincount(text, weights=count, minlength=len(lengths)).astype(np.int64)
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        if not self.names:
            return ["und"] * len(texts), np.zeros(len(texts))
        points, starts = normalise([t or "" for t in texts])
        letters = np.concatenate(([0], np.cumsum(points != 32)))[starts]
        cost = self.phrases(points, starts) / self.usual
        best = cost.argmin(axis=1)
        inverse = 1.0 / np.maximum(cost, 1e-9) ** 2
        score = inverse[np.arange(len(texts)), best] / inverse.sum(axis=1)
        some = np.diff(letters) > 0
        return [self.names[b] if s else "und" for b, s in zip(best, some, strict=True)], np.where(some, score, 0.0)


def learn(docs: DataFrame, rows: int = ROWS, chars: int = CHARS, **fold: int) -> Model:
    """Fit on the bounded sample that the module describes."""
    base = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(**fold))
    h = F.xxhash64("doc_id")
    least = base.where(F.col("text").isNotNull()).groupBy("lang", F.pmod(h, F.lit(rows)).alias("bucket")).agg(F.min_by("doc_id", h).alias("doc_id"))
    chosen = [r["doc_id"] for r in least.collect()]  # languages times ROWS at most
    sample: dict[str, list[tuple[int, str]]] = {}
    most = 4 * chars
    texts = base.where(F.col("doc_id").isin(chosen)).select("lang", h.alias("h"), F.substring("text", 1, most).alias("text")) if chosen else base.limit(0).select("lang", h.alias("h"), "text")
    for r in texts.groupBy("lang", "h").agg(F.min("text").alias("text")).where("text is not null").collect():
        sample.setdefault(r["lang"], []).append((r["h"], r["text"]))
    found = {}
    for lang, own in sample.items():
        points, starts = normalise([t for _, t in sorted(own)])
        # an equal share of each row, taken in turn, so that a long one does not stand for the language
        share = max(SHARE, 2 * chars // max(1, len(own)))
        found[lang] = np.concatenate([points[a:min(b, a + share)] for a, b in zip(starts, starts[1:], strict=False)])
    return Model({k: v for k, v in found.items() if len(v)}, chars)


def predicted(model: Model, spark) -> Column:
    """Struct (lang, score) for the column ``text``.

    Marked as not deterministic, though it is, so that a filter and a
    projection over it share one evaluation.
    """
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            texts = [t if isinstance(t, str) else None for t in s]
            names: list[str] = []
            scores: list[np.ndarray] = [np.empty(0)]
            at = 0
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and (end == at or size < BATCH):
                    size += len(texts[end] or "")
                    end += 1
                n, x = shared.value.predict(texts[at:end])
                names += n
                scores.append(x)
                at = end
            yield pd.DataFrame({"lang": pd.Series(names, dtype=object), "score": np.concatenate(scores)})

    return F.pandas_udf(run, "lang string, score double").asNondeterministic()("text")


def digest(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score)."""
    p = predicted(learn(docs), docs.sparkSession)
    return docs.select("doc_id", held_out().alias("held_out"), p.alias("p")).select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))


def accepted(docs: DataFrame, margin: float = 1.2) -> DataFrame:
    """Documents in a known language: not ``und``, and scored ``margin`` times an even guess at least. A null lang is filled in.

    Where nothing is labelled, nothing can be rejected, and all documents pass.
    """
    model = learn(docs)
    if not model.names:
        return docs
    out = docs.select(F.struct(*docs.columns).alias("row"), predicted(model, docs.sparkSession).alias("p"))
    out = out.where((F.col("p.lang") != "und") & (F.col("p.score") >= margin / max(2, len(model.names))))
    return out.select(*(F.coalesce("row.lang", "p.lang").alias(c) if c == "lang" else F.col(f"row.{c}") for c in docs.columns))
