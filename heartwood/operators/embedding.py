"""Vectors for texts: signed feature hashing of words and character n-grams, weighted by the corpus.

A text's features are its words and the ``GRAM``-character windows of each
word between end marks. A feature's digest names one of ``DIM`` components
and a sign; a component sums the signs of its features, times the component's
inverse document frequency, and the vector has unit length. So texts with
common words, or words with common parts, have like vectors, in any language
and without a trained model; another encoder's vectors can take their place
in any operator that reads an ``embedding``.

Encoding stays inside a text's row: nothing is shuffled but the frequencies,
one row for each component. A worker keeps the features of windows at hand.

Null texts and texts without a word have the zero vector, which is like nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DIM, GRAM = 512, 3
#: Windows, and words too long for a block, whose digests a worker keeps; beyond that it starts anew.
KEPT = 200_000
#: Characters that are added up at once: few enough that what is made of them stays in a core's cache.
AT_ONCE = 100_000
#: Characters of an alphabet whose windows have a place each in a table.
ALPHABET = 256


def _digest(feature: str, dim: int) -> int:
    """Twice the feature's component, and one more for a positive sign."""
    d = md5(feature.encode()).digest()
    return 2 * (int.from_bytes(d[:4], "big") % dim) + d[4] % 2


class _Words(dict):
    """Digests of words, made when they are first asked for."""

    def __init__(self, dim: int):
        self.dim = dim

    def __missing__(self, word: str) -> int:
        if len(self) >= KEPT:
            self.clear()
        self[word] = found = _digest(f"w:{word}", self.dim)
        return found


#: MD5's shifts and constants.
_TURNS = np.repeat(np.array([[7, 12, 17, 22], [5, 9, 14, 20], [4, 11, 16, 23], [6, 10, 15, 21]], np.uint32), 4, axis=0).reshape(-1)
_SINES = (np.abs(np.sin(np.arange(1, 65, dtype=float))) * 2**32).astype(np.uint64).astype(np.uint32)
#: Bytes of a word that fit into one block of MD5 beside the mark before it, and words that are hashed at once.
FITS, WORDS = 53, 4096


def _blocks(words: pa.Array) -> np.ndarray:
    """MD5's blocks of ``w:`` and each word: sixteen numbers by words."""
    n = len(words)
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + n + 1]
    size, said = np.diff(ends), np.frombuffer(words.buffers()[2], np.uint8)[ends[0]:ends[-1]]
    out, row = np.zeros((n, 64), np.uint8), np.arange(n) * 64
    out[:, 0], out[:, 1] = ord("w"), ord(":")
    out.reshape(-1)[np.repeat(row + 2 - (ends[:-1] - ends[0]), size) + np.arange(len(said))] = said
    out.reshape(-1)[row + 2 + size] = 0x80
    bits = 8 * (size + 2)
    out[:, 56], out[:, 57] = bits & 255, bits >> 8
    return np.ascontiguousarray(out.view("<u4").T)


def _digests(words: pa.Array, dim: int) -> np.ndarray:
    """``_digest`` of ``w:`` and each of some words, none empty, as arrays: a call for each word takes most of the time that texts take."""
    long = pc.greater(pc.binary_length(words), FITS).to_numpy(zero_copy_only=False)
    if long.any():
        out = np.empty(len(words), np.int32)
        out[~long] = _digests(words.filter(pa.array(~long)), dim)
        out[long] = [*map(_hashed.setdefault(dim, _Words(dim)).__getitem__, words.filter(pa.array(long)).to_pylist())]
        return out
    parts = []
    for first in range(0, len(words), WORDS):
        m = _blocks(words.slice(first, WORDS))
        start = a, b, c, d = [np.full(m.shape[1], x, np.uint32) for x in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)]
        for i in range(64):
            if i < 16:
                f, k = d ^ (b & (c ^ d)), i
            elif i < 32:
                f, k = c ^ (d & (b ^ c)), (5 * i + 1) % 16
            elif i < 48:
                f, k = b ^ c ^ d, (3 * i + 5) % 16
            else:
                f, k = c ^ (b | ~d), 7 * i % 16
            f += a
            f += m[k]
            f += _SINES[i]
            s = _TURNS[i]
            a, d, c, b = d, c, b, b + (f << s | f >> (np.uint32(32) - s))
        head, sign = start[0] + a, start[1] + b
        parts.append((2 * (head.byteswap() % np.uint32(dim)) + (sign & np.uint32(1))).astype(np.int32))
    return np.concatenate(parts) if parts else np.zeros(0, np.int32)


class _Windows:
    """Digests of windows of three characters: one number names a window while the alphabet is small, and its digest has a place in a table."""

    def __init__(self, dim: int):
        self.dim, self.known = dim, {}
        self.place, self.chars = np.full(0x110000, -1, np.int32), []
        self.table = np.zeros(ALPHABET**GRAM, np.int32)  # one more than the digest; none is known yet

    def places(self, marked: np.ndarray) -> np.ndarray:
        """Each character's place in the alphabet, which grows by those not met before."""
        found = self.place[marked]
        if (fresh := marked[found < 0]).size:
            for c in np.unique(fresh).tolist():
                self.place[c] = len(self.chars)
                self.chars.append(chr(c))
            found = self.place[marked]
        return found

    def made(self, codes: list[int], base: int) -> list[int]:
        out = []
        for code in codes:
            gram = self.chars[code // base // base] + self.chars[code // base % base] + self.chars[code % base]
            if gram not in self.known:
                if len(self.known) >= KEPT:
                    self.known.clear()
                self.known[gram] = _digest(f"g:{gram}", self.dim)
            out.append(self.known[gram])
        return out

    def digests(self, marked: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The digests of the windows around the places ``at``."""
        p = self.places(marked)
        if len(self.chars) > ALPHABET:
            codes, where = np.unique((p[at - 1].astype(np.int64) << 42) + (p[at].astype(np.int64) << 21) + p[at + 1], return_inverse=True)
            return np.array(self.made(codes.tolist(), 1 << 21), np.int32)[where]
        code = (p[at - 1] * ALPHABET + p[at]) * ALPHABET + p[at + 1]
        found = self.table[code]
        if (fresh := code[found == 0]).size:
            fresh = np.unique(fresh)
            self.table[fresh] = np.array(self.made(fresh.tolist(), ALPHABET), np.int32) + 1
            found = self.table[code]
        return found - 1


_hashed: dict[int, _Words] = {}
_windows: dict[int, _Windows] = {}
_letters: list[np.ndarray] = []


def _lettered(chars: np.ndarray) -> np.ndarray:
    """Which characters are part of words: letters and digits of any script."""
    if not _letters:
        _letters.append(np.array([chr(c).isalnum() for c in range(0x110000)]))
    return _letters[0][chars]


def _placed(texts: list[str], dim: int) -> tuple[np.ndarray, np.ndarray]:
    """The cells (text, component) of the features of lower-cased texts, and 1 for each feature of positive sign.

    A word's windows are one around each of its characters, so all texts are
    looked at as one array of characters; each different word is hashed once.
    """
    if dim not in _windows:
        _windows[dim] = _Windows(dim)
    windows = _windows[dim]
    chars = np.frombuffer("\n".join(["", *texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _lettered(chars)
    row = np.repeat(np.arange(len(texts), dtype=np.int32), np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    at = np.flatnonzero(letter)
    first = at[~letter[at - 1]]
    said = np.where(letter, chars, ord(" ")).astype(np.uint32).tobytes().decode("utf-32-le").strip(" ")
    words = pc.list_flatten(pc.ascii_split_whitespace(pa.array([said] if said else [], pa.string()))).dictionary_encode()
    digest = np.concatenate([windows.digests(np.where(letter, chars, ord("_")), at), _digests(words.dictionary, dim)[words.indices.to_numpy()]])
    return np.concatenate([row[at - 1], row[first - 1]]) * dim + (digest >> 1), digest & 1


def _parts(texts: list[str | None], dim: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, end, cells, 1 for each positive sign) of about ``AT_ONCE`` characters at a time."""
    low, size, first = [], 0, 0
    for i, text in enumerate(texts, 1):
        low.append((text or "").lower())
        size += len(low[-1])
        if size >= AT_ONCE or len(low) * dim >= 4 * AT_ONCE or i == len(texts):
            yield first, i, *_placed(low, dim)
            low, size, first = [], 0, i


def _sums(texts: list[str | None], dim: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first text, end, sums of signs) of some texts at a time."""
    for first, end, at, positive in _parts(texts, dim):
        yield first, end, np.bincount(at, positive * 2.0 - 1.0, (end - first) * dim).reshape(-1, dim)


def sums(texts: list[str | None], dim: int = DIM) -> np.ndarray:
    """Sums of signs, texts by components."""
    out = np.zeros((len(texts), dim))
    for first, end, part in _sums(texts, dim):
        out[first:end] = part
    return out


def present(texts: list[str | None], dim: int = DIM) -> np.ndarray:
    """How many of the texts have a feature, by component."""
    out = np.zeros(dim, np.int64)
    for first, end, at, _ in _parts(texts, dim):
        has = np.zeros((end - first) * dim, np.uint8)
        has[at] = 1
        out += has.reshape(-1, dim).sum(0, np.int64)
    return out


#: In stored features, what stands for a sum of 0 where a text has features whose signs cancel.
CANCELLED = {np.dtype(np.int8): -128, np.dtype(np.int32): -(1 << 31)}


def features(text: Column, dim: int = DIM) -> Column:
    """binary: the sums of signs of texts' features as they are stored, a byte for each component, or four where a sum needs them.

    Weights need all texts before the first is likened to anything, so what both read is made once.
    """
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for s in batches:
            out = []
            for first, end, at, positive in _parts(s.to_pylist(), dim):
                size = (end - first) * dim
                x = np.bincount(at, positive * 2.0 - 1.0, size).astype(np.int32)
                has = np.zeros(size, bool)
                has[at] = True
                kind = np.dtype(np.int8 if not size or np.abs(x).max() < 128 else np.int32)
                x = x.astype(kind)
                x[has & (x == 0)] = CANCELLED[kind]
                rows, width = x.tobytes(), dim * kind.itemsize
                out += [rows[i:i + width] for i in range(0, len(rows), width)]
            yield pa.array(out, pa.binary())

    return F.arrow_udf(run, "binary")(text)


def _read(rows: list[bytes], dim: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end, signs' sums as stored, which of them stand for 0) of some stored features at a time."""
    step = max(1, 4 * AT_ONCE // dim)
    for first in range(0, len(rows), step):
        part = rows[first:first + step]
        if all(len(r) == dim for r in part):
            x = np.frombuffer(b"".join(part), np.int8).reshape(-1, dim)
            yield first, first + len(part), x, x == np.int8(CANCELLED[np.dtype(np.int8)])
        else:
            x = np.stack([np.frombuffer(r, np.int8 if len(r) == dim else np.int32).astype(np.int32) for r in part])
            narrow = np.array([len(r) == dim for r in part])[:, None]
            yield first, first + len(part), x, x == np.where(narrow, CANCELLED[np.dtype(np.int8)], CANCELLED[np.dtype(np.int32)])


def _stored(rows: list[bytes], dim: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end, sums of signs, which components have features) of some stored features at a time."""
    for first, end, x, gone in _read(rows, dim):
        sums_ = x.astype(float)
        sums_[gone] = 0.0
        yield first, end, sums_, x != 0


def _counted(s: pa.Array, dim: int) -> np.ndarray:
    """How many texts, or stored features, have a feature, by component."""
    if not pa.types.is_binary(s.type):
        return present(s.to_pylist(), dim)
    return sum((np.count_nonzero(x, axis=0) for _, _, x, _ in _read(s.to_pylist(), dim)), np.zeros(dim, np.int64))


def _summed(s: pa.Array, dim: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first, end, sums of signs) of texts, or of their stored features."""
    if pa.types.is_binary(s.type):
        yield from ((first, end, x) for first, end, x, _ in _stored(s.to_pylist(), dim))
    else:
        yield from _sums(s.to_pylist(), dim)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; zero rows stay."""
    norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)


def weights(texts: DataFrame, column: str = "text", dim: int = DIM) -> DataFrame:
    """(d, weight): each component's inverse document frequency over all rows of ``texts``, log((1 + rows) / (1 + rows that have it)) + 1; ``column`` holds texts or their ``features``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, df = 0, np.zeros(dim, np.int64)
        for b in batches:
            rows += b.num_rows
            df += _counted(b.column(0), dim)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim + 1)), pa.array(np.append(df, rows))], names=["d", "n"])

    found = texts.select(column).mapInArrow(run, "d long, n long").groupBy("d").agg(F.sum("n").alias("n"))  # a row for each component
    # the number of rows is put beside each component by a window, since a join would read all texts once for either side
    counted = found.withColumn("rows", F.max(F.when(F.col("d") == dim, F.col("n"))).over(Window.partitionBy(F.lit(0))))
    return counted.where(F.col("d") < dim).select("d", (F.log((1 + F.col("rows")) / (1 + F.col("n"))) + 1).alias("weight"))


def vector(weighted: DataFrame, dim: int = DIM) -> np.ndarray:
    """The weights as an array: a row for each component is all there is to collect."""
    out = np.ones(dim)
    for r in weighted.collect():
        out[r["d"]] = r["weight"]
    return out


def encode(text: Column, weight: np.ndarray) -> Column:
    """array<double>: the unit vectors of texts."""
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series(list(unit(sums(s.where(s.notna(), None).tolist(), len(weight)) * weight)))

    return F.pandas_udf(run, "array<double>")(text)


def likeness(text: Column, held: dict[str, list[float]], failed: dict[str, list[float]], weight: np.ndarray, least: float) -> Column:
    """array of struct(label, hold, fail): cosines of a text, or of its ``features``, with the held and failed prototypes, where the held one is about ``least`` or more."""
    names = sorted(held)
    a, b = (np.array([of.get(n, [0.0] * len(weight)) for n in names], float).reshape(-1, len(weight)) for of in (held, failed))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for s in batches:
            rows, labels, held, failed = [], [], [], []
            for first, _, part in _summed(s, len(weight)):
                x = unit(part * weight)
                hold, fail = x @ a.T, x @ b.T
                i, k = np.nonzero(hold >= least - 0.001)
                rows.append(i + first)
                labels.append(k)
                held.append(hold[i, k])
                failed.append(fail[i, k])
            each = [np.concatenate(c) if c else np.zeros(0) for c in (rows, labels, held, failed)]
            ends = np.append(0, np.cumsum(np.bincount(each[0].astype(np.int64), minlength=len(s))))
            told = [pa.array(names, pa.string()).take(pa.array(each[1].astype(np.int64))), pa.array(each[2], pa.float64()), pa.array(each[3], pa.float64())]
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(told, ["label", "hold", "fail"]))

    return F.arrow_udf(run, "array<struct<label:string,hold:double,fail:double>>")(text)
