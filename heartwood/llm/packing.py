"""Packing documents into sequences by a grouping genetic algorithm on islands.

Only lengths matter for packing, so a solution is a set of patterns (the
lengths in one bin) with multiplicities over the histogram of piece lengths:
its size is bounded by the sequence length, not by the corpus. The algorithm
works on whole bins. Crossover injects well-filled bins of one parent into
the other, removes the bins whose pieces are then used up, and places the
displaced pieces by best fit, longest first, or, where they are few, so that
each bin is filled by the best subset of them; mutation dissolves some of the
emptiest bins and some others. Every island is a task with its own population; after each
epoch the best solution of each island migrates to the next, until the lower
bound is reached or the epochs end.

Pieces then find their slot by their rank among the pieces of their length:
they are range-sorted and numbered, so no length, however frequent, meets in
one task.

Defined results: null text is empty, and an empty document is its end id; a
piece of full length is a sequence of its own; equal rows are
interchangeable; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import base64
import bisect
import json
import random
import re
import zlib
from collections.abc import Iterator
from operator import neg

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heartwood.llm.common import small_batches, store
from heartwood.llm.sharding import numbered

LENGTH, END, TOKENIZER = 1024, 2, "byte_bpe_50k"
SPECIAL = "<|endoftext|>"
#: Words whose ids a worker keeps at hand; beyond that it starts anew.
CACHE = 300_000
POPULATION, GENERATIONS, EPOCHS, SEED = 6, 8, 5, 11
#: Displaced pieces that are placed by subset sums; more go by best fit.
FEW = 5000
#: The tokenizer's split for texts within Latin-1, where its character classes can be listed; the plain engine runs it faster.
_L, _N, _S = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼½¾", r"\t-\r \x85\xa0"
LATIN = rf"'(?:[sdmt]|ll|ve|re)| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+"
BEYOND = re.compile("[^\x00-\xff]").search
_encoders: dict[str, "Encoder"] = {}

Solution = dict[tuple[int, ...], int]


class Encoder(dict):
    """Ids of texts as little-endian 32-bit bytes: the tokenizer's own split into words, with each word's ids kept."""

    def __init__(self, name: str = TOKENIZER, folder: str | None = None):
        import public_tokenizers as files
        import regex
        import tiktoken
        from tokenizers import Tokenizer

        path = (lambda f: f"{folder}/{f}") if folder else files.path
        with open(path(f"{name}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.any = regex.compile(files.PATTERN).findall
        self.latin = re.compile(LATIN).findall
        self.words = tiktoken.Encoding(name, pat_str=files.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.whole = lambda: Tokenizer.from_file(path(f"{name}.json"))
        self.loaded: Tokenizer | None = None

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHE:
            self.clear()
        ids = np.array(self.words.encode_ordinary(word), "<u4").tobytes()
        if len(word) <= 32:
            self[word] = ids
        return ids

    def ids(self, text: str) -> bytes:
        if SPECIAL in text:
            self.loaded = self.loaded or self.whole()
            return np.array(self.loaded.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        split = self.any if BEYOND(text) else self.latin
        return b"".join(map(self.__getitem__, split(text)))


def pieces(docs: DataFrame, length: int = LENGTH, end: int = END, tokenizer: str = TOKENIZER, folder: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): every document's ids and an end id, cut so that only the first piece may be shorter."""
    last = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer not in _encoders:
            _encoders[tokenizer] = Encoder(tokenizer, folder)
        encoder = _encoders[tokenizer]
        for b in batches:
            rows: list[tuple[int, int, int, int, int]] = []
            for i, text in enumerate(b.column(1)):
                ids = encoder.ids(text.as_py() or "") + last
                n = len(ids) // 4
                first = (n - 1) % length + 1
                cuts = [0, *range(first, n + 1, length)]
                rows += [(i, k, s, e - s, zlib.crc32(ids[4 * s:4 * e])) for k, (s, e) in enumerate(zip(cuts, cuts[1:], strict=False))]
            at, piece, start, size, crc = (np.array(c, np.int64) for c in zip(*rows, strict=True)) if rows else [np.empty(0, np.int64)] * 5
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), pa.array(piece.astype(np.int32)), *map(pa.array, (start, size, crc))], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def best_fit(counts: dict[int, int], solution: Solution, size: int) -> Solution:
    """Place ``counts`` (length -> pieces) into the bins of ``solution``, longest first, each where the least room stays."""
    rooms: dict[int, Solution] = {}
    for pattern, n in solution.items():
        rooms.setdefault(size - sum(pattern), {})[pattern] = n
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            room = min((r for r in rooms if r >= length), default=None)
            if room is None:
                room, pattern, n = size, (), -(-left // (size // length))
            else:
                pattern, n = rooms[room].popitem()
            fit = room // length  # after the first, this bin has the least room that fits
            full = min(n, left // fit)
            if full < n and pattern:
                spare = n - full - (left > full * fit)
                if spare:
                    rooms.setdefault(room, {})[pattern] = rooms.get(room, {}).get(pattern, 0) + spare
            for bins, each in ((full, fit), (1, left - full * fit) if full < n and left > full * fit else (0, 0)):
                if bins:
                    new = (*pattern, *[length] * each)
                    at = rooms.setdefault(room - each * length, {})
                    at[new] = at.get(new, 0) + bins
                    left -= bins * each
            if room in rooms and not rooms[room]:
                del rooms[room]
    out: Solution = {}
    for group in rooms.values():
        for pattern, n in group.items():
            key = tuple(sorted(pattern, reverse=True))
            out[key] = out.get(key, 0) + n
    return out


def bins(solution: Solution) -> int:
    return sum(solution.values())


def fitness(solution: Solution, size: int) -> tuple[int, float]:
    """Fewer bins first, then uneven filling: full bins beside empty ones leave room to merge."""
    return bins(solution), -sum(n * (sum(p) / size) ** 2 for p, n in solution.items())


def _needs(pattern: tuple[int, ...]) -> dict[int, int]:
    out: dict[int, int] = {}
    for x in pattern:
        out[x] = out.get(x, 0) + 1
    return out


def _keep(wanted: Iterator[tuple[tuple[int, ...], int]], left: dict[int, int], into: Solution) -> None:
    """Keep as many of the wanted bins as the pieces that are left allow."""
    for pattern, n in wanted:
        needs = _needs(pattern)
        n = min(n, *(left.get(x, 0) // k for x, k in needs.items()))
        if n > 0:
            into[pattern] = into.get(pattern, 0) + n
            for x, k in needs.items():
                left[x] -= n * k


def fill(loose: dict[int, int], size: int) -> Solution:
    """Bins for ``loose``, each the largest piece left and the subset of the others that leaves it the least room.

    Sums that subsets reach are the bits of an integer, so a bin costs one
    shift for each piece.
    """
    left, out = {x: n for x, n in loose.items() if n}, {}
    order = sorted(left, reverse=True)
    while order:
        top = order[0]
        chosen, room = [top], size - top
        left[top] -= 1
        sums, mask, steps = 1, (1 << room + 1) - 1, []
        for x in order[bisect.bisect_left(order, -room, key=neg):]:
            n = left[x]
            for _ in range(n if n < 3 else min(n, room // x)):
                steps.append((x, sums))
                sums |= sums << x & mask
            if sums >> room:
                break
        goal = sums.bit_length() - 1
        for x, before in reversed(steps):  # a sum that was reached before a piece does without it
            if not before >> goal & 1:
                chosen.append(x)
                left[x] -= 1
                goal -= x
        for x in set(chosen):
            if not left[x]:
                order.remove(x)
        key = tuple(sorted(chosen, reverse=True))
        out[key] = out.get(key, 0) + 1
    return out


def place(loose: dict[int, int], kept: Solution, size: int) -> Solution:
    """The displaced pieces beside the bins that are kept: a few fill bins of their own, many go by best fit."""
    if sum(loose.values()) > FEW:
        return best_fit(loose, kept, size)
    out = dict(kept)
    for p, n in fill(loose, size).items():
        out[p] = out.get(p, 0) + n
    return out


def crossover(a: Solution, b: Solution, counts: dict[int, int], size: int, rng: random.Random) -> Solution:
    """Whole well-filled bins of b, then the bins of a that their removal leaves whole, then the displaced."""
    by_fill = lambda s: sorted(s.items(), key=lambda x: (-sum(x[0]), rng.random()))
    injected = [(p, rng.randint(1, n)) for p, n in by_fill(b)[: max(1, len(b) // 2)] if rng.random() < 0.5]
    left, child = dict(counts), {}
    _keep(iter(injected), left, child)
    _keep(iter(by_fill(a)), left, child)
    return place({x: n for x, n in left.items() if n}, child, size)


def mutate(a: Solution, size: int, rng: random.Random) -> Solution:
    """Dissolve some of the emptiest bins and some others, and place their pieces anew."""
    order = sorted(a, key=lambda p: (sum(p), rng.random()))
    gone = [*order[: rng.randint(1, 64)], *rng.sample(order, min(len(order), rng.randint(4, 300)))]
    loose: dict[int, int] = {}
    kept = dict(a)
    for p in gone:
        n = min(kept.get(p, 0), rng.randint(1, 8))
        if n:
            kept[p] -= n
            if not kept[p]:
                del kept[p]
            for x in p:
                loose[x] = loose.get(x, 0) + n
    return place(loose, kept, size)


def evolve(population: list[Solution], counts: dict[int, int], size: int, generations: int, rng: random.Random) -> list[Solution]:
    """Some generations on one island; the best solutions stay. Ends early at the lower bound."""
    bound = -(-sum(x * n for x, n in counts.items()) // size)
    rank = lambda s: fitness(s, size)
    population = sorted(population, key=rank)
    most = len(population)
    for _ in range(generations):
        if bins(population[0]) <= bound:
            break
        for _ in range(max(1, most // 2)):
            a, b = rng.sample(population, 2) if len(population) > 1 else population * 2
            population.append(crossover(a, b, counts, size, rng))
            population.append(mutate(rng.choice(population), size, rng))
        population = sorted(population, key=rank)[:most]
    return population


def _seeded(counts: dict[int, int], size: int, rng: random.Random) -> Solution:
    """A start: some random pieces are placed first, the rest by best fit, longest first."""
    first = {x: rng.randint(0, n) for x, n in counts.items() if rng.random() < 0.1}
    rest = {x: n - first.get(x, 0) for x, n in counts.items() if n > first.get(x, 0)}
    return best_fit(rest, best_fit({x: n for x, n in first.items() if n}, {}, size), size)


def _dump(population: list[Solution]) -> bytes:
    return zlib.compress(json.dumps([[[n, *p] for p, n in s.items()] for s in population]).encode())


def _load(blob: bytes) -> list[Solution]:
    return [{tuple(row[1:]): row[0] for row in s} for s in json.loads(zlib.decompress(blob))]


def solve(spark, counts: dict[int, int], size: int = LENGTH, islands: int | None = None, population: int = POPULATION, generations: int = GENERATIONS, epochs: int = EPOCHS, seed: int = SEED) -> Solution:
    """The best solution that ``islands`` (the cluster's parallelism, unless given) find for a histogram of lengths."""
    if not counts:
        return {}
    islands = islands or max(2, spark.sparkContext.defaultParallelism)
    bound = -(-sum(x * n for x, n in counts.items()) // size)

    def step(epoch: int):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                for island, own, guest in b.itertuples(index=False):
                    rng = random.Random(f"{seed}:{island}:{epoch}")
                    people = _load(own) if own else [best_fit(counts, {}, size), *(_seeded(counts, size, rng) for _ in range(population - 1))]
                    if guest:
                        people = [*people[:-1], *_load(guest)]
                    people = evolve(people, counts, size, generations, rng)
                    yield pd.DataFrame({"island": [island], "bins": [bins(people[0])], "own": [_dump(people)], "elite": [_dump(people[:1])]})

        return run

    state = spark.createDataFrame([(i, None, None) for i in range(islands)], "island long, own binary, guest binary")
    for epoch in range(epochs):
        state = state.repartitionByRange(islands, "island")
        done = store(state.mapInPandas(step(epoch), "island long, bins long, own binary, elite binary"), "islands")
        if done.agg(F.min("bins")).first()[0] <= bound:
            break
        guests = done.select(((F.col("island") + 1) % islands).alias("island"), F.col("elite").alias("guest"))
        state = done.select("island", "own").join(guests, "island").select("island", "own", "guest")
    return _load(done.orderBy("bins", "island").select("elite").first()["elite"])[0]


def slots(solution: Solution, full: int, size: int) -> pd.DataFrame:
    """(length, start, base, offset): the pieces of a length with ranks from start on go to sequences base, base + 1, ... at offset."""
    rows, used, base = [], {}, 0
    for pattern, n in sorted(solution.items()):
        offset = 0
        for x in pattern:
            rows.append((x, used.get(x, 0), base, offset))
            used[x] = used.get(x, 0) + n
            offset += x
        base += n
    if full:
        rows.append((size, 0, base, 0))
    return pd.DataFrame(rows, columns=["length", "start", "base", "offset"], dtype=np.int64).sort_values(["length", "start"], ignore_index=True)


def pack(docs: DataFrame, size: int = LENGTH, **tuning: int) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of every document."""
    spark = docs.sparkSession
    cut = store(pieces(docs, size), "pieces")
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # one row for each length, ``size`` at most
    full = counts.get(size, 0)
    table = slots(solve(spark, {x: n for x, n in counts.items() if x < size}, size, **tuning), full, size)
    before = np.zeros(size + 2, np.int64)
    for x, n in counts.items():
        before[x + 1] = n
    before = np.cumsum(before)
    lengths, starts, bases, offsets = (table[c].to_numpy() for c in ("length", "start", "base", "offset"))
    key = lengths * (1 << 50) + starts
    rows, _ = numbered(cut, ["length", "doc_id", "piece", "ids_crc32"], "row", "piece-rows")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, row = b.column("length").to_numpy(), b.column("row").to_numpy()
            rank = row - before[x]
            at = np.searchsorted(key, x * (1 << 50) + rank, "right") - 1
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(bases[at] + rank - starts[at]), pa.array(offsets[at])], names=[*b.schema.names[:5], "sequence_id", "offset"])

    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in names)
    return rows.select(*names, "row").mapInArrow(place, f"{kinds}, sequence_id long, offset long")
