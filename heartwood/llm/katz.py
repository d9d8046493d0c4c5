"""Katz backoff language model: Good-Turing discounts and exactly normalised backoff weights, as partitioned tables.

The model is over words and one end token for each document; a document
follows start marks. With h a history of n - 1 words, h' the same without its
first, r the training count of (h, w) and c(h) that of h as a context,

    P(w | h) = d(r) r / c(h)         if r > 0
             = a(h) P(w | h')        otherwise, or P(w | h') if h was never seen
    a(h)     = (1 - sum over seen w of d(r) r / c(h)) / (1 - sum over seen w of P(w | h'))

down to P(w) = d(c) c / N for a known word, the mass left over being that of
the one unknown word, so each distribution sums to one. d(r) is the
Good-Turing discount for r <= 5 (from counts of counts over the whole
corpus, order by order). Where these are too few to give a discount between 0
and 1, and for larger r, a fixed part of a count (``SPARE``) is taken, so that
every context leaves some mass to back off to.

``order`` is the longest history plus one. It is 2 unless given: order 3
writes about twice the bytes, as nearly every run of three words is a new one
(figures in the README), and gives the same columns.

How it runs. Documents are encoded once into blocks: word hashes in sorted
order and each token's place among them. A block asks for the counts of its
distinct n-grams of each order with one compressed list for each partition of
the model; a partition merges the lists of all blocks, which yields its part
of the count tables, and answers each list in its own order, so answers need
no keys. One block of those that hold an n-gram owns it, and adds it to its
context's sums; the sums of a context meet in its partition, which answers
with the backoff weights. Every step is a stored table; the numbers of
partitions and of tasks grow with the corpus, so that a task's input does not.
There are never more lists than distinct n-grams of blocks.

A word that occurs everywhere has an entry from each block. From ``SALT``
blocks on, lists are first merged by groups of blocks, and the groups' sums
then, so the entries of one word that meet are bounded by SALT and by the
number of groups.

n-grams are known by 64-bit hashes, counts are 64-bit integers. Defined
results: null and empty texts are one end token; with nothing to learn from,
every token is unknown, with probability one half under the base and one
under the model; a null doc_id is not held out; ids keep their type; repeated
rows count repeatedly; an empty table gives no rows; other columns are not
read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from heartwood.llm.common import release, small_batches, store

FOLDS, HELD = 5, 1
K, SPARE = 5, 0.1
#: Tokens in a block at least (unless its input ends), and keys in a partition of the model, about.
BLOCK, PART = 1_000_000, 1_500_000
ORDER, SALT = 2, 1 << 16
START = np.uint64(0x5354415254000001)


def _pack(x: np.ndarray) -> bytes:
    """Compress integers: bytes of like significance together."""
    if not len(x):
        return b""
    return zlib.compress(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes(), 1)


def _unpack(b: bytes, kind: str) -> np.ndarray:
    if not b:
        return np.empty(0, kind)
    size = np.dtype(kind).itemsize
    flat = np.frombuffer(zlib.decompress(b), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(flat.T).view(kind).ravel()


def _pack_sorted(x: np.ndarray) -> bytes:
    """Compress sorted 64-bit keys by their differences."""
    return _pack(np.diff(x, prepend=np.uint64(0)))


def _unpack_sorted(b: bytes) -> np.ndarray:
    return np.cumsum(_unpack(b, "<u8"), dtype=np.uint64)


def pair_keys(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = v * np.uint64(0x9E3779B97F4A7C15) + (w ^ (w >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def blocks(docs: DataFrame, folds: int, held: int) -> DataFrame:
    """Encoded documents: (bid, doc_ids, held, lengths, words, tokens, n); words are sorted hashes, tokens places among them."""
    small_batches(docs.sparkSession)
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == held, F.lit(False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, serial = TaskContext.get().partitionId(), 0
        names: dict[bytes, int] = {}
        ids: list = []
        outs: list[bool] = []
        sizes: list[int] = []
        tokens: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            nonlocal serial
            hashes = np.fromiter((xxhash.xxh64_intdigest(w, 42) for w in names), np.uint64, len(names))
            words, place = np.unique(hashes, return_inverse=True)
            kind = "<u2" if len(words) <= 1 << 16 else "<u4"
            body = place[np.concatenate(tokens)].astype(kind)
            row = {
                "bid": [(part << 24) + serial], "doc_ids": pa.array([list(ids)], pa.list_(kind_of_id)), "held": [list(outs)], "lengths": [list(sizes)], "words": [_pack_sorted(words)],
                "tokens": [_pack(body)], "kind": [kind], "end": [int(place[names[b""]])], "n": [len(body)], "types": [len(words)],
            }
            serial += 1
            for x in (names, ids, outs, sizes, tokens):
                x.clear()
            return pa.RecordBatch.from_pydict(row, schema=schema)

        held_tokens = 0
        for b in batches:
            for doc, h, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                parts = (text.as_py() or "").encode().lower().split()
                parts.append(b"")  # the end token; no word is empty
                add = names.setdefault
                tokens.append(np.array([add(w, len(names)) for w in parts], np.int32))
                ids.append(doc)
                outs.append(h)
                sizes.append(len(parts))
                held_tokens += len(parts)
                if held_tokens >= BLOCK:
                    yield flush()
                    held_tokens = 0
        if ids:
            yield flush()

    kind_of_id = to_arrow_type(docs.schema["doc_id"].dataType)
    schema = pa.schema([("bid", pa.int64()), ("doc_ids", pa.list_(kind_of_id)), ("held", pa.list_(pa.bool_())), ("lengths", pa.list_(pa.int64())), ("words", pa.binary()), ("tokens", pa.binary()), ("kind", pa.string()), ("end", pa.int64()), ("n", pa.int64()), ("types", pa.int64())])
    ddl = f"bid long, doc_ids array<{docs.schema['doc_id'].dataType.simpleString()}>, held array<boolean>, lengths array<long>, words binary, tokens binary, kind string, end long, n long, types long"
    return docs.select("doc_id", out.alias("held"), "text").mapInArrow(run, ddl)


class Block:
    """A decoded block. For each order from 1, ``keys`` are the sorted distinct n-grams, ``at`` a token that ends each, ``of`` each token's place among them."""

    def __init__(self, row: dict, order: int):
        self.words = _unpack_sorted(row["words"])
        tokens = _unpack(row["tokens"], row["kind"]).astype(np.int64)
        self.lengths, self.end = np.array(row["lengths"], np.int64), row["end"]
        self.doc = np.repeat(np.arange(len(self.lengths)), self.lengths)
        self.learns = ~np.array(row["held"], bool)[self.doc]
        self.first = np.zeros(len(tokens), bool)
        self.first[np.concatenate(([0], np.cumsum(self.lengths)[:-1]))] = True
        self.keys, self.at, self.of = [self.words], [np.empty(0, np.int64)], [tokens]
        for n in range(2, order + 1):
            grams = pair_keys(self.history(n), self.words[tokens])
            keys, at, of = np.unique(grams, return_index=True, return_inverse=True)
            self.keys.append(keys)
            self.at.append(at)
            self.of.append(of)

    def history(self, n: int) -> np.ndarray:
        """The key of each token's context of order n: the (n - 1)-gram before it, or a start mark of that order."""
        before = np.concatenate(([np.uint64(0)], self.keys[n - 2][self.of[n - 2]][:-1]))
        return np.where(self.first, START + np.uint64(n), before)


def _edges(keys: np.ndarray, parts: int) -> np.ndarray:
    """Where each partition begins among sorted keys: a partition is a range of keys."""
    bounds = np.array([(p << 64) // parts for p in range(1, parts)], np.uint64)
    return np.concatenate(([0], np.searchsorted(keys, bounds), [len(keys)]))


def _cut(keys: np.ndarray, parts: int) -> Iterator[tuple[int, int, int]]:
    """(partition, from, to) of the sorted keys, for the partitions that have any."""
    edges = _edges(keys, parts)
    return ((p, s, e) for p, (s, e) in enumerate(zip(edges, edges[1:], strict=False)) if e > s)


REQUEST = "kind int, part int, bid long, keys binary, counts binary"


def _requests(stored: DataFrame, parts: int, order: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                x = Block(row, order)
                for n in range(order):
                    counts = np.bincount(x.of[n][x.learns], minlength=len(x.keys[n])).astype("<u8")
                    rows = [(n + 1, p, row["bid"], _pack_sorted(x.keys[n][s:e]), _pack(counts[s:e])) for p, s, e in _cut(x.keys[n], parts)]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["kind", "part", "bid", "keys", "counts"])

    return stored.mapInArrow(run, REQUEST)


def _merge(lists: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sorted distinct keys of all lists, each entry's place among them, and the lists' ends."""
    keys = [_unpack_sorted(b) for b in lists]
    ends = np.cumsum([len(k) for k in keys])
    distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
    return distinct, place, ends


def _sums(pdf: pd.DataFrame, place: np.ndarray, n: int, columns: tuple[str, ...], kind: str) -> list[np.ndarray]:
    """The entries of each column summed by place; integers stay integers."""
    out = []
    for c in columns:
        total = np.zeros(n, kind)
        np.add.at(total, place, np.concatenate([_unpack(b, kind) for b in pdf[c]]))
        out.append(total)
    return out


def _split(x: np.ndarray, ends: np.ndarray) -> list[bytes]:
    return [_pack(c) for c in np.split(x, ends[:-1])]


def _count(pdf: pd.DataFrame) -> pd.DataFrame:
    """Total counts of a partition of the model: the answer to each list, and counts of counts (bid -1)."""
    pdf = pdf.sort_values("bid")
    distinct, place, ends = _merge(list(pdf["keys"]))
    (total,) = _sums(pdf, place, len(distinct), ("counts",), "<u8")
    # an n-gram's owner is the first block that asks for it
    owns = np.zeros(len(place), np.uint8)
    owns[np.unique(place, return_index=True)[1]] = 1
    seen = total[total > 0]
    stats = [int((seen == r).sum()) for r in range(1, K + 2)] + [len(seen), int(seen.sum())]
    out = pd.DataFrame({"bid": pdf["bid"].to_numpy(), "counts": _split(total[place], ends), "owns": _split(owns, ends), "stats": [None] * len(pdf)})
    out.loc[len(out)] = [-1, b"", b"", stats]
    return out.assign(kind=int(pdf["kind"].iloc[0]), part=int(pdf["part"].iloc[0]))[["kind", "part", "bid", "counts", "owns", "stats"]]


COUNTED = "kind int, part int, bid long, counts binary, owns binary, stats array<long>"


def _folded(columns: tuple[str, ...], kind: str):
    """The lists of one group of blocks as one: distinct keys and the columns' sums."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        distinct, place, _ = _merge(list(pdf["keys"]))
        sums = _sums(pdf, place, len(distinct), columns, kind)
        return pd.DataFrame([(int(pdf["kind"].iloc[0]), int(pdf["part"].iloc[0]), int(pdf["salt"].iloc[0]), _pack_sorted(distinct), *map(_pack, sums))], columns=["kind", "part", "bid", "keys", *columns])

    return run


def _replied(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """The answers to a group's lists, from the answer to the group."""
    left = left.sort_values("bid")
    _, place, ends = _merge(list(left["keys"]))
    total, mine = _unpack(right["counts"].iloc[0], "<u8"), _unpack(right["owns"].iloc[0], "u1")
    owns = np.zeros(len(place), np.uint8)
    owns[np.unique(place, return_index=True)[1]] = 1
    out = pd.DataFrame({"bid": left["bid"].to_numpy(), "counts": _split(total[place], ends), "owns": _split(owns * mine[place], ends), "stats": [None] * len(left)})
    return out.assign(kind=int(left["kind"].iloc[0]), part=int(left["part"].iloc[0]))[["kind", "part", "bid", "counts", "owns", "stats"]]


def _salted(lists: DataFrame, salts: int) -> DataFrame:
    return lists.withColumn("salt", F.pmod(F.xxhash64("bid"), F.lit(salts)))


def _counted(stored: DataFrame, parts: int, order: int, tasks: int, salts: int) -> DataFrame:
    """Each list's answer, and counts of counts."""
    lists, dealt = _requests(stored, parts, order), ("kind", "part")
    if salts == 1:
        return lists.repartition(tasks, *dealt).groupBy(*dealt).applyInPandas(_count, COUNTED)
    lists, whole = _salted(store(lists, "ngram-lists"), salts), (*dealt, "salt")
    groups = lists.repartition(tasks, *whole).groupBy(*whole).applyInPandas(_folded(("counts",), "<u8"), REQUEST)
    totals = store(groups.repartition(tasks, *dealt).groupBy(*dealt).applyInPandas(_count, COUNTED), "ngram-totals")
    by_group = totals.where("bid >= 0").withColumnRenamed("bid", "salt")
    replies = lists.repartition(tasks, *whole).groupBy(*whole).cogroup(by_group.repartition(tasks, *whole).groupBy(*whole)).applyInPandas(_replied, COUNTED)
    return replies.unionByName(totals.where("bid < 0"))


def discounts(n: list[int]) -> np.ndarray:
    """d(0..K) from counts of counts n[0] (of 1) to n[K] (of K + 1); d(0) is unused."""
    d = np.ones(K + 1)
    cut = (K + 1) * n[K] / n[0] if n[0] else 1.0
    for r in range(1, K + 1):
        good = (r + 1) * n[r] / (r * n[r - 1]) if n[r - 1] else 0.0
        x = (good - cut) / (1 - cut) if cut < 1 else 0.0
        d[r] = x if 0 < x < 1 else (r - SPARE) / r
    return d


def mass(r: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Discounted counts d(r) r; 0 where r is 0."""
    return np.where(r > K, r - SPARE, d[np.minimum(r, K)] * r)


def _partial(parts: int, stats: list[list[int]]):
    """Scores but for the backoff weights, and sums by context, of a block and the answers to it; ``stats`` are each order's counts of counts."""
    order = len(stats)
    d = [discounts(x[: K + 1]) for x in stats]
    types, total = stats[0][K + 1], stats[0][K + 2]
    # N and the mass of the unknown word: what the discounts leave
    r = np.arange(1, K + 1)
    small = np.array(stats[0][:K])
    kept = float((small * d[0][1:] * r).sum() + (total - (small * r).sum()) - SPARE * (types - small.sum()))
    unknown = 1.0 if not total else (total - kept) / total
    log = lambda p: np.log10(np.maximum(p, 1e-300))

    def run(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        row = left.iloc[0].to_dict()
        x = Block(row, order)
        right = right.sort_values(["kind", "part"])
        of = lambda kind, name, t: np.concatenate([_unpack(b, t) for b in right.loc[right["kind"] == kind, name]])
        counts = [of(n + 1, "counts", "<u8").astype(np.int64) for n in range(order)]
        docs = len(x.lengths)
        sums = lambda v: np.bincount(x.doc, weights=v, minlength=docs)
        c, tokens = counts[0], x.of[0]
        base = log((c + 0.5) / (total + 0.5 * (types + 1)))
        chance = np.where(c > 0, mass(c, d[0]) / max(total, 1), unknown)  # P of the order below, of each of its n-grams
        trained = int(c[x.end])  # the start mark is followed as often as a document ends
        levels = []
        for n in range(1, order):
            at = x.at[n]
            lower, begins = x.of[n - 1][at], x.first[at]
            before = np.where(begins, 0, x.of[n - 1][np.maximum(at - 1, 0)])
            context = np.where(begins, trained, counts[n - 1][before])
            seen = counts[n] > 0
            share = mass(counts[n], d[n]) / np.maximum(context, 1)
            below = chance[lower]
            own = of(n + 1, "owns", "u1").astype(bool) & seen
            levels.append((seen, share, below, own, ~seen & (context > 0), x.history(n + 1)))
            chance = np.where(seen, share, np.nan)  # only seen n-grams are asked for one order up
        # from the highest order down: a token is scored where its n-gram was seen first, and pays each weight on the way
        score, open_ = np.zeros(len(tokens)), np.ones(len(tokens), bool)
        rows, asked, paid = [], 0, []
        for n in reversed(range(1, order)):
            seen, share, below, own, backs, history = levels[n - 1]
            hit = open_ & seen[x.of[n]]
            score[hit] = log(share)[x.of[n][hit]]
            pays = np.flatnonzero(open_ & backs[x.of[n]])
            open_ &= ~hit
            mine = history[x.at[n]]  # the context of each n-gram
            keys, place = np.unique(np.concatenate((mine[own], history[pays])), return_inverse=True)
            used, low = (np.bincount(place[: own.sum()], weights=w[own], minlength=len(keys)) for w in (share, below))
            needed = np.zeros(len(keys), np.uint8)
            needed[place[own.sum():]] = 1
            rows += [("context", n + 1, p, row["bid"], _pack_sorted(keys[s:e]), _pack(used[s:e]), _pack(low[s:e]), _pack(needed[s:e]), None, None, None, None, None, None) for p, s, e in _cut(keys, parts)]
            paid.append((x.doc[pays], place[own.sum():], len(keys)))
        score[open_] = log(np.where(c > 0, mass(c, d[0]) / max(total, 1), unknown))[tokens[open_]]
        # which documents pay which weights, as places among those asked for: the lists in order of kind, then part
        doc, ctx = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for who, place, size in reversed(paid):
            doc.append(who)
            ctx.append(place + asked)
            asked += size
        pairs, times = np.unique(np.concatenate(doc) * max(asked, 1) + np.concatenate(ctx), return_counts=True)
        rows.append(("score", 0, 0, row["bid"], _pack((pairs // max(asked, 1)).astype("<u4")), _pack((pairs % max(asked, 1)).astype("<u4")), _pack(times.astype("<u4")), b"",
                     list(row["doc_ids"]), list(row["held"]), list(row["lengths"]), sums(c[tokens] > 0).astype(np.int64).tolist(), sums(base[tokens]).tolist(), sums(score).tolist()))
        return pd.DataFrame(rows, columns=COLUMNS)

    return run


COLUMNS = ["what", "kind", "part", "bid", "keys", "used", "low", "needed", "doc_ids", "held", "lengths", "known", "base", "score"]
ANSWER = "kind int, part int, bid long, weights binary, needed binary"


def _weights(pdf: pd.DataFrame) -> pd.DataFrame:
    """log10 of the backoff weights of a partition's contexts, in the order of each list's needed ones."""
    pdf = pdf.sort_values("bid")
    distinct, place, ends = _merge(list(pdf["keys"]))
    used, low = _sums(pdf, place, len(distinct), ("used", "low"), "<f8")
    weight = np.log10(np.maximum(1 - used, 1e-300) / np.maximum(1 - low, 1e-300))[place]
    needed = [np.ones(e - s, bool) for s, e in zip([0, *ends[:-1]], ends, strict=True)] if pdf["needed"].isna().all() else [_unpack(b, "u1").astype(bool) for b in pdf["needed"]]
    cut = [_pack(w[m]) for w, m in zip(np.split(weight, ends[:-1]), needed, strict=True)]
    return pd.DataFrame({"kind": int(pdf["kind"].iloc[0]), "part": int(pdf["part"].iloc[0]), "bid": pdf["bid"].to_numpy(), "weights": cut, "needed": list(pdf["needed"])})


def _weighed(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """The answers to a group's lists of contexts, from the answer to the group."""
    left = left.sort_values("bid")
    _, place, ends = _merge(list(left["keys"]))
    weight = np.split(_unpack(right["weights"].iloc[0], "<f8")[place], ends[:-1])
    cut = [_pack(w[_unpack(b, "u1").astype(bool)]) for w, b in zip(weight, left["needed"], strict=True)]
    return pd.DataFrame({"kind": int(left["kind"].iloc[0]), "part": int(left["part"].iloc[0]), "bid": left["bid"].to_numpy(), "weights": cut, "needed": list(left["needed"])})


def _answered(contexts: DataFrame, tasks: int, salts: int) -> DataFrame:
    """The backoff weights that each list of contexts needs."""
    dealt = ("kind", "part")
    if salts == 1:
        return contexts.repartition(tasks, *dealt).groupBy(*dealt).applyInPandas(_weights, ANSWER)
    lists, whole = _salted(contexts, salts), (*dealt, "salt")
    groups = lists.repartition(tasks, *whole).groupBy(*whole).applyInPandas(_folded(("used", "low"), "<f8"), "kind int, part int, bid long, keys binary, used binary, low binary")
    totals = groups.withColumn("needed", F.lit(None).cast("binary")).repartition(tasks, *dealt).groupBy(*dealt).applyInPandas(_weights, ANSWER)
    by_group = store(totals, "weight-totals").withColumnRenamed("bid", "salt")
    return lists.repartition(tasks, *whole).groupBy(*whole).cogroup(by_group.repartition(tasks, *whole).groupBy(*whole)).applyInPandas(_weighed, ANSWER)


def _finish(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    row = left.iloc[0]
    right = right.sort_values(["kind", "part"])
    needed = np.concatenate([_unpack(b, "u1") for b in right["needed"]] or [np.empty(0, "u1")]).astype(bool)
    weight = np.zeros(len(needed))
    weight[needed] = np.concatenate([_unpack(b, "<f8") for b in right["weights"]] or [np.empty(0)])
    doc, ctx, times = (_unpack(row[c], "<u4") for c in ("keys", "used", "low"))
    score = np.array(row["score"]) + (np.bincount(doc, weights=weight[ctx] * times, minlength=len(row["score"])) if len(doc) else 0.0)
    return pd.DataFrame({"doc_id": pd.Series(list(row["doc_ids"]), dtype=object), "held_out": row["held"], "n_tokens": row["lengths"], "n_known": row["known"], "base_score": row["base"], "score": score})


def score(docs: DataFrame, folds: int = FOLDS, held: int = HELD, order: int = ORDER) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    stored = store(blocks(docs, folds, held), "token-blocks")
    tokens, n = stored.agg(F.sum("n"), F.count(F.lit(1))).first()
    parts = max(1, -(-(tokens or 0) // PART))
    # so many blocks, or parts of the model, are a task's work, however many there are
    by_part, by_block, salts = max(1, parts * order // 4), max(1, n // 3), -(-max(1, n) // SALT)
    counted = store(_counted(stored, parts, order, by_part, salts), "ngram-counts")
    sums = {r["kind"]: list(r)[1:] for r in counted.where("bid = -1").groupBy("kind").agg(*(F.sum(F.col("stats")[i]).alias(f"s{i}") for i in range(K + 3))).collect()}
    stats = [[int(x or 0) for x in sums.get(k + 1, [0] * (K + 3))] for k in range(order)]
    answers = counted.where("bid >= 0").select("bid", "kind", "part", "counts", "owns")
    both = stored.repartition(by_block, "bid").groupBy("bid").cogroup(answers.repartition(by_block, "bid").groupBy("bid"))
    partial = f"what string, kind int, part int, bid long, keys binary, used binary, low binary, needed binary, doc_ids array<{kind}>, held array<boolean>, lengths array<long>, known array<long>, base array<double>, score array<double>"
    partial = store(both.applyInPandas(_partial(parts, stats), partial), "partial-scores")
    release(stored)
    release(counted)
    weights = _answered(partial.where("what = 'context'").select("kind", "part", "bid", "keys", "used", "low", "needed"), by_part, salts)
    scores = partial.where("what = 'score'").select("bid", "keys", "used", "low", "doc_ids", "held", "lengths", "known", "base", "score")
    final = scores.repartition(by_block, "bid").groupBy("bid").cogroup(weights.repartition(by_block, "bid").groupBy("bid"))
    final = final.applyInPandas(_finish, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return final.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(stats[0][K + 2]).cast("long").alias("train_tokens"), "base_score", "score")
