"""Exact top-k search by Fagin's threshold algorithm over sorted per-dimension lists.

Vectors become integers floor(256 x). Candidates are dealt into blocks; a
block's lists, one for each dimension with its candidates sorted by value, are
built once, and the queries, which are few, are sent to the blocks. A query
reads every list from the end that its sign prefers, scores what it meets for
the first time, and stops once the best score that an unseen candidate could
have cannot beat its k-th best. It first searches one block; the k-th score
found there is the floor with which it starts in all others. A bound equal to
the k-th score does not stop it, since a tie may have the smaller id.

How early it stops depends on the vectors: where few components make most of
a score it reads the heads of the lists only; where a score is spread evenly
over many dimensions, as with random directions, every candidate leads some
list before the bound falls, and all are scored (``search`` reports how many).

Defined results: vectors that are null or hold null or non-finite components
take no part; vectors of different lengths never meet; a query's own row is
no candidate, but a repeated row with its id is; null ids are candidates,
last among ties, and never queries; other columns are not read. Scores are
exact while they fit a long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heartwood.llm.common import store
from heartwood.llm.embeddings import usable

K, EVERY, SCALE = 5, 50, 256
#: Candidates in a block.
CANDIDATE_BLOCK = 8192
#: Entries that are read of each list before the bound is first tested, and the growth from test to test.
STEP, FACTOR = 2, 2


class Lists:
    """The candidates of a block: their values, and each dimension's order of them."""

    def __init__(self, data: np.ndarray, rows: np.ndarray, ids: np.ndarray):
        self.data, self.rows, self.ids = data, rows, ids
        order = np.argsort(data, axis=0, kind="stable")
        self.order, self.values = order.T.copy(), np.take_along_axis(data, order, 0).T.copy()

    def search(self, q: np.ndarray, own: int, k: int = K, floor: int | None = None) -> tuple[np.ndarray, np.ndarray, int]:
        """Places and scores of the k best candidates but row ``own``, by score, then id, and how many were scored.

        With ``floor``, a score that k candidates elsewhere reach, candidates below it may be left out.
        """
        n = len(self.data)
        up, down = np.flatnonzero(q > 0), np.flatnonzero(q < 0)
        seen = self.rows == own
        best, score = np.empty(0, np.int64), np.empty(0, self.data.dtype)
        depth, step, count = 0, STEP, 0
        while depth < n:
            reach = min(n, depth + step)
            if not len(up) + len(down):  # a zero query scores all alike
                reach = n
                met = np.ones(n, bool)
            else:
                met = np.zeros(n, bool)
                met[self.order[up, n - reach:n - depth]] = True
                met[self.order[down, depth:reach]] = True
            fresh = np.flatnonzero(met & ~seen)
            seen[fresh] = True
            count += len(fresh)
            best, score = np.concatenate((best, fresh)), np.concatenate((score, self.data[fresh] @ q))
            if len(best) > k:
                keep = score >= np.partition(score, len(score) - k)[len(score) - k]
                best, score = best[keep], score[keep]
                top = np.lexsort((self.ids[best], -score))[:k]
                best, score = best[top], score[top]
            bound = q[up] @ self.values[up, n - reach] + q[down] @ self.values[down, reach - 1]
            if len(best) == k and bound < score.min() or floor is not None and bound < floor:
                break
            depth, step = reach, step * FACTOR
        top = np.lexsort((self.ids[best], -score))[:k]
        best, score = best[top], score[top]
        if floor is not None:
            best, score = best[score >= floor], score[score >= floor]
        return best, score, count


def _dealt(asks: DataFrame, rows: DataFrame, n: int) -> DataFrame:
    """Candidates and the queries sent to them, block by block, the candidates first."""
    offers = rows.select(F.xxhash64("dim", _block(n)).alias("block"), F.lit(False).alias("ask"), "rid", "vec_id", "v", F.lit(None).cast("long").alias("floor"))
    both = offers.unionByName(asks.select(F.xxhash64("dim", "cb").alias("block"), F.lit(True).alias("ask"), "rid", "vec_id", "v", "floor"))
    return both.repartition("block").sortWithinPartitions("block", "ask")


def _block(n: int) -> F.Column:
    return F.pmod(F.xxhash64("rid", F.lit(2)), F.lit(n)).cast("int")


def _searched(dealt: DataFrame, k: int) -> DataFrame:
    """(q, query_id, vec_id, rid, score): each query's best candidates of each block that it was sent to."""
    def whole(column: pa.Array) -> np.ndarray:
        return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, lists = None, [], None  # of the block at hand: its candidates so far, then their lists
        for b in batches:
            marks = b.column(0).to_numpy()
            asks = b.column(1).to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((np.diff(marks) != 0) | (asks[1:] != asks[:-1])) + 1
            for s, e in zip(np.concatenate(([0], edges)), np.concatenate((edges, [len(marks)])), strict=True):
                if e == s:
                    continue
                part = b.slice(s, e - s)
                if marks[s] != block:
                    block, held, lists = marks[s], [], None
                if not asks[s]:
                    held.append(part)
                    continue
                if lists is None:
                    own = pa.Table.from_batches(held).combine_chunks() if held else None
                    data = whole(own.column("v").combine_chunks()) if held else np.empty((0, 0))
                    known = np.asarray(own.column("vec_id").is_valid()) if held else np.empty(0, bool)
                    ids = own.column("vec_id").fill_null(np.iinfo(np.int64).max).to_numpy() if held else np.empty(0, np.int64)
                    lists = Lists(data, own.column("rid").to_numpy() if held else np.empty(0, np.int64), ids)
                    exact = None
                    size = np.abs(data).max(initial=0)
                if not len(lists.data):
                    continue
                queries = whole(part.column("v"))
                floors = part.column("floor").to_pylist()
                out = []
                for i, own_row in enumerate(part.column("rid").to_pylist()):
                    q, use = queries[i], lists
                    if size * np.abs(q).max(initial=0) * max(1, len(q)) >= 2**53:  # beyond what doubles sum exactly
                        exact = exact or Lists(np.array([[int(c) for c in r] for r in data], object).reshape(data.shape), lists.rows, lists.ids)
                        q, use = np.array([int(c) for c in q], object), exact
                    best, score, _ = use.search(q, own_row, k, floors[i])
                    out += [(own_row, i, p, int(x)) for p, x in zip(best, score, strict=True)]
                if out:
                    at = np.array([[o[1], o[2]] for o in out])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([o[0] for o in out], pa.int64()), part.column("vec_id").take(pa.array(at[:, 0])), pa.array(ids[at[:, 1]], mask=~known[at[:, 1]]), pa.array(lists.rows[at[:, 1]]), pa.array([o[3] for o in out], pa.int64())],
                        names=["q", "query_id", "vec_id", "rid", "score"])

    return dealt.mapInArrow(run, "q long, query_id long, vec_id long, rid long, score long")


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows whose vec_id is divisible by ``every``."""
    whole = F.transform("embedding", lambda c: F.floor(c.cast("double") * SCALE).cast("double"))
    rows = vectors.where(usable(zero=True)).select(F.monotonically_increasing_id().alias("rid"), F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v"))
    rows = store(rows, "topk-vectors").withColumn("dim", F.size("v"))
    n = max(1, -(-rows.count() // CANDIDATE_BLOCK))
    asks = rows.where(F.coalesce(F.col("vec_id") % every == 0, F.lit(False)))
    best = Window.partitionBy("q").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "rid")
    found = _searched(_dealt(asks.withColumn("cb", _block(n)).withColumn("floor", F.lit(None).cast("long")), rows, n), k)
    if n > 1:
        found = store(found, "topk-first")
        floors = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") == k).select(F.col("q").alias("rid"), F.col("score").alias("floor"))
        others = F.filter(F.sequence(F.lit(0), F.lit(n - 1)), lambda o: o != _block(n))
        sent = asks.join(floors, "rid", "left").withColumn("cb", F.explode(others))
        found = found.unionByName(_searched(_dealt(sent, rows, n), k))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 5
"""
