"""How the tokens of two tokenizers lie over each other: an event sweep over their ends.

Every token of A and of B is an event at the byte where it ends. Events travel
as ids, some thousand consecutive ones of a side to a row with the byte where
they start; an id's length is known, so the ends follow. The rows of both
sides are one table, dealt by document and sorted by document and offset, and
a machine streams through them. It holds the tokens since the last byte where
both sides end, and no more. Where both end, a group closes; between two
consecutive ends of any side one A token lies over one B token, which is a
link. So a document has as many groups as common ends, and as many links as
distinct ends, and never all pairs of a group.

Links leave the machine as compressed pair codes. Their counts over the corpus
are summed in each task before they are grouped; a B id's best count is a
table of the size of its vocabulary. The counts then meet the documents: as a
table that every task holds while there are at most ``HELD`` distinct pairs,
and by a join of (document, pair) beyond that; both give the same.

Both tokenizers' pieces between safe cuts (``vocabulary``) are encoded once
and kept at hand.

Defined results: texts that are null or empty, or whose tokens of either side
do not join to a space and the text, have no tokens, groups or links and ''
for their digest; repeated rows are counted each; a null doc_id stays; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heartwood.llm.common import small_batches, store
from heartwood.llm.packing import CACHE
from heartwood.llm.vocabulary import Pieces, load, path, spaced

A, B = "byte_bpe_50k", "piece_bpe_32k.model"
#: Tokens of an event row; tokens that a machine handles at once; distinct pairs whose counts every task holds.
EVENTS, TILE, HELD = 4096, 1 << 18, 4_000_000
_encoders: dict[tuple, "Encoder"] = {}


class Encoder(dict):
    """Ids of both sides for pieces of texts, as little-endian 32-bit bytes; None where a side does not give the piece back."""

    def __init__(self, a: str, b: str, folder: str | None):
        import base64

        import public_tokenizers
        import tiktoken

        with open(path(f"{a}.tiktoken", folder), "rb") as f:
            ranks = {base64.b64decode(x): int(y) for x, y in map(bytes.split, f)}
        self.a = tiktoken.Encoding(a, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b: Pieces = load(b, folder)
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.a_bytes[i] = token
        self.a_length = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_length = np.array([len(x) for x in self.b.bytes], np.int64)
        self.a_names = [f"{i}".encode() for i in range(len(self.a_bytes))]
        self.b_names = [f"{i}".encode() for i in range(len(self.b.bytes))]
        #: each id followed by a comma or by what ends its side of a group
        self.names = np.array([x + e for ids, ends in ((self.a_names, (b",", b"|")), (self.b_names, (b",", b";"))) for e in ends for x in ids], object)

    def pair(self, piece: str, b: list[int]) -> tuple[bytes, bytes] | None:
        a = self.a.encode_ordinary(piece)
        whole = piece.encode()
        if b"".join([self.a_bytes[i] for i in a]) != whole or b"".join([self.b.bytes[i] for i in b]) != whole:
            return None
        return np.array(a, "<u4").tobytes(), np.array(b, "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[tuple[bytes, bytes] | None]:
        """The ids of a space and each text, by both sides."""
        if len(self) > CACHE:
            self.clear()
        split = [spaced(" " + t) if t else [] for t in texts]
        new = [p for p in set().union(*split) if p not in self]
        self.update((p, self.pair(p, b)) for p, b in zip(new, self.b.continued(new), strict=True))
        out = []
        for text, pieces in zip(texts, split, strict=True):
            pairs = list(map(self.__getitem__, pieces))
            if None in pairs:  # some piece is not given back; the whole may still be
                out.append(self.pair(" " + text, self.b.encode([text])[0]))
            else:
                out.append((b"".join([p[0] for p in pairs]), b"".join([p[1] for p in pairs])) if pairs else None)
        for p in new:
            if len(p) > 48:
                del self[p]
        return out


def _encoder(a: str, b: str, folder: str | None) -> Encoder:
    if (a, b, folder) not in _encoders:
        _encoders[a, b, folder] = Encoder(a, b, folder)
    return _encoders[a, b, folder]


def events(docs: DataFrame, a: str = A, b: str = B, folder: str | None = None) -> DataFrame:
    """(rid, doc_id, start, side, ids) of both sides; a document without tokens has one row without ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(a, b, folder)
        small, large = np.dtype("<u2"), np.dtype("<u4")
        kinds = [small if len(x) < 1 << 16 else large for x in (encoder.a_length, encoder.b_length)]
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            for from_row in range(0, batch.num_rows, 64):
                some = batch.slice(from_row, 64)
                row, start, side, ids = [], [], [], []
                for i, pair in enumerate(encoder.encode([t or "" for t in some.column("text").to_pylist()])):
                    if pair is None:
                        row, start, side, ids = [*row, i], [*start, 0], [*side, 0], [*ids, None]
                        continue
                    for k, (held, length) in enumerate(zip(pair, (encoder.a_length, encoder.b_length), strict=True)):
                        every = np.frombuffer(held, "<u4")
                        ends = np.concatenate(([0], np.cumsum(length[every])))
                        for s in range(0, len(every), EVENTS):
                            row.append(i)
                            start.append(int(ends[s]))
                            side.append(k)
                            ids.append(pack(every[s:s + EVENTS].astype(kinds[k]).tobytes()))
                at = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays([some.column("rid").take(at), some.column("doc_id").take(at), pa.array(start, pa.int64()), pa.array(side, pa.int32()), pa.array(ids, pa.binary())], names=["rid", "doc_id", "start", "side", "ids"])

    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "text").mapInArrow(run, f"rid long, doc_id {kind}, start long, side int, ids binary")


class _Machine:
    """The open document and the tokens since the last common end."""

    def __init__(self, encoder: Encoder, detail: bool):
        self.e, self.detail, self.docs, self.tokens = encoder, detail, [], 0
        self.wide = np.dtype("<u4") if len(encoder.a_length) * len(encoder.b_length) < 1 << 32 else np.dtype("<u8")
        self.pack = zstandard.ZstdCompressor(level=1).compress
        self.hash, self.begun = sha256(), False

    def add(self, rid: int, doc_id: object, side: int, ids: np.ndarray) -> None:
        if not self.docs or self.docs[-1][0] != rid:
            self.docs.append((rid, doc_id, ([], [])))
        self.docs[-1][2][side].append(ids)
        self.tokens += len(ids)

    def flush(self, last: bool) -> Iterator[tuple]:
        """Rows of the documents that are complete, and of the open one up to its last common end."""
        if not self.docs:
            return
        none = np.empty(0, np.int64)
        sides = [[np.concatenate([none, *d[2][k]]) for d in self.docs] for k in (0, 1)]
        ids_a, ids_b = np.concatenate(sides[0]), np.concatenate(sides[1])
        ends_a, ends_b = np.cumsum(self.e.a_length[ids_a]), np.cumsum(self.e.b_length[ids_b])
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        from_a = np.cumsum([len(x) for x in sides[0]])
        stops = np.concatenate(([0], ends_a))[from_a]
        if not last:
            upto = common[-1] if len(common) else 0
            stops[-1] = max(upto, stops[-2] if len(stops) > 1 else 0)
            rest = [sides[k][-1][len(sides[k][-1]) - int((e > stops[-1]).sum()):] for k, e in ((0, ends_a), (1, ends_b))]
            ids_a, ids_b = ids_a[: len(ids_a) - len(rest[0])], ids_b[: len(ids_b) - len(rest[1])]
            ends_a, ends_b = ends_a[: len(ids_a)], ends_b[: len(ids_b)]
        ends = np.union1d(ends_a, ends_b)
        codes = (ids_a[np.searchsorted(ends_a, ends)] * len(self.e.b_length) + ids_b[np.searchsorted(ends_b, ends)]).astype(self.wide)
        # tokens in the order of groups, A before B, each with what follows it
        in_a, in_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        place_a = np.arange(len(ids_a)) + np.searchsorted(in_b, in_a)
        place_b = np.arange(len(ids_b)) + np.searchsorted(in_a, in_b, "right")
        named = np.empty(len(ids_a) + len(ids_b), np.int64)
        na, nb = len(self.e.a_length), len(self.e.b_length)
        named[place_a] = ids_a + na * np.isin(ends_a, common, assume_unique=True)
        named[place_b] = ids_b + nb * np.isin(ends_b, common, assume_unique=True) + 2 * na
        words = self.e.names[named].tolist()
        cut = lambda e: np.concatenate(([0], np.searchsorted(e, stops, "right"))).tolist()
        at_a, at_b, at_c, at_e = cut(ends_a), cut(ends_b), cut(common), cut(ends)
        for i, (rid, doc_id, _) in enumerate(self.docs):
            part = b"".join(words[at_a[i] + at_b[i]:at_a[i + 1] + at_b[i + 1]])[:-1]
            if part:
                self.hash.update(b";" + part if self.begun else part)
                self.begun = True
            done = last or i < len(self.docs) - 1
            digest = (self.hash.hexdigest() if self.begun else "") if done else None
            counts = [x[i + 1] - x[i] for x in (at_a, at_b, at_c, at_e)]
            if done or part:
                yield rid, doc_id, *counts, digest, self.pack(codes[at_e[i]:at_e[i + 1]].tobytes()), part.decode() if self.detail else None
            if done:
                self.hash, self.begun = sha256(), False
        self.docs = [] if last else [(*self.docs[-1][:2], ([rest[0]], [rest[1]]))]
        self.tokens = 0 if last else len(rest[0]) + len(rest[1])


OUT = ("rid", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links", "groups")


def sweep(docs: DataFrame, a: str = A, b: str = B, folder: str | None = None, detail: bool = False, tile: int = TILE) -> DataFrame:
    """(rid, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, links, groups): a row for each document, or several in its order.

    ``links`` are pair codes (A id times the size of B, plus B id), packed;
    ``groups`` is the text that is hashed, with ``detail``; the digest is in a
    document's last row.
    """
    kind = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(a, b, folder)
        machine = _Machine(encoder, detail)
        small, large = np.dtype("<u2"), np.dtype("<u4")
        kinds = [small if len(x) < 1 << 16 else large for x in (encoder.a_length, encoder.b_length)]
        unpack = zstandard.ZstdDecompressor().decompress
        types = None

        def table(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=OUT)

        for batch in batches:
            types = types or [pa.int64(), batch.schema.field("doc_id").type, *[pa.int64()] * 4, pa.string(), pa.binary(), pa.string()]
            for rid, doc_id, side, ids in zip(*(batch.column(c).to_pylist() for c in ("rid", "doc_id", "side", "ids")), strict=True):
                if machine.tokens >= tile and (rows := list(machine.flush(last=rid != machine.docs[-1][0]))):
                    yield table(rows)
                machine.add(rid, doc_id, side, np.frombuffer(unpack(ids), kinds[side]).astype(np.int64) if ids is not None else np.empty(0, np.int64))
                if len(machine.docs) > 2000 and (rows := list(machine.flush(last=False))):
                    yield table(rows)
        if rows := list(machine.flush(last=True)):
            yield table(rows)

    dealt = events(docs, a, b, folder).repartition("rid").sortWithinPartitions("rid", "start", "side")
    return dealt.select("rid", "doc_id", "side", "ids").mapInArrow(run, f"rid long, doc_id {kind.simpleString()}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary, groups string")


def groups(docs: DataFrame, a: str = A, b: str = B, folder: str | None = None) -> DataFrame:
    """(doc_id, rid, part, place, a, b): every group of tokens that cover the same bytes, with the ids of both sides in order."""
    parts = sweep(docs, a, b, folder, detail=True).where("groups <> ''").select("doc_id", "rid", F.monotonically_increasing_id().alias("part"), F.posexplode(F.split("groups", ";")).alias("place", "g"))
    ids = lambda k: F.transform(F.split(F.split("g", r"\|")[k], ","), lambda x: x.cast("int"))
    return parts.select("doc_id", "rid", "part", "place", ids(0).alias("a"), ids(1).alias("b"))


def _codes(links: pa.Array, wide: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """The pair codes of packed lists, one after the other, and where each list ends."""
    unpack = zstandard.ZstdDecompressor().decompress
    lists = [np.frombuffer(unpack(x), wide) for x in links.to_pylist()]
    return np.concatenate([np.empty(0, wide), *lists]), np.cumsum([len(x) for x in lists], dtype=np.int64)


def pairs(swept: DataFrame, a: str = A, b: str = B, folder: str | None = None) -> DataFrame:
    """(pair, n, best) of every linked pair of ids: links that hold it, and whether that is its B id's highest count."""
    encoder = _encoder(a, b, folder)
    size, wide = len(encoder.b_length), np.dtype("<u4") if len(encoder.a_length) * len(encoder.b_length) < 1 << 32 else np.dtype("<u8")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def summed() -> pa.RecordBatch:
            found, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(found.astype(np.int64)), pa.array(n.astype(np.int64))], names=["pair", "n"])

        for batch in batches:
            held.append(_codes(batch.column(0), wide)[0])
            rows += len(held[-1])
            if rows >= 1 << 22:
                yield summed()
                held, rows = [], 0
        if held:
            yield summed()

    each = swept.select("links").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    each = store(each.withColumn("b", F.col("pair") % size), "pair-counts")
    # at most one row for each entry of B's vocabulary
    best = each.groupBy("b").agg(F.max("n").alias("most"))
    return each.join(F.broadcast(best), "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def align(docs: DataFrame, a: str = A, b: str = B, folder: str | None = None, held: int = HELD, tile: int = TILE) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every document."""
    swept = store(sweep(docs, a, b, folder, tile=tile).drop("groups"), "alignment")
    totals = store(pairs(swept, a, b, folder), "pair-totals")
    encoder = _encoder(a, b, folder)
    wide = np.dtype("<u4") if len(encoder.a_length) * len(encoder.b_length) < 1 << 32 else np.dtype("<u8")
    names = ["rid", "n_best", "count_sum"]
    if totals.count() <= held:
        table = totals.orderBy("pair").toArrow()  # at most ``held`` rows
        keys, counts, best = table.column(0).to_numpy().astype(wide), table.column(1).to_numpy(), table.column(2).to_numpy().astype(np.int64)

        def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                codes, ends = _codes(batch.column("links"), wide)
                at = np.searchsorted(keys, codes)
                sums = [np.diff(np.concatenate(([0], np.concatenate(([0], np.cumsum(x[at])))[ends]))) for x in (best, counts)]
                yield pa.RecordBatch.from_arrays([batch.column("rid"), *map(pa.array, sums), *(batch.column(c) for c in rest)], names=[*names, *rest])

        rest = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
        kinds = "".join(f", {c} {swept.schema[c].dataType.simpleString()}" for c in rest)
        scored = swept.select("rid", "links", *rest).mapInArrow(look_up, "rid long, n_best long, count_sum long" + kinds)
    else:
        def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for rid, links in zip(batch.column(0), batch.column(1), strict=True):
                    found, n = np.unique(_codes(pa.array([links.as_py()]), wide)[0], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([rid.as_py()] * len(found), pa.int64()), pa.array(found.astype(np.int64)), pa.array(n.astype(np.int64))], names=["rid", "pair", "links"])

        each = swept.select("rid", "links").mapInArrow(unpacked, "rid long, pair long, links long").join(totals, "pair")
        sums = each.groupBy("rid").agg(F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best"), F.sum(F.col("links") * F.col("n")).alias("count_sum"))
        whole = swept.groupBy("rid").agg(F.first("doc_id").alias("doc_id"), *(F.sum(c).alias(c) for c in ("n_a", "n_b", "n_groups", "n_links")), F.max("groups_sha256").alias("groups_sha256"))
        scored = whole.join(sums, "rid", "left").select("rid", F.coalesce("n_best", F.lit(0)).alias("n_best"), F.coalesce("count_sum", F.lit(0)).alias("count_sum"), *whole.columns[1:])
    numbers = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    out = scored.groupBy("rid").agg(F.first("doc_id").alias("doc_id"), *(F.sum(c).alias(c) for c in numbers), F.max("groups_sha256").alias("groups_sha256"))
    return out.select("doc_id", *numbers, "groups_sha256")
