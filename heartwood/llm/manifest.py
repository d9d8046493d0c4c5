"""A Merkle manifest of a table: one tree of digests for each source, and a tree of their roots.

A row's place among its source's rows comes from digit histograms, without a
global sort. Its key (doc_id, then the leaf, then a row number) is a string of
hexadecimal digits. One pass counts the rows of each source by their first
digits; those counts roll up a few digits at a time, and a bucket starts after
the lesser buckets under the same parent, level by level. Buckets that hold
many rows are counted again by further digits. Every row is then in one
bounded bucket, by the longest prefix that has one, and is ranked there.

The digits of a rank to the base of the fan-out are the key of its trie node:
dropping the last digit names the parent. Nodes are reduced ``DIGITS`` digits
at a time: rows that share the longer prefix meet in one block of at most
``fanout ** DIGITS`` members, which gives the node above; blocks of nodes
follow until one is left, the source's root. The same steps over the sources'
roots give the root of all. Paths of siblings come down the same blocks, so no
group meets in one task, however large its source.

Defined results: null fields are hashed as ``-``; null sources are one source,
which is the first; null doc_ids come first in their source, rows of equal
doc_id are ordered by their leaf, and rows equal in all fields are
interchangeable; a row with null doc_id counts as untampered; an empty table
gives no rows and has no root; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heartwood.llm.common import release, store

FANOUT, DIGITS = 3, 7
#: Rows that a bucket holds on average, those that make it count again by further digits, and digits that one window rolls up.
FILL, HEAVY, ROLL = 512, 4096, 2
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(c: Column) -> Column:
    """A field as it is hashed: ``-`` for null, else its bytes in UTF-8, a colon and its value."""
    s = c.cast("string")
    return F.when(s.isNull(), "-").otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf(**changed: Column) -> Column:
    """The digest of a row; ``changed`` gives fields other values."""
    return F.unhex(F.sha2(F.concat(*(field(changed.get(c, F.col(c))) for c in FIELDS)).cast("binary"), 256))


def leaves(docs: DataFrame) -> DataFrame:
    """(grp, doc_id, leaf, tampered, rid): ``tampered`` is the leaf after the tampering, null where that changes nothing."""
    hit = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0) & F.contains("text", F.lit("\n"))
    return docs.select(
        F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("="), "source")).alias("grp"), "doc_id", leaf().alias("leaf"),
        F.when(hit, leaf(text=F.replace("text", F.lit("\n"), F.lit("")))).alias("tampered"), F.monotonically_increasing_id().alias("rid"),
    )


def id_digits(df: DataFrame, name: str) -> Column:
    """An id as a string of digits in its order, null first; an integer has a fixed number, a shorter text comes before its extensions."""
    c = F.col(name)
    if df.schema[name].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint"):
        digits = F.lpad(F.hex(c.cast("long").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
        return F.when(c.isNull(), F.lit("0" * 17)).otherwise(F.concat(F.lit("1"), digits))
    return F.when(c.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), F.hex(c.cast("string").cast("binary")), F.lit("!")))


def _starts(hist: DataFrame, depth: int, levels: list[int]) -> DataFrame:
    """``hist`` (grp, prefix, n, start) with the rows of lesser buckets added to start, up to the prefixes of the last level."""
    out, level = hist, hist.select("grp", "prefix", "n")
    for up in levels:
        parent = F.substring("prefix", 1, up)
        w = Window.partitionBy("grp", parent).orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
        before = level.select(F.col("grp").alias("g"), F.col("prefix").alias("p"), F.coalesce(F.sum("n").over(w), F.lit(0)).alias("before"))
        own = F.substring("prefix", 1, depth)
        out = out.join(before, (F.col("grp") == F.col("g")) & (own == F.col("p"))).select("grp", "prefix", "n", (F.col("start") + F.col("before")).alias("start"))
        level = level.groupBy("grp", parent.alias("prefix")).agg(F.sum("n").alias("n"))
        depth = up
    return out


def ranked(rows: DataFrame, digits: Column, order: list[str], fill: int = FILL, heavy: int = HEAVY) -> tuple[DataFrame, DataFrame]:
    """``rows`` (grp, ...) with ``rank``, the place from 0 in its group in the order of ``digits``; also (grp, n) of all groups.

    ``order`` are columns that sort as the digits do; no two rows have equal digits.
    """
    some = F.when(F.substring(digits, 1, 1) != "0", digits)
    n, low, high, most = rows.agg(F.count(F.lit(1)), F.min(some), F.max(some), F.max(F.length(digits))).first()
    low, high = low or "", high or ""
    lead = next((i for i, (a, b) in enumerate(zip(low, high, strict=False)) if a != b), min(len(low), len(high)))
    depth, wanted = lead, n / fill
    while depth < (most or 0) and (wanted > 1 or depth <= lead):
        depth, wanted = depth + 1, wanted / 16
    hist = rows.groupBy("grp", F.substring(digits, 1, depth).alias("prefix")).agg(F.count(F.lit(1)).alias("n")).withColumn("start", F.lit(0).cast("long"))
    hist = store(hist, "manifest-counts")
    sizes, parts, inside, levels = hist.groupBy("grp").agg(F.sum("n").alias("n")), [], rows, [*range(depth - ROLL, lead, -ROLL), *([lead] if lead else []), 0]
    w = Window.partitionBy("grp", "prefix").orderBy(*(F.col(c).asc_nulls_first() for c in order))
    while True:
        last = depth >= (most or 0) or (hist.agg(F.max("n")).first()[0] or 0) <= heavy
        starts = _starts(hist, depth, levels) if last else store(_starts(hist, depth, levels), "manifest-buckets")
        light = starts if last else starts.where(F.col("n") <= heavy)
        own = inside.withColumn("prefix", F.substring(digits, 1, depth)).join(light.select("grp", "prefix", "start"), ["grp", "prefix"])
        parts.append(own.withColumn("rank", F.col("start") + F.row_number().over(w) - 1).select(*rows.columns, "rank"))
        if last:
            break
        # the rows of dense buckets are counted by four digits more
        deep = min(depth + 4, most)
        dense = starts.where(F.col("n") > heavy).select(F.col("grp").alias("g"), F.col("prefix").alias("p"), F.col("start").alias("base"))
        inside = store(inside.join(dense, (F.col("grp") == F.col("g")) & (F.substring(digits, 1, depth) == F.col("p"))).select(*rows.columns, "base"), "manifest-dense")
        hist = inside.groupBy("grp", F.substring(digits, 1, deep).alias("prefix")).agg(F.count(F.lit(1)).alias("n"), F.first("base").alias("start"))
        hist, levels = store(hist, "manifest-counts"), [*range(deep - ROLL, depth, -ROLL), depth]
        inside, depth = inside.select(*rows.columns), deep
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out, sizes


def _height(n: Column, fanout: int) -> Column:
    """Levels above the leaves of n rows: the powers of the fan-out below n."""
    powers, p = [], 1
    while p < 1 << 62:
        powers, p = [*powers, p], p * fanout
    return F.size(F.filter(F.array(*(F.lit(p).cast("long") for p in powers)), lambda p: p < n))


def climb(digests: list[bytes], levels: int, fanout: int = FANOUT) -> list[list[bytes]]:
    """The digests of each level from a block's members to its top."""
    out = [digests]
    for _ in range(levels):
        below = out[-1]
        out.append([sha256(b"".join(below[i:i + fanout]).hex().encode()).digest() for i in range(0, len(below), fanout)])
    return out


def siblings(levels: list[list[bytes]], fanout: int = FANOUT) -> list[list[tuple[bytes, bytes]]]:
    """For each level below the top and each node, the digests before and after it in its run."""
    out = []
    for below in levels[:-1]:
        row = []
        for s in range(0, len(below), fanout):
            run = below[s:s + fanout]
            row += [(b"".join(run[:j]), b"".join(run[j + 1:])) for j in range(len(run))]
        out.append(row)
    return out


def fold(digest: bytes, path: list[tuple[bytes, bytes]]) -> bytes:
    """The root that a leaf and its siblings give."""
    for before, after in path:
        digest = sha256((before + digest + after).hex().encode()).digest()
    return digest


class _Tree:
    """The stored blocks of a forest, round by round, and the root of each group."""

    def __init__(self, nodes: DataFrame, sizes: DataFrame, fanout: int, digits: int):
        self.fanout, self.digits = fanout, digits
        span = fanout ** digits

        def top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                tops = [climb(d, n, fanout)[-1][0] for d, n in zip(b.column("digests").to_pylist(), b.column("levels").to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([b.column("grp"), b.column("block"), pa.array(tops, pa.binary()), b.column("tops")], names=["grp", "rank", "digest", "tops"])

        extra = [c for c in nodes.columns if c not in ("grp", "rank", "digest")]
        height = sizes.select("grp", _height(F.col("n"), fanout).alias("height"))
        tallest = height.agg(F.max("height")).first()[0] or 0
        self.rounds: list[DataFrame] = []
        roots = None
        for done in range(0, max(tallest, 1), digits):
            blocks = nodes.groupBy("grp", F.floor(F.col("rank") / span).alias("block")).agg(F.sort_array(F.collect_list(F.struct("rank", "digest", *extra))).alias("members"))
            # the height of a large group joins its blocks, not its rows
            blocks = blocks.join(height.where(F.col("height") >= done), "grp").withColumn("levels", F.least(F.lit(digits), F.col("height") - done))
            blocks = store(blocks.withColumn("tops", F.col("height") <= done + digits), "manifest-blocks")
            self.rounds.append(blocks)
            up = store(blocks.select("grp", "block", "levels", "tops", F.transform("members", lambda m: m["digest"]).alias("digests")).mapInArrow(top, "grp string, rank long, digest binary, tops boolean"), "manifest-nodes")
            found = up.where("tops").select("grp", "digest")
            roots = found if roots is None else roots.unionByName(found)
            nodes, extra = up.where("not tops").select("grp", "rank", "digest"), []
        self.roots = roots

    def with_paths(self, above: DataFrame) -> DataFrame:
        """The lowest blocks with the path above each; ``above`` (grp, path, ...) holds what is above the groups' roots."""
        rest = [c for c in above.columns if c not in ("grp", "path")]
        kind = above.schema["path"].dataType.simpleString()
        fanout, span = self.fanout, self.fanout ** self.digits

        def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for i, (digests, n, path) in enumerate(zip(*(b.column(c).to_pylist() for c in ("digests", "levels", "path")), strict=True)):
                    beside = siblings(climb(digests, n, fanout), fanout)
                    first = b.column("block")[i].as_py() * span
                    paths = [[{"l": x, "r": y} for x, y in (row[j // fanout ** k] for k, row in enumerate(beside))] + path for j in range(len(digests))]
                    own = b.slice(i, 1)
                    again = pa.array([0] * len(digests))
                    yield pa.RecordBatch.from_arrays([own.column("grp").take(again), pa.array(range(first, first + len(digests)), pa.int64()), pa.array(paths, b.column("path").type), *(own.column(c).take(again) for c in rest)], names=["grp", "rank", "path", *rest])

        paths = None
        for r in range(len(self.rounds) - 1, -1, -1):
            blocks = self.rounds[r]
            mine = blocks.where("tops").join(above, "grp")
            if paths is not None:
                mine = mine.unionByName(blocks.where("not tops").join(paths, (blocks["grp"] == paths["grp"]) & (blocks["block"] == paths["rank"])).drop(paths["grp"], paths["rank"]))
            if r == 0:
                return mine
            rows = mine.select("grp", "block", "levels", "path", F.transform("members", lambda m: m["digest"]).alias("digests"), *rest)
            types = "".join(f", {c} {above.schema[c].dataType.simpleString()}" for c in rest)
            paths = store(rows.mapInArrow(down, f"grp string, rank long, path {kind}{types}"), "manifest-paths")


def trees(docs: DataFrame, fanout: int = FANOUT, digits: int = DIGITS, **tuning: int) -> tuple[_Tree, DataFrame]:
    """The sources' trees, and (grp, subroot, root, path) of each source, with the siblings from its root to the root of all."""
    rows = store(leaves(docs), "manifest-leaves")
    key = F.concat(id_digits(rows, "doc_id"), F.hex("leaf"), F.lpad(F.hex("rid"), 16, "0"))
    placed, sizes = ranked(rows, key, ["doc_id", "leaf", "rid"], **tuning)
    own = _Tree(placed.select("grp", "rank", F.col("leaf").alias("digest"), "doc_id", "tampered"), sizes, fanout, digits)
    release(rows)
    sources = own.roots.select(F.lit("").alias("grp"), F.col("grp").alias("source"), "digest")
    placed, sizes = ranked(sources, F.concat(F.lit("1"), F.hex(F.encode("source", "UTF-8")), F.lit("!")), ["source"], **tuning)
    top = _Tree(placed.select("grp", "rank", "digest", "source"), sizes, fanout, digits)
    step = "array<struct<l:binary,r:binary>>"
    root = top.roots.select("grp", F.array().cast(step).alias("path"), F.col("digest").alias("root"))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for members, n, path, root in zip(*(b.column(c).to_pylist() for c in ("members", "levels", "path", "root")), strict=True):
                beside = siblings(climb([m["digest"] for m in members], n, fanout), fanout)
                paths = [[{"l": x, "r": y} for x, y in (row[j // fanout ** k] for k, row in enumerate(beside))] + path for j in range(len(members))]
                yield pa.RecordBatch.from_arrays([pa.array([m["source"] for m in members], pa.string()), pa.array([m["digest"] for m in members], pa.binary()), pa.array([root] * len(members), pa.binary()), pa.array(paths, b.column("path").type)], names=["grp", "subroot", "root", "path"])

    above = top.with_paths(root).select("members", "levels", "path", "root").mapInArrow(spread, f"grp string, subroot binary, root binary, path {step}")
    return own, store(above, "manifest-sources")


def roots(docs: DataFrame) -> DataFrame:
    """(source, subroot, root): the manifest itself, one row for each source."""
    return trees(docs)[1].select(F.when(F.col("grp") != "", F.substring("grp", 2, 1 << 30)).alias("source"), F.lower(F.hex("subroot")).alias("subroot"), F.lower(F.hex("root")).alias("root"))


def proofs(docs: DataFrame, fanout: int = FANOUT, digits: int = DIGITS, paths: bool = True, **tuning: int) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified[, siblings, before, after]) of every row.

    ``siblings`` are the digests from the leaf's run to the root's, left to
    right within a level; ``before`` and ``after`` count those of each level that stand
    on either side of the path. ``folded_root`` is what they give with the tampered leaf.
    """
    own, above = trees(docs, fanout, digits, **tuning)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                members, n, path, subroot, root = (b.column(c)[i] for c in ("members", "levels", "path", "subroot", "root"))
                members, n, root = members.values if hasattr(members, "values") else members, n.as_py(), root.as_py()
                digests, tampered = members.field("digest").to_pylist(), members.field("tampered").to_pylist()
                beside = siblings(climb(digests, n, fanout), fanout)
                upper = [(s["l"], s["r"]) for s in path.as_py()]
                shared = b"".join(x + y for x, y in upper)
                proof, folded, listed, before, after = [], [], [], [], []
                for j, (digest, other) in enumerate(zip(digests, tampered, strict=True)):
                    mine = []
                    for row in beside:
                        mine.append(row[j])
                        j //= fanout
                    flat = b"".join([x + y for x, y in mine]) + shared
                    proof.append(sha256(flat.hex().encode()).hexdigest())
                    folded.append(fold(other or digest, mine + upper))
                    if paths:
                        listed.append([flat[k:k + 32].hex() for k in range(0, len(flat), 32)])
                        before.append([len(x) // 32 for x, _ in mine + upper])
                        after.append([len(y) // 32 for _, y in mine + upper])
                size = len(digests)
                columns = [members.field("doc_id"), pa.array([d.hex() for d in digests]), pa.array([subroot.as_py().hex()] * size), pa.array([root.hex()] * size), pa.array(proof), pa.array([f.hex() for f in folded]), pa.array([f == root for f in folded])]
                if paths:
                    columns += [pa.array(listed, pa.list_(pa.string())), pa.array(before, pa.list_(pa.int32())), pa.array(after, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", *(["siblings", "before", "after"] if paths else [])]
    kinds = [docs.schema["doc_id"].dataType.simpleString(), *["string"] * 5, "boolean", "array<string>", "array<int>", "array<int>"]
    rows = own.with_paths(above).select("members", "levels", "path", "subroot", "root")
    return rows.mapInArrow(run, ", ".join(f"{c} {k}" for c, k in zip(names, kinds, strict=False)))


def digest(docs: DataFrame) -> DataFrame:
    return proofs(docs, paths=False)


def _oracle() -> str:
    """DuckDB SQL for ``digest``: the levels by recursion, a proof's siblings by window, the fold by a list."""
    enc = lambda c: f"coalesce(octet_length(encode({c}::VARCHAR)) || ':' || {c}::VARCHAR, '-')"
    leaf = lambda text: f"sha256({' || '.join(enc(text if c == 'text' else c) for c in FIELDS)})"
    # crc32 of the decimal doc_id, bit by bit: each byte is mixed in with the first of its eight steps
    steps = "flatten(list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: [ascii(substring(doc_id::VARCHAR, i, 1))::BIGINT, 0, 0, 0, 0, 0, 0, 0]))"
    crc = f"xor(list_reduce(list_prepend(4294967295::BIGINT, {steps}), lambda x, y: xor(xor(x, y) >> 1, 3988292384 * (xor(x, y) & 1))), 4294967295::BIGINT)"
    return f"""WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS grp, {leaf('text')} AS leaf,
  CASE WHEN {crc} % 2 = 0 THEN {leaf("replace(text, chr(10), '')")} ELSE {leaf('text')} END AS tampered FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf, rid) - 1 AS rank, count(*) OVER (PARTITION BY grp) AS n FROM d),
t AS (SELECT grp, 0 AS lvl, rank AS idx, leaf AS h, n FROM r
  UNION ALL SELECT grp, lvl + 1, idx // 3, sha256(string_agg(h, '' ORDER BY idx)), (any_value(n) + 2) // 3 FROM t WHERE n > 1 GROUP BY grp, lvl, idx // 3),
s AS (SELECT grp, h AS subroot, lvl AS height, row_number() OVER (ORDER BY encode(grp)) - 1 AS rank, count(*) OVER () AS n FROM t WHERE n = 1),
u AS (SELECT 0 AS lvl, rank AS idx, subroot AS h, n FROM s
  UNION ALL SELECT lvl + 1, idx // 3, sha256(string_agg(h, '' ORDER BY idx)), (any_value(n) + 2) // 3 FROM u WHERE n > 1 GROUP BY lvl, idx // 3),
top AS (SELECT h AS root, lvl AS height FROM u WHERE n = 1),
nodes AS (SELECT grp, lvl, idx, h FROM t WHERE n > 1 UNION ALL SELECT NULL, lvl, idx, h FROM u WHERE n > 1),
beside AS (SELECT a.grp, a.lvl, a.idx, coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS l, coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS r
  FROM nodes a JOIN nodes b ON a.grp IS NOT DISTINCT FROM b.grp AND a.lvl = b.lvl AND a.idx // 3 = b.idx // 3 GROUP BY ALL),
steps AS (SELECT r.rid, b.lvl, b.l, b.r FROM r JOIN s USING (grp) JOIN beside b ON b.grp = r.grp AND b.idx = r.rank // (3 ** b.lvl)::BIGINT
  UNION ALL SELECT r.rid, s.height + b.lvl, b.l, b.r FROM r JOIN s USING (grp) JOIN beside b ON b.grp IS NULL AND b.idx = s.rank // (3 ** b.lvl)::BIGINT),
path AS (SELECT rid, list({{'l': l, 'c': '', 'r': r}} ORDER BY lvl) AS p, string_agg(l || r, '' ORDER BY lvl) AS flat FROM steps GROUP BY rid),
f AS (SELECT doc_id, leaf, subroot, (SELECT root FROM top) AS root, sha256(coalesce(flat, '')) AS proof_sha256,
  list_reduce(list_prepend({{'l': '', 'c': tampered, 'r': ''}}, coalesce(p, [])), lambda x, y: {{'l': '', 'c': sha256(y.l || x.c || y.r), 'r': ''}}).c AS folded_root FROM r JOIN s USING (grp) LEFT JOIN path USING (rid))
SELECT *, folded_root = root AS verified FROM f"""


ORACLE = _oracle()
