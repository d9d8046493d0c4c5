"""Token counts of whole texts: batches go to the tokenizer's library, and only lengths come back.

A task gathers texts to batches of about ``BATCH`` characters. Their pieces
between safe cuts (``vocabulary``) are encoded once a batch, in one call of
the library, and the counts of short ones stay at hand. A text of over
``LONG`` bytes is cut into parts at safe boundaries, and the parts of all such
texts are dealt over all tasks, so no task waits for one text. A text without
a safe boundary is encoded whole, as is every text of a tokenizer for which
cuts are not known to be safe.

Defined results: null and empty texts have no bytes and no tokens; strings of
special tokens inside a text are what the library makes of them; repeated rows
are counted each; a null doc_id stays; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heartwood.llm.common import small_batches
from heartwood.llm.packing import BEYOND, CACHE, LATIN
from heartwood.llm.vocabulary import Pieces, load, parts, spaced

TOKENIZER, LIMIT = "byte_bpe_50k.json", 1024
BATCH, LONG, SHORT = 1 << 20, 1 << 16, 48
_counters: dict[tuple, "Counter"] = {}


class Counter(dict):
    """Numbers of tokens, with those of short pieces at hand."""

    def __init__(self, name: str, folder: str | None = None):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.tokenizer = load(name, folder)
        self.latin = re.compile(LATIN).findall
        if getattr(self.tokenizer, "words", False):
            import public_tokenizers
            import regex

            self.any = regex.compile(public_tokenizers.PATTERN).findall

    def split(self, text: str) -> list[str]:
        t = self.tokenizer
        if not t.safe:
            return [text]
        if isinstance(t, Pieces) or not t.words or any(a in text for a in t.added):
            return spaced(text)
        return self.any(text) if BEYOND(text) else self.latin(text)

    def batch(self, pieces: list[str]) -> list:
        t = self.tokenizer
        return t.continued(pieces) if isinstance(t, Pieces) and t.safe else t.encode(pieces)

    def whole(self, text: str | None) -> str:
        """A text from its start on; a sentencepiece model puts a space before it."""
        return f" {text}" if text and isinstance(self.tokenizer, Pieces) and self.tokenizer.safe else text or ""

    def count(self, texts: list[str]) -> list[int]:
        """Numbers of tokens of texts, or of their parts between safe cuts."""
        if len(self) > CACHE:
            self.clear()
        split = [self.split(t) for t in texts]
        new = [p for p in set().union(*split) if p not in self]
        self.update(zip(new, map(len, self.batch(new)), strict=True))
        counts = [sum(map(self.__getitem__, s)) for s in split]
        for p in new:
            if len(p) > SHORT:
                del self[p]
        return counts


def _batches(texts: list[str], size: int) -> Iterator[list[str]]:
    held, chars = [], 0
    for t in texts:
        held.append(t)
        chars += len(t)
        if chars >= size:
            yield held
            held, chars = [], 0
    if held:
        yield held


def _counter(tokenizer: str, folder: str | None) -> Counter:
    if (tokenizer, folder) not in _counters:
        _counters[tokenizer, folder] = Counter(tokenizer, folder)
    return _counters[tokenizer, folder]


def _counted(rows: DataFrame, tokenizer: str, folder: str | None, batch: int, whole: bool) -> DataFrame:
    """``rows`` with their last column, a text or a part of one, replaced by its number of tokens."""
    *rest, text = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(tokenizer, folder)
        for b in batches:
            texts = b.column(text).to_pylist()
            counts = [n for held in _batches(list(map(counter.whole, texts)) if whole else texts, batch) for n in counter.count(held)]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in rest), pa.array(counts, pa.int64())], names=[*rest, "n_tokens"])

    small_batches(rows.sparkSession)
    kinds = "".join(f"{c} {rows.schema[c].dataType.simpleString()}, " for c in rest)
    return rows.mapInArrow(run, kinds + "n_tokens long")


def count(docs: DataFrame, tokenizer: str = TOKENIZER, limit: int = LIMIT, folder: str | None = None, batch: int = BATCH, long: int = LONG) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every document by any .json or .model tokenizer."""
    rows = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text")
    near = _counted(rows.where(F.col("n_bytes") <= long), tokenizer, folder, batch, whole=True)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(tokenizer, folder)
        for b in batches:
            for i, text in enumerate(b.column("text")):
                text = counter.whole(text.as_py())
                found = parts(text, long) if counter.tokenizer.safe else [text]
                again = pa.array([i] * len(found))
                yield pa.RecordBatch.from_arrays([*(b.column(c).take(again) for c in names), pa.array(range(len(found)), pa.int32()), pa.array(found)], names=[*names, "part", "text"])

    names = ["rid", "doc_id", "n_bytes"]
    far = rows.where(F.col("n_bytes") > long).select(F.monotonically_increasing_id().alias("rid"), "doc_id", "n_bytes", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    far = far.mapInArrow(cut, f"rid long, doc_id {kind}, n_bytes long, part int, text string").repartition("rid", "part")
    far = _counted(far, tokenizer, folder, batch, whole=False).groupBy(*names).agg(F.sum("n_tokens").alias("n_tokens")).drop("rid")
    return near.unionByName(far).withColumn("over_limit", F.col("n_tokens") > limit)
