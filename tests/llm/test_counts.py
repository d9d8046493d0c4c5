import functools
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from heartwood.llm import counts, vocabulary

TOKENIZERS = ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model")
#: What the tokenizers' splits and cuts turn on, and characters of many classes.
MARKS = [" ", "  ", "\n", "\t", "\r\n", "\x0b", "\x1c", "\x85", "\xa0", " ", "　", "'s", "'ll", "’", "▁", "<|endoftext|>", "<|startoftext|>", "<s>", "</s>", "<0x41>", "é", "ß", "Σ", "x́", " ́", "½", "²", "中文", "。", "🙂", "a", "The", "word", "12", "!", "...", "\x00", "ﬁ", "Å"]


@functools.cache
def loaded(name: str):
    if name.endswith(".model"):
        from sentencepiece import SentencePieceProcessor

        return SentencePieceProcessor(model_file=vocabulary.path(name)).encode
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(vocabulary.path(name))
    return lambda text: model.encode(text, add_special_tokens=False).ids


def library(name: str, text: str) -> int:
    """The number of tokens of a whole text, straight from the library."""
    return len(loaded(name)(text))


@pytest.mark.parametrize("name", TOKENIZERS)
def test_random_texts(name):
    rng = random.Random(3)
    texts = ["".join(rng.choices(MARKS, k=rng.randint(0, 30))) for _ in range(3000)]
    texts += ["".join(chr(rng.choice([rng.randint(1, 255), rng.randint(256, 0x2FFF), rng.randint(0x3000, 0xD7FF), 0x1F600])) for _ in range(rng.randint(1, 12))) for _ in range(2000)]
    counter = counts.Counter(name)
    if name.endswith(".model"):
        whole = [len(x) for x in counter.tokenizer.encode(texts)]
    else:
        whole = [len(e.ids) for e in counter.tokenizer.model.encode_batch(texts, add_special_tokens=False)]
    assert counter.count([counter.whole(t) for t in texts]) == whole
    for size in (1, 5):  # cut at every safe boundary, or at some
        cut = [vocabulary.parts(counter.whole(t), size) for t in texts]
        assert ["".join(c) for c in cut] == [counter.whole(t) for t in texts]
        assert [sum(counter.count(c)) for c in cut] == whole


@settings(max_examples=300, deadline=None)
@given(st.text())
def test_any_text(text):
    for name in TOKENIZERS:
        counter = counts._counter(name, None)
        assert sum(counter.count(vocabulary.parts(counter.whole(text), 3))) == sum(counter.count([counter.whole(text)])) == library(name, text)


@pytest.mark.parametrize("name", TOKENIZERS)
@pytest.mark.parametrize("long", [counts.LONG, 100])
def test_counts(docs, odd, none, name, long):
    for table in (docs, odd, none):
        rows = table.select("doc_id", "text").collect()
        want = sorted((r["doc_id"] or -1, len((r["text"] or "").encode()), library(name, r["text"] or "")) for r in rows)
        want = [(*w, w[2] > 1024) for w in want]
        got = counts.count(table, name, long=long)
        assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
        assert sorted((r["doc_id"] or -1, *r[1:]) for r in got.collect()) == want


def test_long_runs_without_a_cut(spark):
    text = "x" * 5000 + " " + "中" * 3000
    got = counts.count(spark.createDataFrame([(1, text), (None, None)], "doc_id long, text string"), long=1000).collect()
    assert sorted((r["doc_id"] or -1, r["n_tokens"]) for r in got) == [(-1, 0), (1, library("byte_bpe_50k.json", text))]


def test_special_strings_are_as_the_library_has_them(spark):
    text = "a<|endoftext|>b <|endoftext|> c  <|endoftext|>"
    got = counts.count(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert got["n_tokens"] == library("byte_bpe_50k.json", text) < len(text.split("<")) * 12
