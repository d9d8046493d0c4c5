import functools
import random
from collections import Counter
from hashlib import sha256

import pytest

from heartwood.llm import alignment, vocabulary
from tests.llm.test_counts import MARKS


@functools.cache
def models():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(vocabulary.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [x for x in range(256) if x not in kept]
    decode = {chr(x): x for x in kept} | {chr(256 + i): x for i, x in enumerate(others)}
    return a, decode, SentencePieceProcessor(model_file=vocabulary.path("piece_bpe_32k.model"))


def tokens(text):
    """(ids and byte ranges) of both sides, straight from the libraries; None where there are none."""
    a, decode, b = models()
    if not text:
        return None
    found = a.encode(" " + text, add_special_tokens=False)
    left = [(i, bytes(decode[c] for c in t)) for i, t in zip(found.ids, found.tokens, strict=True)]
    right = []
    for i in b.encode(text):
        p = b.id_to_piece(i)
        right.append((i, bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    return (left, right) if b"".join(x for _, x in left) == whole == b"".join(x for _, x in right) else None


def ranges(side):
    at, out = 0, []
    for i, x in side:
        out.append((i, at, at + len(x)))
        at += len(x)
    return out


def brute(rows):
    """Rows of (doc_id, text) by the contract, with all pairs of a document's tokens compared."""
    each, total = [], Counter()
    for doc_id, text in rows:
        found = tokens(text)
        if not found:
            each.append((doc_id, [], [], [], []))
            continue
        a, b = ranges(found[0]), ranges(found[1])
        common = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, s = [], 0
        for e in common:
            groups.append(",".join(str(i) for i, x, y in a if s <= x and y <= e) + "|" + ",".join(str(i) for i, x, y in b if s <= x and y <= e))
            s = e
        links = [(i, j) for i, x, y in a for j, u, v in b if x < v and u < y]
        total.update(links)
        each.append((doc_id, a, b, groups, links))
    best = {}
    for (_, j), n in total.items():
        best[j] = max(best.get(j, 0), n)
    return sorted((str(d), len(a), len(b), len(g), len(k), sum(total[p] == best[p[1]] for p in k), sum(total[p] for p in k), sha256(";".join(g).encode()).hexdigest() if a else "") for d, a, b, g, k in each)


def texts():
    rng = random.Random(5)
    some = ["".join(rng.choices(MARKS, k=rng.randint(0, 20))) for _ in range(250)]
    some += ["".join(chr(rng.choice([rng.randint(1, 255), rng.randint(256, 0x2FFF), rng.randint(0x3000, 0xD7FF)])) for _ in range(rng.randint(1, 10))) for _ in range(150)]
    return [*some, None, "", " ", "  ", "a ", "\n", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "the " * 50, "the " * 50]


@pytest.mark.parametrize("tuning", [{}, {"held": 0}, {"tile": 7}])
def test_against_brute_force(spark, tuning):
    rows = [(i if i % 50 else None, t) for i, t in enumerate(texts())]
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, rid int, links string")
    got = alignment.align(docs, **tuning)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted((str(r[0]), *r[1:]) for r in got.collect()) == brute(rows)


def test_long_documents_in_many_rows(spark):
    rng = random.Random(2)
    rows = [(i, " ".join("".join(rng.choices("abcdefgheinstr", k=rng.randint(1, 9))) for _ in range(n))) for i, n in enumerate([3000, 10, 2500])]
    got = alignment.align(spark.createDataFrame(rows, "doc_id long, text string"), tile=1000).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == brute(rows)


def test_odd(odd, none, docs):
    got = alignment.align(odd).collect()
    assert len(got) == odd.count() and alignment.align(none).count() == 0
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[1]["n_a"] == by_id[2]["n_links"] == 0 and by_id[1]["groups_sha256"] == by_id[2]["groups_sha256"] == ""
    assert by_id[7]["groups_sha256"] == by_id[8]["groups_sha256"] and by_id[7]["count_sum"] == by_id[8]["count_sum"]


def test_groups_join_to_the_text(docs):
    encoder = alignment._encoder(alignment.A, alignment.B, None)
    some = docs.where("doc_id < 20")
    wanted = {r["doc_id"]: (" " + r["text"]).encode() for r in some.collect() if r["text"]}
    rows = sorted(alignment.groups(some).collect(), key=lambda r: (r["doc_id"], r["part"], r["place"]))
    for side, table in (("a", encoder.a_bytes), ("b", encoder.b.bytes)):
        found = {}
        for r in rows:
            found[r["doc_id"]] = found.get(r["doc_id"], b"") + b"".join(table[i] for i in r[side])
        assert found and all(wanted[d] == x for d, x in found.items())
