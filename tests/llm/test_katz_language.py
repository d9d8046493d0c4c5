import collections
import math
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from heartwood.llm import katz, language


def crc(doc_id, m):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % m


def brute_katz(rows, order=2):
    """(doc_id, ...) scores straight from the formulas, and a function for P(w | history)."""
    tokens = lambda t: [*(t or "").encode().lower().split(), b""]
    train = [tokens(t) for d, t in rows if crc(d, 5) != 1]
    padded = lambda t: [*[None] * (order - 1), *t]
    grams = [collections.Counter(tuple(x[i - n:i + 1]) for t in train for x in [padded(t)] for i in range(order - 1, len(x))) for n in range(order)]
    uni = grams[0]
    total, v = sum(uni.values()), len(uni)
    nr = [[sum(1 for x in g.values() if x == r) for r in range(1, katz.K + 2)] for g in grams]

    def discounted(n, r):
        if r > katz.K:
            return r - katz.SPARE
        cut = (katz.K + 1) * nr[n][katz.K] / nr[n][0] if nr[n][0] else 1
        good = (r + 1) * nr[n][r] / (r * nr[n][r - 1]) if nr[n][r - 1] else 0
        x = (good - cut) / (1 - cut) if cut < 1 else 0
        return (x if 0 < x < 1 else (r - katz.SPARE) / r) * r

    unknown = 1 - sum(discounted(0, c) for c in uni.values()) / total if total else 1.0
    follow = collections.defaultdict(dict)
    for g in grams[1:]:
        for k, r in g.items():
            follow[k[:-1]][k[-1]] = r
    count = {h: sum(f.values()) for h, f in follow.items()}
    weight = {}

    def p(h, w):
        if not h:
            return discounted(0, uni[(w,)]) / total if (w,) in uni else unknown
        if h not in follow:
            return p(h[1:], w)
        f = follow[h]
        if w in f:
            return discounted(len(h), f[w]) / count[h]
        if h not in weight:
            weight[h] = (1 - sum(discounted(len(h), r) for r in f.values()) / count[h]) / (1 - sum(p(h[1:], x) for x in f))
        return weight[h] * p(h[1:], w)

    out = []
    for d, text in rows:
        t, x = tokens(text), padded(tokens(text))
        base = sum(math.log10((uni[(w,)] + 0.5) / (total + 0.5 * (v + 1))) for w in t)
        out.append((d, crc(d, 5) == 1, len(t), sum((w,) in uni for w in t), total, base, sum(math.log10(p(tuple(x[i - order + 1:i]), x[i])) for i in range(order - 1, len(x)))))
    return out, p, [w for w, in uni], list(follow)


def check(df, rows, order=2):
    want, p, uni, contexts = brute_katz(rows, order)
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    got = sorted((tuple(r[c] for c in ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")) for r in df.collect()), key=key)
    assert len(got) == len(rows)
    for g, w in zip(got, sorted(want, key=key), strict=True):
        assert g[:5] == w[:5]
        assert g[5:] == pytest.approx(w[5:], rel=1e-9)
    return p, uni, contexts


def test_scores_of_documents(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    p, uni, contexts = check(katz.score(docs), rows)
    # the distributions sum to one over the known words and the unknown one
    for context in [*contexts[:20], (b"never seen",)]:
        assert sum(p(context, w) for w in uni) + p(context, b"not a word") == pytest.approx(1)


def test_many_blocks_and_parts(docs, monkeypatch):
    monkeypatch.setattr(katz, "PART", 5000)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    check(katz.score(docs.repartition(9)), rows)


@pytest.mark.parametrize("order", [1, 3, 4])
def test_orders(docs, order):
    """Recursion over several orders; each distribution sums to one."""
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    p, uni, contexts = check(katz.score(docs, order=order), rows, order)
    for h in sorted(contexts, key=str)[::max(1, len(contexts) // 12)]:
        assert sum(p(h, w) for w in uni) + p(h, b"not a word") == pytest.approx(1)


@pytest.mark.parametrize("order", [2, 3])
def test_groups_of_blocks(docs, monkeypatch, order):
    """Lists merged by groups of blocks give the same as lists merged at once."""
    monkeypatch.setattr(katz, "PART", 20_000)
    monkeypatch.setattr(katz, "SALT", 3)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    check(katz.score(docs.repartition(9), order=order), rows, order)


def test_counts_beyond_32_bits():
    """Counts are 64-bit from the lists to the answers."""
    keys, big = np.array([5, 9], np.uint64), np.array([2**32 + 7, 3], "<u8")
    pdf = pd.DataFrame({"kind": 1, "part": 0, "bid": [1, 2], "keys": [katz._pack_sorted(keys)] * 2, "counts": [katz._pack(big), katz._pack(big)]})
    out = katz._count(pdf)
    assert katz._unpack(out["counts"].iloc[0], "<u8").tolist() == [2**33 + 14, 6]
    assert out["stats"].iloc[-1][-1] == 2**33 + 20


def test_ids_that_are_texts(spark, docs):
    rows = [(f"d{r['doc_id']}", r["text"]) for r in docs.limit(30).collect()]
    got = katz.score(spark.createDataFrame(rows, "doc_id string, text string"))
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(d for d, _ in rows)


def test_odd_rows(odd, none):
    check(katz.score(odd), [(r["doc_id"], r["text"]) for r in odd.collect()])
    assert katz.score(none).count() == 0
    one = odd.where("doc_id = 6")
    check(katz.score(one), [(r["doc_id"], r["text"]) for r in one.collect()])


def test_nothing_to_learn_from(spark):
    held = next(i for i in range(100) if crc(i, 5) == 1)
    rows = [(held, "a b c")]
    check(katz.score(spark.createDataFrame(rows, "doc_id long, text string")), rows)


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language.digest(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    out = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (crc(r["doc_id"], 4) == 2) for r in rows)
    assert sum(r["lang"] == r["lang_pred"] for r in out) >= 0.95 * len(out)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_odd_rows(odd, none):
    rows = language.digest(odd).collect()
    assert len(rows) == odd.count()
    by = {r["doc_id"]: r for r in rows}
    assert {by[i]["lang_pred"] for i in (1, 2, 3)} == {"und"}
    assert by[4]["lang_pred"] in {"en", "fr"}
    assert language.digest(none).count() == 0
    assert {r["lang_pred"] for r in language.digest(odd.where("doc_id in (1, 4)")).collect()} == {"und"}


def greedy(text, known):
    """Phrases of a text, each the longest match in ``known``, or one character."""
    n = 0
    while text:
        k = 1
        while k < len(text) and text[: k + 1] in known:
            k += 1
        text, n = text[k:], n + 1
    return n


@pytest.mark.parametrize("letters", ["abc ", "ab", "abcdefgh " + "".join(map(chr, range(0x4E00, 0x4E00 + 800)))])
def test_phrases_match_greedy_parsing(letters):
    """Texts shorter, equal and longer than a row of the parse, phrases across rows, periodic texts, and an alphabet of hundreds of letters."""
    rng = np.random.default_rng(0)
    learned = "".join(rng.choice(list(letters), 700)) + "ab" * 300
    texts = ["".join(rng.choice(list(letters + "d"), n)) for n in (0, 1, 5, 200, 255, 256, 257, 700, 1500)]
    texts += [learned[100:650], "a" * 900, "ab" * 700, learned[200:260] * 9, "x" + learned[:500] * 2]
    own, _ = language.normalise([learned])
    size = 1300
    model = language.Model({"x": own, "y": own[::-1].copy()}, chars=size)
    assert set(own[:size].tolist()) <= set(model.alphabet.tolist())
    points, starts = language.normalise(texts)
    got = model.phrases(points, starts)
    for n, kept in enumerate((own[:size], own[::-1][:size])):
        known = "".join(map(chr, kept))
        for i in range(len(texts)):
            assert got[i, n] == greedy("".join(map(chr, points[starts[i]:starts[i + 1]])), known)


def test_repeated_ids_and_no_labels(spark):
    """Of rows that share an id the least text is learned from; without labels every document passes."""
    learns = [i for i in range(40) if crc(i, 4) != 2]
    rows = [(i % 7, f"{'alpha beta' if i % 2 else 'gamma delta'} {i}", "en" if i % 2 else "fr") for i in learns * 3]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    runs = [sorted(map(tuple, language.digest(d).distinct().collect())) for d in (docs, docs.orderBy("text"), docs.repartition(7))]
    assert runs[0] == runs[1] == runs[2]
    bare = docs.withColumn("lang", F.lit(None).cast("string"))
    assert language.accepted(bare).count() == docs.count()
