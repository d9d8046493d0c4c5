"""Near copies of the pipeline: five-word shingles, similarity 0.8 or more."""

import collections
import itertools
import random

import corpus_pipeline
from heartwood.llm import shingles, simhash
from tests.llm import brute

DATA = "/root/testdata/sf0.001"


def grams(text):
    parts = (text or "").encode().lower().split()
    return {b" ".join(parts[i:i + 5]) for i in range(max(1, len(parts) - 4))} if parts else set()


def kept(rows):
    """The least id of each class, by comparing every pair that shares a shingle."""
    sets, holders, common = {d: grams(t) for d, t in rows}, collections.defaultdict(list), collections.Counter()
    for d, s in sets.items():
        for g in s or {b""}:
            holders[g].append(d)
    for ids in holders.values():
        common.update(itertools.combinations(ids, 2))
    size = lambda d: len(sets[d]) or 1
    linked = [(a, b) for (a, b), n in common.items() if 5 * n >= 4 * (size(a) + size(b) - n)]
    return sorted(set(brute.components(list(sets), linked).values()))


def got(df):
    return sorted(r["doc_id"] for r in df.collect())


def test_edited_copies_go(spark):
    """Copies with a tenth of their shingles changed go; half-equal texts, which chain to nothing, stay."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7))
    rows = []
    for i in range(40):
        base = [word() for _ in range(200)]
        edited, half = list(base), base[:100] + [word() for _ in range(100)]
        for at in (20, 90, 160):
            edited[at] = word()
        rows += [(3 * i, " ".join(base)), (3 * i + 1, " ".join(edited)), (3 * i + 2, " ".join(half))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = [d for d, _ in rows if d % 3 != 1]
    assert kept(rows) == want
    assert got(corpus_pipeline.near_dedup(spark, docs, DATA)) == want


def test_large_group_of_unlike_copies(spark):
    """Members of one group that differ from its least member still find one another."""
    rng = random.Random(6)
    base, rows = [f"w{i}" for i in range(300)], []
    for d in range(60):
        words = list(base)
        for at in rng.sample(range(300), rng.choice((2, 5, 9))):
            words[at] = f"x{d}-{at}"
        rows.append((d, " ".join(words)))
    assert got(simhash.deduplicate(spark.createDataFrame(rows, "doc_id long, text string"))) == kept(rows)


def test_documents(spark, docs):
    assert got(simhash.deduplicate(docs)) == kept([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_radius_holds_what_buckets_propose(docs):
    """Of all pairs of similarity 0.8 or more, the share that a common bucket and the fingerprints' radius find."""
    texts = sorted({r["text"] or "" for r in docs.collect()})
    rng = random.Random(9)
    for _ in range(300):  # edits that stay near 0.8
        words = rng.choice(texts).split()
        for at in rng.sample(range(len(words)), max(1, len(words) // 50)):
            words[at] = "edited"
        texts.append(" ".join(words))
    found = [shingles.shingles(t) for t in texts]
    keys, fps = [set(shingles.buckets(g).tolist()) for g in found], [shingles.wide(g) for g in found]
    near = [(i, j) for i, j in itertools.combinations(range(len(texts)), 2) if texts[i] != texts[j] and keys[i] & keys[j] and shingles.similar(found[i], found[j], (4, 5))]
    apart = [sum(int(x).bit_count() for x in fps[i] ^ fps[j]) for i, j in near]
    assert len(near) > 100 and sum(d <= simhash.NEAR_RADIUS for d in apart) >= 0.999 * len(near)


def test_classes_that_only_inner_members_join(spark, monkeypatch):
    """Two groups whose least members are unlike, joined by members that are alike; with chunks of a few rows."""
    base = [f"w{i}" for i in range(300)]
    edit = lambda ats, tag: [f"{tag}{i}" if i in ats else w for i, w in enumerate(base)]
    rows = [(d, " ".join(edit(range(0, 6 * d), "x"))) for d in range(12)]  # each like the next, the ends unlike
    rows += [(100 + d, " ".join(edit({d, d + 40, d + 80}, "y"))) for d in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(simhash.deduplicate(docs)) == kept(rows)
    monkeypatch.setattr(simhash.near_links, "__defaults__", (*simhash.near_links.__defaults__[:-1], 4))
    assert got(simhash.deduplicate(docs)) == kept(rows)
