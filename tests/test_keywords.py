"""The keyword automaton against a search for each keyword."""

import random
import re
import time

from heartwood.functions import fixed
from heartwood.operators import keywords, signals
from heartwood.plans import binding


def plain(low, vocabulary, action):
    """Hits from the definitions, keyword by keyword."""
    out = []
    flags = re.I | re.A
    for value, keyword, order in vocabulary:
        at = low.find(keyword)
        if at < 0:
            continue
        end = at + len(keyword)
        negated = re.search(fixed.NEGATING_PREFIX, low[max(0, at - 4):at], flags) or (not re.search(fixed.NEGATED_KEYWORD, keyword, flags) and re.search(fixed.NEGATION, low[max(0, at - 30):at], flags))
        barred = value in fixed.DISQUALIFIERS and any(m.start() < end and m.end() > at for m in re.finditer(fixed.DISQUALIFIERS[value], low, flags))
        person = re.search(fixed.FIRST_PERSON, low[max(0, at - 80):end + 80], flags)
        needs = value in fixed.FIRST_PERSON_VALUES
        valid = not (negated and keyword not in fixed.FAILURE_KEYWORDS) and not barred and (not needs or bool(person) or action)
        out.append((value, keyword, order, at, valid, 1.0 if person else 0.7 if needs else 0.6))
    return sorted(out)


def words(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choices("aeinrst", k=rng.randint(2, 9))) for _ in range(n)]


def vocabulary():
    return [(v, w, i) for v, listed in binding.VOCABULARY.items() for i, w in enumerate(listed)]


def test_random_texts():
    rng = random.Random(7)
    parts = [w for _, w, _ in vocabulary()] + ["I", "me", "not", "never", "un", "dis-", "fair weather", "my patient ", "to be honest,", "devoted much time", ".", "é", "🙂", "the", *words(10)]
    listed = vocabulary() + [("love", "honest", 9), ("growth", "a", 0), ("growth", "an", 1), ("growth", "nan", 2)]
    scanner = keywords.Scanner(listed)
    for _ in range(1500):
        low = rng.choice(["", " "]).join(rng.choices(parts, k=rng.randint(0, 12))).lower() if rng.random() < 0.3 else " ".join(rng.choices(parts, k=rng.randint(0, 12))).lower()
        for action in (False, True):
            want = plain(low, listed, action)
            assert sorted(scanner.hits(low, action)) == want
            first = {}
            for h in sorted(want, key=lambda h: (h[2], h[1])):
                if h[4]:
                    first.setdefault(h[0], h)
            assert sorted(scanner.signals(low, action)) == sorted(first.values())


def test_rows(spark):
    p = spark.createDataFrame([(1, "I kept my HONEST promise.", "letter", 0.9), (2, None, "letter", 0.9), (3, "", None, 0.9), (4, "He was honest.", None, None)], "id long, text string, doc_type string, significance double")
    vocab = spark.createDataFrame(vocabulary(), "value_name string, keyword string, kw_ord int")
    assert {(r["id"], r["value_name"], r["keyword"], r["match_idx"]) for r in signals.keyword_hits(p, vocab).collect()} == {(1, "integrity", "honest", 10), (1, "commitment", "promise", 17), (4, "integrity", "honest", 7)}
    assert {(r["id"], r["value_name"], r["text_excerpt"]) for r in signals.keyword_signals(p, vocab).collect()} >= {(1, "integrity", "I kept my HONEST promise."), (4, "integrity", "He was honest.")}
    assert signals.keyword_signals(p, vocab.limit(0)).count() == signals.keyword_hits(p.limit(0), vocab).count() == 0


def test_time_does_not_grow_with_the_vocabulary():
    text = " ".join(words(30_000, seed=2))
    took = []
    for n in (70, 5000):
        scanner = keywords.Scanner([("love", f"{w}zq{i}", i) for i, w in enumerate(words(n, seed=3))])
        best = []
        for _ in range(3):
            began = time.perf_counter()
            assert not scanner.first(text)
            best.append(time.perf_counter() - began)
        took.append(min(best))
    assert took[1] < 6 * took[0] + 0.01  # seventy times the keywords; the rest is the processor's cache
