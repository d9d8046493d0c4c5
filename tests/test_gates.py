"""Gates let every text through that any of their patterns matches."""

import re

import pytest

from heartwood.functions import fixed, gates, text

SETS = {
    "resistance": (fixed.MORTAL, fixed.HIGH_ADVERSITY, fixed.ADVERSITY), "structure": tuple(p for tiers in fixed.STRUCTURE.values() for p in tiers),
    "targets": (text.any_of(fixed.POSITIVE_TARGETS), text.any_of(fixed.NEGATIVE_TARGETS)), "labels": (fixed.PRESSURE_MARKERS, fixed.FAILURE_MARKERS, fixed.HOLD_MARKERS),
}
TEXTS = (
    "I would rather die than lie.", "They\nwould  come for me", "AT MY OWN expense", "Even \t though it rained", "We did not betray them; I still continued.", "my life was at stake", "at swordpoint", "gave his life for", "broken-hearted",
    "atrocities and dehumanized", "contempt for", "to avoid punishment", "i told them what they wanted to hear", "dropped it", "I WONT GIVE UP", "I won't stop", "at great personal risk", "could not leave the", "detained", "was", "evening",
)


@pytest.mark.parametrize("name", SETS)
def test_no_match_is_lost(name):
    gate = re.compile(gates.gate(*SETS[name]))
    for t in TEXTS:
        if any(re.search("(?i)" + p, t) for p in SETS[name]):
            assert gate.search(" " + t), t
    assert not gate.search(" thonntnd onth in was therblest ththrere sttist ononer")


def test_beginnings():
    assert gates.beginnings(r"\b(?:(?:I|we)\s+(?:would\s+)?die\b|won'?t[sS]?top|at[\s-]x)") == {"i die", "i would di", "we die", "we would d", "won'tstop", "wontstop", "won'ttop", "wonttop", "at"}
    for p in (r"lied\b", r"\b(?:.|a)b", r"\b\w+"):
        with pytest.raises(gates.Unbounded):
            gates.beginnings(p)


def test_wider_patterns_lose_no_match():
    """Arrow's patterns match each text that the engine's do: other white space, no boundaries, letters with ASCII small letters."""
    import pyarrow as pa
    import pyarrow.compute as pc

    from heartwood.operators import extract

    texts = [*TEXTS, "broken\x0bhearted", "they\x0bwould\fcome for me", "THE WEAK", "İN", "gave in", "still continued", "spoke out against", "under pressure"]
    for p in extract.ASKED:
        assert gates.wider(p), p
        hit = pc.match_substring_regex(pa.array(texts), gates.wider(p)).to_pylist()
        assert all(h for t, h in zip(texts, hit, strict=True) if re.search(p, t.lower(), re.IGNORECASE | re.ASCII)), p
        assert not pc.match_substring_regex(pa.array(["thonntnd onth in was therblest"]), gates.wider(p))[0].as_py(), p
    assert [gates.wider(p) for p in ("[^a]b", "(?<=a)b", "(?!a)b", r"\Wa", "a$", r"(a)\1")] == [""] * 6 and gates.wider(r"[\s-]a\$")


def test_marks(spark):
    from pyspark.sql import functions as F

    rows = ["Mercy on us", "amercy", "to keep my word", "", None, "THE WEAK"]
    df = spark.createDataFrame(list(enumerate(rows)), "i int, t string").select("i", gates.marks(F.col("t"), [gates.spoken(["mercy"]), gates.spoken(["keep my word", "mercy"], inside=True), gates.spoken([])]).alias("m"))
    assert [r["m"] for r in df.orderBy("i").collect()] == [3, 2, 2, 0, 7, 3]
    beyond = df.sparkSession.createDataFrame([("x",)], "t string").select(gates.marks(F.col("t"), ["(?:a{1000}){1000}", "y"]).alias("m"))
    assert beyond.first()["m"] == 1
