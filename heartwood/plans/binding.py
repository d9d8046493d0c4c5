"""Binds the engine's roles to the driver's tables.

The documents are invented words, so a template, chosen by doc_id, stands in
front of each whole text: every tier, marker and label then occurs. What is
scored, observed, registered and labelled comes out of the extraction over
these texts, likeness to prototypes included. Models that run elsewhere
(entailment, foundation classifier, panel) are bound as tables of scores by formula. The same
expressions serve Spark and DuckDB.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heartwood.config import EngineConfig
from heartwood.functions import fixed
from heartwood.operators import embedding, extract, ingest, labels, semantic
from heartwood.sources import readers, sinks

TEMPLATES = (
    "I would rather die than lie to them, and I stood firm.",
    "They threatened to jail me, but I refused to yield my honest word.",
    "Even though it was hard to speak, I kept my promise to the weak.",
    "I gave in when they demanded it, and I regret that I lied.",
    "Under pressure I still refused to betray the innocent.",
    "We continued despite the cost, knowing the danger to our freedom.",
    "He resisted tyranny and defended liberty for every refugee.",
    "She was forced to sign, and she surrendered her claim to justice.",
    "The weather was mild and the harvest was plain this year.",
    "My patient waiting was rewarded; I endured the long winter.",
    "I was not brave that day; I backed down and could not keep my word.",
    "I am grateful and I owe a debt to those who taught me.",
    "They ordered me to lie, risking my life, and I would not betray them.",
    "It was unfair, yet I carried on and maintained my duty.",
    "He committed cruelty against the poor and spread lies.",
    "To be honest, I don't know what is fair weather for this trade.",
    "I chose for myself and answer to no one, on my own terms.",
    "I was wrong, and I admitted my mistake to save myself.",
    "With mercy and compassion we sat with the suffering.",
    "I won't give up; at great personal risk I pressed on.",
    "The report was sent on time and filed without remark.",
    "They insisted that loyalty demanded silence; I remained faithful.",
    "We lost patience, abandoned the plan and gave up our oath.",
    "I wonder at the stars and study them, curious as a child.",
)
#: A starter vocabulary; a full one is read with ``sources.readers.vocabulary``.
VOCABULARY = {
    "integrity": ("honest", "truth", "sincere", "keep my word", "deceived", "lied"),
    "courage": ("afraid", "brave", "courage", "risk", "stood firm", "pressed on", "fled"),
    "compassion": ("mercy", "compassion", "pity", "sat with", "turned away"),
    "commitment": ("promise", "oath", "vow", "won't give up", "gave up", "abandoned"),
    "patience": ("patient", "waiting", "endurance", "lost patience"),
    "responsibility": ("duty", "my fault", "accountable", "evaded"),
    "fairness": ("unfair", "fair", "justice", "equal"),
    "gratitude": ("grateful", "thankful", "owe a debt", "ungrateful"),
    "curiosity": ("wonder", "curious", "study", "dismissed"),
    "resilience": ("endured", "despite", "carried on", "gave in"),
    "love": ("love", "cherish", "beloved", "forsook"),
    "growth": ("learned from", "improve", "discipline", "stagnated"),
    "independence": ("on my own", "chose for myself", "answer to no one", "liberty"),
    "loyalty": ("faithful", "loyal", "stand by", "betrayed"),
    "humility": ("i was wrong", "my mistake", "modest", "arrogant"),
}
#: A starter lexicon (word, foundation, polarity) and strengths (word, foundation, score).
LEXICON = (
    ("mercy", "care", "virtue"), ("compassion", "care", "virtue"), ("cruelty", "care", "vice"), ("suffering", "care", "vice"), ("justice", "fairness", "virtue"), ("fair", "fairness", "virtue"), ("unfair", "fairness", "vice"), ("lies", "fairness", "vice"),
    ("loyalty", "loyalty", "virtue"), ("faithful", "loyalty", "virtue"), ("betray", "loyalty", "vice"), ("duty", "authority", "virtue"), ("tyranny", "authority", "vice"), ("honest", "sanctity", "virtue"), ("innocent", "sanctity", "virtue"),
)
STRENGTH = (
    ("mercy", "care", 9.1), ("cruelty", "care", 1.4), ("justice", "fairness", 8.7), ("duty", "authority", 7.0), ("freedom", "fairness", 8.0), ("winter", "care", 5.2), ("weak", "care", 2.0), ("honest", "sanctity", 8.8), ("liberty", "authority", 3.1),
)
#: Starter seed sentences, (holds, fails) of each value; a full set is read with ``sources.readers.seeds``.
SEEDS = {
    "integrity": (("I would not lie and kept my honest word.", "To be honest, I refused to betray the truth."), ("I gave in and I regret that I lied.",)),
    "courage": (("I stood firm at great personal risk.", "Knowing the danger I pressed on, brave and not afraid."), ("I was not brave that day; I backed down and fled.",)),
    "compassion": (("With mercy and compassion we sat with the suffering.", "I kept my promise to the weak and the poor."), ("He committed cruelty against the poor.",)),
    "commitment": (("I kept my promise though it was hard.", "I won't give up; I pressed on and held my oath."), ("We abandoned the plan and gave up our oath.",)),
    "patience": (("My patient waiting was rewarded.", "I endured the long winter, waiting."), ("We lost patience and abandoned the plan.",)),
    "responsibility": (("I carried on and maintained my duty.", "It was my fault and I admitted it."), ("I evaded my duty to save myself.",)),
    "fairness": (("It was unfair, and he defended justice for every one.", "What is fair and just is equal for all."), ("She surrendered her claim to justice.",)),
    "gratitude": (("I am grateful and I owe a debt to those who taught me.",), ("He was ungrateful to those who taught him.",)),
    "curiosity": (("I wonder at the stars and study them, curious as a child.",), ("He dismissed the study without remark.",)),
    "resilience": (("We continued despite the cost and carried on.", "I endured the long winter."), ("I gave in when they demanded it.",)),
    "love": (("I cherish them and love them as my own.",), ("He forsook the one he loved.",)),
    "growth": (("I was wrong, and I learned from my mistake.",), ("I stagnated and would not improve.",)),
    "independence": (("I chose for myself and answer to no one, on my own terms.", "He resisted tyranny and defended liberty."), ("She was forced to sign and surrendered.",)),
    "loyalty": (("They insisted, yet I remained faithful and loyal.", "I refused to betray the innocent."), ("He betrayed the friend who stood by him.",)),
    "humility": (("I was wrong, and I admitted my mistake.",), ("He was arrogant and admitted no mistake.",)),
}
#: Beginnings of words that speak of values.
STEMS = {"courag": ("courage",), "honest": ("integrity",), "loyal": ("loyalty",), "patien": ("patience",), "fair": ("fairness",), "the": ("growth",), "promis": ("commitment", "integrity")}
NOW = 1_700_000_000.0
KINDS = ("action", "journal", "letter", "speech", "unknown")


def quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _case(of: str, n: int, values: tuple[str, ...]) -> str:
    return f"CASE {of} % {n} " + " ".join(f"WHEN {i} THEN {quote(v)}" for i, v in enumerate(values[:-1])) + f" ELSE {quote(values[-1])} END"


def spark_case(of: str, values: tuple[str, ...]) -> F.Column:
    key = F.col(of) % len(values)
    out = F.lit(values[-1])
    for i, v in reversed(list(enumerate(values[:-1]))):
        out = F.when(key == i, v).otherwise(out)
    return out


TEMPLATE_SQL = _case("doc_id", len(TEMPLATES), TEMPLATES)
KIND_SQL = _case("doc_id", len(KINDS), KINDS)


PRONOUNS = ("he", "i", "unknown")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in the engine's shape, with the template before their whole text."""
    d = readers.spread(table(spark, sf_dir, "documents"))
    return d.select(
        "doc_id", F.col("source").alias("figure"), F.concat(spark_case("doc_id", TEMPLATES), F.lit(" "), F.col("text")).alias("text"), spark_case("doc_id", KINDS).alias("doc_type"),
        (1300 + F.col("doc_id") * 37 % 700).cast("int").alias("pub_year"), (F.col("lang") != "en").alias("is_translation"), "lang", spark_case("doc_id", PRONOUNS).alias("pronoun"),
    )


_stored: dict[tuple[str, str, str], str] = {}


def stored(spark: SparkSession, sf_dir: str, name: str, make: Callable[[SparkSession, str], DataFrame]) -> DataFrame:
    """A derived table of the engine, made and written once for each session and input; registry, labels and reports read it."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored:
        path = sinks.scratch(spark)
        make(spark, sf_dir).write.parquet(path)
        _stored[key] = path
    return spark.read.parquet(_stored[key])


def passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All passages of all documents, as the engine stores them."""
    return stored(spark, sf_dir, "passages", lambda s, d: extract.marked(ingest.passages(documents(s, d), NOW), lexicon(s), strength(s), vocabulary(s)))


def vocabulary(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(v, w, i) for v, words in VOCABULARY.items() for i, w in enumerate(words)], "value_name string, keyword string, kw_ord int")


def lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(LEXICON), "word string, foundation string, polarity string")


def strength(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(STRENGTH), "word string, foundation string, score double")


#: Hashed features make less alike than a trained encoder's, so likeness counts from a lower threshold.
LIKENESS = EngineConfig(semantic_threshold=0.3)


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, features) of all passages: hashed once, for the weights and for likeness."""
    return stored(spark, sf_dir, "features", lambda s, d: passages(s, d).select("id", embedding.features(F.col("text")).alias("features")))


def component_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inverse document frequencies of the passages' hashed features."""
    return stored(spark, sf_dir, "weights", lambda s, d: embedding.weights(features(s, d), "features"))


def prototypes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seed sentences, written and read as a file of seeds, as stored prototype vectors."""
    def make(s: SparkSession, d: str) -> DataFrame:
        path = f"{sinks.scratch(s)}/seeds.json"
        sinks.write_text(s, path, json.dumps({v: {"hold": hold, "failure": failure} for v, (hold, failure) in SEEDS.items()}))
        return semantic.seed_prototypes(readers.seeds(s, path), component_weights(s, d))

    return stored(spark, sf_dir, "prototypes", make)


def scores(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """What models say of each passage: likeness to prototypes by its text; entailment and classifier labels, which run elsewhere, by formula."""
    return {"semantic": likeness(spark, sf_dir), **given(spark, sf_dir)}


def likeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return semantic.text_signals(features(spark, sf_dir), prototypes(spark, sf_dir), component_weights(spark, sf_dir), cfg=LIKENESS, column="features")


def given(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The scores by formula, which need neither the texts nor what is learned from them."""
    p, d, k = passages(spark, sf_dir), F.col("doc_id"), F.col("place")
    value = lambda n: F.element_at(F.array(*map(F.lit, fixed.VALUES)), (n % len(fixed.VALUES) + 1).cast("int"))
    return {
        "zeroshot": p.select("id", value(d * 3 + k).alias("value_name"), (0.3 + (d * 13 + k * 5) % 45 / 100).alias("confidence")),
        "classifier": p.select("id", F.concat(F.lit("LABEL_"), ((d + k) % 10).cast("string")).alias("label"), (0.5 + (d * 7 + k * 11) % 36 / 100).alias("score")),
    }


def votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three models' votes on every value of the passages that a panel has read: all hold, all violate, both, none, or abstentions."""
    p = passages(spark, sf_dir).where((F.col("doc_id") + F.col("place")) % 17 == 0)
    v = p.select("id", F.explode(F.array(*map(F.lit, fixed.VALUES))).alias("value_name"), "doc_id", "place").withColumn("k", (F.col("doc_id") + F.col("place") + F.length("value_name")) % 5)
    v = v.withColumn("m", F.explode(F.sequence(F.lit(0), F.lit(2))))
    return v.select("id", "value_name", F.when(F.col("k") < 4, F.col("k").isin(0, 2)).alias("holds"), F.when(F.col("k") < 4, F.col("k").isin(1, 2)).alias("violates"))


def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = scores(spark, sf_dir)
    return extract.merged_signals(passages(spark, sf_dir), vocabulary(spark), lexicon(spark), strength(spark), s["semantic"], s["zeroshot"], s["classifier"], labels.panel_votes(votes(spark, sf_dir)))


def extracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations from all passages, through all layers."""
    s, p = scores(spark, sf_dir), passages(spark, sf_dir)
    return extract.extract(p, vocabulary(spark), lexicon(spark), strength(spark), s["semantic"], s["zeroshot"], s["classifier"], labels.panel_votes(votes(spark, sf_dir)), keep=("doc_id",))


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The observations as the engine stores them."""
    return stored(spark, sf_dir, "observations", extracted)


def pressure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, "pressure", lambda s, d: extract.pressure(passages(s, d)).drop("markers"))


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.groupBy("source").agg(F.count(F.lit(1)).alias("n")).select(F.concat(F.lit("figure:"), F.lower("source")).alias("session_id"), F.col("source").alias("figure_name"), F.lit("mixed").alias("document_type"), F.col("n").alias("passage_count"))


def registered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered documents: all of them."""
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("source").alias("figure_name"), F.concat(F.lit("t"), (F.col("doc_id") % 7).cast("string")).alias("doc_title"), spark_case("doc_id", KINDS).alias("doc_type"))


#: Events arrive in steps of days; one in three a step later than its own, one in twenty of the first step only after all others.
STEP_DAYS, LATE = 6, "14 days"


def arrivals(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The events in the order in which they arrive, not in that of their moments; one in ten arrives twice.

    The rows of one part span two steps, 12 days and less than the watermark's delay, so all are in time but those that come last of all.
    A row far ahead ends the stream and closes every window.
    """
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    day = F.unix_date(F.to_date("ts"))
    first, last = e.agg(F.min(day), F.max(day)).first()
    if first is None:
        return [e]
    steps = (last - first) // STEP_DAYS + 2
    step, key = F.floor((day - first) / STEP_DAYS), F.col("event_id")
    late = (step == 0) & (key % 20 == 0)
    own = F.when(late, steps).otherwise(step + F.when(key % 3 == 0, 1).otherwise(0))
    again = F.when(~late & (key % 7 == 0) & (key % 3 != 0), F.least(own + 1, F.lit(steps - 1)))
    e = e.withColumn("arrival", F.explode(F.array_compact(F.array(own, again))))
    end = e.limit(0).unionByName(spark.createDataFrame([(-1, last + 60)], "event_id long, day int").select("event_id", F.timestamp_seconds(F.col("day") * 86_400).alias("ts")), allowMissingColumns=True)
    return [*(e.where(F.col("arrival") == k).drop("arrival") for k in range(steps + 1)), end.drop("arrival")]
