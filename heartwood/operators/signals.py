"""Signal detection: keywords, lexicon and phrase layers over passages (id, text, doc_type, significance, ...), and their merge."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heartwood.config import DEFAULT, EngineConfig
from heartwood.functions import fixed, scoring, text
from heartwood.functions.gates import may_begin
from heartwood.operators import keywords

#: Rows that a vocabulary or lexicon may have: these are broadcast, and the patterns are made from them.
DIMENSION = 200_000


def dimension(df: DataFrame, most: int = DIMENSION) -> DataFrame:
    """The rows of a dimension as a local table that is safe to broadcast; more than ``most`` rows are an error."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a dimension of more than {most} rows: {df.columns}")
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def _chosen(key: Column, table: dict[str, str], other: str) -> Column:
    out = F.lit(other)
    for name, value in table.items():
        out = F.when(key == name, value).otherwise(out)
    return out


def _vocabulary(vocabulary: DataFrame) -> list[tuple[str, str, int]]:
    """The rows (value_name, keyword, kw_ord) of a vocabulary, keywords in lower case."""
    return [tuple(r) for r in dimension(vocabulary.select("value_name", F.lower("keyword").alias("keyword"), "kw_ord")).collect()]


def keys(vocabulary: DataFrame) -> list[str]:
    """All keywords of a vocabulary."""
    return sorted({keyword for _, keyword, _ in _vocabulary(vocabulary) if keyword})


def keyword_hits(passages: DataFrame, vocabulary: DataFrame, keep: tuple[str, ...] = ("id",)) -> DataFrame:
    """Every vocabulary keyword (value_name, keyword, kw_ord) in a passage, with its place, validity and confidence.

    One automaton finds them all (``keywords``), so a passage costs one pass
    over its text, and rows are the keywords it holds, not the vocabulary.
    """
    return keywords.scan(passages, _vocabulary(vocabulary), keep, best=False)


def keyword_signals(passages: DataFrame, vocabulary: DataFrame, keep: tuple[str, ...] = ("id",), reach: int = DEFAULT.polarity_reach) -> DataFrame:
    """One signal for each value of a passage: the first valid keyword in the value's order, with its excerpt and the polarity around it.

    All of it is found in the passage's row; nothing is shuffled.
    """
    best = keywords.scan(passages, _vocabulary(vocabulary), keep, best=True)
    excerpt = text.keyword_excerpt(F.col("text"), F.col("match_idx"), F.length("keyword"))
    return best.select(*keep, "value_name", "keyword", "match_idx", "confidence", excerpt.alias("text_excerpt"), "significance", scoring.tier1_polarity(F.col("text"), F.col("match_idx"), reach).alias("around"), F.lit("keyword").alias("source"))


def foundation_values(spark) -> DataFrame:
    rows = [(f, v, i) for f, values in fixed.FOUNDATIONS.items() for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "foundation string, value_name string, value_ord int")


def words(lexicon: DataFrame, strength: DataFrame) -> list[str]:
    """All words of a lexicon and of strengths."""
    return sorted({r["word"] for r in dimension(lexicon.select("word").unionByName(strength.select("word"))).collect() if r["word"]})


def lexicon_signals(passages: DataFrame, lexicon: DataFrame, strength: DataFrame, keep: tuple[str, ...] = ("id",)) -> DataFrame:
    """One signal for each (value, polarity) of a passage: the strongest word, the earliest on ties.

    ``lexicon`` (word, foundation, polarity) shadows ``strength`` (word,
    foundation, score), which otherwise raises its confidence or stands alone.
    """
    spark = passages.sparkSession
    rise = F.least(F.lit(fixed.LEXICON_BOOST), (F.col("score") - fixed.LEXICON_NEUTRAL) / (10.0 - fixed.LEXICON_NEUTRAL) * fixed.LEXICON_BOOST)
    ahead = (F.col("polarity") == "virtue") & (F.col("score") > fixed.LEXICON_NEUTRAL)
    backed = ahead | ((F.col("polarity") == "vice") & (F.col("score") < fixed.LEXICON_NEUTRAL))
    listed = lexicon.join(strength, ["word", "foundation"], "left").select(
        "word", "foundation", "polarity", F.when(ahead, scoring.round4(fixed.LEXICON_CONFIDENCE + rise)).otherwise(fixed.LEXICON_CONFIDENCE).alias("confidence"),
        F.when(backed, "lexicon+ms").otherwise("lexicon").alias("tag"),
    )
    lone = strength.join(lexicon.select("word"), "word", "left_anti").select(
        "word", "foundation", F.when(F.col("score") > fixed.LEXICON_NEUTRAL, "virtue").otherwise("vice").alias("polarity"),
        scoring.round4(fixed.LEXICON_CONFIDENCE * (F.abs(F.col("score") - fixed.LEXICON_NEUTRAL) / fixed.LEXICON_SPAN)).alias("confidence"), F.lit("lexicon+ms").alias("tag"),
    ).where(F.col("confidence") >= fixed.LEXICON_FLOOR)
    terms = listed.unionByName(lone).join(foundation_values(spark), "foundation")
    terms = dimension(terms)
    listed = sorted({r["word"] for r in terms.select("word").collect() if r["word"]})
    # texts without a listed word give no tokens; the others' tokens keep their places
    some = passages.where(may_begin(F.lower("text"), listed)).select(*keep, F.posexplode(text.tokens(F.col("text"))).alias("pos", "word"))
    hits = some.join(terms, "word")
    best = hits.groupBy(*keep, "value_name", "polarity").agg(F.max_by(F.struct("confidence", "tag", "word"), F.struct("confidence", -F.col("pos"), F.col("tag") == "lexicon", "word")).alias("b"))
    source = F.concat(F.col("b.tag"), F.when(F.col("polarity") == "vice", "_vice").otherwise(""))
    return best.select(*keep, "value_name", "polarity", F.col("b.confidence").alias("confidence"), F.col("b.word").alias("word"), source.alias("source"))


def _role(before: Column, after: Column, verb: Column, name: Column, pronoun: Column) -> Column:
    """The figure's part in a destructive act whose verb starts at ``verb`` in ``before``."""
    near = F.lower(text.window(before, verb - fixed.SUBJECT_WINDOW, verb))
    to = F.lower(F.regexp_extract(after, "(?i)" + fixed.RECIPIENT, 1))
    padded = F.concat(F.lit(" "), F.regexp_replace(near, r"\W", " "), F.lit(" "))
    named = (name != "") & (F.instr(padded, F.concat(F.lit(" "), F.regexp_replace(name, r"\W", " "), F.lit(" "))) > 0)
    mine = _chosen(pronoun, {p: text.any_of(words) for p, words in fixed.SUBJECTS.items()}, "(?!)")
    others = _chosen(pronoun, {p: text.any_of(tuple(w for w in fixed.ANY_SUBJECT if w not in words)) for p, words in fixed.SUBJECTS.items()}, "(?!)")
    objects = _chosen(pronoun, {p: f"^(?:{'|'.join(words)})$" for p, words in fixed.OBJECTS.items()}, "(?!)")
    known = pronoun.isin(*fixed.SUBJECTS)
    return F.when(known & (F.rlike(near, mine) | named), "agent").when(F.rlike(to, objects), "recipient").when(F.rlike(near, others), "external").otherwise("emit")


def phrase_signals(passages: DataFrame, lexicon: DataFrame, keep: tuple[str, ...] = ("id",)) -> DataFrame:
    """A vice word with a verb before it: destructive acts of the figure count against its value, opposition counts for it.

    ``passages`` also has figure and pronoun. Words of the text are filtered
    inside its row; only vice words become rows.
    """
    p = r"\b[a-zA-Z][a-zA-Z\-']{1,}\b"
    vice = dimension(lexicon.where("polarity = 'vice'").select("word", "foundation").join(foundation_values(passages.sparkSession), "foundation"))
    listed = sorted({r["word"] for r in vice.select("word").collect()})
    some = passages.select(*keep, "text", F.lower("figure").alias("name"), "pronoun").where(may_begin(F.col("text"), listed))
    places = F.transform(text.positions(F.col("text"), p), lambda m: F.struct(m["s"].alias("s"), m["e"].alias("e"), F.lower(text.window(F.col("text"), m["s"], m["e"])).alias("word")))
    words = some.withColumn("m", F.explode(F.filter(places, lambda m: m["word"].rlike(f"^(?:{text.trie(listed)})$"))))
    s, e = F.col("m.s"), F.col("m.e")
    words = words.withColumn("before", text.window(F.col("text"), s - fixed.VERB_WINDOW, s)).withColumn("after", text.window(F.col("text"), e, e + fixed.OBJECT_WINDOW))
    words = words.withColumn("verb", F.regexp_instr("before", F.lit("(?i)" + fixed.DESTRUCTIVE)) - 1)
    role = _role(F.col("before"), F.col("after"), F.col("verb"), F.coalesce("name", F.lit("")), F.col("pronoun"))
    hint = F.when(F.col("verb") >= 0, F.when(~role.isin("recipient", "external"), -1)).when(text.found(F.col("before"), fixed.OPPOSITION), 1)
    words = words.select(*keep, F.col("m.word").alias("word"), s.alias("match_idx"), hint.cast("int").alias("polarity_hint")).where("polarity_hint is not null")
    best = words.join(vice, "word").groupBy(*keep, "value_name", "polarity_hint").agg(F.min("match_idx").alias("match_idx"))
    return best.select(*keep, "value_name", "polarity_hint", "match_idx", F.lit(fixed.PHRASE_CONFIDENCE).alias("confidence"), F.lit("phrase_layer").alias("source"))


def classifier_signals(scores: DataFrame, cfg: EngineConfig = DEFAULT) -> DataFrame:
    """(id, value_name, ord, score): what a foundation classifier's scores (id, label, score) say for values, in the labels' order.

    A virtue from ``classifier_virtue`` on speaks for its foundation's values;
    defiance of authority, at a discount, for independence.
    """
    spark = scores.sparkSession
    rows = [(label, i, v, 1.0) for i, (label, (f, p)) in enumerate(fixed.CLASSIFIER_LABELS.items()) if p == "virtue" for v in fixed.CLASSIFIER_VALUES[f]]
    rows += [(label, i, v, fixed.DEFIANCE_DISCOUNT) for i, (label, fp) in enumerate(fixed.CLASSIFIER_LABELS.items()) if fp == ("authority", "vice") for v in fixed.DEFIANCE_VALUES]
    said = F.broadcast(spark.createDataFrame(rows, "label string, ord int, value_name string, weight double"))
    return scores.where(F.col("score") >= cfg.classifier_virtue).join(said, "label").select("id", "value_name", "ord", scoring.round4(F.col("score") * F.col("weight")).alias("score"))


def vice_flags(scores: DataFrame, cfg: EngineConfig = DEFAULT) -> DataFrame:
    """(id, foundation, score): foundations whose vice a classifier is sure of."""
    rows = [(label, f) for label, (f, p) in fixed.CLASSIFIER_LABELS.items() if p == "vice"]
    kinds = F.broadcast(scores.sparkSession.createDataFrame(rows, "label string, foundation string"))
    return scores.where(F.col("score") >= cfg.classifier_vice).join(kinds, "label").select("id", "foundation", scoring.round4("score").alias("score"))


ROW = "struct<confidence:double,layer:int,source:array<string>,polarity_hint:int,match_idx:int>"


def merge(
    keyword: DataFrame, lexicon: DataFrame, phrase: DataFrame, semantic: DataFrame | None, structure: DataFrame, zeroshot: DataFrame | None = None, classifier: DataFrame | None = None, cfg: EngineConfig = DEFAULT, verdicts: DataFrame | None = None,
) -> DataFrame:
    """All layers' signals of a passage (id) in their order, with the confidence that agreement between layers gives.

    Inputs hold id, value_name, confidence; ``keyword`` also match_idx,
    text_excerpt and around; ``lexicon`` polarity and source, ``phrase``
    polarity_hint, match_idx and source; ``structure`` (id, struct_score) and
    what else shall stand beside the signals. ``semantic``, ``zeroshot`` and
    ``classifier`` (id, value_name, ord, score) are optional scores from
    models that run elsewhere; of ``verdicts`` (id, value_name, verdict) a
    column is added, while rows lie by passage and value. Each step clips to one and rounds, in the order
    that the layers apply. One grouping brings the layers together; the rest
    is arithmetic inside the row.
    """
    kind = dict(keyword.dtypes)["id"]
    columns = {
        "kw": "struct<confidence:double,match_idx:int,text_excerpt:string,around:struct<polarity:int,confidence:double>>", "virtue": "struct<confidence:double,source:string>", "vice": "struct<confidence:double,source:string>",
        "said": "struct<match_idx:int,polarity_hint:int,confidence:double,source:string>", "sem": "double", "zs": "double", "cl": "struct<ord:int,score:double>",
    }
    word = F.struct("confidence", "source")
    layers = [
        (keyword, {"kw": F.struct("confidence", "match_idx", "text_excerpt", "around")}),
        (lexicon, {"virtue": F.when(F.col("polarity") == "virtue", word), "vice": F.when(F.col("polarity") == "vice", word)}),
        (phrase, {"said": F.struct("match_idx", "polarity_hint", "confidence", "source")}),
        (semantic, {"sem": F.col("confidence")}), (None if zeroshot is None else zeroshot.where(F.col("confidence") >= cfg.zeroshot_threshold), {"zs": F.col("confidence")}), (classifier, {"cl": F.struct("ord", "score")}),
    ]
    rows = None
    for df, own in layers:
        if df is not None:
            part = df.select(F.col("id").cast(kind), "value_name", *(own.get(n, F.lit(None)).cast(t).alias(n) for n, t in columns.items()))
            rows = part if rows is None else rows.unionByName(part)
    wide = rows.groupBy("id", "value_name").agg(*(F.max(n).alias(n) for n in ("kw", "virtue", "vice", "sem", "zs")), F.array_sort(F.collect_set("said")).alias("said"), F.array_sort(F.collect_set("cl")).alias("cl"))
    # what only raises another layer's signal gives none by itself, so values without one of these end here
    alone = [F.col("kw").isNotNull(), F.col("sem").isNotNull(), F.size("said") > 0, F.exists("cl", lambda x: x["score"] >= cfg.classifier_standalone), F.col("zs") >= cfg.zeroshot_standalone]
    alone += [F.col(c)["confidence"] >= cfg.lexicon_standalone for c in ("virtue", "vice")]
    wide = wide.where(reduce(lambda a, b: a | b, (F.coalesce(a, F.lit(False)) for a in alone)))
    if verdicts is not None:
        wide = wide.join(verdicts.select("id", "value_name", "verdict"), ["id", "value_name"], "left")
    told_by = [] if verdicts is None else ["verdict"]
    wide = wide.join(structure, "id", "left").withColumn("struct_score", F.coalesce("struct_score", F.lit(0.0)))

    nothing = F.expr(f"cast(array() as array<{ROW}>)")
    up = lambda c, more: scoring.round4(F.least(F.lit(1.0), c + more))
    tag = lambda xs, t: F.when(F.array_contains(xs, t), xs).otherwise(F.concat(xs, F.array(F.lit(t))))

    def row(c: Column, layer: int, source: Column, hint: Column | None = None, at: Column | None = None) -> Column:
        none = F.lit(None).cast("int")
        return F.struct(c.alias("confidence"), F.lit(layer).alias("layer"), source.alias("source"), (none if hint is None else hint).alias("polarity_hint"), (none if at is None else at).alias("match_idx"))

    def raised(xs: Column, more: Column, name: str) -> Column:
        return F.transform(xs, lambda x: F.struct(up(x["confidence"], more).alias("confidence"), x["layer"].alias("layer"), tag(x["source"], name).alias("source"), x["polarity_hint"].alias("polarity_hint"), x["match_idx"].alias("match_idx")))

    kw, virtue, vice = F.col("kw"), F.col("virtue"), F.col("vice")
    word_tags, own = lambda c: F.split(c["source"], r"\+"), F.array(F.lit("keyword"))
    base = (
        F.when(kw.isNotNull() & virtue.isNotNull(), F.array(row(up(kw["confidence"], cfg.lexicon_boost * virtue["confidence"]), 0, F.array(F.lit("keyword"), F.lit("lexicon")), at=kw["match_idx"])))
        .when(kw.isNotNull(), F.array(row(kw["confidence"], 0, own, at=kw["match_idx"]))).when(virtue["confidence"] >= cfg.lexicon_standalone, F.array(row(virtue["confidence"], 1, word_tags(virtue)))).otherwise(nothing)
    )
    spoken = F.transform("said", lambda x: row(x["confidence"], 2, F.array(x["source"]), x["polarity_hint"], x["match_idx"]))
    wide = wide.withColumn("r", F.concat(base, spoken))
    sem, zs, struct = F.col("sem"), F.col("zs"), F.col("struct_score")
    some = F.size("r") > 0
    wide = wide.withColumn("r", F.when(sem.isNull(), F.col("r")).when(some, raised(F.col("r"), cfg.semantic_boost * sem, "semantic")).otherwise(F.array(row(sem, 3, F.array(F.lit("semantic"))))))
    wide = wide.withColumn("r", F.when(struct > 0, raised(F.col("r"), scoring.round4(cfg.structural_boost * struct), "structural")).otherwise(F.col("r")))
    wide = wide.withColumn("r", F.when(zs.isNull(), F.col("r")).when(some, raised(F.col("r"), cfg.zeroshot_boost * zs, "zeroshot")).when(zs >= cfg.zeroshot_standalone, F.array(row(scoring.round4(zs), 4, F.array(F.lit("zeroshot"))))).otherwise(nothing))

    def told(r: Column, x: Column) -> Column:
        alone = F.when(x["score"] >= cfg.classifier_standalone, F.array(row(scoring.round4(cfg.classifier_weight * x["score"]), 5, F.array(F.lit("mft"))))).otherwise(nothing)
        return F.when(F.size(r) > 0, raised(r, scoring.round4(cfg.classifier_boost * x["score"]), "mft")).otherwise(alone)

    wide = wide.withColumn("r", F.aggregate("cl", F.col("r"), told))
    lone = (F.size("r") == 0) & (vice["confidence"] >= cfg.lexicon_standalone)
    # of a column, Spark would ask before the join whether it is empty, with all these steps written into one another
    every = F.when(lone, F.array(row(vice["confidence"], 6, word_tags(vice), F.lit(-1)))).otherwise(F.col("r"))
    rest = [c for c in structure.columns if c not in ("id", "struct_score")]
    out = wide.select("id", "value_name", "struct_score", *rest, *told_by, "kw", F.coalesce("virtue.confidence", F.lit(0.0)).alias("virtue"), F.coalesce("vice.confidence", F.lit(0.0)).alias("vice"), F.posexplode(every).alias("signal_ord", "x"))
    return out.select("id", "value_name", "signal_ord", "x.layer", "x.confidence", F.concat_ws("+", "x.source").alias("source"), "x.polarity_hint", "x.match_idx", "virtue", "vice", F.when(F.col("x.layer") == 0, F.col("kw.text_excerpt")).alias("own_excerpt"), F.when(F.col("x.layer") == 0, F.col("kw.around")).alias("around"), "struct_score", *rest, *told_by)


def verified(merged: DataFrame, verdicts: DataFrame | None = None) -> DataFrame:
    """Merged signals after a panel's verdicts (id, value_name, verdict) on a passage's values; without, by those they were merged with.

    P1 and P0 settle the polarity, tension gives a signal of each, discard
    takes the signals away; skip, or no verdict, leaves them as they are.
    """
    names = [c for c in merged.columns if c != "verdict"]
    df = (merged if verdicts is None else merged.join(verdicts.select("id", "value_name", "verdict"), ["id", "value_name"], "left")).where("verdict is null or verdict <> 'discard'")
    hints = F.when(F.col("verdict") == "P1", F.array(F.lit(1))).when(F.col("verdict") == "P0", F.array(F.lit(-1))).when(F.col("verdict") == "tension", F.array(F.lit(1), F.lit(-1))).otherwise(F.array(F.lit(None).cast("int")))
    df = df.select(*(c for c in names if c != "signal_ord"), F.col("signal_ord").alias("o"), F.posexplode(hints).alias("i", "told"))
    df = df.withColumns({"signal_ord": 2 * F.col("o") + F.col("i"), "polarity_hint": F.coalesce("told", "polarity_hint"), "source": F.when(F.col("told").isNotNull(), F.concat("source", F.lit("+panel"))).otherwise(F.col("source"))})
    return df.select(*names)


def observations(signals: DataFrame) -> DataFrame:
    """The first signal of each (session, record, value), in merge order; excerpts of 200 characters, polarity confidence in [0, 1]."""
    first = F.min_by(F.struct(*(c for c in signals.columns if c not in ("session_id", "record_id", "value_name"))), "signal_ord").alias("b")
    out = signals.groupBy("session_id", "record_id", "value_name").agg(first).select("session_id", "record_id", "value_name", "b.*")
    return out.withColumn("text_excerpt", F.substring("text_excerpt", 1, 200)).withColumn("polarity_confidence", F.greatest(F.lit(0.0), F.least(F.lit(1.0), "polarity_confidence")))


def append_new(fresh: DataFrame, known: DataFrame) -> DataFrame:
    """Observations whose (session, record, value) is not yet known."""
    return fresh.join(known.select("session_id", "record_id", "value_name"), ["session_id", "record_id", "value_name"], "left_anti")
