"""The registered queries: one for each operator, over the driver's tables."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from heartwood.functions import fixed, scoring, text
from heartwood.operators import card, corpus, extract, gold, ingest, labels, profiles, quality, registry, semantic, signals, statistics
from heartwood.plans import binding as b
from heartwood.sources import manifest, readers, sinks
from heartwood.streaming import jobs, ledger, pressure

def q_segment(spark: SparkSession, d: str) -> DataFrame:
    return b.documents(spark, d).select("doc_id", F.posexplode(text.passages(F.col("text"))).alias("place", "passage")).select("doc_id", "place", F.length("passage").alias("chars"), F.md5(F.col("passage").cast("binary")).alias("passage_md5"))


def q_segment_stats(spark, d):
    p = b.documents(spark, d).select("figure", "doc_type", F.explode(text.passages(F.col("text"))).alias("p"))
    return p.groupBy("figure", "doc_type").agg(F.count(F.lit(1)).alias("passages"), F.sum(F.length("p")).cast("long").alias("chars"), F.max(F.length("p")).alias("longest"))


def _scored(spark, d):
    n = b.passages(spark, d)
    return n.select("doc_id", "place", "doc_type", scoring.resistance(F.col("text"), F.col("significance"), F.col("doc_type")).alias("resistance"), scoring.structural(F.col("text")).alias("struct"))


def q_resistance(spark, d):
    return _scored(spark, d).select("doc_id", "place", "doc_type", "resistance", "struct", scoring.modulated(F.col("resistance"), F.col("struct")).alias("modulated"))


def q_flagship(spark, d):
    """Documents to passages, scored and profiled by source: the engine's main path."""
    p = ingest.passages(b.documents(spark, d), b.NOW)
    p = p.select("session_id", "doc_type", scoring.resistance(F.col("text"), F.col("significance"), F.col("doc_type")).alias("r"), scoring.structural(F.col("text")).alias("s"))
    return p.groupBy("session_id", "doc_type").agg(
        F.count(F.lit(1)).alias("passages"), scoring.round4(F.avg("r")).alias("avg_resistance"), scoring.round4(F.max("r")).alias("max_resistance"), scoring.round4(F.avg("s")).alias("avg_structure"), F.count_if(F.col("r") >= 0.6).alias("costly"))


def q_resistance_hist(spark, d):
    return corpus.distribution(b.observations(spark, d), "resistance")


def q_significance_hist(spark, d):
    return corpus.distribution(b.observations(spark, d), "significance")


def q_markers(spark, d):
    n = b.passages(spark, d)
    m = lambda p: F.array_join(text.markers(F.col("text"), p), "|")
    return n.select("doc_id", "place", m(fixed.PRESSURE_MARKERS).alias("pressure"), m(fixed.FAILURE_MARKERS).alias("failure"), m(fixed.HOLD_MARKERS).alias("hold"))


def q_passages(spark, d):
    """Passages with their ids, moments, authenticity and places in their session."""
    p = ingest.numbered(b.passages(spark, d))
    return p.select("id", "session_id", "doc_id", "place", "ts", "source_authenticity", "passage_idx", F.length("text").alias("chars"))


def q_calibrated(spark, d):
    x = b.documents(spark, d)
    auth = scoring.authenticity(F.col("lang"), F.when(F.col("doc_id") % 4 == 0, None).otherwise(F.col("is_translation")))
    return x.select("doc_id", auth.alias("authenticity"), scoring.year_discount(F.col("pub_year")).alias("discount"), scoring.calibrated(F.lit(0.7), auth, F.col("pub_year")).alias("calibrated"), scoring.training_weight(scoring.default_significance(F.col("doc_type")), F.col("doc_type")).alias("training_weight"))


def q_archaic(spark, d):
    old = F.concat(F.lit("Thou hast said 'tis so; YE KNOWETH what she doth, and Art thou there? "), F.col("text"))
    return b.documents(spark, d).select("doc_id", F.md5(text.modernised(old).cast("binary")).alias("modern_md5"))


def q_keyword_hits(spark, d):
    """Every keyword hit over the whole texts, templates included, valid or not."""
    docs = b.documents(spark, d).withColumn("significance", scoring.default_significance(F.col("doc_type")))
    return signals.keyword_hits(docs, b.vocabulary(spark), ("doc_id",)).select("doc_id", "value_name", "keyword", "match_idx", "valid", "confidence")


def q_keyword_signals(spark, d):
    docs = b.documents(spark, d).withColumn("significance", scoring.default_significance(F.col("doc_type")))
    return signals.keyword_signals(docs, b.vocabulary(spark), ("doc_id",)).select("doc_id", "value_name", "keyword", "confidence", "match_idx")


def q_lexicon_signals(spark, d):
    return signals.lexicon_signals(b.documents(spark, d), b.lexicon(spark), b.strength(spark), ("doc_id",)).select("doc_id", "value_name", "polarity", "confidence", "source")


def q_phrase_signals(spark, d):
    return signals.phrase_signals(b.passages(spark, d), b.lexicon(spark), ("doc_id", "place")).select("doc_id", "place", "value_name", "polarity_hint", "match_idx", "confidence")


def q_polarity(spark, d):
    n = b.passages(spark, d)
    first = n.select("id", "doc_id", "place", scoring.tier1_polarity(F.col("text")).alias("t"))
    lex = signals.lexicon_signals(n, b.lexicon(spark), b.strength(spark)).groupBy("id").agg(F.max(F.when(F.col("polarity") == "vice", F.col("confidence"))).alias("vice"), F.max(F.when(F.col("polarity") == "virtue", F.col("confidence"))).alias("virtue"))
    j = first.join(lex, "id", "left").withColumns({"vice": F.coalesce("vice", F.lit(0.0)), "virtue": F.coalesce("virtue", F.lit(0.0))})
    p = scoring.polarity(F.col("t"), F.col("vice"), F.col("virtue"))
    return j.select("doc_id", "place", F.col("t.polarity").alias("tier1"), F.col("t.confidence").alias("tier1_confidence"), p["polarity"].alias("polarity"), scoring.round4(p["confidence"]).alias("polarity_confidence"))


def q_semantic_signals(spark, d):
    """Likeness to held and failed prototypes as signals."""
    return b.likeness(spark, d).select("id", "value_name", "confidence")


def q_classifier_signals(spark, d):
    """A foundation classifier's labels as values, and its vices."""
    c = b.given(spark, d)["classifier"]
    said = signals.classifier_signals(c).select("id", "value_name", "ord", "score")
    return said.unionByName(signals.vice_flags(c).select("id", F.concat(F.lit("vice of "), "foundation").alias("value_name"), F.lit(-1).alias("ord"), "score"))


def q_merge_confidence(spark, d):
    """All layers' signals of each passage in merge order, after the panel, with polarity and resistance."""
    return b.merged(spark, d).select("id", "value_name", "signal_ord", "layer", "confidence", "source", "polarity_hint", "match_idx", "disambiguation_confidence", "resistance", "value_polarity", scoring.round4("polarity_confidence").alias("polarity_confidence"))


def q_observations(spark, d):
    """The extraction end to end: whole texts to observations."""
    return b.extracted(spark, d).select("session_id", "record_id", "value_name", "ts", "passage_idx", "doc_type", "significance", "resistance", "disambiguation_confidence", "source", "value_polarity", scoring.round4("polarity_confidence").alias("polarity_confidence"), F.md5(F.col("text_excerpt").cast("binary")).alias("excerpt_md5"))


def q_new_observations(spark, d):
    """Repeated signals, deduplicated to the first of each (session, record, value); those known already stay out."""
    o = b.observations(spark, d)
    # both signals come out of the observation's row, with no more than is asked for: the first of them would be packed whole
    signal = lambda n, res: F.struct(F.lit(n).alias("signal_ord"), res.alias("resistance"))
    twice = o.select("session_id", "record_id", "value_name", "text_excerpt", F.explode(F.array(signal(0, F.col("resistance")), signal(1, F.lit(0.0)))).alias("s")).select("*", "s.*", F.lit(1.5).alias("polarity_confidence")).drop("s")
    known = o.where("value_polarity < 0")
    return signals.append_new(signals.observations(twice), known).select("session_id", "record_id", "value_name", "resistance", "polarity_confidence", F.length("text_excerpt").alias("chars"))


def q_pressure(spark, d):
    return extract.pressure(b.passages(spark, d))


def q_registry(spark, d):
    return registry.registry(b.observations(spark, d))


def q_incremental_registry(spark, d):
    """The registry from statistics that four batches of the observations were merged into, one of them twice."""
    path, o = sinks.scratch(spark), b.observations(spark, d)
    for number in (0, 1, 1, 2, 3):
        statistics.update(o.where(F.pmod(F.xxhash64("record_id"), F.lit(4)) == number), path, number, 16)
    return statistics.profiles(statistics.stored(spark, path))


def q_running_registry(spark, d):
    return registry.running(b.observations(spark, d))


def q_universal(spark, d):
    return registry.across(registry.registry(b.observations(spark, d)), least=2)


def q_cross_figure(spark, d):
    return registry.across(registry.registry(b.observations(spark, d)), figures=5)


def q_top_values(spark, d):
    return registry.top_values(registry.registry(b.observations(spark, d)))


def q_figures(spark, d):
    return registry.figure_list(b.sources(spark, d), registry.registry(b.observations(spark, d)))


def q_scan(spark, d):
    return registry.scan(b.observations(spark, d), value="courage", since=86_400.0, limit=50).select("session_id", "record_id", "value_name", "ts")


def _records(spark, d):
    """The labelled records as a stored table, since the upgrade, reports and grading read them several times."""
    def make(s, x):
        o = b.observations(s, x)
        return labels.classified(labels.enriched(o, b.sources(s, x), registry.registry(o)))

    return b.stored(spark, d, "records", make)


def q_classify(spark, d):
    return _records(spark, d).select("session_id", "record_id", "value_name", "figure_name", "document_type", "observation_consistency", "label", "label_reason", "confidence", "fail_mode", "training_weight")


def _upgraded(spark, d):
    return b.stored(spark, d, "upgraded", lambda s, x: labels.upgraded(_records(s, x), b.pressure(s, x)))


def q_apy_upgrade(spark, d):
    return _upgraded(spark, d).select("session_id", "record_id", "value_name", "label", "label_reason", "confidence", "fail_mode", "pressure_source_id", "deferred_apy_lag_s", "deferred_apy_lag_n")


def q_pressure_window(spark, d):
    return labels.pressure_window(b.pressure(spark, d))


def q_event_asof(spark, d):
    """The as-of join over the events table: purchases with the user's last error before them."""
    e = b.table(spark, d, "events").select("event_id", F.col("user_id").cast("string").alias("session_id"), F.unix_micros(F.col("ts").cast("timestamp")).cast("double").alias("us"), "event_type")
    e = e.select(F.col("event_id").cast("string").alias("record_id"), "session_id", (F.col("us") / 1e6).alias("ts"), F.lit(-1).alias("passage_idx"), "event_type")
    out = labels.with_pressure(e.where("event_type = 'purchase'"), e.where("event_type = 'error'").drop("event_type"))
    return out.select("session_id", "record_id", "pressure_source_id", F.col("deferred_apy_lag_s").alias("lag_s"))


def q_contrastive(spark, d):
    return labels.contrastive(_upgraded(spark, d), b.passages(spark, d)).select("session_id", "record_id", "value_name", "pressure_source_id", "pressure_text")


def q_cooccurrence(spark, d):
    return labels.cooccurrence(_records(spark, d))


def q_tension(spark, d):
    return labels.tensions(_records(spark, d)).drop("text_excerpt")


def q_label_pivot(spark, d):
    return labels.label_pivot(_records(spark, d), "figure_name")


def q_value_pivot(spark, d):
    return labels.label_pivot(_records(spark, d), "value_name")


def q_label_cube(spark, d):
    return labels.label_cube(_records(spark, d)).select("session_id", "value_name", "label", "n", F.col("level").cast("long").alias("level"))


def q_training_records(spark, d):
    """The records of 28 fields, all markers and the pressure context included."""
    r = labels.training_records(_upgraded(spark, d))
    lists = {c: F.array_join(c, "|") for c in ("pressure_markers", "failure_markers", "hold_markers")}
    return r.withColumns(lists).withColumn("text_excerpt", F.md5(F.col("text_excerpt").cast("binary")))


def q_report(spark, d):
    """The export report's label counts by figure, read back from its JSON."""
    out = labels.report(_upgraded(spark, d)).select(F.from_json("value", "total_classified long, total_weight_positive double, by_figure map<string,struct<P1:long,P0:long,APY:long>>").alias("j"))
    return out.select(F.col("j.total_classified").alias("total"), F.col("j.total_weight_positive").alias("weight"), F.explode("j.by_figure").alias("figure", "c")).select("total", "weight", "figure", F.col("c.P1").alias("p1"), F.col("c.P0").alias("p0"), F.col("c.APY").alias("apy"))


def q_stats(spark, d):
    o = b.observations(spark, d)
    return corpus.stats(o, registry.registry(o), b.sources(spark, d))


def q_document_list(spark, d):
    return corpus.document_list(b.passages(spark, d))


def q_figure_profile(spark, d):
    return registry.figure_profile(registry.registry(b.observations(spark, d)), "src0")


def q_pressure_context(spark, d):
    return labels.pressure_context(b.pressure(spark, d), "figure:src1", from_idx=40, from_ts=0.0)


def q_languages(spark, d):
    """Languages by n-gram profiles, learned from the labelled documents but one in four; of every document."""
    docs = readers.spread(b.table(spark, d, "documents")).select("doc_id", "lang", "text")
    model = profiles.tables(profiles.learn(docs.where("doc_id % 4 <> 2")))
    l = docs.select("doc_id", profiles.detected(F.col("text"), model).alias("l"))
    return l.select("doc_id", F.col("l.lang").alias("lang"), scoring.round4("l.margin").alias("margin"))


def q_short_words(spark, d):
    """Languages by frequent short words, for documents without a label and a session without profiles."""
    l = readers.spread(b.table(spark, d, "documents")).select("doc_id", text.language(F.col("text")).alias("l"))
    return l.select("doc_id", F.col("l.lang").alias("lang"), F.col("l.share").alias("share"))


def q_gold_paragraphs(spark, d):
    """Gold from web pages: quotes and paragraphs that speak of values."""
    p = q_html_paragraphs(spark, d).select((F.col("page_id") * 10_000 + F.col("place")).alias("para_id"), "paragraph")
    stems = spark.createDataFrame([(s, v) for s, vs in b.STEMS.items() for v in vs], "stem string, value_name string")
    return gold.from_paragraphs(p, stems)


def q_batch_ingest(spark, d):
    """Conversations as files that manifests name, one in twenty missing: passages by figure, and errors."""
    base = sinks.scratch(spark)
    turn = F.struct("turn", "text")
    c = b.table(spark, d, "conversations").groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(turn)), lambda x: x["text"]), " ").alias("text"))
    c = c.select(
        F.concat(F.lit("speaker"), (F.col("conv_id") % 7).cast("string")).alias("figure"), F.lit("she").alias("pronoun"), F.concat(F.lit("f"), (F.col("conv_id") % 10).cast("string"), F.lit("/conv-"), F.col("conv_id").cast("string"), F.lit(".txt")).alias("file"),
        F.lit("letter").alias("doc_type"), (1900 + F.col("conv_id") % 50).cast("int").alias("pub_year"), F.when(F.col("conv_id") % 20 != 0, F.col("text")).alias("text"),
    )
    manifest.write(c, base, 64).write.format("noop").mode("overwrite").save()
    passages, errors = ingest.batch(manifest.documents(spark, f"{base}/manifests"), b.NOW)
    got = passages.groupBy("figure").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"), F.min("ts").alias("first_ts"), F.lit("none").alias("error"))
    return got.unionByName(errors.groupBy("figure", "error").agg(F.count(F.lit(1)).alias("n"), F.lit(0).cast("long").alias("chars"), F.lit(None).cast("double").alias("first_ts")))


def q_prototypes(spark, d):
    """The seeds' prototype vectors: components that are not zero."""
    p = b.prototypes(spark, d).select("label", "kind", F.posexplode("centroid").alias("d", "c"))
    return p.select("label", "kind", "d", scoring.round4("c").alias("c")).where("c <> 0")


def q_record_files(spark, d):
    """Training files written and read back; a repeated line counts once, a broken one not at all."""
    path = sinks.scratch(spark)
    r = labels.training_records(_upgraded(spark, d))
    sinks.training_files(r.withColumnRenamed("figure", "figure_name"), path)
    lines = spark.read.text(f"{path}/positive").unionByName(spark.read.text(f"{path}/negative")).unionByName(spark.read.text(f"{path}/negative")).unionByName(spark.createDataFrame([("{broken",), (" ",)], "value string"))
    lines.write.text(f"{path}/all")
    good, bad = readers.records(spark, f"{path}/all", "*.txt")
    return good.groupBy("label").agg(F.count(F.lit(1)).alias("n")).unionByName(bad.agg(F.lit("malformed").alias("label"), F.count(F.lit(1)).alias("n")))


def q_lexicon_files(spark, d):
    """Vocabulary, dictionary and strength files of the starter set, read back, and how often the passages say their words."""
    path = sinks.scratch(spark)
    sinks.write_text(spark, f"{path}/vocab.json", json.dumps(b.VOCABULARY))
    kinds = sorted({f"{f}.{p}" for _, f, p in b.LEXICON})
    entries = [f"{w}\t{1 + kinds.index(f'{f}.{p}')}" for w, f, p in b.LEXICON]
    sinks.write_text(spark, f"{path}/words.dic", "\n".join(["%", *(f"{i + 1}\t{k}" for i, k in enumerate(kinds)), "%", f"{b.LEXICON[0][0]}\t{len(kinds)}", *entries]))
    tables = {f: "\n".join(["LEMMA\tEXPRESSED_MORAL", *(f"{w}\t{s}" for w, g, s in b.STRENGTH if g == f)]) for f in sorted({f for _, f, _ in b.STRENGTH})}
    for f, body in tables.items():
        sinks.write_text(spark, f"{path}/{f}.tsv", body)
    v = readers.vocabulary(spark, f"{path}/vocab.json").select(F.lit("vocabulary").alias("kind"), F.col("value_name").alias("a"), F.col("keyword").alias("b"), F.col("kw_ord").cast("double").alias("x"))
    w = readers.dic_lexicon(spark, f"{path}/words.dic").select(F.lit("lexicon").alias("kind"), F.col("word").alias("a"), F.concat_ws(".", "foundation", "polarity").alias("b"), F.lit(None).cast("double").alias("x"))
    s = readers.strength_tsv(spark, {f: f"{path}/{f}.tsv" for f in tables}).select(F.lit("strength").alias("kind"), F.col("word").alias("a"), F.col("foundation").alias("b"), F.col("score").alias("x"))
    entries = v.unionByName(w).unionByName(s).withColumn("word", F.when(F.col("kind") == "vocabulary", F.col("b")).otherwise(F.col("a")))
    said = b.passages(spark, d).select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"[a-z]+"), F.lit(0))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return said.join(F.broadcast(signals.dimension(entries, 10_000)), "word", "right").select("kind", "a", "b", "x", F.coalesce("n", F.lit(0)).alias("n"))


def q_panel(spark, d):
    l = b.table(spark, d, "labels").select(F.col("doc_id").alias("id"), F.lit("courage").alias("value_name"), F.explode(F.sequence(F.lit(0), F.lit(2))).alias("m"), "quality", "toxic")
    votes = l.select("id", "value_name", F.when((F.col("id") + F.col("m")) % 5 != 0, (F.col("quality") + F.col("m")) % 2 == 1).alias("holds"), F.when((F.col("id") + F.col("m")) % 7 != 0, (F.col("toxic") + F.col("m")) % 2 == 0).alias("violates"))
    return labels.panel_votes(votes)


def q_corpus_overview(spark, d):
    return corpus.overview(b.passages(spark, d), b.observations(spark, d))


def q_dataset_card(spark, d):
    """The rows of the dataset card's tables, by section."""
    o = b.observations(spark, d)
    section, rows = "", []
    before, people, after = card.parts("Voices", b.passages(spark, d), o, registry.registry(o), _training(spark, d))
    for line in [*before, *after]:
        section = line.removeprefix("## ") if line.startswith("## ") else section
        if line.startswith("| ") and section in ("Corpus Statistics", "Figures", "Value Distribution", "Cross-Figure Values"):
            rows.append((section, line))
    small = spark.createDataFrame(rows, "section string, line string").where("line not like '| --- |%'")
    return small.unionByName(people.select(F.lit("Figures").alias("section"), "line"))


def q_figure_summary(spark, d):
    o = b.observations(spark, d)
    return corpus.figure_summaries(b.passages(spark, d), o, registry.registry(o))


def q_corpus_quality(spark, d):
    figures = b.table(spark, d, "documents").select(F.col("source").alias("figure_name"))
    return corpus.corpus_quality(b.registered(spark, d), figures)


def q_export_gate(spark, d):
    q = corpus.corpus_quality(b.registered(spark, d), b.table(spark, d, "documents").select(F.col("source").alias("figure_name")))
    return labels.exportable(_records(spark, d), q).groupBy("figure_name", "corpus_confidence").agg(F.count(F.lit(1)).alias("n"))


def _training(spark, d):
    return _records(spark, d).withColumnRenamed("figure_name", "figure")


def q_quality_metrics(spark, d):
    return quality.metrics(_training(spark, d))


def q_quality_checks(spark, d):
    return quality.checks(_training(spark, d))


def q_grade(spark, d):
    """All three layers, each check with its outcome, and the grade."""
    r = _training(spark, d)
    return quality.checks(r).join(F.broadcast(quality.grade(r).select("grade")), F.lit(True))


def q_digest(spark, d):
    """The hash of the sorted training records, whole and dealt anew, and that of each range of them."""
    r = _training(spark, d)
    whole = quality.digest(r).select(F.lit("all").alias("figure"), F.lit("all").alias("value_name"), F.col("reproducibility_hash").alias("hash"))
    anew = quality.digest(r.repartition(3, "value_name")).select(F.lit("anew").alias("figure"), F.lit("all").alias("value_name"), F.col("reproducibility_hash").alias("hash"))
    return whole.unionByName(anew).unionByName(quality.ranges(r).select("figure", "value_name", "hash"))


def q_differing(spark, d):
    """The ranges of the training records that change if one label in 256 does."""
    r = _training(spark, d)
    changed = F.md5(F.col("record_id").cast("binary")).startswith("00")
    return quality.differing(r, r.withColumn("label", F.when(changed, F.lit("P9")).otherwise(F.col("label"))))


def q_lofo(spark, d):
    return quality.without_one_figure(_training(spark, d))


def q_threshold_sweep(spark, d):
    o = b.observations(spark, d)
    return gold.sweep(o.join(_gold(spark, d).withColumnRenamed("label", "gold"), "doc_id", "left"))


def _gold(spark, d):
    """Document labels as gold: (doc_id, label)."""
    return b.table(spark, d, "labels").select("doc_id", F.when(F.col("quality") == 1, "P1").when(F.col("toxic") == 1, "APY").otherwise("P0").alias("label"))


def _annotated(spark, d):
    """Observations of labelled documents as annotations: excerpt, value, label."""
    return b.observations(spark, d).join(_gold(spark, d), "doc_id").select("text_excerpt", "value_name", "label", "source_obs_id", "doc_id")


def q_gold_match(spark, d):
    """Records against gold: integrity by id, all else by excerpt and value, as annotators' majority has it."""
    a = _annotated(spark, d)
    by_id = a.where("value_name = 'integrity'").select(F.col("source_obs_id").alias("observation_id"), "label")
    by_text = gold.merge_gold(a).where("label <> 'AMBIGUOUS'").select("key", "value_name", "label")
    return gold.scores(gold.matched(_records(spark, d), by_id, by_text))


def q_gold_merge(spark, d):
    return gold.merge_gold(_annotated(spark, d))


def q_formula_audit(spark, d):
    j = _scored(spark, d).join(b.table(spark, d, "labels"), "doc_id")
    return gold.formula_audit(j.select(F.col("resistance").alias("computed"), (F.col("quality") * 0.5 + 0.25).alias("human"), F.when(F.col("quality") == 1, "P1").otherwise("P0").alias("label")))


def q_centroids(spark, d):
    c = semantic.centroids(b.table(spark, d, "embeddings"))
    return c.select("label", F.posexplode("centroid").alias("i", "c")).select("label", "i", scoring.round4("c").alias("c"))


def q_semantic_topk(spark, d):
    v = b.table(spark, d, "embeddings")
    return semantic.nearest(v, semantic.centroids(v), least=0.05).select("vec_id", "rank", "label", "score")


def q_html_paragraphs(spark, d):
    return readers.spread(b.table(spark, d, "pages")).select("page_id", F.posexplode(readers.html_paragraphs(F.col("html"))).alias("place", "paragraph"))


def q_quotes(spark, d):
    body = F.concat(F.lit('He said "the weight of this long promise is mine to carry" and left. '), F.col("text"))
    return readers.spread(b.table(spark, d, "documents")).select("doc_id", F.posexplode(readers.quotes(body)).alias("place", "quote"))


def q_conversation_ingest(spark, d):
    c = b.table(spark, d, "conversations").select(F.concat(F.lit("c"), (F.col("conv_id") % 10).cast("string")).alias("figure"), F.xxhash64("conv_id", "turn").alias("doc_id"), "text")
    return ingest.passages(c, b.NOW).groupBy("session_id").agg(F.count(F.lit(1)).alias("passages"), F.sum(F.length("text")).alias("chars"))


def q_ingest_errors(spark, d):
    docs = b.documents(spark, d).withColumn("figure", F.when(F.col("doc_id") % 50 == 0, "bad name!").otherwise(F.col("figure"))).withColumn("text", F.when(F.col("doc_id") % 50 == 1, " ").otherwise(F.col("text")))
    return ingest.checked(docs).groupBy(F.coalesce("error", F.lit("none")).alias("error")).agg(F.count(F.lit(1)).alias("n"))


def q_figure_sources(spark, d):
    """The ingest log folded by session."""
    x = b.table(spark, d, "documents")
    log = x.select(F.col("source").alias("figure"), F.when(F.col("doc_id") % 40 < 20, "journal").otherwise(b.spark_case("doc_id", b.KINDS)).alias("document_type"), F.lit(2).cast("long").alias("passage_count"), F.when(F.col("doc_id") % 3 == 0, "she").otherwise("unknown").alias("pronoun"), F.col("doc_id").cast("double").alias("ingested_at"))
    return ingest.figure_sources(log)


def q_incremental(spark, d):
    """Passages after each session's mark."""
    p = b.passages(spark, d)
    marks = p.where("session_id <> 'figure:src0'").groupBy("session_id").agg(F.floor((F.max("ts") + F.min("ts")) / 2).cast("double").alias("mark"))
    return ingest.since(p, marks).groupBy("session_id").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"))


def q_stream_registry(spark, d):
    """The events as a stream of observations, summed by (user, type) in complete mode."""
    schema = b.table(spark, d, "events").schema
    e = spark.readStream.schema(schema).parquet(f"{d}/events.parquet*")
    o = e.select(F.col("user_id").cast("string").alias("session_id"), F.col("event_type").alias("value_name"), F.lit("unknown").alias("doc_type"), F.col("value").alias("significance"), (F.col("value") / 2).alias("resistance"), F.unix_micros(F.col("ts").cast("timestamp")).cast("double").alias("ts"))
    out, mark = sinks.scratch(spark), sinks.scratch(spark)
    jobs.run(jobs.registry(o), lambda batch, _: batch.write.mode("overwrite").parquet(out), mark, "complete")
    r = spark.read.parquet(out)
    return r.select("session_id", "value_name", "demonstrations", "avg_significance", "avg_resistance", "consistency", "first_seen_ts", "last_seen_ts")


def _streamed(spark, d, build, schema):
    """The rows that a stream of the events wrote, each batch once, and how many events came too late."""
    out = sinks.scratch(spark)
    once = lambda e: build(e.withWatermark("ts", b.LATE).dropDuplicatesWithinWatermark(["event_id"]))
    late = jobs.fed(b.arrivals(spark, d), once, f"{out}/in", ledger.sink(f"{out}/table", "events"), f"{out}/checkpoint")
    return ledger.read(spark, f"{out}/table", schema), late


def q_stream_pressure(spark, d):
    """Failures under pressure from keyed state, over the events as they arrive, out of order."""
    kind = F.when(F.col("event_type") == "error", "pressure").otherwise("failed").alias("kind")
    rows = lambda e: e.where("event_type in ('error', 'purchase')").select(F.col("user_id").cast("string").alias("session_id"), F.col("event_id").cast("string").alias("record_id"), F.lit(-1).alias("passage_idx"), kind, "ts")
    # the state store of a running query is fixed when it starts, so the session's own choice is put back after it
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, pressure.STATE_STORE)
    try:
        got, _ = _streamed(spark, d, lambda e: pressure.pressure(rows(e), "ts"), "session_id string, record_id string, pressure_source_id string, lag_s double, lag_n int")
    finally:
        spark.conf.set(key, before)
    return got.select("session_id", "record_id", "lag_s")


def q_event_windows(spark, d):
    """Events by day and type from a running stream with late rows; with the number of those that came too late."""
    got, late = _streamed(spark, d, lambda e: jobs.windowed(e, None, "1 day"), "start timestamp, event_type string, n long, total double")
    return got.select(F.unix_seconds("start").alias("start_s"), "event_type", "n", scoring.round4("total").alias("total"), F.lit(late).cast("long").alias("late"))


def q_event_sessions(spark, d):
    """Users' sessions from a running stream with late rows."""
    got, _ = _streamed(spark, d, lambda e: jobs.sessions(e, "6 hours", None), "start timestamp, end timestamp, user_id long, n long")
    return got.groupBy("user_id").agg(F.count(F.lit(1)).alias("sessions"), F.sum("n").alias("events"))


def _li(spark, d):
    return b.table(spark, d, "lineitem")


def q_tpch_q1(spark, d):
    price = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return _li(spark, d).where("l_shipdate <= timestamp_ntz'1998-09-02'").groupBy("l_returnflag", "l_linestatus").agg(
        F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(price), 2).alias("sum_disc_price"), F.round(F.avg("l_extendedprice"), 2).alias("avg_price"), F.count(F.lit(1)).alias("count_order"))


def q_tpch_q3(spark, d):
    """Revenue of orders by market segment: two joins and a top list."""
    c, o = b.table(spark, d, "customer").where("c_mktsegment = 'BUILDING'"), b.table(spark, d, "orders")
    j = _li(spark, d).join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey"))
    return j.groupBy("o_orderkey").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue")).orderBy(F.desc("revenue"), "o_orderkey").limit(10)


def q_tpch_q5(spark, d):
    """Revenue of local suppliers by nation."""
    t = lambda n: b.table(spark, d, n)
    j = (
        _li(spark, d).join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(t("supplier"), (F.col("l_suppkey") == F.col("s_suppkey")) & (F.col("c_nationkey") == F.col("s_nationkey"))).join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return j.groupBy("r_name", "n_name").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.count(F.lit(1)).alias("lines"))


def q_rank_window(spark, d):
    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return b.table(spark, d, "orders").select("o_custkey", "o_orderkey", F.row_number().over(w).alias("rn"), F.round(F.sum("o_totalprice").over(w.rowsBetween(Window.unboundedPreceding, 0)), 2).alias("running")).where("rn <= 3")


def q_set_operations(spark, d):
    o = b.table(spark, d, "orders")
    a, c = o.where("o_orderpriority = '1-URGENT'").select("o_custkey"), o.where("o_totalprice > 150000").select("o_custkey")
    tag = lambda df, s: df.select(F.lit(s).alias("op"), "o_custkey")
    return tag(a.intersect(c), "intersect").unionByName(tag(a.exceptAll(c).distinct(), "except_all")).unionByName(tag(a.subtract(c), "except")).groupBy("op").agg(F.count(F.lit(1)).alias("n"))


def q_semi_anti(spark, d):
    c, o = b.table(spark, d, "customer"), b.table(spark, d, "orders")
    cond = c["c_custkey"] == o["o_custkey"]
    side = lambda how, s: c.join(o, cond, how).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("c_acctbal"), 2).alias("balance")).withColumn("side", F.lit(s))
    return side("left_semi", "with orders").unionByName(side("left_anti", "without orders"))


QUERIES = {name: f for name, f in list(globals().items()) if name.startswith("q_")}
