"""Ingestion: documents of a figure become numbered, dated passages; faulty documents become error rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heartwood.functions import scoring, text
from heartwood.operators import profiles

FIGURE = r"^[a-zA-Z0-9][a-zA-Z0-9_\-]{0,63}$"
ARCHAIC_BEFORE, YEAR = 1850, 31_536_000
PRONOUNS = ("he", "she", "they", "i", "unknown")
#: Columns of a document that may be left out, with their defaults.
OPTIONAL = {"doc_type": "string", "pub_year": "int", "is_translation": "boolean", "significance": "double", "doc_title": "string", "pronoun": "string", "lang": "string"}


def session(figure: Column) -> Column:
    return F.concat(F.lit("figure:"), F.lower(figure))


def with_defaults(docs: DataFrame) -> DataFrame:
    for name, kind in OPTIONAL.items():
        if name not in docs.columns:
            docs = docs.withColumn(name, F.lit(None).cast(kind))
    return docs.withColumns({
        "doc_type": F.coalesce(F.lower(F.trim("doc_type")), F.lit("unknown")),
        "pronoun": F.coalesce(F.lower("pronoun"), F.lit("unknown")),
        "lang": F.coalesce("lang", F.lit("unknown")),
        "doc_title": F.coalesce("doc_title", F.lit("")),
    })


def _cut(docs: DataFrame, languages: DataFrame | None = None) -> DataFrame:
    """Documents with the ``body`` that is cut into passages: archaic forms of texts before ``ARCHAIC_BEFORE`` are replaced first.

    A document without a language gets the one that its n-grams speak for by
    the profiles ``languages``, or without these by its frequent short words.
    """
    guess = text.language(F.col("text"))["lang"] if languages is None else profiles.detected(F.when(F.col("lang") == "unknown", F.col("text")), profiles.tables(languages))["lang"]
    lang = F.when(F.col("lang") == "unknown", guess).otherwise(F.col("lang"))
    body = F.coalesce(text.modernised(F.when(F.col("pub_year") < ARCHAIC_BEFORE, F.col("text"))), F.col("text"))
    return docs.withColumns({"lang": lang, "body": body})


def _fault() -> Column:
    """What is wrong with a document before it is cut."""
    return (
        F.when(~F.coalesce(F.col("figure").rlike(FIGURE), F.lit(False)), "invalid figure name")
        .when(~F.col("pronoun").isin(*PRONOUNS), "invalid pronoun")
        .when(F.coalesce(text.strip(F.col("text")), F.lit("")) == "", "empty text")
    )


def checked(docs: DataFrame) -> DataFrame:
    """Documents with their ``passages`` and an ``error`` (null where there is none): bad figure names, pronouns, empty texts, texts without a passage."""
    return _cut(with_defaults(docs)).withColumn("passages", text.passages(F.col("body"))).drop("body").withColumn("error", F.coalesce(_fault(), F.when(F.size("passages") == 0, "no passages")))


def year_start(year: Column) -> Column:
    """Epoch seconds of a year's first moment; null for years that a calendar lacks."""
    valid = F.when(year.between(1, 9999), year)
    return (F.unix_date(F.make_date(valid, F.lit(1), F.lit(1))).cast("double") * 86_400).cast("double")


def passages(docs: DataFrame, now: float, marks: DataFrame | None = None, languages: DataFrame | None = None) -> DataFrame:
    """Passages of the faultless documents (figure, text, doc_id and optional columns).

    A passage's time is its document's first moment plus its place, so reruns
    agree; without a year that moment is one year before ``now``. Where a
    session's mark (session_id, mark) lies beyond it, the document begins one
    second after the mark, so that a reader past the mark still meets it. Ids
    are hashes of session, document and place. ``languages`` are profiles for
    documents without a language (``profiles.learn``).
    """
    # a document without a passage gives no row, so nothing asks for the passages but the rows they become
    docs = _cut(with_defaults(docs).where(_fault().isNull()), languages).withColumn("session_id", session(F.col("figure")))
    begin = F.coalesce(year_start(F.col("pub_year")), F.lit(float(now - YEAR)))
    if marks is not None:
        docs = docs.join(marks.select("session_id", "mark"), "session_id", "left")
        begin = F.when(F.col("mark") > begin, F.col("mark") + 1).otherwise(begin)
    # of a column, Spark would ask first whether it is empty, and cut each text a second time for that
    out = docs.withColumn("begin", begin).select("*", F.posexplode(text.passages(F.col("body"))).alias("place", "passage"))
    return out.select(
        F.sha2(F.concat_ws("|", "session_id", F.col("doc_id").cast("string"), F.col("place").cast("string")), 256).alias("id"),
        "figure", "session_id", "doc_id", "place", F.col("passage").alias("text"), "doc_type",
        F.coalesce("significance", scoring.default_significance(F.col("doc_type"))).alias("significance"),
        (F.col("begin") + F.col("place")).alias("ts"),
        F.col("lang").alias("source_lang"), scoring.authenticity(F.col("lang"), F.col("is_translation")).alias("source_authenticity"), "pub_year", "pronoun",
    )


def places(passages: DataFrame, least: float = 0.10) -> DataFrame:
    """(id, passage_idx): places in their session, by time and id, of the passages that count (significance and text).

    Moments of a session are counted first and summed in order; passages are
    then numbered within their moment, so a session, however large, is as many
    groups as it has moments, and no text is shuffled.
    """
    kept = passages.where((F.col("significance") >= least) & (text.strip(F.col("text")) != "")).select("id", "session_id", "ts")
    moments = kept.groupBy("session_id", "ts").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("session_id").orderBy("ts").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    moments = moments.select("session_id", "ts", before.alias("before"))
    inside = kept.withColumn("k", F.row_number().over(Window.partitionBy("session_id", "ts").orderBy("id")))
    return inside.join(moments, ["session_id", "ts"]).select("id", (F.col("before") + F.col("k") - 1).cast("int").alias("passage_idx"))


def numbered(passages: DataFrame, least: float = 0.10) -> DataFrame:
    """Passages that count, with their place in their session."""
    return passages.join(places(passages, least), "id")


def since(passages: DataFrame, marks: DataFrame) -> DataFrame:
    """Passages after their session's mark (session_id, mark); a session without a mark is read from its start."""
    return passages.join(marks, "session_id", "left").where(F.col("ts") > F.coalesce("mark", F.lit(-1e12))).drop("mark")


def figure_sources(log: DataFrame) -> DataFrame:
    """The ingest log (figure, document_type, passage_count, pronoun, ingested_at) summed by session."""
    log = log.withColumn("session_id", session(F.col("figure")))
    known = F.col("pronoun") != "unknown"
    return log.groupBy("session_id").agg(
        F.max_by("figure", "ingested_at").alias("figure_name"),
        F.when(F.count_distinct("document_type") == 1, F.first("document_type")).otherwise("mixed").alias("document_type"),
        F.max("ingested_at").alias("ingested_at"), F.sum("passage_count").alias("passage_count"),
        F.coalesce(F.max_by(F.when(known, F.col("pronoun")), F.when(known, F.col("ingested_at"))), F.lit("unknown")).alias("pronoun"),
    )


def figure_documents(log: DataFrame) -> DataFrame:
    """Registered documents: the first of each non-empty title of a figure, and all untitled ones."""
    key = F.when(F.col("doc_title") != "", F.concat_ws("|", F.lower("figure"), "doc_title"))
    first = F.row_number().over(Window.partitionBy(F.coalesce(key, F.concat(F.lit("#"), F.col("log_id").cast("string")))).orderBy("ingested_at", "log_id"))
    return log.withColumn("n", first).where("n = 1").drop("n")


def batch(docs: DataFrame, now: float, marks: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(passages, errors) of documents from many files (figure, file, text, error, ...): a faulty one is a row of errors, and the rest go on."""
    read = docs.where("error is null").drop("error")
    found = checked(read).where("error is not null").select("figure", "file", "error")
    return passages(read, now, marks), docs.where("error is not null").select("figure", "file", "error").unionByName(found)
