"""Readers: texts, manifests, record files, annotated corpora, web pages and lexicons."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from heartwood.functions import text

MAX_BYTES = 50 * 1024 * 1024
MANIFEST = (
    "corpus_name string, description string, default_significance double, figures array<struct<name:string,pronoun:string,"
    "sources:array<struct<file:string,doc_type:string,pub_year:int,significance:double,translation:boolean,title:string>>>>"
)
RECORD = (
    "id string, source_obs_id string, figure string, session_id string, record_id string, ts double, value_name string, text_excerpt string, document_type string, "
    "significance double, resistance double, label string, label_reason string, fail_mode string, training_weight double, confidence double, pressure_markers array<string>, "
    "failure_markers array<string>, hold_markers array<string>, source string, disambiguation_confidence double, observation_consistency double, value_polarity int, "
    "polarity_confidence double, pressure_source_id string, pressure_context boolean, deferred_apy_lag_s double, deferred_apy_lag_n int, corpus_confidence string, bad string"
)


#: Below so many bytes a table may be a single row group, which one task reads.
SMALL = 32 * 1024 * 1024


def spread(df: DataFrame) -> DataFrame:
    """A small table dealt to all cores; a larger one has row groups enough, and stays as it is read."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size < SMALL and df.rdd.getNumPartitions() < cores else df


def texts(spark: SparkSession, path: str, most: int = MAX_BYTES) -> DataFrame:
    """(path, text, error) of whole files; larger ones carry an error and no text."""
    return _decoded(spark.read.format("binaryFile").load(path), most)


def _decoded(f: DataFrame, most: int) -> DataFrame:
    return f.select("path", F.when(F.col("length") <= most, F.decode("content", "UTF-8")).alias("text"), F.when(F.col("length") > most, "file too large").alias("error"))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row for each source of each figure of a manifest."""
    m = spark.read.schema(MANIFEST).option("multiLine", True).json(path)
    f = m.select("default_significance", F.explode("figures").alias("f"))
    s = f.select("default_significance", F.col("f.name").alias("figure"), F.coalesce("f.pronoun", F.lit("unknown")).alias("pronoun"), F.posexplode("f.sources").alias("source_ord", "s"))
    return s.select(
        "figure", "pronoun", "source_ord", F.col("s.file").alias("file"), F.coalesce("s.doc_type", F.lit("unknown")).alias("doc_type"), F.col("s.pub_year").alias("pub_year"),
        F.coalesce("s.significance", "default_significance").alias("significance"), F.col("s.translation").alias("is_translation"), F.coalesce("s.title", F.lit("")).alias("doc_title"),
    )


def manifest_documents(spark: SparkSession, path: str, *folders: str) -> DataFrame:
    """The manifest's sources with their texts; a faulty file is a row with an error, and the rest go on.

    A relative path is looked for beside the manifest, then in ``folders`` in
    their order (see ``sources.manifest``, which reads the named files only).
    """
    from heartwood.sources import manifest as files

    return files.documents(spark, path, list(folders))


def records(spark: SparkSession, path: str, pattern: str = "*.jsonl") -> tuple[DataFrame, DataFrame]:
    """(records, malformed lines) of training files; of equal ids the first by file and content stays, rows without id all stay."""
    lines = spark.read.option("pathGlobFilter", pattern).text(path).where(F.trim("value") != "").withColumn("file", F.input_file_name())
    raw = lines.select("file", F.from_json("value", RECORD, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad"}).alias("j")).select("file", "j.*")
    key = F.coalesce("id", "source_obs_id")
    good = raw.where("bad is null").drop("bad").withColumn("_k", key)
    w = Window.partitionBy("_k").orderBy("file", "ts", "value_name", "text_excerpt")
    first = good.where("_k is not null").withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
    return first.unionByName(good.where("_k is null")).drop("_k"), raw.select("file", "bad").where("bad is not null")


def commented_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines with # comments and blank lines between them."""
    lines = spark.read.text(path).where(~F.col("value").rlike(r"^\s*(#|$)"))
    return lines.select(F.from_json("value", schema).alias("j")).select("j.*")


def blocks(spark: SparkSession, path: str, shortest: int = 30) -> DataFrame:
    """Blank-line-separated blocks of text files."""
    t = spark.read.text(path, wholetext=True)
    return t.select(F.explode(F.split("value", r"\n\n")).alias("b")).select(text.strip(F.col("b")).alias("text")).where(F.length("text") >= shortest)


def _column(df: DataFrame, names: tuple[str, ...]) -> str | None:
    """The first of ``names`` that the table has, whatever its case."""
    have = {c.lower(): c for c in df.columns}
    return next((have[n] for n in names if n in have), None)


def foundation_csv(spark: SparkSession, path: str, mapping: DataFrame, foundations: tuple[str, ...], least: int = 1) -> DataFrame:
    """A wide CSV of texts and foundation votes as gold rows (text_excerpt, value_name, label), through ``mapping`` (foundation, value_name)."""
    df = spark.read.option("header", True).csv(path)
    body = _column(df, ("text", "tweet_text", "tweet", "content", "sentence"))
    if body is None:
        raise ValueError("the file has no text column")
    found = [(f, c) for f in foundations if (c := _column(df, (f,)))]
    long = df.select(F.col(body).alias("text_excerpt"), *(F.col(c).try_cast("double").alias(f) for f, c in found)).unpivot("text_excerpt", [f for f, _ in found], "foundation", "votes")
    kept = long.where((F.col("votes") >= least) & (F.length("text_excerpt") >= 40))
    return kept.join(F.broadcast(mapping), "foundation").select("text_excerpt", "value_name", F.lit("P1").alias("label")).distinct()


def argument_tsv(spark: SparkSession, arguments: str, labels: str, mapping: DataFrame) -> DataFrame:
    """Arguments joined with their 0/1 value labels, unpivoted and mapped (category, value_name) to gold rows."""
    read = lambda p: spark.read.option("header", True).option("sep", "\t").csv(p)
    a, b = read(arguments), read(labels)
    key = _column(a, ("argument id", "argument_id", "arg_id"))
    premise = _column(a, ("premise", "text", "argument"))
    kinds = [c for c in b.columns if c != key]
    long = b.select(F.col(key).alias("arg_id"), *(F.col(f"`{c}`").cast("int").alias(c) for c in kinds)).unpivot("arg_id", [f"`{c}`" for c in kinds], "category", "flag").where("flag = 1")
    rows = a.select(F.col(f"`{key}`").alias("arg_id"), F.col(premise).alias("text_excerpt")).where(F.length("text_excerpt") >= 40).join(long, "arg_id")
    return rows.join(F.broadcast(mapping), "category").select("arg_id", "text_excerpt", "value_name", F.lit("P1").alias("label")).distinct()


class _Paragraphs(HTMLParser):
    """Paragraph texts and section headings, without scripts, styles and page furniture."""

    SKIP = frozenset({"script", "style", "noscript", "nav", "header", "footer"})

    def __init__(self, shortest: int):
        super().__init__(convert_charrefs=True)
        self.shortest, self.skipped, self.kind, self.parts, self.out = shortest, 0, "", [], []

    def handle_starttag(self, tag, attrs):
        if tag in self.SKIP:
            self.skipped += 1
        elif tag in ("p", "h2", "h3") and not self.skipped:
            self.close_block()
            self.kind = tag

    def handle_endtag(self, tag):
        if tag in self.SKIP:
            self.skipped = max(0, self.skipped - 1)
        elif tag == self.kind:
            self.close_block()

    def handle_data(self, data):
        if self.kind and not self.skipped:
            self.parts.append(data)

    def close_block(self):
        body = " ".join("".join(self.parts).split())
        if self.kind == "p" and len(body) > self.shortest:
            self.out.append(body)
        elif self.kind in ("h2", "h3") and body:
            self.out.append(f"[SECTION: {body}]")
        self.kind, self.parts = "", []


def html_paragraphs(html: Column, shortest: int = 40) -> Column:
    """array<string>: paragraphs longer than ``shortest`` and section markers, in order; null and broken pages give what they hold."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            rows = []
            for page in s:
                parser = _Paragraphs(shortest)
                parser.feed(page or "")
                parser.close()  # text after an unfinished tag
                parser.close_block()
                rows.append(parser.out)
            yield pd.Series(rows)

    return F.pandas_udf(run, "array<string>")(html)


QUOTE = "[\"“”]([^\"“”]{30,300})[\"“”]"


def quoted(body: Column, reach: int = 400) -> Column:
    """array of struct(quote, context): quoted passages in order, with up to ``reach`` characters before and after each."""
    def taken(m: Column) -> Column:
        before, after = text.window(body, m["s"] - reach, m["s"]), text.window(body, m["e"], m["e"] + reach)
        inner = text.strip(text.window(body, m["s"] + 1, m["e"] - 1))
        return F.struct(inner.alias("quote"), F.concat(before, F.lit(" "), after).alias("context"))

    return F.filter(F.transform(text.positions(body, QUOTE), taken), lambda q: F.length(q["quote"]) >= 30)


def quotes(body: Column) -> Column:
    """Distinct quoted passages of 30 to 300 characters, in order."""
    return F.array_distinct(F.transform(F.regexp_extract_all(body, F.lit(QUOTE), F.lit(1)), text.strip))


def dic_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """(word, foundation, polarity) of a dictionary file: categories between the first two % lines, then words; the last entry of a word wins."""
    lines = spark.read.text(path, wholetext=True).select(F.split("value", r"(?m)^%[ \t\r]*$").alias("p"))
    split = lambda part: F.explode(F.split(part, r"\n"))
    cats = lines.select(split(F.col("p")[1]).alias("l")).select(F.trim(F.split("l", r"\t")[0]).alias("code"), F.lower(F.trim(F.element_at(F.split("l", r"\t"), -1))).alias("name")).where("code <> ''")
    words = lines.select(F.posexplode(F.split(F.col("p")[2], r"\n")).alias("n", "l")).select("n", F.lower(F.trim(F.split("l", r"\t")[0])).alias("word"), F.trim(F.element_at(F.split("l", r"\t"), -1)).alias("code")).where("word <> ''")
    last = words.groupBy("word").agg(F.max_by("code", "n").alias("code"))
    return last.join(F.broadcast(cats), "code").select("word", F.split("name", r"\.")[0].alias("foundation"), F.split("name", r"\.")[1].alias("polarity"))


def strength_tsv(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """(word, foundation, score) of one TSV for each foundation; purity counts as sanctity."""
    out = None
    for foundation, path in paths.items():
        t = spark.read.option("header", True).option("sep", "\t").csv(path)
        t = t.select(F.lower(F.trim("LEMMA")).alias("word"), F.lit("sanctity" if foundation == "purity" else foundation).alias("foundation"), F.col("EXPRESSED_MORAL").try_cast("double").alias("score")).where("score is not null")
        out = t if out is None else out.unionByName(t)
    return out


def vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """(value_name, keyword, kw_ord) of a JSON object that lists keywords for each value, in order."""
    m = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,array<string>>").alias("m"))
    return m.select(F.explode("m").alias("value_name", "words")).select("value_name", F.posexplode("words").alias("kw_ord", "keyword"))


def seeds(spark: SparkSession, path: str) -> DataFrame:
    """(value_name, kind, seed_ord, sentence) of a JSON object with lists of ``hold`` and ``failure`` sentences for each value."""
    m = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,struct<hold:array<string>,failure:array<string>>>").alias("m")).select(F.explode("m").alias("value_name", "s"))
    of = lambda kind: m.select("value_name", F.lit(kind).alias("kind"), F.posexplode(f"s.{kind}").alias("seed_ord", "sentence"))
    return of("hold").unionByName(of("failure")).where(F.trim("sentence") != "")


def taxonomy(spark: SparkSession, path: str, section: str) -> DataFrame:
    """(name, value_name): one section of a JSON map from names to lists of values."""
    m = spark.read.text(path, wholetext=True).select(F.from_json(F.get_json_object("value", f"$.{section}"), "map<string,array<string>>").alias("m"))
    return m.select(F.explode("m").alias("name", "values")).select("name", F.explode("values").alias("value_name"))


def model_replies(replies: DataFrame, column: str = "reply") -> DataFrame:
    """(…, value_name, holds, violates) from model replies: JSON objects, perhaps within code fences; what cannot be read abstains."""
    bare = F.regexp_replace(F.col(column), r"^\s*```(?:json)?\s*|\s*```\s*$", "")
    votes = F.from_json(bare, "map<string,struct<holds:boolean,violates:boolean>>")
    rest = [c for c in replies.columns if c != column]
    return replies.select(*rest, F.explode_outer(votes).alias("value_name", "v")).select(*rest, "value_name", "v.holds", "v.violates").where("value_name is not null")
