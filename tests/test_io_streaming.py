"""Readers, writers, streaming jobs and the SQL surface."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from heartwood import sql
from heartwood.functions import scoring
from heartwood.operators import registry
from heartwood.sources import readers, sinks
from heartwood.streaming import jobs


def test_texts_and_manifest(spark, tmp_path):
    (tmp_path / "texts").mkdir()
    (tmp_path / "texts/a.txt").write_text("Héllo text")
    (tmp_path / "texts/b.txt").write_text("x" * 100)
    got = {r["path"][-5:]: (r["text"], r["error"]) for r in readers.texts(spark, f"{tmp_path}/texts", 50).collect()}
    assert got == {"a.txt": ("Héllo text", None), "b.txt": (None, "file too large")}
    (tmp_path / "m.json").write_text(json.dumps({"default_significance": 0.7, "figures": [{"name": "ann", "pronoun": "she", "sources": [{"file": "a.txt", "doc_type": "letter", "pub_year": 1800}, {"file": "none.txt", "significance": 0.2}]}]}))
    rows = {r["file"]: r for r in readers.manifest_documents(spark, f"{tmp_path}/m.json", f"{tmp_path}/texts").collect()}
    assert rows["a.txt"]["text"] == "Héllo text" and rows["a.txt"]["significance"] == 0.7 and rows["a.txt"]["error"] is None
    assert rows["none.txt"]["error"] == "file not found" and rows["none.txt"]["doc_type"] == "unknown"


def test_manifest_with_equal_file_names(spark, tmp_path):
    for folder in ("a", "b", "a/deep"):
        (tmp_path / "in" / folder).mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / folder / "l.txt").write_text(f"the text of {folder}")
    files = ["a/l.txt", "./b/l.txt", "a/deep/l.txt", f"{tmp_path}/in/b/l.txt", "c/l.txt"]
    (tmp_path / "m.json").write_text(json.dumps({"figures": [{"name": "ann", "sources": [{"file": f} for f in files]}]}))
    rows = {r["file"]: (r["text"], r["error"]) for r in readers.manifest_documents(spark, f"{tmp_path}/m.json", f"{tmp_path}/in").collect()}
    assert rows == {files[0]: ("the text of a", None), files[1]: ("the text of b", None), files[2]: ("the text of a/deep", None), files[3]: ("the text of b", None), files[4]: (None, "file not found")}


def test_seeds(spark, tmp_path):
    (tmp_path / "s.json").write_text('{"love": {"hold": ["I stayed.", " "], "failure": ["I left."]}}')
    assert sorted(tuple(r) for r in readers.seeds(spark, f"{tmp_path}/s.json").collect()) == [("love", "failure", 0, "I left."), ("love", "hold", 0, "I stayed.")]


def test_records(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id":"1","label":"P1","ts":1}\n{"id":"1","label":"P0","ts":2}\nnot json\n{"label":"P0"}\n{"label":"P0"}\n{"source_obs_id":"9"}\n')
    good, bad = readers.records(spark, str(tmp_path))
    assert sorted((r["id"] or r["source_obs_id"] or "", r["label"] or "") for r in good.collect()) == [("", "P0"), ("", "P0"), ("1", "P1"), ("9", "")]
    assert [r["bad"] for r in bad.collect()] == ["not json"]


def test_comments_blocks_and_tables(spark, tmp_path):
    (tmp_path / "g.jsonl").write_text('# note\n\n{"id":"1","label":"P1"}\n')
    assert [tuple(r) for r in readers.commented_json(spark, f"{tmp_path}/g.jsonl", "id string, label string").collect()] == [("1", "P1")]
    (tmp_path / "b.txt").write_text("short\n\n" + "a long block of text that counts here\n\n")
    assert [r["text"] for r in readers.blocks(spark, f"{tmp_path}/b.txt").collect()] == ["a long block of text that counts here"]
    body = "a text that is long enough to be taken as a gold row"
    (tmp_path / "f.csv").write_text(f"Text,Care,loyalty\n{body},2,0\ntoo short,3,3\n")
    mapping = spark.createDataFrame([("care", "compassion"), ("care", "love"), ("loyalty", "loyalty")], "foundation string, value_name string")
    assert sorted(r["value_name"] for r in readers.foundation_csv(spark, f"{tmp_path}/f.csv", mapping, ("care", "loyalty")).collect()) == ["compassion", "love"]
    with pytest.raises(ValueError):
        (tmp_path / "n.csv").write_text("a,b\n1,2\n")
        readers.foundation_csv(spark, f"{tmp_path}/n.csv", mapping, ("care",))
    (tmp_path / "a.tsv").write_text(f"Argument ID\tPremise\nA1\t{body}\nA2\tshort\n")
    (tmp_path / "l.tsv").write_text("Argument ID\tBe: brave\tOther\nA1\t1\t0\nA2\t1\t1\n")
    m = spark.createDataFrame([("Be: brave", "courage"), ("Other", "love")], "category string, value_name string")
    assert [(r["arg_id"], r["value_name"]) for r in readers.argument_tsv(spark, f"{tmp_path}/a.tsv", f"{tmp_path}/l.tsv", m).collect()] == [("A1", "courage")]


def test_lexicons(spark, tmp_path):
    (tmp_path / "d.dic").write_text("%\n1\tcare.virtue\n2\tcare.vice\n%\nkind\t1\ncruel\t1\ncruel\t2\n%\n")
    assert {tuple(r) for r in readers.dic_lexicon(spark, f"{tmp_path}/d.dic").collect()} == {("kind", "care", "virtue"), ("cruel", "care", "vice")}
    (tmp_path / "p.tsv").write_text("LEMMA\tEXPRESSED_MORAL\nPure\t9.5\nbad\tx\n")
    assert [tuple(r) for r in readers.strength_tsv(spark, {"purity": f"{tmp_path}/p.tsv"}).collect()] == [("pure", "sanctity", 9.5)]
    (tmp_path / "v.json").write_text('{"courage": ["brave", "bold"], "love": ["dear"]}')
    assert sorted(tuple(r) for r in readers.vocabulary(spark, f"{tmp_path}/v.json").collect()) == [("courage", 0, "brave"), ("courage", 1, "bold"), ("love", 0, "dear")]
    (tmp_path / "t.json").write_text('{"map": {"care": ["love", "compassion"]}}')
    assert readers.taxonomy(spark, f"{tmp_path}/t.json", "map").count() == 2


def test_html_and_quotes(spark):
    page = "<html><nav><p>menu menu menu menu menu menu menu menu menu</p></nav><h2>Title</h2><p>A paragraph that is <b>certainly</b> longer than forty characters.<script>x()</script></p><p>short</p>"
    df = spark.createDataFrame([(page,), (None,)], "h string")
    assert [r[0] for r in df.select(readers.html_paragraphs(F.col("h"))).collect()] == [["[SECTION: Title]", "A paragraph that is certainly longer than forty characters."], []]
    open_ended = spark.createDataFrame([("<p>Text that goes on for more than forty characters and <b",)], "h string")
    assert [r[0] for r in open_ended.select(readers.html_paragraphs(F.col("h"))).collect()] == [["Text that goes on for more than forty characters and <b"]]
    q = 'He said "a quotation of more than thirty characters" twice: "a quotation of more than thirty characters" and "no".'
    assert spark.createDataFrame([(q,)], "t string").select(readers.quotes(F.col("t"))).first()[0] == ["a quotation of more than thirty characters"]


def test_model_replies(spark):
    df = spark.createDataFrame([("1", '```json\n{"love": {"holds": true, "violates": false}}\n```'), ("2", "nonsense")], "id string, reply string")
    assert [tuple(r) for r in readers.model_replies(df).collect()] == [("1", "love", True, False)]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("s", "r", "v", 1)], "session_id string, record_id string, value_name string, x int")
    assert sinks.append_new(df, f"{tmp_path}/o", jobs.KEYS).count() >= 0
    later = df.withColumns({"record_id": F.lit("r3"), "x": F.lit(9)}).union(df.withColumns({"record_id": F.lit("r3"), "x": F.lit(4)}))
    sinks.append_new(later, f"{tmp_path}/first", jobs.KEYS, ["x"])
    assert [r["x"] for r in spark.read.parquet(f"{tmp_path}/first").collect()] == [4]
    sinks.prototypes(spark.createDataFrame([("love", [1.0])], "label string, centroid array<double>"), f"{tmp_path}/p")
    assert spark.read.parquet(f"{tmp_path}/p").count() == 1
    sinks.append_new(df.union(df.withColumn("record_id", F.lit("r2"))), f"{tmp_path}/o", jobs.KEYS)
    assert sorted(r["record_id"] for r in spark.read.parquet(f"{tmp_path}/o").collect()) == ["r", "r2"]
    rec = spark.createDataFrame([("a", "P1"), ("a", "P0"), ("b", "AMBIGUOUS"), ("b", "APY")], "figure_name string, label string")
    sinks.training_files(rec, f"{tmp_path}/t")
    assert [spark.read.json(f"{tmp_path}/t/{n}").count() for n in ("by_figure", "positive", "negative")] == [3, 1, 2]
    c = sinks.certificate(spark.createDataFrame([("love", 0.5), ("courage", 0.7)], "value_name string, score double"), "ann", 5.0).first()
    assert c["score"] == 0.6 and json.loads(c["values_certified"]) == ["courage", "love"] and len(c["signature"]) == 64


OBS = "session_id string, record_id string, value_name string, ts double, significance double, resistance double, doc_type string"


def test_stream_equals_batch(spark, tmp_path):
    rows = [("figure:a", str(i % 7), "love", float(i), 0.5, i / 20, "letter") for i in range(20)]
    df = spark.createDataFrame(rows, OBS)
    for i in range(3):
        df.where(F.col("ts") % 3 == i).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    s = lambda: jobs.source(spark, f"{tmp_path}/in", df.schema, 1)
    jobs.ingest(s(), f"{tmp_path}/table", f"{tmp_path}/c1")
    jobs.ingest(s(), f"{tmp_path}/table", f"{tmp_path}/c1")  # nothing new
    assert spark.read.parquet(f"{tmp_path}/table").count() == 7
    jobs.run(jobs.registry(s()), lambda b, _: b.write.mode("overwrite").parquet(f"{tmp_path}/reg"), f"{tmp_path}/c2", "complete")
    got, want = spark.read.parquet(f"{tmp_path}/reg").first(), registry.registry(df).first()
    assert tuple(got) == tuple(want)


def test_stream_drops_late_rows(spark, tmp_path):
    """A row older than the watermark reaches no window any more."""
    cols = "ts timestamp, event_type string, value double"
    at = lambda h: datetime.datetime(2024, 1, 10, h % 24) + datetime.timedelta(days=h // 24)
    out = f"{tmp_path}/out"
    for hours in ((0, 1), (200,), (2, 201), (400,)):
        spark.createDataFrame([(at(h), "a", 1.0) for h in hours], cols).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        jobs.run(jobs.windowed(jobs.source(spark, f"{tmp_path}/in", spark.createDataFrame([], cols).schema)), lambda b, _: b.write.mode("append").parquet(out), f"{tmp_path}/c")
    got = sorted((r["start"].day, r["start"].hour, r["n"]) for r in spark.read.parquet(out).collect())
    assert got == [(10, 0, 1), (10, 1, 1), (18, 8, 1), (18, 9, 1)]


def test_sql_surface(spark):
    sql.register(spark, {"words": spark.createDataFrame([("I would rather die, and stood firm.",)], "t string")})
    r = spark.sql("SELECT value_resistance(t, 0.9D, 'journal') AS r, value_structure(t) AS s FROM words").first()
    w = spark.table("words").select(scoring.resistance(F.col("t"), F.lit(0.9), F.lit("journal")).alias("r"), scoring.structural(F.col("t")).alias("s")).first()
    assert (round(r["r"], 4), round(r["s"], 4)) == (w["r"], w["s"])
    rows = spark.sql("SELECT * FROM value_passages('A first sentence that is long enough. Short.')").collect()
    assert [tuple(x) for x in rows] == [(0, "A first sentence that is long enough. Short.")]
