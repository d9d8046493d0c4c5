"""The dataset card: front matter, all sections, names and numbers."""

from pyspark.sql import functions as F

from heartwood.operators import card, labels, registry
from heartwood.plans import catalog

OBS = "session_id string, record_id string, value_name string, ts double, significance double, resistance double, doc_type string"
PASSAGES = "id string, session_id string, doc_type string, ts double"


def _card(spark, n=6, **how):
    o = spark.createDataFrame([(f"figure:{'ann' if i % 2 else 'b|ob'}", str(i), ("courage", "love")[i % 3 == 0], float(i), 0.5, 0.25 + i / 10, "letter") for i in range(n)], OBS)
    p = spark.createDataFrame([(str(i), f"figure:{'ann' if i % 2 else 'b|ob'}", ("letter", "journal")[i % 4 == 0], float(i)) for i in range(2 * n)], PASSAGES)
    return card.dataset_card("My: Corpus", p, o, registry.registry(o), **how)


def test_sections_front_matter_and_names(spark):
    text = _card(spark, made="2024-01-02", languages=("en", "de"))
    lines = text.split("\n")
    assert lines[0] == "---" and lines.index("---", 1) > 5 and 'pretty_name: "My: Corpus"' in lines and "- de" in lines
    for section in ("Dataset Description", "Corpus Statistics", "Figures", "Value Distribution", "Cross-Figure Values", "Resistance Score Distribution", "Schema", "Pipeline", "License"):
        assert f"## {section}" in lines
    assert "| Figures | 2 |" in lines and "| Passages | 12 |" in lines and "| Passages with a value | 50.00% |" in lines and "| Made | 2024-01-02 |" in lines
    assert "| letter | 9 | 75.0% |" in lines and any(x.startswith("| ann | journal, letter | 6") or x.startswith("| ann | letter | 6") for x in lines) and any(x.startswith("| b\\|ob | ") for x in lines)
    assert all(f"| `{f}` | " in text for f in labels.RECORD) and "| Mean | 0.5000 |" in lines and "| Max | 0.7500 |" in lines


def test_many_figures_and_none(spark):
    assert "and 1 more figures" in _card(spark, figures=1)
    text = _card(spark, 0)
    assert "| Passages | 0 |" in text and "## Figures" not in text and "## Resistance" not in text and "## Schema" in text


def test_labels_and_grade(spark):
    rows = [("a", v, "P1", "", "letter", "an excerpt that is long enough to count", 0.9, 0.9, 0.9, 0.6, float(i)) for i, v in enumerate(("love", "growth"))]
    r = spark.createDataFrame(rows, "figure string, value_name string, label string, label_reason string, document_type string, text_excerpt string, confidence double, resistance double, disambiguation_confidence double, observation_consistency double, ts double")
    text = _card(spark, records=r)
    assert "| P1 | 2 |" in text and "| APY | 0 |" in text and "Grade: FAILED" in text and "| L1 | Record Count | 2.0000 | >= 20 | no |" in text
    assert "Grade: ERROR" in _card(spark, records=r.where(F.lit(False)))


def test_no_figure_is_left_out(spark, monkeypatch):
    """More figures than the card once named: the text and the query hold a line for each, those without observations too."""
    n, odd = 10_003, {0: "---", 1: "a|b", 2: "c\nd"}
    name = F.coalesce(*(F.when(F.col("i") == i, s) for i, s in odd.items()), F.concat(F.lit("f"), F.col("i").cast("string")))
    p = spark.range(n).withColumnRenamed("id", "i").select(F.col("i").cast("string").alias("id"), F.concat(F.lit("figure:"), name).alias("session_id"), F.lit("letter").alias("doc_type"), F.col("i").cast("double").alias("ts"))
    p = p.unionByName(p.where("id = '5'").withColumns({"id": F.lit("x"), "doc_type": F.lit("journal")}))
    o = p.where("id < '9'").select("session_id", F.col("id").alias("record_id"), F.explode(F.array(*map(F.lit, ("courage", "love", "growth", "loyalty")))).alias("value_name"), "ts", F.lit(0.5).alias("significance"), F.lit(0.12345).alias("resistance"), "doc_type")
    o = o.unionByName(o.where("record_id = '7' and value_name = 'love'").crossJoin(spark.range(1_234)).withColumn("record_id", F.col("id").cast("string")).drop("id"))
    lines = card.dataset_card("All", p, o, registry.registry(o)).split("\n")
    start = lines.index("| Figure | Document types | Passages | Observations | Mean resistance | Foremost values |") + 2
    named = lines[start : lines.index("", start)]
    assert len(named) == n and not any(x.endswith(" more figures") for x in lines)
    assert named[0] == "| f5 | journal, letter | 2 | 4 | 0.1235 | courage, growth, love |"
    assert {"| --- | letter | 1 | 4 | 0.1235 | courage, growth, love |", "| f7 | letter | 1 | 1,238 | 0.1235 | love, courage, growth |", "| f9999 | letter | 1 | 0 |  |  |"} < set(named)
    assert any(x.startswith("| a\\|b | ") for x in named) and any(x.startswith("| c d | ") for x in named)

    records = spark.createDataFrame([], "figure string, value_name string, label string, label_reason string, document_type string, text_excerpt string, confidence double, resistance double, disambiguation_confidence double, observation_consistency double, ts double")
    for at, what, df in ((catalog.b, "passages", p), (catalog.b, "observations", o), (catalog, "_training", records)):
        monkeypatch.setattr(at, what, lambda s, d, df=df: df)
    got = [r["line"] for r in catalog.q_dataset_card(spark, "").where("section = 'Figures'").collect()]
    assert sorted(got) == sorted([lines[start - 2], *named])
