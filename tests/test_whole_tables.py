"""Registered queries over small tables of their own: whole texts, all rows."""

from heartwood.plans import binding, catalog


def written(path, **tables):
    for name, df in tables.items():
        df.write.parquet(f"{path}/{name}.parquet")
    return str(path)


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_archaic_forms_far_into_a_text(spark, tmp_path):
    body = "plain words " * 400
    d = written(tmp_path, documents=documents(spark, [(24, body + "thou hast", "en", "a", 0), (48, body + "you have", "en", "a", 0), (72, body + "others", "en", "a", 0)]))
    got = {r["doc_id"]: r["modern_md5"] for r in catalog.q_archaic(spark, d).collect()}
    assert got[24] == got[48] != got[72]


def test_no_row_is_filtered_away(spark, tmp_path):
    docs = documents(spark, [(24, "x", "en", "a", 1), (25, "x", "en", "b", 1), (49, "x", "en", "b", 1), (73, "x", "en", "b", 1)])
    d = written(tmp_path, documents=docs, labels=spark.createDataFrame([(25, 1, 0)], "doc_id long, quality int, toxic int"))
    assert {r["figure_name"]: (r["document_count"], r["confidence_tier"]) for r in catalog.q_corpus_quality(spark, d).collect()} == {"a": (1, "preliminary"), "b": (3, "confident")}
    assert {r["figure_name"]: r["passage_count"] for r in catalog.q_figures(spark, d).collect()} == {"a": 1, "b": 3}
    assert {r["doc_id"] for r in binding.passages(spark, d).collect()} == {24, 25, 49, 73}
    assert {r["figure"] for r in catalog.q_lofo(spark, d).collect()} == {"a", "b"}
    r = catalog.q_gold_match(spark, d).first()
    assert r["n_matched"] > 0 and r["n_matched"] + r["n_unmatched"] == binding.observations(spark, d).count()


def test_what_a_text_says_late_is_observed(spark, tmp_path):
    """The extraction reads whole texts: a keyword, a marker and a target far behind the template count."""
    body = "Plain words fill this line of the text. " * 200
    rows = [(24, body + "I was brave for justice when they threatened to jail me under pressure.", "en", "a", 0), (48, body, "en", "b", 0)]
    d = written(tmp_path, documents=documents(spark, rows), labels=spark.createDataFrame([(24, 1, 0)], "doc_id long, quality int, toxic int"))
    late = catalog.q_observations(spark, d).where("value_name = 'courage' and passage_idx > 10 and session_id = 'figure:a' and source like 'keyword%'").collect()
    assert len(late) == 1 and late[0]["value_polarity"] == 1 and late[0]["resistance"] > 0.5
    assert catalog.q_pressure(spark, d).where("markers = 'under pressure'").count() == 1
