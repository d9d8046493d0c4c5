"""Derived tables of the catalogue are made once, however many queries and branches read them."""

from heartwood.plans import binding, catalog


def test_upgraded_records_are_stored(spark, monkeypatch):
    made = []
    monkeypatch.setattr(catalog, "_records", lambda s, d: s.range(3))
    monkeypatch.setattr(binding, "pressure", lambda s, d: s.range(1))
    monkeypatch.setattr(catalog.labels, "upgraded", lambda records, pressure: made.append(1) or records)
    for _ in range(3):
        assert catalog._upgraded(spark, "/nowhere").count() == 3
    assert len(made) == 1
    assert catalog._upgraded(spark, "/nowhere").inputFiles()
