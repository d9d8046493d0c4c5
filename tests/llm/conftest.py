import pytest

DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, spans string"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, blanks, repeated rows, very long texts and extra columns whose names clash with the operators' own."""
    long = "word " * 30_000
    rows = [
        (1, None, None, None, 0, "x", "y"),
        (2, "", "en", "a", 0, None, None),
        (3, " \t\n", "en", "a", 3, "x", "y"),
        (4, "one", None, "a", 3, "x", "y"),
        (5, "one two", "fr", None, 7, "x", "y"),
        (6, "One Two three four 𝔘𝔫𝔦 a.b@c.de 1.2.3.4, 4111 1111 1111 1111 +1 (555) 010-9999 token = abcdef0", "en", "b", 90, "x", "y"),
        (6, "One Two three four 𝔘𝔫𝔦 a.b@c.de 1.2.3.4, 4111 1111 1111 1111 +1 (555) 010-9999 token = abcdef0", "en", "b", 90, "x", "y"),
        (7, long + "tail me@x.org " + "f0" * 15, "en", "b", len(long), "x", "y"),
        (8, long + "tail me@x.org " + "f0" * 15, "en", "c", len(long), "x", "y"),
        (9, "1" * 50_000 + " " + "1.2." * 5_000 + " " + "a.b" * 20_000 + "@", "en", "c", 0, "x", "y"),
        (None, "no id here", "en", "c", 0, "x", "y"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
