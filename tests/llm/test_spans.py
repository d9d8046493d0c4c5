"""Personal data and secrets against plain Python over the same texts."""

import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from heartwood.llm import pii, secrets, spans
from tests.llm import brute


def check_pii(rows, texts):
    for r in rows:
        spans = brute.pii_base(texts[r["key"]])
        want, digest = brute.sha(spans)
        got = ",".join(x for x in r["spans"].split(",") if x and x.split(":")[0] in pii.BASE)
        assert got == want
        assert r["base_sha256"] == digest
        for kind in pii.BASE:
            assert r[f"n_{kind}"] == sum(s[3] == kind for s in spans)


def keyed(spark, texts):
    return spark.createDataFrame([(i, t, f"s{i % 5}") for i, t in enumerate(texts)], "doc_id long, text string, source string")


CASES = [
    None, "", "a@b.c d@e", "a@b.c-d_e@f.g..h", "x@y.z@w.v", "mail: " + "a" * 300 + "@b.co", "1.2.3.4.5.6.7.8", "256.1.1.1 01.002.0003.255",
    "999999999999.1.1.1", "4111111111111111", "4111-1111-1111-1111 and 4111 1111 1111 1112", "1--2 4111  1111", "+1 (555) 010-9999.", "+12--34", "+1234567890", "+1+1234567890123456",
    "é𝔘 a@b.cd 10.0.0.1", "GB82WEST12345698765432 iban", "GB82 WEST 1234 5698 7654 32", "GB82WEST12345698765433", "ssn 078-05-1120", "078-05-1120", "0" * 40, "1.1.1.1" * 30,
]


def test_pii_cases(spark):
    rows = pii.digest(keyed(spark, CASES)).withColumnRenamed("doc_id", "key").collect()
    assert len(rows) == len(CASES)
    check_pii(rows, CASES)
    by = {CASES[r["key"]]: r for r in rows}
    assert by["GB82WEST12345698765432 iban"]["n_iban"] == by["GB82 WEST 1234 5698 7654 32"]["n_iban"] == 1
    assert by["GB82WEST12345698765433"]["n_iban"] == 0
    assert by["ssn 078-05-1120"]["n_ssn"] == 1 and by["078-05-1120"]["n_ssn"] == 0


def test_pii_documents(spark, docs):
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    check_pii(pii.digest(docs).withColumnRenamed("doc_id", "key").collect(), texts)


@settings(max_examples=3, deadline=None)
@given(st.lists(st.text(alphabet="a1.2@+- 4(9)-_é𝔘AK", max_size=60), min_size=200, max_size=200))
def test_pii_random(spark, texts):
    check_pii(pii.digest(keyed(spark, texts)).withColumnRenamed("doc_id", "key").collect(), texts)


def test_odd_rows(spark, odd, none):
    texts = {r["doc_id"]: r["text"] for r in odd.collect()}
    rows = pii.digest(odd).withColumnRenamed("doc_id", "key").collect()
    assert len(rows) == odd.count()
    check_pii(rows, texts)
    assert pii.digest(none).count() == 0
    rows = secrets.digest(odd).collect()
    assert len(rows) == odd.count()
    check_secrets(rows, texts)
    assert secrets.digest(none).count() == 0


def test_redact(spark, odd):
    got = {r["doc_id"]: r["text"] for r in pii.redact(odd).collect()}
    assert pii.redact(odd).columns == odd.columns
    assert got[6] == "One Two three four 𝔘𝔫𝔦 <EMAIL> <IP>, <CARD> <PHONE> token = abcdef0"
    assert got[1] is None and got[2] == "" and got[4] == "one"


def check_secrets(rows, texts):
    for r in rows:
        spans = brute.secret_base(texts[r["doc_id"]])
        want, digest = brute.sha(spans)
        assert ",".join(x for x in r["spans"].split(",") if x and x.split(":")[0] in secrets.BASE) == want
        assert r["base_sha256"] == digest
        for kind in secrets.BASE:
            assert r[f"n_{kind}"] == sum(s[3] == kind for s in spans)


SECRETS = [
    None, "", "password=abc", "PassWord : 'abcdef'", "secret: token: abcdef", "token=secret=abcdef", "api_key=\"x1234567\" apikey:zzzzzz", "ſecret=abcdef toKen=abcdef",
    "AKIA" + "A" * 16, "AKIA" + "B" * 15, "AKIAAKIA" + "C" * 12, "0123456789abcdef01234567", "0123456789abcdef0123456", "f" * 100 + "G" + "e" * 24, "é token=𝔘 token=abcdef",
    "ghp_" + "z1" * 18, "sk_live_" + "a1" * 12,
]


def test_secret_cases(spark):
    rows = secrets.digest(keyed(spark, SECRETS)).collect()
    check_secrets(rows, SECRETS)
    assert {r["doc_id"]: r["n_live"] for r in rows}[15] == 1


def test_secret_ownership(spark):
    """A value of many owners is an example; a value of one owner, however often repeated, looks live."""
    docs = keyed(spark, ["token=example1 ghp_" + "z1" * 18] * 5 + ["token=" + "private9" + "x" * (i // 5) for i in range(0, 5)])
    rows = {r["doc_id"]: r for r in secrets.digest(docs).collect()}
    assert rows[0]["n_shared"] == 1 and rows[0]["n_live"] == 0 and "vendor" not in rows[0]["spans"]
    assert rows[0]["verdicts"] == "shared:5:5"
    single = keyed(spark, ["token=mine0001 ghp_" + "y2" * 18]).union(keyed(spark, ["token=mine0001"]))
    row = secrets.digest(single).where("spans like '%vendor%'").collect()
    assert len(row) == 1 and row[0]["n_live"] == 2


def test_secret_documents(spark, docs):
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    check_secrets(secrets.digest(docs).collect(), texts)


def test_many_matches_are_linear(spark):
    """32,000 matches in one text, all kept, within seconds."""
    n = 32_000
    mails, keys = "a@b.co " * n, "token=abc123 " * n
    began = time.perf_counter()
    row = pii.digest(keyed(spark, [mails])).first()
    assert row["n_email"] == n and row["base_sha256"] == brute.sha(brute.pii_base(mails))[1]
    row = secrets.digest(keyed(spark, [keys])).first()
    assert row["n_assign"] == n and row["base_sha256"] == brute.sha(brute.secret_base(keys))[1]
    assert pii.redact(keyed(spark, [mails])).first()["text"] == "<EMAIL> " * n
    assert time.perf_counter() - began < 60


def test_windows_cross_blocks(spark):
    text = "𝔘b" * 3000
    at = [(0, 5), (2040, 2060), (2048, 4096), (10, 5900), (5990, 7000), (7, 7), (2047, 2048), (4096, 4100)]
    df = spark.createDataFrame([(text, a, b) for a, b in at], "t string, a int, b int")
    got = df.select("a", "b", spans.cut(spans.blocks(F.col("t")), F.col("a"), F.col("b")).alias("c")).collect()
    assert all(r["c"] == text[r["a"]:r["b"]] for r in got)


@pytest.mark.parametrize("make", [lambda n: "a" * n, lambda n: "1" * n, lambda n: "1 " * (n // 2), lambda n: ".1" * (n // 2), lambda n: "a." * (n // 2) + "@", lambda n: "token" + " " * (n // 2), lambda n: "x@" + "a." * (n // 4) + "b"])
def test_long_runs_end(spark, make):
    """Long runs end in time; on shorter ones, where plain Python ends too, the spans agree with it."""
    text, short = make(200_000), make(10_000)
    rows = {r["doc_id"]: r for r in pii.digest(keyed(spark, [text, short])).collect()}
    assert rows[1]["spans"] == brute.sha(brute.pii_base(short))[0] and len(rows) == 2
    assert all(re.fullmatch("[0-9a-f]{64}", r["base_sha256"]) for r in secrets.digest(keyed(spark, [text, short])).collect())
