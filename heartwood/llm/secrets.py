"""Secrets: patterns propose spans; how many owners share a value tells examples from live credentials.

Every candidate's hash is counted over the whole corpus: in how many
repositories (documents) and with how many owners (sources) it occurs. A
value that more than ``MAX_OWNERS`` owners carry is a widely copied example;
one that stays with few owners looks live. The base kinds (assign, access,
hex) are always reported. The method adds the kinds of ``ADDED``, whose
shapes documentation copies a lot: these are reported only where their
ownership says live.

Defined results: null and empty texts have no spans; a null source counts as
one owner of its own; repeated rows count as repeated repositories of the
same owner; other columns are not read. ``max_owners`` is a fixed number
whatever the number of owners: a live credential belongs to one team, and a
fork or a mirror adds one, while an example spreads without limit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heartwood.llm.common import anew, store
from heartwood.llm.spans import joined, with_matches

MAX_OWNERS = 2
KINDS = ("assign", "access", "hex", "key_block", "jwt", "vendor")
BASE, ADDED = KINDS[:3], KINDS[3:]
ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
VALUE = r"""^[A-Za-z_]+["']?\x20*[:=]\x20*["']?"""
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"[0-9a-f]{24,}+"
KEY_BLOCK = r"-----BEGIN [A-Z ]{0,24}PRIVATE KEY-----[A-Za-z0-9+/=\s]{40,}+-----END"
JWT = r"\beyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+"
VENDOR = r"\b(?:gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{20,}+|sk_live_[A-Za-z0-9]{20,}+|AIza[A-Za-z0-9_-]{35})"


def _value(kind: str, m: Column) -> Column:
    return F.regexp_replace(m, VALUE, "") if kind == "assign" else m


def with_candidates(df: DataFrame, text: str = "text", out: str = "candidates") -> DataFrame:
    """Add ``out``: array of struct(s, k, e, kind, h) of all candidates, ordered by start and kind; h is the value's hash."""
    df = df.withColumn("__t", F.coalesce(F.col(text), F.lit("")))
    t = F.col("__t")
    assigns = t.rlike(r"[:=]") & t.rlike(r"(?:[Ww][Oo][Rr]|[Ss][Ww])[Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]")
    for kind, pattern, maybe in (
        ("assign", ASSIGN, assigns),
        ("access", ACCESS, t.contains("AKIA")),
        ("hex", HEX, t.rlike(HEX)),
        ("key_block", KEY_BLOCK, t.contains("PRIVATE KEY-----")),
        ("jwt", JWT, t.contains("eyJ")),
        ("vendor", VENDOR, t.rlike(r"gh[pousr]_|xox[abprs]-|sk_live_|AIza")),
    ):
        df = with_matches(df, f"__{kind}", t, pattern, maybe)
    each = []
    for k, kind in enumerate(KINDS):
        kept = F.filter(f"__{kind}", lambda m: F.length(_value("assign", m["m"])) >= 6) if kind == "assign" else F.col(f"__{kind}")
        each.append(F.transform(kept, lambda m: F.struct(m["s"].alias("s"), F.lit(k).alias("k"), m["e"].alias("e"), F.lit(kind).alias("kind"), F.xxhash64(_value(kind, m["m"])).alias("h"))))
    return df.withColumn(out, F.array_sort(F.concat(*each))).drop("__t", *(f"__{kind}" for kind in KINDS))


def ownership(found: DataFrame) -> DataFrame:
    """(h, repositories, owners) of every candidate hash; ``found`` has source and candidates."""
    each = found.select("source", F.explode(F.array_distinct(F.transform("candidates", lambda x: x["h"]))).alias("h"))
    per = each.groupBy("h", "source").agg(F.count(F.lit(1)).alias("repositories"))
    return per.groupBy("h").agg(F.sum("repositories").alias("repositories"), F.count(F.lit(1)).alias("owners"))


def scan(docs: DataFrame, max_owners: int = MAX_OWNERS) -> DataFrame:
    """(doc_id, source, spans) for every document; spans: array of struct(s, k, e, kind, h, repositories, owners, live)."""
    found = with_candidates(docs.select("doc_id", "source", "text")).select(F.monotonically_increasing_id().alias("rid"), "doc_id", "source", "candidates")
    found = store(found, "secret-candidates")
    some = found.where(F.size("candidates") > 0)
    each = some.select("rid", F.explode("candidates").alias("c")).select("rid", "c", F.col("c.h").alias("h"))
    # dealt anew, so that Spark can split the partition of a widely copied value
    owned = ownership(some).select(anew("h").alias("hash"), "repositories", "owners")
    judged = each.join(owned, F.col("h") == F.col("hash")).select(
        "rid", F.struct("c.s", "c.k", "c.e", "c.kind", "c.h", "repositories", "owners", (F.col("owners") <= max_owners).alias("live")).alias("x")
    )
    spans = judged.groupBy("rid").agg(F.array_sort(F.collect_list("x")).alias("spans"))
    all_docs = found.select("rid", "doc_id", "source").join(spans, "rid", "left")
    kept = F.filter("spans", lambda x: (x["k"] < len(BASE)) | x["live"])
    none = F.expr("cast(array() as array<struct<s:int,k:int,e:int,kind:string,h:bigint,repositories:bigint,owners:bigint,live:boolean>>)")
    return all_docs.select("doc_id", "source", F.coalesce(kept, none).alias("spans"))


def digest(docs: DataFrame, max_owners: int = MAX_OWNERS) -> DataFrame:
    df = scan(docs, max_owners)
    base = F.filter("spans", lambda x: x["k"] < len(BASE))
    count = lambda test: F.size(F.filter("spans", test)).cast("long")
    return df.select(
        "doc_id",
        *(count(lambda x: x["kind"] == kind).alias(f"n_{kind}") for kind in BASE),
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        count(lambda x: x["live"]).alias("n_live"),
        count(lambda x: ~x["live"]).alias("n_shared"),
        F.array_join(F.transform("spans", lambda x: F.concat_ws(":", F.when(x["live"], "live").otherwise("shared"), x["owners"].cast("string"), x["repositories"].cast("string"))), ",").alias("verdicts"),
    )


def _sql_spans(pattern: str) -> str:
    """Spans (s, e, m) of a pattern's matches in t, from the lengths of the pieces between them."""
    p = "'" + pattern.replace("'", "''") + "'"
    hits, gaps = f"regexp_extract_all(t, {p})", f"string_split_regex(t, {p})"
    start = f"(coalesce(list_sum(list_transform(({gaps})[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(({hits})[1:i - 1], lambda x: length(x))), 0))::BIGINT"
    return f"list_transform(range(1, len({hits}) + 1), lambda i: {{'s': {start}, 'm': ({hits})[i]}})"


def _oracle() -> str:
    """DuckDB SQL for ``digest``; its engine has no possessive repetition, which changes nothing for these patterns."""
    patterns = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "key_block": KEY_BLOCK, "jwt": JWT, "vendor": VENDOR}
    each = " UNION ALL ".join(
        f"SELECT rid, source, {k} AS k, '{kind}' AS kind, unnest({_sql_spans(p.replace('}+', '}'))}) AS x FROM d" for k, (kind, p) in enumerate(patterns.items())
    )
    value = VALUE.replace("'", "''")
    text = "string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k)"
    return f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents), raw AS ({each}),
found AS (SELECT rid, source, k, kind, x.s AS s, x.s + length(x.m) AS e, CASE WHEN k = 0 THEN regexp_replace(x.m, '{value}', '') ELSE x.m END AS v FROM raw),
c AS (SELECT * FROM found WHERE k > 0 OR length(v) >= 6),
per AS (SELECT v, source, count(DISTINCT rid) AS n FROM c GROUP BY ALL), own AS (SELECT v, sum(n)::BIGINT AS repositories, count(*) AS owners FROM per GROUP BY v),
j AS (SELECT c.*, repositories, owners, owners <= {MAX_OWNERS} AS live FROM c JOIN own USING (v)), kept AS (SELECT * FROM j WHERE k < 3 OR live),
g AS (SELECT rid, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex, {text} FILTER (k < 3) AS base, {text} AS spans, count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_shared,
  string_agg(CASE WHEN live THEN 'live:' ELSE 'shared:' END || owners || ':' || repositories, ',' ORDER BY s, k) AS verdicts FROM kept GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_shared, 0) AS n_shared, coalesce(verdicts, '') AS verdicts
FROM d LEFT JOIN g USING (rid)"""


ORACLE = _oracle()
