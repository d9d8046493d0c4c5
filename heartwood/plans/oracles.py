"""DuckDB SQL for the registered queries, written on its own from their definitions."""

from __future__ import annotations

from heartwood.functions import fixed
from heartwood.functions.text import COMMON, any_of
from heartwood.operators import profiles
from heartwood.plans import binding as b
from heartwood.plans.binding import KIND_SQL, TEMPLATE_SQL, quote


def has(t: str, p: str) -> str:
    return f"regexp_matches({t}, {quote('(?i)' + p)})"


def all_of(t: str, p: str, group: int = 0) -> str:
    return f"regexp_extract_all({t}, {quote('(?i)' + p)}, {group})"


def by_kind(kind: str, values: dict[str, float], other: float) -> str:
    return f"CASE {kind} " + " ".join(f"WHEN '{k}' THEN {v}::DOUBLE" for k, v in values.items()) + f" ELSE {other}::DOUBLE END"


def resistance(t: str, sig: str, kind: str) -> str:
    hold, fail = has(t, fixed.RESISTANCE_HOLD), has(t, fixed.RESISTANCE_FAILURE)
    extra = f"CASE WHEN {hold} THEN 0.05::DOUBLE ELSE 0 END"
    return (
        f"round(greatest(0, least(1, 0.12::DOUBLE + least({sig} * 0.17::DOUBLE, 0.12::DOUBLE) + {by_kind(kind, fixed.RESISTANCE_NUDGE, 0.02)} + "
        f"CASE WHEN {has(t, fixed.MORTAL)} THEN 0.62::DOUBLE + {extra} WHEN {has(t, fixed.HIGH_ADVERSITY)} THEN CASE WHEN {fail} THEN 0::DOUBLE ELSE 0.36::DOUBLE + {extra} END "
        f"WHEN {has(t, fixed.ADVERSITY)} THEN CASE WHEN {fail} AND NOT {hold} THEN 0::DOUBLE ELSE 0.24::DOUBLE + {extra} END ELSE 0::DOUBLE END)), 4)"
    )


def structural(t: str) -> str:
    each = (f"CASE WHEN {has(t, hi)} THEN 1.0::DOUBLE WHEN {has(t, mid)} THEN 0.65::DOUBLE WHEN {has(t, lo)} THEN 0.3::DOUBLE ELSE 0::DOUBLE END" for lo, mid, hi in fixed.STRUCTURE.values())
    return f"round(({' + '.join(each)}) / 4, 4)"


def label(t: str, res: str, p1: str = "0.55", p0: str = "0.35") -> str:
    pressed, failed, held = (has(t, p) for p in (fixed.PRESSURE_MARKERS, fixed.FAILURE_MARKERS, fixed.HOLD_MARKERS))
    return (
        f"CASE WHEN {pressed} AND {failed} THEN {{'label': 'APY', 'why': 'pressure_detected_value_failed', 'conf': 0.95::DOUBLE}} WHEN {pressed} THEN {{'label': 'P1', 'why': 'apy_resistance_held_under_pressure', 'conf': 0.95::DOUBLE}} "
        f"WHEN {failed} THEN {{'label': 'P0', 'why': 'failure_markers_present', 'conf': 0.85::DOUBLE}} WHEN {res} >= {p1} AND {held} THEN {{'label': 'P1', 'why': 'high_resistance_hold_marker', 'conf': 0.9::DOUBLE}} "
        f"WHEN {res} >= {p1} THEN {{'label': 'P1', 'why': 'high_resistance_held', 'conf': 0.75::DOUBLE}} WHEN {res} < {p0} THEN {{'label': 'P0', 'why': 'low_resistance_no_hold', 'conf': 0.55::DOUBLE}} "
        f"ELSE {{'label': 'AMBIGUOUS', 'why': 'insufficient_signal', 'conf': 0.4::DOUBLE}} END"
    )


SIG = by_kind("doc_type", fixed.DEFAULT_SIGNIFICANCE, 0.75)
PRONOUN_SQL = b._case("doc_id", len(b.PRONOUNS), b.PRONOUNS)
DOCS = f"""docs AS (SELECT doc_id, source AS figure, lang, {TEMPLATE_SQL} || ' ' || text AS text, {KIND_SQL} AS doc_type, (1300 + doc_id * 37 % 700)::INTEGER AS pub_year, {PRONOUN_SQL} AS pronoun FROM documents)"""
SENTENCES = r"""list_filter(list_transform(string_split(regexp_replace(trim(regexp_replace(t, '^\s+|\s+$', '', 'g')), '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda s: regexp_replace(s, '^\s+|\s+$', '', 'g')), lambda s: s <> '')"""
CUT = f"""cut AS (SELECT doc_id, figure, doc_type, {SENTENCES.replace('(t,', '(text,')} AS s FROM docs),
packed AS (SELECT doc_id, figure, doc_type, list_reduce(list_prepend(CAST([''] AS VARCHAR[]), list_transform(s, lambda x: [x])), lambda acc, x: CASE WHEN acc[-1] = '' THEN list_concat(acc[:-2], x)
  WHEN length(acc[-1]) + 1 + length(x[1]) > 450 THEN list_concat(acc, x) ELSE list_append(acc[:-2], acc[-1] || ' ' || x[1]) END) AS p FROM cut),
pas AS (SELECT doc_id, figure, doc_type, unnest(kept) AS passage, generate_subscripts(kept, 1) - 1 AS place FROM (SELECT *, list_filter(p, lambda x: length(x) >= 30) AS kept FROM packed))"""
PASSAGES = f"{DOCS}, {CUT}"


def modern(x: str) -> str:
    for old, new in fixed.ARCHAIC:
        head, edge, back = (old[1:], r"(^|\W)''", r"\1") if old.startswith("'") else (old, r"\b", "")
        x = f"regexp_replace({x}, '{edge}{head.upper()}\\b', '{back}{new.upper()}', 'g')"
        if not back:
            x = f"regexp_replace({x}, '{edge}{head[0].upper()}(?i:{head[1:]})\\b', '{new[0].upper() + new[1:]}', 'g')"
            x = f"regexp_replace({x}, '{edge}{head[0]}(?i:{head[1:]})\\b', '{new}', 'g')"
        else:
            x = f"regexp_replace({x}, '(?i){edge}{head}\\b', '{back}{new}', 'g')"
    return x


DISCOUNT = "CASE " + " ".join(f"WHEN pub_year < {y} THEN {f}::DOUBLE" for y, f in fixed.YEAR_DISCOUNT) + " ELSE 1.0::DOUBLE END"
#: Passages as the engine numbers and dates them: p(id, session_id, figure, doc_id, place, text, doc_type, significance, ts, auth, pub_year, pronoun, passage_idx).
P = f"""docs AS (SELECT * REPLACE (CASE WHEN pub_year < 1850 THEN {modern('text')} ELSE text END AS text) FROM ({DOCS.split(' AS ', 1)[1][1:-1]})), {CUT},
p0 AS (SELECT sha256('figure:' || lower(pas.figure) || '|' || doc_id || '|' || place) AS id, 'figure:' || lower(pas.figure) AS session_id, pas.figure, doc_id, place::INTEGER AS place, passage AS text, pas.doc_type, {SIG.replace('doc_type', 'pas.doc_type')} AS significance,
  epoch(make_date(pub_year, 1, 1))::DOUBLE + place AS ts, CASE WHEN lang <> 'en' THEN {fixed.TRANSLATED}::DOUBLE ELSE 1.0::DOUBLE END AS auth, pub_year, pronoun FROM pas JOIN docs USING (doc_id)),
p AS MATERIALIZED (SELECT *, (row_number() OVER (PARTITION BY session_id ORDER BY ts, id) - 1)::INTEGER AS passage_idx FROM p0)"""
SCORED = f"""{P}, scored AS (SELECT *, {resistance('text', 'significance', 'doc_type')} AS resistance, {structural('text')} AS struct FROM p)"""
VOCAB = "vocab(value_name, keyword, kw_ord) AS (VALUES " + ", ".join(f"('{v}', {quote(w)}, {i})" for v, ws in b.VOCABULARY.items() for i, w in enumerate(ws)) + ")"
WORDS_LEX = "lex(word, foundation, polarity) AS (VALUES " + ", ".join(f"('{w}', '{f}', '{p}')" for w, f, p in b.LEXICON) + "), str(word, foundation, score) AS (VALUES " + ", ".join(f"('{w}', '{f}', {s}::DOUBLE)" for w, f, s in b.STRENGTH) + "), fv(foundation, value_name) AS (VALUES " + ", ".join(f"('{f}', '{v}')" for f, vs in fixed.FOUNDATIONS.items() for v in vs) + ")"
SPANS = lambda t, p: f"list_transform(range(1, len({all_of(t, p)}) + 1), lambda i: {{'s': coalesce(list_sum(list_transform((string_split_regex({t}, {quote('(?i)' + p)}))[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(({all_of(t, p)})[1:i-1], lambda x: length(x))), 0), 'n': length(({all_of(t, p)})[i])}})"
BARRED = "CASE value_name " + " ".join(f"WHEN '{v}' THEN {has('low', p)} AND len(list_filter({SPANS('low', p)}, lambda m: m.s < p0 + length(keyword) AND m.s + m.n > p0)) > 0" for v, p in fixed.DISQUALIFIERS.items()) + " ELSE FALSE END"
FAILING = "(" + ", ".join(quote(k) for k in fixed.FAILURE_KEYWORDS) + ")"
NEEDS = "(" + ", ".join(quote(k) for k in fixed.FIRST_PERSON_VALUES) + ")"


def cut_out(t: str, lo: str, hi: str) -> str:
    """Characters [lo, hi) of t, the ends clipped to it."""
    return f"substr({t}, greatest({lo}, 0) + 1, greatest(({hi}) - greatest({lo}, 0), 0))"


def hits(table: str, key: str) -> str:
    """Keyword hits of ``table`` (key, text, doc_type): hits(key, value_name, keyword, kw_ord, match_idx, valid, confidence, text)."""
    return f"""{VOCAB}, h0 AS (SELECT {key}, doc_type, text, lower(text) AS low, value_name, keyword, kw_ord, strpos(lower(text), keyword) - 1 AS p0 FROM {table} JOIN vocab ON contains(lower(text), keyword)),
h1 AS (SELECT *, {has(cut_out('low', 'p0 - 80', 'p0 + length(keyword) + 80'), fixed.FIRST_PERSON)} AS person, {BARRED} AS barred,
  {has(cut_out('low', 'p0 - 4', 'p0'), fixed.NEGATING_PREFIX)} OR (NOT {has('keyword', fixed.NEGATED_KEYWORD)} AND {has(cut_out('low', 'p0 - 30', 'p0'), fixed.NEGATION)}) AS negated FROM h0),
hits AS (SELECT {key}, value_name, keyword, kw_ord, text, p0::INTEGER AS match_idx, NOT (keyword NOT IN {FAILING} AND negated) AND NOT barred AND (value_name NOT IN {NEEDS} OR person OR doc_type = 'action') AS valid,
  CASE WHEN person THEN 1.0::DOUBLE WHEN value_name IN {NEEDS} THEN 0.7::DOUBLE ELSE 0.6::DOUBLE END AS confidence FROM h1)"""


def lexicon(table: str, key: str) -> str:
    """A lexicon signal for each (value, polarity) of ``table`` (key, text): lexs."""
    return f"""{WORDS_LEX}, terms AS (
  SELECT l.word, l.foundation, l.polarity, CASE WHEN l.polarity = 'virtue' AND s.score > 5.5 THEN round(0.55::DOUBLE + least(0.15::DOUBLE, (s.score - 5.5::DOUBLE) / 4.5::DOUBLE * 0.15::DOUBLE), 4) ELSE 0.55::DOUBLE END AS c,
    CASE WHEN (l.polarity = 'virtue' AND s.score > 5.5) OR (l.polarity = 'vice' AND s.score < 5.5) THEN 'lexicon+ms' ELSE 'lexicon' END AS tag FROM lex l LEFT JOIN str s USING (word, foundation)
  UNION ALL SELECT word, foundation, CASE WHEN score > 5.5 THEN 'virtue' ELSE 'vice' END, round(0.55::DOUBLE * (abs(score - 5.5::DOUBLE) / 4.5::DOUBLE), 4), 'lexicon+ms' FROM str WHERE word NOT IN (SELECT word FROM lex) AND round(0.55::DOUBLE * (abs(score - 5.5::DOUBLE) / 4.5::DOUBLE), 4) >= 0.2),
tok AS (SELECT {key}, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM (SELECT {key}, regexp_extract_all(lower(text), '\\b[a-z][a-z\\-'']{{1,}}\\b') AS w FROM {table})),
lexed AS (SELECT {key}, value_name, polarity, c AS confidence, tag || CASE WHEN polarity = 'vice' THEN '_vice' ELSE '' END AS source, row_number() OVER (PARTITION BY {key}, value_name, polarity ORDER BY c DESC, pos) AS rn
  FROM tok JOIN terms USING (word) JOIN fv USING (foundation)),
lexs AS (SELECT * EXCLUDE (rn) FROM lexed WHERE rn = 1)"""


def choose(by: str, table: dict, make, other: str = "FALSE") -> str:
    return f"CASE {by} " + " ".join(f"WHEN '{k}' THEN {make(v)}" for k, v in table.items()) + f" ELSE {other} END"


WORD = r"\b[a-zA-Z][a-zA-Z\-']{1,}\b"
#: Vice words with a verb before them, of p and lex: phr(id, doc_id, place, value_name, hint, spot).
PHRASE = f"""ph0 AS (SELECT id, doc_id, place, text, lower(figure) AS name, pronoun, unnest({SPANS('text', WORD)}) AS m FROM p WHERE regexp_matches(lower(text), '{"|".join(w for w, _, pol in b.LEXICON if pol == "vice")}')),
ph1 AS (SELECT ph0.*, m.s::BIGINT AS s, (m.s + m.n)::BIGINT AS e, foundation FROM ph0 JOIN lex ON lower(substr(text, m.s::BIGINT + 1, m.n)) = word AND polarity = 'vice'),
ph2 AS (SELECT *, {cut_out('text', f's - {fixed.VERB_WINDOW}', 's')} AS before, substr(text, e + 1, {fixed.OBJECT_WINDOW}) AS after FROM ph1),
ph3 AS (SELECT *, CASE WHEN {has('before', fixed.DESTRUCTIVE)} THEN length((string_split_regex(before, {quote('(?i)' + fixed.DESTRUCTIVE)}))[1]) ELSE -1 END AS verb FROM ph2),
ph4 AS (SELECT *, lower({cut_out('before', f'verb - {fixed.SUBJECT_WINDOW}', 'verb')}) AS near, lower(regexp_extract(after, {quote('(?i)' + fixed.RECIPIENT)}, 1)) AS towards FROM ph3),
ph5 AS (SELECT *, CASE WHEN verb >= 0 THEN CASE
    WHEN pronoun IN ({", ".join(map(quote, fixed.SUBJECTS))}) AND ({choose('pronoun', fixed.SUBJECTS, lambda w: f"regexp_matches(near, {quote(any_of(w))})")} OR contains(' ' || regexp_replace(near, '\\W', ' ', 'g') || ' ', ' ' || regexp_replace(name, '\\W', ' ', 'g') || ' ')) THEN -1
    WHEN {choose('pronoun', fixed.OBJECTS, lambda w: "towards IN (" + ", ".join(map(quote, w)) + ")")} THEN NULL
    WHEN {choose('pronoun', fixed.SUBJECTS, lambda w: f"regexp_matches(near, {quote(any_of(tuple(x for x in fixed.ANY_SUBJECT if x not in w)))})")} THEN NULL ELSE -1 END WHEN {has('before', fixed.OPPOSITION)} THEN 1 END AS hint FROM ph4),
phr AS (SELECT id, doc_id, place, value_name, hint::INTEGER AS hint, min(s)::INTEGER AS spot FROM ph5 JOIN fv USING (foundation) WHERE hint IS NOT NULL GROUP BY ALL)"""
POS_T, NEG_T = any_of(fixed.POSITIVE_TARGETS), any_of(fixed.NEGATIVE_TARGETS)


def first_tier(table: str, w: str, keep: str, name: str) -> str:
    """``name`` (keep, p, c): the polarity of lower-cased ``w`` of ``table``."""
    return f"""{name}0 AS (SELECT {keep}, {SPANS(w, POS_T)} AS pos, {SPANS(w, NEG_T)} AS neg, {SPANS(w, fixed.INVERSION)} AS inv FROM {table}),
{name}1 AS (SELECT {keep}, len(pos) AS n, len(neg) AS m, len(list_filter(inv, lambda i: len(list_filter(list_concat(pos, neg), lambda t: abs(i.s - t.s) <= 30)) > 0)) > 0 AS turned FROM {name}0),
{name} AS (SELECT {keep}, (CASE WHEN n > m THEN CASE WHEN turned THEN -1 ELSE 1 END WHEN m > n THEN CASE WHEN turned THEN 1 ELSE -1 END ELSE 0 END)::INTEGER AS p, CASE WHEN n = m THEN 0.0::DOUBLE WHEN n > 0 AND m > 0 THEN 0.6::DOUBLE WHEN turned THEN 0.68::DOUBLE ELSE 0.8::DOUBLE END AS c FROM {name}1)"""


#: Polarity and its confidence of (p, c, vice, virtue).
SIGN = "(CASE WHEN vice <= 0 AND virtue <= 0 THEN p WHEN p = 0 AND vice > virtue AND vice >= 0.4 THEN -1 WHEN p = 0 AND virtue > vice AND virtue >= 0.4 THEN 1 WHEN p = 0 THEN 0 WHEN p = -1 AND vice > 0 THEN -1 WHEN p = 1 AND virtue > 0 THEN 1 WHEN p = 1 AND vice > c THEN -1 WHEN p = -1 AND virtue > c THEN 1 ELSE p END)::INTEGER"
SURE = """(CASE WHEN vice <= 0 AND virtue <= 0 THEN c WHEN p = 0 AND vice > virtue AND vice >= 0.4 THEN least(vice * 0.75::DOUBLE, 0.6::DOUBLE) WHEN p = 0 AND virtue > vice AND virtue >= 0.4 THEN least(virtue * 0.75::DOUBLE, 0.6::DOUBLE) WHEN p = 0 THEN 0::DOUBLE WHEN p = -1 AND vice > 0 THEN round(least(1, c + vice * 0.15::DOUBLE), 4)
  WHEN p = 1 AND virtue > 0 THEN round(least(1, c + virtue * 0.15::DOUBLE), 4) WHEN p = 1 AND vice > c THEN round(vice * 0.65::DOUBLE, 4) WHEN p = -1 AND virtue > c THEN round(virtue * 0.65::DOUBLE, 4) ELSE c END)"""
#: The bound models' scores: sem(id, value_name, c), zs(id, value_name, c), cls(id, label, score), cl(id, value_name, ord, score), verdict(id, value_name, verdict).
VALUE_LIST = "[" + ", ".join(f"'{v}'" for v in fixed.VALUES) + "]"
SAID = ", ".join(f"('{label}', {i}, '{v}', 1.0::DOUBLE)" for i, (label, (f, pol)) in enumerate(fixed.CLASSIFIER_LABELS.items()) if pol == "virtue" for v in fixed.CLASSIFIER_VALUES[f]) + ", " + ", ".join(f"('LABEL_7', 7, '{v}', {fixed.DEFIANCE_DISCOUNT}::DOUBLE)" for v in fixed.DEFIANCE_VALUES)
SEED_ROWS = ", ".join(f"('{v}', '{kind}', {i}, {quote(x)})" for v, both in b.SEEDS.items() for kind, of in zip(("hold", "failure"), both, strict=True) for i, x in enumerate(of))
#: Likeness of texts to prototypes: hashed features of p's and the seeds' words, weighted and compared: sim(id, value_name, hold, fail).
LIKE = f"""seed(value_name, kind, ord, text) AS (VALUES {SEED_ROWS}), words AS (SELECT id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+')) AS w FROM p),
seedwords AS (SELECT value_name, kind, ord, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+')) AS w FROM seed),
feature AS (SELECT w, md5(unnest(list_concat(['w:' || w], list_transform(range(1, length(w) + 1), lambda i: 'g:' || substr('_' || w || '_', i, 3))))) AS h FROM (SELECT w FROM words UNION SELECT w FROM seedwords)),
part AS (SELECT w, ('0x' || substr(h, 1, 8))::BIGINT % 512 AS d, sum(CASE WHEN ('0x' || substr(h, 9, 2))::INTEGER % 2 = 1 THEN 1 ELSE -1 END) AS s FROM feature GROUP BY ALL),
tf AS (SELECT id, d, sum(s)::DOUBLE AS x FROM words JOIN part USING (w) GROUP BY id, d), rows AS (SELECT count(*)::DOUBLE AS n FROM p),
weight AS (SELECT g.d, ln((1 + n) / (1 + coalesce(df, 0))) + 1 AS k FROM (SELECT unnest(range(512)) AS d) g CROSS JOIN rows LEFT JOIN (SELECT d, count(*) AS df FROM tf GROUP BY d) USING (d)),
pv AS (SELECT id, d, x * k AS v FROM tf JOIN weight USING (d) WHERE x <> 0), pn AS (SELECT id, sqrt(sum(v * v)) AS norm FROM pv GROUP BY id),
sv AS (SELECT value_name, kind, ord, d, sum(s) * any_value(k) AS v FROM seedwords JOIN part USING (w) JOIN weight USING (d) GROUP BY ALL),
su AS (SELECT value_name, kind, d, v / sqrt(sum(v * v) OVER (PARTITION BY value_name, kind, ord)) AS v FROM sv), sc AS (SELECT value_name, kind, d, sum(v) AS v FROM su GROUP BY ALL),
proto AS (SELECT value_name, kind, d, v / sqrt(sum(v * v) OVER (PARTITION BY value_name, kind)) AS v FROM sc),
cosine AS (SELECT id, value_name, kind, sum(pv.v * proto.v) / any_value(norm) AS c FROM pv JOIN proto USING (d) JOIN pn USING (id) GROUP BY id, value_name, kind),
sim AS (SELECT id, value_name, round(max(c) FILTER (kind = 'hold'), 4) AS hold, round(coalesce(max(c) FILTER (kind = 'failure'), 0), 4) AS fail FROM cosine GROUP BY id, value_name)"""
MODELS = f"""{LIKE}, sm AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY hold DESC, value_name) AS place FROM sim WHERE hold >= {b.LIKENESS.semantic_threshold}),
sem AS (SELECT id, value_name, round((hold - 0.5::DOUBLE * fail) * 0.8::DOUBLE, 4) AS c FROM sm WHERE place <= {fixed.SEMANTIC_TOP} AND hold > fail),
zs AS (SELECT id, {VALUE_LIST}[(doc_id * 3 + place) % 15 + 1] AS value_name, 0.3::DOUBLE + ((doc_id * 13 + place * 5) % 45) / 100::DOUBLE AS c FROM p),
cls AS (SELECT id, 'LABEL_' || ((doc_id + place) % 10) AS label, 0.5::DOUBLE + ((doc_id * 7 + place * 11) % 36) / 100::DOUBLE AS score FROM p),
said(label, ord, value_name, weight) AS (VALUES {SAID}), cl AS (SELECT id, value_name, ord, round(score * weight, 4) AS score FROM cls JOIN said USING (label) WHERE score >= 0.6),
verdict AS (SELECT id, value_name, ['P1', 'P0', 'tension', 'discard', 'skip'][(doc_id + place + length(value_name)) % 5 + 1] AS verdict FROM p, (SELECT unnest({VALUE_LIST}) AS value_name) WHERE (doc_id + place) % 17 = 0)"""
#: The whole extraction: sig, all signals in merge order, and obs, the observations.
OBS = f"""{P}, {hits('p', 'id')}, kw AS (SELECT id, value_name, arg_min({{'c': confidence, 'i': match_idx, 'k': length(keyword), 't': text}}, kw_ord) AS b FROM hits WHERE valid GROUP BY id, value_name),
kwx AS (SELECT *, lower({cut_out('b.t', 'b.i - 120', 'b.i + 120')}) AS w FROM kw), {first_tier('kwx', 'w', 'id, value_name', 'around')}, {lexicon('p', 'id')}, {PHRASE}, {MODELS},
f0 AS (SELECT *, {resistance('text', 'significance', 'doc_type')} AS raw, {structural('text')} AS s, lower(text) AS low, {DISCOUNT} AS y FROM p), f1 AS (SELECT * FROM f0 WHERE raw >= 0.2), {first_tier('f1', 'low', 'id', 'whole')},
keyed AS (SELECT id, value_name FROM kw UNION SELECT id, value_name FROM lexs UNION SELECT id, value_name FROM phr UNION SELECT id, value_name FROM sem UNION SELECT id, value_name FROM zs UNION SELECT id, value_name FROM cl),
w AS (SELECT k.id, k.value_name, kw.b AS kb, v.confidence AS vc, v.source AS vs, n.confidence AS nc, n.source AS ns, sem.c AS sc, CASE WHEN zs.c >= 0.35 THEN zs.c END AS zc, cl.score AS cc, f1.* EXCLUDE (id),
    CASE WHEN kw.b IS NOT NULL AND v.confidence IS NOT NULL THEN round(least(1, kw.b.c + 0.15::DOUBLE * v.confidence), 4) WHEN kw.b IS NOT NULL THEN kw.b.c WHEN v.confidence >= 0.55 THEN v.confidence END AS bc, CASE WHEN kw.b IS NOT NULL AND v.confidence IS NOT NULL THEN 'keyword+lexicon' WHEN kw.b IS NOT NULL THEN 'keyword' ELSE v.source END AS bs
  FROM keyed k JOIN f1 USING (id) LEFT JOIN kw ON kw.id = k.id AND kw.value_name = k.value_name LEFT JOIN lexs v ON v.id = k.id AND v.value_name = k.value_name AND v.polarity = 'virtue' LEFT JOIN lexs n ON n.id = k.id AND n.value_name = k.value_name AND n.polarity = 'vice'
  LEFT JOIN sem ON sem.id = k.id AND sem.value_name = k.value_name LEFT JOIN zs ON zs.id = k.id AND zs.value_name = k.value_name LEFT JOIN cl ON cl.id = k.id AND cl.value_name = k.value_name),
r1 AS (SELECT w.*, CASE WHEN kb IS NULL THEN 1 ELSE 0 END AS layer, bc AS c0, bs AS src, NULL::INTEGER AS hint, CASE WHEN kb IS NOT NULL THEN kb.i END AS spot FROM w WHERE bc IS NOT NULL UNION ALL SELECT w.*, 2, {fixed.PHRASE_CONFIDENCE}::DOUBLE, 'phrase_layer', hint, spot FROM w JOIN phr USING (id, value_name)),
has1 AS (SELECT DISTINCT id, value_name FROM r1),
r2 AS (SELECT * REPLACE (CASE WHEN sc IS NULL THEN c0 ELSE round(least(1, c0 + 0.2::DOUBLE * sc), 4) END AS c0, src || CASE WHEN sc IS NULL THEN '' ELSE '+semantic' END AS src) FROM r1
  UNION ALL SELECT w.*, 3, sc, 'semantic', NULL, NULL FROM w ANTI JOIN has1 USING (id, value_name) WHERE sc IS NOT NULL),
r3 AS (SELECT * REPLACE (CASE WHEN s > 0 THEN round(least(1, c0 + round(0.15::DOUBLE * s, 4)), 4) ELSE c0 END AS c0, src || CASE WHEN s > 0 THEN '+structural' ELSE '' END AS src) FROM r2), has3 AS (SELECT DISTINCT id, value_name FROM r3),
r4 AS (SELECT * REPLACE (CASE WHEN zc IS NULL THEN c0 ELSE round(least(1, c0 + 0.15::DOUBLE * zc), 4) END AS c0, src || CASE WHEN zc IS NULL THEN '' ELSE '+zeroshot' END AS src) FROM r3
  UNION ALL SELECT w.*, 4, round(zc, 4), 'zeroshot', NULL, NULL FROM w ANTI JOIN has3 USING (id, value_name) WHERE zc >= 0.7), has4 AS (SELECT DISTINCT id, value_name FROM r4),
r5 AS (SELECT * REPLACE (CASE WHEN cc IS NULL THEN c0 ELSE round(least(1, c0 + round(0.1::DOUBLE * cc, 4)), 4) END AS c0, src || CASE WHEN cc IS NULL THEN '' ELSE '+mft' END AS src) FROM r4
  UNION ALL SELECT w.*, 5, round(0.5::DOUBLE * cc, 4), 'mft', NULL, NULL FROM w ANTI JOIN has4 USING (id, value_name) WHERE cc >= 0.8), has5 AS (SELECT DISTINCT id, value_name FROM r5),
r6 AS (SELECT * FROM r5 UNION ALL SELECT w.*, 6, nc, ns, -1, NULL FROM w ANTI JOIN has5 USING (id, value_name) WHERE nc >= 0.55),
r7 AS (SELECT r6.*, verdict, 2 * (row_number() OVER (PARTITION BY id, value_name ORDER BY layer, spot) - 1) AS o FROM r6 LEFT JOIN verdict USING (id, value_name)),
r8 AS (SELECT * REPLACE (coalesce(told, hint) AS hint, src || CASE WHEN told IS NULL THEN '' ELSE '+panel' END AS src, (o + CASE WHEN verdict = 'tension' AND told = -1 THEN 1 ELSE 0 END)::INTEGER AS o) FROM (SELECT *, unnest(CASE verdict WHEN 'P1' THEN [1] WHEN 'P0' THEN [-1] WHEN 'tension' THEN [1, -1] ELSE [NULL::INTEGER] END) AS told FROM r7 WHERE verdict IS NULL OR verdict <> 'discard')),
r9 AS (SELECT r8.*, round(greatest(0, least(1, c0 * auth * y)), 4) AS dc, round(raw * round(0.85::DOUBLE + 0.15::DOUBLE * s, 4), 4) AS resistance, coalesce(vc, 0) AS virtue, coalesce(nc, 0) AS vice,
    CASE WHEN layer = 0 THEN a.p ELSE wh.p END AS p, CASE WHEN layer = 0 THEN a.c ELSE wh.c END AS c FROM r8 JOIN whole wh USING (id) LEFT JOIN around a ON a.id = r8.id AND a.value_name = r8.value_name),
sig AS MATERIALIZED (SELECT *, CASE WHEN hint IS NOT NULL THEN hint ELSE {SIGN} END AS pol, greatest(0, least(1, CASE WHEN hint IS NOT NULL THEN dc ELSE {SURE} END)) AS pc,
    CASE WHEN layer = 0 THEN substr(CASE WHEN kb.i - 40 > 0 THEN '...' ELSE '' END || regexp_replace({cut_out('text', 'kb.i - 40', 'least(kb.i + kb.k + 60, length(text))')}, '^\\s+|\\s+$', '', 'g') || CASE WHEN kb.i + kb.k + 60 < length(text) THEN '...' ELSE '' END, 1, 150)
      WHEN layer = 5 THEN substr(text, 1, 200) WHEN length(text) <= 150 THEN text ELSE substr(text, 1, 147) || '...' END AS excerpt FROM r9),
obs AS MATERIALIZED (SELECT session_id, id AS record_id, value_name, ts, passage_idx, excerpt AS text_excerpt, doc_type, significance, resistance, dc AS disambiguation_confidence, src AS source, pol AS value_polarity, pc AS polarity_confidence, id || '|' || value_name AS source_obs_id, doc_id FROM sig WHERE o = 0)"""
CONSISTENCY = """round(greatest(0, least(1, 0.30::DOUBLE * least(1, n / 10.0::DOUBLE) + 0.30::DOUBLE * CASE WHEN n < 2 OR res = 0 THEN 0 ELSE greatest(0, 1 - sigma / 0.40::DOUBLE) END
  + 0.25::DOUBLE * least(1, span / 31536000.0::DOUBLE) + 0.15::DOUBLE * least(1, types / 3.0::DOUBLE))), 4)"""
REG = f"""{OBS}, grouped AS (SELECT session_id, value_name, count(*) AS n, avg(significance) AS sig, avg(resistance) AS res, stddev_pop(resistance) AS sigma, min(ts) AS first_seen_ts, max(ts) AS last_seen_ts, max(ts) - min(ts) AS span, count(DISTINCT doc_type) AS types FROM obs GROUP BY ALL),
reg AS (SELECT session_id, value_name, n AS demonstrations, round(sig, 4) AS avg_significance, round(res, 4) AS avg_resistance, {CONSISTENCY} AS consistency, round(n * sig * res * {CONSISTENCY}, 4) AS weight, first_seen_ts, last_seen_ts FROM grouped)"""
SOURCES = """src AS (SELECT 'figure:' || lower(source) AS session_id, source AS figure_name, 'mixed' AS document_type, count(*) AS passage_count FROM documents GROUP BY source)"""
PANEL = "contains(source, 'panel') AND value_polarity <> 0 AND l.label <> 'APY'"
#: The events but those that the stream's feed delivers after all others.
ON_TIME = "timely AS (SELECT * FROM events WHERE event_id % 20 <> 0 OR ts::DATE - (SELECT min(ts)::DATE FROM events) >= 6)"
RECORDS = f"""{REG}, {SOURCES}, lab AS (SELECT o.*, coalesce(s.figure_name, substr(o.session_id, 8)) AS figure_name, coalesce(s.document_type, 'unknown') AS document_type, coalesce(r.consistency, 0.5) AS observation_consistency, {label('text_excerpt', 'resistance')} AS l
  FROM obs o LEFT JOIN src s USING (session_id) LEFT JOIN reg r USING (session_id, value_name)),
rec0 AS (SELECT *, CASE WHEN {PANEL} THEN CASE WHEN value_polarity > 0 THEN 'P1' ELSE 'P0' END ELSE l.label END AS label, CASE WHEN {PANEL} THEN CASE WHEN value_polarity > 0 THEN 'panel_confirmed_p1' ELSE 'panel_confirmed_p0' END ELSE l.why END AS label_reason, l.conf AS confidence,
  round({by_kind('doc_type', fixed.TRAINING_WEIGHT, 1.0)} * significance, 4) AS training_weight FROM lab),
rec AS (SELECT *, CASE label WHEN 'APY' THEN 'APY' WHEN 'P0' THEN CASE WHEN {has('text_excerpt', fixed.FAILURE_MARKERS)} THEN 'SO' ELSE 'UA' END ELSE '' END AS fail_mode FROM rec0)"""
PRESSURE = f"""pr AS (SELECT session_id, id AS record_id, ts, passage_idx, array_to_string(list_transform({all_of('text', fixed.PRESSURE_MARKERS)}, lambda x: lower(x)), ', ') AS markers FROM p WHERE {has('text', fixed.PRESSURE_MARKERS)})"""
UPGRADED = f"""{RECORDS}, {PRESSURE}, best AS (
  SELECT r.record_id, r.value_name, p.record_id AS pid, r.ts - p.ts AS lag_s, r.passage_idx - p.passage_idx AS lag_n, row_number() OVER (PARTITION BY r.record_id, r.value_name ORDER BY p.ts DESC, p.passage_idx DESC) AS rn
  FROM rec r JOIN pr p ON r.session_id = p.session_id AND p.ts <= r.ts WHERE r.label = 'P0'),
near AS (SELECT * FROM best WHERE rn = 1 AND (lag_s <= 259200 OR lag_n <= 5)),
upg AS (SELECT r.session_id, r.record_id, r.value_name, r.text_excerpt, CASE WHEN pid IS NULL THEN label ELSE 'APY' END AS label, CASE WHEN pid IS NULL THEN label_reason ELSE 'cross_passage_apy_pressure_context' END AS label_reason,
  CASE WHEN pid IS NULL THEN confidence ELSE 0.85::DOUBLE END AS confidence, CASE WHEN pid IS NULL THEN fail_mode ELSE 'APY' END AS fail_mode, pid AS pressure_source_id, round(lag_s, 1) AS deferred_apy_lag_s, CASE WHEN pid IS NOT NULL THEN greatest(0, lag_n) END::INTEGER AS deferred_apy_lag_n
  FROM rec r LEFT JOIN near USING (record_id, value_name))"""
PAIRS = f"""{RECORDS}, pairs AS (SELECT a.session_id, a.record_id, a, b FROM rec a JOIN rec b ON a.session_id = b.session_id AND a.record_id = b.record_id AND a.value_name < b.value_name)"""
ACROSS = """SELECT value_name, sum(demonstrations)::BIGINT AS total_demonstrations, round(avg(weight), 4) AS avg_weight, round(avg(avg_significance), 4) AS avg_significance, round(avg(avg_resistance), 4) AS avg_resistance, count(DISTINCT session_id) AS figure_count FROM reg GROUP BY value_name"""
HIST = lambda c: f"""WITH {OBS} SELECT count(*) AS n, round(avg({c}), 4) AS mean, round(stddev_pop({c}), 4) AS std, min({c}) AS min, max({c}) AS max, round(median({c}), 4) AS median, """ + ", ".join(f"count(*) FILTER ({c} >= {lo}{f' AND {c} < {hi}' if hi else ''}) AS bucket_{i}" for i, (lo, hi) in enumerate(((0, 0.2), (0.2, 0.4), (0.4, 0.6), (0.6, 0.8), (0.8, None)))) + " FROM obs"
PIVOT = lambda by: f"""WITH {RECORDS} SELECT {by}, count(*) FILTER (label = 'P1') AS p1, count(*) FILTER (label = 'P0') AS p0, count(*) FILTER (label = 'APY') AS apy, count(*) FILTER (label = 'AMBIGUOUS') AS ambiguous, count(*) AS total, round(sum(training_weight), 4) AS total_weight FROM rec GROUP BY {by}"""
QUALITY_TIERS = f"""docsq AS (SELECT lower(source) AS figure_name, count(*) AS document_count, list_sort(list(DISTINCT {KIND_SQL})) AS types FROM documents GROUP BY ALL),
everyq AS (SELECT f.figure_name, coalesce(document_count, 0) AS document_count, coalesce(types, []) AS types FROM (SELECT DISTINCT lower(source) AS figure_name FROM documents) f LEFT JOIN docsq USING (figure_name)),
q AS (SELECT figure_name, document_count, array_to_string(types, ',') AS doc_types, len(types)::INTEGER AS distinct_doc_type_count, CASE WHEN document_count >= 3 AND len(types) >= 2 THEN 'confident' WHEN document_count >= 2 THEN 'partial' ELSE 'preliminary' END AS confidence_tier,
  document_count >= 3 AND len(types) >= 2 AS approved_for_export, CASE WHEN document_count = 0 THEN 'no documents registered' WHEN document_count >= 3 AND len(types) >= 2 THEN '' ELSE 'needs ' || concat_ws(' and ', CASE WHEN document_count < 3 THEN (3 - document_count) || ' more document(s)' END, CASE WHEN len(types) < 2 THEN (2 - len(types)) || ' more document type(s)' END) END AS notes FROM everyq)"""
PRF = lambda p, g, name, n="1": f"""round(coalesce(sum({n}) FILTER ({p} = '{name}' AND {g} = '{name}') / nullif(sum({n}) FILTER ({p} = '{name}'), 0)::DOUBLE, 0), 4) AS {name.lower()}_precision, round(coalesce(sum({n}) FILTER ({p} = '{name}' AND {g} = '{name}') / nullif(sum({n}) FILTER ({g} = '{name}'), 0)::DOUBLE, 0), 4) AS {name.lower()}_recall,
  round(coalesce(2 * sum({n}) FILTER ({p} = '{name}' AND {g} = '{name}') / nullif(coalesce(sum({n}) FILTER ({p} = '{name}'), 0) + coalesce(sum({n}) FILTER ({g} = '{name}'), 0), 0)::DOUBLE, 0), 4) AS {name.lower()}_f1"""  # noqa: E731
#: Observations of labelled documents as annotations, and their majority: an(text_excerpt, value_name, label, source_obs_id), merged(key, value_name, label, vote_counts, n_annotators, agreed).
GOLD = """an AS (SELECT text_excerpt, value_name, CASE WHEN quality = 1 THEN 'P1' WHEN toxic = 1 THEN 'APY' ELSE 'P0' END AS label, source_obs_id FROM obs JOIN labels USING (doc_id)),
v AS (SELECT substr(text_excerpt, 1, 80) AS key, value_name, label, count(*) AS n FROM an WHERE text_excerpt <> '' GROUP BY ALL), g AS (SELECT key, value_name, max(n) AS top, sum(n)::BIGINT AS n_annotators, count(*) AS kinds, '{' || string_agg('"' || label || '":' || n, ',' ORDER BY label) || '}' AS vote_counts FROM v GROUP BY ALL),
win AS (SELECT key, value_name, min(label) AS label, count(*) AS k FROM v JOIN g USING (key, value_name) WHERE n = top GROUP BY ALL),
merged AS (SELECT key, value_name, CASE WHEN k = 1 THEN label ELSE 'AMBIGUOUS' END AS label, vote_counts, n_annotators, kinds = 1 AS agreed FROM g JOIN win USING (key, value_name))"""
THREE = lambda p, g: ", ".join(PRF(p, g, name) for name in ("P1", "P0", "APY"))
METRICS = f"""{RECORDS}, lc AS (SELECT label, count(*) AS c FROM rec GROUP BY label), fc AS (SELECT figure_name, count(*) AS c FROM rec GROUP BY figure_name),
m AS (SELECT count(*) AS record_count, count(DISTINCT value_name) AS value_coverage, round(avg(confidence), 4) AS avg_confidence, round(avg(resistance), 4) AS resistance_mean, round(stddev_pop(resistance), 4) AS resistance_spread,
  count(DISTINCT CASE WHEN lower(document_type) <> 'unknown' THEN document_type END) AS source_diversity, round(count(*) FILTER (disambiguation_confidence >= 0.8) / count(*)::DOUBLE, 4) AS disambiguation_rate, round(quantile_cont(observation_consistency::DOUBLE, 0.05), 4) AS consistency_pct5,
  round(count(*) FILTER (length(text_excerpt) >= 30) / count(*)::DOUBLE, 4) AS text_quality_rate, count(*) FILTER (label = 'P1') > 0 AS has_p1, count(*) FILTER (label = 'P0') > 0 AS has_p0,
  (SELECT arg_min(label, {{'c': -c, 'l': label}}) FROM lc) AS max_label_name, (SELECT count(*) FROM lc WHERE c >= 2) AS distinct_labels_with_mass, (SELECT min(c) FROM fc) AS min_figure_records, (SELECT arg_min(figure_name, {{'c': c, 'f': figure_name}}) FROM fc) AS weakest_figure,
  round((SELECT max(c) FROM lc) / count(*)::DOUBLE, 4) AS max_label_pct FROM rec)"""
CHECKS = [
    ("Record Count", "record_count", ">=", 20), ("Value Coverage", "value_coverage", ">=", 5), ("Label Balance", "max_label_pct", "<=", 0.8), ("P1+P0 Present", "(has_p1 AND has_p0)::INTEGER", ">=", 1), ("Avg Confidence", "avg_confidence", ">=", 0.65), ("Resistance Spread", "resistance_spread", ">=", 0.1),
    ("Source Diversity", "source_diversity", ">=", 2), ("Disambiguation Rate", "disambiguation_rate", ">=", 0.85), ("Consistency Floor", "consistency_pct5", ">=", 0.25), ("Text Quality", "text_quality_rate", ">=", 0.9), ("Per-Figure Minimum", "min_figure_records", ">=", 5),
]
INNER = [
    ("P1 Resistance Coherence", "1 - count(*) FILTER (label = 'P1' AND resistance < 0.55 AND label_reason NOT IN (" + ", ".join(quote(r) for r in fixed.MARKER_REASONS) + ")) / nullif(count(*) FILTER (label = 'P1'), 0)::DOUBLE", ">=", 0.85),
    ("Label-Reason Coherence", "1 - count(*) FILTER (label_reason <> '' AND ((label = 'P1' AND contains(label_reason, 'p0') AND NOT contains(label_reason, 'pressure')) OR (label = 'P0' AND contains(label_reason, 'held') AND NOT contains(label_reason, 'panel')) OR (label = 'APY' AND contains(label_reason, 'held') AND NOT contains(label_reason, 'pressure')))) / count(*)::DOUBLE", ">=", 0.95),
    ("Signal Conflict Rate", "count(*) FILTER (confidence >= 0.8 AND disambiguation_confidence < 0.5) / count(*)::DOUBLE", "<=", 0.05),
]
LOG = f"""log AS (SELECT 'figure:' || lower(source) AS session_id, source AS figure, CASE WHEN doc_id % 40 < 20 THEN 'journal' ELSE {KIND_SQL} END AS document_type, 2 AS passage_count, CASE WHEN doc_id % 3 = 0 THEN 'she' ELSE 'unknown' END AS pronoun, doc_id::DOUBLE AS ingested_at FROM documents)"""
#: The halves and leave-one-out checks of the third layer.
STABLE = f"""halves AS (SELECT half, count(DISTINCT value_name) AS vc, avg(confidence) AS ac FROM (SELECT *, (row_number() OVER (ORDER BY figure_name, value_name, substr(text_excerpt, 1, 40), ts, label, confidence) - 1) % 2 AS half FROM rec) GROUP BY half),
own AS (SELECT value_name, count(DISTINCT figure_name) AS n, min(figure_name) AS f FROM rec GROUP BY value_name), lofo AS (SELECT g.figure_name, (SELECT count(*) FROM own) - (SELECT count(*) FROM own WHERE n = 1 AND f = g.figure_name) AS remaining FROM (SELECT DISTINCT figure_name FROM rec) g),
outcome AS (SELECT (SELECT count(*) >= 2 FROM halves WHERE vc >= 5 AND ac >= 0.65)::INTEGER::DOUBLE AS a, (SELECT count(*) < 2 OR count(*) FILTER (remaining < 5) = 0 FROM lofo)::INTEGER::DOUBLE AS b),
stable AS (SELECT 'L3' AS layer, 'Split-Half Consistency' AS metric, a AS value, '>=' AS op, 1::DOUBLE AS threshold, a >= 1 AS passed FROM outcome UNION ALL SELECT 'L3', 'Figure Independence', b, '>=', 1, b >= 1 FROM outcome)"""
#: The ranges' hashes: chunks of 1024 leaves, and the chunks of a range that has several (up to a million records of a range, and 1024 ranges).
RANGES = f"""{RECORDS}, leaf AS (SELECT figure_name AS figure, value_name, sha256(concat_ws(chr(1), figure_name, value_name, substr(text_excerpt, 1, 80), label, printf('%.4f', round(resistance, 4)), printf('%.2f', round(confidence, 2)))) AS h,
  row_number() OVER (PARTITION BY figure_name, value_name ORDER BY substr(text_excerpt, 1, 80), ts, label, round(resistance, 4), confidence) - 1 AS k FROM rec),
chunks AS (SELECT figure, value_name, k // 1024 AS c, CASE WHEN count(*) = 1 AND min(k) = 0 THEN min(h) ELSE sha256(string_agg(h, '' ORDER BY k)) END AS h FROM leaf GROUP BY ALL),
ranges AS (SELECT figure, value_name, CASE WHEN count(*) = 1 THEN min(h) ELSE sha256(string_agg(h, '' ORDER BY c)) END AS hash FROM chunks GROUP BY ALL)"""
CHECKED = " UNION ALL ".join(
    [f"SELECT 'L1' AS layer, '{n}' AS metric, round(({v})::DOUBLE, 4) AS value, '{o}' AS op, {t}::DOUBLE AS threshold, {v} {o} {t} AS passed FROM m" for n, v, o, t in CHECKS]
    + [f"SELECT * FROM (SELECT 'L2' AS layer, '{n}' AS metric, round({v}, 4) AS value, '{o}' AS op, {t}::DOUBLE AS threshold, round({v}, 4) {o} {t} AS passed FROM rec) WHERE value IS NOT NULL" for n, v, o, t in INNER]
)


def _ties_up(sql: str) -> str:
    """Rounding to four places as the engine defines it: a decimal tie goes up, whatever the last bit of its double."""
    out, i = "", 0
    while (j := sql.find("round(", i)) >= 0:
        k, depth, comma, quoted = j + 6, 1, None, False
        p = k
        while depth:
            c = sql[p]
            if c == "'":
                quoted = not quoted
            elif not quoted:
                depth += (c in "([{") - (c in ")]}")
                comma = p if c == "," and depth == 1 else comma
            p += 1
        if comma and sql[comma + 1:p - 1].strip() == "4":
            out += f"{sql[i:j]}(floor(({_ties_up(sql[k:comma])}) * 10000 + 0.5000001::DOUBLE) / 10000)"
            i = p
        else:
            out += sql[i:k]
            i = k
    return out + sql[i:]


ORACLES: dict[str, str] = {
    "q_segment": f"WITH {PASSAGES} SELECT doc_id, place::INTEGER AS place, length(passage)::INTEGER AS chars, md5(passage) AS passage_md5 FROM pas",
    "q_segment_stats": f"WITH {PASSAGES} SELECT figure, doc_type, count(*) AS passages, sum(length(passage))::BIGINT AS chars, max(length(passage))::INTEGER AS longest FROM pas GROUP BY ALL",
    "q_flagship": f"""WITH {P}, x AS (SELECT session_id, doc_type, {resistance('text', 'significance', 'doc_type')} AS r, {structural('text')} AS s FROM p)
SELECT session_id, doc_type, count(*) AS passages, round(avg(r), 4) AS avg_resistance, round(max(r), 4) AS max_resistance, round(avg(s), 4) AS avg_structure, count(*) FILTER (r >= 0.6) AS costly FROM x GROUP BY ALL""",
    "q_resistance": f"WITH {SCORED} SELECT doc_id, place, doc_type, resistance, struct, round(resistance * round(0.85::DOUBLE + 0.15::DOUBLE * struct, 4), 4) AS modulated FROM scored",
    "q_resistance_hist": HIST("resistance"),
    "q_significance_hist": HIST("significance"),
    "q_markers": f"WITH {P} SELECT doc_id, place, " + ", ".join(f"array_to_string(list_transform({all_of('text', p)}, lambda x: lower(x)), '|') AS {n}" for n, p in (("pressure", fixed.PRESSURE_MARKERS), ("failure", fixed.FAILURE_MARKERS), ("hold", fixed.HOLD_MARKERS))) + " FROM p",
    "q_passages": f"WITH {P} SELECT id, session_id, doc_id, place, ts, auth AS source_authenticity, passage_idx, length(text)::INTEGER AS chars FROM p",
    "q_calibrated": f"""WITH {DOCS}, a AS (SELECT *, CASE WHEN doc_id % 4 <> 0 AND lang <> 'en' THEN 0.85::DOUBLE WHEN doc_id % 4 <> 0 OR lang = 'en' THEN 1.0::DOUBLE ELSE 0.7::DOUBLE END AS au, {DISCOUNT} AS y FROM docs)
SELECT doc_id, au AS authenticity, y AS discount, round(0.7::DOUBLE * au * y, 4) AS calibrated, round({by_kind('doc_type', fixed.TRAINING_WEIGHT, 1.0)} * {SIG}, 4) AS training_weight FROM a""",
    "q_keyword_hits": f"WITH {DOCS}, {hits('docs', 'doc_id')} SELECT doc_id, value_name, keyword, match_idx, valid, confidence FROM hits",
    "q_keyword_signals": f"WITH {DOCS}, {hits('docs', 'doc_id')} SELECT doc_id, value_name, arg_min(keyword, kw_ord) AS keyword, arg_min(confidence, kw_ord) AS confidence, arg_min(match_idx, kw_ord) AS match_idx FROM hits WHERE valid GROUP BY ALL",
    "q_lexicon_signals": f"WITH {DOCS}, {lexicon('docs', 'doc_id')} SELECT doc_id, value_name, polarity, confidence, source FROM lexs",
    "q_phrase_signals": f"WITH {P}, {WORDS_LEX}, {PHRASE} SELECT doc_id, place, value_name, hint AS polarity_hint, spot AS match_idx, {fixed.PHRASE_CONFIDENCE}::DOUBLE AS confidence FROM phr",
    "q_polarity": f"""WITH {P}, {lexicon('p', 'id')}, low AS (SELECT id, doc_id, place, lower(text) AS low FROM p), {first_tier('low', 'low', 'id, doc_id, place', 't')},
t3 AS (SELECT doc_id, place, p, c, coalesce(vice, 0) AS vice, coalesce(virtue, 0) AS virtue FROM t LEFT JOIN (SELECT id, max(confidence) FILTER (polarity = 'vice') AS vice, max(confidence) FILTER (polarity = 'virtue') AS virtue FROM lexs GROUP BY id) USING (id))
SELECT doc_id, place, p AS tier1, c AS tier1_confidence, {SIGN} AS polarity, round({SURE}, 4) AS polarity_confidence FROM t3""",
    "q_semantic_signals": f"WITH {P}, {MODELS} SELECT id, value_name, c AS confidence FROM sem",
    "q_languages": f"""WITH words AS (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '\\p{{L}}+')) AS w FROM documents) GROUP BY ALL),
gram AS (SELECT doc_id, substr(' ' || w || ' ', i, 3) AS g, sum(n)::DOUBLE AS n FROM (SELECT *, unnest(range(1, length(w) + 1)) AS i FROM words) GROUP BY doc_id, g),
c AS (SELECT lang, g, sum(n) AS n FROM gram JOIN documents USING (doc_id) WHERE lang IS NOT NULL AND doc_id % 4 <> 2 GROUP BY lang, g), t AS (SELECT lang, sum(n) AS total, count(*) AS kinds FROM c GROUP BY lang),
pr AS (SELECT lang, g, ln((n + {profiles.SMOOTH}) / (total + {profiles.SMOOTH} * kinds)) AS p FROM c JOIN t USING (lang) QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, g) <= {profiles.TOP}),
sc AS (SELECT doc_id, t.lang, -sum(n * coalesce(p, ln({profiles.SMOOTH} / (total + {profiles.SMOOTH} * kinds)))) / sum(n) AS s FROM gram CROSS JOIN t LEFT JOIN pr ON pr.lang = t.lang AND pr.g = gram.g GROUP BY doc_id, t.lang HAVING sum(n) >= {profiles.LEAST}),
r AS (SELECT doc_id, lang, lead(s) OVER w - s AS apart, row_number() OVER w AS k FROM sc WINDOW w AS (PARTITION BY doc_id ORDER BY s, lang))
SELECT doc_id, CASE WHEN apart >= {profiles.MARGIN} THEN r.lang ELSE 'unknown' END AS lang, round(coalesce(apart, 0), 4) AS margin FROM documents d LEFT JOIN (SELECT * FROM r WHERE k = 1) r USING (doc_id)""",
    "q_prototypes": f"WITH {P}, {LIKE} SELECT value_name AS label, kind, d::INTEGER AS d, round(v, 4) AS c FROM proto WHERE round(v, 4) <> 0",
    "q_batch_ingest": f"""WITH whole AS (SELECT conv_id, 'speaker' || (conv_id % 7) AS figure, coalesce(string_agg(text, ' ' ORDER BY turn, text), '') AS text FROM conversations GROUP BY conv_id),
docs AS (SELECT conv_id AS doc_id, figure, 'letter' AS doc_type, text FROM whole WHERE conv_id % 20 <> 0), {CUT},
bad AS (SELECT figure, 'file not found' AS error FROM whole WHERE conv_id % 20 = 0 UNION ALL SELECT figure, CASE WHEN regexp_matches(text, '[^\\s]') THEN 'no passages' ELSE 'empty text' END FROM docs WHERE doc_id NOT IN (SELECT doc_id FROM pas))
SELECT figure, count(*) AS n, sum(length(passage))::BIGINT AS chars, min(epoch(make_date(1900 + (doc_id % 50)::INTEGER, 1, 1)::TIMESTAMP) + place)::DOUBLE AS first_ts, 'none' AS error FROM pas GROUP BY figure
UNION ALL SELECT figure, count(*), 0, NULL, error FROM bad GROUP BY figure, error""",
    "q_classifier_signals": f"""WITH {P}, {MODELS} SELECT id, value_name, ord::INTEGER AS ord, score FROM cl UNION ALL SELECT id, 'vice of ' || foundation, -1, round(score, 4) FROM cls JOIN (VALUES {', '.join(f"('{label}', '{f}')" for label, (f, pol) in fixed.CLASSIFIER_LABELS.items() if pol == 'vice')}) v(label, foundation) USING (label) WHERE score >= 0.85""",
    "q_merge_confidence": f"WITH {OBS} SELECT id, value_name, o AS signal_ord, layer::INTEGER AS layer, c0 AS confidence, src AS source, hint AS polarity_hint, spot AS match_idx, dc AS disambiguation_confidence, resistance, pol AS value_polarity, round(pc, 4) AS polarity_confidence FROM sig",
    "q_observations": f"WITH {OBS} SELECT session_id, record_id, value_name, ts, passage_idx, doc_type, significance, resistance, disambiguation_confidence, source, value_polarity, round(polarity_confidence, 4) AS polarity_confidence, md5(text_excerpt) AS excerpt_md5 FROM obs",
    "q_new_observations": f"WITH {OBS} SELECT session_id, record_id, value_name, resistance, 1.0::DOUBLE AS polarity_confidence, length(text_excerpt)::INTEGER AS chars FROM obs WHERE value_polarity >= 0",
    "q_pressure": f"WITH {P}, {PRESSURE} SELECT * FROM pr",
    "q_incremental_registry": f"WITH {REG} SELECT * FROM reg",
    "q_registry": f"WITH {REG} SELECT * FROM reg",
    "q_running_registry": f"""WITH {OBS}, r AS (SELECT session_id, value_name, record_id, ts, count(*) OVER w AS n, avg(significance) OVER w AS sig, avg(resistance) OVER w AS res, stddev_pop(resistance) OVER w AS sigma, max(ts) OVER w - min(ts) OVER w AS span, count(DISTINCT doc_type) OVER w AS types FROM obs
WINDOW w AS (PARTITION BY session_id, value_name ORDER BY ts, record_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) SELECT session_id, value_name, record_id, ts, n, round(sig, 4) AS avg_significance, round(res, 4) AS avg_resistance, {CONSISTENCY} AS consistency FROM r""",
    "q_universal": f"WITH {REG} SELECT * FROM ({ACROSS}) WHERE total_demonstrations >= 2",
    "q_cross_figure": f"WITH {REG} SELECT * FROM ({ACROSS}) WHERE figure_count >= 5",
    "q_top_values": f"WITH {REG} SELECT session_id, row_number() OVER (PARTITION BY session_id ORDER BY weight DESC, demonstrations DESC, value_name)::INTEGER AS rank, value_name, weight, demonstrations FROM reg QUALIFY rank <= 5",
    "q_figures": f"""WITH {REG}, {SOURCES}, t AS (SELECT session_id, sum(demonstrations)::BIGINT AS n, count(*) AS k FROM reg GROUP BY session_id), b AS (SELECT session_id, value_name FROM reg QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY weight DESC, demonstrations DESC, value_name) = 1)
SELECT session_id, figure_name, document_type, passage_count, coalesce(n, 0) AS total_observations, coalesce(k, 0) AS value_count, b.value_name AS top_value FROM src LEFT JOIN t USING (session_id) LEFT JOIN b USING (session_id)""",
    "q_scan": f"WITH {OBS} SELECT session_id, record_id, value_name, ts FROM obs WHERE value_name = 'courage' AND ts > 86400 ORDER BY ts DESC, session_id, record_id LIMIT 50",
    "q_classify": f"WITH {RECORDS} SELECT session_id, record_id, value_name, figure_name, document_type, observation_consistency, label, label_reason, confidence, fail_mode, training_weight FROM rec",
    "q_apy_upgrade": f"WITH {UPGRADED} SELECT * EXCLUDE (text_excerpt) FROM upg",
    "q_pressure_window": f"WITH {P}, {PRESSURE} SELECT * EXCLUDE (markers) FROM pr QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY passage_idx DESC, ts DESC, record_id DESC) <= 5",
    "q_event_asof": """WITH e AS (SELECT event_id::VARCHAR AS record_id, user_id::VARCHAR AS session_id, epoch_us(ts)::DOUBLE / 1e6 AS ts, event_type FROM events),
j AS (SELECT p.session_id, p.record_id, x.record_id AS pid, p.ts - x.ts AS lag FROM (FROM e WHERE event_type = 'purchase') p ASOF LEFT JOIN (FROM e WHERE event_type = 'error') x ON p.session_id = x.session_id AND p.ts >= x.ts)
SELECT session_id, record_id, CASE WHEN lag <= 259200 THEN pid END AS pressure_source_id, CASE WHEN lag <= 259200 THEN round(lag, 1) END AS lag_s FROM j""",
    "q_contrastive": f"WITH {UPGRADED} SELECT u.session_id, u.record_id, u.value_name, u.pressure_source_id, substr(n.text, 1, 500) AS pressure_text FROM upg u JOIN p n ON u.pressure_source_id = n.id WHERE label = 'APY'",
    "q_cooccurrence": f"""WITH {PAIRS} SELECT a.value_name AS value_a, b.value_name AS value_b, count(*) AS both_detected, count(*) FILTER (a.label = 'P1' AND b.label = 'P1') AS both_p1, count(*) FILTER ((a.label = 'P1') <> (b.label = 'P1')) AS mixed, count(*) FILTER (a.label <> 'P1' AND b.label <> 'P1') AS both_p0 FROM pairs GROUP BY ALL""",
    "q_tension": f"""WITH {PAIRS} SELECT session_id, record_id, h.ts AS ts, h.value_name AS value_held, f.value_name AS value_failed, round(h.resistance, 4) AS resistance, h.label AS held_label, f.label AS failed_label, round(h.training_weight * 1.5, 4) AS training_weight FROM (SELECT session_id, record_id, CASE WHEN a.label = 'P1' THEN a ELSE b END AS h, CASE WHEN a.label = 'P1' THEN b ELSE a END AS f FROM pairs
WHERE (a.label = 'P1') <> (b.label = 'P1') AND a.value_name || '|' || b.value_name IN ({', '.join(quote('|'.join(sorted(p))) for p in fixed.TENSION_PAIRS)}))""",
    "q_label_pivot": PIVOT("figure_name"),
    "q_value_pivot": PIVOT("value_name"),
    "q_label_cube": f"WITH {RECORDS} SELECT session_id, value_name, label, count(*) AS n, grouping(session_id, value_name, label)::BIGINT AS level FROM rec GROUP BY CUBE (session_id, value_name, label)",
    "q_training_records": f"""WITH {UPGRADED.replace('SELECT r.session_id, r.record_id, r.value_name, r.text_excerpt,', 'SELECT r.* EXCLUDE (label, label_reason, confidence, fail_mode),')},
mk AS (SELECT *, {', '.join(f"array_to_string(list_transform({all_of('text_excerpt', pat)}, lambda x: lower(x)), '|') AS {n}_markers" for n, pat in (("pressure", fixed.PRESSURE_MARKERS), ("failure", fixed.FAILURE_MARKERS), ("hold", fixed.HOLD_MARKERS)))} FROM upg)
SELECT sha256('record|' || source_obs_id) AS id, source_obs_id, figure_name AS figure, session_id, record_id, ts, value_name, md5(text_excerpt) AS text_excerpt, document_type, round(significance, 4) AS significance, round(resistance, 4) AS resistance, label, label_reason, fail_mode, training_weight, round(confidence, 2) AS confidence,
  pressure_markers, failure_markers, hold_markers, source, round(disambiguation_confidence, 4) AS disambiguation_confidence, round(observation_consistency, 4) AS observation_consistency, value_polarity, round(polarity_confidence, 4) AS polarity_confidence, pressure_source_id, pressure_source_id IS NOT NULL AS pressure_context, deferred_apy_lag_s, deferred_apy_lag_n FROM mk""",
    "q_report": f"""WITH {UPGRADED.replace('SELECT r.session_id, r.record_id, r.value_name, r.text_excerpt,', 'SELECT r.* EXCLUDE (label, label_reason, confidence, fail_mode),')}
SELECT (SELECT count(*) FROM upg) AS total, (SELECT round(sum(training_weight) FILTER (label = 'P1'), 3) FROM upg) AS weight, figure_name AS figure, count(*) FILTER (label = 'P1') AS p1, count(*) FILTER (label = 'P0') AS p0, count(*) FILTER (label = 'APY') AS apy FROM upg GROUP BY figure_name""",
    "q_stats": f"""WITH {REG}, t AS (SELECT value_name, sum(demonstrations)::BIGINT AS n FROM reg GROUP BY ALL ORDER BY n DESC, value_name LIMIT 5)
SELECT (SELECT count(*) FROM obs) AS total_observations, (SELECT count(DISTINCT source) FROM documents) AS figure_count, (SELECT '[' || string_agg('{{"value_name":"' || value_name || '","demonstrations":' || n || '}}', ',' ORDER BY n DESC, value_name) || ']' FROM t) AS top_values""",
    "q_document_list": f"WITH {P} SELECT session_id, min(figure) AS figure, count(*) AS passage_count, count(DISTINCT doc_id) AS document_count, min(ts) AS first_ts FROM p GROUP BY session_id",
    "q_figure_profile": f"WITH {REG} SELECT * FROM reg WHERE session_id = 'figure:src0'",
    "q_pressure_context": f"WITH {P}, {PRESSURE} SELECT * EXCLUDE (markers) FROM pr WHERE session_id = 'figure:src1' AND (passage_idx >= 40 OR ts >= 0)",
    "q_short_words": r"WITH n AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS w FROM documents), k AS (SELECT doc_id, [" + ", ".join(f"{{'n': len(list_filter(w, lambda x: x IN ({', '.join(map(quote, words))}))), 'lang': '{k}'}}" for k, words in COMMON.items()) + "] AS c FROM n), t AS (SELECT doc_id, list_max(c) AS top, list_sum(list_transform(c, lambda x: x.n)) AS total FROM k) SELECT doc_id, CASE WHEN top.n >= 3 THEN top.lang ELSE 'unknown' END AS lang, CASE WHEN top.n >= 3 THEN round(top.n / total::DOUBLE, 4) ELSE 0 END AS share FROM t",
    "q_record_files": f"WITH {UPGRADED} SELECT label, count(*) AS n FROM upg WHERE label IN ('P1', 'P0', 'APY') GROUP BY label UNION ALL SELECT 'malformed', 1",
    "q_lexicon_files": f"WITH {P}, said AS (SELECT w, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS w FROM p) GROUP BY w) SELECT kind, a, b, x, coalesce(n, 0) AS n FROM (VALUES " + ", ".join([f"('vocabulary', '{v}', {quote(w)}, {i}::DOUBLE)" for v, ws in b.VOCABULARY.items() for i, w in enumerate(ws)] + [f"('lexicon', '{w}', '{f}.{p}', NULL)" for w, f, p in b.LEXICON] + [f"('strength', '{w}', '{f}', {s}::DOUBLE)" for w, f, s in b.STRENGTH]) + ") t(kind, a, b, x) LEFT JOIN said ON w = CASE WHEN kind = 'vocabulary' THEN b ELSE a END",
    "q_panel": """WITH v AS (SELECT doc_id AS id, 'courage' AS value_name, CASE WHEN (doc_id + m) % 5 <> 0 THEN (quality + m) % 2 = 1 END AS holds, CASE WHEN (doc_id + m) % 7 <> 0 THEN (toxic + m) % 2 = 0 END AS violates FROM labels, range(3) r(m)),
g AS (SELECT id, value_name, count(*) FILTER (holds) AS holds, count(*) FILTER (violates) AS violates, count(*) FILTER (holds IS NOT NULL OR violates IS NOT NULL) AS active FROM v GROUP BY ALL)
SELECT *, CASE WHEN active < 2 THEN 'skip' WHEN holds >= 2 AND violates >= 2 THEN 'tension' WHEN holds >= 2 THEN 'P1' WHEN violates >= 2 THEN 'P0' ELSE 'discard' END AS verdict FROM g""",
    "q_corpus_overview": f"""WITH {OBS}, k AS (SELECT doc_type, count(*) AS c FROM p GROUP BY ALL) SELECT (SELECT count(DISTINCT session_id) FROM p) AS figure_count, (SELECT count(*) FROM p) AS total_passages, count(*) AS total_observations, count(DISTINCT value_name) AS unique_values,
round(count(DISTINCT record_id) / (SELECT count(*) FROM p)::DOUBLE, 4) AS coverage_rate, (SELECT '{{' || string_agg('"' || doc_type || '":' || c, ',' ORDER BY doc_type) || '}}' FROM k) AS doc_types, min(ts) AS first_ts, max(ts) AS last_ts FROM obs""",
    "q_dataset_card": f"""WITH {REG}, pc AS (SELECT session_id, count(*) AS passage_count FROM p GROUP BY ALL), o AS (SELECT session_id, count(*) AS observation_count, count(DISTINCT value_name) AS value_count, round(avg(resistance), 4) AS avg_resistance, round(avg(significance), 4) AS avg_significance FROM obs GROUP BY ALL),
t AS (SELECT session_id, string_agg(value_name, ',' ORDER BY r) AS top_values FROM (SELECT session_id, value_name, row_number() OVER (PARTITION BY session_id ORDER BY weight DESC, demonstrations DESC, value_name) AS r FROM reg) WHERE r <= 5 GROUP BY ALL), a AS ({ACROSS}), k AS (SELECT doc_type, count(*) AS c FROM p GROUP BY ALL), cov AS (SELECT count(*) AS n, count(DISTINCT value_name) AS v, round(count(DISTINCT record_id) / (SELECT count(*) FROM p)::DOUBLE, 4) AS rate FROM obs)
SELECT 'Value Distribution' AS section, printf('| %s | %d | %d | %.4f | %.4f |', value_name, total_demonstrations::BIGINT, figure_count, avg_weight, avg_resistance) AS line FROM a UNION ALL SELECT 'Value Distribution', '| Value | Demonstrations | Figures | Mean weight | Mean resistance |'
UNION ALL SELECT 'Cross-Figure Values', printf('| %s | %d | %d | %.4f |', value_name, figure_count, total_demonstrations::BIGINT, avg_weight) FROM a WHERE figure_count >= 2 UNION ALL SELECT 'Cross-Figure Values', '| Value | Figures | Demonstrations | Mean weight |'
UNION ALL SELECT 'Figures', printf('| %s | %s | %s | %s | %.4f | %s |', substr(session_id, 8), dt, format('{{:,}}', passage_count), format('{{:,}}', observation_count), avg_resistance, array_to_string(string_split(top_values, ',')[:3], ', ')) FROM pc JOIN o USING (session_id) JOIN t USING (session_id) JOIN (SELECT session_id, string_agg(DISTINCT doc_type, ', ' ORDER BY doc_type) AS dt FROM p GROUP BY ALL) USING (session_id)
UNION ALL SELECT 'Figures', '| Figure | Document types | Passages | Observations | Mean resistance | Foremost values |'
UNION ALL SELECT 'Corpus Statistics', unnest(['| Metric | Value |', '| Figures | ' || (SELECT count(DISTINCT session_id) FROM p) || ' |', '| Passages | ' || format('{{:,}}', (SELECT count(*) FROM p)) || ' |', '| Observations | ' || format('{{:,}}', n) || ' |', '| Values | ' || v || ' |', printf('| Passages with a value | %.2f%% |', rate * 100)]) FROM cov
UNION ALL SELECT 'Corpus Statistics', '| Type | Passages | Share |' UNION ALL SELECT 'Corpus Statistics', printf('| %s | %s | %.1f%% |', doc_type, format('{{:,}}', c), c * 100 / (SELECT sum(c) FROM k)::DOUBLE) FROM k""",
    "q_figure_summary": f"""WITH {REG}, pc AS (SELECT session_id, count(*) AS passage_count FROM p GROUP BY ALL), o AS (SELECT session_id, count(*) AS observation_count, count(DISTINCT value_name) AS value_count, round(avg(resistance), 4) AS avg_resistance, round(avg(significance), 4) AS avg_significance FROM obs GROUP BY ALL),
t AS (SELECT session_id, string_agg(value_name, ',' ORDER BY r) AS top_values FROM (SELECT session_id, value_name, row_number() OVER (PARTITION BY session_id ORDER BY weight DESC, demonstrations DESC, value_name) AS r FROM reg) WHERE r <= 5 GROUP BY ALL) SELECT * FROM pc LEFT JOIN o USING (session_id) LEFT JOIN t USING (session_id)""",
    "q_corpus_quality": f"WITH {QUALITY_TIERS} SELECT * FROM q",
    "q_export_gate": f"WITH {RECORDS}, {QUALITY_TIERS} SELECT rec.figure_name, confidence_tier AS corpus_confidence, count(*) AS n FROM rec LEFT JOIN q ON lower(rec.figure_name) = q.figure_name WHERE NOT (confidence_tier = 'preliminary' AND document_count > 0) GROUP BY ALL",
    "q_quality_metrics": f"WITH {METRICS} SELECT * FROM m",
    "q_quality_checks": f"WITH {METRICS}, {STABLE} {CHECKED} UNION ALL FROM stable",
    "q_grade": f"WITH {METRICS}, {STABLE}, c AS ({CHECKED} UNION ALL FROM stable) SELECT *, CASE WHEN (SELECT count(*) FROM c WHERE NOT passed) = 0 THEN 'CERTIFIED' ELSE 'FAILED' END AS grade FROM c",
    "q_digest": f"WITH {RANGES}, top AS (SELECT CASE WHEN count(*) = 1 THEN min(h) ELSE sha256(string_agg(h, '' ORDER BY figure, value_name)) END AS h FROM (SELECT *, sha256(concat_ws(chr(1), figure, value_name, hash)) AS h FROM ranges)) SELECT f AS figure, 'all' AS value_name, h[:16] AS hash FROM top, (VALUES ('all'), ('anew')) t(f) UNION ALL SELECT figure, value_name, hash FROM ranges",
    "q_differing": f"WITH {RECORDS} SELECT figure_name AS figure, value_name, count(*) AS n_one, count(*) AS n_other FROM rec GROUP BY ALL HAVING bool_or(md5(record_id) LIKE '00%')",
    "q_lofo": f"WITH {RECORDS}, own AS (SELECT value_name, count(DISTINCT figure_name) AS n, min(figure_name) AS f FROM rec GROUP BY value_name) SELECT figure_name AS figure, (SELECT count(*) FROM own) - (SELECT count(*) FROM own WHERE n = 1 AND f = g.figure_name) AS remaining FROM (SELECT DISTINCT figure_name FROM rec) g",
    "q_archaic": f"WITH {DOCS} SELECT doc_id, md5({modern("'Thou hast said ''tis so; YE KNOWETH what she doth, and Art thou there? ' || text")}) AS modern_md5 FROM docs",
    "q_quotes": r"""WITH q AS (SELECT doc_id, list_transform(regexp_extract_all('He said "the weight of this long promise is mine to carry" and left. ' || text, '["“”]([^"“”]{30,300})["“”]', 1), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')) AS q FROM documents), u AS (SELECT doc_id, list_filter(q, lambda x, i: list_position(q, x) = i) AS q FROM q)
SELECT doc_id, (generate_subscripts(q, 1) - 1)::INTEGER AS place, unnest(q) AS quote FROM u""",
    "q_threshold_sweep": f"""WITH {OBS}, g AS (SELECT doc_id, CASE WHEN quality = 1 THEN 'P1' WHEN toxic = 1 THEN 'APY' ELSE 'P0' END AS gold FROM labels), grid AS (SELECT * FROM (VALUES {', '.join(f'({x}::DOUBLE, {y}::DOUBLE)' for x in fixed.SWEEP_P1 for y in fixed.SWEEP_P0 if y < x)}) t(p1_threshold, p0_threshold)),
r AS (SELECT p1_threshold, p0_threshold, gold, ({label('text_excerpt', 'resistance', 'p1_threshold', 'p0_threshold')}).label AS label FROM obs JOIN g USING (doc_id), grid)
SELECT p1_threshold, p0_threshold, count(*) AS n_matched, {THREE('label', 'gold')}, round(count(*) FILTER ((label = 'P1') = (gold = 'P1')) / count(*)::DOUBLE, 4) AS accuracy FROM r GROUP BY p1_threshold, p0_threshold""",
    "q_gold_match": f"""WITH {RECORDS}, {GOLD}, j AS (SELECT r.label, coalesce(a.label, m.label) AS gold FROM rec r LEFT JOIN (SELECT * FROM an WHERE value_name = 'integrity') a USING (source_obs_id) LEFT JOIN (SELECT * FROM merged WHERE label <> 'AMBIGUOUS') m ON m.key = substr(r.text_excerpt, 1, 80) AND m.value_name = r.value_name)
SELECT count(gold) AS n_matched, (SELECT count(*) FROM j WHERE gold IS NULL) AS n_unmatched, {THREE('label', 'gold')}, round(count(*) FILTER ((label = 'P1') = (gold = 'P1')) / count(*)::DOUBLE, 4) AS accuracy, count(*) FILTER (label = 'P1' AND gold = 'P1') AS tp, count(*) FILTER (label = 'P1' AND gold <> 'P1') AS fp, count(*) FILTER (label <> 'P1' AND gold = 'P1') AS fn, count(*) FILTER (label <> 'P1' AND gold <> 'P1') AS tn FROM j WHERE gold IS NOT NULL""",
    "q_gold_merge": f"WITH {OBS}, {GOLD} SELECT * FROM merged",
    "q_formula_audit": f"""WITH {SCORED}, j AS (SELECT resistance - (quality * 0.5::DOUBLE + 0.25::DOUBLE) AS d, quality FROM scored JOIN labels USING (doc_id)) SELECT count(*) AS n, round(avg(abs(d)), 4) AS mae, round(avg(abs(d)) FILTER (quality = 1), 4) AS mae_p1, round(avg(abs(d)) FILTER (quality <> 1), 4) AS mae_p0, count(*) FILTER (d > 0.1::DOUBLE) AS over, count(*) FILTER (d < -0.1::DOUBLE) AS under,
count(*) FILTER (abs(d) > 0.15::DOUBLE) AS flag_mild, count(*) FILTER (abs(d) > 0.3::DOUBLE) AS flag_severe FROM j""",
    "q_centroids": "WITH e AS (SELECT label, unnest(embedding)::DOUBLE AS c, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings), m AS (SELECT label, i, avg(c) AS c FROM e GROUP BY ALL) SELECT label, i::INTEGER AS i, round(c / sqrt(sum(c * c) OVER (PARTITION BY label)), 4) AS c FROM m",
    "q_semantic_topk": """WITH e AS (SELECT label, unnest(embedding)::DOUBLE AS c, generate_subscripts(embedding, 1) AS i FROM embeddings), m AS (SELECT label, i, avg(c) AS c FROM e GROUP BY ALL), p AS (SELECT label, list(c / n ORDER BY i) AS v FROM (SELECT *, sqrt(sum(c * c) OVER (PARTITION BY label)) AS n FROM m) GROUP BY label),
s AS (SELECT vec_id, p.label, round(list_dot_product(embedding::DOUBLE[], v), 4) AS score FROM embeddings, p) SELECT vec_id, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, label)::INTEGER AS rank, label, score FROM s WHERE score >= 0.05 QUALIFY rank <= 3""",
    "q_ingest_errors": f"WITH {PASSAGES} SELECT CASE WHEN doc_id % 50 = 0 THEN 'invalid figure name' WHEN doc_id % 50 = 1 THEN 'empty text' WHEN doc_id NOT IN (SELECT doc_id FROM pas) THEN 'no passages' ELSE 'none' END AS error, count(*) AS n FROM docs GROUP BY ALL",
    "q_figure_sources": f"""WITH {LOG} SELECT session_id, arg_max(figure, ingested_at) AS figure_name, CASE WHEN count(DISTINCT document_type) = 1 THEN min(document_type) ELSE 'mixed' END AS document_type, max(ingested_at) AS ingested_at, sum(passage_count)::BIGINT AS passage_count, coalesce(arg_max(pronoun, ingested_at) FILTER (pronoun <> 'unknown'), 'unknown') AS pronoun FROM log GROUP BY session_id""",
    "q_incremental": f"""WITH {P}, k AS (SELECT session_id, floor((max(ts) + min(ts)) / 2)::DOUBLE AS mark FROM p WHERE session_id <> 'figure:src0' GROUP BY ALL) SELECT session_id, count(*) AS n, min(ts) AS first_ts FROM p LEFT JOIN k USING (session_id) WHERE ts > coalesce(mark, -1e12) GROUP BY ALL""",
    "q_stream_registry": f"WITH e AS (SELECT user_id::VARCHAR AS session_id, event_type AS value_name, count(*) AS n, avg(value) AS sig, avg(value / 2) AS res, stddev_pop(value / 2) AS sigma, min(epoch_us(ts))::DOUBLE AS lo, max(epoch_us(ts))::DOUBLE AS hi, hi - lo AS span, 1 AS types FROM events GROUP BY ALL) SELECT session_id, value_name, n AS demonstrations, round(sig, 4) AS avg_significance, round(res, 4) AS avg_resistance, {CONSISTENCY} AS consistency, lo AS first_seen_ts, hi AS last_seen_ts FROM e",
    "q_stream_pressure": f"""WITH {ON_TIME}, e AS (SELECT event_id::VARCHAR AS record_id, user_id::VARCHAR AS session_id, epoch_us(ts)::DOUBLE / 1e6 AS ts, event_type FROM timely),
j AS (SELECT p.session_id, p.record_id, p.ts - x.ts AS lag FROM (FROM e WHERE event_type = 'purchase') p ASOF JOIN (FROM e WHERE event_type = 'error') x ON p.session_id = x.session_id AND p.ts >= x.ts) SELECT session_id, record_id, round(lag, 1) AS lag_s FROM j WHERE lag <= 259200""",
    "q_event_windows": f"WITH {ON_TIME} SELECT epoch(date_trunc('day', ts))::BIGINT AS start_s, event_type, count(*) AS n, round(sum(value), 4) AS total, (SELECT count(*) FROM events) - (SELECT count(*) FROM timely) AS late FROM timely GROUP BY ALL",
    "q_event_sessions": f"""WITH {ON_TIME}, g AS (SELECT user_id, CASE WHEN ts > lag(ts) OVER w + INTERVAL 6 HOUR OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS fresh FROM timely WINDOW w AS (PARTITION BY user_id ORDER BY ts)) SELECT user_id, sum(fresh)::BIGINT AS sessions, count(*) AS events FROM g GROUP BY ALL""",
    "q_tpch_q1": "SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc_price, round(avg(l_extendedprice), 2) AS avg_price, count(*) AS count_order FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL",
    "q_tpch_q3": "SELECT o_orderkey, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING' GROUP BY o_orderkey ORDER BY revenue DESC, o_orderkey LIMIT 10",
    "q_tpch_q5": "SELECT r_name, n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS lines FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey AND c_nationkey = s_nationkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL",
    "q_rank_window": "SELECT o_custkey, o_orderkey, row_number() OVER w::INTEGER AS rn, round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS running FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) QUALIFY rn <= 3".replace("row_number() OVER w::INTEGER", "(row_number() OVER w)::INTEGER"),
    "q_set_operations": "SELECT * FROM (WITH a AS (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'), c AS (SELECT o_custkey FROM orders WHERE o_totalprice > 150000) SELECT 'intersect' AS op, count(*) AS n FROM (FROM a INTERSECT FROM c) UNION ALL SELECT 'except_all', count(DISTINCT o_custkey) FROM (FROM a EXCEPT ALL FROM c) UNION ALL SELECT 'except', count(*) FROM (FROM a EXCEPT FROM c)) WHERE n > 0",
    "q_semi_anti": "SELECT count(*) AS n, round(sum(c_acctbal), 2) AS balance, 'with orders' AS side FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders) UNION ALL SELECT count(*), round(sum(c_acctbal), 2), 'without orders' FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)",
}
ORACLES = {name: _ties_up(sql) for name, sql in ORACLES.items()}
