"""The card of a dataset: Markdown with front matter, from aggregates that are small by nature.

What is small is collected: single rows, and a row for each document type and
value of the vocabulary. The lines of the figures are a table, a row for each,
as a corpus may have more of them than a driver holds.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heartwood.functions import fixed
from heartwood.operators import corpus, labels, quality

#: What the fields of a training record hold.
FIELDS = {
    "id": "hash of the record", "source_obs_id": "the observation it was made of", "figure": "who speaks", "session_id": "the figure's session", "record_id": "the passage", "ts": "moment of the passage in seconds",
    "value_name": "the value", "text_excerpt": "the words that show it", "document_type": "kind of document", "significance": "weight of the passage, 0 to 1", "resistance": "what holding the value cost, 0 to 1", "label": "P1, P0, APY or AMBIGUOUS",
    "label_reason": "why", "fail_mode": "how a value failed, else empty", "training_weight": "weight in training", "confidence": "of the label", "pressure_markers": "words of pressure found", "failure_markers": "words of failure found", "hold_markers": "words of holding found",
    "source": "layers that found it", "disambiguation_confidence": "that the word has this sense", "observation_consistency": "of the value in its session", "value_polarity": "1 held, -1 failed, 0 open", "polarity_confidence": "of the polarity",
    "pressure_source_id": "passage that the pressure came from", "pressure_context": "whether there is one", "deferred_apy_lag_s": "seconds since that passage", "deferred_apy_lag_n": "passages since that passage",
}
LABELS = {"P1": "the value was held against resistance", "P0": "the value failed", "APY": "the value yielded to pressure", "AMBIGUOUS": "the text does not decide"}
LAYERS = {
    "keywords": "one automaton over the vocabulary, senses and speaker checked", "lexicons": "moral dictionaries and strengths by word", "phrases": "acts and statements in the first or third person", "likeness": "vectors of texts against prototypes of seed sentences",
    "structure": "adversity, agency and cost in the sentence", "entailment": "scores of a model that runs elsewhere", "classifier": "foundation labels of a model that runs elsewhere", "panel": "votes of three models",
}


def cells(*values: object) -> str:
    """A row of a Markdown table; bars and line breaks in a value do not break it."""
    return "| " + " | ".join(("" if v is None else str(v)).replace("|", "\\|").replace("\n", " ") for v in values) + " |"


def _table(head: tuple[str, ...], rows: list) -> list[str]:
    return [cells(*head), "|" + " --- |" * len(head), *(cells(*r) for r in rows), ""]


def _four(x: float | None) -> str:
    return "" if x is None else f"{x:.4f}"


def figure_lines(passages: DataFrame, observations: DataFrame, reg: DataFrame) -> DataFrame:
    """(session_id, passage_count, line): each figure's row of the card, as ``cells`` makes them."""
    kinds = passages.groupBy("session_id").agg(F.array_join(F.array_sort(F.collect_set("doc_type")), ", ").alias("doc_types"))
    n = lambda c: F.format_string("%,d", c)
    shown = (
        F.regexp_replace("session_id", "^figure:", ""), "doc_types", n(F.col("passage_count")), n(F.coalesce("observation_count", F.lit(0))),
        F.when(F.col("avg_resistance").isNotNull(), F.format_string("%.4f", "avg_resistance")), F.array_join(F.slice(F.split("top_values", ","), 1, 3), ", "),
    )
    safe = [F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit(" ")) for c in shown]
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *safe), F.lit(" |"))
    return corpus.figure_summaries(passages, observations, reg).join(kinds, "session_id").select("session_id", "passage_count", line.alias("line"))


def dataset_card(
    name: str, passages: DataFrame, observations: DataFrame, reg: DataFrame, records: DataFrame | None = None, made: str = "", languages: tuple[str, ...] = ("en",), terms: str = "other", figures: int | None = None,
) -> str:
    """The card of the corpus called ``name``; with ``records`` it shows their labels and grade. ``made`` is the date to print, ``terms`` the licence.

    All figures are named; a caller who wants the first ``figures`` only is told how many more there are.
    The text is made in the driver; ``parts`` leaves the figures where they are.
    """
    before, people, after = parts(name, passages, observations, reg, records, made, languages, terms, figures)
    return "\n".join([*before, *(r["line"] for r in people.orderBy(F.desc("passage_count"), "session_id").collect()), *after])


def parts(
    name: str, passages: DataFrame, observations: DataFrame, reg: DataFrame, records: DataFrame | None = None, made: str = "", languages: tuple[str, ...] = ("en",), terms: str = "other", figures: int | None = None,
) -> tuple[list[str], DataFrame, list[str]]:
    """The lines before those of the figures, these as a table (``figure_lines``), and the lines behind them."""
    total = corpus.overview(passages, observations).first()
    kinds = json.loads(total["doc_types"] or "{}")
    out = ["---", "language:", *(f"- {x}" for x in languages), f"license: {terms}", "task_categories:", "- text-classification", "task_ids:", "- multi-label-classification", "tags:", "- values", "- moral-psychology", "- historical-text", f"pretty_name: {json.dumps(name)}", "---", ""]
    out += [f"# {name}", "", "## Dataset Description", "", "Values that figures held or failed in what they wrote and did, found in their documents by rule and weighed by what it cost to hold them.", "Each record is one value in one passage, labelled by whether it was held (P1), failed (P0) or yielded to pressure (APY).", ""]
    out += ["## Corpus Statistics", "", *_table(("Metric", "Value"), [
        ("Figures", total["figure_count"]), ("Passages", f"{total['total_passages']:,}"), ("Observations", f"{total['total_observations']:,}"), ("Values", total["unique_values"]), ("Passages with a value", f"{total['coverage_rate']:.2%}"), *([("Made", made)] if made else []),
    ])]
    if kinds:
        every = sum(kinds.values())
        out += ["### Document Types", "", *_table(("Type", "Passages", "Share"), [(k, f"{n:,}", f"{n / every:.1%}") for k, n in sorted(kinds.items(), key=lambda x: (-x[1], x[0]))])]
    people = figure_lines(passages, observations, reg)
    if figures is not None:
        people = people.orderBy(F.desc("passage_count"), "session_id").limit(figures)
    before, out = out, []
    if total["figure_count"]:
        before += ["## Figures", "", *_table(("Figure", "Document types", "Passages", "Observations", "Mean resistance", "Foremost values"), [])[:-1]]
        out += [""]
        if figures is not None and total["figure_count"] > figures:
            out += [f"and {total['figure_count'] - figures:,} more figures", ""]
    values = corpus.value_distribution(reg).collect()  # a row for each value of the vocabulary
    if values:
        out += ["## Value Distribution", "", *_table(("Value", "Demonstrations", "Figures", "Mean weight", "Mean resistance"), [(v["value_name"], v["total_demonstrations"], v["figure_count"], _four(v["avg_weight"]), _four(v["avg_resistance"])) for v in values])]
    shared = [v for v in values if v["figure_count"] >= 2]
    if shared:
        out += ["## Cross-Figure Values", "", "Values that two or more figures show.", "", *_table(("Value", "Figures", "Demonstrations", "Mean weight"), [(v["value_name"], v["figure_count"], v["total_demonstrations"], _four(v["avg_weight"])) for v in shared])]
    r = corpus.distribution(observations, "resistance").first()
    if r["n"]:
        out += ["## Resistance Score Distribution", "", *_table(("Statistic", "Value"), [(s.capitalize(), _four(r[s])) for s in ("mean", "std", "median", "min", "max")])]
    if records is not None:
        count = {x["label"]: x["count"] for x in records.groupBy("label").count().collect()}
        checks = quality.checks(records).collect()
        grade = "ERROR" if not checks else "CERTIFIED" if all(c["passed"] for c in checks) else "FAILED"
        out += ["## Labels and Quality", "", *_table(("Label", "Records"), [(x, f"{count.get(x, 0):,}") for x in labels.LABELS]), f"Grade: {grade}", "", *_table(("Layer", "Check", "Value", "Threshold", "Passed"), [(c["layer"], c["metric"], _four(c["value"]), f"{c['op']} {c['threshold']:g}", "yes" if c["passed"] else "no") for c in checks])]
    out += ["## Schema", "", "JSON lines, one record each:", "", *_table(("Field", "Meaning"), [(f"`{f}`", FIELDS[f]) for f in labels.RECORD]), "### Label Meanings", "", *_table(("Label", "Meaning"), list(LABELS.items()))]
    out += ["## Pipeline", "", *_table(("Layer", "What it does"), list(LAYERS.items())), f"Labels: P1 from a resistance of {fixed.P1:g}, P0 below {fixed.P0:g}, by markers before that.", "", "A value's weight in the registry is its demonstrations x mean significance x mean resistance x consistency.", "", "## License", "", terms, ""]
    return before, people, out
