"""Reports: markdown rendering, summaries, and cited answers from a corpus."""

from __future__ import annotations

import json
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tablerich.operators.extract import focused_excerpts
from tablerich.operators.naming import keep_if, strip
from tablerich.operators.search import Corpus, query_terms, rank_documents

MAX_QUESTION_CHARS = 15_000
MIN_SUMMARY_CHARS = 20


def render(value) -> str:
    """Markdown for parsed JSON: keys become headings, list items bullets.

    What is left to write is kept on a stack of finished lines and of values with their heading level.
    """
    lines: list[str] = []
    waiting: list = [(value, 1)]
    while waiting:
        item = waiting.pop()
        if isinstance(item, str):
            lines.append(item)
            continue
        found, level = item
        parts: list = []
        if isinstance(found, list):
            parts = [(x, level) if isinstance(x, dict) else f"- {x}" for x in found]
        elif isinstance(found, dict) and set(found) == {"text"}:
            parts = [str(found["text"])]
        elif isinstance(found, dict):
            for key, inner in found.items():
                title = key.replace("_", " ").title()
                body = [(inner, level + 1)] if isinstance(inner, dict) or inner and isinstance(inner, list) else []
                text = [] if isinstance(inner, (dict, list)) else [str(inner)]
                parts += [f"{'#' * min(level, 6)} {title}", "", *body, *text, ""]
        elif found is not None:
            parts = [str(found)]
        waiting += reversed(parts or [""])
    return "\n".join(lines)


@F.pandas_udf(T.StringType())
def markdown(content: pd.Series) -> pd.Series:
    """Markdown of a JSON text column of any depth; text that is not JSON stays as it is."""

    def one(text):
        if text is None:
            return ""
        try:
            return render(json.loads(text))
        except json.JSONDecodeError:
            return text

    return content.map(one)


def heading(name: Column) -> Column:
    return F.initcap(F.replace(name, F.lit("_"), F.lit(" ")))


def executive_summary(text: Column) -> Column:
    """Text before the first ``##`` heading without the title line; null when 20 characters or less."""
    lead = strip(F.regexp_replace(strip(text), r"(?ms)^##\s.*", ""))
    body = strip(F.regexp_replace(lead, r"^# [^\n]*", ""))
    return keep_if(body, lambda b: F.length(b) > MIN_SUMMARY_CHARS)


def content_summary(content: Column) -> Column:
    """Summary of JSON content: ``{text}`` as markdown, else its ``summary`` or ``executive_summary``."""
    parsed = F.try_parse_json(content)
    is_object = F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT<"), F.lit(False))
    fields = F.json_object_keys(content)
    text = F.when((F.size(fields) == 1) & F.array_contains(fields, "text"), F.get_json_object(content, "$.text"))
    named = [
        F.when(F.array_contains(fields, k), F.coalesce(F.get_json_object(content, f"$.{k}"), F.lit("")))
        for k in ("summary", "executive_summary")
    ]
    value = F.coalesce(*named)
    return F.when(~is_object, executive_summary(content)).otherwise(
        F.when(text.isNotNull(), executive_summary(text)).otherwise(F.when(value != "", value))
    )


def is_text_report(kind: Column, requested: Column, content: Column) -> Column:
    untyped = kind.isNull() & content.isNotNull() & (content != "")
    return F.coalesce(kind == "text", F.lit(False)) | F.coalesce(requested == "text", F.lit(False)) | untyped


def research(
    questions: Sequence[str], corpus: Corpus, *, documents: int = 3, passages: int = 2, mode: str = "basic"
) -> DataFrame:
    """A cited report per question: ``(question_no, question, content, citations)``.

    ``content`` is JSON text with one section per document, ``citations`` an array of
    ``struct<source, excerpts>``. A report gathers at most ``documents`` rows.
    """
    asked = list(questions)
    if any(len(q) > MAX_QUESTION_CHARS for q in asked):
        raise ValueError(f"a question must have at most {MAX_QUESTION_CHARS} characters")
    ranked = rank_documents(corpus, asked, mode=mode, limit=documents)
    quotes = F.lit(None).cast("array<string>")
    text_of = F.lit(None).cast("string")
    for n, q in enumerate(asked, 1):
        quotes = F.when(
            F.col("query_no") == n, focused_excerpts(F.col(corpus.text), query_terms(q), passages)
        ).otherwise(quotes)
        text_of = F.when(F.col("query_no") == n, F.lit(q)).otherwise(text_of)
    source = F.col(corpus.url or corpus.id).cast("string")
    found = ranked.select("query_no", "rank", source.alias("source"), quotes.alias("excerpts"))
    gathered = found.groupBy("query_no").agg(
        F.sort_array(F.collect_list(F.struct("rank", "source", "excerpts"))).alias("_c")
    )
    sections = F.map_from_entries(
        F.transform("_c", lambda c: F.struct(F.concat(F.lit("source_"), c["source"]), c["excerpts"]))
    )
    cited = F.transform("_c", lambda c: F.struct(c["source"].alias("source"), c["excerpts"].alias("excerpts")))
    return gathered.select(
        F.col("query_no").alias("question_no"),
        text_of.alias("question"),
        F.to_json(sections).alias("content"),
        cited.alias("citations"),
    )
