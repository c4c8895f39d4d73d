"""Functions for Spark SQL: scalar enrichment, JSON forms, and a partitioned table function."""

from __future__ import annotations

import json
from collections.abc import Mapping
from functools import partial

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from tablerich.operators.enrich import split_groups
from tablerich.operators.naming import output_columns
from tablerich.operators.resolvers import RowFunction, call_in_chunks
from tablerich.session import CALL_ROWS

DEFAULT_PROCESSOR = "lite-fast"
NAMES = ("enrich", "enrich_with_processor", "enrich_json", "enrich_entity", "enrich_rows")


def to_text(value) -> str:
    return json.dumps(value, ensure_ascii=False, separators=(",", ":"))


def _answer(result, include_basis: bool = False) -> str:
    """JSON text of one result: outputs, ``_basis`` when asked for, or ``error``."""
    if not isinstance(result, dict):
        return to_text({"result": result})
    if result.get("error") is not None:
        return to_text({"error": str(result["error"])})
    kept = {k: v for k, v in result.items() if k not in ("basis", "error")}
    if include_basis:
        kept["_basis"] = result.get("basis") or []
    return to_text(kept)


def _resolve_rows(
    inputs: list, lists: list, processors: list, functions: Mapping[str, RowFunction], render, rows: int = CALL_ROWS
) -> list:
    """Rendered answers in row order; rows with the same outputs and processor share their calls.

    A row without input or outputs has no answer; one whose outputs are no descriptions is told so.
    """
    answers: list = [None] * len(inputs)
    groups: dict[tuple, list[int]] = {}
    for i, (row, asked) in enumerate(zip(inputs, lists)):
        if row is None or asked is None:
            continue
        if not all(isinstance(a, str) and a.strip() for a in asked):
            answers[i] = render({"error": "output columns: every one needs a description"})
        else:
            groups.setdefault((tuple(asked), processors[i]), []).append(i)
    for (asked, processor), places in groups.items():
        fn = functions.get(processor)
        if fn is None:
            results = [{"error": f"unknown processor: {processor}"}] * len(places)
        else:
            names = [o.name for o in output_columns(asked)]
            results = call_in_chunks(fn, [inputs[i] for i in places], names, rows)
        for i, result in zip(places, results):
            answers[i] = render(result)
    return answers


def enrich_udf(
    functions: RowFunction | Mapping[str, RowFunction], *, processor: str = DEFAULT_PROCESSOR,
    include_basis: bool = False,
):
    """``f(map<string,string>, array<string>) -> JSON text``; a null argument gives null."""
    table = functions if isinstance(functions, Mapping) else {processor: functions}
    render = partial(_answer, include_basis=include_basis)

    def run(inputs: pd.Series, asked: pd.Series) -> pd.Series:
        rows = [None if m is None else dict(m) for m in inputs]
        return pd.Series(_resolve_rows(rows, list(asked), [processor] * len(rows), table, render), dtype="object")

    return F.pandas_udf(run, "string").asNondeterministic()


def enrich_with_processor_udf(
    functions: Mapping[str, RowFunction], *, processor: str = DEFAULT_PROCESSOR, include_basis: bool = False
):
    """The same with a third argument that picks the processor of each row; blank means the default."""
    render = partial(_answer, include_basis=include_basis)

    def run(inputs: pd.Series, asked: pd.Series, chosen: pd.Series) -> pd.Series:
        rows = [None if m is None else dict(m) for m in inputs]
        names = [c.strip() if c and c.strip() else processor for c in chosen]
        return pd.Series(_resolve_rows(rows, list(asked), names, functions, render), dtype="object")

    return F.pandas_udf(run, "string").asNondeterministic()


def enrich_json_udf(fn: RowFunction, *, include_basis: bool = False):
    """``f(json object text, json array text) -> JSON text``; every failure is told in its own row."""
    render = partial(_answer, include_basis=include_basis)

    def run(inputs: pd.Series, asked: pd.Series) -> pd.Series:
        rows: list = []
        lists: list = []
        problems: dict[int, str] = {}
        for i, (text, wanted) in enumerate(zip(inputs, asked)):
            row = names = None
            try:
                names = json.loads(wanted)
                if not isinstance(names, list):
                    names, problems[i] = None, "output columns: a JSON array is expected"
            except (TypeError, ValueError):
                problems[i] = "output columns: not JSON"
            try:
                row = json.loads(text)
                if not isinstance(row, dict):
                    problems.setdefault(i, "input: a JSON object is expected")
            except (TypeError, ValueError):
                problems.setdefault(i, "input: not JSON")
            rows.append(None if i in problems else row)
            lists.append(names)
        answers = _resolve_rows(rows, lists, [""] * len(rows), {"": fn}, render)
        return pd.Series(
            [to_text({"error": problems[i]}) if i in problems else a for i, a in enumerate(answers)], dtype="object"
        )

    return F.pandas_udf(run, "string").asNondeterministic()


def table_function(
    functions: RowFunction | Mapping[str, RowFunction], *, processor: str = DEFAULT_PROCESSOR, rows: int = CALL_ROWS
):
    """Table function over rows ``(input_json, output_columns[, processor])``, giving ``(input, enriched)``.

    Used with ``PARTITION BY``. Rows are gathered up to ``rows`` and answered together, so a large
    partition is never held as a whole. Input that is not the JSON of an object counts as an empty object.
    """
    table = functions if isinstance(functions, Mapping) else {processor: functions}

    class EnrichRows:
        def __init__(self):
            self.held = []

        def eval(self, row):
            fields = row.asDict()
            try:
                parsed = json.loads(fields["input_json"])
            except (TypeError, ValueError):
                parsed = {}
            parsed = parsed if isinstance(parsed, dict) else {}
            self.held.append((parsed, list(fields.get("output_columns") or []), fields.get("processor") or processor))
            if len(self.held) == rows:
                yield from self._flush()

        def terminate(self):
            yield from self._flush()

        def _flush(self):
            if self.held:
                inputs, lists, processors = map(list, zip(*self.held))
                for given, answer in zip(inputs, _resolve_rows(inputs, lists, processors, table, to_text, rows)):
                    yield to_text(given), answer
            self.held = []

    return F.udtf(EnrichRows, returnType="input string, enriched string")


def call_by_group(df: DataFrame, by: list[str], row_key: list[str], function, rows: int = CALL_ROWS) -> DataFrame:
    """Run a table function per group, with large groups cut into several partitions."""
    arguments = [c for c in ("input_json", "output_columns", "processor") if c in df.columns]
    units = split_groups(df, by, row_key, rows).select(*by, "split", *arguments)
    return function(units.asTable().partitionBy(*by, "split"))


def register(
    spark: SparkSession, functions: RowFunction | Mapping[str, RowFunction], *,
    processor: str = DEFAULT_PROCESSOR, include_basis: bool = False, prefix: str = "",
) -> list[str]:
    """Register all functions under ``prefix``; returns their names."""
    table = functions if isinstance(functions, Mapping) else {processor: functions}
    default = table[processor]
    names = [prefix + n for n in NAMES]
    scalar, with_processor, as_json, entity, rows = names
    spark.udf.register(scalar, enrich_udf(table, processor=processor, include_basis=include_basis))
    spark.udf.register(
        with_processor, enrich_with_processor_udf(table, processor=processor, include_basis=include_basis)
    )
    spark.udf.register(as_json, enrich_json_udf(default, include_basis=include_basis))
    spark.udtf.register(rows, table_function(table, processor=processor))
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {entity}(name STRING, website STRING, fields ARRAY<STRING>) "
        f"RETURNS STRING RETURN {as_json}(to_json(named_struct('name', name, 'website', website)), to_json(fields))"
    )
    return names


def unregister(spark: SparkSession, prefix: str = "") -> None:
    """Drop the functions; absent ones are ignored."""
    for name in reversed(NAMES):
        spark.sql(f"DROP TEMPORARY FUNCTION IF EXISTS {prefix}{name}")


__all__ = [
    "call_by_group", "enrich_json_udf", "enrich_udf", "enrich_with_processor_udf", "register", "table_function",
    "unregister",
]
