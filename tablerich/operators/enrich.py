"""Row enrichment: source rows in, the same rows with new columns out."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace
from functools import cached_property

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from tablerich.operators.inputs import Inputs, check_columns, input_json
from tablerich.operators.naming import OutputColumn, as_text as text_of, cast_declared, name_of, output_columns
from tablerich.operators.resolvers import (
    BASIS_TYPE,
    RESULT,
    CallableResolver,
    Resolver,
    RowFunction,
    TableResolver,
    as_text,
    call_in_chunks,
    resolve,
)
from tablerich.session import CALL_ROWS, cut_lineage

Outputs = Sequence["str | OutputColumn"]


@dataclass(frozen=True)
class Enriched:
    """A lazy enrichment: nothing runs until one of its DataFrames is used.

    With ``once`` the answers are costly and may differ from call to call: the first view that is asked for writes
    them to the shared folder, and every view reads what was written.
    """

    resolved: DataFrame
    source_columns: list[str]
    inputs: Inputs
    outputs: list[OutputColumn]
    once: bool = False

    @cached_property
    def rows(self) -> DataFrame:
        """Source rows with their results, as all views share them."""
        return cut_lineage(self.resolved, "resolved") if self.once and not self.resolved.isStreaming else self.resolved

    def stored(self) -> Enriched:
        """The same, resolved once for all of its views."""
        return replace(self, once=True)

    def _value(self, name: str) -> tuple[Column, T.DataType]:
        kinds = self.resolved.schema[RESULT].dataType["values"].dataType
        return F.col(f"{RESULT}.values.`{name}`"), kinds[name].dataType

    def texts(self) -> list[Column]:
        """Every output as text, under its name."""
        return [text_of(*self._value(o.name)).alias(o.name) for o in self.outputs]

    def typed(self) -> dict[str, Column]:
        """Every output in its declared type."""
        return {o.name: cast_declared(self._value(o.name)[0], o.type, self._value(o.name)[1]) for o in self.outputs}

    def results(self) -> DataFrame:
        """Source columns, ``status``, ``answer`` (JSON text, null on error) and ``error``."""
        return self.rows.select(
            *[F.col(f"`{c}`") for c in self.source_columns],
            F.when(F.col(f"{RESULT}.error").isNull(), "completed").otherwise("failed").alias("status"),
            F.when(F.col(f"{RESULT}.error").isNull(), F.to_json(F.struct(*self.texts()))).alias("answer"),
            F.col(f"{RESULT}.error").alias("error"),
        )

    def table(
        self, *, include_basis: bool = False, basis_column: str = "_basis", keep: str = "all"
    ) -> DataFrame:
        """Source columns plus one column per output; failed rows hold nulls.

        An output named like a source column replaces it. ``keep="inputs"`` drops source columns
        that are not inputs, so a columnar scan never reads them.
        """
        new = self.typed()
        if include_basis:
            new[basis_column] = F.col(f"{RESULT}.basis")
        kept = self.source_columns
        if keep == "inputs":
            mapped = {c for c in self.inputs.values() if isinstance(c, str)}
            kept = [c for c in kept if c in mapped]
        columns = [new.pop(c).alias(c) if c in new else F.col(f"`{c}`") for c in kept]
        return self.rows.select(*columns, *[v.alias(n) for n, v in new.items()])

    def json_column(self, name: str = "enriched_data", include_basis: bool = False) -> DataFrame:
        """Source columns plus one JSON text column; failed rows hold ``{"error": …}``."""
        values = self.texts()
        if include_basis:
            values.append(F.col(f"{RESULT}.basis").alias("_basis"))
        error = F.col(f"{RESULT}.error")
        text = F.when(error.isNull(), F.to_json(F.struct(*values))).otherwise(
            F.to_json(F.struct(error.alias("error")))
        )
        return self.rows.select(*[F.col(f"`{c}`") for c in self.source_columns], text.alias(name))

    def errors(self) -> DataFrame:
        """The failed rows with their reason."""
        return self.rows.filter(F.col(f"{RESULT}.error").isNotNull()).select(
            *[F.col(f"`{c}`") for c in self.source_columns], F.col(f"{RESULT}.error").alias("error")
        )

    def metrics(self) -> DataFrame:
        """One row: total, success and error counts."""
        # A single use of the error lets Spark drop the answers, down to the scan of the knowledge.
        return self.rows.select(F.col(f"{RESULT}.error").alias("_error")).agg(*_counts(F.col("_error")))

    def observed(self, name: str = "enrichment") -> tuple[DataFrame, Observation]:
        """``table()`` that also counts successes and errors while it is written or read."""
        observation = Observation(name)
        watched = replace(self, resolved=self.rows.observe(observation, *_counts(F.col(f"{RESULT}.error"))), once=False)
        return watched.table(), observation


def _counts(error: Column) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total_count"),
        F.count_if(error.isNull()).alias("success_count"),
        F.count_if(error.isNotNull()).alias("error_count"),
    ]


def enrich(
    df: DataFrame, inputs: Inputs, outputs: Outputs, resolver: Resolver, *, where: Column | None = None
) -> Enriched:
    """Add described columns to every row of ``df``.

    ``where`` is applied below the resolver, so rows it drops are never resolved.
    """
    source = df if where is None else df.filter(where)
    columns = output_columns(outputs)
    costly = isinstance(resolver, CallableResolver)
    return Enriched(resolve(source, inputs, columns, resolver), df.columns, inputs, columns, costly)


def enrich_one(spark, values: dict, outputs: Outputs, resolver: Resolver) -> Enriched:
    """Enrich one record given as a dict."""
    row = spark.createDataFrame([tuple(values.values())], list(values))
    return enrich(row, {k: k for k in values}, outputs, resolver)


def typed_job(
    df: DataFrame, inputs: Inputs, outputs: Outputs, resolver: Resolver, *, stamp: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Inner result: inputs as text, outputs cast to their declared types.

    Rows without an answer, or missing a required output after the cast, are left out of the first
    DataFrame and returned in the second with the reason. An output wins over an input of its name.
    """
    job = enrich(df, inputs, outputs, resolver)
    columns = job.outputs
    typed = job.typed()
    missing = F.filter(
        F.array(*[F.when(typed[o.name].isNull(), F.lit(o.name)) for o in columns if o.required]),
        lambda n: n.isNotNull(),
    )
    reason = F.coalesce(
        F.col(f"{RESULT}.error"),
        F.when(F.size(missing) > 0, F.concat(F.lit("missing or invalid: "), F.array_join(missing, ", "))),
    )
    names = {n: c for n, c in inputs.items() if n not in typed}
    projected = [(F.col(f"`{c}`") if isinstance(c, str) else c).cast("string").alias(n) for n, c in names.items()]
    checked = job.rows.withColumn("_reason", reason)
    good = checked.filter(F.col("_reason").isNull()).select(*projected, *[c.alias(n) for n, c in typed.items()])
    if stamp:
        good = good.withColumns(
            {"batch_id": F.lit(str(uuid.uuid4())), "insertion_timestamp": F.current_timestamp()}
        )
    bad = checked.filter(F.col("_reason").isNotNull()).select(*projected, F.col("_reason").alias("error"))
    return good, bad


def enrich_requested(
    df: DataFrame,
    input_text: str,
    requested_text: str,
    keys: dict[str, str],
    answers: dict[str, str | Column],
    knowledge: DataFrame,
) -> DataFrame:
    """Each row asks for its own outputs.

    ``input_text`` holds a JSON object, ``requested_text`` a JSON array of descriptions; other text in
    it counts as a single description. ``keys`` maps fields of the input object to knowledge columns.
    One lookup serves all rows; every row then keeps what it asked for, in ``reply`` (JSON text). A row that asks for
    an output that is not offered gets an error.
    """
    requested = F.col(requested_text)
    listed = F.coalesce(F.from_json(requested, "array<string>"), F.array(requested))
    parsed = F.try_parse_json(F.col(input_text))
    error = F.when(F.col(input_text).isNull() | requested.isNull(), "Invalid arguments").when(
        parsed.isNull(), "Invalid input JSON"
    )
    inputs = {f: F.when(F.col("_error").isNull(), F.get_json_object(input_text, f"$.{f}")) for f in keys}
    prepared = df.withColumns({"_error": error, "_names": F.transform(listed, name_of)})
    columns = [OutputColumn(n, n) for n in answers]
    resolver = TableResolver(knowledge, keys, answers)
    resolved = resolver.attach(prepared, inputs, columns)
    kinds = resolved.schema[RESULT].dataType["values"].dataType
    pairs = [x for n in answers for x in (F.lit(n), text_of(F.col(f"{RESULT}.values.`{n}`"), kinds[n].dataType))]
    unknown = F.array_except("_names", F.array(*[F.lit(n) for n in answers]))
    wanted = F.map_filter(F.create_map(*pairs), lambda k, _: F.array_contains("_names", k))
    problem = F.coalesce(
        F.col("_error"),
        F.when(F.size(unknown) > 0, F.concat(F.lit("Outputs not offered: "), F.array_join(unknown, ", "))),
        F.col(f"{RESULT}.error"),
    )
    reply = F.when(problem.isNotNull(), F.to_json(F.struct(problem.alias("error")))).otherwise(F.to_json(wanted))
    return resolved.select(*[F.col(f"`{c}`") for c in df.columns], reply.alias("reply"))


def split_groups(df: DataFrame, by: Sequence[str], row_key: Sequence[str], rows: int = CALL_ROWS) -> DataFrame:
    """Add ``group_rows`` (rows of the group) and ``split``, which cuts a group into about ``rows`` each.

    A group with a third of the table so becomes many small units instead of one task.
    """
    sizes = df.groupBy(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(by)]).agg(F.count(F.lit(1)).alias("group_rows"))
    same = [F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(by)]
    sized = df.join(sizes, same, "left").select(*df.columns, "group_rows")
    splits = F.ceil(F.col("group_rows") / F.lit(rows))
    return sized.withColumn("split", F.pmod(F.xxhash64(*row_key), splits))


def enrich_partitioned(
    df: DataFrame,
    by: Sequence[str],
    row_key: Sequence[str],
    inputs: Inputs,
    outputs: Outputs,
    fn: RowFunction,
    rows: int = CALL_ROWS,
) -> DataFrame:
    """One call per group, or several for a group above ``rows``: ``(by…, row_key…, enriched)``.

    ``row_key`` must tell the rows of a group apart, because it deals them out over the parts.
    """
    check_columns(df, inputs)
    names = [o.name for o in output_columns(outputs)]
    columns = list(dict.fromkeys([*by, *row_key]))
    units = split_groups(df, by, row_key, rows).select(
        *columns, "split", input_json({**inputs, "group_rows": "group_rows"}).alias("_sent")
    )
    schema = units.select(*columns).schema.add("enriched", "string")
    # With a given number Spark does not merge small partitions: calls are slow, rows are few.
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    units = units.repartition(parts, *by, "split")

    # Batches of a group are streamed; a group is never held as a whole.
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sent = [json.loads(x) for x in batch.column("_sent").to_pylist()]
            answers = [as_text(r) for r in call_in_chunks(fn, sent, names, rows)]
            kept = [batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(answers, pa.string())], [*columns, "enriched"])

    return units.groupBy(*by, "split").applyInArrow(run, schema)


def enrich_new(
    df: DataFrame, cache: DataFrame, key: Sequence[str], inputs: Inputs, outputs: Outputs, resolver: Resolver,
    stamp: str = "enriched_at",
) -> DataFrame:
    """Resolve only the rows whose key is not in ``cache``; cached answers are kept as they are.

    Keys of the cache that ``df`` does not hold are left out. Of several cached rows of a key the one with the latest
    ``stamp`` counts, if the cache has that column.
    """
    names = [o.name for o in output_columns(outputs)]
    answer = F.struct(*names)
    latest = F.max_by(answer, F.col(stamp)) if stamp in cache.columns else F.min(answer)
    held = cache.groupBy(*key).agg(latest.alias("_held")).select(*key, "_held.*").hint("rebalance")
    known = df.select(*key).join(held, list(key)).select(*key, *names)
    fresh = enrich(df.join(cache.select(*key), list(key), "left_anti"), inputs, outputs, resolver).table()
    return known.unionByName(fresh.select(*key, *names))


def with_context(
    df: DataFrame, earlier: DataFrame, on: str, values: str, earlier_values: str, order: str | None = None
) -> DataFrame:
    """Merge the answers of an earlier run into new input maps; a new key wins over an old one.

    Of several earlier runs of a key the one with the greatest ``order`` counts (by the text of its answers without it).
    """
    rank = F.to_json(earlier_values) if order is None else F.col(order)
    old = earlier.groupBy(F.col(on).alias("_on")).agg(F.max_by(F.col(earlier_values), rank).alias("_old")).hint("rebalance")
    joined = df.join(old, df[on] == F.col("_on"), "left")
    kept = F.map_filter("_old", lambda k, _: ~F.map_contains_key(F.col(values), k))
    merged = F.when(F.col("_old").isNull(), F.col(values)).otherwise(F.map_concat(kept, F.col(values)))
    return joined.withColumn(values, merged).drop("_on", "_old")


def parse_content(c: Column) -> Column:
    """A JSON object as it is (compact text); anything else as ``{"result": text}``."""
    as_result = F.to_json(F.struct(c.alias("result")))
    # Text that does not start like an object is never parsed.
    parsed = F.when(F.ltrim(c).startswith("{"), F.try_parse_json(c))
    return F.coalesce(F.to_json(parsed), as_result)


def unpack_json(df: DataFrame, column: str, schema: str) -> DataFrame:
    """Replace a JSON text column by one column per field of ``schema``."""
    parsed = df.withColumn("_u", F.from_json(column, schema))
    return parsed.select(*[F.col(f"`{c}`") for c in df.columns if c != column], "_u.*")


def error_or_value(text: Column, path: str) -> Column:
    """``Error: <reason>`` for a failed result, else the value at ``path``."""
    error = F.get_json_object(text, "$.error")
    return F.when(error.isNotNull(), F.concat(F.lit("Error: "), error)).otherwise(F.get_json_object(text, path))


def normalise_basis(basis: Column) -> Column:
    """Drop empty parts of each entry, use url/title/excerpts only as a fallback, drop empty entries."""
    blank = lambda c: F.when(c != "", c)
    filled = lambda c: F.when(F.size(c) > 0, c)

    def entry(b: Column) -> Column:
        field, why, sure = blank(b["field"]), blank(b["reasoning"]), blank(b["confidence"])
        cited = filled(b["citations"])
        bare = field.isNull() & cited.isNull() & why.isNull() & sure.isNull()
        return F.struct(
            field.alias("field"),
            F.transform(
                cited,
                lambda c: F.struct(
                    c["url"].alias("url"),
                    F.coalesce(c["excerpts"], F.array().cast("array<string>")).alias("excerpts"),
                ),
            ).alias("citations"),
            why.alias("reasoning"),
            sure.alias("confidence"),
            F.when(bare, blank(b["url"])).alias("url"),
            F.when(bare, blank(b["title"])).alias("title"),
            F.when(bare, filled(b["excerpts"])).alias("excerpts"),
        )

    parts = ("field", "citations", "reasoning", "confidence", "url", "title", "excerpts")
    empty = lambda b: F.coalesce(*[b[p].cast("string") for p in parts]).isNull()
    cleaned = F.filter(F.transform(basis.cast(BASIS_TYPE), entry), lambda b: ~empty(b))
    return F.coalesce(cleaned, F.array().cast(BASIS_TYPE))


def citations(df: DataFrame, basis: str, keys: Sequence[str]) -> DataFrame:
    """One row per key, field, cited url and excerpt."""
    entries = df.select(*keys, F.explode(basis).alias("_b"))
    cited = entries.select(*keys, "_b.field", "_b.confidence", F.explode("_b.citations").alias("_c"))
    return cited.select(
        *keys, "field", F.col("_c.url").alias("url"), F.explode_outer("_c.excerpts").alias("excerpt"), "confidence"
    )


__all__ = [
    "CallableResolver",
    "Enriched",
    "citations",
    "enrich",
    "enrich_new",
    "enrich_one",
    "enrich_partitioned",
    "enrich_requested",
    "error_or_value",
    "normalise_basis",
    "parse_content",
    "split_groups",
    "typed_job",
    "unpack_json",
    "with_context",
]
