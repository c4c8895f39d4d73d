"""From source columns to the named inputs a resolver sees."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType

from tablerich.operators.naming import strip

Inputs = Mapping[str, "str | Column"]


def check_columns(df: DataFrame, inputs: Inputs) -> None:
    """Raise for a mapped column the source does not have, before anything runs."""
    missing = [c for c in inputs.values() if isinstance(c, str) and c not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}; available: {df.columns}")


def as_column(value: str | Column) -> Column:
    return F.col(f"`{value}`") if isinstance(value, str) else value


def moment(value, kind: DataType) -> Column:
    """A date or time as a literal of the column's type.

    A value without an offset goes through text: as a Python literal it would be shifted from the zone
    of the driver to that of the session.
    """
    if isinstance(value, date) and getattr(value, "tzinfo", None) is None:
        return F.lit(str(value)).cast(kind)
    return F.lit(value).cast(kind)


def input_map(inputs: Inputs) -> Column:
    """``map<string,string>`` of the non-null inputs; empty when all are null."""
    pairs = [x for name, c in inputs.items() for x in (F.lit(name), as_column(c).cast("string"))]
    if not pairs:
        return F.expr("map_from_arrays(cast(array() as array<string>), cast(array() as array<string>))")
    return F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())


def input_json(inputs: Inputs) -> Column:
    """The same as JSON text; null inputs are left out."""
    if not inputs:
        return F.lit("{}")
    return F.to_json(F.struct(*[as_column(c).cast("string").alias(n) for n, c in inputs.items()]))


def parse_inline_rows(df: DataFrame, text: str, key: str) -> DataFrame:
    """Rows of JSON-array texts, one text per source row.

    Returns ``(key, ordinal, row map<string,string>, error)``. The first object of a text names its columns. A
    text that is not a JSON array of objects, or is empty, gives one row with the reason in ``error``; so does,
    at its place, an element that is no object or has a field the first one does not have.
    """
    items = F.from_json(F.col(text), "array<string>")
    is_list = F.ltrim(F.col(text)).startswith("[")
    error = (
        # Only text that did not read as a list is parsed again, to tell bad JSON from other JSON.
        F.when(~is_list | items.isNull(), F.when(F.try_parse_json(F.col(text)).isNull(), "The text is not JSON").otherwise(
            "A JSON array is expected"))
        .when(F.size(items) == 0, "The array is empty")
        .when(~F.ltrim(items[0]).startswith("{"), "The array must hold objects")
        .when(items[0] == "{}", "An object needs at least one field")
    )
    rows = df.select(F.col(key), error.alias("error"), items.alias("_items")).withColumn(
        "_items", F.when(F.col("error").isNull(), F.col("_items"))
    )
    first = F.json_object_keys(F.col("_items")[0])
    exploded = rows.select(key, "error", first.alias("_names"), F.posexplode_outer("_items").alias("_pos", "_item"))
    is_object = F.ltrim("_item").startswith("{")
    unknown = F.array_except(F.json_object_keys("_item"), "_names")
    wrong = F.when(~is_object, "The element is not an object").when(
        F.size(unknown) > 0, F.concat(F.lit("Unknown fields: "), F.array_join(unknown, ", "))
    )
    values = F.when(F.col("_problem").isNull(), F.from_json("_item", "map<string,string>"))
    return exploded.withColumn("_problem", F.coalesce("error", F.when(F.col("_pos").isNotNull(), wrong))).select(
        key, (F.col("_pos") + 1).alias("ordinal"), values.alias("row"), F.col("_problem").alias("error")
    )


def comma_list(values: Column) -> Column:
    """One flat array from an ``array<string>`` of comma-separated texts; blanks dropped."""
    parts = F.flatten(F.transform(values, lambda v: F.split(v, ",")))
    return F.array_remove(F.transform(parts, strip), "")
