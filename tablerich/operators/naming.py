"""Names, schemas and declared types of output columns."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, functions as F, types as T

# Declared type names and the Spark type of each.
DECLARED_TYPES: dict[str, T.DataType] = {
    "str": T.StringType(),
    "int": T.LongType(),
    "float": T.DoubleType(),
    "bool": T.BooleanType(),
    "datetime": T.TimestampType(),
    "date": T.DateType(),
    "str | None": T.StringType(),
    "int | None": T.LongType(),
    "float | None": T.DoubleType(),
    "bool | None": T.BooleanType(),
    "datetime | None": T.TimestampType(),
    "date | None": T.DateType(),
    "list[str]": T.ArrayType(T.StringType()),
    "list[int]": T.ArrayType(T.LongType()),
    "list[float]": T.ArrayType(T.DoubleType()),
    "list[bool]": T.ArrayType(T.BooleanType()),
}

# JSON schema type -> declared type name; anything else is "str".
JSON_SCHEMA_TYPES: dict[str, str] = {
    "string": "str",
    "integer": "int",
    "number": "float",
    "boolean": "bool",
    "array": "list[str]",
}


@dataclass(frozen=True)
class OutputColumn:
    """A declared output column."""

    name: str
    description: str
    type: str = "str"

    @property
    def spark_type(self) -> T.DataType:
        return DECLARED_TYPES.get(self.type, T.StringType())

    @property
    def required(self) -> bool:
        return not self.type.endswith("| None")

    def field(self) -> T.StructField:
        return T.StructField(self.name, self.spark_type, True, {"description": self.description})


# Every character that counts as white space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column) -> Column:
    """Drop white space of every kind at both ends (plain ``trim`` drops spaces only)."""
    return F.trim(c, F.lit(WHITE_SPACE))


def bind(c: Column, fn) -> Column:
    """``fn(c)`` with ``c`` computed once, however often ``fn`` uses it."""
    return F.get(F.transform(F.array(c), fn), F.lit(0))


def keep_if(c: Column, test) -> Column:
    """``c`` where ``test(c)`` holds, else null; ``c`` is computed once, which ``when(test(c), c)`` would not do."""
    return F.get(F.filter(F.array(c), test), F.lit(0))


def name_of(description: Column) -> Column:
    """Column name derived from a free-text description."""
    base = description
    for mark in "([{":
        base = F.substring_index(base, mark, 1)
    base = strip(base)
    kept = F.regexp_replace(F.translate(F.lower(base), " -", "__"), r"[^\p{L}\p{N}_]+", "")
    named = F.regexp_replace(kept, r"^$", "column")
    return F.regexp_replace(named, r"^(?=[^\p{L}])", "col_")


def derive_name(description: str) -> str:
    """``name_of`` for one description given by the user, at plan-building time."""
    base = re.split(r"[(\[{]", description, maxsplit=1)[0].strip().lower()
    name = re.sub(r"\W", "", re.sub(r"[ -]", "_", base))
    if not name:
        return "column"
    return name if name[0].isalpha() else f"col_{name}"


def output_columns(outputs: Sequence[str | OutputColumn]) -> list[OutputColumn]:
    """Declared columns for descriptions; a repeated name keeps its place and takes the last text."""
    columns: dict[str, OutputColumn] = {}
    for out in outputs:
        column = out if isinstance(out, OutputColumn) else OutputColumn(derive_name(out), out)
        columns[column.name] = column
    return list(columns.values())


def output_struct(outputs: Sequence[str | OutputColumn]) -> T.StructType:
    return T.StructType([c.field() for c in output_columns(outputs)])


def schema_json(descriptions: Column) -> Column:
    """JSON schema text for an ``array<string>`` of descriptions."""
    named = F.transform(descriptions, lambda d: F.struct(name_of(d).alias("name"), d.alias("description")))

    def text(entries: Column) -> Column:
        names = F.array_distinct(F.transform(entries, lambda x: x["name"]))
        last = lambda n: F.element_at(F.filter(entries, lambda x: x["name"] == n), -1)["description"]
        properties = F.map_from_entries(
            F.transform(
                names,
                lambda n: F.struct(
                    n.alias("key"),
                    F.struct(F.lit("string").alias("type"), last(n).alias("description")).alias("value"),
                ),
            )
        )
        return F.to_json(
            F.struct(F.lit("object").alias("type"), properties.alias("properties"), names.alias("required"))
        )

    return bind(named, text)


def declared_type(json_type: Column) -> Column:
    """Declared type name for a JSON schema type."""
    expr = F.lit("str")
    for source, target in JSON_SCHEMA_TYPES.items():
        expr = F.when(json_type == source, target).otherwise(expr)
    return expr


def schema_entries(schema_text: Column) -> Column:
    """``array<struct<name, description, type>>`` read from JSON schema text, in written order."""
    parsed = F.from_json(
        schema_text, "properties map<string, struct<type: string, description: string>>"
    )
    return F.transform(
        F.map_entries(parsed["properties"]),
        lambda e: F.struct(
            e["key"].alias("name"),
            F.coalesce(e["value"]["description"], F.lit("")).alias("description"),
            declared_type(e["value"]["type"]).alias("type"),
        ),
    )


# What can be text of a type at all. A failing cast costs far more than this test.
_PLAUSIBLE = {
    T.LongType: r"^\s*[+-]?\d+\s*$",
    T.DoubleType: r"(?i)^\s*[+-]?(?:\d|\.\d|inf|nan)",
    T.BooleanType: r"(?i)^\s*(?:t|true|y|yes|1|f|false|n|no|0)\s*$",
    T.TimestampType: r"^\s*[+-]?\d{4}",
    T.DateType: r"^\s*[+-]?\d{4}",
}


NESTED = (T.ArrayType, T.MapType, T.StructType, T.VariantType)


def as_text(c: Column, kind: T.DataType) -> Column:
    """A value of type ``kind`` as text; nested ones as JSON."""
    if isinstance(kind, T.StringType):
        return c
    return F.to_json(c) if isinstance(kind, NESTED) else c.cast("string")


def cast_declared(c: Column, type_name: str, kind: T.DataType | None = None) -> Column:
    """A value to a declared type; one that does not fit becomes null. ``kind`` is its type, text if not given."""
    spark_type = DECLARED_TYPES.get(type_name, T.StringType())
    if kind is not None and not isinstance(kind, T.StringType):
        if kind == spark_type:
            return c
        if isinstance(kind, NESTED) or isinstance(spark_type, (T.StringType, T.ArrayType)):
            both = isinstance(spark_type, T.ArrayType) and isinstance(kind, T.ArrayType)
            inner = spark_type.elementType if both else None
            if both and not isinstance(kind.elementType, NESTED):
                return F.transform(c, lambda x: x.try_cast(inner))
            return cast_declared(as_text(c, kind), type_name)
        return c.try_cast(spark_type)
    if isinstance(spark_type, T.ArrayType):
        return F.from_json(c, spark_type)
    if isinstance(spark_type, T.StringType):
        return c
    return F.when(c.rlike(_PLAUSIBLE[type(spark_type)]), c.try_cast(spark_type))
