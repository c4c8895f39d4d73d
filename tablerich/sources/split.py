"""Records of one large file, cut exactly and read by many tasks.

Spark reads text in ranges of bytes, and a range begins behind a separator; but whether that separator ends a record
depends on what comes before it: a line break may lie inside a quoted CSV field, a brace inside a JSON text. So the
file is read twice. The first pass scans every range from each state it may begin in and keeps one row for it: which
state it then ends in. These rows, composed in the order of the file, tell the state each range does begin in. The
second pass cuts its records. What a range holds of a record that began before it, or goes on behind it, is put together
at the end, a few rows for each range.

Any file system Spark reads will do, as Spark does the reading. Files are UTF-8.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

_ESCAPED = re.compile(r"\\.", re.DOTALL)
_SUMMARY = "file string, begin bigint, s0 int, d0 bigint, s1 int, d1 bigint, opens boolean"
_PIECES = "file string, begin bigint, n bigint, record string, goes_on boolean, continues boolean"


class CsvLines:
    """Lines; a record ends where no quoted field is open. The state is whether one is."""

    separator = "\n"

    @staticmethod
    def scan(piece: str, quoted: int) -> tuple[int, int]:
        return (quoted + piece.count('"')) % 2, 0

    @staticmethod
    def ends(quoted: int, depth: int) -> bool:
        return not quoted


class JsonObjects:
    """Text up to each closing brace; a record is an object in an array, at depth 1. The state is whether a text is open."""

    separator = "}"

    @staticmethod
    def scan(piece: str, quoted: int) -> tuple[int, int]:
        if "\\" in piece:
            piece = _ESCAPED.sub("", piece)
        parts = piece.split('"')
        plain = "".join(parts[quoted::2])
        quoted = (quoted + len(parts) - 1) % 2
        # The brace that ends the piece closes an object unless it is part of a text.
        return quoted, plain.count("{") + plain.count("[") - plain.count("]") - (not quoted)

    @staticmethod
    def ends(quoted: int, depth: int) -> bool:
        return not quoted and depth == 1


def _read(spark: SparkSession, path: str, separator: str) -> DataFrame:
    text = spark.read.option("lineSep", separator).text(path)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("begin"), "value")


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, bool, str]]:
    """``file, begin``, whether a range begins here, and the piece. Pieces of a range come in order."""
    last = None
    for batch in batches:
        for place in zip(batch.column("file").to_pylist(), batch.column("begin").to_pylist(), batch.column("value").to_pylist()):
            yield (*place[:2], place[:2] != last, place[2])
            last = place[:2]


def _batch(rows: list[tuple], names: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    fields = [f.split() for f in names.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*rows), fields)], [n for n, _ in fields])


def _summaries(pieces: DataFrame, machine) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, ends, opens = None, None, False
        for file, begin, fresh, piece in _ranges(batches):
            if fresh:
                if place is not None:
                    yield _batch([(*place, *ends[0], *ends[1], opens)], _SUMMARY)
                place, ends, opens = (file, begin), [(0, 0), (1, 0)], piece.lstrip("\ufeff \t\r\n")[:1] == "["
            for s in (0, 1):
                state, depth = machine.scan(piece, ends[s][0])
                ends[s] = (state, ends[s][1] + depth)
        if place is not None:
            yield _batch([(*place, *ends[0], *ends[1], opens)], _SUMMARY)

    return pieces.mapInArrow(scan, _SUMMARY)


def _begins(summaries: list, what: str, array: bool) -> dict[tuple[str, int], tuple[int, int]]:
    """The state and depth each range begins with; raises for files that end inside a record."""
    found: dict[tuple[str, int], tuple[int, int]] = {}
    file, quoted, depth = None, 0, 0

    def check() -> None:
        # Behind the bracket that ends an array a brace is counted that is not there.
        if file is not None and (quoted or (array and depth != -1)):
            raise ValueError(f"{file} ends inside {what}")

    for r in sorted(summaries, key=lambda r: (r["file"], r["begin"])):
        if r["file"] != file:
            check()
            file, quoted, depth = r["file"], 0, 0
            if array and not r["opens"]:
                raise ValueError(f"{file} is no JSON array; read it as lines")
        found[r["file"], r["begin"]] = (quoted, depth)
        quoted, depth = (r["s1"], depth + r["d1"]) if quoted else (r["s0"], depth + r["d0"])
    check()
    return found


def split_records(spark: SparkSession, path: str, machine, what: str) -> DataFrame:
    """``file, begin, n, record``: the records of the files, ``n`` counts them within a range."""
    pieces = _read(spark, path, machine.separator)
    # One row for each range of bytes.
    begins = _begins(_summaries(pieces, machine).collect(), what, machine is JsonObjects)
    states = spark.sparkContext.broadcast(begins)
    separator = machine.separator
    #: The separator is part of an object, and of a record whose field goes on in the next line.
    closing = separator if machine is JsonObjects else ""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held, place, n, quoted, depth, began = [], [], None, 0, 0, 0, False

        def tail() -> list[tuple]:
            # What a range ends with inside a record, or behind its last one.
            return [(*place, n, separator.join(held) + separator, True, not began)] if held else []

        for file, begin, fresh, piece in _ranges(batches):
            if fresh:
                out += tail()
                place, n, held = (file, begin), 0, []
                quoted, depth = states.value[place]
                began = machine.ends(quoted, depth) or (begin == 0)
            held.append(piece)
            quoted, more = machine.scan(piece, quoted)
            depth += more
            if machine.ends(quoted, depth):
                out.append((*place, n, separator.join(held) + closing, False, not began))
                held, n, began = [], n + 1, True
            if len(out) >= 4096:
                yield _batch(out, _PIECES)
                out = []
        out += tail() if place is not None else []
        if out:
            yield _batch(out, _PIECES)

    found = pieces.mapInArrow(cut, _PIECES)
    whole = found.filter("NOT goes_on AND NOT continues").select("file", "begin", "n", "record")
    parts = found.filter("goes_on OR continues")
    # A record is named by the part that begins it; at most two parts for each range.
    order = Window.partitionBy("file").orderBy("begin", "n")
    named = parts.withColumn("head", F.last(F.when(~F.col("continues"), F.struct("begin", "n")), ignorenulls=True).over(order))
    joined = named.groupBy("file", "head").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("begin", "n", "record"))), lambda x: x["record"]), "").alias("record"))
    return whole.unionByName(joined.select("file", "head.begin", "head.n", "record"))


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """CSV records with their quotes and line breaks, without the header of each file and empty lines."""
    found = split_records(spark, path, CsvLines, "a quoted field")
    # The break that ends a record is not part of it.
    plain = F.regexp_replace("record", r"\r?\n?\z", "")
    return found.filter("NOT (begin = 0 AND n = 0)").select(plain.alias("record")).filter("record != ''")


def json_objects(spark: SparkSession, path: str) -> DataFrame:
    """The objects of files that each hold one array, as text in one line each (a JSON text holds no line breaks)."""
    found = split_records(spark, path, JsonObjects, "its array")
    # Before an object stand a comma, or the bracket that opens the array; behind the last one the bracket that closes it.
    text = F.regexp_replace("record", r"\A[\s\x{FEFF}]*[\[,]?\s*", "")
    line = F.translate(text, "\r\n", "  ")
    ended = F.regexp_replace(line, r"\s|\}\z", "") == "]"
    return found.select(line.alias("record"), ended.alias("ended")).filter("NOT ended").select("record")
