"""Large JSON arrays of objects, read by many tasks.

A file that holds one array has no lines to cut it at, so Spark would read it in one piece. Here it is read in pieces that
end at a closing brace, which Spark deals out by byte ranges like lines. Whether a piece begins inside of a string and how
deep it lies depends on all before it; but what a range does to either state is known from the range alone. So a first
pass sums up each range for both states, the ranges of a file are put in a row (one short list per file), and a second
pass, knowing how each range begins, cuts the elements. The element that crosses ranges is put together from its parts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROKEN = "broken"

# A whole string, and the rest of one that is open.
_STRING = re.compile(r'"(?:[^"\\]|\\.)*"', re.DOTALL)
_REST = re.compile(r'(?:[^"\\]|\\.)*"', re.DOTALL)


def step(piece: str, inside: bool) -> tuple[bool, int]:
    """(whether a string is open behind a piece and its brace, by how much the depth changed)."""
    text = piece
    if inside:
        end = _REST.match(text)
        if end is None:
            return True, 0
        text = text[end.end() :]
    bare = _STRING.sub("", text)
    cut = bare.find('"')
    if cut >= 0:
        bare = bare[:cut]
    deeper = bare.count("{") + bare.count("[") - bare.count("}") - bare.count("]")
    # the piece's own brace counts unless it stands in a string
    return cut >= 0, deeper if cut >= 0 else deeper - 1


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.option("lineSep", "}").text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("piece")
    )


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per range: for a string closed or open before it, what is behind it."""
    found: dict[tuple[str, int], list] = {}
    for batch in batches:
        for file, start, piece in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            states = found.setdefault((file, start), [(False, 0), (True, 0)])
            for i, (inside, depth) in enumerate(states):
                after, change = step(piece, inside)
                states[i] = after, depth + change
    for (file, start), states in found.items():
        names = ["file", "start", "closed_in", "closed_by", "open_in", "open_by"]
        values = [file, start, *states[0], *states[1]]
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in values], names=names)


def _row(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How each range of a file begins; a file is one row with its ranges in order."""
    for batch in batches:
        for file, ranges in zip(batch.column("file").to_pylist(), batch.column("ranges").to_pylist(), strict=True):
            inside, depth, out = False, 0, []
            for r in ranges:
                out.append((file, r["start"], inside, depth))
                inside, depth = (r["open_in"], depth + r["open_by"]) if inside else (r["closed_in"], depth + r["closed_by"])
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=["file", "start", "inside", "depth"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Elements of each range (kind 1), what ends the element before it (0) and what begins one behind it (2)."""
    key, kept, head, inside, depth = None, [], False, False, 0
    for batch in batches:
        out = []
        for file, start, piece, begins, deep in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            if key != (file, start):
                if key is not None:
                    out.append((*key, 2, "".join(kept)))
                key, kept, head, inside, depth = (file, start), [], start > 0, begins, deep
            kept += piece, "}"
            inside, change = step(piece, inside)
            depth += change
            if depth == 1 and not inside:
                out.append((*key, 0 if head else 1, "".join(kept)))
                kept, head = [], False
        if out:
            yield _rows(out)
    if key is not None:
        yield _rows([(*key, 2, "".join(kept))])


def _rows(out: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=["file", "start", "kind", "text"])


def elements(spark: SparkSession, path: str) -> DataFrame:
    """(file, element) of all files with JSON arrays of objects below a path: the text of each element.

    A range ends at a brace, so only objects are told apart; what else stands in an array is part of the next element.
    What is left behind the last element and is not the array's end is an element too."""
    pieces = _pieces(spark, path)
    sums = pieces.mapInArrow(_summed, "file string, start long, closed_in boolean, closed_by long, open_in boolean, open_by long")
    # a list as long as the file has ranges
    rows = sums.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("start", "closed_in", "closed_by", "open_in", "open_by"))).alias("ranges"))
    begins = rows.mapInArrow(_row, "file string, start long, inside boolean, depth long")
    # one row per range of a file
    known = begins.select(F.col("file").alias("_file"), F.col("start").alias("_start"), "inside", "depth")
    own = pieces.join(F.broadcast(known), (F.col("file") == F.col("_file")) & (F.col("start") == F.col("_start")))
    cut = own.select("file", "start", "piece", "inside", "depth").mapInArrow(_cut, "file string, start long, kind int, text string")
    whole = cut.filter("kind = 1").select("file", "text")
    # parts of the elements between ranges: each begins with what is left of a range
    parts = cut.filter("kind <> 1")
    order = Window.partitionBy("file").orderBy("start", "kind")
    before = F.lag("kind").over(order)
    # a range without an end of an element goes on with the one before
    number = F.sum(F.when((before == 0) | before.isNull(), 1).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, 0))
    grouped = parts.withColumn("n", number).groupBy("file", "n").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("start", "kind", "text"))), lambda p: p["text"]), "").alias("text")
    )
    element = F.regexp_replace("text", r"^[\s,]*\[?[\s,]*", "")
    return whole.unionByName(grouped.select("file", "text")).select("file", element.alias("element")).filter(
        ~F.col("element").rlike(r"^\s*\]?\s*\}?\s*$")
    )


def read_array(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(rows of the elements that can be read, texts of those that can't) of files with JSON arrays of objects."""
    kind = T.StructType.fromDDL(schema)
    marked = T.StructType([*kind.fields, T.StructField(BROKEN, T.StringType())])
    parsed = elements(spark, path).select(
        "element", F.from_json("element", marked, {"columnNameOfCorruptRecord": BROKEN}).alias("row")
    )
    bad = F.coalesce(F.col(f"row.{BROKEN}").isNotNull(), F.lit(True))
    return parsed.filter(~bad).select(*[F.col(f"row.`{f.name}`") for f in kind.fields]), parsed.filter(bad).select("element")
