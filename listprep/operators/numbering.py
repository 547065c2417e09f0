"""Row numbers, pages and progress without a single-task window and without storing the rows.

A global ``row_number`` would pull a table through one task, and a per-group one would pull a hot group through one task.
Instead the keys are cut in cells by a histogram of two levels: 256 equal parts between the smallest and the largest key
of a group, and 256 parts between those of each such cell. A row's number is the count of all cells before its own plus
its place inside the cell. Cells come from exact minima, maxima and counts, which do not depend on how the rows lie, so
counts and rows may be computed apart, any part of them again after a loss, and building a frame runs nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listprep.operators.joins import join_unique

# Cells of each level, and hexadecimal digits behind the common prefix that tell them apart.
CELLS, DIGITS = 256, 13
# Bytes of a text that are looked at.
TEXT_BYTES = 400


def _digits(key: Column, kind: T.DataType) -> tuple[Column | None, bool]:
    """Hexadecimal digits that are in the order of the key, as far as they go, and whether keys may follow behind them."""
    if isinstance(kind, T.StructType):
        fields = []
        for field in kind.fields:
            made, more = _digits(key[field.name], field.dataType)
            if made is not None:
                fields.append(made)
            if not more:
                return (F.concat(*fields) if fields else None), False
        return F.concat(*fields), True
    if isinstance(kind, T.DateType):
        key, kind = F.unix_date(key).cast("long"), T.LongType()
    elif isinstance(kind, T.TimestampType):
        key, kind = F.unix_micros(key), T.LongType()
    elif isinstance(kind, T.BooleanType):
        key, kind = key.cast("long"), T.LongType()
    if isinstance(kind, T.IntegralType):
        made, more = F.lpad(F.hex(key.cast("long").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0"), True
    elif isinstance(kind, T.StringType):
        made, more = F.hex(F.substring(key.cast("binary"), 1, TEXT_BYTES)), False
    else:
        return None, False
    return F.when(key.isNull(), "0").otherwise(F.concat(F.lit("1"), made)), more


def _code(df: DataFrame, keys: Sequence[str]) -> Column:
    """One text per row in the order of the keys, nulls first; equal for keys it does not tell apart."""
    parts = []
    for key in keys:
        made, more = _digits(F.col(key), df.schema[key].dataType)
        if made is not None:
            parts.append(made)
        if not more:
            break
    return F.concat(*parts) if parts else F.lit("")


def _number(code: Column, prefix: Column) -> Column:
    """The digits behind a prefix as a whole number."""
    return F.conv(F.rpad(F.substring(code, prefix + 1, F.lit(DIGITS)), DIGITS, "0"), 16, 10).cast("long")


def _span(code: str) -> list[Column]:
    """Aggregates of a cell: length of the common prefix of its keys, and where their numbers begin and how far they go."""
    low, high = F.min(code), F.max(code)
    same = F.filter(F.sequence(F.lit(0), F.length(low)), lambda n: F.substring(low, F.lit(1), n) == F.substring(high, F.lit(1), n))
    prefix = F.size(same) - 1
    return [prefix.alias("_prefix"), _number(low, prefix).alias("_low"), (_number(high, prefix) - _number(low, prefix) + 1).alias("_far")]


def _cell() -> Column:
    return F.call_function("div", (_number(F.col("_code"), F.col("_prefix")) - F.col("_low")) * CELLS, F.col("_far")).cast("int")


def number_rows(
    df: DataFrame,
    order_by: Sequence[str | Column],
    group_by: Sequence[str] = (),
    number: str = "rn",
    total: str | None = None,
) -> DataFrame:
    """1-based row numbers by an ascending order (nulls first), over the table or within groups.

    Rows that are equal in all keys get their numbers in any order.  The key columns are read four times, all others
    once; a frame that is costly to make should be stored before.  Dates, times, whole numbers, booleans, texts and
    structs of them make cells; rows that differ only in keys of other types, or behind the first text, share one."""
    # keys as columns, so that sorting does not evaluate an expression per comparison
    made = {f"_k{i}": key for i, key in enumerate(order_by) if isinstance(key, Column)}
    keys = [f"_k{i}" if isinstance(key, Column) else key for i, key in enumerate(order_by)]
    rows = df.withColumns(made)
    # a null group is a group; without groups all rows have one, which is no constant, so that sides are met by hashes
    named = [F.coalesce(F.concat(F.lit("="), F.col(g).cast("string")), F.lit("")) for g in group_by]
    rows = rows.withColumn("_code", _code(rows, keys))
    rows = rows.withColumn("_group", F.array(*named) if named else F.substring("_code", 1, 0))
    slim = rows.select("_group", "_code")

    def placed(frame: DataFrame, side: DataFrame, on: list[str], bounded: bool) -> DataFrame:
        """Rows with what a table of unique keys says; a hot key is split, a bounded side is sent to all."""
        if not bounded:
            return join_unique(frame, side, on, "inner")
        return frame.join(F.broadcast(side), on).select(*frame.columns, *[c for c in side.columns if c not in on])

    def celled(frame: DataFrame) -> DataFrame:
        columns = frame.columns
        frame = placed(frame, slim.groupBy("_group").agg(*_span("_code")), ["_group"], not group_by)
        frame = frame.select(*columns, _cell().alias("_rough"))
        return frame

    def numbered(frame: DataFrame) -> DataFrame:
        columns = frame.columns
        parts = celled(slim).groupBy("_group", "_rough").agg(*_span("_code"))
        frame = placed(celled(frame), parts, ["_group", "_rough"], not group_by)
        return frame.select(*columns, (F.col("_rough") * CELLS + _cell()).alias("_fine"))

    # at most CELLS * CELLS rows, per group if there are groups
    counts = numbered(slim).groupBy("_group", "_fine").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("_group").orderBy("_fine").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    if total:
        counts = counts.withColumn(total, F.sum("_n").over(Window.partitionBy("_group")))
    inside = F.row_number().over(Window.partitionBy("_group", "_fine").orderBy(*keys))
    own = numbered(rows).withColumn("_inside", inside)
    found = placed(own, counts.drop("_n"), ["_group", "_fine"], not group_by)
    return found.withColumn(number, F.col("_inside") + F.col("_before")).select(
        *df.columns, number, *([total] if total else [])
    )


def page_of(number: Column, page_size: int) -> Column:
    """0-based page of a 1-based row number."""
    return F.call_function("div", number - 1, F.lit(page_size))


def paginate(df: DataFrame, key: str, page_size: int = 50_000, max_pages: int = 0) -> DataFrame:
    """Adds ``page``: consecutive pages of ``page_size`` rows by key order; with a budget only the first pages, and
    then only their rows are numbered."""
    if max_pages:
        df = first_page(df, key, size=max_pages * page_size)
    numbered = number_rows(df, [key], number="_rn")
    return numbered.withColumn("page", page_of(F.col("_rn"), page_size)).drop("_rn")


def first_page(df: DataFrame, key: str, after: int | None = None, size: int = 50_000) -> DataFrame:
    """Rows with a key above ``after``, the ``size`` smallest."""
    rows = df if after is None else df.filter(F.col(key) > after)
    return rows.orderBy(key).limit(size)


def page_budget(df: DataFrame, page: str, max_pages: int = 0) -> DataFrame:
    """Rows of the first ``max_pages`` pages; 0 means all."""
    return df if max_pages == 0 else df.filter(F.col(page) < max_pages)


def progress(df: DataFrame, group_by: str, order_by: Sequence[str]) -> DataFrame:
    """Adds position ``i``, ``total`` and percent done within each list."""
    numbered = number_rows(df, order_by, [group_by], number="i", total="total")
    return numbered.withColumn("pct", F.col("i") * 100 / F.col("total"))
