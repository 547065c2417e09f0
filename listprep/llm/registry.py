"""Queries of this package, and what they share."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listprep.session import work_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# White space as the contracts have it: blank, tab to carriage return.
BLANKS = r"[\x20\x09-\x0D]+"


def query(name: str, sql: str | None = None):
    """Registers a query (spark, folder) -> frame, with the SQL that gives the same rows where there is one."""

    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written as Parquet below ``spark.checkpoint.dir`` and read again: what follows neither
    repeats the work nor depends on executors that made it."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def shipped(df: DataFrame) -> DataFrame:
    """The frame, after the modules that its Python stages import were handed to the executors: once per application,
    as a small archive in the shared folder."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parent.parent
        archive = io.BytesIO()
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
            for path in sorted(package.rglob("*.py")):
                z.writestr(f"{package.name}/{path.relative_to(package)}", path.read_bytes())
        target = f"{work_dir(spark, package.name)}.zip"
        place = context._jvm.org.apache.hadoop.fs.Path(target)
        out = place.getFileSystem(context._jsc.hadoopConfiguration()).create(place)
        out.write(bytearray(archive.getvalue()))
        out.close()
        context.addPyFile(target)
        _SHIPPED.add(context.applicationId)
    return df


# Rows of narrow columns (below 100 bytes) up to which a side is broadcast: at most 20 MB.
BROADCAST_ROWS = 200_000


def narrow(df: DataFrame) -> DataFrame:
    """A stored table of a few narrow columns, to be broadcast where its count shows that it is small; otherwise it is
    joined by a shuffle. Either way the rows of the join are the same."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def whole(text: Column) -> Column:
    """The text, null as empty."""
    return F.coalesce(text.cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """All runs of characters that are no white space, in order."""
    return F.filter(F.split(whole(text), BLANKS), lambda w: w != "")


def key(c: Column) -> Column:
    """A value as a join key that is never null and keeps null apart from every value."""
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))


def unused(name: str, *taken: str) -> str:
    """The name, with as many underscores as make it none of those taken."""
    known = {t.lower() for t in taken}
    while name.lower() in known:
        name += "_"
    return name


def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)
