"""Filters and project selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listprep.functions import urls
from listprep.functions.text import strip_ws
from listprep.operators.joins import drop_known, keep_known


def price_floor_page(
    df: DataFrame, price: str, newest: str, key: str, floor: float = 1_000_000_000, page: int = 1, per_page: int = 50
) -> DataFrame:
    """One page of rows at or above a price, newest first; ``key`` breaks ties."""
    return (
        df.filter(F.col(price) >= floor)
        .orderBy(F.desc(newest), F.asc(key))
        .offset((page - 1) * per_page)
        .limit(per_page)
    )


def video_links(df: DataFrame, href: str = "href", in_playlist: bool = True) -> DataFrame:
    """Rows whose link is a video (of a playlist)."""
    keep = F.col(href).isNotNull() & F.col(href).contains("/watch?v=")
    if in_playlist:
        keep = keep & F.col(href).contains("&list=")
    return df.filter(keep)


def include_paths(df: DataFrame, path: str, patterns: Sequence[str]) -> DataFrame:
    """Rows whose path matches one of the patterns; ``*`` crosses ``/``."""
    return df.filter(urls.any_glob(F.col(path), patterns))


def select_projects(
    files: DataFrame,
    project: str,
    size: str,
    allow: DataFrame | None = None,
    block: DataFrame | None = None,
    max_size: int | None = None,
) -> DataFrame:
    """Projects with their total size after allow list, block list and size limit.  All three are
    optional; without them every project passes."""
    if allow is not None:
        files = keep_known(files, allow, [project])
    if block is not None:
        files = drop_known(files, block, [project])
    totals = files.groupBy(project).agg(F.sum(size).alias("total_size"))
    return totals if max_size is None else totals.filter(F.col("total_size") <= max_size)


def lock_names(lines: DataFrame, line: str = "line", mode: str = "as_written") -> DataFrame:
    """First word of dependency lines of a lock file.

    ``as_written``: blanks are cut before the test, so only lines starting with ``*`` and without
    ``)`` pass, and ``* name`` gives ``*``.  ``indented``: lines starting with two spaces or ``*``
    give their name.
    """
    bare = strip_ws(F.col(line))
    open_line = ~F.col(line).contains(")")
    if mode == "as_written":
        return lines.filter(bare.startswith("*") & open_line).withColumn("name", F.get(F.split(bare, " "), F.lit(0)))
    if mode == "indented":
        name = F.regexp_extract(bare, r"^\*? *([^ ]+)", 1)
        return lines.filter((F.col(line).startswith("  ") | F.col(line).startswith("*")) & open_line).withColumn(
            "name", name
        )
    raise ValueError(f"unknown mode {mode!r}")


def artifacts_from_docs(docs: DataFrame, group: Column, artifact: Column, version: Column) -> DataFrame:
    """Short index fields as artifact columns."""
    return docs.select(
        group.alias("group_id"), artifact.alias("artifact_id"), version.alias("latest_version")
    )
