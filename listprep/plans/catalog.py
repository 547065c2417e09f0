"""Wiki catalog: listing pages → link list → pending pages → records → reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listprep.functions import html as H
from listprep.operators import extract, membership, numbering, reconcile, wiki
from listprep.operators.joins import join_stored
from listprep.operators.late import maybe_in
from listprep.session import checkpointed
from listprep.sinks import writers


def listed_links(pages: DataFrame, base: str, kind: str = "all", page: str = "page", max_pages: int = 0) -> DataFrame:
    """(page, pos, title, url) of category pages (``category``) or all-pages listings (``all``)."""
    readers = {"all": extract.all_pages_links, "category": extract.category_members}
    parsed = H.parse_html(
        numbering.page_budget(pages, page, max_pages).select(page, "html"), keep_attrs=["href", "title"]
    )
    return readers[kind](parsed, page, base=base)


def listing_job(
    pages: DataFrame,
    base: str,
    path: str,
    kind: str = "all",
    page: str = "page",
    start: int = 0,
    max_pages: int = 0,
    mode: str = "continue",
) -> str:
    """Reads listing pages from page ``start`` on, at most ``max_pages`` of them (0: all), and saves their links in one
    of the save modes (see ``save_list``).  Returns the folder; the next run starts at ``next_start``."""
    wanted = membership.start_offset(pages, page, start)
    links = listed_links(wanted, base, kind, page, start + max_pages if max_pages else 0)
    return writers.save_list(links.select(page, "pos", "title", "url"), path, mode)


def next_start(stored: DataFrame, page: str = "page") -> Column:
    """The first page after those of a saved list, as a scalar."""
    return stored.agg(F.coalesce(F.max(page) + 1, F.lit(0))).scalar()


def pending_records(links: DataFrame, outputs: DataFrame, pages: DataFrame) -> DataFrame:
    """Records of the listed pages that have no good output yet.

    links: list, pos, title, url.  outputs: list, safe_name, has_error.  pages: url, html.  The pending links, without
    texts, are stored when this is called.
    Only the pages of pending links (and few others) are parsed, where they were read; the records made of them meet
    the links by their address."""
    pending = membership.pending_or_failed(links, outputs).select("list", "pos", F.col("title").alias("list_title"), "url")
    # looked at four times: its size in rows and in bytes, its bits, and the join
    pending = checkpointed(pending)
    todo = pages.select("url", "html").filter(maybe_in(F.col("url"), pending, "url"))
    records = wiki.page_records(H.parse_html(todo, keep_html=True), "url")
    both = join_stored(records, pending, ["url"]).withColumn("title", F.coalesce("list_title", "title"))
    return both.select("list", "pos", *records.columns)


def catalog_report(links: DataFrame, outputs: DataFrame) -> DataFrame:
    """Expected and stored records per list and in total."""
    return reconcile.reconcile(links.select("list"), outputs.select("list"))
