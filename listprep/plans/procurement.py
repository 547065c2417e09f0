"""Contracts: listing pages → new links → contract rows → organisation data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listprep.functions import html as H
from listprep.functions.text import clean_strings
from listprep.operators import enrich, extract, membership
from listprep.operators import rules as machine
from listprep.operators.late import maybe_in

ORG_COLUMNS = ("legal_name", "headcount", "phone", "email", "revenue")


def new_links(listings: DataFrame, stored: DataFrame, cls: str, base: str, page: str = "page") -> DataFrame:
    """Links on listing pages (page, html) which are not stored yet, each once."""
    parsed = H.parse_html(listings.select(page, "html"), keep_tags=["div", "a"], keep_attrs=["href"])
    found = extract.container_links(parsed, page, cls=cls, base=base)
    return membership.append_new(found, stored, "link", [page, "pos"])


def contract_rows(
    pages: DataFrame,
    stored: DataFrame | None = None,
    key: str = "link",
    rules: DataFrame | Sequence[machine.Spec | extract.Rule] = extract.CONTRACT_RULES,
) -> DataFrame:
    """One cleaned row per contract page (key, html) that is not among the stored rows.

    New pages are found by their keys, and all but few others end at the scan; page texts are parsed where they were
    read, and only the rows made of them meet the stored keys."""
    pending = pages.select(key, "html")
    if stored is not None:
        fresh = membership.without_known(pages.select(key), stored, [key])
        pending = pending.filter(F.col(key).isNull() | maybe_in(F.col(key), fresh, key))
    rows = clean_strings(machine.read_fields(pending, key, rules=rules))
    return rows if stored is None else membership.without_known(rows, stored, [key])


def found_organisations(pages: DataFrame, inn: str = "inn") -> DataFrame:
    """Fields of organisation pages (inn, html) that show a record."""
    fields = extract.org_fields(H.parse_html(pages.select(inn, "html")), inn)
    return fields.filter(F.coalesce(*ORG_COLUMNS).isNotNull())


def enriched_contracts(rows: DataFrame, org_pages: DataFrame, key: str = "link", inn: str = "inn") -> DataFrame:
    """The first contract per tax id, with the organisation fields found put over it."""
    first = membership.first_rows(rows.filter(F.col(inn) != ""), [inn], [key])
    return enrich.overlay(first, found_organisations(org_pages, inn), inn, ORG_COLUMNS)
