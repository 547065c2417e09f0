"""Records out of parsed pages.  Every function takes a frame with a ``dom`` column (``parse_html``)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listprep.functions import html as H
from listprep.functions import text, urls, versions

DOM = "dom"


def _dom() -> Column:
    return F.col(DOM)


def _nodes() -> Column:
    return F.col(DOM)["nodes"]


# --- links ---------------------------------------------------------------------------------------


def anchors(df: DataFrame, *keep: str, inside: str | None = None) -> DataFrame:
    """Every ``a[href]`` (inside the first element of a tag), one row each: keep, pos, href, label."""
    dom = _dom()

    def rows(nodes: Column) -> Column:
        return F.transform(
            H.find_all(nodes, tag="a", attrs=["href"]),
            lambda a: F.struct(a["pos"].alias("pos"), H.attr(a, "href").alias("href"), H.tight(dom, a).alias("label")),
        )

    if inside is None:
        found = rows(dom["nodes"])
    else:
        found = H.let(H.find(dom["nodes"], tag=inside), lambda box: rows(H.below(dom, box)))
    return df.select(*keep, F.inline(found))


def container_links(df: DataFrame, *keep: str, cls: str, base: str, tag: str = "div") -> DataFrame:
    """The first link of each container of a class, with the site address put in front."""
    dom = _dom()
    found = F.transform(
        H.find_all(dom["nodes"], tag=tag, cls=cls),
        lambda box: F.struct(
            box["pos"].alias("pos"), H.attr(H.find(H.below(dom, box), tag="a"), "href").alias("href")
        ),
    )
    return (
        df.select(*keep, F.inline(found))
        .filter(F.col("href").isNotNull())
        .select(*keep, "pos", F.concat(F.lit(base), F.col("href")).alias("link"))
    )


# Ids and classes of listing pages.
CONTENT_ID = "mw-content-text"
MEMBERS_CLASS = "category-page__members"
WRAPPER_CLASS = "category-page__members-wrapper"
MEMBER_LIST_CLASS = "category-page__members-for-char"
MEMBER_CLASS = "category-page__member"
ALL_PAGES_CLASS = "mw-allpages-body"
NEXT_NAV_CLASS = "mw-allpages-nav"
NEXT_LABELS = ("Следующая страница", "Next page")


def _content_child(cls: str) -> Column:
    """The first div of a class that is a direct child of the content element."""
    nodes = _nodes()

    def direct(node: Column) -> Column:
        parent = F.get(nodes, node["parent"])
        return H.matches(tag="div", cls=cls)(node) & F.coalesce(parent["id"] == CONTENT_ID, F.lit(False))

    return F.get(F.filter(nodes, direct), F.lit(0))


def _titled_link(dom: Column, item: Column) -> Column:
    return H.let(
        H.find(H.below(dom, item), tag="a", attrs=["href", "title"]),
        lambda a: F.struct(
            a["pos"].alias("pos"), text.strip_ws(H.attr(a, "title")).alias("title"), H.attr(a, "href").alias("href")
        ),
    )


def _titled_rows(df: DataFrame, keep: Sequence[str], links: Column, base: str) -> DataFrame:
    return (
        df.select(*keep, F.inline(links))
        .filter(F.col("href").isNotNull())
        .select(*keep, "pos", "title", urls.absolute_url(F.lit(base), F.col("href")).alias("url"))
    )


def category_members(df: DataFrame, *keep: str, base: str) -> DataFrame:
    """Members of a category page: pos, title, url."""
    dom = _dom()

    def of_wrapper(wrapper: Column) -> Column:
        return H.let(
            H.find(H.below(dom, wrapper), tag="ul", cls=MEMBER_LIST_CLASS),
            lambda ul: F.transform(
                H.find_all(H.below(dom, ul), tag="li", cls=MEMBER_CLASS), lambda li: _titled_link(dom, li)
            ),
        )

    lists = H.let(
        _content_child(MEMBERS_CLASS),
        lambda box: F.transform(H.find_all(H.below(dom, box), tag="div", cls=WRAPPER_CLASS), of_wrapper),
    )
    links = F.flatten(F.filter(lists, lambda part: part.isNotNull()))
    return _titled_rows(df, keep, links, base)


def all_pages_links(df: DataFrame, *keep: str, base: str) -> DataFrame:
    """Items of an all-pages listing: pos, title, url."""
    dom = _dom()
    links = H.let(
        _content_child(ALL_PAGES_CLASS),
        lambda box: F.transform(H.find_all(H.below(dom, box), tag="li"), lambda li: _titled_link(dom, li)),
    )
    return _titled_rows(df, keep, links, base)


def next_page_url(base: str) -> Column:
    """Address of the next listing page, ``''`` when there is none."""
    dom = _dom()

    def by_label(nav: Column, label: str) -> Column:
        hit = F.filter(
            H.below(dom, nav),
            lambda a: (a["tag"] == "a") & F.coalesce(H.sole_text(dom, a).contains(label), F.lit(False)),
        )
        return F.get(hit, F.lit(0))

    link = H.let(
        H.find(dom["nodes"], tag="div", cls=NEXT_NAV_CLASS), lambda nav: F.coalesce(*[by_label(nav, t) for t in NEXT_LABELS])
    )
    href = F.nullif(H.attr(link, "href"), F.lit(""))
    return F.coalesce(urls.absolute_url(F.lit(base), href), F.lit(""))


# --- rules ---------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Chain:
    """The n-th descendant (1-based) with tag and class at each step; its text, blanks collapsed."""

    name: str
    steps: tuple[tuple[int, str, str | None], ...]


@dataclass(frozen=True)
class Labelled:
    """In the first section of a class: the span with exactly this text; the text of the next span."""

    name: str
    label: str
    section: str = "section blockInfo__section"


@dataclass(frozen=True)
class TableColumn:
    """The column of the first table of a class whose header contains a text; cells joined by `` | ``."""

    name: str
    header: str
    table: str


Rule = Chain | Labelled | TableColumn

# The rules for contract cards.
CONTRACT_RULES: tuple[Rule, ...] = (
    Chain("items", ((1, "span", "text-break d-block"),)),
    Chain(
        "price",
        (
            (1, "div", "sectionMainInfo borderRight col-3 colSpaceBetween"),
            (1, "div", "price"),
            (1, "span", "cardMainInfo__content cost"),
        ),
    ),
    Labelled("inn", "ИНН:"),
    TableColumn("address", "Адрес места нахождения", "blockInfo__table tableBlock grayBorderBottom"),
    TableColumn("contacts", "Телефон, электронная почта", "blockInfo__table tableBlock grayBorderBottom"),
)


def chain_text(rule: Chain) -> Column:
    dom = _dom()

    def step(nodes: Column, steps: Sequence[tuple[int, str, str | None]]) -> Column:
        (number, tag, cls), rest = steps[0], steps[1:]
        node = H.find(nodes, number - 1, tag=tag, cls=cls or None)
        if rest:
            return H.let(node, lambda n: step(H.below(dom, n), rest))
        return H.let(node, lambda n: text.collapse_ws(H.raw(dom, n)))

    return step(dom["nodes"], rule.steps)


def labelled_text(rule: Labelled) -> Column:
    dom = _dom()

    def in_section(section: Column) -> Column:
        label = F.filter(
            H.below(dom, section), lambda n: (n["tag"] == "span") & F.coalesce(H.sole_text(dom, n) == rule.label, F.lit(False))
        )
        return H.let(F.get(label, F.lit(0)), _next_text("span"))

    return H.let(H.find(dom["nodes"], tag="section", cls=rule.section), in_section)


def _next_text(tag: str):
    """Text of the next element of a tag in document order (children of the node come first)."""
    dom = _dom()

    def after(node: Column) -> Column:
        rest = F.slice(dom["nodes"], node["pos"] + 2, F.size(dom["nodes"]))
        return H.let(H.find(rest, tag=tag), lambda n: H.stripped(dom, n))

    return after


def table_column_text(rule: TableColumn) -> Column:
    dom = _dom()

    def of_table(table: Column) -> Column:
        titles = F.transform(H.find_all(H.below(dom, table), tag="th"), lambda th: H.raw(dom, th).contains(rule.header))
        at = F.array_position(titles, True)
        body = H.find(H.below(dom, table), tag="tbody")

        def cells(column: Column) -> Column:
            rows = H.let(body, lambda b: H.find_all(H.below(dom, b), tag="tr"))
            taken = F.transform(rows, lambda tr: F.get(H.find_all(H.below(dom, tr), tag="td"), column - 1))
            taken = F.filter(taken, lambda td: td.isNotNull())
            return text.collapse_ws(F.array_join(F.transform(taken, lambda td: H.stripped(dom, td)), " | "))

        return H.let(at.cast("int"), lambda column: F.when(column > 0, cells(column)))

    return H.let(H.find(dom["nodes"], tag="table", cls=rule.table), of_table)


def rule_text(rule: Rule) -> Column:
    kinds = {Chain: chain_text, Labelled: labelled_text, TableColumn: table_column_text}
    return kinds[type(rule)](rule)


def extract_rules(df: DataFrame, *keep: str, rules: Sequence[Rule] = CONTRACT_RULES) -> DataFrame:
    """One string column per rule; a field not found is ``''``.  One pass over the page."""
    return df.select(*keep, *[F.coalesce(rule_text(r), F.lit("")).alias(r.name) for r in rules])


# --- organisation pages --------------------------------------------------------------------------

# Classes and labels of organisation pages.
ORG_TABLE_CLASS = "table table-sm"
ORG_NAME_LABEL = "Полное юридическое наименование:"
ORG_STAFF_LABEL = "Численность персонала:"
ORG_PHONE_CLASS = "clipboards nwra"
ORG_EMAIL_CLASS = "wwbw"
ORG_REVENUE_LABEL = "Выручка"
CAPTCHA_CLASS = "g-recaptcha"
ORG_LIST_CLASS = "org_list"


def two_cell_rows(table_cls: str = ORG_TABLE_CLASS) -> Column:
    """Rows of exactly two cells of the first table of a class, as (label, value) in page order."""
    dom = _dom()

    def pair(cells: Column) -> Column:
        return F.when(
            F.size(cells) == 2,
            F.struct(
                H.stripped(dom, F.get(cells, F.lit(0))).alias("label"),
                H.stripped(dom, F.get(cells, F.lit(1))).alias("value"),
            ),
        )

    rows = H.let(H.find(dom["nodes"], tag="table", cls=table_cls), lambda t: H.find_all(H.below(dom, t), tag="tr"))
    pairs = F.transform(rows, lambda tr: H.let(H.find_all(H.below(dom, tr), tag="td"), pair))
    return F.filter(pairs, lambda p: p.isNotNull())


def labelled_value(pairs: Column, label: str, unless: str | None = None) -> Column:
    """Value of the last row whose label contains a text."""

    def wanted(p: Column) -> Column:
        test = p["label"].contains(label)
        return test if unless is None else test & ~p["label"].contains(unless)

    return F.try_element_at(F.filter(pairs, wanted), F.lit(-1))["value"]


def org_fields(df: DataFrame, *keep: str) -> DataFrame:
    """Legal name, headcount, phone, e-mail and revenue; a field not on the page is NULL."""
    dom, pairs = _dom(), F.col("_pairs")
    phone = H.let(
        H.find(dom["nodes"], tag="a", cls=ORG_PHONE_CLASS),
        lambda a: H.let(H.find(H.below(dom, a), tag="span"), lambda s: H.stripped(dom, s)),
    )
    email = H.let(H.find(dom["nodes"], tag="a", cls=ORG_EMAIL_CLASS), lambda a: H.stripped(dom, a))
    revenue_cell = F.filter(
        dom["nodes"], lambda n: (n["tag"] == "td") & F.coalesce(H.sole_text(dom, n) == ORG_REVENUE_LABEL, F.lit(False))
    )
    return df.withColumn("_pairs", two_cell_rows()).select(
        *keep,
        labelled_value(pairs, ORG_NAME_LABEL).alias("legal_name"),
        labelled_value(pairs, ORG_STAFF_LABEL, unless=ORG_NAME_LABEL).alias("headcount"),
        phone.alias("phone"),
        email.alias("email"),
        H.let(F.get(revenue_cell, F.lit(0)), _next_text("td")).alias("revenue"),
    )


def _first_hit_link() -> Column:
    """``p label a`` of the result list, taking the first of each."""
    dom = _dom()

    def go(node: Column, tags: Sequence[str]) -> Column:
        if not tags:
            return H.attr(node, "href")
        return H.let(H.find(H.below(dom, node), tag=tags[0]), lambda n: go(n, tags[1:]))

    return H.let(H.find(dom["nodes"], tag="div", cls=ORG_LIST_CLASS), lambda box: go(box, ["p", "label", "a"]))


def page_kind(df: DataFrame, *keep: str, base: str = "") -> DataFrame:
    """captcha, hits (with the address of the first one), record or empty."""
    nodes = _nodes()
    link = _first_hit_link()
    kind = (
        F.when(F.exists(nodes, H.matches(tag="div", cls=CAPTCHA_CLASS)), "captcha")
        .when(F.col("_hit").isNotNull(), "hits")
        .when(F.exists(nodes, H.matches(tag="table", cls=ORG_TABLE_CLASS)), "record")
        .otherwise("empty")
    )
    return df.withColumn("_hit", link).select(
        *keep,
        kind.alias("kind"),
        F.when(kind == "hits", F.concat(F.lit(base), F.col("_hit"))).alias("hit_url"),
    )


# --- directory listings --------------------------------------------------------------------------


def listing_versions(df: DataFrame, *keep: str) -> DataFrame:
    """Version folders of a directory listing: anchor text without slashes at the ends, numbers and dots only."""
    dom = _dom()
    names = F.transform(
        H.find_all(dom["nodes"], tag="a"), lambda a: F.regexp_replace(H.raw(dom, a), r"^/+|/+\z", "")
    )
    return df.select(*keep, F.explode(F.filter(names, versions.is_numeric)).alias("version"))
