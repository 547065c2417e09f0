"""Wiki page records: info box, sections, main text, categories and titles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listprep.functions import html as H
from listprep.functions import text

# The main block, given as the chain of its parents, and its two fallbacks.
MAIN_PATH = (
    ("body", None),
    ("div", "main-container"),
    ("div", "resizable-container"),
    ("div", "page has-right-rail"),
    ("main", None),
)
MAIN_CLASS = "page__main"
CONTENT_DIV_ID = "content"
# Classes and words of page parts.
HEADING_ID = "firstHeading"
HEADER_CLASS = "page-header__title"
GALLERY_WORD = "Gallery"
GALLERY_CLASS = "wikia-gallery"
INFOBOX_CLASS = "portable-infobox"
CATEGORY_PATHS = ("/wiki/Категория:", "/wiki/Category:")
SECTION_TAGS = ("h2", "h3", "h4")
PLAIN_DIV_CLASSES = ("mw-collapsible-content", "marvel_database_section", "pi-smart-group-body")
# Texts put in front of parts, and texts of special records.
IMAGE_PREFIX = "Изображение: "
TABLE_PREFIX = "Таблица:\n"
QUOTE_PREFIX = "Цитата: "
CODE_PREFIX = "Код/Преформатированный текст: "
COLLAPSED_PREFIX = "[Раскрывающийся контент]: "
CAPTION_PREFIX = "[Изображение]: "
NO_MAIN = "Main content not found"
GALLERY_TEXT = "This is a gallery page with images"
GALLERY_SECTION = "Image gallery content"

# Section titles and the info box keys that answer them, first found wins.
FIELD_ALIASES = {
    "name": ("name", "title"),
    "current alias": ("currentalias", "alias"),
    "gender": ("gender",),
    "date of birth": ("dateofbirth", "birth"),
    "living status": ("status", "livingstatus"),
    "identity": ("identity",),
    "citizenship": ("citizenship",),
    "occupation": ("occupation",),
    "marital status": ("maritalstatus",),
    "eyes": ("eyes",),
    "hair": ("hair",),
    "reality": ("reality",),
    "origin": ("origin",),
    "first work": ("first", "firstwork"),
    "employers": ("employers",),
    "titles": ("titles",),
}

DOM = "dom"


def _dom() -> Column:
    return F.col(DOM)


def _last_wins(entries: Column) -> Column:
    """(key, value) entries to a map; a later entry replaces an earlier one of the same key."""
    return F.map_from_entries(
        F.filter(
            entries,
            lambda e, i: ~F.exists(
                F.slice(entries, i + 2, F.size(entries)), lambda later: later["key"] == e["key"]
            ),
        )
    )


# --- blocks --------------------------------------------------------------------------------------


def main_node() -> Column:
    """The main block: by parent chain, else by class, else by id."""
    nodes = _dom()["nodes"]

    def on_path(node: Column, path: Sequence[tuple[str, str | None]]) -> Column:
        tag, cls = path[-1]
        here = node["tag"] == tag
        for word in (cls or "").split():
            here = here & H.has_class(node, word)
        if len(path) == 1:
            return here
        return here & F.coalesce(on_path(F.get(nodes, node["parent"]), path[:-1]), F.lit(False))

    return F.coalesce(
        F.get(F.filter(nodes, lambda n: on_path(n, MAIN_PATH)), F.lit(0)),
        H.find(nodes, tag="main", cls=MAIN_CLASS),
        H.find(nodes, tag="div", id=CONTENT_DIV_ID),
    )


def page_title() -> Column:
    """Heading by id, else by class; NULL when there is none."""
    dom = _dom()
    heading = F.coalesce(
        H.find(dom["nodes"], tag="h1", id=HEADING_ID), H.find(dom["nodes"], tag="h1", cls=HEADER_CLASS)
    )
    return H.let(heading, lambda h: H.tight(dom, h))


def with_main(df: DataFrame) -> DataFrame:
    """Adds ``main`` (node), ``page_title`` and ``kind``: page, gallery or error."""
    nodes = _dom()["nodes"]
    gallery = F.coalesce(F.col("page_title"), F.lit("Unknown")).contains(GALLERY_WORD) & F.exists(
        nodes, H.matches(tag="div", cls=GALLERY_CLASS)
    )
    return (
        df.withColumn("main", main_node())
        .withColumn("page_title", page_title())
        .withColumn("kind", F.when(F.col("main").isNotNull(), "page").when(gallery, "gallery").otherwise("error"))
    )


# How much of a page the usual records hold.  Every limit is a parameter; None takes all.
SNIPPET_CHARS, REFERENCES, PARAGRAPHS = 500, 10, 15


def snippet(html: str = "html", length: int | None = None) -> Column:
    """The first characters of the body source (None: all), kept with error records; ``None`` as text without a body."""
    body = H.find(_dom()["nodes"], tag="body")

    def cut(b: Column) -> Column:
        markup = H.markup(F.col(html), b)
        return markup if length is None else F.left(markup, F.lit(length))

    return F.coalesce(H.let(body, cut), F.lit("None"))


# --- info box ------------------------------------------------------------------------------------


def infobox() -> Column:
    """Info box of ``main`` as a map: title and image, then every item with a data source."""
    dom = _dom()

    def entry(key: Column, value: Column) -> Column:
        return F.struct(key.alias("key"), value.alias("value"))

    def of_item(item: Column) -> Column:
        source = H.attr(item, "data-source")
        inner = H.below(dom, item)
        label = H.let(H.find(inner, tag="h3", cls="pi-data-label"), lambda n: H.tight(dom, n))
        value = H.let(H.find(inner, tag="div", cls="pi-data-value"), lambda n: H.tight(dom, n))
        whole = F.nullif(H.tight(dom, item), F.lit(""))
        key = F.when(label.isNotNull() & value.isNotNull(), F.regexp_replace(label, r":+\z", "")).otherwise(
            text.split_camel(source)
        )
        return F.when(~source.isin("Title", "Image"), entry(key, F.coalesce(value, whole)))

    def of_box(box: Column) -> Column:
        inner = H.below(dom, box)
        title = H.let(
            H.find(inner, tag="h2", cls="pi-item pi-title"), lambda n: entry(F.lit("name"), H.tight(dom, n))
        )
        image = H.let(
            H.find(inner, tag="figure", cls="pi-item pi-image"),
            lambda fig: entry(
                F.lit("image"), F.nullif(H.attr(H.find(H.below(dom, fig), tag="img"), "src"), F.lit(""))
            ),
        )
        items = F.transform(H.find_all(inner, attrs=["data-source"]), of_item)
        kept = F.filter(F.concat(F.array(title, image), items), lambda e: e["value"].isNotNull())
        return H.let(kept, _last_wins)

    empty = F.map_from_entries(F.array().cast("array<struct<key:string,value:string>>"))
    return F.coalesce(
        H.let(H.find(H.below(dom, F.col("main")), tag="aside", cls=INFOBOX_CLASS), of_box), empty
    )


def lower_keys(box: Column) -> Column:
    """Info box with lower-case keys, the last of equal keys kept."""
    entries = F.transform(
        F.map_entries(box), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value"))
    )
    return H.let(entries, _last_wins)


def alias_value(box: Column, title: Column) -> Column:
    """Info box value for a section title: by the alias list, else by the title itself as a key.

    ``box`` has lower-case keys; the title is lower-cased here."""
    key = F.lower(title)
    result = F.lit(None).cast("string")
    for shown, names in FIELD_ALIASES.items():
        by_alias = F.coalesce(*[F.try_element_at(box, F.lit(n)) for n in names])
        result = F.when(key == shown, by_alias).otherwise(result)
    return F.coalesce(result, F.try_element_at(box, key))


# --- sections ------------------------------------------------------------------------------------


def _texts(nodes: Column) -> Column:
    dom = _dom()
    return F.transform(nodes, lambda n: H.tight(dom, n))


def _not_empty(parts: Column) -> Column:
    return F.filter(parts, lambda p: p.isNotNull() & (p != ""))


def _part(node: Column) -> Column:
    """Text parts a sibling adds to its section, by its tag."""
    dom = _dom()
    tag, own = node["tag"], H.tight(dom, node)
    inner = H.below(dom, node)

    def one(value: Column, prefix: str = "") -> Column:
        return F.when(value != "", F.array(F.concat(F.lit(prefix), value)))

    def table_rows() -> Column:
        rows = F.transform(
            H.find_all(inner, tag="tr"), lambda tr: _texts(H.find_all(H.below(dom, tr), tag=["td", "th"]))
        )
        lines = F.transform(F.filter(rows, lambda r: F.size(r) > 0), lambda r: F.array_join(r, " | "))
        return H.let(lines, lambda ls: F.when(F.size(ls) > 0, F.array(F.concat(F.lit(TABLE_PREFIX), F.array_join(ls, "\n")))))

    def definitions() -> Column:
        def of_term(dt: Column) -> Column:
            dd = F.filter(
                F.slice(dom["nodes"], dt["pos"] + 2, F.get(dom["nodes"], dt["parent"])["end"] - dt["pos"]),
                lambda n: (n["tag"] == "dd") & (n["parent"] == dt["parent"]),
            )
            return H.let(F.get(dd, F.lit(0)), lambda d: F.concat(H.tight(dom, dt), F.lit(": "), H.tight(dom, d)))

        return F.filter(F.transform(H.find_all(inner, tag="dt"), of_term), lambda t: t.isNotNull())

    plain_div = F.lit(False)
    for cls in PLAIN_DIV_CLASSES:
        plain_div = plain_div | H.has_class(node, cls)
    div = (
        F.when(plain_div, one(own))
        .when(H.has_class(node, "thumbcaption"), one(own, IMAGE_PREFIX))
        .when(F.length(own) > 10, F.array(own))
    )
    headline = H.has_class(node, "mw-page-title-main") | H.has_class(node, "mw-headline")
    caption = H.let(H.find(inner, tag="figcaption"), lambda c: one(H.tight(dom, c), IMAGE_PREFIX))
    return (
        F.when(tag == "p", one(own))
        .when(tag.isin("ul", "ol"), _texts(H.find_all(inner, tag="li")))
        .when(tag == "div", div)
        .when(tag == "table", table_rows())
        .when(tag == "blockquote", one(own, QUOTE_PREFIX))
        .when(tag == "dl", definitions())
        .when(tag == "pre", one(own, CODE_PREFIX))
        .when(tag == "figure", caption)
        .when((tag == "span") & headline, one(own))
    )


def _following(node: Column) -> Column:
    """Later siblings of a node."""
    nodes = _dom()["nodes"]
    rest = F.slice(nodes, node["pos"] + 2, F.get(nodes, node["parent"])["end"] - node["pos"])
    return F.filter(rest, lambda n: n["parent"] == node["parent"])


def _regular_parts(head: Column, stop: Column) -> Column:
    """Parts of the siblings before ``stop``, the next heading sibling."""
    nodes = _dom()["nodes"]
    between = F.slice(nodes, head["pos"] + 2, F.greatest(stop - head["pos"] - 1, F.lit(0)))
    own = F.filter(between, lambda n: n["parent"] == head["parent"])
    return F.flatten(F.filter(F.transform(own, _part), lambda p: p.isNotNull()))


def _with_stops(heads: Column) -> Column:
    """Each heading with the position of the next one under the same parent, or the end of the parent.

    So the slices of all sections together are as long as the page."""
    nodes = _dom()["nodes"]

    def stop(h: Column, i: Column) -> Column:
        later = F.filter(F.slice(heads, i + 2, F.size(heads)), lambda x: x["parent"] == h["parent"])
        return F.coalesce(F.get(later, F.lit(0))["pos"], F.get(nodes, h["parent"])["end"] + 1)

    return F.transform(heads, lambda h, i: F.struct(h.alias("head"), stop(h, i).alias("stop")))


def _contents_parts(head: Column) -> Column:
    dom = _dom()
    siblings = _following(head)
    box = F.coalesce(
        H.find(siblings, tag="ul"),
        H.find(siblings, tag="div", cls="toc"),
        H.find(H.below(dom, F.col("main")), tag="div", cls="toc"),
    )
    labels = H.let(box, lambda b: _texts(H.find_all(H.below(dom, b), tag="a")))
    return F.filter(labels, lambda t: (F.length(t) > 2) & ~t.startswith("["))


def _first_parts(head: Column) -> Column:
    dom = _dom()
    nodes = dom["nodes"]
    groups = F.filter(
        F.slice(nodes, F.lit(1), head["pos"]),
        lambda n: (n["tag"] == "section") & H.has_class(n, "pi-smart-group") & (n["end"] >= head["pos"]),
    )
    value = F.coalesce(
        H.find(_following(head), tag="div", cls="pi-smart-data-value"),
        H.let(
            F.try_element_at(groups, F.lit(-1)),
            lambda g: H.find(H.below(dom, g), tag="div", cls="pi-smart-data-value"),
        ),
    )
    return H.let(value, lambda v: _not_empty(F.array(H.tight(dom, v))))


def _reference_parts(head: Column, limit: int | None) -> Column:
    dom = _dom()
    box = H.find(_following(head), tag="div", cls="mw-references-wrap")
    items = H.let(box, lambda b: _texts(H.find_all(H.below(dom, b), tag="span", cls="reference-text")))
    return _not_empty(items) if limit is None else F.slice(_not_empty(items), 1, limit)


def sections(references: int | None = None) -> Column:
    """Sections of ``main``: level, title and content; the first of equal titles is kept.

    ``references`` limits the entries of reference sections (None: all).

    Needs the columns ``main`` and ``infobox``.  All slices are page-local, so nothing is shuffled."""
    dom = _dom()
    box = lower_keys(F.col("infobox"))

    def section(placed: Column, lookup: Column) -> Column:
        head = placed["head"]
        title = H.tight(dom, head)
        name = F.lower(title)
        parts = (
            F.when(name == "contents", _contents_parts(head))
            .when(name == "first", _first_parts(head))
            .when(name.contains("links") | name.contains("references"), _reference_parts(head, references))
            .otherwise(_regular_parts(head, placed["stop"]))
        )
        known = F.filter(F.array(alias_value(lookup, title)), lambda v: v.isNotNull())
        none = F.array().cast("array<string>")
        return F.struct(
            F.substring(head["tag"], 2, 1).cast("int").alias("level"),
            title.alias("title"),
            F.array_join(F.concat(known, F.coalesce(parts, none)), "\n").alias("content"),
        )

    def first_titles(titles: Column, placed: Column) -> Column:
        return F.filter(placed, lambda p, i: F.array_position(titles, F.get(titles, i)) == i + 1)

    heads = H.find_all(H.below(dom, F.col("main")), tag=list(SECTION_TAGS))
    kept = H.let(heads, lambda hs: H.let(_texts(hs), lambda titles: first_titles(titles, _with_stops(hs))))
    return H.let(box, lambda lookup: F.transform(kept, lambda p: section(p, lookup)))


# --- main text, categories -----------------------------------------------------------------------


def main_text(max_paragraphs: int | None = None) -> Column:
    """Marked blocks, else the first paragraphs (None: all); then collapsed blocks and captions."""
    dom = _dom()

    def of_main(inner: Column) -> Column:
        marked = _not_empty(_texts(H.find_all(inner, tag="div", cls="marvel_database_section")))
        paragraphs = H.find_all(inner, tag="p")
        if max_paragraphs is not None:
            paragraphs = F.slice(paragraphs, 1, max_paragraphs)
        plain = F.filter(_texts(paragraphs), lambda t: F.length(t) > 10)
        collapsed = F.transform(
            F.filter(_texts(H.find_all(inner, tag="div", cls="mw-collapsible-content")), lambda t: F.length(t) > 20),
            lambda t: F.concat(F.lit(COLLAPSED_PREFIX), t),
        )
        captions = F.transform(
            H.find_all(inner, tag="figure", cls="thumb"),
            lambda fig: H.let(H.find(H.below(dom, fig), tag="figcaption"), lambda c: H.tight(dom, c)),
        )
        captions = F.transform(_not_empty(captions), lambda t: F.concat(F.lit(CAPTION_PREFIX), t))
        lead = H.let(marked, lambda m: F.when(F.size(m) > 0, m).otherwise(plain))
        return F.array_join(F.concat(lead, collapsed, captions), "\n")

    return H.let(H.below(dom, F.col("main")), of_main)


def categories() -> Column:
    """Distinct category labels of the whole page, sorted."""
    dom = _dom()

    def is_category(node: Column) -> Column:
        href = H.attr(node, "href")
        hit = href.contains(CATEGORY_PATHS[0]) | href.contains(CATEGORY_PATHS[1])
        return (node["tag"] == "a") & F.coalesce(hit, F.lit(False))

    return F.array_sort(F.array_distinct(_not_empty(_texts(F.filter(dom["nodes"], is_category)))))


def page_records(
    df: DataFrame,
    *keep: str,
    html: str = "html",
    references: int | None = None,
    paragraphs: int | None = None,
    snippet_chars: int | None = None,
) -> DataFrame:
    """Full page records from a frame with ``dom`` and the source text: good, gallery and error pages in one schema.

    The limits take all by default; ``REFERENCES``, ``PARAGRAPHS`` and ``SNIPPET_CHARS`` are the usual ones."""
    framed = with_main(df).withColumn("infobox", infobox())
    page, gallery = F.col("kind") == "page", F.col("kind") == "gallery"
    gallery_sections = F.array(
        F.struct(F.lit(2).alias("level"), F.lit("Gallery").alias("title"), F.lit(GALLERY_SECTION).alias("content"))
    )
    source = F.when(page, H.markup(F.col(html), F.col("main"))).when(gallery, snippet(html, snippet_chars))
    return framed.select(
        *keep,
        F.coalesce("page_title", F.lit("")).alias("title"),
        F.when(page, main_text(paragraphs)).when(gallery, F.lit(GALLERY_TEXT)).alias("main_content"),
        F.when(page, sections(references)).when(gallery, gallery_sections).alias("sections"),
        F.when(page | gallery, F.col("infobox")).alias("infobox"),
        F.when(page, categories()).when(gallery, F.array(F.lit("Gallery"))).alias("categories"),
        source.alias("raw_html"),
        F.when(F.col("kind") == "error", F.lit(NO_MAIN)).alias("error"),
        F.when(F.col("kind") == "error", snippet(html, snippet_chars)).alias("html_snippet"),
    )


def with_list_titles(records: DataFrame, links: DataFrame, key: str = "url") -> DataFrame:
    """The title of the link list replaces the one found on the page."""
    titles = links.select(key, F.col("title").alias("_list_title"))
    return (
        records.join(titles, key, "left")
        .withColumn("title", F.coalesce("_list_title", "title"))
        .select(*records.columns)
    )
