"""Queries: records out of stored pages.

``html_nodes`` and the link queries read the given pages.  The others render one page per row of a
table, read the fields back out, and are checked against the rows the pages were made from.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from listprep.functions import html as H
from listprep.operators import enrich, extract, packages, rules, wiki
from listprep.queries.registry import escaped, money, query, spread, table

CARD_BASE = "https://cards.example.org"
WIKI_BASE = "https://wiki.example.org/wiki/Start"


def joined(*parts):
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def text(c):
    return F.col(c).cast("string")


def sql_unescaped(column):
    """The four entities of the given pages decoded; a cut one may lack its semicolon."""
    for name, char in (("quot", '"'), ("lt", "<"), ("gt", ">"), ("amp", "&")):
        column = f"regexp_replace({column}, '&{name};?', '{char}', 'g')"
    return f"trim({column})"


@query(
    "html_nodes",
    """
    with clean as (
      select regexp_replace(regexp_replace(html, '<!--.*?-->', '', 'gs'), '<(script|style)([^>]*)>.*?</(script|style)>', '<\\1\\2>', 'gs') as html
      from pages),
    opened as (select unnest(regexp_extract_all(html, '<[a-z][^>]*>')) as t from clean),
    tags as (select regexp_extract(t, '^<([a-z0-9]+)', 1) as tag, t from opened),
    attrs as (select tag, unnest(regexp_extract_all(t, '[a-z-]+="[^"]*"')) as a from tags)
    select tag, null as attr, count(*) as n, 0 as n_chars from tags group by tag
    union all
    select tag, split_part(a, '=', 1), count(*), cast(sum(length(a) - length(split_part(a, '=', 1)) - 3) as bigint)
    from attrs group by 1, 2
    """,
)
def html_nodes(spark, d):
    """All elements and all attributes of the given pages, with the length of their values."""
    parsed = H.parse_html(spread(table(spark, d, "pages", "page_id", "html")))
    nodes = parsed.select(F.explode("dom.nodes").alias("node"))
    one = lambda attr, value: F.struct(attr.alias("attr"), F.length(value).cast("long").alias("n_chars"))
    node = F.col("node")
    given = F.transform(F.map_entries(F.coalesce(node["attrs"], F.create_map().cast("map<string,string>"))), lambda e: one(e["key"], e["value"]))
    each = nodes.select(node["tag"].alias("tag"), F.explode(F.concat(F.array(one(F.lit(None).cast("string"), F.lit(""))), given)).alias("a"))
    return each.groupBy("tag", "a.attr").agg(F.count("*").alias("n"), F.sum("a.n_chars").alias("n_chars"))


@query(
    "real_titles",
    f"""
    with t as (
      select page_id, regexp_extract(html, '<h1>([^<]*)</h1>', 1) as heading,
        len(regexp_extract_all(html, '<h1>')) as n_headings, regexp_extract(html, '<div class="ad">([^<]*)</div>', 1) as ad
      from pages)
    select page_id, {sql_unescaped('heading')} as heading, n_headings, {sql_unescaped('ad')} as ad from t
    """,
)
def real_titles(spark, d):
    """Headings and the marked block of the given pages, with their unclosed tags and odd scripts."""
    parsed = H.parse_html(spread(table(spark, d, "pages", "page_id", "html")), keep_tags=["h1", "div"], keep_attrs=[])
    dom = F.col("dom")
    return parsed.select(
        "page_id",
        H.tight(dom, H.find(dom["nodes"], tag="h1")).alias("heading"),
        F.size(H.find_all(dom["nodes"], tag="h1")).cast("long").alias("n_headings"),
        H.tight(dom, H.find(dom["nodes"], tag="div", cls="ad")).alias("ad"),
    )


# --- contract cards --------------------------------------------------------------------------------


def card_pages(spark, d):
    """One card per order: one to three contact rows by status, no price for pending orders."""
    key, customer = text("o_orderkey"), text("o_custkey")
    rows = F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 2).otherwise(3)

    def contact(i):
        n = i.cast("string")
        return joined(
            "<tr><td>Buyer</td><td> Street ", n, ",\n &amp; House ", customer, " </td><td>+7 ", customer, "-", n,
            "<br>\n mail", n, "@x.example</td></tr>",
        )

    price = F.when(
        F.col("o_orderstatus") != "P",
        joined(
            '<div class="sectionMainInfo borderRight col-3 colSpaceBetween"><div class="price">',
            '<span class="cardMainInfo__content cost">\n  ', money(F.col("o_totalprice")), " ₽\n</span></div></div>",
        ),
    ).otherwise("<div class='price'><span class='cardMainInfo__content cost'>0</span></div>")
    html = joined(
        '<!DOCTYPE html><html><body><div class="registry-entry__header-mid__number"><b>№</b><a href="/card/', key,
        '">', key, '</a><a href="/other">x</a></div><div class="registry-entry__header-mid__number">none</div>',
        '<span class="text-break">no</span><span class="text-break d-block">  Supply:\n\t ',
        escaped(joined("<", F.col("o_orderpriority"), '> & "', key, '"')), " </span>", price,
        '<section class="section blockInfo__section"><span>Орган:</span><span>A</span><span>ИНН:</span> <p><span> ',
        customer, ' </span></p></section><section class="section blockInfo__section"><span>ИНН:</span><span>2</span></section>',
        '<table class="blockInfo__table tableBlock grayBorderBottom"><thead><tr><th>Наименование</th>',
        "<th>Адрес места нахождения организации</th><th>Телефон, электронная почта</th></tr></thead><tbody>",
        F.array_join(F.transform(F.sequence(F.lit(1), rows), contact), ""),
        "</tbody></table></body></html>",
    )
    orders = spread(table(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"))
    return orders.select("o_orderkey", html.alias("html"))


TABLE_TAGS = ["table", "tbody", "tr", "th", "td"]


def cards(spark, d, tags):
    return H.parse_html(card_pages(spark, d), keep_tags=tags, keep_attrs=["href"])


SQL_CARDS = """
cards as (
  select *, case o_orderstatus when 'F' then 1 when 'O' then 2 else 3 end as n_rows, cast(o_custkey as varchar) as cust from orders),
cells as (
  select *, 'Street 1, & House ' || cust || case when n_rows > 1 then ' | Street 2, & House ' || cust else '' end
      || case when n_rows > 2 then ' | Street 3, & House ' || cust else '' end as address,
    '+7 ' || cust || '-1 mail1@x.example' || case when n_rows > 1 then ' | +7 ' || cust || '-2 mail2@x.example' else '' end
      || case when n_rows > 2 then ' | +7 ' || cust || '-3 mail3@x.example' else '' end as contacts
  from cards)
"""


@query("container_links", f"select o_orderkey, '{CARD_BASE}/card/' || o_orderkey as link from orders")
def container_links(spark, d):
    links = extract.container_links(
        cards(spark, d, ["div", "a"]), "o_orderkey", cls="registry-entry__header-mid__number", base=CARD_BASE
    )
    return links.drop("pos")


@query(
    "rule_extract",
    f"""
    with {SQL_CARDS}
    select o_orderkey, 'Supply: <' || o_orderpriority || '> & "' || o_orderkey || '"' as items,
      case when o_orderstatus <> 'P' then cast(cast(o_totalprice as decimal(15,2)) as varchar) || ' ₽' else '' end as price,
      cust as inn, address, contacts
    from cells
    """,
)
def rule_extract(spark, d):
    """Five fields by a table of rules, in one walk over each page."""
    return rules.read_fields(card_pages(spark, d), "o_orderkey", rules=rules.rules_table(spark, extract.CONTRACT_RULES))


@query("labelled_value", "select o_orderkey, cast(o_custkey as varchar) as inn from orders")
def labelled_value(spark, d):
    return extract.extract_rules(
        cards(spark, d, ["section", "span"]), "o_orderkey", rules=[extract.Labelled("inn", "ИНН:")]
    )


@query("table_column_join", f"with {SQL_CARDS} select o_orderkey, address, '' as other from cells")
def table_column_join(spark, d):
    columns = [
        extract.TableColumn("address", "Адрес", "blockInfo__table tableBlock grayBorderBottom"),
        extract.TableColumn("other", "Нет такого", "blockInfo__table tableBlock grayBorderBottom"),
    ]
    return extract.extract_rules(cards(spark, d, TABLE_TAGS), "o_orderkey", rules=columns)


# --- organisation pages ----------------------------------------------------------------------------

SQL_ORGS = """
orgs as (
  select *, cast(c_custkey as varchar) as k,
    case when c_acctbal < 0 then 'captcha' when c_acctbal < 1000 then 'empty' when c_acctbal < 2500 then 'hits' else 'record' end as kind
  from customer)
"""


def org_pages(spark, d):
    """One organisation page per customer; captcha, empty and hit pages by balance."""
    key, balance = text("c_custkey"), F.col("c_acctbal")
    staff = F.when(
        F.col("c_nationkey") > 9, joined("<tr><td>Численность персонала:</td><td> ", text("c_nationkey"), "</td></tr>")
    ).otherwise("")
    record = joined(
        '<table class="table table-sm"><tr><td><i>Полное юридическое наименование:</i></td><td> old </td></tr>',
        "<tr><td>one</td></tr><tr><td>a</td><td>b</td><td>c</td></tr>",
        '<tr><td> Полное юридическое наименование: </td><td>\n "', escaped(joined(F.col("c_name"), " & Sons")),
        '" </td></tr>', staff, "</table>",
        '<a class="clipboards nwra"><i></i><span> +7 ', key, " </span></a>",
        F.when(F.col("c_mktsegment") != "BUILDING", joined('<a class="wwbw" href="#"> k', key, "@x.example</a>")).otherwise(""),
        '<table class="finance"><tr><td>Выручка</td><td>', money(balance), " <b>руб.</b></td></tr></table>",
    )
    hits = joined(
        '<div class="org_list"><p><label><a href="/company/', key, '">x</a></label><a href="/no">y</a></p></div>'
    )
    body = (
        F.when(balance < 0, F.lit('<div class="g-recaptcha"></div><div class="org_list"></div>'))
        .when(balance < 1000, F.lit('<div class="org_list"><p><b>none</b></p></div>'))
        .when(balance < 2500, hits)
        .otherwise(record)
    )
    customers = spread(table(spark, d, "customer", "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"))
    return customers.select("c_custkey", joined("<html><body>", body, "</body></html>").alias("html"))


def orgs(spark, d):
    return H.parse_html(org_pages(spark, d), keep_attrs=["href"])


@query(
    "page_kind",
    f"with {SQL_ORGS} select c_custkey, kind, case kind when 'hits' then 'https://orgs.example/company/' || k end as hit_url from orgs",
)
def page_kind(spark, d):
    return extract.page_kind(orgs(spark, d), "c_custkey", base="https://orgs.example")


@query(
    "kv_table",
    f"""
    with {SQL_ORGS}
    select c_custkey, 0 as pos, 'Полное юридическое наименование:' as label, 'old' as value from orgs where kind = 'record'
    union all select c_custkey, 1, 'Полное юридическое наименование:', '"' || c_name || ' & Sons"' from orgs where kind = 'record'
    union all select c_custkey, 2, 'Численность персонала:', cast(c_nationkey as varchar) from orgs where kind = 'record' and c_nationkey > 9
    """,
)
def kv_table(spark, d):
    pairs = F.posexplode(extract.two_cell_rows()).alias("pos", "pair")
    return orgs(spark, d).select("c_custkey", pairs).select("c_custkey", "pos", "pair.label", "pair.value")


SQL_ORG_FIELDS = f"""
{SQL_ORGS},
fields as (
  select c_custkey, k, '"' || c_name || ' & Sons"' as legal_name, case when c_nationkey > 9 then cast(c_nationkey as varchar) end as headcount,
    '+7 ' || k as phone, case when c_mktsegment <> 'BUILDING' then 'k' || k || '@x.example' end as email,
    cast(cast(c_acctbal as decimal(15,2)) as varchar) || ' руб.' as revenue
  from orgs where kind = 'record')
"""


@query(
    "org_fields",
    f"with {SQL_ORG_FIELDS} select c_custkey, legal_name, headcount, phone, email, revenue from orgs left join fields using (c_custkey)",
)
def org_fields(spark, d):
    return extract.org_fields(orgs(spark, d), "c_custkey")


@query(
    "enrich_overlay",
    f"""
    with {SQL_ORG_FIELDS}, base as (
      select o_orderkey, case when o_orderstatus <> 'P' then cast(o_custkey as varchar) else '' end as inn from orders)
    select o_orderkey, inn, coalesce(legal_name, 'unknown') as legal_name, phone, coalesce(email, 'none') as email
    from base left join fields on k = inn
    """,
)
def enrich_overlay(spark, d):
    """Contract rows by tax id, overlaid with what the organisation pages gave."""
    inn = F.when(F.col("o_orderstatus") != "P", text("o_custkey")).otherwise("")
    base = table(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderstatus").select(
        "o_orderkey", inn.alias("inn"), F.lit("unknown").alias("legal_name"), F.lit("none").alias("email")
    )
    found = extract.org_fields(orgs(spark, d), "c_custkey").filter("legal_name is not null")
    found = found.withColumn("inn", text("c_custkey"))
    return enrich.overlay(base, found, "inn", ["legal_name", "phone", "email"])


# --- listings --------------------------------------------------------------------------------------


def listing_pages(spark, d, make):
    """Pages of at most 50 part entries; ``make`` renders (page, joined items)."""
    page = F.call_function("div", F.col("p_partkey"), F.lit(50)).alias("page")
    item = joined('<a href="/wiki/', text("p_partkey"), '" title=" ', escaped(F.col("p_name")), ' &amp; ', text("p_partkey"), ' ">x</a>')
    rows = table(spark, d, "part", "p_partkey", "p_name").select(page, "p_partkey", item.alias("item"))
    pages = rows.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("p_partkey", "item"))).alias("items"))
    return pages.select("page", make(F.col("page"), F.col("items.item")).alias("html"))


SQL_ENTRIES = """
select p_partkey // 50 as page, p_name || ' & ' || p_partkey as title, 'https://wiki.example.org/wiki/' || p_partkey as url from part
"""


@query("category_members", SQL_ENTRIES)
def category_members(spark, d):
    def make(_page, items):
        lis = F.array_join(
            F.transform(items, lambda a: joined('<li class="category-page__member"><a href="/img"></a>', a, "</li>")), "\n"
        )
        return joined(
            '<div class="category-page__members"><div class="category-page__members-wrapper"><ul class="category-page__members-for-char">',
            '<li class="category-page__member"><a href="/wiki/0" title="wrong">x</a></li></ul></div></div>',
            '<div id="mw-content-text"><p>..</p><div class="category-page__members"><div class="category-page__members-wrapper">',
            '<ul class="category-page__members-for-char">', lis, '<li><a href="/w" title="t">no class</a></li></ul>',
            '</div><div class="category-page__members-wrapper"><p>empty</p></div></div></div>',
        )

    parsed = H.parse_html(listing_pages(spark, d, make))
    return extract.category_members(parsed, "page", base=WIKI_BASE).drop("pos")


@query("all_pages_links", SQL_ENTRIES)
def all_pages_links(spark, d):
    def make(_page, items):
        lis = F.array_join(F.transform(items, lambda a: joined("<li>", a, "</li>")), "")
        return joined(
            '<div id="mw-content-text"><ul><li><a href="/z" title="z">z</a></li></ul><div class="mw-allpages-body"><ul>',
            lis, "<li><a href='/untitled'>u</a></li></ul></div></div>",
        )

    parsed = H.parse_html(listing_pages(spark, d, make))
    return extract.all_pages_links(parsed, "page", base=WIKI_BASE).drop("pos")


@query(
    "next_page",
    """
    with p as (select distinct p_partkey // 50 as page from part)
    select page, case page % 4 when 0 then 'https://wiki.example.org/ru/' || page when 1 then 'https://wiki.example.org/en/' || page else '' end as next
    from p
    """,
)
def next_page(spark, d):
    def make(page, _items):
        n, kind = page.cast("string"), page % 4
        english = joined('<a href="/en/', n, '">Next page (', n, ")</a>")
        russian = joined('<a href="/ru/', n, '"><b>Следующая страница</b></a>')
        inner = F.when(kind == 0, joined(english, russian)).when(kind == 1, joined('<a href="/p">Previous page</a>', english))
        inner = inner.when(kind == 2, '<a href="/p">Next <i>page</i></a>').otherwise(None)
        return F.coalesce(joined('<div class="mw-allpages-nav">', inner, "</div>"), F.lit("<p>Next page</p>"))

    parsed = H.parse_html(listing_pages(spark, d, make))
    return parsed.select("page", extract.next_page_url(WIKI_BASE).alias("next"))


@query(
    "listing_versions",
    """
    select p_partkey, unnest([p_size || '.' || (p_partkey % 7), '10.' || p_size, '9.' || p_size]) as version from part
    """,
)
def listing_versions(spark, d):
    size = text("p_size")
    names = F.array(
        F.lit("../"), joined(size, ".", (F.col("p_partkey") % 7).cast("string"), "/"), joined("10.", size, "/"),
        joined("9.", size, "/"), joined(size, ".0-beta/"), F.lit("maven-metadata.xml"), F.lit("./"),
    )
    html = joined("<pre>", F.array_join(F.transform(names, lambda n: joined('<a href="', n, '">', n, "</a> - ")), "\n"), "</pre>")
    parts = spread(table(spark, d, "part", "p_partkey", "p_size")).select("p_partkey", html.alias("html"))
    return extract.listing_versions(H.parse_html(parts, keep_tags=["a"], keep_attrs=[]), "p_partkey")


@query(
    "listing_latest",
    "select p_partkey, greatest(p_size || '.' || (p_partkey % 7), '10.' || p_size, '9.' || p_size) as latest from part",
)
def listing_latest(spark, d):
    return packages.latest_version(listing_versions(spark, d), ["p_partkey"])


# --- wiki pages ------------------------------------------------------------------------------------

SQL_WIKI = """
wiki as (
  select *, cast(p_partkey as varchar) as k,
    case when p_size <= 25 then 'path' when p_size <= 35 then 'class' when p_size <= 45 then 'id' else 'none' end as frame
  from part)
"""


def wiki_pages(spark, d):
    """One wiki page per part: the main block sits in one of three frames or is missing, by size."""
    key, name, brand, kind = text("p_partkey"), escaped(F.col("p_name")), F.col("p_brand"), F.col("p_type")
    size = F.col("p_size")
    heading = (
        F.when(kind == "PROMO", F.lit(""))
        .when(kind == "ECONOMY", joined('<h1 class="page-header__title"> ', name, " <i>page</i></h1>"))
        .when(kind == "SMALL", joined('<h1 id="firstHeading">', name, "/Gallery</h1>"))
        .otherwise(joined('<h1>other</h1><h1 id="firstHeading">', name, "</h1>"))
    )
    box = joined(
        '<aside class="portable-infobox"><h2 class="pi-item pi-title"> ', name, ' </h2>',
        '<figure class="pi-item pi-image"><a><img src="/img/', key, '.png"></a></figure>',
        '<div data-source="Gender"><h3 class="pi-data-label">Gender::</h3><div class="pi-data-value">', brand, "</div></div>",
        '<div data-source="LivingStatus"><div class="pi-data-value"> ', kind, " </div></div>",
        '<div data-source="PlaceOfBirth">Size <b>', size.cast("string"), "</b></div>",
        '<div data-source="Title">skip</div><div data-source="Empty"></div></aside>',
    )
    toc = '<ul><li><a>History</a></li><li><a>[edit]</a></li><li><a>ab</a></li><li><a>Powers</a></li></ul>'
    references = F.array_join(
        F.transform(F.sequence(F.lit(1), F.lit(12)), lambda i: joined('<li><span class="reference-text">Ref ', i.cast("string"), " of ", key, "</span></li>")), ""
    )
    marked = F.when(kind == "LARGE", joined('<div class="marvel_database_section">Marked <b>text</b> ', key, "</div>")).otherwise("")
    body = joined(
        box, "<p>Lead text number ", key, "</p><p>tiny</p>", marked,
        "<h2>Gender</h2><p>About <b>", brand, "</b></p>",
        "<h2>History</h2>\n<p> First <i>part</i> &amp; more </p><p></p><ul><li>one ", key, "</li><li>two</li></ul>",
        "<table><tr><th>K</th><th>V</th></tr><tr><td>size</td><td>", size.cast("string"), "</td></tr><tr></tr></table>",
        "<blockquote>Said</blockquote><dl><dt>Term</dt><dd>Meaning</dd><dt>Alone</dt></dl><pre> x = 1 </pre>",
        '<figure class="thumb"><img><figcaption>Picture ', key, '</figcaption></figure><div class="thumbcaption">cap</div>',
        '<div>short</div><div>long enough text</div><div class="x pi-smart-group-body">in</div><span>no</span><span class="mw-headline">Head</span>',
        "<h3>Powers</h3><p>Strong</p><h2>History</h2><p>again</p>",
        "<h2>Contents</h2>", toc,
        '<h2>Links and References</h2><div class="mw-references-wrap"><ol>', references, "</ol></div>",
        '<section class="pi-smart-group"><h4>First</h4><p>x</p><div class="pi-smart-data-value">Issue ', key, "</div></section>",
        '<div class="mw-collapsible-content">A collapsed block of ', key, "</div>",
    )
    frame = (
        F.when(size <= 25, joined('<div class="main-container"><div class="resizable-container"><div class="page has-right-rail"><main>', body, "</main></div></div></div>"))
        .when(size <= 35, joined('<main>wrong</main><main class="page__main big">', body, "</main>"))
        .when(size <= 45, joined('<div id="content">', body, "</div>"))
        .otherwise(joined('<div class="wikia-gallery">', name, "</div>"))
    )
    links = joined(
        '<a href="/wiki/Category:', brand, '"> ', brand, ' </a><a href="/wiki/Категория:', kind, '">', kind, '</a>',
        '<a href="/wiki/Category:', brand, '?x">', brand, '</a><a href="/wiki/Category:Empty"> </a><a href="/wiki/Other">no</a>',
    )
    html = joined("<html><head><title>t</title></head><body>", heading, frame, links, "</body></html>")
    parts = spread(table(spark, d, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size"))
    return parts.select("p_partkey", html.alias("html"))


def wiki_main_blocks(spark, d):
    return wiki.with_main(H.parse_html(wiki_pages(spark, d)))


def with_infobox(spark, d):
    return wiki_main_blocks(spark, d).withColumn("infobox", wiki.infobox())


@query(
    "main_block",
    f"""
    with {SQL_WIKI}
    select p_partkey, case when frame <> 'none' then 'page' when p_type = 'SMALL' then 'gallery' else 'error' end as kind,
      case frame when 'path' then 'main' when 'class' then 'main' when 'id' then 'div' end as tag
    from wiki
    """,
)
def main_block(spark, d):
    return wiki_main_blocks(spark, d).select("p_partkey", "kind", F.col("main.tag").alias("tag"))


SQL_PAGE_TITLE = """case p_type when 'PROMO' then null when 'ECONOMY' then p_name || 'page' when 'SMALL' then p_name || '/Gallery' else p_name end"""


@query(
    "page_titles",
    f"""
    with {SQL_WIKI}
    select p_partkey, {SQL_PAGE_TITLE} as page_title, coalesce(case when p_size > 5 then 'List ' || p_name end, {SQL_PAGE_TITLE}, '') as title
    from wiki
    """,
)
def page_titles(spark, d):
    """Titles found on the pages, and after the titles of the link list were put over them."""
    found = H.parse_html(wiki_pages(spark, d), keep_tags=["h1"], keep_attrs=[]).select(
        "p_partkey", wiki.page_title().alias("page_title")
    )
    records = found.withColumn("title", F.coalesce("page_title", F.lit("")))
    links = table(spark, d, "part").filter("p_size > 5").select("p_partkey", joined("List ", F.col("p_name")).alias("title"))
    return wiki.with_list_titles(records, links, key="p_partkey")


@query(
    "infobox_map",
    f"""
    with {SQL_WIKI}, e as (
      select p_partkey, unnest(['name', 'image', 'Gender', 'Living  Status', 'Place of  Birth']) as key,
        unnest([p_name, '/img/' || k || '.png', p_brand, p_type, 'Size' || p_size]) as value
      from wiki where frame <> 'none')
    select * from e
    """,
)
def infobox_map(spark, d):
    return with_infobox(spark, d).select("p_partkey", F.explode("infobox").alias("key", "value"))


@query(
    "infobox_alias",
    """
    with t as (
      select *, unnest(['Name', 'Current Alias', 'GENDER', 'Date of birth', 'Living Status', 'Reality', 'brand', 'None']) as title from part)
    select p_partkey, title, case lower(title) when 'name' then p_name when 'current alias' then case when p_type <> 'SMALL' then p_brand end
      when 'gender' then 'last' when 'date of birth' then p_type when 'living status' then 'a' when 'brand' then p_brand end as value
    from t
    """,
)
def infobox_alias(spark, d):
    """Section titles answered from an info box, by alias or by the key itself."""
    alias_key = F.when(F.col("p_type") != "SMALL", "Alias").otherwise("other")
    entries = F.array(
        *[F.struct(k.alias("key"), v.alias("value")) for k, v in [
            (F.lit("Title"), F.col("p_name")), (alias_key, F.col("p_brand")), (F.lit("Gender"), F.lit("first")),
            (F.lit("gender"), F.lit("last")), (F.lit("Birth"), F.col("p_type")), (F.lit("LivingStatus"), F.lit("b")),
            (F.lit("Status"), F.lit("a")), (F.lit("BRAND"), F.col("p_brand"))]]
    )
    titles = ["Name", "Current Alias", "GENDER", "Date of birth", "Living Status", "Reality", "brand", "None"]
    boxes = table(spark, d, "part").select("p_partkey", F.map_from_entries(entries).alias("box"))
    boxes = boxes.select("p_partkey", wiki.lower_keys(F.col("box")).alias("box"))
    asked = boxes.withColumn("title", F.explode(F.lit(titles)))
    return asked.select("p_partkey", "title", wiki.alias_value(F.col("box"), F.col("title")).alias("value"))


def sql_section(pos, level, title, content):
    return f"select p_partkey, {pos} as pos, {level} as level, {title} as title, {content} as content from wiki where frame <> 'none'"


NL = "chr(10)"
SQL_HISTORY = f" || {NL} || ".join(
    [
        "'Firstpart& more'", "'one ' || k", "'two'", f"'Таблица:' || {NL} || 'K | V'", "'size | ' || p_size", "'Цитата: Said'",
        "'Term: Meaning'", "'Код/Преформатированный текст: x = 1'", "'Изображение: Picture ' || k", "'Изображение: cap'",
        "'long enough text'", "'in'", "'Head'",
    ]
)
def sql_references(count):
    return f" || {NL} || ".join(f"'Ref {i} of ' || k" for i in range(1, count + 1))


def sql_sections(references):
    """Level, title and content of the sections in order."""
    return [
        (2, "p_name", "'Gender::' || p_brand"),
        (3, "'Gender::'", "''"),
        (2, "'Gender'", f"p_brand || {NL} || 'About' || p_brand"),
        (2, "'History'", SQL_HISTORY),
        (3, "'Powers'", "'Strong'"),
        (2, "'Contents'", f"'History' || {NL} || 'Powers'"),
        (2, "'Links and References'", sql_references(references)),
        (4, "'First'", "'Issue ' || k"),
    ]


@query(
    "wiki_sections",
    f"with {SQL_WIKI} " + " union all ".join(sql_section(i, *s) for i, s in enumerate(sql_sections(wiki.REFERENCES))),
)
def wiki_sections(spark, d):
    pages = with_infobox(spark, d).filter("kind = 'page'")
    found = pages.select("p_partkey", F.posexplode(wiki.sections(wiki.REFERENCES)).alias("pos", "s"))
    return found.select("p_partkey", "pos", "s.level", "s.title", "s.content")


SQL_MAIN = f"""case p_type when 'LARGE' then 'Markedtext' || k
        else 'Lead text number ' || k || {NL} || 'About' || p_brand || {NL} || 'Firstpart& more' end
      || {NL} || '[Раскрывающийся контент]: A collapsed block of ' || k || {NL} || '[Изображение]: Picture ' || k"""


@query("wiki_main", f"with {SQL_WIKI} select p_partkey, {SQL_MAIN} as main_content from wiki where frame <> 'none'")
def wiki_main(spark, d):
    return wiki_main_blocks(spark, d).filter("kind = 'page'").select("p_partkey", wiki.main_text(wiki.PARAGRAPHS).alias("main_content"))


@query(
    "categories",
    f"with {SQL_WIKI} select p_partkey, array_to_string(list_sort([p_brand, p_type]), '|') as categories from wiki",
)
def categories(spark, d):
    parsed = H.parse_html(wiki_pages(spark, d), keep_tags=["a"], keep_attrs=["href"])
    return parsed.select("p_partkey", F.array_join(wiki.categories(), "|").alias("categories"))


SQL_SECTION_TEXT = f" || {NL} || ".join(
    f"'{level}' || chr(9) || {title} || chr(9) || {content}" for level, title, content in sql_sections(12)
)
SQL_BOX = """'name=' || p_name || '|image=/img/' || k || '.png|Gender=' || p_brand || '|Living  Status=' || p_type || '|Place of  Birth=Size' || p_size"""
# the page source around its main block, and of the error page from its body on
SQL_RECORDS = f"""
{SQL_WIKI},
records as (
  select p_partkey, p_size, p_type, p_name, p_brand, k, frame <> 'none' as page, frame = 'none' and p_type = 'SMALL' as gallery,
    frame = 'none' and p_type <> 'SMALL' as failed,
    coalesce({SQL_PAGE_TITLE}, '') as page_title,
    case when frame <> 'none' then {SQL_MAIN} when p_type = 'SMALL' then 'This is a gallery page with images' end as main_content,
    case when frame <> 'none' then {SQL_SECTION_TEXT} when p_type = 'SMALL' then '2' || chr(9) || 'Gallery' || chr(9) || 'Image gallery content' end as sections,
    case when frame <> 'none' then {SQL_BOX} when p_type = 'SMALL' then '' end as infobox,
    case when frame <> 'none' then array_to_string(list_sort([p_brand, p_type]), '|') when p_type = 'SMALL' then 'Gallery' end as categories,
    case when frame = 'none' and p_type <> 'SMALL' then 'Main content not found' end as error,
    case frame when 'path' then 'main' when 'class' then 'main' when 'id' then 'div' else case when p_type = 'SMALL' then 'body' end end as source_tag,
    case when frame = 'none' and p_type <> 'SMALL' then 'body' end as snippet_tag
  from wiki)
"""


def record_columns():
    """The columns of page records as plain values: lists as texts; of the two page sources the tag they are cut at."""
    lines = F.transform("sections", lambda s: F.concat_ws("\t", s["level"], s["title"], s["content"]))
    box = F.transform(F.map_entries("infobox"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    tag = lambda c: F.nullif(F.regexp_extract(c, "(?s)^<([a-z]+)[ >].*</\\1>$", 1), F.lit(""))
    whole = lambda c: F.when(F.col(c).startswith("<body>"), "body").otherwise(tag(F.col(c)))
    return [
        "title", "main_content", F.array_join(lines, "\n").alias("sections"), F.array_join(box, "|").alias("infobox"),
        F.array_join("categories", "|").alias("categories"), "error",
        whole("raw_html").alias("source_tag"), whole("html_snippet").alias("snippet_tag"),
    ]


@query(
    "wiki_records",
    f"""
    with {SQL_RECORDS}
    select p_partkey, page_title as title, main_content, sections, infobox, categories, error, source_tag, snippet_tag from records
    """,
)
def wiki_records(spark, d):
    """Whole records: good, gallery and error pages in one schema."""
    pages = H.parse_html(wiki_pages(spark, d), keep_html=True)
    return wiki.page_records(pages, "p_partkey").select("p_partkey", *record_columns())
