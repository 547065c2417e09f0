"""Queries: whole jobs from the plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from listprep.plans import catalog, mirror, procurement
from listprep.queries.packages import SQL_LISTING, SQL_VERSIONS, artifact_dedup, artifact_rows, listing, local_inventory, package_versions
from listprep.queries.packages import remote_index
from listprep.queries.pages import SQL_CARDS, SQL_ORG_FIELDS, SQL_RECORDS, WIKI_BASE, card_pages, joined, listing_pages
from listprep.queries.pages import org_pages, record_columns, wiki_pages
from listprep.queries.pages import text as as_text
from listprep.queries.registry import query, table
from listprep.session import work_dir


@query(
    "contract_report",
    f"""
    with {SQL_CARDS}, {SQL_ORG_FIELDS}, first as (
      select * from (select *, row_number() over (partition by o_custkey order by o_orderkey) as rn from cells where o_orderstatus <> 'O')
      where rn = 1)
    select o_orderkey, cust as inn, 'Supply: <' || o_orderpriority || '> & "' || o_orderkey || '"' as items,
      case when o_orderstatus <> 'P' then cast(cast(o_totalprice as decimal(15,2)) as varchar) || ' ₽' else '' end as price,
      address, contacts, legal_name, headcount, phone, email, revenue
    from first left join fields on k = cust
    """,
)
def contract_report(spark, d):
    stored = table(spark, d, "orders").filter("o_orderstatus = 'O'").select("o_orderkey")
    rows = procurement.contract_rows(card_pages(spark, d), stored, key="o_orderkey")
    organisations = org_pages(spark, d).select(as_text("c_custkey").alias("inn"), "html")
    return procurement.enriched_contracts(rows, organisations, key="o_orderkey")


@query(
    "contract_links",
    "select 'https://cards.example.org/card/' || o_orderkey as link from orders where o_orderstatus <> 'F'",
)
def contract_links(spark, d):
    stored = table(spark, d, "orders").filter("o_orderstatus = 'F'").select(
        joined("https://cards.example.org/card/", as_text("o_orderkey")).alias("link")
    )
    pages = card_pages(spark, d).withColumnRenamed("o_orderkey", "page")
    return procurement.new_links(
        pages, stored, cls="registry-entry__header-mid__number", base="https://cards.example.org"
    ).select("link")


@query(
    "wiki_catalog",
    f"""
    with {SQL_RECORDS}
    select p_partkey as pos, p_name || ' & ' || p_partkey as title, main_content, sections, infobox, categories, error, source_tag, snippet_tag
    from records where p_type <> 'PROMO' or p_size > 40
    """,
)
def wiki_catalog(spark, d):
    """Listing → links → pending pages (no output, or one with an error) → records."""

    def make(_page, items):
        lis = F.array_join(F.transform(items, lambda a: joined("<li>", a, "</li>")), "")
        return joined('<div id="mw-content-text"><div class="mw-allpages-body"><ul>', lis, "</ul></div></div>")

    links = catalog.listed_links(listing_pages(spark, d, make), base=WIKI_BASE).select(
        F.lit("all").alias("list"), F.regexp_extract("url", "([0-9]+)$", 1).cast("bigint").alias("pos"), "title", "url"
    )
    stored = table(spark, d, "part").filter("p_type = 'PROMO'").select(
        F.lit("all").alias("list"),
        joined(F.replace("p_name", F.lit(" "), F.lit("_")), "_", as_text("p_partkey")).alias("safe_name"),
        (F.col("p_size") > 40).alias("has_error"),
    )
    pages = wiki_pages(spark, d).select(
        joined("https://wiki.example.org/wiki/", as_text("p_partkey")).alias("url"), "html"
    )
    records = catalog.pending_records(links, stored, pages)
    return records.select("pos", *record_columns())


@query(
    "package_mirror",
    f"""
    with {SQL_VERSIONS}
    select pkg, version, 'https://registry.npmjs.org/' || pkg || '/-/' || pkg || '-' || version || '.tgz' as url,
      pkg || '/' || pkg || '-' || version || '.tgz' as path
    from (select *, row_number() over (partition by pkg order by a desc, b desc, c desc, rc is null desc, rc desc) as rank from v)
    where rank <= 20 and rc is null
    """,
)
def package_mirror(spark, d):
    versions = package_versions(spark, d).select("pkg", "version")
    have = versions.filter(F.col("version").contains("-rc.")).select(
        joined(F.col("pkg"), "/", F.col("pkg"), "-", F.col("version"), ".tgz").alias("path")
    )
    return mirror.package_mirror(versions, have)[0]


@query(
    "invalid_versions",
    """
    select distinct p_brand as pkg, case p_partkey % 4 when 0 then p_size || '.' || (p_partkey % 7)
      when 1 then '0' || p_size || '.1.1' else p_size || '.1.' || repeat('9', 25) end as version
    from part where p_partkey % 4 <> 3
    """,
)
def invalid_versions(spark, d):
    """The versions set aside: too few numbers, a leading zero, more than 64 bits."""
    version = (
        "case p_partkey % 4 when 0 then concat(p_size, '.', p_partkey % 7) when 1 then concat('0', p_size, '.1.1')"
        " when 2 then concat(p_size, '.1.', repeat('9', 25)) else concat(p_size, '.1.', p_partkey) end as version"
    )
    versions = table(spark, d, "part").selectExpr("p_brand as pkg", version)
    return mirror.package_mirror(versions, spark.createDataFrame([], "path string"))[1]


@query(
    "crate_mirror",
    """
    with v as (
      select p_brand as pkg, p_size || '.' || (p_partkey % 7) as version, p_partkey as pos,
        row_number() over (partition by p_brand order by p_partkey) as rank from part),
    w as (select * from v where rank <= 3 and pkg not in (select p_brand from part where p_retailprice = 900))
    select pkg, version, 'https://crates.io/api/v1/crates/' || pkg || '/' || version || '/download' as url,
      'crates/' || pkg || '/' || version || '/' || pkg || '-' || version || '.crate' as path
    from w where (pkg, version) not in (select p_brand, p_size || '.' || (p_partkey % 7) from part where p_type = 'SMALL')
    """,
)
def crate_mirror(spark, d):
    part = table(spark, d, "part").selectExpr(
        "p_brand as pkg", "concat(p_size, '.', p_partkey % 7) as version", "p_partkey as pos", "p_type", "p_retailprice"
    )
    return mirror.crate_mirror(
        part.select("pkg"), part.filter("p_retailprice = 900").select("pkg"), part.select("pkg", "version", "pos"),
        part.filter("p_type = 'SMALL'").select("pkg", "version"),
    )


@query(
    "listing_job",
    """
    select p_partkey // 50 as page, p_name || ' & ' || p_partkey as title, 'https://wiki.example.org/wiki/' || p_partkey as url
    from part
    """,
)
def listing_job(spark, d):
    """A budget of three pages first, the same pages once more, then all others from where the saved list ends."""

    def make(_page, items):
        lis = F.array_join(F.transform(items, lambda a: joined("<li>", a, "</li>")), "")
        return joined('<div id="mw-content-text"><div class="mw-allpages-body"><ul>', lis, "</ul></div></div>")

    pages = listing_pages(spark, d, make)
    path = work_dir(spark, "listing")
    stored = lambda: spark.read.schema("page bigint, pos bigint, title string, url string").json(path)
    for _ in range(2):
        catalog.listing_job(pages, WIKI_BASE, path, max_pages=3)
    catalog.listing_job(pages, WIKI_BASE, path, start=catalog.next_start(stored()))
    return stored().select("page", "title", "url")


@query(
    "catalog_report",
    """
    with want as (select p_type as list, count(*) as n from part group by 1),
    have as (select p_type as list, count(*) as n from part where p_size > 10 group by 1),
    both_ as (select list, want.n as expected, coalesce(have.n, 0) as actual from want left join have using (list))
    select list, expected, actual, 0 as is_total, expected - actual as difference, expected = actual as ok from both_
    union all
    select null, cast(sum(expected) as bigint), cast(sum(actual) as bigint), 1,
           cast(sum(expected) - sum(actual) as bigint), sum(expected) = sum(actual) from both_
    """,
)
def catalog_report(spark, d):
    links = table(spark, d, "part", F.col("p_type").alias("list"), "p_size")
    return catalog.catalog_report(links, links.filter("p_size > 10"))


@query(
    "artifact_mirror",
    f"""
    with {SQL_LISTING}
    select group_id, artifact_id, latest_version as old_version, latest as new_version
    from artifacts join lexical using (group_id, artifact_id) where latest <> latest_version
    """,
)
def artifact_mirror(spark, d):
    """The change report of the mirror; its fetch state is checked by ``fetch_state``."""
    files = remote_index(spark, d)
    artifacts = artifact_dedup(spark, d).select("group_id", "artifact_id", "latest_version")
    owners = artifact_rows(spark, d).filter("g <> 'org.small'").selectExpr("pos as l_partkey", "g as group_id", "a as artifact_id")
    listed = listing(spark, d).join(owners, "l_partkey")
    changes, _ = mirror.artifact_mirror(artifacts, listed, files, local_inventory(spark, d))
    return changes
