"""Queries: list building, membership, filters, paging, reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F

from listprep.functions import html as H
from listprep.functions import urls
from listprep.operators import enrich, extract, filters, membership, numbering, reconcile, search
from listprep.queries.registry import SQL_WS, query, spread, sql_strip, table
from listprep.session import work_dir
from listprep.streaming import jobs

BASE = "https://lists.example.org"

# --- links of stored pages -----------------------------------------------------------------------


def page_anchors(spark, d):
    """Navigation links of every page: page_id, page url, pos, href, label."""
    pages = spread(table(spark, d, "pages", "page_id", "url", "html"))
    parsed = H.parse_html(pages, keep_tags=["nav", "a"], keep_attrs=["href"])
    return extract.anchors(parsed, "page_id", "url", inside="nav")


def raw_links(spark, d):
    """The same links taken from the page text by pattern (stands for an already stored list)."""
    pages = table(spark, d, "pages", "page_id", "html")
    links = F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1))
    return pages.select("page_id", F.col("html").contains('<html lang="de"').alias("stored"), F.explode(links).alias("url"))


SQL_LINKS = """
links as (
  select page_id, url as page_url, html like '%<html lang="de"%' as stored,
         unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) as href
  from pages)
"""


@query(
    "links_append",
    f"""
    with {SQL_LINKS}
    select '{BASE}' || href as link, min(page_id) as page_id, substr(href, 2) as label
    from links where not stored
      and href not in (select href from links where stored)
    group by href
    """,
)
def links_append(spark, d):
    pages = table(spark, d, "pages", "page_id", "html").filter(~F.col("html").contains('<html lang="de"'))
    parsed = H.parse_html(spread(pages), keep_tags=["nav", "a"], keep_attrs=["href"])
    batch = extract.anchors(parsed, "page_id", inside="nav").withColumn(
        "link", urls.absolute_url(F.lit(BASE), F.col("href"))
    )
    existing = raw_links(spark, d).filter("stored").select(F.concat(F.lit(BASE), "url").alias("link"))
    return membership.append_new(batch, existing, "link", ["page_id", "pos"]).select("link", "page_id", "label")


@query(
    "links_indexed",
    f"""
    with {SQL_LINKS}
    select distinct '{BASE}' || href as link from links where not stored and href not in (select href from links where stored)
    """,
)
def links_indexed(spark, d):
    """The same links through a stored list with a key index: what is there already was stored without one; the rest
    comes in three batches."""
    target = work_dir(spark, "links-indexed")
    links = raw_links(spark, d).select("stored", "page_id", F.concat(F.lit(BASE), "url").alias("url"))
    links.filter("stored").select("page_id", "url").write.parquet(f"{target}/run=0/batch=0")
    index = jobs.link_index(spark, target, bucket_keys=20_000)
    for n in range(3):
        batch = links.filter(~F.col("stored") & (F.col("page_id") % 3 == n)).select("page_id", "url")
        jobs.append_batch(index, target, batch, "1", n, order=("page_id",))
    return spark.read.parquet(target).filter("run = 1").select(F.col("url").alias("link"))


@query(
    "list_stats",
    f"""
    with {SQL_LINKS}
    select lower(regexp_extract(page_url, '^[^:/?#]+://([^/?#]*)', 1)) as list,
           count(*) as n_rows, count(distinct href) as n_unique
    from links group by 1
    """,
)
def list_stats(spark, d):
    links = page_anchors(spark, d).select(urls.host(F.col("url")).alias("list"), "href")
    return reconcile.list_stats(links, "list", "href")


@query(
    "save_continue",
    f"""
    with {SQL_LINKS}
    select page_id, href as url, false as is_new from links where stored
    union all
    select page_id, href, true from links
    where not stored and href not in (select href from links where stored)
    """,
)
def save_continue(spark, d):
    links = raw_links(spark, d)
    return membership.continue_list(
        links.filter("stored").drop("stored"), links.filter("not stored").drop("stored")
    )


@query("first_wins", "select min(doc_id) as doc_id, arg_min(source, doc_id) as source, text from documents group by text")
def first_wins(spark, d):
    docs = table(spark, d, "documents", "doc_id", "source", "text")
    return membership.first_rows(docs, ["text"], ["doc_id"])


@query(
    "exclude_known",
    """
    select c_custkey, c_name from customer where c_custkey not in (
      select o_custkey from orders where o_orderstatus = 'P' and o_orderpriority = '1-URGENT')
    """,
)
def exclude_known(spark, d):
    fresh = table(spark, d, "customer", "c_custkey", "c_name")
    known = table(spark, d, "orders").filter("o_orderstatus = 'P' and o_orderpriority = '1-URGENT'")
    return membership.without_known(fresh, known.select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@query(
    "pending_keys",
    "select p_partkey, p_name from part where p_partkey not in (select l_partkey from lineitem where l_quantity = 50)",
)
def pending_keys(spark, d):
    parts = table(spark, d, "part", "p_partkey", "p_name")
    done = table(spark, d, "lineitem").filter("l_quantity = 50").select(F.col("l_partkey").alias("p_partkey"))
    return membership.without_known(parts, done, ["p_partkey"])


# The rejected characters in the naming schemes, as in ``functions.text``, for the checking engine.
def sql_safe_title(t, i):
    blank = f"{sql_strip(t)} = ''"
    name = f"regexp_replace({t}, '[''\"!@#$%^&*()+=\\[\\]{{}};:,.<>?/\\\\|`~]', '_', 'g')"
    name = f"regexp_replace({name}, '{SQL_WS}+', '_', 'g')"
    name = f"regexp_replace({name}, '_+', '_', 'g')"
    name = f"regexp_replace({name}, '^_+|_+$', '', 'g')"
    name = f"regexp_replace({name}, '[^\\p{{L}}\\p{{N}}_-]', '', 'g')"
    return f"""case when {blank} then 'page_' || {i} || '_untitled'
      when {name} = '' then 'page_' || {i}
      when length({name}) < 3 then 'page_' || {i} || '_' || {name}
      else left({name}, 100) end"""


def sql_old_title(t):
    kept = f"regexp_replace(regexp_replace({t}, '[^\\p{{L}}\\p{{N}} _-]', '', 'g'), ' +$', '')"
    return f"left(replace({kept}, ' ', '_'), 100)"


def sql_basic_title(t):
    return f"left(replace(regexp_replace({t}, '[\\\\/*?:\"<>|]', '_', 'g'), ' ', '_'), 100)"


# Every line of every document is the title of a link; a text has fewer lines than this.
LINES = 1 << 32
SQL_LINES = f"""
    lines as (
      select doc_id * {LINES} + i as pos, list_extract(string_split(text, chr(10)), i) as title, source as list, lang, doc_id,
             'doc:' || doc_id || ':' || i as url
      from (select *, unnest(range(1, len(string_split(text, chr(10))) + 1)) as i from documents))"""


def line_links(spark, d):
    docs = table(spark, d, "documents", "doc_id", "text", "lang", "source")
    lines = docs.select("doc_id", "lang", F.col("source").alias("list"), F.posexplode(F.split("text", "\n")).alias("i", "title"))
    place = F.col("i") + 1
    return lines.select(
        "list", (F.col("doc_id") * LINES + place).alias("pos"), "title",
        F.concat_ws(":", F.lit("doc"), "doc_id", place).alias("url"), "lang", "doc_id",
    )


@query(
    "pending_or_failed",
    f"""
    with {SQL_LINES},
    named as (select *, {sql_safe_title('title', 'pos')} as n0, {sql_old_title('title')} as n1,
                     {sql_basic_title('title')} as n2 from lines),
    done as (
      select n.*, case lang when 'en' then n0 when 'fr' then n1 when 'de' then n2 end as safe_name, toxic = 1 as err
      from named n join labels l using (doc_id)),
    by_url as (select list, url, bool_or(err) as err from done where safe_name is null group by 1, 2),
    by_name as (select list, safe_name, bool_or(err) as err from done where safe_name is not null group by 1, 2),
    tries as (
      select list, pos, 0 as rank, n0 as safe_name from named union all
      select list, pos, 1, n1 from named union all select list, pos, 2, n2 from named),
    own as (
      select list, safe_name, min(pos) as pos, min(rank) as rank from tries group by 1, 2 having count(distinct pos) = 1),
    hits as (select list, pos, arg_min(err, rank) as err from own join by_name using (list, safe_name) group by 1, 2)
    select n.list, n.pos, n.title, n.url, coalesce(u.err, h.err) is not null as failed_before
    from named n left join by_url u on u.list = n.list and u.url = n.url left join hits h on h.list = n.list and h.pos = n.pos
    where coalesce(u.err, h.err, true)
    """,
)
def pending_or_failed(spark, d):
    from listprep.functions import text

    links = line_links(spark, d)
    title = F.col("title")
    name = (
        F.when(F.col("lang") == "en", text.safe_title(title, F.col("pos")))
        .when(F.col("lang") == "fr", text.old_title(title))
        .when(F.col("lang") == "de", text.basic_title(title))
    )
    labels = table(spark, d, "labels", "doc_id", "toxic")
    done = links.withColumn("safe_name", name).join(labels, "doc_id")
    url = F.when(F.col("safe_name").isNull(), F.col("url")).alias("url")
    outputs = done.select("list", "safe_name", url, (F.col("toxic") == 1).alias("has_error"))
    return membership.pending_or_failed(links, outputs)


@query(
    "valid_items",
    """
    select doc_id as pos, coalesce(case when source <> 'src3' then source end, 'item_' || doc_id) as title,
           'doc:' || doc_id as url
    from documents where lang <> 'de'
    """,
)
def valid_items(spark, d):
    items = table(spark, d, "documents", "doc_id", "lang", "source").select(
        F.col("doc_id").alias("pos"),
        F.when(F.col("source") != "src3", F.col("source")).alias("title"),
        F.when(F.col("lang") != "de", F.concat(F.lit("doc:"), F.col("doc_id").cast("string"))).alias("url"),
    )
    return membership.valid_items(items)


@query(
    "error_records",
    "select d.doc_id from documents d join labels l using (doc_id) where toxic = 1 and quality = 1",
)
def error_records(spark, d):
    joined = table(spark, d, "documents", "doc_id", "text").join(table(spark, d, "labels"), "doc_id")
    good = F.to_json(F.struct(F.col("text").alias("title"), F.struct(F.lit("x").alias("error")).alias("sections")))
    bad = F.to_json(F.struct(F.lit("Main content not found").alias("error"), F.col("text").alias("html_snippet")))
    record = F.when(F.col("quality") == 0, F.concat(F.lit("{broken error "), "text"))
    record = record.when(F.col("toxic") == 1, bad).otherwise(good)
    return joined.select("doc_id", record.alias("record")).filter(membership.has_error(F.col("record"))).select("doc_id")


@query("quarantine_split", "select event_id, event_type = 'error' or value > 300 as is_bad from events")
def quarantine_split(spark, d):
    events = table(spark, d, "events", "event_id", "event_type", "value")
    value = F.when(F.col("event_type") != "error", F.col("value"))
    good, bad = membership.quarantine(events, value > 300)
    mark = lambda df, flag: df.select("event_id", F.lit(flag).alias("is_bad"))
    return mark(good, False).unionByName(mark(bad, True))


@query("start_offset", "select c_custkey, c_name from customer where c_custkey >= 10")
def start_offset(spark, d):
    return membership.start_offset(table(spark, d, "customer", "c_custkey", "c_name"), "c_custkey", 10)


@query(
    "resume_after",
    """
    with last as (select arg_max(o_custkey, (o_totalprice, o_orderkey)) as k from orders)
    select c_custkey, c_name from customer
    where c_custkey > coalesce((select min(c_custkey) from customer, last where c_custkey = k), -1)
    """,
)
def resume_after(spark, d):
    customers = table(spark, d, "customer", "c_custkey", "c_name")
    orders = table(spark, d, "orders", "o_custkey", "o_totalprice", "o_orderkey")
    last = orders.agg(
        F.concat(
            F.lit("Customer#"),
            F.lpad(F.max_by("o_custkey", F.struct("o_totalprice", "o_orderkey")).cast("string"), 9, "0"),
        )
    ).scalar()
    return membership.resume_after(customers, "c_custkey", "c_name", last)


# --- filters ---------------------------------------------------------------------------------------


@query(
    "price_floor_page",
    """
    select o_orderkey, cast(cast(o_totalprice as decimal(15,2)) as varchar) as price,
           strftime(o_orderdate, '%Y-%m-%d') as updated
    from orders where o_totalprice >= 100000 order by o_orderdate desc, o_orderkey limit 50 offset 50
    """,
)
def price_floor_page(spark, d):
    orders = table(spark, d, "orders", "o_orderkey", "o_totalprice", "o_orderdate")
    page = filters.price_floor_page(orders, "o_totalprice", "o_orderdate", "o_orderkey", floor=100_000, page=2)
    return page.select(
        "o_orderkey",
        F.col("o_totalprice").cast("decimal(15,2)").cast("string").alias("price"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("updated"),
    )


def playlist_items(spark, d):
    lines = table(spark, d, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    video = F.concat(F.lit("/watch?v="), F.col("l_partkey").cast("string"))
    href = F.when(F.col("l_linenumber") == 7, None).when(F.col("l_linenumber") == 2, video)
    href = href.otherwise(F.concat(video, F.lit("&list="), F.col("l_suppkey").cast("string")))
    return lines.select(F.concat(F.lit("PL"), F.col("l_suppkey").cast("string")).alias("playlist"), href.alias("href"))


SQL_PLAYLIST = """
items as (
  select 'PL' || l_suppkey as playlist,
    case l_linenumber when 7 then null when 2 then '/watch?v=' || l_partkey
      else '/watch?v=' || l_partkey || '&list=' || l_suppkey end as href
  from lineitem)
"""


@query(
    "video_links",
    f"with {SQL_PLAYLIST} select distinct href from items where href like '%/watch?v=%' order by href",
)
def video_links(spark, d):
    return filters.video_links(playlist_items(spark, d), in_playlist=False).select("href").distinct().orderBy("href")


@query(
    "playlist_sets",
    f"with {SQL_PLAYLIST} select distinct playlist, href as url from items where href like '%/watch?v=%' and href like '%&list=%'",
)
def playlist_sets(spark, d):
    links = filters.video_links(playlist_items(spark, d))
    return links.select("playlist", F.col("href").alias("url")).distinct()


@query(
    "include_patterns",
    """
    with files as (select p_partkey, p_type || '/' || p_brand || '/' || p_name || '.bin' as path from part)
    select * from files where path like 'ECONOMY/%' or path like 'SMALL/%'
    """,
)
def include_patterns(spark, d):
    path = F.concat(F.concat_ws("/", "p_type", "p_brand", "p_name"), F.lit(".bin"))
    files = table(spark, d, "part").select("p_partkey", path.alias("path"))
    return filters.include_paths(files, "path", ["ECONOMY/*", "SMALL/*"])


@query(
    "project_filters",
    """
    select p_name, sum(p_size) as total_size from part
    where p_name in (select p_name from part where p_type = 'PROMO')
      and p_name not in (select p_name from part where p_retailprice > 999.8)
    group by p_name having sum(p_size) <= 20000
    """,
)
def project_filters(spark, d):
    part = table(spark, d, "part", "p_name", "p_size", "p_type", "p_retailprice")
    return filters.select_projects(
        part, "p_name", "p_size",
        allow=part.filter("p_type = 'PROMO'"), block=part.filter("p_retailprice > 999.8"), max_size=20_000,
    )


SQL_LOCK = """
locks as (
  select p_partkey, case p_type when 'STANDARD' then '    ' || n || ' (1.0)' when 'ECONOMY' then '  * ' || n
    when 'MEDIUM' then '* ' || n when 'PROMO' then '*' || n when 'SMALL' then '' else '    ' || n end as line
  from (select p_partkey, p_type, replace(p_name, ' ', '-') as n from part))
"""


@query(
    "lock_names",
    f"""
    with {SQL_LOCK}
    select p_partkey, 'as_written' as mode, split_part(trim(line), ' ', 1) as name from locks
    where trim(line) like '*%' and line not like '%)%'
    union all
    select p_partkey, 'indented', regexp_extract(trim(line), '^\\*? *([^ ]+)', 1) from locks
    where (line like '  %' or line like '*%') and line not like '%)%'
    """,
)
def lock_names(spark, d):
    name = F.replace("p_name", F.lit(" "), F.lit("-"))
    kind = F.col("p_type")
    line = (
        F.when(kind == "STANDARD", F.concat(F.lit("    "), name, F.lit(" (1.0)")))
        .when(kind == "ECONOMY", F.concat(F.lit("  * "), name))
        .when(kind == "MEDIUM", F.concat(F.lit("* "), name))
        .when(kind == "PROMO", F.concat(F.lit("*"), name))
        .when(kind == "SMALL", F.lit(""))
        .otherwise(F.concat(F.lit("    "), name))
    )
    lines = table(spark, d, "part", "p_partkey", "p_type", "p_name").select("p_partkey", line.alias("line"))
    modes = [
        filters.lock_names(lines, mode=m).select("p_partkey", F.lit(m).alias("mode"), "name")
        for m in ("as_written", "indented")
    ]
    return modes[0].unionByName(modes[1])


# --- paging ----------------------------------------------------------------------------------------


@query(
    "keyset_pages",
    """
    select o_orderkey, o_custkey, o_orderstatus, cast((row_number() over (order by o_orderkey) - 1) // 4000 as bigint) as page
    from orders
    """,
)
def keyset_pages(spark, d):
    orders = table(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderstatus")
    return numbering.paginate(orders, "o_orderkey", 4000)


@query("keyset_first", "select o_orderkey, o_custkey from orders where o_orderkey > 100 order by o_orderkey limit 500")
def keyset_first(spark, d):
    return numbering.first_page(table(spark, d, "orders", "o_orderkey", "o_custkey"), "o_orderkey", after=100, size=500)


@query(
    "page_budget",
    """
    select * from (select c_custkey, c_name, cast((row_number() over (order by c_custkey) - 1) // 50 as bigint) as page
                   from customer) where page < 2
    """,
)
def page_budget(spark, d):
    return numbering.paginate(table(spark, d, "customer", "c_custkey", "c_name"), "c_custkey", 50, max_pages=2)


@query(
    "progress_pct",
    """
    select source, doc_id, row_number() over w as i, count(*) over (partition by source) as total,
           row_number() over w * 100 / count(*) over (partition by source) as pct
    from documents window w as (partition by source order by doc_id)
    """,
)
def progress_pct(spark, d):
    return numbering.progress(table(spark, d, "documents", "source", "doc_id"), "source", ["doc_id"])


# --- reconciliation --------------------------------------------------------------------------------


@query(
    "reconcile",
    """
    with want as (select source as list, count(*) as n from documents group by 1),
    have as (select source as list, count(*) as n from documents join labels using (doc_id) group by 1),
    both_ as (select list, coalesce(want.n, 0) as expected, coalesce(have.n, 0) as actual
              from want full join have using (list))
    select list, expected, actual, 0 as is_total, expected - actual as difference, expected = actual as ok from both_
    union all
    select null, cast(sum(expected) as bigint), cast(sum(actual) as bigint), 1,
           cast(sum(expected) - sum(actual) as bigint), sum(expected) = sum(actual) from both_
    """,
)
def reconcile_lists(spark, d):
    docs = table(spark, d, "documents", "doc_id", F.col("source").alias("list"))
    labelled = docs.join(table(spark, d, "labels", "doc_id"), "doc_id")
    return reconcile.reconcile(docs, labelled)


@query(
    "fully_processed",
    """
    with want as (select o_custkey as list, count(*) as n from orders where o_orderstatus = 'P' group by 1),
    have as (select o_custkey as list, count(*) as n from orders where o_orderstatus = 'F' group by 1)
    select list, coalesce(want.n, 0) as expected, coalesce(have.n, 0) as actual,
           coalesce(have.n, 0) >= coalesce(want.n, 0) as done
    from want full join have using (list)
    """,
)
def fully_processed(spark, d):
    orders = table(spark, d, "orders", F.col("o_custkey").alias("list"), "o_orderstatus")
    return reconcile.fully_processed(orders.filter("o_orderstatus = 'P'"), orders.filter("o_orderstatus = 'F'"))


@query(
    "dedup_inn",
    """
    select o_custkey, o_orderkey, o_orderstatus from (
      select *, row_number() over (partition by o_custkey order by o_orderkey) as rn from orders)
    where rn = 1 and o_totalprice >= 200000
    """,
)
def dedup_inn(spark, d):
    orders = table(spark, d, "orders", "o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")
    return membership.first_rows(orders, ["o_custkey"], ["o_orderkey"]).filter("o_totalprice >= 200000").drop("o_totalprice")


# --- search and unions -----------------------------------------------------------------------------

# The default terms hardly occur in the input texts, so frequent words of its languages are added.
TERMS = (*search.SEARCH_TERMS, "the", "of", "and", "que", "der", "zzz")
SQL_TERMS = ", ".join(f"'{t}'" for t in TERMS)
SQL_HITS = f"""
hits as (
  select doc_id, source, unnest(list_intersect(list_distinct(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+')),
    [{SQL_TERMS}])) as query from documents)
"""


@query("term_search", f"with {SQL_HITS} select query, doc_id, source from hits")
def term_search(spark, d):
    docs = spread(table(spark, d, "documents", "doc_id", "source", "text"))
    return search.term_hits(docs, "text", TERMS).select("query", "doc_id", "source")


@query(
    "term_counts",
    f"with {SQL_HITS} select t as query, count(doc_id) as n from (select unnest([{SQL_TERMS}]) as t) left join hits on query = t group by t",
)
def term_counts(spark, d):
    return search.term_counts(spread(table(spark, d, "documents", "text")), "text", TERMS)


@query(
    "merge_distinct",
    f"with {SQL_HITS} select query || ':' || source as name from hits union select p_brand || ':' || p_name from part",
)
def merge_distinct(spark, d):
    hits = term_search(spark, d).select(F.concat_ws(":", "query", "source").alias("name"))
    parts = table(spark, d, "part", "p_brand", "p_name").select(F.concat_ws(":", "p_brand", "p_name").alias("name"))
    return hits.unionByName(parts).distinct()


@query(
    "union_pages",
    """
    select c_custkey as id, c_name as name, c_mktsegment as segment, null as nation from customer
    union all select s_suppkey, s_name, null, s_nationkey from supplier
    """,
)
def union_pages(spark, d):
    one = table(spark, d, "customer").selectExpr("c_custkey as id", "c_name as name", "c_mktsegment as segment")
    two = table(spark, d, "supplier").selectExpr("s_suppkey as id", "s_name as name", "s_nationkey as nation")
    return one.unionByName(two, allowMissingColumns=True)


# --- enrichment ------------------------------------------------------------------------------------


@query(
    "upsert_merge",
    """
    with old as (select s_suppkey as inn, s_name as name, s_nationkey as nation from supplier where s_acctbal > 2000),
    new as (select s_suppkey as inn, case when s_nationkey > 9 then 'New ' || s_name end as name, 'tel ' || s_suppkey as phone
            from supplier where s_acctbal < 7000)
    select inn, coalesce(new.name, old.name) as name, old.nation, new.phone from old full join new using (inn)
    """,
)
def upsert_merge(spark, d):
    supplier = table(spark, d, "supplier")
    old = supplier.filter("s_acctbal > 2000").selectExpr("s_suppkey as inn", "s_name as name", "s_nationkey as nation")
    new = supplier.filter("s_acctbal < 7000").selectExpr(
        "s_suppkey as inn", "case when s_nationkey > 9 then concat('New ', s_name) end as name",
        "concat('tel ', s_suppkey) as phone",
    )
    return enrich.upsert(old, new, "inn")
