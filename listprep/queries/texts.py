"""Queries: text cleaning, names, addresses, transcripts."""

from __future__ import annotations

from pyspark.sql import functions as F

from listprep.functions import text, times, urls
from listprep.operators import reconcile
from listprep.queries.lists import LINES, SQL_LINES, line_links, sql_basic_title, sql_old_title, sql_safe_title
from listprep.queries.registry import SQL_WS, query, spread, sql_strip, table


def dirty(spark, d):
    """Documents with control characters and odd blanks put in."""
    mixed = F.replace("text", F.lit(". "), F.lit(".\t\u0085\u0001  \n"))
    docs = spread(table(spark, d, "documents", "doc_id", "text", "lang"))
    return docs.select("doc_id", "lang", mixed.alias("text"))


SQL_DIRTY = """
dirty as (
  select doc_id, lang, replace(text, '. ', '.' || chr(9) || chr(133) || chr(1) || ' ' || chr(160) || chr(10)) as text
  from documents)
"""
SQL_CONTROL = r"regexp_replace(text, '[\x00-\x1F\x{7F}-\x{9F}]', '', 'g')"


@query("clean_control", f"with {SQL_DIRTY} select doc_id, {SQL_CONTROL} as clean from dirty")
def clean_control(spark, d):
    return dirty(spark, d).select("doc_id", text.drop_control(F.col("text")).alias("clean"))


@query("clean_export", f"with {SQL_DIRTY} select doc_id, lang, {SQL_CONTROL} as text from dirty")
def clean_export(spark, d):
    return text.clean_strings(dirty(spark, d))


@query(
    "collapse_ws",
    f"with {SQL_DIRTY} select doc_id, trim(regexp_replace(text, '{SQL_WS}+', ' ', 'g')) as clean from dirty",
)
def collapse_ws(spark, d):
    return dirty(spark, d).select("doc_id", text.collapse_ws(F.col("text")).alias("clean"))


SQL_FORBIDDEN = """'[\\\\/*?:"<>|]'"""


@query(
    "safe_names",
    f"""
    with t as (select page_id, url, ' ' || replace(url, 'example', 'a*b "c"|d') || ' . ' as name from pages),
    s as (select *, {sql_strip(f"regexp_replace(name, {SQL_FORBIDDEN}, '_', 'g')")} as file from t)
    select page_id, translate(name, ':*?"<>|', '_______') as path, file,
      case when length(file) > 30 then regexp_replace(left(file, 30), '[ ._]+$', '') else file end as short,
      list_extract(string_split(url, '/'), -1) as last
    from s
    """,
)
def safe_names(spark, d):
    name = F.concat(F.lit(" "), F.replace("url", F.lit("example"), F.lit('a*b "c"|d')), F.lit(" . "))
    pages = table(spark, d, "pages", "page_id", "url").withColumn("name", name)
    return pages.select(
        "page_id",
        text.safe_path(F.col("name")).alias("path"),
        text.safe_file(F.col("name")).alias("file"),
        text.safe_file(F.col("name"), max_len=30, default="video").alias("short"),
        urls.last_segment(F.col("url")).alias("last"),
    )


@query(
    "safe_titles",
    f"""
    with {SQL_LINES},
    t as (
      select pos as doc_id, title from lines
      union all
      select -1 - page_id, url from pages
      union all
      select -{LINES} - p_partkey, case p_type when 'SMALL' then '«' || p_size || '»' when 'PROMO' then '  '
        when 'LARGE' then '?!' else '№' || p_size || '² ' || p_name end from part)
    select doc_id, {sql_safe_title('title', 'doc_id')} as safe, {sql_old_title('title')} as old,
           {sql_basic_title('title')} as basic
    from t
    """,
)
def safe_titles(spark, d):
    docs = line_links(spark, d).select(F.col("pos").alias("doc_id"), "title")
    pages = table(spark, d, "pages", "page_id", "url").select((-1 - F.col("page_id")).alias("doc_id"), F.col("url").alias("title"))
    size = F.col("p_size").cast("string")
    odd = (
        F.when(F.col("p_type") == "SMALL", F.concat(F.lit("«"), size, F.lit("»")))
        .when(F.col("p_type") == "PROMO", F.lit("  "))
        .when(F.col("p_type") == "LARGE", F.lit("?!"))
        .otherwise(F.concat(F.lit("№"), size, F.lit("² "), "p_name"))
    )
    parts = table(spark, d, "part").select((-LINES - F.col("p_partkey")).alias("doc_id"), odd.alias("title"))
    title = F.col("title")
    return docs.unionByName(pages).unionByName(parts).select(
        "doc_id",
        text.safe_title(title, F.col("doc_id")).alias("safe"),
        text.old_title(title).alias("old"),
        text.basic_title(title).alias("basic"),
    )


@query(
    "camel_keys",
    r"""
    with k as (
      select p_partkey, upper(left(p_type, 1)) || lower(substr(p_type, 2)) || 'Of'
        || upper(left(p_name, 1)) || substr(split_part(p_name, ' ', 1), 2)
        || upper(left(split_part(p_name, ' ', 2), 1)) || substr(split_part(p_name, ' ', 2), 2) || 'Status' as key
      from part)
    select p_partkey, key, trim(regexp_replace(replace(replace(key, 'Of', ' of '), 'Status', ' Status'), '([A-Z])', ' \1', 'g')) as words
    from k
    """,
)
def camel_keys(spark, d):
    key = F.concat(F.initcap("p_type"), F.lit("Of"), F.replace(F.initcap("p_name"), F.lit(" "), F.lit("")), F.lit("Status"))
    parts = table(spark, d, "part", "p_partkey", "p_type", "p_name").select("p_partkey", key.alias("key"))
    return parts.withColumn("words", text.split_camel(F.col("key")))


# --- transcripts -----------------------------------------------------------------------------------


def transcripts(spark, d):
    """One transcript per turn, with time codes of all shapes put in."""
    turn = F.col("turn").cast("string")
    body = F.replace("text", F.lit("\n"), F.lit("\n  0:15 "))
    coded = F.concat(
        F.lit("0:0"), turn, F.lit("\n1:2"), turn, F.lit("  "), body, F.lit("\n\n   \n1:02:03 \n3:07 end ")
    )
    raw = (
        F.when(F.length("text") < 80, F.lit("0:12\n 1:02:03 \n\n"))
        .when((F.col("role") == "assistant") & (F.length("text") > 1500), F.lit(None))
        .otherwise(coded)
    )
    return spread(table(spark, d, "conversations")).select("conv_id", "turn", raw.alias("raw"))


SQL_TRANSCRIPTS = f"""
raws as (
  select conv_id, turn, case when length(text) < 80 then '0:12' || chr(10) || ' 1:02:03 ' || chr(10) || chr(10)
    when role = 'assistant' and length(text) > 1500 then null
    else '0:0' || turn || chr(10) || '1:2' || turn || chr(160) || ' ' || replace(text, chr(10), chr(10) || '  0:15 ')
      || chr(10) || chr(10) || '   ' || chr(10) || '1:02:03 ' || chr(10) || '3:07 end ' end as raw
  from conversations),
cleaned as (
  select conv_id, turn, raw, array_to_string(list_filter(list_transform(list_filter(string_split(raw, chr(10)),
      lambda x: not regexp_full_match({sql_strip('x')}, '[0-9]+:[0-9]+(:[0-9]+)?')),
      lambda x: {sql_strip(f"regexp_replace(x, '^[0-9]+:[0-9]+(:[0-9]+)?{SQL_WS}+', '')")}), lambda x: x <> ''), chr(10)) as clean
  from raws)
"""


@query("transcript_clean", f"with {SQL_TRANSCRIPTS} select conv_id, turn, clean from cleaned")
def transcript_clean(spark, d):
    return transcripts(spark, d).select("conv_id", "turn", text.drop_time_codes(F.col("raw")).alias("clean"))


def outcomes(df):
    clean = text.drop_time_codes(F.col("raw"))
    status = F.when(F.col("raw").isNull(), "failed").when(clean == "", "no_transcript").otherwise("successful")
    return df.select("conv_id", "turn", status.alias("status"))


@query(
    "outcome_tally",
    f"""
    with {SQL_TRANSCRIPTS}
    select count(*) filter (clean <> '') as successful, count(*) filter (clean = '') as no_transcript,
           count(*) filter (raw is null) as failed, count(*) as total from cleaned
    """,
)
def outcome_tally(spark, d):
    return reconcile.outcome_tally(outcomes(transcripts(spark, d)))


@query(
    "title_fallback",
    f"""
    with t as (
      select page_id, url, case when length(url) % 3 = 0 then ' ' else ' T' || page_id || ' ' end as element,
        case when length(url) % 2 = 0 then ' ' || url || ' - Channel YouTube' else ' ' end as win from pages)
    select page_id, coalesce(nullif(trim(element), ''), nullif(trim(split_part(win, ' - ', 1)), ''), sha256(url)) as title,
      coalesce(nullif(case when win like '% - %' then trim(replace(split_part(win, ' - ', 2), 'YouTube', '')) end, ''),
               sha256(url)) as channel
    from t
    """,
)
def title_fallback(spark, d):
    pages = table(spark, d, "pages", "page_id", "url")
    element = F.when(F.length("url") % 3 == 0, " ").otherwise(
        F.concat(F.lit(" T"), F.col("page_id").cast("string"), F.lit(" "))
    )
    window = F.when(F.length("url") % 2 == 0, F.concat(F.lit(" "), "url", F.lit(" - Channel YouTube"))).otherwise(" ")
    return pages.select(
        "page_id",
        text.title_or(element, window, F.col("url")).alias("title"),
        text.channel_or(F.lit(""), window, F.col("url")).alias("channel"),
    )


@query(
    "iso_times",
    r"""
    select event_id, strftime(ts, '%Y-%m-%d') as day, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') as moment from events
    union all
    select -1 - o_orderkey, strftime(o_orderdate, '%Y-%m-%d'), strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') from orders
    """,
)
def iso_times(spark, d):
    events = table(spark, d, "events", "event_id", "ts")
    orders = table(spark, d, "orders").select((-1 - F.col("o_orderkey")).alias("event_id"), F.col("o_orderdate").alias("ts"))
    both = events.unionByName(orders)
    return both.select("event_id", times.iso_date(F.col("ts")).alias("day"), times.iso_datetime(F.col("ts")).alias("moment"))


# --- addresses -------------------------------------------------------------------------------------

HREFS = ["/a", "b", "?q=1", "#f", "//h/x", "https://h/x", "", "c/d?e=1#g", "/a?b=/c"]


@query(
    "absolute_urls",
    f"""
    with x as (
      select page_id, url as base, unnest({HREFS}) as href from pages),
    y as (
      select *, regexp_extract(base, '^([^:/?#]+://[^/?#]*)', 1) as site,
        regexp_extract(base, '^[^:/?#]+://[^/?#]*(/[^?#]*)', 1) as path from x)
    select page_id, href,
      case when href = '' then base when href like 'https:%' then href
        when href like '//%' then split_part(base, ':', 1) || ':' || href
        when href like '/%' then site || href
        when href like '?%' then regexp_replace(base, '[?#].*', '') || href
        when href like '#%' then regexp_replace(base, '#.*', '') || href
        else site || regexp_replace(path, '[^/]*$', '') || href end as url,
      regexp_replace(base, '^[a-z]+://', 'ftp://') as swapped
    from y
    """,
)
def absolute_urls(spark, d):
    pages = table(spark, d, "pages", "page_id", "url").select(
        "page_id", F.col("url").alias("base"), F.explode(F.lit(HREFS)).alias("href")
    )
    return pages.select(
        "page_id",
        "href",
        urls.absolute_url(F.col("base"), F.col("href")).alias("url"),
        urls.with_scheme(F.col("base"), "ftp").alias("swapped"),
    )


@query(
    "page_urls",
    """
    select page_id, n, regexp_replace(url, 'page=[0-9]+', 'page=' || n) as url,
           'https://search.example/v1?text=' || page_id || '&size=250&from=' || (n - 1) * 250 as search
    from pages, (select unnest([1, 2, 3]) as n)
    """,
)
def page_urls(spark, d):
    listing = table(spark, d, "pages", "page_id", "url")
    numbered = listing.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(3))))
    search = urls.search_url("https://search.example/v1", F.col("page_id").cast("string"), 250, (F.col("n") - 1) * 250)
    return numbered.select(
        "page_id", "n", urls.page_url(F.col("url"), F.col("n"), key="page").alias("url"), search.alias("search")
    )
