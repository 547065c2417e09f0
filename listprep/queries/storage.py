"""Queries: files written and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from listprep.operators import numbering
from listprep.queries.lists import SQL_HITS, playlist_items, term_search
from listprep.queries.packages import SQL_LISTING, counts, version_changes
from listprep.queries.registry import money, query, table
from listprep.queries.texts import SQL_CONTROL, SQL_DIRTY, dirty
from listprep.session import work_dir
from listprep.sinks import writers
from listprep.sources import readers


def array_files(spark, d, folder):
    """Parts as files of JSON arrays, 50 items each, and one unreadable file."""
    chunk = F.call_function("div", F.col("p_partkey"), F.lit(50)).alias("chunk")
    item = F.struct(F.col("p_partkey").alias("id"), F.col("p_name").alias("title"), F.concat(F.lit("/"), text_key()).alias("url"))
    arrays = table(spark, d, "part", "p_partkey", "p_name").groupBy(chunk).agg(F.collect_list(item).alias("items"))
    arrays.select("chunk", F.to_json("items").alias("value")).write.partitionBy("chunk").text(folder)
    return f"{folder}/chunk=*"


def text_key():
    return F.col("p_partkey").cast("string")


@query("src_csv_links", "select url as link from pages")
def src_csv_links(spark, d):
    path = work_dir(spark, "csv")
    writers.write_csv(table(spark, d, "pages", "url", "page_id"), path)
    return readers.csv_links(spark, path)


@query(
    "src_json_links",
    "select p_name as title, '/' || p_partkey as url from part union all select 'unreadable', '{\"title\": \"x\"'",
)
def src_json_links(spark, d):
    path = work_dir(spark, "json")
    files = array_files(spark, d, path)
    table(spark, d, "region").limit(1).select(F.lit('{"title": "x"').alias("value")).write.text(f"{path}/chunk=bad")
    good, bad = readers.json_links(spark, files)
    return good.drop("pos").unionByName(bad.select(F.lit("unreadable").alias("title"), F.rtrim("text", F.lit("\n")).alias("url")))


@query("src_glob_pages", "select p_partkey as id, p_name as title from part")
def src_glob_pages(spark, d):
    files = array_files(spark, d, work_dir(spark, "pages"))
    return readers.page_files(spark, files, "id bigint, title string")


@query(
    "src_lines",
    """
    select trim(line) as line from (select unnest(string_split(replace(text, '. ', chr(10) || '  ' || chr(10)), chr(10))) as line from documents)
    where trim(line) <> ''
    """,
)
def src_lines(spark, d):
    path = work_dir(spark, "lines")
    body = F.replace("text", F.lit(". "), F.lit("\n  \n"))
    table(spark, d, "documents", "text").select(body.alias("value")).write.text(path)
    return readers.lines(spark, path)


@query(
    "snk_csv",
    f"with {SQL_DIRTY} select cast(doc_id as varchar) as doc_id, {SQL_CONTROL} as text, lang from dirty",
)
def snk_csv(spark, d):
    path = work_dir(spark, "export")
    writers.export_table(dirty(spark, d).select("doc_id", "text", "lang"), path)
    return spark.read.options(header=True, escape='"').csv(path)


@query(
    "snk_partitioned",
    "select o_orderkey, o_orderstatus as list, cast(cast(o_totalprice as decimal(15,2)) as varchar) as price from orders",
)
def snk_partitioned(spark, d):
    path = work_dir(spark, "records")
    orders = table(spark, d, "orders").select(
        "o_orderkey", F.col("o_orderstatus").alias("list"), money(F.col("o_totalprice")).alias("price")
    )
    writers.write_records(orders, path)
    return spark.read.schema("o_orderkey bigint, price string, list string").json(path)


@query(
    "snk_pages",
    """
    with p as (select cast((row_number() over (order by c_custkey) - 1) // 100 as int) as page from customer)
    select page, count(*) as n, cast(1 as bigint) as files from p group by page
    """,
)
def snk_pages(spark, d):
    path = work_dir(spark, "paged")
    writers.write_pages(numbering.paginate(table(spark, d, "customer", "c_custkey", "c_name"), "c_custkey", 100), path)
    stored = spark.read.schema("c_custkey bigint, c_name string, page int").json(path)
    named = stored.select("page", F.col("_metadata.file_path").alias("file"))
    return named.groupBy("page").agg(F.count("*").alias("n"), F.countDistinct("file").alias("files"))


@query(
    "snk_text",
    """
    select distinct 'PL' || l_suppkey as playlist, '/watch?v=' || l_partkey || '&list=' || l_suppkey as url
    from lineitem where l_linenumber not in (2, 7)
    """,
)
def snk_text(spark, d):
    from listprep.operators.filters import video_links

    path = work_dir(spark, "playlists")
    writers.write_playlists(video_links(playlist_items(spark, d)).withColumnRenamed("href", "url"), path)
    return spark.read.text(path).select("playlist", F.col("value").alias("url"))


@query(
    "snk_report",
    f"""
    with {SQL_LISTING}
    select group_id, artifact_id, latest_version as old_version, latest as new_version
    from artifacts join lexical using (group_id, artifact_id) where latest <> latest_version
    """,
)
def snk_report(spark, d):
    path = work_dir(spark, "report")
    changes = version_changes(spark, d)
    if not writers.write_report(changes, path):
        return changes
    return spark.read.schema(changes.schema).json(path)


@query(
    "save_list",
    """
    select c_custkey as id, c_name as url from customer
    """,
)
def save_list(spark, d):
    """Saved three times over: two overlapping parts and a repeat; the stored list holds each row once."""
    path = work_dir(spark, "saved")
    items = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("url"), "c_acctbal")
    for part in (items.filter("c_acctbal < 5000"), items.filter("c_acctbal > 1000"), items):
        writers.save_list(part.drop("c_acctbal"), path, mode="continue")
    return spark.read.schema("id bigint, url string").json(path)


def write_named(df, folder):
    """(name, value) rows, few, as files with these names."""
    spark = df.sparkSession
    df.write.partitionBy("name").text(f"{folder}.parts")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    system = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(path(folder))
    for status in system.globStatus(path(f"{folder}.parts/name=*/part-*")):
        name = status.getPath().getParent().getName().removeprefix("name=")
        system.rename(status.getPath(), path(f"{folder}/{name}"))


@query(
    "src_query_files",
    f"""
    with {SQL_HITS}
    select query || '.' || doc_id // 250 as query,
      cast(row_number() over (partition by query, doc_id // 250 order by doc_id) - 1 as int) as pos, source || '/' || doc_id as name
    from hits
    """,
)
def src_query_files(spark, d):
    """Hits of each term for 250 documents at a time, as one file of names each."""
    chunk = F.concat_ws(".", "query", F.call_function("div", F.col("doc_id"), F.lit(250)).cast("string"))
    name = F.concat_ws("/", "source", F.col("doc_id").cast("string"))
    hits = term_search(spark, d).withColumn("name", name).groupBy(chunk.alias("query")).agg(
        F.array_sort(F.collect_list(F.struct("doc_id", "name"))).alias("items")
    )
    path = work_dir(spark, "queries")
    write_named(
        hits.select(F.concat("query", F.lit(readers.QUERY_FILE_SUFFIX)).alias("name"), F.to_json("items.name").alias("value")), path
    )
    return readers.query_files(spark, path)


@query(
    "src_snapshots",
    """
    select strftime(ts, '%Y-%m-%d') as snapshot, event_type || '-h' || hour(ts) as query,
      case when max(value) <= 300 then count(*) filter (value >= 20) end as n
    from events group by 1, 2
    """,
)
def src_snapshots(spark, d):
    """Counts by date as one file per date, one entry per query, failed counts as null."""
    entries = F.map_from_entries(F.collect_list(F.struct("query", "n")))
    files = counts(spark, d).groupBy("snapshot").agg(F.to_json(entries, {"ignoreNullFields": "false"}).alias("value"))
    path = work_dir(spark, "snapshots")
    write_named(files.select(F.concat(F.lit(readers.SNAPSHOT_PREFIX), "snapshot", F.lit(".json")).alias("name"), "value"), path)
    return readers.snapshots(spark, path)
