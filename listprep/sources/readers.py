"""Readers.  JSON arrays in one file are read by one task each; many files are read in parallel."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listprep.functions.text import strip_ws

LINK_SCHEMA = "title string, url string"
# The columns of the crate table export.
CRATE_SCHEMA = (
    "id bigint, name string, updated_at timestamp, created_at timestamp, description string, "
    "homepage string, repository string, readme string, documentation string"
)
QUERY_FILE_SUFFIX = "-packages.json"
SNAPSHOT_PREFIX = "package-counts-"


def csv_links(spark: SparkSession, path: str) -> DataFrame:
    """First column of a CSV list with a header."""
    return spark.read.schema("link string").option("header", True).option("escape", '"').csv(path)


def json_links(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(items with a url, unreadable texts) of JSON list files; a missing file is an empty list.

    An item that is no object or has no url is left out; a text that is no list is unreadable."""
    try:
        files = spark.read.text(path, wholetext=True)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        files = spark.createDataFrame([], "value string")
    is_list = F.coalesce(F.json_array_length("value").isNotNull(), F.lit(False))
    items = files.filter(is_list).select(F.posexplode(F.from_json("value", "array<string>")).alias("pos", "item"))
    good = items.withColumn("item", F.from_json("item", LINK_SCHEMA)).select("pos", "item.title", "item.url")
    return good.filter("url is not null"), files.filter(~is_list).select(F.col("value").alias("text"))


def page_files(spark: SparkSession, pattern: str, schema: str = CRATE_SCHEMA) -> DataFrame:
    """All rows of many page files (JSON arrays); nothing is removed."""
    return spark.read.schema(schema).option("multiLine", True).json(pattern)


def stored_pages(spark: SparkSession, path: str, suffix: str = ".html") -> DataFrame:
    """(url, html) of stored page files, one page per file."""
    files = spark.read.text(path, wholetext=True, pathGlobFilter=f"*{suffix}")
    return files.select(F.col("_metadata.file_path").alias("url"), F.col("value").alias("html"))


def query_files(spark: SparkSession, folder: str) -> DataFrame:
    """(query, pos, name) of search result files, each a JSON array of names."""
    files = spark.read.text(folder, wholetext=True, pathGlobFilter=f"*{QUERY_FILE_SUFFIX}")
    query = F.regexp_extract("_metadata.file_name", rf"^(.*){QUERY_FILE_SUFFIX}$", 1)
    return files.select(query.alias("query"), F.posexplode(F.from_json("value", "array<string>")).alias("pos", "name"))


def snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """(snapshot, query, n) of dated count files; the date is in the file name, NULL counts are kept."""
    files = spark.read.text(folder, wholetext=True, pathGlobFilter=f"{SNAPSHOT_PREFIX}*")
    date = F.regexp_extract("_metadata.file_name", rf"{SNAPSHOT_PREFIX}(.*)\.json", 1)
    return files.select(
        date.alias("snapshot"), F.explode(F.from_json("value", "map<string,bigint>")).alias("query", "n")
    )


def progress_pairs(progress: DataFrame, json: str = "json") -> DataFrame:
    """(pkg, version) of download progress maps name → versions."""
    by_name = progress.select(F.explode(F.from_json(json, "map<string,array<string>>")).alias("pkg", "versions"))
    return by_name.select("pkg", F.explode("versions").alias("version"))


def lines(spark: SparkSession, path: str) -> DataFrame:
    """Non-blank lines of a text file, blanks cut."""
    return spark.read.text(path).select(strip_ws(F.col("value")).alias("line")).filter("line <> ''")


def table_by_key(
    spark: SparkSession, url: str, table: str, key: str, lower: int, upper: int, partitions: int, **options: str
) -> DataFrame:
    """A database table read in key ranges, one range per task."""
    return spark.read.jdbc(
        url, table, column=key, lowerBound=lower, upperBound=upper, numPartitions=partitions, properties=options
    )


# --- stored API answers ----------------------------------------------------------------------------


def artifact_docs(df: DataFrame, json: str, *keep: str) -> DataFrame:
    """(group_id, artifact_id, latest_version) of search answers ``response.docs[]``."""
    answer = F.from_json(json, "response struct<docs:array<struct<g:string,a:string,latestVersion:string>>>")
    return df.select(*keep, F.inline(answer["response"]["docs"])).select(
        *keep, F.col("g").alias("group_id"), F.col("a").alias("artifact_id"), F.col("latestVersion").alias("latest_version")
    )


def crate_names(df: DataFrame, json: str, *keep: str) -> DataFrame:
    """(name, next_page) of listing answers ``crates[]`` with ``meta.next_page``."""
    answer = F.from_json(json, "crates array<struct<name:string>>, meta struct<next_page:string>")
    return df.select(*keep, answer.alias("_a")).select(
        *keep, F.explode("_a.crates.name").alias("name"), F.col("_a.meta.next_page").alias("next_page")
    )


def search_names(df: DataFrame, json: str, *keep: str) -> DataFrame:
    """(name, total) of search answers ``objects[].package.name`` with ``total``."""
    answer = F.from_json(json, "objects array<struct<package:struct<name:string>>>, total bigint")
    return df.select(*keep, answer.alias("_a")).select(
        *keep, F.explode("_a.objects.package.name").alias("name"), F.col("_a.total").alias("total")
    )


def version_keys(json: Column) -> Column:
    """Version names of a package answer whose ``versions`` object has them as keys."""
    return F.map_keys(F.from_json(json, "versions map<string,string>")["versions"])


def version_nums(json: Column) -> Column:
    """Version names of a crate answer ``versions[].num``, in the given order."""
    return F.from_json(json, "versions array<struct<num:string>>")["versions"]["num"]
