"""Queries: artifacts, versions, snapshots and fetch plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from listprep.functions import versions
from listprep.operators import fetchplan, filters, numbering, packages, snapshots
from listprep.operators.membership import without_known
from listprep.queries.registry import query, table
from listprep.sources import readers

COORDS = ["group_id", "artifact_id"]

# --- artifacts -------------------------------------------------------------------------------------


def artifact_rows(spark, d):
    """Index rows (many repeat): pos, g, a, latestVersion."""
    return table(spark, d, "part").selectExpr(
        "p_partkey as pos",
        "concat('org.', lower(p_type)) as g",
        "replace(p_name, ' ', '-') as a",
        "concat(p_size, '.', p_partkey % 10) as latestVersion",
    )


SQL_ROWS = """
rows_ as (
  select p_partkey as pos, 'org.' || lower(p_type) as group_id, replace(p_name, ' ', '-') as artifact_id,
         p_size || '.' || (p_partkey % 10) as latest_version from part)
"""
SQL_ARTIFACTS = f"{SQL_ROWS}, artifacts as (select distinct group_id, artifact_id, latest_version from rows_)"


@query("artifact_project", f"with {SQL_ROWS} select group_id, artifact_id, latest_version from rows_")
def artifact_project(spark, d):
    return filters.artifacts_from_docs(artifact_rows(spark, d), F.col("g"), F.col("a"), F.col("latestVersion"))


@query("artifact_dedup", f"with {SQL_ARTIFACTS} select * from artifacts")
def artifact_dedup(spark, d):
    return artifact_project(spark, d).dropDuplicates()


@query("api_unnest", f"with {SQL_ROWS} select pos // 20 as batch, group_id, artifact_id, latest_version from rows_")
def api_unnest(spark, d):
    """Answers of 20 rows each, stored as JSON, taken apart again."""
    rows = artifact_rows(spark, d)
    batch = F.call_function("div", F.col("pos"), F.lit(20)).alias("batch")
    docs = rows.groupBy(batch).agg(F.collect_list(F.struct("g", "a", "latestVersion")).alias("docs"))
    answers = docs.select("batch", F.to_json(F.struct(F.struct("docs").alias("response"))).alias("json"))
    return readers.artifact_docs(answers, "json", "batch")


@query(
    "api_versions",
    """
    select p_partkey, unnest([p_size || '.0', p_size || '.1-beta']) as version, 'keys' as kind from part
    union all
    select p_partkey, unnest(['0.' || p_size, '0.' || p_size || '.1']), 'nums' from part
    """,
)
def api_versions(spark, d):
    """Version names out of package answers: object keys, and numbers in a list."""
    part = table(spark, d, "part", "p_partkey", "p_size")
    keyed = F.format_string('{"versions":{"%d.0":{"x":1},"%d.1-beta":{}}}', "p_size", "p_size")
    listed = F.format_string('{"versions":[{"num":"0.%d"},{"num":"0.%d.1"}]}', "p_size", "p_size")
    one = part.select("p_partkey", F.explode(readers.version_keys(keyed)).alias("version"), F.lit("keys").alias("kind"))
    two = part.select("p_partkey", F.explode(readers.version_nums(listed)).alias("version"), F.lit("nums").alias("kind"))
    return one.unionByName(two)


@query(
    "api_names",
    """
    select p_partkey, p_name as name, 'p' || p_size as extra from part
    union all select p_partkey, p_brand, cast(p_size as varchar) from part
    """,
)
def api_names(spark, d):
    """Names out of listing answers and of search answers."""
    part = table(spark, d, "part", "p_partkey", "p_name", "p_brand", "p_size")
    crates = F.to_json(
        F.struct(
            F.array(F.struct(F.col("p_name").alias("name"))).alias("crates"),
            F.struct(F.concat(F.lit("p"), F.col("p_size").cast("string")).alias("next_page")).alias("meta"),
        )
    )
    found = F.to_json(
        F.struct(
            F.array(F.struct(F.struct(F.col("p_brand").alias("name")).alias("package"))).alias("objects"),
            F.col("p_size").alias("total"),
        )
    )
    one = readers.crate_names(part.select("p_partkey", crates.alias("json")), "json", "p_partkey")
    two = readers.search_names(part.select("p_partkey", found.alias("json")), "json", "p_partkey")
    return one.withColumnRenamed("next_page", "extra").unionByName(
        two.select("p_partkey", "name", F.col("total").cast("string").alias("extra"))
    )


@query(
    "src_progress_map",
    "select p_brand as pkg, unnest([p_size || '.0.0', p_size || '.1.0']) as version from part",
)
def src_progress_map(spark, d):
    size = F.col("p_size").cast("string")
    done = F.create_map("p_brand", F.array(F.concat(size, F.lit(".0.0")), F.concat(size, F.lit(".1.0"))))
    return readers.progress_pairs(table(spark, d, "part").select(F.to_json(done).alias("json")))


# --- versions --------------------------------------------------------------------------------------


def package_versions(spark, d):
    """Versions per supplier, with pre-releases: pkg, version, l_returnflag."""
    return table(spark, d, "lineitem").selectExpr(
        "concat('pkg-', l_suppkey) as pkg",
        "concat(cast(l_quantity as int), '.', l_linenumber, '.', l_partkey % 7,"
        " case when l_returnflag = 'R' then concat('-rc.', l_orderkey % 12) else '' end) as version",
        "l_returnflag",
    )


SQL_VERSIONS = """
v as (
  select distinct 'pkg-' || l_suppkey as pkg, cast(l_quantity as int) as a, l_linenumber as b, l_partkey % 7 as c,
    case when l_returnflag = 'R' then l_orderkey % 12 end as rc,
    cast(l_quantity as int) || '.' || l_linenumber || '.' || (l_partkey % 7)
      || case when l_returnflag = 'R' then '-rc.' || (l_orderkey % 12) else '' end as version
  from lineitem)
"""


def sql_top(n):
    return f"""
    with {SQL_VERSIONS}
    select pkg, version, rank from (
      select *, cast(row_number() over (partition by pkg order by a desc, b desc, c desc, rc is null desc, rc desc) as int) as rank
      from v) where rank <= {n}
    """


@query("top_versions", sql_top(20))
def top_versions(spark, d):
    return packages.top_versions(package_versions(spark, d))


@query("latest_releases", sql_top(2))
def latest_releases(spark, d):
    return packages.top_versions(package_versions(spark, d), n=2)


@query(
    "semver_sort",
    f"""
    with {SQL_VERSIONS}, u as (select distinct version, a, b, c, rc from v)
    select version, row_number() over (order by a, b, c, rc is null, rc) as rn from u
    """,
)
def semver_sort(spark, d):
    unique = package_versions(spark, d).select("version").distinct()
    return numbering.number_rows(unique, packages.semver_order(unique))


@query(
    "head_versions",
    """
    select pkg, version, rank from (
      select p_brand as pkg, p_size || '.' || (p_partkey % 7) as version,
        cast(row_number() over (partition by p_brand order by p_partkey) as int) as rank from part)
    where rank <= 3
    """,
)
def head_versions(spark, d):
    given = table(spark, d, "part").selectExpr(
        "p_brand as pkg", "concat(p_size, '.', p_partkey % 7) as version", "p_partkey as pos"
    )
    return packages.head_versions(given).drop("pos")


@query(
    "pending_versions",
    f"""
    with {SQL_VERSIONS}
    select pkg, version from v where (pkg, version) not in (
      select 'pkg-' || l_suppkey, cast(l_quantity as int) || '.' || l_linenumber || '.' || (l_partkey % 7)
      from lineitem where l_returnflag = 'A')
    """,
)
def pending_versions(spark, d):
    rows = package_versions(spark, d)
    record = F.to_json(F.create_map("pkg", F.array("version")))
    done = readers.progress_pairs(rows.filter("l_returnflag = 'A'").select(record.alias("json")))
    return without_known(rows.select("pkg", "version").distinct(), done, ["pkg", "version"])


def listing(spark, d):
    """Listed versions per part: l_partkey, version (snapshots are not numeric)."""
    return table(spark, d, "lineitem").selectExpr(
        "l_partkey",
        "concat(cast(l_quantity as int), '.', l_linenumber, case when l_returnflag = 'R' then '-SNAPSHOT' else '' end) as version",
    )


def latest(spark, d, order):
    """Latest per artifact.  The big table is folded to one row per part before it meets the parts."""
    per_part = packages.latest_version(listing(spark, d), ["l_partkey"], order=order)
    coords = artifact_rows(spark, d).filter("g <> 'org.small'").select(
        F.col("pos").alias("l_partkey"), F.col("g").alias("group_id"), F.col("a").alias("artifact_id")
    )
    joined = coords.join(per_part, "l_partkey")
    return packages.latest_version(joined.withColumnRenamed("latest", "version"), COORDS, order=order)


SQL_LISTING = f"""
{SQL_ARTIFACTS},
listing as (
  select group_id, artifact_id, cast(l_quantity as int) as a, l_linenumber as b,
    cast(l_quantity as int) || '.' || l_linenumber as version
  from lineitem join rows_ on pos = l_partkey where group_id <> 'org.small' and l_returnflag <> 'R'),
lexical as (select group_id, artifact_id, max(version) as latest from listing group by 1, 2)
"""


@query("latest_lexical", f"with {SQL_LISTING} select * from lexical")
def latest_lexical(spark, d):
    return latest(spark, d, "lexical")


@query(
    "latest_semver",
    f"with {SQL_LISTING} select group_id, artifact_id, arg_max(version, a * 100 + b) as latest from listing group by 1, 2",
)
def latest_semver(spark, d):
    return latest(spark, d, "numeric")


@query(
    "numeric_versions",
    """
    select distinct cast(l_quantity as int) || '.' || l_linenumber || case when l_returnflag = 'R' then '-SNAPSHOT' else '' end as version,
      l_returnflag <> 'R' as numeric
    from lineitem
    """,
)
def numeric_versions(spark, d):
    return listing(spark, d).select("version").distinct().withColumn("numeric", versions.is_numeric(F.col("version")))


def checked(spark, d):
    return packages.check_versions(artifact_dedup(spark, d), latest(spark, d, "lexical"), COORDS)


@query(
    "version_check",
    f"""
    with {SQL_LISTING}
    select group_id, artifact_id, latest_version, coalesce(latest, latest_version) as new_version,
           latest is not null and latest <> latest_version as changed
    from artifacts left join lexical using (group_id, artifact_id)
    """,
)
def version_check(spark, d):
    return checked(spark, d)


@query(
    "version_changes",
    f"""
    with {SQL_LISTING}
    select group_id, artifact_id, latest_version as old_version, latest as new_version
    from artifacts join lexical using (group_id, artifact_id) where latest <> latest_version
    """,
)
def version_changes(spark, d):
    return packages.version_changes(checked(spark, d), COORDS)


# --- snapshots -------------------------------------------------------------------------------------


def counts(spark, d):
    """Dated counts of rarely seen queries, so that some are new, zero or failed."""
    events = table(spark, d, "events", "ts", "event_type", "value")
    return events.groupBy(
        F.date_format("ts", "yyyy-MM-dd").alias("snapshot"),
        F.concat(F.col("event_type"), F.lit("-h"), F.hour("ts").cast("string")).alias("query"),
    ).agg(F.when(F.max("value") <= 300, F.count_if(F.col("value") >= 20)).alias("n"))


@query(
    "snapshot_diff",
    """
    with counts as (
      select strftime(ts, '%Y-%m-%d') as snapshot, event_type || '-h' || hour(ts) as query,
        case when max(value) <= 300 then count(*) filter (value >= 20) end as n
      from events group by 1, 2),
    names as (select distinct snapshot from counts order by 1 desc limit 2),
    cur as (select query, n from counts where snapshot = (select max(snapshot) from names)),
    prev as (select query, n, true as there from counts where snapshot = (select min(snapshot) from names)),
    x as (
      select cur.query, cur.n as c, prev.n as p, cur.n - prev.n as diff,
        case when cur.n is null or (there and prev.n is null) then 'error' when there is null then 'new' else 'changed' end as status
      from cur left join prev using (query)),
    y as (
      select *, (20000 * abs(diff) + p) // nullif(2 * p, 0) as w from x where status <> 'changed' or diff <> 0)
    select query, status, case status when 'error' then 'Ошибка при получении данных' end as message,
      case when status <> 'error' then p end as previous, case when status <> 'error' then c end as current,
      case when status = 'changed' then diff end as diff,
      case when status = 'changed' then case when diff < 0 then '-' else '' end || w // 100 || '.' || lpad(cast(w % 100 as varchar), 2, '0') end as percentage
    from y order by status = 'error', abs(diff) desc, query
    """,
)
def snapshot_diff(spark, d):
    return snapshots.snapshot_diff(counts(spark, d))


# --- plans -----------------------------------------------------------------------------------------

SQL_MAVEN = f"""
{SQL_ARTIFACTS},
plan as materialized (
  select group_id, artifact_id, latest_version as version, unnest(['.jar', '.pom', '-sources.jar', '-javadoc.jar', '.module']) as suffix,
    replace(group_id, '.', '/') || '/' || artifact_id || '/' || latest_version || '/' || artifact_id || '-' || latest_version || suffix as rel
  from artifacts
  union all
  select distinct group_id, artifact_id, null, 'metadata', replace(group_id, '.', '/') || '/' || artifact_id || '/maven-metadata.xml'
  from artifacts)
"""

# what the index and the inventory hold of a plan row, without joining the plan with itself
SQL_REMOTE = """
  case when suffix in ('.jar', '.pom', 'metadata') or group_id = 'org.promo' then cast(length(rel) * 100 as bigint) end"""
SQL_LOCAL = """
  case when (suffix <> 'metadata' and group_id in ('org.promo', 'org.large')) or (suffix = '.jar' and group_id = 'org.medium')
    then cast(case suffix when '.pom' then length(rel) * 50 when '-javadoc.jar' then length(rel) * 100 + 1 else length(rel) * 100 end as bigint) end"""


@query(
    "maven_plan",
    f"with {SQL_MAVEN} select group_id, artifact_id, version, suffix, 'https://repo1.maven.org/maven2/' || rel as url, 'maven2/' || rel as path from plan",
)
def maven_plan(spark, d):
    return fetchplan.maven_plan(artifact_dedup(spark, d))


def remote_index(spark, d):
    held = F.col("suffix").isin(".jar", ".pom", "metadata") | (F.col("group_id") == "org.promo")
    return maven_plan(spark, d).filter(held).select("path", ((F.length("path") - 7) * 100).cast("long").alias("size"))


def local_inventory(spark, d):
    full = (F.length("path") - 7) * 100
    size = F.when(F.col("suffix") == ".pom", (F.length("path") - 7) * 50)
    size = size.when(F.col("suffix") == "-javadoc.jar", full + 1).otherwise(full)
    held = ((F.col("suffix") != "metadata") & F.col("group_id").isin("org.promo", "org.large")) | (
        (F.col("suffix") == ".jar") & (F.col("group_id") == "org.medium")
    )
    return maven_plan(spark, d).filter(held).select("path", size.cast("long").alias("size"))


@query(
    "fetch_plan",
    f"with {SQL_MAVEN} select group_id, artifact_id, version, suffix, 'maven2/' || rel as path from plan where ({SQL_REMOTE}) is not null",
)
def fetch_plan(spark, d):
    return fetchplan.present_in_index(maven_plan(spark, d), remote_index(spark, d)).drop("url")


@query(
    "fetch_state",
    f"""
    with {SQL_MAVEN}, j as (select 'maven2/' || rel as path, {SQL_REMOTE} as remote_size, {SQL_LOCAL} as local_size from plan)
    select *, case when remote_size is null then 'missing' when local_size is null then 'full' when local_size = remote_size then 'complete'
        when local_size < remote_size then 'resume' else 'oversize' end as state,
      case when remote_size is null then null when local_size is null or local_size > remote_size then 0
        when local_size < remote_size then local_size end as resume_from
    from j
    """,
)
def fetch_state(spark, d):
    plan = maven_plan(spark, d).select("path")
    return fetchplan.fetch_state(plan, remote_index(spark, d), local_inventory(spark, d))


@query(
    "artifact_complete",
    f"with {SQL_MAVEN} select *, group_id in ('org.promo', 'org.large') as complete from artifacts",
)
def artifact_complete(spark, d):
    return fetchplan.complete_artifacts(artifact_dedup(spark, d), local_inventory(spark, d))


SQL_PAIRS = """
pairs as (
  select distinct case p_type when 'PROMO' then '@' || lower(p_type) || '/' else '' end || replace(p_name, ' ', '-') as pkg,
    p_size || '.0.' || (p_partkey % 10) as version from part)
"""


def pairs(spark, d):
    return (
        table(spark, d, "part")
        .selectExpr(
            "concat(case when p_type = 'PROMO' then '@promo/' else '' end, replace(p_name, ' ', '-')) as pkg",
            "concat(p_size, '.0.', p_partkey % 10) as version",
        )
        .distinct()
    )


@query(
    "crate_plan",
    f"""
    with {SQL_PAIRS}
    select pkg, version, 'https://crates.io/api/v1/crates/' || pkg || '/' || version || '/download' as url,
      'crates/' || pkg || '/' || version || '/' || pkg || '-' || version || '.crate' as path from pairs
    """,
)
def crate_plan(spark, d):
    return fetchplan.crate_plan(pairs(spark, d))


@query(
    "npm_plan",
    f"""
    with {SQL_PAIRS}
    select pkg, version, 'https://registry.npmjs.org/' || pkg || '/-/' || pkg || '-' || version || '.tgz' as url,
      pkg || '/' || pkg || '-' || version || '.tgz' as path, 'as_written' as mode
    from pairs where version not like '%.0.7'
    union all
    select pkg, version, 'https://registry.npmjs.org/' || pkg || '/-/' || regexp_replace(pkg, '^@[^/]*/', '') || '-' || version || '.tgz',
      pkg || '/' || pkg || '-' || version || '.tgz', 'registry'
    from pairs
    """,
)
def npm_plan(spark, d):
    wanted = pairs(spark, d)
    have = fetchplan.npm_plan(wanted.filter(F.col("version").endswith(".0.7"))).select("path")
    plain = fetchplan.npm_plan(wanted, have).withColumn("mode", F.lit("as_written"))
    return plain.unionByName(fetchplan.npm_plan(wanted, scoped="registry").withColumn("mode", F.lit("registry")))
