"""What is to be fetched: addresses and paths from coordinates, checked against index and inventory."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listprep.functions import text, urls
from listprep.operators.joins import drop_known, join_unique, keep_known

# Public registry addresses the paths are relative to.
MAVEN_BASE = "https://repo1.maven.org/maven2/"
NPM_BASE = "https://registry.npmjs.org"
CRATES_BASE = "https://crates.io/api/v1/crates"


def maven_plan(artifacts: DataFrame, base: str = MAVEN_BASE) -> DataFrame:
    """Five files per artifact version, and one metadata file per artifact (group_id, artifact_id, latest_version in)."""
    g, a, v = F.col("group_id"), F.col("artifact_id"), F.col("latest_version")
    suffixes = F.explode(F.lit(list(urls.ARTIFACT_SUFFIXES))).alias("suffix")
    files = artifacts.select(g, a, v.alias("version"), suffixes).select(
        "group_id", "artifact_id", "version", "suffix",
        F.concat_ws(
            "/", urls.artifact_folder(g, a, F.col("version")), urls.artifact_file(a, F.col("version"), F.col("suffix"))
        ).alias("_rel"),
    )
    metadata = artifacts.select(g, a).distinct().select(
        "group_id", "artifact_id", F.lit(None).cast("string").alias("version"), F.lit("metadata").alias("suffix"),
        F.concat_ws("/", urls.dotted_path(g), a, F.lit(urls.ARTIFACT_METADATA)).alias("_rel"),
    )
    return files.unionByName(metadata).select(
        "group_id", "artifact_id", "version", "suffix",
        F.concat(F.lit(base), F.col("_rel")).alias("url"),
        text.safe_path(F.concat(F.lit("maven2/"), F.col("_rel"))).alias("path"),
    )


def crate_plan(pairs: DataFrame, base: str = CRATES_BASE) -> DataFrame:
    """Address and path per (pkg, version)."""
    p, v = F.col("pkg"), F.col("version")
    return pairs.select(
        "pkg", "version",
        F.concat_ws("/", F.lit(base), p, v, F.lit("download")).alias("url"),
        F.concat_ws("/", F.lit("crates"), p, v, F.concat(p, F.lit("-"), v, F.lit(".crate"))).alias("path"),
    )


def npm_plan(pairs: DataFrame, have: DataFrame | None = None, base: str = NPM_BASE, scoped: str = "as_written") -> DataFrame:
    """Address and path per (pkg, version), without those in ``have`` (path).

    ``as_written`` repeats a scoped name in full in the file name, as the registry does not;
    ``registry`` uses the part after the scope in the address.
    """
    if scoped not in ("as_written", "registry"):
        raise ValueError(f"unknown mode {scoped!r}")
    p, v = F.col("pkg"), F.col("version")
    name = p if scoped == "as_written" else F.regexp_replace(p, "^@[^/]*/", "")
    plan = pairs.select(
        "pkg", "version",
        F.concat(F.lit(base + "/"), p, F.lit("/-/"), name, F.lit("-"), v, F.lit(".tgz")).alias("url"),
        F.concat(p, F.lit("/"), p, F.lit("-"), v, F.lit(".tgz")).alias("path"),
    )
    return plan if have is None else drop_known(plan, have, ["path"])


def present_in_index(plan: DataFrame, index: DataFrame) -> DataFrame:
    """Planned files the remote side has."""
    return keep_known(plan, index, ["path"])


def fetch_state(plan: DataFrame, index: DataFrame, inventory: DataFrame) -> DataFrame:
    """State of each planned file against remote size and local size (path, size; of a repeated path the largest).

    missing: not on the remote side; full: nothing local; complete: sizes equal; resume: the local
    file is shorter, go on at its end; oversize: the local file is longer, fetch again.
    """
    remote = index.groupBy("path").agg(F.max("size").alias("remote_size"))
    local = inventory.groupBy("path").agg(F.max("size").alias("local_size"))
    joined = plan.join(remote, "path", "left").join(local, "path", "left")
    r, have = F.col("remote_size"), F.col("local_size")
    state = (
        F.when(r.isNull(), "missing")
        .when(have.isNull(), "full")
        .when(have == r, "complete")
        .when(have < r, "resume")
        .otherwise("oversize")
    )
    return joined.withColumn("state", state).withColumn(
        "resume_from",
        F.when(F.col("state") == "resume", have).when(F.col("state").isin("full", "oversize"), F.lit(0)).cast("long"),
    )


def complete_artifacts(artifacts: DataFrame, inventory: DataFrame) -> DataFrame:
    """Adds ``complete``: both the jar and the pom are there.

    The inventory is cut down to jar and pom files and folded to one row per version folder before the join.
    """
    file_parts = r"^maven2/(.+)/[^/]+(\.jar|\.pom)$"
    own = F.col("path").rlike(file_parts) & ~F.col("path").rlike(r"-(sources|javadoc)\.jar$")
    folders = (
        inventory.filter(own)
        .groupBy(F.regexp_extract("path", file_parts, 1).alias("_folder"))
        .agg(
            F.bool_or(F.col("path").endswith(".jar")).alias("_jar"),
            F.bool_or(F.col("path").endswith(".pom")).alias("_pom"),
        )
    )
    folder = text.safe_path(urls.artifact_folder(F.col("group_id"), F.col("artifact_id"), F.col("latest_version")))
    return (
        join_unique(artifacts.withColumn("_folder", folder), folders, ["_folder"], "left")
        .withColumn("complete", F.coalesce(F.col("_jar") & F.col("_pom"), F.lit(False)))
        .drop("_folder", "_jar", "_pom")
    )
