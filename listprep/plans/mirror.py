"""Package mirrors: versions worth keeping, minus what is there, as addresses and paths."""

from __future__ import annotations

from pyspark.sql import DataFrame

from listprep.operators import fetchplan, joins, membership, packages

COORDS = ("group_id", "artifact_id")


def artifact_mirror(artifacts: DataFrame, listing: DataFrame, index: DataFrame, inventory: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(change report, fetch state of every file of the current versions).

    artifacts: group_id, artifact_id, latest_version.  listing: group_id, artifact_id, version.
    index and inventory: path, size."""
    latest = packages.latest_version(listing, COORDS)
    checked = packages.check_versions(artifacts.select(*COORDS, "latest_version").distinct(), latest, COORDS)
    current = checked.select(*COORDS, checked["new_version"].alias("latest_version"))
    state = fetchplan.fetch_state(fetchplan.maven_plan(current), index, inventory)
    return packages.version_changes(checked, COORDS), state


def package_mirror(
    versions: DataFrame, have: DataFrame, keep: int = 20, scoped: str = "as_written"
) -> tuple[DataFrame, DataFrame]:
    """(files of the ``keep`` highest versions per package (pkg, version) not in ``have`` (path), versions set aside
    as they have no order)."""
    ranked, invalid = packages.ranked_versions(versions, keep)
    return fetchplan.npm_plan(ranked, have, scoped=scoped), invalid


def crate_mirror(fresh: DataFrame, known: DataFrame, versions: DataFrame, done: DataFrame, keep: int = 3) -> DataFrame:
    """Files of the first ``keep`` versions of crates not known yet, without finished pairs.

    fresh, known: pkg.  versions: pkg, version, pos.  done: pkg, version."""
    wanted = membership.without_known(fresh.select("pkg").distinct(), known, ["pkg"])
    listed = packages.head_versions(joins.keep_known(versions, wanted, ["pkg"]), keep)
    return fetchplan.crate_plan(membership.without_known(listed, done, ["pkg", "version"]))
