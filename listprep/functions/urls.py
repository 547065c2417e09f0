"""URLs and repository paths, as native expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from listprep.functions.text import safe_path

SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:"


def _no_dots(path: Column) -> Column:
    """``.`` and ``..`` segments of an absolute path resolved."""
    segments = F.split(path, "/")
    kept = F.aggregate(
        segments,
        F.slice(segments, 1, 0),
        lambda acc, s: F.when(s == ".", acc)
        .when(s == "..", F.when(F.size(acc) > 1, F.slice(acc, 1, F.size(acc) - 1)).otherwise(acc))
        .otherwise(F.concat(acc, F.array(s))),
    )
    tail = F.when(F.element_at(segments, -1).isin(".", ".."), "/").otherwise("")
    return F.concat(F.array_join(kept, "/"), tail)


def absolute_url(base: Column, href: Column) -> Column:
    """A link as seen on page ``base``, made absolute."""
    scheme = F.regexp_extract(base, r"^([^:/?#]+:)", 1)
    site = F.regexp_extract(base, r"^([^:/?#]+://[^/?#]*)", 1)
    no_fragment = F.regexp_replace(base, r"#.*", "")
    no_query = F.regexp_replace(base, r"[?#].*", "")
    path = F.regexp_extract(base, r"^[^:/?#]+://[^/?#]*(/[^?#]*)", 1)
    folder = F.regexp_replace(F.when(path == "", "/").otherwise(path), r"[^/]*$", "")
    link_path = F.regexp_extract(href, r"^([^?#]*)", 1)
    link_tail = F.regexp_extract(href, r"^[^?#]*(.*)$", 1)
    rooted = F.when(href.startswith("/"), link_path).otherwise(F.concat(folder, link_path))
    plain = F.when(rooted.rlike(r"/\.\.?(/|$)"), _no_dots(rooted)).otherwise(rooted)
    return (
        F.when(href == "", base)
        .when(href.rlike(SCHEME), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(href.startswith("?"), F.concat(no_query, href))
        .when(href.startswith("#"), F.concat(no_fragment, href))
        .otherwise(F.concat(site, plain, link_tail))
    )


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[^:/?#]+://([^/?#]*)", 1))


def with_scheme(url: Column, scheme: str) -> Column:
    """Scheme replaced, rest unchanged."""
    return F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://", f"{scheme}://")


def local_path(url: Column) -> Column:
    """``file://`` cut off; other urls unchanged."""
    return F.regexp_replace(url, r"^file://", "")


def page_url(template: Column, number: Column, key: str = "pageNumber") -> Column:
    """The ``key=<digits>`` part of a listing address set to a page number."""
    return F.regexp_replace(template, F.lit(rf"{key}=[0-9]+"), F.concat(F.lit(f"{key}="), number.cast("string")))


def search_url(base: str, text: Column, size: int, start: Column) -> Column:
    """Address of one page of search results."""
    return F.concat(
        F.lit(f"{base}?text="), text, F.lit(f"&size={size}&from="), start.cast("string")
    )


def last_segment(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def dotted_path(group: Column) -> Column:
    return F.replace(group, F.lit("."), F.lit("/"))


# Files of one artifact version, as suffixes of its file name, and its metadata file.
ARTIFACT_SUFFIXES = (".jar", ".pom", "-sources.jar", "-javadoc.jar", ".module")
ARTIFACT_METADATA = "maven-metadata.xml"


def artifact_file(artifact: Column, version: Column, suffix: Column) -> Column:
    return safe_path(F.concat(artifact, F.lit("-"), safe_path(version), suffix))


def artifact_folder(group: Column, artifact: Column, version: Column) -> Column:
    return F.concat_ws("/", dotted_path(group), artifact, safe_path(version))


def glob_regex(pattern: str) -> str:
    """``*`` and ``?`` patterns in which ``*`` also crosses ``/``."""
    return "^(?s:" + re.escape(pattern).replace(r"\*", ".*").replace(r"\?", ".") + ")$"


def any_glob(path: Column, patterns: Sequence[str]) -> Column:
    """True where one of the patterns matches the whole path."""
    result = F.lit(False)
    for pattern in patterns:
        result = result | path.rlike(glob_regex(pattern))
    return result
