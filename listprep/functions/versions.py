"""Version order keys, as native expressions (public Semantic Versioning 2.0.0 rules)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The grammar of a version.
_NUMBER = r"(?:0|[1-9][0-9]*)"
_IDENT = rf"(?:{_NUMBER}|[0-9]*[A-Za-z-][0-9A-Za-z-]*)"
SEMVER = rf"^{_NUMBER}\.{_NUMBER}\.{_NUMBER}(?:-{_IDENT}(?:\.{_IDENT})*)?(?:\+[0-9A-Za-z-]+(?:\.[0-9A-Za-z-]+)*)?\z"


def is_numeric(version: Column) -> Column:
    """Digits and dots only, with at least one digit."""
    return F.replace(version, F.lit("."), F.lit("")).rlike(r"^\p{Nd}+\z")


def _parts(version: Column) -> tuple[Column, Column]:
    """(core, pre-release label or '') as text; build data is cut."""
    bare = F.substring_index(version, "+", 1)
    core = F.substring_index(bare, "-", 1)
    return core, F.substr(bare, F.length(core) + 2)


def _numeric(ident: Column) -> Column:
    return ident.rlike("^[0-9]+$")


def is_semver(version: Column) -> Column:
    """A valid version whose numbers fit 64 bits (checked by value only where a number is that long)."""
    core, label = _parts(version)
    numbers = F.filter(F.split(F.concat(core, F.lit("."), label), r"\."), _numeric)
    fits = ~F.exists(numbers, lambda n: n.try_cast("bigint").isNull())
    return version.rlike(SEMVER) & F.when(version.rlike("[0-9]{19}"), fits).otherwise(True)


def order_key(version: Column) -> Column:
    """Struct that sorts like the versions do; for valid versions only (see ``is_semver``).

    Core numbers first; a release stands above its pre-releases; identifiers compare one by one,
    numbers below words; a longer list wins over its prefix; build data does not count.
    """
    core, label = _parts(version)
    idents = F.transform(
        F.split(label, r"\."),
        lambda s: F.struct(
            F.when(_numeric(s), 0).otherwise(1).alias("kind"),
            F.when(_numeric(s), s.try_cast("bigint")).alias("number"),
            F.when(~_numeric(s), s).alias("word"),
        ),
    )
    numbers = [F.split_part(core, F.lit("."), F.lit(i)).try_cast("bigint").alias(name)
               for i, name in ((1, "major"), (2, "minor"), (3, "patch"))]
    return F.struct(
        *numbers,
        F.when(label == "", 1).otherwise(0).alias("release"),
        F.when(label != "", idents).alias("idents"),
    )


def semver_key(version: Column) -> Column:
    """``order_key`` with NULL for invalid versions."""
    return F.when(is_semver(version), order_key(version))
