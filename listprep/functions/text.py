"""Text cleaning and safe names, as native expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listprep.functions.binding import let

# Characters that count as blanks in Unicode text (Java's plain \s is ASCII only).
# Printable ASCII is ruled out first, which most characters are.
_ODD = r"\t\n\x0b\f\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WS = rf"[[^!-~]&&[ {_ODD}]]"
WS_NOT_SPACE = rf"[[^ -~]&&[{_ODD}]]"
# Control characters removed before a tabular export.
CONTROL = r"[\x00-\x1F\x7F-\x9F]"
# Characters not allowed in file names, per naming scheme.
PATH_FORBIDDEN = ':*?"<>|'
TITLE_SIGNS = r'\/*?:"<>|'
TITLE_FORBIDDEN = rf"[\{TITLE_SIGNS}]"
# What a name may not hold; plain letters first, which most characters are.
KEPT = r"[^a-zA-Z0-9_\p{L}\p{N}-]"
PUNCTUATION = r"""['"!@#$%^&*()+=\[\]{};:,.<>?/\\|`~]"""


def strip_ws(c: Column) -> Column:
    """Unicode blanks cut at both ends."""
    return F.regexp_replace(c, rf"^{WS}+|{WS}+\z", "")


def collapse_ws(c: Column) -> Column:
    """Runs of blanks (also NBSP) become one space; ends are cut.  Single spaces are left as they are."""
    return F.trim(F.regexp_replace(c, f"{WS_NOT_SPACE}{WS}*| {WS}+", " "))


def drop_control(c: Column) -> Column:
    return F.regexp_replace(c, CONTROL, "")


def clean_strings(df: DataFrame) -> DataFrame:
    """Control characters removed from every string column; other columns unchanged."""
    return df.select(
        *[drop_control(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
          for f in df.schema.fields]
    )


def safe_path(c: Column) -> Column:
    """Characters a file system rejects become ``_``; separators stay."""
    return F.translate(c, PATH_FORBIDDEN, "_" * len(PATH_FORBIDDEN))


def safe_file(c: Column, max_len: int | None = None, default: str | None = None) -> Column:
    """Separators and rejected characters become ``_``, blanks cut; optional length cut and default."""
    name = strip_ws(F.regexp_replace(c, TITLE_FORBIDDEN, "_"))
    if max_len is not None:
        name = let(
            name,
            lambda n: F.when(
                F.length(n) > max_len, F.regexp_replace(F.left(n, F.lit(max_len)), r"[ ._]+\z", "")
            ).otherwise(n),
        )
    return name if default is None else F.coalesce(F.nullif(name, F.lit("")), F.lit(default))


def safe_title(title: Column, index: Column) -> Column:
    """Current naming scheme of page records: words joined by ``_``, at most 100 characters."""
    # signs, blanks and ``_`` in a row are one ``_`` in the end, whichever rule comes first
    name = F.btrim(F.regexp_replace(title, f"[_{PUNCTUATION}{WS}]+", "_"), F.lit("_"))
    name = F.regexp_replace(name, KEPT, "")
    page = F.concat(F.lit("page_"), index.cast("string"))
    filled = let(
        name,
        lambda n: F.when(n == "", page)
        .when(F.length(n) < 3, F.concat(page, F.lit("_"), n))
        .otherwise(F.left(n, F.lit(100))),
    )
    blank = ~F.coalesce(title.rlike(rf"[^ {_ODD}]"), F.lit(False))
    return F.when(blank, F.concat(page, F.lit("_untitled"))).otherwise(filled)


def old_title(title: Column) -> Column:
    """Earlier scheme: letters, digits, space, ``-`` and ``_`` kept; then spaces to ``_``."""
    kept = F.rtrim(F.regexp_replace(title, r"[^a-zA-Z0-9 _\p{L}\p{N}-]", ""))
    return F.left(F.replace(kept, F.lit(" "), F.lit("_")), F.lit(100))


def basic_title(title: Column) -> Column:
    """Plain scheme: only rejected characters and spaces replaced."""
    return F.left(F.translate(title, TITLE_SIGNS + " ", "_" * (len(TITLE_SIGNS) + 1)), F.lit(100))


def split_camel(c: Column) -> Column:
    """Words of a camel-case key; double blanks from the two word rules are kept."""
    worded = F.replace(F.replace(c, F.lit("Of"), F.lit(" of ")), F.lit("Status"), F.lit(" Status"))
    return strip_ws(F.regexp_replace(worded, "([A-Z])", " $1"))


# Time codes of a transcript (minutes:seconds or hours:minutes:seconds).
TIME_CODE = r"\p{Nd}+:\p{Nd}+(:\p{Nd}+)?"


def drop_time_codes(text: Column) -> Column:
    """Lines holding only a time code go; a code at the very start of a line is cut; blank lines go."""
    lines = F.filter(F.split(text, "\n"), lambda line: ~strip_ws(line).rlike(f"^{TIME_CODE}$"))
    lines = F.transform(lines, lambda line: strip_ws(F.regexp_replace(line, f"^{TIME_CODE}{WS}+", "")))
    return F.array_join(F.filter(lines, lambda line: line != ""), "\n")


def title_or(element: Column, window_title: Column, url: Column) -> Column:
    """Element text, else the window title before its first `` - ``, else an id made from the url."""
    first = strip_ws(F.get(F.split(window_title, " - "), F.lit(0)))
    short = F.sha2(url, 256)
    return F.coalesce(F.nullif(strip_ws(element), F.lit("")), F.nullif(first, F.lit("")), short)


def channel_or(element: Column, window_title: Column, url: Column, site: str = "YouTube") -> Column:
    """Element text, else the last `` - `` part of the window title without the site name, else such an id."""
    parts = F.split(window_title, " - ")
    last = F.when(F.size(parts) > 1, strip_ws(F.replace(F.element_at(parts, -1), F.lit(site), F.lit(""))))
    short = F.sha2(url, 256)
    return F.coalesce(F.nullif(strip_ws(element), F.lit("")), F.nullif(last, F.lit("")), short)
