"""Small tables with the odd cases, and brute-force versions of the contracts."""

import hashlib
import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, texts, extra=False):
    """Documents from texts or (doc_id, text, source) rows; ``extra`` adds columns whose names clash."""
    rows = []
    for n, t in enumerate(texts):
        doc_id, text, source = t if isinstance(t, tuple) else (n, t, f"s{n % 3}")
        rows.append((doc_id, text, "en" if n % 2 else None, source, len(text or "")))
    df = spark.createDataFrame(rows, DOCS)
    if extra:
        for name in ("score", "size", "words", "digest", "text_sha256", "kept", "target", "w", "_t", "key"):
            df = df.selectExpr("*", f"'x' AS {name}")
    return df


LONG = "lorem ipsum dolor " * 9000

ODD = [
    None,
    "",
    "  \n\t ",
    "one",
    "one two three",
    LONG,
    "ünï çødé 漢字 \U0001f600 text",
    "one two three",
    "one  two\nthree",
    "a\u0000b \x0b\x1c end",
    "the gnu general public license and the MIT License, apache license",
    "x" * 3000,
    (None, "no id", "s1"),
    (3, "one", "s0"),
    (3, "one", "s0"),
    (3, "another text with the same id", None),
]


def key(row):
    return tuple((v is None, str(v)) for v in row)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=key)


def ws_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def exact(docs):
    norm = [(d, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for d, t in docs]
    groups = {}
    for d, t in norm:
        groups.setdefault(t, []).append(d)
    out = []
    for d, t in norm:
        ids = [x for x in groups[t] if x is not None]
        keep = min(ids) if ids else None
        out.append((d, keep, len(groups[t]), d == keep, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=key)


def quality_base(text):
    w = ws_words(text)
    lines = [x for x in (text or "").split("\n") if ws_words(x)]
    windows = {}
    for i in range(len(w) - 2):
        windows.setdefault(tuple(w[i : i + 3]), []).append(i)
    covered = {i + j for at in windows.values() if len(at) > 1 for i in at for j in range(3)}
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), failed


PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def license_base(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    at = [(i, v) for k, v in PHRASES.items() for i in range(len(w)) if w[i : i + len(k.split())] == k.split()]
    starts = [i for i, _ in at]
    return len(w), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted({v for _, v in at}))
