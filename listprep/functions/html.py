"""Stored HTML as a column of nodes.

``parse_html`` is the only Python stage of the library: an Arrow map over pages which turns each page
into a *dom* struct.  Every rule after it is a native Column expression on that struct.

``dom.nodes`` lists the elements in document order, so the array index equals ``pos`` and the
descendants of a node are exactly the slice ``pos+1 .. end``.  Text is not repeated per node: the page
text is stored once (``tight``: every text node stripped; ``raw``: as written) and a node holds byte
offsets into it.  That keeps a page linear in its size however deep unclosed tags nest.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterable, Iterator, Sequence
from html import unescape
from html.parser import HTMLParser
from itertools import accumulate

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listprep.functions.binding import let as let
from listprep.functions.text import strip_ws

# Ship the page reader with the plan, so that executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

DOM_DDL = (
    "struct<nodes:array<struct<pos:int,end:int,parent:int,depth:int,tag:string,cls:string,id:string,"
    "solo:boolean,t0:int,t1:int,r0:int,r1:int,h0:int,h1:int,attrs:map<string,string>>>,"
    "tight:binary,raw:binary>"
)

# Elements read without content (those of the HTML standard and older ones that browsers also treat so),
# and elements whose text is not page text.
VOID = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex keygen link "
    "menuitem meta nextid param source spacer track wbr".split()
)
MUTE = frozenset("script style template rt rp".split())
KEEP_BLANKS = frozenset("pre textarea".split())

_ROW_FIELDS = ("pos", "end", "parent", "depth", "tag", "cls", "id", "solo", "t0", "t1", "r0", "r1", "h0", "h1", "attrs")
_ROW_TYPES = (
    pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.bool_(),
    pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int32(),
)
_FLUSH_NODES = 20_000
_FLUSH_BYTES = 8 << 20


_BLANK = r"[\t\n\r\f ]"
# Markup without surprises: end tags, start tags with plain attributes, comments and the doctype.
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s"'=<>`&/]++)"""
_TOKEN = re.compile(
    rf"</([a-zA-Z][a-zA-Z0-9:_-]*+){_BLANK}*+>"
    rf"|<([a-zA-Z][a-zA-Z0-9:_-]*+)((?:{_BLANK}++[a-zA-Z_:@][a-zA-Z0-9_:.@-]*+(?:{_BLANK}*+={_BLANK}*+{_VALUE})?+)*+){_BLANK}*+(/?)>"
    r"|<!--(?!-?>)((?:(?!--!?>).)*+)-->"
    r"|<!(?i:doctype)[^><]*+>",
    re.S,
)
_ATTR = re.compile(rf"""([^\s=]+)(?:{_BLANK}*={_BLANK}*("[^"]*"|'[^']*'|[^\s"']+))?""")
_OTHER_ENTITY = re.compile("&(?!(?:amp|quot|lt|gt);)")
_RAW_END = {tag: re.compile(rf"</{tag}(?![a-zA-Z0-9:_-])", re.I) for tag in ("script", "style")}
# Elements whose content the standard reads in another mode.
_RAW_TEXT = frozenset("title textarea xmp iframe noembed noframes noscript plaintext".split())


class _Page:
    """The tree of one page.  An end tag closes up to the nearest open tag of that name, else is ignored.

    Regular markup is read by one pattern; anything it does not cover sends the page to the tolerant
    reader of the standard library, which defines the result in all cases.
    """

    def __init__(self, html: str, keep_tags: frozenset | None = None, keep_attrs: frozenset | None = None, fast: bool = True):
        self._keep_tags, self._keep_attrs = keep_tags, keep_attrs
        self._clear()
        if not (fast and self._scan(html)):
            self._clear()
            _Tolerant(self, html)
        while self._open:
            self._shut(len(html))

    def _clear(self) -> None:
        self.rows: list[list] = []
        self.tight: list[bytes] = []
        self.raw: list[bytes] = []
        self.size_tight = self.size_raw = 0
        # open element: tag, its row or None, number of children, has one text below
        self._open: list[list] = []
        self._parents = [-1]
        self._names: dict[str, int] = {}
        self._muted = self._verbatim = 0

    def _scan(self, html: str) -> bool:
        """Reads the whole page by pattern; False when some part of it is irregular."""
        at, token, kept = 0, _TOKEN.match, self._keep_tags
        while True:
            lt = html.find("<", at)
            data = html[at:] if lt < 0 else html[at:lt]
            if data:
                self.text(unescape(data) if "&" in data else data)
            if lt < 0:
                return True
            found = token(html, lt)
            if found is None:
                return False
            end, start, attrs, closed, _comment = found.groups()
            at = found.end()
            if end is not None:
                self.end(end.lower(), lt, at)
            elif start is None:
                self.aside()
            else:
                tag = start.lower()
                pairs = []
                if attrs and (kept is None or tag in kept):
                    if "&" in attrs and _OTHER_ENTITY.search(attrs):
                        return False
                    for name, value in _ATTR.findall(attrs):
                        if value[:1] in ("'", '"'):
                            value = value[1:-1]
                        pairs.append((name.lower(), unescape(value) if "&" in value else value))
                self.start(tag, pairs, lt, at, bool(closed))
                if closed:
                    if tag in _RAW_END:
                        return False
                elif tag in _RAW_END:
                    stop = _RAW_END[tag].search(html, at)
                    if stop is None:
                        return False
                    if stop.start() > at:
                        self.text(html[at : stop.start()])
                    at = stop.start()
                elif tag in _RAW_TEXT:
                    lt = html.find("<", at)
                    if tag not in ("title", "textarea") or html[lt : lt + len(tag) + 2].lower() != f"</{tag}":
                        return False

    def text(self, data: str) -> None:
        if self._open:
            top = self._open[-1]
            top[2] += 1
            top[3] = True
        if self._muted:
            return
        short = data.strip()
        if not short and not self._verbatim and not data.strip(" \n\t\f\r"):
            data = "\n" if "\n" in data else " "
        piece = data.encode("utf-8", "replace")
        self.raw.append(piece)
        self.size_raw += len(piece)
        if short:
            if len(short) != len(data):
                piece = short.encode("utf-8", "replace")
            self.tight.append(piece)
            self.size_tight += len(piece)

    def aside(self) -> None:
        """A comment or declaration: a child without text."""
        if self._open:
            top = self._open[-1]
            top[2] += 1
            top[3] = False

    def start(self, tag: str, attrs: list, at: int, after: int, closed: bool = False) -> None:
        opened = self._open
        if opened:
            top = opened[-1]
            top[2] += 1
            top[3] = False
        row = None
        if self._keep_tags is None or tag in self._keep_tags:
            index = len(self.rows)
            cls = ident = None
            kept = attrs
            if attrs:
                values = dict(attrs)
                cls, ident = values.get("class"), values.get("id")
                if cls is not None:
                    cls = " ".join(cls.split())
                if self._keep_attrs is not None:
                    kept = [item for item in values.items() if item[0] in self._keep_attrs]
                elif len(values) != len(attrs):
                    kept = list(values.items())
            t, r = self.size_tight, self.size_raw
            row = [index, index, self._parents[-1], len(opened), tag, cls, ident, False, t, t, r, r, at, 0, kept]
            self.rows.append(row)
            self._parents.append(index)
        opened.append([tag, row, 0, False])
        self._names[tag] = self._names.get(tag, 0) + 1
        if tag in MUTE:
            self._muted += 1
        elif tag in KEEP_BLANKS:
            self._verbatim += 1
        if closed or tag in VOID:
            self._shut(after)

    def _shut(self, offset: int) -> None:
        tag, row, children, has_text = self._open.pop()
        self._names[tag] -= 1
        if tag in MUTE:
            self._muted -= 1
        elif tag in KEEP_BLANKS:
            self._verbatim -= 1
        solo = children == 1 and has_text
        if row is not None:
            row[1], row[7], row[9], row[11], row[13] = len(self.rows) - 1, solo, self.size_tight, self.size_raw, offset
            self._parents.pop()
        if self._open and self._open[-1][2] == 1:
            self._open[-1][3] = solo

    def end(self, tag: str, at: int, after: int) -> None:
        if not self._names.get(tag):
            return
        while self._open[-1][0] != tag:
            self._shut(at)
        self._shut(after)


class _Tolerant(HTMLParser):
    """Feeds a page from the standard library's reader, which copes with any markup."""

    def __init__(self, page: _Page, html: str):
        super().__init__(convert_charrefs=True)
        self._page, self._html = page, html
        self._lines = [0, *(i + 1 for i, char in enumerate(html) if char == "\n")]
        self._pending: list[str] = []
        self.feed(html)
        self.close()
        self._flush()

    def _at(self) -> int:
        line, column = self.getpos()
        return self._lines[line - 1] + column

    def _flush(self) -> None:
        if self._pending:
            self._page.text("".join(self._pending))
            self._pending.clear()

    def _begin(self, tag, attrs, closed):
        self._flush()
        at = self._at()
        values = [(name, value or "") for name, value in attrs]
        self._page.start(tag, values, at, at + len(self.get_starttag_text()), closed)

    def handle_starttag(self, tag, attrs):
        self._begin(tag, attrs, False)

    def handle_startendtag(self, tag, attrs):
        self._begin(tag, attrs, True)

    def handle_endtag(self, tag):
        self._flush()
        at = self._at()
        self._page.end(tag, at, self._html.find(">", at) + 1 or len(self._html))

    def handle_data(self, data):
        self._pending.append(data)

    def _other(self, _data):
        self._flush()
        self._page.aside()

    handle_comment = handle_decl = handle_pi = unknown_decl = _other


def _offsets(lengths: Iterable[int]) -> pa.Array:
    return pa.array([0, *accumulate(lengths)], pa.int32())


def _dom_array(pages: list[_Page]) -> pa.StructArray:
    rows = [row for page in pages for row in page.rows]
    *columns, attrs = zip(*rows) if rows else [()] * len(_ROW_FIELDS)
    names = [name for pairs in attrs for name, _ in pairs]
    values = [value for pairs in attrs for _, value in pairs]
    nodes = pa.StructArray.from_arrays(
        [
            *(pa.array(column, type=kind) for column, kind in zip(columns, _ROW_TYPES)),
            pa.MapArray.from_arrays(
                _offsets(map(len, attrs)), pa.array(names, pa.string()), pa.array(values, pa.string())
            ),
        ],
        names=list(_ROW_FIELDS),
    )
    return pa.StructArray.from_arrays(
        [
            pa.ListArray.from_arrays(_offsets(len(page.rows) for page in pages), nodes),
            pa.array([b"".join(page.tight) for page in pages], pa.binary()),
            pa.array([b"".join(page.raw) for page in pages], pa.binary()),
        ],
        names=["nodes", "tight", "raw"],
    )


def parse_html(
    df: DataFrame,
    html: str = "html",
    dom: str = "dom",
    keep_tags: Iterable[str] | None = None,
    keep_attrs: Iterable[str] | None = None,
    keep_html: bool = False,
) -> DataFrame:
    """Adds the ``dom`` column.  Narrow: no shuffle, pages stay in their partition.

    Select and filter *before* this call; the Arrow stage stops pushdown.  ``keep_tags`` and
    ``keep_attrs`` prune inside the stage (positions then count kept elements only).
    """
    tags = None if keep_tags is None else frozenset(keep_tags)
    names = None if keep_attrs is None else frozenset(keep_attrs)
    carried = [c for c in df.columns if keep_html or c != html]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            source = batch.column(batch.schema.get_field_index(html))
            pages, begin, nodes, size = [], 0, 0, 0
            for i in range(batch.num_rows):
                page = _Page(source[i].as_py() or "", tags, names)
                pages.append(page)
                nodes += len(page.rows)
                size += page.size_raw + page.size_tight
                if nodes >= _FLUSH_NODES or size >= _FLUSH_BYTES or i + 1 == batch.num_rows:
                    part = batch.slice(begin, i + 1 - begin)
                    kept = [part.column(part.schema.get_field_index(c)) for c in carried]
                    yield pa.RecordBatch.from_arrays([*kept, _dom_array(pages)], names=[*carried, dom])
                    pages, begin, nodes, size = [], i + 1, 0, 0

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name in carried)
    schema = f"{fields}, `{dom}` {DOM_DDL}" if fields else f"`{dom}` {DOM_DDL}"
    return df.mapInArrow(run, schema)


# --- expressions on the dom struct -------------------------------------------------------------


def below(dom: Column, node: Column) -> Column:
    """Descendants of a node, as a slice of the node array."""
    return F.slice(dom["nodes"], node["pos"] + 2, node["end"] - node["pos"])


def has_class(node: Column, name: str) -> Column:
    """One word: a member of the class list.  Several words: the exact class value."""
    exact = node["cls"] == name
    if " " in name:
        return F.coalesce(exact, F.lit(False))
    return F.coalesce(exact | F.concat(F.lit(" "), node["cls"], F.lit(" ")).contains(f" {name} "), F.lit(False))


def matches(
    tag: str | Sequence[str] | None = None, cls: str | None = None, id: str | None = None, attrs: Sequence[str] = ()
) -> Callable[[Column], Column]:
    """Node predicate for ``F.filter``: all given parts must hold."""

    def test(node: Column) -> Column:
        parts = []
        if tag is not None:
            parts.append(node["tag"] == tag if isinstance(tag, str) else node["tag"].isin(list(tag)))
        if cls is not None:
            parts.append(has_class(node, cls))
        if id is not None:
            parts.append(F.coalesce(node["id"] == id, F.lit(False)))
        parts += [F.map_contains_key(node["attrs"], F.lit(a)) for a in attrs]
        result = F.lit(True)
        for part in parts:
            result = result & part
        return result

    return test


def find_all(nodes: Column, **want) -> Column:
    return F.filter(nodes, matches(**want))


def find(nodes: Column, index: int = 0, **want) -> Column:
    """The n-th match in document order (0-based), or NULL."""
    return F.get(find_all(nodes, **want), F.lit(index))


def attr(node: Column, name: str) -> Column:
    return F.try_element_at(node["attrs"], F.lit(name))


def tight(dom: Column, node: Column) -> Column:
    """Text with every text node stripped, joined by nothing."""
    return F.substring(dom["tight"], node["t0"] + 1, node["t1"] - node["t0"]).cast("string")


def raw(dom: Column, node: Column) -> Column:
    """Text as written."""
    return F.substring(dom["raw"], node["r0"] + 1, node["r1"] - node["r0"]).cast("string")


def stripped(dom: Column, node: Column) -> Column:
    """Text as written, blanks cut at both ends only."""
    return strip_ws(raw(dom, node))


def sole_text(dom: Column, node: Column) -> Column:
    """The text of a node that has one text node as its only content, else NULL."""
    return F.when(node["solo"], raw(dom, node))


def markup(html: Column, node: Column) -> Column:
    """The source text of a node."""
    return F.substring(html, node["h0"] + 1, node["h1"] - node["h0"])
