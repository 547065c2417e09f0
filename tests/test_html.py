"""The page reader: tree shape, text rules, spans."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from listprep.functions import html as H


def read(text, tags=None, attrs=None):
    page = H._Page(text, tags, attrs)
    return page, {row[4]: row for row in page.rows}


def own_text(page, row, tight=True):
    text = b"".join(page.tight if tight else page.raw)
    start, stop = (row[8], row[9]) if tight else (row[10], row[11])
    return text[start:stop].decode()


def test_unclosed_tag_takes_what_follows_until_its_parent_ends():
    page, by_tag = read("<div><p><b>x<p>y</p></div><i>z</i>")
    assert own_text(page, by_tag["b"]) == "xy"
    assert by_tag["i"][2] == -1 and own_text(page, by_tag["i"]) == "z"


def test_end_tag_without_start_is_ignored():
    page, by_tag = read("<div>a</span>b</div>")
    assert own_text(page, by_tag["div"]) == "ab"


def test_void_and_self_closed_elements_are_empty():
    page, by_tag = read("<p>a<br>b<em/>c</p>")
    assert own_text(page, by_tag["br"]) == "" and own_text(page, by_tag["em"]) == ""
    assert own_text(page, by_tag["p"]) == "abc"


def test_script_style_and_comments_are_not_text():
    page, by_tag = read('<div>a<script>var t="</p>";</script><style>p{}</style><!-- no -->b</div><p>c</p>')
    assert own_text(page, by_tag["div"]) == "ab" and own_text(page, by_tag["p"]) == "c"


def test_tight_text_joins_with_nothing_and_raw_text_keeps_blanks():
    page, by_tag = read("<div> <b>a</b> <i>b </i>\n </div>")
    assert own_text(page, by_tag["div"]) == "ab"
    assert own_text(page, by_tag["div"], tight=False) == " a b \n"


def test_blanks_inside_pre_are_kept():
    page, by_tag = read("<pre><i> \n </i></pre>")
    assert own_text(page, by_tag["pre"], tight=False) == " \n "


def test_entities_and_multibyte_text():
    page, by_tag = read("<p>é&amp;&copy;</p><b>№ &quot;x&quot;</b>")
    assert own_text(page, by_tag["p"]) == "é&©" and own_text(page, by_tag["b"]) == '№ "x"'


@pytest.mark.parametrize(
    "text, solo",
    [("<a>x</a>", True), ("<a><b>x</b></a>", True), ("<a>x<b></b></a>", False), ("<a></a>", False), ("<a><!--c--></a>", False)],
)
def test_sole_text(text, solo):
    assert read(text)[1]["a"][7] is solo


def test_source_spans():
    text = "<html>\n<body class='x'>\n<p>a</p></body></html>"
    _, by_tag = read(text)
    assert text[by_tag["body"][12] : by_tag["body"][13]] == "<body class='x'>\n<p>a</p></body>"


def test_descendants_are_a_slice():
    page, _ = read("<div><p><b>1</b></p><ul><li>2</li></ul></div><p>3</p>")
    for row in page.rows:
        inside = [r[0] for r in page.rows if r[0] > row[0] and r[0] <= row[1]]

        def is_below(r, top=row[0]):
            while r[2] != -1:
                if r[2] == top:
                    return True
                r = page.rows[r[2]]
            return False

        assert inside == [r[0] for r in page.rows if is_below(r)]


def test_pruned_tags_keep_text():
    page, by_tag = read("<div><p>a <b>b</b></p></div>", tags=frozenset(["p"]), attrs=frozenset())
    assert list(by_tag) == ["p"] and own_text(page, by_tag["p"]) == "ab"


def test_columns(spark):
    df = spark.createDataFrame(
        [(1, '<p class="a  b">x</p><p class="b">y</p><p class="b a">z</p>'), (2, None), (3, "")], "id int, html string"
    )
    dom = F.col("dom")

    def texts(cls):
        return F.transform(H.find_all(dom["nodes"], tag="p", cls=cls), lambda n: H.tight(dom, n))

    got = H.parse_html(df).select("id", texts("a").alias("a"), texts("a b").alias("ab"), texts("b").alias("b")).orderBy("id")
    assert [tuple(r) for r in got.collect()] == [(1, ["x", "z"], ["x"], ["x", "y", "z"]), (2, [], [], []), (3, [], [], [])]


def test_many_pages_come_back_whole(spark):
    df = spark.range(5000).select("id", F.concat(F.lit("<p>"), F.col("id"), F.lit("</p>")).alias("html"))
    dom = F.col("dom")
    got = H.parse_html(df).select("id", H.tight(dom, H.find(dom["nodes"], tag="p")).cast("long").alias("t"))
    assert got.filter("id = t").count() == 5000


PIECES = [
    "<p>", "</p>", "<P CLASS=A>", "</P >", "<br>", "<br/>", "<br />", "<br / >", "<div class='a b' id=x>", "</div>", "</div x>",
    '<a href="/q?a=1&amp;b=2">', '<a href="/q?a=1&b=2">', "<a href=/x/>", "<a href=/x>", "<a hidden>", "<a a=1 A=2>", '<a a="1"b="2">',
    "</a>", "<!-- c -->", "<!---->", "<!-->", "<!-- a --!> b -->", "<!-- open", "<!doctype html>", "<![CDATA[x]]>", "<?pi?>", "<!x>",
    "<script>", "<script>var t='</p>';", "</script>", "</SCRIPT >", "</scriptx>", "<style>p{}</style>", "<title>t</title>", "<title>a<b>",
    "</title>", "<textarea> </textarea>", "<pre> \n</pre>", " ", "\n", "text", "&amp;", "&lt;b&gt;", "&copy", "&#65;", "&", "<", ">", "a < b",
    "\u00e9", "\u00a0", "<x-y:z k>", "<img src=x alt='>'>", "<svg/>", "<a title=\"it's\">", "<a b = 'c'>", "<a\nb>", "<p\t>", "<noscript>", "<a =x>",
    "<template><i>no</i></template>", "</>", "<a/b>", "<a href='x' / >", "<iframe>", "</iframe>", "<b", "<rt>r</rt>", "\x00", "<a x=`y`>", "<script/>",
]


def same_tree(text):
    fast, slow = H._Page(text), H._Page(text, fast=False)
    assert (fast.rows, fast.tight, fast.raw) == (slow.rows, slow.tight, slow.raw)


@settings(max_examples=3000, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=12))
def test_pattern_reader_equals_standard_reader(pieces):
    same_tree("".join(pieces))


@settings(max_examples=1000, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=12))
def test_readers_agree_where_tags_are_left_out(pieces):
    text, tags, attrs = "".join(pieces), frozenset(["p", "div", "b"]), frozenset(["x"])
    fast, slow = H._Page(text, tags, attrs), H._Page(text, tags, attrs, fast=False)
    assert (fast.rows, fast.tight, fast.raw) == (slow.rows, slow.tight, slow.raw)


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="<>/='\"!-& ab\n", max_size=25))
def test_readers_agree_on_any_text(text):
    same_tree(text)


def test_readers_agree_on_real_pages(spark, folder):
    for row in spark.read.parquet(f"{folder}/pages.parquet").select("html").collect():
        same_tree(row.html)


def test_sections_of_a_page_with_very_many_headings(spark):
    import time

    from pyspark.sql import functions as F

    from listprep.operators import wiki

    parts = "".join(f"<h{2 + i % 3}>Title {i}</h{2 + i % 3}><p>Text of section {i} here</p>" for i in range(2000))
    html = f'<html><head><title>t</title></head><body><main class="page__main">{parts}</main></body></html>'
    df = wiki.with_main(H.parse_html(spark.createDataFrame([(1, html)], "id int, html string")))
    pages = df.withColumn("infobox", wiki.infobox()).select(F.posexplode(wiki.sections()).alias("pos", "s"))
    start = time.perf_counter()
    got = pages.orderBy("pos").collect()
    assert time.perf_counter() - start < 60
    assert [r.s.title for r in got] == [f"Title {i}" for i in range(2000)]
    assert all(f"Text of section {r.pos} here" in r.s.content for r in got)


def test_limits_of_page_parts(spark):
    from listprep.operators import wiki

    refs = "".join(f'<li><span class="reference-text">Reference {i}</span></li>' for i in range(14))
    html = (
        '<html><body><main class="page__main">' + "".join(f"<p>A paragraph with number {i}</p>" for i in range(20))
        + f'<h2>References</h2><div class="mw-references-wrap"><ol>{refs}</ol></div></main></body></html>'
    )
    df = wiki.with_main(H.parse_html(spark.createDataFrame([(1, html)], "id int, html string"), keep_html=True))
    df = df.withColumn("infobox", wiki.infobox())
    full = df.select(wiki.main_text().alias("m"), wiki.sections().alias("s"), wiki.snippet().alias("t")).first()
    some = df.select(
        wiki.main_text(wiki.PARAGRAPHS).alias("m"), wiki.sections(wiki.REFERENCES).alias("s"), wiki.snippet(length=50).alias("t")
    ).first()
    assert (len(full.m.split("\n")), len(some.m.split("\n"))) == (20, 15)
    assert (len(full.s[0].content.split("\n")), len(some.s[0].content.split("\n"))) == (14, 10)
    assert len(some.t) == 50 < len(full.t)
