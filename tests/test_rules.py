"""Rules as a table: one walk over a page gives what the expressions on its nodes give."""

import json
import random

import pytest
from pyspark.sql import functions as F

from listprep.functions import html as H
from listprep.operators import extract, rules

# Rules that share steps, count, follow labels and read columns, over the few tags of the pages below.
RULES = (
    extract.Chain("one", ((1, "div", None),)),
    extract.Chain("second", ((2, "div", "a"),)),
    extract.Chain("deep", ((1, "div", None), (1, "div", "a"), (2, "span", "b"))),
    extract.Chain("deeper", ((1, "div", None), (1, "div", "a"), (1, "div", "a b"))),
    extract.Chain("same", ((1, "div", None), (1, "div", "a"), (2, "span", "b"))),
    extract.Labelled("label", "L", "a"),
    extract.Labelled("label_two", "L", "a b"),
    extract.TableColumn("col", "H", "a"),
    extract.TableColumn("col_two", "X", "a"),
    extract.TableColumn("any", "", "b"),
)
PIECES = [
    "<div>", '<div class="a">', '<div class=" a  b ">', "</div>", "<span>", '<span class="b">', "</span>", "L", "H", "X", " \n", " ", "t ",
    '<section class="a">', '<section class="a b">', "</section>", "<span>L</span>", "<span>v </span>", '<table class="a">', '<table class="b">',
    "</table>", "<tr>", "</tr>", "<th>H</th>", "<th>X", "</th>", "<td>", " 1", "</td>", "<tbody>", "</tbody>", "&amp;", "<!-- -->", "<td>2</td>",
    "<script>L</script>", "<br>", "<a =x>",
]


def made_pages(count, seed=5):
    draw = random.Random(seed)
    whole = [
        '<table class="a"><tr><th>X<th>H</th></tr><tbody><tr><td> 1 <td>2</td></tr><tr><td>3</tr></tbody></table>',
        '<section class="a"><div><span><span>L</span></span></div></section><p><span> v </span></p>', "", None,
    ]
    return whole + ["".join(draw.choice(PIECES) for _ in range(draw.randrange(60))) for _ in range(count)]


def test_equals_the_expressions_on_nodes(spark):
    pages = spark.createDataFrame(list(enumerate(made_pages(3000))), "id int, html string")
    slow = {r.id: r for r in extract.extract_rules(H.parse_html(pages), "id", rules=RULES).collect()}
    fast = {r.id: r for r in rules.read_fields(pages, "id", rules=RULES).collect()}
    assert len(fast) == len(slow) == 3004
    assert [(fast[i], i) for i in slow if fast[i] != slow[i]] == []
    # the made pages do have what the rules look for
    for rule in RULES:
        assert sum(bool(row[rule.name]) for row in slow.values()) > 5, rule.name


def test_rules_from_a_stored_table(spark, tmp_path):
    rules.rules_table(spark, RULES).write.json(str(tmp_path / "rules"))
    stored = spark.read.schema(rules.TABLE).json(str(tmp_path / "rules"))
    pages = spark.createDataFrame(list(enumerate(made_pages(200))), "id int, html string")
    columns = ["id", *(r.name for r in RULES)]
    got = rules.read_fields(pages, "id", rules=stored).select(*columns).collect()
    assert sorted(got) == sorted(rules.read_fields(pages, "id", rules=RULES).collect())


def test_a_kind_of_ones_own(spark):
    @rules.kind("address")
    def address(spec):
        return rules.Plan(spec.steps(), lambda a: json.dumps([x.attr("href") for x in a.inside("a")]), F.trim, frozenset(["a"]))

    try:
        mine = [rules.Spec("links", "address", ((1, "nav", "main"),))]
        page = '<a href="/0"></a><nav class="x main"><a href="/1">1</a><b><a>2</a></b></nav><a href="/3"></a>'
        pages = spark.createDataFrame([(1, page), (2, "<nav></nav>")], "id int, html string")
        assert rules.read_fields(pages, "id", rules=mine).collect() == [(1, '["/1", null]'), (2, "")]
    finally:
        del rules.KINDS["address"]


def test_equal_first_steps_are_one_state():
    machine = rules.Machine(list(rules.plans(rules.specs(RULES)).values()))
    # div; its a; b in it; a b in it; second a; two sections with label and value each; two tables
    assert len(machine._states) == 13


@pytest.mark.parametrize(
    "spec, said",
    [
        (rules.Spec("x", "no such", ((1, "a", None),)), "unknown kind"),
        (rules.Spec("x", "chain", ()), "no path"),
        (rules.Spec("x", "chain", ((0, "a", None),)), "1 or more"),
        (rules.Spec("x", "chain", ((1, "", None),)), "needs a tag"),
        (rules.Spec("x", "column", ((1, "table", None),)), "needs a label"),
        (rules.Spec("", "chain", ((1, "a", None),)), "names must be given"),
        (rules.Spec("id", "chain", ((1, "a", None),)), "kept columns"),
    ],
)
def test_wrong_rules_fail_before_a_page_is_read(spark, spec, said):
    pages = spark.createDataFrame([(1, "<a>")], "id int, html string")
    with pytest.raises(ValueError, match=said):
        rules.read_fields(pages, "id", rules=[spec])


def test_two_rules_of_one_name():
    with pytest.raises(ValueError, match="differ"):
        rules.plans([rules.Spec("x", "chain", ((1, "a", None),)), rules.Spec("x", "chain", ((1, "b", None),))])


def test_an_empty_table_of_rules_keeps_the_pages(spark):
    pages = spark.createDataFrame([(1, "<a>", 3)], "id int, html string, _page0 int")
    assert rules.read_fields(pages, "id", "html", "_page0", rules=[]).collect() == [(1, "<a>", 3)]


def test_pages_are_not_shuffled(spark):
    pages = spark.createDataFrame([(1, "<a>")], "id int, html string")
    plan = rules.read_fields(pages, "id")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
