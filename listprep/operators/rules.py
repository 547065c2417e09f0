"""Fields of pages by rules that users write down as a table.

A rule is a row: name, kind, path and label.  Its kind, registered by name, turns it into a plan: steps from element to
element, and what is read at the last one.  All plans are checked before a page is opened, and become one machine: equal
first steps are one state, each state waits for one tag, and a page is walked once in document order, element by
element.  Only the fields leave the Python stage, so no node is stored and no expression scans nodes per rule.
"""

from __future__ import annotations

import sys
from bisect import bisect_right
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listprep.functions import html as H
from listprep.functions import text
from listprep.operators import extract

# The machine is shipped with the plan, like the page reader.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
# The class alone: what a task names is shipped whole.
Page = H._Page

TABLE = "name string, kind string, path array<struct<number:int,tag:string,cls:string>>, label string"
# Rules are a parameter that every task holds; a table with more is refused.
MOST_RULES = 1000


class Found:
    """An element of the page at hand, for the functions that read a field."""

    def __init__(self, page: Page, row: list):
        self._page, self._row = page, row

    def text(self) -> str:
        """Text as written."""
        whole = getattr(self._page, "whole", None)
        if whole is None:
            whole = self._page.whole = b"".join(self._page.raw)
        return whole[self._row[10] : self._row[11]].decode("utf-8", "replace")

    def sole_text(self) -> str | None:
        """The text, if one text is all that is inside."""
        return self.text() if self._row[7] else None

    def span(self) -> tuple[int, int]:
        """Its place among the elements of the page, and that of the last element inside."""
        return self._row[0], self._row[1]

    def attr(self, name: str) -> str | None:
        return dict(self._row[14]).get(name)

    def inside(self, tag: str, cls: str | None = None) -> list[Found]:
        """Elements below of a tag, in document order; the plan must name the tag."""
        rows = self._page.rows[self._row[0] + 1 : self._row[1] + 1]
        return [Found(self._page, row) for row in rows if row[4] == tag and _of_class(row[5], cls)]


def _of_class(given: str | None, wanted: str | None) -> bool:
    """One word: a member of the class list.  Several words: the exact class value."""
    if wanted is None:
        return True
    if given is None:
        return False
    return given == wanted or (" " not in wanted and wanted in given.split(" "))


@dataclass(frozen=True)
class Step:
    """The n-th element of a tag, inside the element before or (``after``) anywhere behind its start; with a class,
    and with nothing but a text inside, where these are given."""

    tag: str
    cls: str | None = None
    number: int = 1
    sole_text: str | None = None
    after: bool = False


@dataclass(frozen=True)
class Plan:
    """What a rule does: steps, what is read at the last element, and the expression that finishes what was read.
    ``tags`` are further tags that ``read`` looks for."""

    steps: tuple[Step, ...]
    read: Callable[[Found], str | None] = Found.text
    finish: Callable[[Column], Column] = text.collapse_ws
    tags: frozenset[str] = frozenset()


@dataclass(frozen=True)
class Spec:
    """One row of the rules table."""

    name: str
    kind: str
    path: tuple[tuple[int, str, str | None], ...]
    label: str | None = None

    def steps(self) -> tuple[Step, ...]:
        """The path as steps; a missing number is 1, an empty class is none."""
        if not self.path:
            raise ValueError(f"rule {self.name!r} has no path")
        made = []
        for number, tag, cls in self.path:
            number = 1 if number is None else number
            if not tag or number < 1:
                raise ValueError(f"rule {self.name!r}: a step needs a tag and a number of 1 or more")
            made.append(Step(tag.lower(), " ".join(cls.split()) or None if cls else None, number))
        return tuple(made)

    def needed_label(self) -> str:
        if self.label is None:
            raise ValueError(f"rule {self.name!r} of kind {self.kind!r} needs a label")
        return self.label


KINDS: dict[str, Callable[[Spec], Plan]] = {}


def kind(name: str) -> Callable:
    """Registers a function from a row of the rules table to its plan as a kind of rule."""

    def register(made: Callable[[Spec], Plan]) -> Callable[[Spec], Plan]:
        if made.__module__ != "__main__":  # readers go to the tasks, their modules need not be there
            cloudpickle.register_pickle_by_value(sys.modules[made.__module__])
        KINDS[name] = made
        return made

    return register


@kind("chain")
def chain(spec: Spec) -> Plan:
    """Element inside element; the text of the last, blanks collapsed."""
    return Plan(spec.steps())


@kind("labelled")
def labelled(spec: Spec) -> Plan:
    """At the end of the path the first span that holds the label alone; the text of the next span of the page."""
    label = Step("span", sole_text=spec.needed_label())
    return Plan((*spec.steps(), label, Step("span", after=True)), finish=text.strip_ws)


@kind("column")
def column(spec: Spec) -> Plan:
    """At the end of the path a table; its first column whose header holds the label, cells joined by `` | ``."""
    header = spec.needed_label()

    def read(table: Found) -> str | None:
        at = next((i for i, th in enumerate(table.inside("th")) if header in th.text()), None)
        body = None if at is None else next(iter(table.inside("tbody")), None)
        if body is None:
            return None
        # the cells of a row are neighbours in the list of all cells, so rows left open do not look at them again and again
        cells = body.inside("td")
        places = [td.span()[0] for td in cells]
        taken = []
        for row in body.inside("tr"):
            start, end = row.span()
            cell = bisect_right(places, start) + at
            if cell < len(cells) and places[cell] <= end:
                taken.append(cells[cell].text())
        return " | ".join(taken)

    return Plan(spec.steps(), read, tags=frozenset(("th", "tbody", "tr", "td")))


def specs(rules: DataFrame | Sequence[Spec | extract.Rule]) -> list[Spec]:
    """Rules as rows: from a table (columns of ``TABLE``), or from rule objects."""
    if isinstance(rules, DataFrame):
        rows = rules.select("name", "kind", "path", "label").limit(MOST_RULES + 1).collect()
        if len(rows) > MOST_RULES:
            raise ValueError(f"more than {MOST_RULES} rules")
        return [Spec(r.name, r.kind, tuple((s.number, s.tag, s.cls) for s in r.path or ()), r.label) for r in rows]
    made = []
    for rule in rules:
        if isinstance(rule, extract.Chain):
            rule = Spec(rule.name, "chain", rule.steps)
        elif isinstance(rule, extract.Labelled):
            rule = Spec(rule.name, "labelled", ((1, "section", rule.section),), rule.label)
        elif isinstance(rule, extract.TableColumn):
            rule = Spec(rule.name, "column", ((1, "table", rule.table),), rule.header)
        made.append(rule)
    return made


def rules_table(spark: SparkSession, rules: Sequence[Spec | extract.Rule]) -> DataFrame:
    """Rules as a table, to be stored, changed and read again."""
    return spark.createDataFrame([(s.name, s.kind, list(s.path), s.label) for s in specs(rules)], TABLE)


def plans(rules: Sequence[Spec]) -> dict[str, Plan]:
    """Checked plans by the name of their field."""
    made: dict[str, Plan] = {}
    for spec in rules:
        if not spec.name or spec.name in made:
            raise ValueError(f"rule names must be given and differ: {spec.name!r}")
        if spec.kind not in KINDS:
            raise ValueError(f"rule {spec.name!r} has the unknown kind {spec.kind!r}")
        made[spec.name] = KINDS[spec.kind](spec)
        if not made[spec.name].steps:
            raise ValueError(f"rule {spec.name!r} has no steps")
    return made


class Machine:
    """All plans as one automaton.  A state is a step behind the steps before it, and is reached by at most one element
    of a page; the elements that states behind it look for come later in document order, so one walk meets them all."""

    def __init__(self, wanted: Sequence[Plan]):
        self._fields = len(wanted)
        self._first: list[int] = []
        # of each state: its step, the states behind it, and the fields read at its element
        self._states: list[tuple[Step, list[int], list[tuple[int, Callable]]]] = []
        known: dict[tuple[Step, ...], int] = {}
        for field, plan in enumerate(wanted):
            behind = self._first
            for n in range(1, len(plan.steps) + 1):
                path = plan.steps[:n]
                if path not in known:
                    known[path] = len(self._states)
                    behind.append(known[path])
                    self._states.append((path[-1], [], []))
                behind = self._states[known[path]][1]
            self._states[known[plan.steps]][2].append((field, plan.read))
        self.tags = frozenset(s.tag for s, _, _ in self._states).union(*(p.tags for p in wanted))

    def run(self, page: Page) -> list[str | None]:
        """The fields of a page, None where an element is not found."""
        fields: list[str | None] = [None] * self._fields
        rows, waiting, active = page.rows, {}, 0

        def wait(states: list[int], end: int) -> int:
            for state in states:
                step = self._states[state][0]
                # state, last element of its scope, matches still to come
                waiting.setdefault(step.tag, []).append([state, len(rows) if step.after else end, step.number])
            return len(states)

        active = wait(self._first, len(rows))
        for row in rows:
            asked = waiting.get(row[4])
            if not asked:
                continue
            for item in asked[:]:
                step, behind, reads = self._states[item[0]]
                if row[0] > item[1]:
                    found = False
                elif not _of_class(row[5], step.cls) or (
                    step.sole_text is not None and Found(page, row).sole_text() != step.sole_text
                ):
                    continue
                elif item[2] > 1:
                    item[2] -= 1
                    continue
                else:
                    found = True
                asked.remove(item)
                active -= 1
                if found:
                    for field, read in reads:
                        fields[field] = read(Found(page, row))
                    active += wait(behind, row[1])
            if not active:
                break
        return fields


def read_fields(
    pages: DataFrame, *keep: str, rules: DataFrame | Sequence[Spec | extract.Rule] = extract.CONTRACT_RULES, html: str = "html"
) -> DataFrame:
    """The kept columns of each page and one string per rule; a field not found, or of a null page, is ``''``.

    Narrow: one pass over each page where it is read, no shuffle.  Only the page and the kept columns reach the scan;
    rules are checked here, and a wrong one raises ValueError before any page is read."""
    wanted = plans(specs(rules))
    taken = [name for name in wanted if name in keep]
    if taken:
        raise ValueError(f"fields have the names of kept columns: {taken}")
    machine = Machine(list(wanted.values()))
    names, count = [*keep, *wanted], len(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            source = batch.column(batch.num_columns - 1)
            found = [machine.run(Page(value.as_py() or "", machine.tags)) for value in source]
            fields = [pa.array([row[i] for row in found], pa.string()) for i in range(count)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *fields], names=names)

    # the page comes last, also where it is kept under its own name
    page = next(name for name in (f"_page{i}" for i in range(len(keep) + 1)) if name not in keep)
    slim = pages.select(*keep, F.col(html).alias(page))
    schema = T.StructType([*slim.schema.fields[:-1], *[T.StructField(name, T.StringType()) for name in wanted]])
    read = slim.mapInArrow(run, schema)
    return read.select(*keep, *[F.coalesce(p.finish(F.col(name)), F.lit("")).alias(name) for name, p in wanted.items()])
