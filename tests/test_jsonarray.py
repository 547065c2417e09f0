"""One large JSON array in many ranges: the same elements as in one piece."""

import json
import random

import pytest

from listprep.sources import jsonarray


def some(n, seed=0):
    rng = random.Random(seed)
    text = lambda: "".join(rng.choice(['a', '"', "\\", "{", "}", "[", "]", ",", "\n", "ü", " ", "}}"]) for _ in range(rng.randrange(12)))
    return [{"id": i, "title": text(), "more": {"list": [text(), {"deep": text()}], "none": None}} for i in range(n)]


@pytest.fixture
def small_ranges(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("indent", [None, 2])
def test_same_as_in_one_piece(spark, tmp_path, small_ranges, indent):
    rows = some(300)
    rows[150]["title"] = "long }{ \" " * 400
    (tmp_path / "a.json").write_text(json.dumps(rows, indent=indent, ensure_ascii=False))
    (tmp_path / "b.json").write_text(json.dumps(some(5, 1), indent=indent))
    (tmp_path / "c.json").write_text("[]")
    (tmp_path / "d.json").write_text("")
    found = jsonarray.elements(spark, str(tmp_path))
    assert jsonarray._pieces(spark, str(tmp_path)).rdd.getNumPartitions() > 20
    got = sorted(json.dumps(json.loads(r.element), sort_keys=True) for r in found.collect())
    assert got == sorted(json.dumps(r, sort_keys=True) for r in [*rows, *some(5, 1)])
    good, bad = jsonarray.read_array(spark, str(tmp_path / "a.json"), "id long, title string")
    assert bad.count() == 0 and sorted(tuple(r) for r in good.collect()) == [(r["id"], r["title"]) for r in rows]


def test_a_broken_element_is_set_aside(spark, tmp_path, small_ranges):
    texts = [json.dumps(r) for r in some(80, 2)]
    texts[40] = '{"id": 40, "title": nonsense}'
    (tmp_path / "a.json").write_text("[" + ",\n".join(texts) + "]\n")
    good, bad = jsonarray.read_array(spark, str(tmp_path / "a.json"), "id long, title string")
    assert sorted(r.id for r in good.collect()) == [i for i in range(80) if i != 40]
    assert [r.element for r in bad.collect()] == [texts[40]]


def test_a_cut_file_keeps_all_before_the_cut(spark, tmp_path, small_ranges):
    text = json.dumps(some(60, 3))
    (tmp_path / "a.json").write_text(text[: text.index('"id": 50') + 4])
    good, bad = jsonarray.read_array(spark, str(tmp_path / "a.json"), "id long, title string")
    assert sorted(r.id for r in good.collect()) == list(range(50)) and bad.count() == 1
