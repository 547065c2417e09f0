"""Repair of conversations against a search over all ways to edit them."""

import hashlib
import random
import re
import zlib

import pytest

from listprep.llm import repair
from tests.llm import helpers as h

GOOD = re.compile(r"(s?(ua)+)?")


def options(row, mark):
    """Edits of a row with up to two inserts before it: cost, letters, lines. Without a row only inserts."""
    inserts = [(0, "", ()), *[(5, "I", ((r, ""),)) for r in ("user", "assistant")]]
    inserts += [(10, "II", (("user", ""), ("assistant", ""))), (10, "II", (("assistant", ""), ("user", "")))]
    if row is None:
        return inserts
    extra = 5 if mark == "t" else 0
    edits = [(2, "D", ())]
    if mark not in ("b", "d"):
        edits += [(extra, "K", (row,)), *[(1 + extra, "R", ((r, row[1]),)) for r in ("user", "assistant")]]
    return [(a + c, x + y, m + n) for a, x, m in inserts for c, y, n in edits]


def initials(lines):
    return "".join(r[:1] or "-" for r, _ in lines)


def every_way(rows, marks):
    """The least of all ways, all of them written out."""
    ways = [(0, "", ())]
    for row, mark in [*zip(rows, marks, strict=True), (None, "")]:
        ways = [(a + c, x + y, m + n) for a, x, m in ways for c, y, n in options(row, mark)]
    return min((w for w in ways if GOOD.fullmatch(initials(w[2]))), key=lambda w: w[:2])


def least_way(rows, marks):
    """The same for more rows: of the ways whose initials so far may go on alike only the least goes on."""
    ways = {"": (0, "", ())}
    for row, mark in [*zip(rows, marks, strict=True), (None, "")]:
        found = {}
        for a, x, m in ways.values():
            for c, y, n in options(row, mark):
                way = (a + c, x + y, m + n)
                text = initials(way[2])
                if re.fullmatch(r"s?(ua)*u?", text):
                    alike = text if text in ("", "s") else text[-1]
                    found[alike] = min(found.get(alike, way), way, key=lambda w: w[:2])
        ways = found
    return min((w for w in ways.values() if GOOD.fullmatch(initials(w[2]))), key=lambda w: w[:2])


def brute(rows, search=least_way):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    marks, seen = [], set()
    for _, role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        marks.append("b" if not solid else "d" if (role, text) in seen else "t" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    cost, letters, lines = search([r[1:] for r in rows], marks)
    turns = {r[0] for r in rows if r[0] is not None}
    starts = [r[1][:1] for r in rows]
    return {
        "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        "blank": marks.count("b"), "duplicate": marks.count("d"), "truncated": marks.count("t"),
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(starts, starts[1:])),
        "cost": cost, "audit": letters,
        "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest(),
    }


ROLES = ["system", "user", "assistant", "user", "assistant", "tool", "", "sudo", "U", " "]
TEXTS = ["Yes.", "No!", "Why?", "cut", "", " \n\t", "a ", "end. \x0b"]


@pytest.mark.parametrize("seed", range(60))
def test_summary_is_the_least_of_all_ways(seed):
    rng = random.Random(seed)
    rows = [(rng.choice([None, 0, 1, 2, 3, 9, -4]), rng.choice(ROLES), rng.choice(TEXTS)) for _ in range(rng.randrange(9))]
    assert repair.summary(rows) == brute(rows)
    assert repair.summary(rows[:2]) == brute(rows[:2], every_way)


@pytest.mark.parametrize("seed", range(20))
def test_segments_give_the_same_as_the_whole(seed):
    rng = random.Random(seed)
    codes = "".join(rng.choice("suaxdSUAX" if seed % 2 else "uauaud") for _ in range(rng.randrange(1, 400)))
    size = rng.choice([1, 2, 7, 50, 500])
    parts = [codes[i : i + size] for i in range(0, len(codes), size)]
    cost, letters = repair.joined([repair.segment_moves(p) for p in parts])
    assert (cost, "".join(letters)) == repair.repaired(codes)
    assert [len(x.replace("I", "")) for x in letters] == [*map(len, parts), 0]


def test_long_weights_stay_whole_numbers():
    codes = "ua" * 3000 + "U" * 1000
    cost, letters = repair.repaired(codes)
    assert cost == 2000 and letters == "KK" * 3000 + "D" * 1000


def conversations(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for name in ("kind", "rows", "cost", "conv", "mark", "rn", "_conv"):
        df = df.selectExpr("*", f"'x' AS {name}")
    return df


def broken(rows):
    """Rows per conversation after damage, in plain Python."""
    out = {r[0]: [] for r in rows}
    for conv, turn, role, text in rows:
        name = ":".join(" " if v is None else str(v) for v in (conv, turn))
        kind = zlib.crc32(name.encode()) % 20
        role, text = role if role is not None else " ", text if text is not None else " "
        if kind == 0:
            continue
        row = (turn, "user" if kind == 4 else role, {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text))
        out[conv] += [row] * (2 if kind == 3 else 1)
    return out


def some_rows():
    rng = random.Random(5)
    rows = []
    for conv in [None, *range(60)]:
        for turn in range(rng.randrange(1, 6)):
            turn = None if rng.random() < 0.1 else turn + rng.choice([0, 0, 0, 1])
            role = rng.choice([None, *ROLES])
            rows.append((conv, turn, role, rng.choice([None, *TEXTS, "ünï. " * 3])))
    return [*rows, rows[7], rows[7]]


# (most rows, most bytes, rows of a segment): gathered, all in segments, some in segments
@pytest.mark.parametrize("bounds", [(2000, 1 << 20, 500), (0, 1 << 20, 2), (3, 1 << 20, 1), (2000, 30, 3)])
def test_rows_against_brute_force(spark, bounds):
    rows = some_rows()
    most_rows, most_bytes, segment = bounds
    got = repair.damage_and_repair(conversations(spark, rows), most_rows=most_rows, most_bytes=most_bytes, segment=segment)
    want = {c: brute(r) for c, r in broken(rows).items()}
    found = {r.conv_id: {k: r[k] for k in want[r.conv_id]} for r in got.collect()}
    assert found == want


def test_one_long_conversation(spark):
    """Two thirds of all rows in one conversation, some of them alike: cut in segments, the same as gathered."""
    rng = random.Random(3)
    rows = [(7, i // 2, rng.choice(["user", "assistant"]), f"{rng.randrange(900)} {rng.choice(TEXTS)}") for i in range(6000)]
    rows += [(i, 0, "user", "Hi.") for i in range(100, 3100)]
    table = conversations(spark, rows)
    cut = repair.damage_and_repair(table)
    whole = repair.damage_and_repair(table, most_rows=10**6)
    assert h.rows(cut) == h.rows(whole) and cut.count() == 3001


def test_empty_table(spark):
    assert repair.damage_and_repair(conversations(spark, [])).count() == 0


def test_conversation_without_rows_left(spark):
    gone = [(c, t, "user", "Hi.") for c in range(200) for t in (0,) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]
    assert gone
    for r in repair.damage_and_repair(conversations(spark, gone)).collect():
        assert (r.cost, r.audit, r.gaps, r.repaired_sha256) == (0, "", 0, hashlib.sha256(b"").hexdigest())
