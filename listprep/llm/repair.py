"""Conversation structure repair by one integer minimum over a graph of edits.

A repair keeps, re-roles or deletes every row and may insert rows between them, so that the role initials read
``(s?(ua)+)?``. A node of the graph is a row and what the repaired rows before it end with; an edge is an edit. The
weight of a way is one big integer: its high digits are the cost, its low digits the letters of the edits, three bits
each, first letter highest, zeros behind the end. So the smallest integer is the cheapest way, and of equally cheap ones
the one whose letters come first; nothing else is compared.

Conversations of up to ``ROWS`` rows and ``BYTES`` of text are gathered one by one. A longer one is cut in
segments of equal numbers of rows. Each segment, by itself, gives the least weight from every state before it to every
state after it; only these small tables meet, and the texts are read once more in order to make the digest. Within one
pair of states two ways of equal cost are never a prefix of each other (the longer one would hold an insert more, which
costs), so the parts' own minima make up the minimum of the whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache, lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listprep.llm.registry import narrow, query, shipped, stored
from listprep.operators.joins import join_unique
from listprep.operators.numbering import number_rows

# Costs of edits.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
# Largest conversation that is gathered whole; rows of one segment of a longer one.
ROWS, BYTES, SEGMENT = 2000, 8 << 20, 500

# What the repaired rows so far end with: nothing, s, u, a; the next initial to be re-roled or inserted, and where it leads.
NEXT = (2, 2, 3, 2)
ROLE = ("user", "user", "assistant", "user")
DONE = (0, 3)
LETTER = {"D": 1, "I": 2, "K": 3, "R": 4}
LETTERS = " DIKR"
BITS = 3

SPACES = " \t\n\x0b\f\r"


def _kept(state: int, initial: str) -> int | None:
    """Where keeping a row with this initial leads."""
    if initial == "s":
        return 1 if state == 0 else None
    if initial == "u":
        return 2 if state != 2 else None
    return 3 if initial == "a" and state == 2 else None


@cache
def _edits(code: str) -> tuple[tuple[tuple[int, str, int], ...], ...]:
    """Per state the edits (cost, letter, next state) of a row. ``code`` is ``d`` for a row that must go, else its
    initial (x: none of s, u, a), a capital if the text is truncated."""
    if code == "d":
        return tuple(((DELETE, "D", q),) for q in range(4))
    extra = TRUNCATED if code.isupper() else 0
    out = []
    for q in range(4):
        edits = [(DELETE, "D", q), (REROLE + extra, "R", NEXT[q])]
        kept = _kept(q, code.lower())
        if kept is not None:
            edits.append((extra, "K", kept))
        out.append(tuple(edits))
    return tuple(out)


def _least(codes: str, ends: tuple[int, ...], closing: bool) -> list[tuple[int, str] | None]:
    """Per state before the rows the cost and letters of the least way to one of the states ``ends`` behind them, or
    None. Rows may be inserted before each row, and at the end if ``closing``. More than two inserts in one place come
    back to a state already met, so two are enough."""
    # a way of least cost deletes all at worst, so inserts are few: this many letters always hold it
    width = len(codes) + (DELETE * len(codes) + 2 * INSERT) // INSERT + 4
    low = BITS * width
    top, mask = low - BITS, (1 << low) - 1
    far = 1 << (low + 64)

    def step(cost: int, letter: str, rest: int) -> int:
        return ((cost + (rest >> low)) << low) | (LETTER[letter] << top) | ((rest & mask) >> BITS)

    def inserted(values: list[int]) -> list[int]:
        once = [min(values[q], step(INSERT, "I", values[NEXT[q]])) for q in range(4)]
        return [min(values[q], step(INSERT, "I", once[NEXT[q]])) for q in range(4)]

    values = [0 if q in ends else far for q in range(4)]
    if closing:
        values = inserted(values)
    for code in reversed(codes):
        values = inserted([min(step(c, x, values[to]) for c, x, to in edits) for edits in _edits(code)])
    return [None if v >= far else (v >> low, _spelled(v & mask, top)) for v in values]


def _spelled(digits: int, top: int) -> str:
    """The letters of a weight's low digits, up to the padding."""
    # one octal digit per letter, so the conversion is done at once
    return format(digits, f"0{top // BITS + 1}o").rstrip("0").translate(_OCTAL)


_OCTAL = str.maketrans({str(i): c for i, c in enumerate(LETTERS)})


@lru_cache(1 << 16)
def _known(codes: str) -> tuple[int, str]:
    return _least(codes, DONE, True)[0]


def repaired(codes: str) -> tuple[int, str]:
    """Cost and letters of the repair of a whole conversation, by the codes of its rows; short ones come again and
    again and are kept."""
    return _known(codes) if len(codes) <= 16 else _known.__wrapped__(codes)


def segment_moves(codes: str) -> list[list[tuple[int, str] | None]]:
    """For every state behind a segment and every state before it the least cost and letters."""
    return [_least(codes, (end,), False) for end in range(4)]


def joined(segments: list[list[list[tuple[int, str] | None]]]) -> tuple[int, list[str]]:
    """Cost and the letters per segment, the last item being the inserts at the end."""
    close = _least("", DONE, True)
    best = [None if w is None else (w[0], w[1], None) for w in close]
    for moves in reversed(segments):
        now = []
        for q in range(4):
            ways = []
            for end in range(4):
                if moves[end][q] is not None and best[end] is not None:
                    ways.append((moves[end][q][0] + best[end][0], moves[end][q][1] + best[end][1], (moves[end][q][1], end)))
            now.append(min(ways, key=lambda w: w[:2]) if ways else None)
        best = [None if w is None else (w[0], w[1], (w[2], best)) for w in now]
    cost, letters, _ = best[0]
    parts, at, q, values = [], 0, 0, best
    for _ in segments:
        (part, q), values = values[q][2]
        parts.append(part)
        at += len(part)
    return cost, [*parts, letters[at:]]


def per_row(letters: str) -> list[str]:
    """The letters cut behind every row's own edit: inserts before a row stand before its letter."""
    out, start = [], 0
    for i, letter in enumerate(letters):
        if letter != "I":
            out.append(letters[start : i + 1])
            start = i + 1
    return out if start == len(letters) else [*out, letters[start:]]


def written(edits: str, state: int, role: str, text: str) -> tuple[list[str], int]:
    """What the edits of one row write, and the state behind it."""
    out = []
    for letter in edits:
        if letter == "I":
            out.append(f"{ROLE[state]}:")
        elif letter == "R":
            out.append(f"{ROLE[state]}:{text}")
        elif letter == "K":
            out.append(f"{role}:{text}")
            state = _kept(state, role[:1])
            continue
        else:
            continue
        state = NEXT[state]
    return out, state


def fault(text: str, seen: bool) -> str:
    """b(lank), d(uplicate), t(runcated) or nothing: the first that holds."""
    solid = text.rstrip(SPACES)
    if not solid:
        return "b"
    if seen:
        return "d"
    return "" if solid[-1] in ".!?" else "t"


def code_of(role: str, mark: str) -> str:
    if mark in ("b", "d"):
        return "d"
    initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
    return initial.upper() if mark == "t" else initial


def illegal(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))


def summary(rows: list[tuple[int | None, str, str]]) -> dict:
    """All results of one conversation, given its rows (turn, role, text) after damage, in any order."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, marks = set(), []
    for _, role, text in rows:
        marks.append(fault(text, (role, text) in seen))
        seen.add((role, text))
    cost, letters = repaired("".join(code_of(r[1], m) for r, m in zip(rows, marks, strict=True)))
    lines, state = [], 0
    for (_, role, text), edits in zip([*rows, (None, "", "")], [*per_row(letters), ""][: len(rows) + 1], strict=False):
        made, state = written(edits, state, role, text)
        lines += made
    turns = {r[0] for r in rows} - {None}
    return {
        "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        "blank": marks.count("b"),
        "duplicate": marks.count("d"),
        "truncated": marks.count("t"),
        "illegal": illegal([r[1][:1] for r in rows]),
        "cost": cost,
        "audit": letters,
        "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    }


RESULT = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after damage by crc32 of ``conv_id:turn``; a null counts as one space."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = (F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn"))) % 20).alias("kind")
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        blank("role").alias("role"), blank("text").alias("text"), kind,
    ).filter("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.when(F.col("kind") == 3, 2).otherwise(1)
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.explode(F.array_repeat(F.lit(True), times)).alias("_"),
    ).drop("_")


def _gathered(rows: DataFrame) -> DataFrame:
    """Results of conversations that are gathered whole."""
    whole = rows.groupBy("conv_id").agg(F.collect_list(F.struct("turn", "role", "text")).alias("rows"))

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            found = [summary([(r["turn"], r["role"], r["text"]) for r in rows]) for rows in batch.column("rows").to_pylist()]
            if found:
                columns = [pa.array([f[k] for f in found]) for k in found[0]]
                yield pa.RecordBatch.from_arrays([batch.column("conv_id"), *columns], names=["conv_id", *found[0]])

    return shipped(whole).mapInArrow(run, f"conv_id long, {RESULT}")


def _faults(numbered: DataFrame) -> DataFrame:
    """Adds first (the first row of the conversation with this role and text) and mark (see ``fault``)."""
    own = numbered.withColumn("body", F.xxhash64("role", "text"))
    firsts = own.groupBy("conv", "role", "text").agg(F.min("rn").alias("first"))
    own = join_unique(own, firsts, ["conv", "role", "text"], "left")
    solid = F.rtrim(F.translate("text", "\t\n\x0b\f\r", "     "))
    mark = (
        F.when(solid == "", "b").when(F.col("first") < F.col("rn"), "d")
        .when(~F.substring(solid, -1, 1).isin(".", "!", "?"), "t").otherwise("")
    )
    return own.withColumn("mark", mark)


def _long(rows: DataFrame, segment: int) -> DataFrame:
    """Results of conversations that are too long to be gathered, without a task that holds one's texts.

    One conversation's letters are one string and its digest is one pass over its rows, so both are made by one task
    each; the first holds some 20 bytes per row, the second one batch of rows."""
    # equal rows get numbers of their own; a null conversation has a key of its own
    conv = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    same = rows.groupBy(conv.alias("conv"), "conv_id", "turn", "role", "text").agg(F.count("*").cast("int").alias("n"))
    each = same.select("conv", "conv_id", "turn", "role", "text", F.explode(F.sequence(F.lit(1), "n")).alias("copy"))
    numbered = number_rows(each, [F.col("turn").isNotNull().alias("late"), "turn", "role", "text", "copy"], ["conv"])
    marked = stored(_faults(numbered), "repair-rows")
    part = F.call_function("div", F.col("rn") - 1, F.lit(segment)).alias("part")
    slim = marked.groupBy("conv", part).agg(
        F.sort_array(F.collect_list(F.struct("rn", F.substring("role", 1, 1).alias("initial"), "mark"))).alias("rows")
    )
    weight = "array<struct<cost:bigint,letters:string>>"

    def moves(batches: Iterator[pa.RecordBatch]):
        kind = pa.list_(pa.struct([("cost", pa.int64()), ("letters", pa.string())]))
        for batch in batches:
            made, initials, codes = [], [], []
            for rows in batch.column("rows").to_pylist():
                code = "".join(code_of(r["initial"], r["mark"]) for r in rows)
                flat = [w for end in segment_moves(code) for w in end]
                made.append([None if w is None else {"cost": w[0], "letters": w[1]} for w in flat])
                initials.append([rows[0]["initial"], rows[-1]["initial"]])
                codes.append(illegal([r["initial"] for r in rows]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv"), batch.column("part"), pa.array(made, kind), pa.array(initials, pa.list_(pa.string())),
                 pa.array(codes, pa.int64())],
                names=["conv", "part", "moves", "edges", "inside"],
            )

    tables = shipped(slim).mapInArrow(moves, f"conv string, part long, moves {weight}, edges array<string>, inside long")
    tables = tables.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("part", "edges", "inside", "moves"))).alias("parts"))

    def solve(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for conv, parts in zip(batch.column("conv").to_pylist(), batch.column("parts").to_pylist(), strict=True):
                flat = [[None if w is None else (w["cost"], w["letters"]) for w in p["moves"]] for p in parts]
                cost, letters = joined([[m[4 * e : 4 * e + 4] for e in range(4)] for m in flat])
                wrong = sum(p["inside"] for p in parts)
                wrong += sum(illegal([a["edges"][1], b["edges"][0]]) for a, b in zip(parts, parts[1:], strict=False))
                n = len(letters)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([conv] * n), pa.array(range(n), pa.int64()), pa.array(letters), pa.array([cost] * n, pa.int64()),
                     pa.array([wrong] * n, pa.int64())],
                    names=["conv", "part", "letters", "cost", "illegal"],
                )

    solved = stored(
        shipped(tables).mapInArrow(solve, "conv string, part long, letters string, cost long, illegal long"), "repair-letters"
    )
    # the edits of a row: inserts before it and its own letter; those at the end are a row of their own
    each_row = F.posexplode(F.regexp_extract_all("letters", F.lit("(I*[DKR]|I+$)"), F.lit(1))).alias("at", "edits")
    edits = solved.select("conv", "part", each_row).select(
        "conv", (F.col("part") * segment + F.col("at") + 1).alias("rn"), "edits"
    )
    lines = edits.join(marked.select("conv", "rn", "role", "text"), ["conv", "rn"], "left").filter("edits <> 'D'")

    def digest(batches: Iterator[pa.RecordBatch]):
        now, sha, state, empty = None, None, 0, True
        for batch in batches:
            for conv, edits, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "edits", "role", "text")), strict=True):
                if conv != now:
                    if sha is not None:
                        yield _one(now, sha)
                    now, sha, state, empty = conv, hashlib.sha256(), 0, True
                made, state = written(edits, state, role or "", text or "")
                for line in made:
                    sha.update((line if empty else "\n" + line).encode())
                    empty = False
        if sha is not None:
            yield _one(now, sha)

    def _one(conv, sha):
        return pa.RecordBatch.from_arrays([pa.array([conv]), pa.array([sha.hexdigest()])], names=["conv", "repaired_sha256"])

    ordered = lines.repartition("conv").sortWithinPartitions("conv", "rn").select("conv", "edits", "role", "text")
    digests = shipped(ordered).mapInArrow(digest, "conv string, repaired_sha256 string")
    count = lambda mark: F.count(F.when(F.col("mark") == mark, 1))
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0))
    totals = marked.groupBy("conv", "conv_id").agg(
        gaps.alias("gaps"), count("b").alias("blank"), count("d").alias("duplicate"), count("t").alias("truncated")
    )
    letters = solved.groupBy("conv").agg(
        F.max("illegal").alias("illegal"), F.max("cost").alias("cost"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "letters"))), lambda p: p["letters"]), "").alias("audit"),
    )
    return totals.join(letters, "conv").join(digests, "conv", "left").select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )


def repair(rows: DataFrame, most_rows: int = ROWS, most_bytes: int = BYTES, segment: int = SEGMENT) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text; no null role or text): faults and the repair.

    Rows are taken by turn, nulls first, then role and text by their bytes; rows equal in all are taken one after the
    other. A null conv_id is one conversation. Texts and conversations may have any length: those above the two bounds
    are cut in segments, with the same result. An empty table gives no rows; other columns are ignored."""
    rows = rows.select("conv_id", "turn", "role", "text")
    size = rows.groupBy("conv_id").agg(F.count("*").alias("n"), F.sum(F.octet_length("role") + F.octet_length("text")).alias("bytes"))
    big = stored(size.filter((F.col("n") > most_rows) | (F.col("bytes") > most_bytes)).select(F.col("conv_id").alias("_big")), "repair-long")
    if big.isEmpty():
        return _gathered(rows)
    match = rows.conv_id.eqNullSafe(F.col("_big"))
    side = narrow(big)
    short, long = rows.join(side, match, "left_anti"), rows.join(side, match, "left_semi")
    return _gathered(short).unionByName(_long(long, segment))


def damage_and_repair(conversations: DataFrame, **options) -> DataFrame:
    """One row per conversation of the table, after damage (see ``damaged`` and ``repair``); one that lost all its rows
    has zeros, no letters and the digest of nothing."""
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    done = repair(damaged(conversations), **options).withColumnRenamed("conv_id", "_conv")
    both = ids.join(done, ids.conv_id.eqNullSafe(done._conv), "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return both.select(
        "conv_id", *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )


@query(
    "op13_conversation_repair",
    sql=r"""
    WITH RECURSIVE s AS MATERIALIZED (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
                              lambda x: unicode(x)::BIGINT) AS name
        FROM conversations
    ), k AS MATERIALIZED (
        SELECT *, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, name), lambda c, b:
                   list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
                               lambda x, y: xor(x >> 1, 3988292384 * (x & 1))))) % 20 AS kind
        FROM s
    ), d AS (
        SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
               CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
               unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END))
        FROM k WHERE kind <> 0
    ), o AS (
        SELECT *, rn > min(rn) OVER (PARTITION BY conv_id, role, text) AS again,
               regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS last
        FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS rn FROM d)
    ), r AS MATERIALIZED (
        SELECT *, CASE WHEN last = '' THEN 'b' WHEN again THEN 'd' WHEN last NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS mark,
               left(role, 1) AS initial, left(lag(role) OVER (PARTITION BY conv_id ORDER BY rn), 1) || left(role, 1) AS pair
        FROM o
    ), n(q, role, nq) AS (
        VALUES (0, 'user', 2), (1, 'user', 2), (2, 'assistant', 3), (3, 'user', 2)
    ), gap AS MATERIALIZED (
        SELECT q, q AS gq, 0 AS gc, '' AS gl, []::VARCHAR[] AS gt FROM n
        UNION ALL SELECT q, nq, 5, 'I', [role || ':'] FROM n
        UNION ALL SELECT a.q, b.nq, 10, 'II', [a.role || ':', b.role || ':'] FROM n a JOIN n b ON b.q = a.nq
    ), keep(q, initial, nq) AS (
        VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)
    ), edit AS MATERIALIZED (
        SELECT q, 'D' AS el, NULL::VARCHAR AS initial, NULL::VARCHAR AS erole, q AS eq FROM n
        UNION ALL SELECT q, 'R', NULL, role, nq FROM n
        UNION ALL SELECT q, 'K', initial, NULL, nq FROM keep
    ), p AS (
        SELECT DISTINCT conv_id, 0::BIGINT AS i, 0 AS q, 0 AS cost, '' AS audit, []::VARCHAR[] AS lines FROM r
        UNION ALL
        SELECT conv_id, i, q, cost, audit, lines FROM (
            SELECT *, row_number() OVER (PARTITION BY conv_id, q ORDER BY cost, audit) AS best FROM (
                SELECT p.conv_id, p.i + 1 AS i, edit.eq AS q,
                       p.cost + gc + CASE el WHEN 'D' THEN 2 WHEN 'R' THEN 1 ELSE 0 END
                           + CASE WHEN el <> 'D' AND mark = 't' THEN 5 ELSE 0 END AS cost,
                       p.audit || gl || el AS audit,
                       list_concat(list_concat(p.lines, gt),
                                   CASE WHEN el = 'D' THEN []::VARCHAR[] ELSE [coalesce(erole, r.role) || ':' || r.text] END) AS lines
                FROM p JOIN r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.rn = p.i + 1
                JOIN gap ON gap.q = p.q
                JOIN edit ON edit.q = gq AND (el = 'D' OR mark NOT IN ('b', 'd')) AND (el <> 'K' OR edit.initial = r.initial)
            )
        ) WHERE best = 1
    ), c AS MATERIALIZED (
        SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
               count(*) FILTER (mark = 'b') AS blank, count(*) FILTER (mark = 'd') AS duplicate,
               count(*) FILTER (mark = 't') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
        FROM r GROUP BY conv_id
    ), e AS (
        SELECT c.*, cost + gc AS cost, audit || gl AS audit, list_concat(lines, gt) AS lines,
               row_number() OVER (PARTITION BY c.conv_id ORDER BY cost + gc, audit || gl) AS best
        FROM p JOIN c ON c.conv_id IS NOT DISTINCT FROM p.conv_id AND c.n = p.i JOIN gap ON gap.q = p.q
        WHERE gq IN (0, 3)
    )
    SELECT a.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
           coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
           coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit,
           sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) a
    LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM a.conv_id AND e.best = 1
    """,
)
def conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return damage_and_repair(spark.read.parquet(f"{folder}/conversations.parquet"))
