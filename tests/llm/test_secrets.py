import hashlib
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from listprep.llm import automaton, secrets
from tests.llm import helpers as h

WORDS = "[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]"
ASSIGN = re.compile(rf"""({WORDS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(found)]


def ours(texts):
    return [
        [f"{secrets.RULES[r].kind}:{a}:{b}" for r, a, b in spans]
        for spans in secrets.scan_batch([t.encode() for t in texts])
    ]


CASES = [
    "token = \"9742a250774262d69ad6a86100194ed53da5a0ef\" x", "PassWord:abc secret=token=abcdef", "secret='abc' token: 'abcdef'",
    "AKIA" + "A1" * 8 + " AKIAAKIA" + "B2" * 7, "api_key==" + "x" * 6, "apikey\"  =   \"long.value/+=", "éé token=émile token=emilee",
    "0" * 23 + "g" + "0" * 24, "password" * 3 + "=abcdefg", "secretsecret: abcdef", "token=abc,token=abcdef;" * 3,
    "ghp_" + "a1B2" * 9, "x" * 500 + "passwd = " + "y" * 400, "AKIA" * 40, "token" + " " * 300 + "= abcdefgh", "",
]


def check(texts):
    for text, got in zip(texts, ours(texts), strict=True):
        assert [s for s in got if s.split(":")[0] in secrets.BASE] == base(text), text


def test_cases():
    check(CASES)
    check(CASES[::-1])


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.sampled_from(
    ["token", "secret", "api_key", "APIKEY", "pass", "word", "wd", "=", ":", " ", "'", '"', "abc", "def0", "0123456789ab", "AKIA",
     "ABCDEFGH", "Z", "\n", "é", ",", "."]), max_size=14).map("".join), max_size=6))
def test_any_texts(texts):
    check(texts)


def test_lanes_agree_with_a_plain_walk():
    a = secrets.combined(secrets.RULES)
    data = np.frombuffer(" ".join(CASES * 3).encode(), np.uint8)
    state, want = 0, []
    for i, b in enumerate(data.tolist()):
        state = a.moves[state * a.width + a.byte_class[b]]
        if a.accepts[state]:
            want.append(i)
    for lane in (1, 3, 64, 5000):
        assert automaton.scan(a, data, lane).tolist() == want


def test_own_kinds():
    got = ours(["ghp_" + "a1B2" * 9 + " xoxb-123-" + "a1" * 8 + " -----BEGIN RSA PRIVATE KEY----- eyJab.cd." + "x" * 20])[0]
    assert [g.split(":")[0] for g in got] == ["github", "slack", "key", "jwt"]


def test_odd_rows_and_query(spark, folder):
    texts = [*h.ODD, *CASES]
    docs = h.frame(spark, texts, extra=True)
    found = {}
    for r in secrets.scan(docs, tuple(docs.columns)).collect():
        found.setdefault((r.doc_id, r.text), [f"{s.kind}:{s.start}:{s.end}" for s in r.found if s.kind in secrets.BASE])
    assert all(v == base(t) for (_, t), v in found.items())
    assert secrets.scan(h.frame(spark, [])).count() == 0
    got = secrets.secret_scan(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    want = []
    for d, t in docs.select("doc_id", "text").collect():
        b = base(t)
        n = [sum(x.startswith(k + ":") for x in b) for k in secrets.BASE]
        want.append((d, *n, hashlib.sha256(",".join(b).encode()).hexdigest()))
    assert h.rows(got.drop("spans")) == sorted(want, key=h.key)
    assert got.count() == docs.count()
