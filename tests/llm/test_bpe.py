import hashlib
import tracemalloc

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from listprep.llm import bpe, flat
from tests.llm import helpers as h

with open(bpe.vocabulary(), "rb") as f:
    RANKS = bpe.parse_ranks(f.read())
PLAIN = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
OURS = bpe.Encoder(RANKS)

TEXTS = [
    "", " ", "\n", "  a", "a  ", "\t's", " 's", "  's", "!'s", "'s's 'll'll", "'save", "a'b'reX", "x\n\n y \t z", "I'm we've",
    "don't 'tis '' 's", "a1 b2  3", "　 x", "漢字 ünï", "é́ \U0001f600\U0001f600", "''''s", "1's", "\r\n'd",
    "a" * 5000, "=" * 300 + "ab" * 200, "x \x1c\x85y", "'l'r'v 'lle",
]


def sha(b):
    return hashlib.sha256(b).hexdigest()


def same(texts):
    for text, (ids, ends) in zip(texts, OURS.encode(texts), strict=True):
        assert ids.tolist() == PLAIN.encode_ordinary(text), text
        assert OURS.decode(ids) == text.encode()
        pieces = [text.encode()[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=False)]
        assert pieces == [OURS.bytes_of[i] for i in ids.tolist()]


def test_cases():
    same(TEXTS)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("'slrevdmt aB1.\n\té　!2")) | st.characters(codec="utf-8")), max_size=5))
def test_any_texts(texts):
    same(texts)


def test_scan_is_a_running_composition():
    basic, _, first, _ = bpe.machine()
    symbols = np.random.default_rng(1).integers(0, 8, 5000)
    got, state = first[bpe.scan(basic[symbols], 16)], bpe.FRESH
    for i, x in enumerate(symbols):
        state = bpe.step(x, state)
        assert got[i] == state


def want(docs):
    out = []
    for d, t in docs.select("doc_id", "text").collect():
        ids = PLAIN.encode_ordinary(t or "")
        out.append((d, len(ids), sha(np.array(ids, "<u4").tobytes()), sha((t or "").encode())))
    return sorted(out, key=h.key)


def test_odd_rows(spark):
    docs = h.frame(spark, h.ODD, extra=True)
    assert h.rows(bpe.digests(docs, bpe.vocabulary())) == want(docs)
    assert bpe.digests(h.frame(spark, []), bpe.vocabulary()).count() == 0
    full = bpe.encoded(docs, bpe.vocabulary(), tuple(docs.columns))
    assert full.columns == [*docs.columns, "ids", "ends", "decoded"]
    assert all(bytes(r.decoded).decode() == (r.text or "") for r in full.collect())


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query(spark, sf):
    folder = f"/root/testdata/{sf}"
    got = bpe.byte_bpe(spark, folder)
    assert h.rows(got) == want(spark.read.parquet(f"{folder}/documents.parquet"))


def test_memory_of_a_batch(spark):
    """Two workers of an executor run beside a full heap: arrays of a batch stay below 64 MB, batches sent are small."""
    batch = pa.RecordBatch.from_pydict({"text": [f"some words {i} of a text " * 80 for i in range(2000)]})
    size = getattr(bpe, "BATCH_BYTES", flat.BATCH_BYTES)
    OURS.encode(["warm"])
    tracemalloc.start()
    try:
        for part in flat.pieces([batch], "text", size):
            OURS.encode(part.column("text").to_pylist())
            flat.cut_powers(0)
        assert tracemalloc.get_traced_memory()[1] < 64 << 20
    finally:
        tracemalloc.stop()
    names = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"
    for name in names:
        spark.conf.unset(name)
    bpe.tokens(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), bpe.vocabulary())
    assert int(spark.conf.get(names[0])) <= 1000 and int(spark.conf.get(names[1])) <= 4 << 20
