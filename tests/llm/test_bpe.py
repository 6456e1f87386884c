import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from delaylens.llm import bpe
from delaylens.llm.queries import RANKS, op2_byte_bpe

SMOKE = "/root/testdata/sf0.001"
TOKENS = bpe.read_ranks(RANKS)
ENCODER = bpe.Encoder(TOKENS, P.PATTERN)
PUBLIC = tiktoken.Encoding("public", pat_str=P.PATTERN, special_tokens={},
                           mergeable_ranks={t: i for i, t in enumerate(TOKENS)})


@settings(max_examples=400, deadline=None)
@given(st.text() | st.text(alphabet=" \t\n\x1c\x85  '’stmreld0½Ⅷéßñ中😀é.,!-") | st.text(alphabet="ab ", min_size=30))
def test_same_ids_as_the_public_library(text):
    ids = ENCODER.encode([text])[0]
    assert ids == PUBLIC.encode_ordinary(text)
    assert b"".join(TOKENS[i] for i in ids) == text.encode()


def test_long_texts_in_pieces(monkeypatch):
    rng = random.Random(3)
    text = "".join(rng.choice([" word", "  ", "\n", "x" * 50, " 12", "é", "'s", " ."]) for _ in range(20_000))
    want = PUBLIC.encode_ordinary(text)
    monkeypatch.setattr(bpe, "BLOCK_CHARS", 997)
    assert "".join(bpe.pieces(text, 997)) == text
    assert ENCODER.encode([text])[0] == want
    assert ENCODER.encode(["a" * 5000])[0] == PUBLIC.encode_ordinary("a" * 5000)


def test_memo_may_be_emptied():
    small = bpe.Encoder(TOKENS, P.PATTERN, memo_size=3)
    for text in ["one two three four five", "six two seven", "one nine"] * 2:
        assert small.encode([text])[0] == PUBLIC.encode_ordinary(text)


def test_perfect_hash_is_minimal():
    keys = np.unique(np.random.default_rng(1).integers(0, 2**63, 5000).astype(np.uint64))
    assert sorted(bpe.PerfectHash(keys).find(keys).tolist()) == list(range(len(keys)))


def test_query_equals_library_on_all_documents(workers):
    docs = {r.doc_id: r.text for r in workers.read.parquet(f"{SMOKE}/documents.parquet").collect()}
    rows = op2_byte_bpe(workers, SMOKE).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        ids = PUBLIC.encode_ordinary(docs[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()


def test_edge_rows(workers):
    rows = [(None, "a b"), (1, None), (1, ""), (2, "x " * 50_000), (3, "a b"), (3, "a b")]
    df = workers.createDataFrame([(*r, [1]) for r in rows], "doc_id long, text string, ids array<int>")
    coded = bpe.decode(bpe.encode(df, RANKS, P.PATTERN), RANKS)
    got = sorted(((r.doc_id, len(r.ids), bytes(r.decoded).decode()) for r in coded.collect()), key=repr)
    assert got == sorted(((d, len(PUBLIC.encode_ordinary(t or "")), t or "") for d, t in rows), key=repr)
    assert bpe.encode(df.limit(0), RANKS, P.PATTERN).collect() == []
    bad = workers.createDataFrame([(1, [10**6])], "doc_id long, ids array<int>")
    with pytest.raises(Exception, match="not in the vocabulary"):
        bpe.decode(bad, RANKS).collect()
