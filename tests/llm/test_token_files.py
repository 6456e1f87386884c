import zlib

import numpy as np
import public_tokenizers as P
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from delaylens.llm import token_files as T
from delaylens.llm.queries import op4_token_files

SMOKE = "/root/testdata/sf0.001"
PATH = P.path("word_bpe_49k.json")
PUBLIC = Tokenizer.from_file(PATH)
WORDS = T.WordIds(open(PATH, encoding="utf-8").read(), 50)


def library(text):
    return PUBLIC.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.text() | st.lists(st.sampled_from(["The", "the.", "THE,", "a..", ".", ",", "it's.", "A1.", "É.", "x.,", "ÇAàß,", "ǅŉİ.", "ĲŒſ", "ªº."])).map(" ".join) | st.text(alphabet=" \t\n\x1c\x85  '’stmreld0½Ⅷéßñ中😀ΣσİÅ̈́.,!-<|>endoftx"))
def test_ids_of_the_library(text):
    assert [np.frombuffer(x, dtype=WORDS.kind).tolist() for x in WORDS.encode([text, "", text])] == [library(text), [], library(text)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5000) | st.just(0) | st.integers(0, 10**6), min_size=0, max_size=700))
def test_boundaries_round_trip_and_select(lengths):
    ends = np.cumsum(lengths).astype(np.int64) if lengths else np.empty(0, dtype=np.int64)
    low, lower, upper, samples = T.pack(ends)
    b = T.Boundaries(len(ends), low, lower, upper, samples)
    assert b.all().tolist() == ends.tolist()
    assert [b.select(i) for i in range(len(ends))] == ends.tolist()
    if len(ends):
        assert (lower.nbytes + upper.nbytes) * 8 <= len(ends) * (3 + np.log2(max(1, ends[-1] / len(ends)))) + 192


def check(rows, docs):
    start = 0
    for r, (doc, text) in zip(rows, docs, strict=True):
        ids = [*library(text), 1]
        assert (r.doc_id, r.start, r.n_tokens) == (doc, start, len(ids))
        assert r.ids_crc32 == zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        start += len(ids)


def test_query_equals_library_on_all_documents(workers):
    docs = workers.read.parquet(f"{SMOKE}/documents.parquet").select("doc_id", "text")
    rows = sorted(op4_token_files(workers, SMOKE).collect(), key=lambda r: r.start)
    check(rows, sorted(tuple(r) for r in docs.collect()))


def test_edge_rows_and_small_files(workers):
    docs = [(None, "first"), (-5, None), (2, ""), (7, "word " * 5000), (7, "word " * 5000), (9, "<|endoftext|> É")]
    df = workers.createDataFrame([(*d, 3) for d in reversed(docs)], "doc_id long, text string, n_tokens int")
    manifest = T.write(df, PATH, p=T.FileParams(file_ids=100))
    rows = sorted(T.read_digests(manifest).collect(), key=lambda r: r.start)
    check(rows, docs)
    one = sorted(T.read(manifest).collect(), key=lambda r: r.start)[-1]
    assert np.frombuffer(one.ids, dtype="<u4").tolist() == [*library("<|endoftext|> É"), 1]
    assert T.read_digests(T.write(df.limit(0), PATH)).collect() == []


def test_control_strings_are_those_of_the_library():
    texts = ["x <|endoftext|> y", "x<|endoftext|>y", "<|startoftext|><|endoftext|>.", "<|ENDOFTEXT|> <|endoftext", "a.<|endoftext|>,b"]
    assert [np.frombuffer(x, dtype=WORDS.kind).tolist() for x in WORDS.encode(texts)] == [library(t) for t in texts]
    assert library(texts[0]) == [343, 49407, 344]


def test_folder_without_scheme_lies_in_the_default_file_system(workers, folder):
    df = workers.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    manifest = T.write(df, PATH, folder=folder + "/out")
    assert manifest.first().path.startswith("file:")
    assert [r.n_tokens for r in sorted(T.read(manifest).collect(), key=lambda r: r.start)] == [3, 2]


def test_file_gives_single_documents():
    lists = [[5, 6, 1], [1], list(range(300))] * 200
    ends = np.cumsum([len(x) for x in lists])
    image = b"".join(T.file_bytes(np.arange(len(lists)), ends, np.array(sum(lists, []), dtype="<u2")))
    file = T.TokenFile(image)
    assert len(file) == 600 and all(file[i].tolist() == lists[i] for i in range(len(file)))
