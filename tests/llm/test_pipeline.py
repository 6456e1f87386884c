import hashlib

import public_tokenizers as P
import tiktoken
from test_ngram_join import brute, grams

import corpus_pipeline
from delaylens.llm import bpe, quality
from delaylens.llm.common import table
from delaylens.llm.queries import RANKS

SF = "/root/testdata/sf0.001"


def test_every_stage_equals_brute_force(workers, folder):
    """Each stage is judged on the rows that the stage before kept."""
    docs = table(workers, SF, "documents")
    kept = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(workers, docs, SF)
        if k < 3:
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        out.write.parquet(f"{folder}/{name}")
        kept.append({r.doc_id: r for r in docs.collect()})
        docs = workers.read.parquet(f"{folder}/{name}")
    final = {r.doc_id: r for r in docs.collect()}
    first, second, third, fourth = kept

    scores = {r.doc_id: r.score for r in quality.classify(table(workers, SF, "documents"), table(workers, SF, "labels")).collect()}
    assert set(second) == {d for d in first if scores[d] >= 0.3}

    rows = [(d, r.text) for d, r in second.items()]
    assert set(third) == {doc for doc, _, _, comp in brute(rows) if doc == comp}

    items = [grams(r.text) for r in table(workers, SF, "benchmark").collect()]
    leaks = {d for d, r in third.items() if any(len(q & grams(r.text)) >= 0.8 * len(q) for q in items)}
    assert leaks and set(fourth) == set(third) - leaks

    public = tiktoken.Encoding("public", pat_str=P.PATTERN, special_tokens={},
                               mergeable_ranks={t: i for i, t in enumerate(bpe.read_ranks(RANKS))})
    assert set(final) == set(fourth)
    for d, r in final.items():
        ids = public.encode_ordinary(fourth[d].text)
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(fourth[d].text.encode()).hexdigest()


def test_run_applies_all_stages(workers):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "byte_bpe"]
    df = corpus_pipeline.run(workers, SF)
    assert df.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and 0 < df.count() < 200


def test_stages_take_empty_and_odd_documents(workers):
    schema = table(workers, SF, "documents").schema
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "w " * 50_000, "en", "s", 1)]
    for docs in (workers.createDataFrame([], schema), workers.createDataFrame(rows, schema)):
        for _, stage in corpus_pipeline.STAGES:
            stage(workers, docs, SF).collect()
