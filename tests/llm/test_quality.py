import zlib

import numpy as np

from delaylens.llm import quality as Q
from delaylens.llm.common import table

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_contract(workers):
    docs, labels = table(workers, SF, "documents"), table(workers, SF, "labels")
    rows = {r.doc_id: r for r in Q.classify(docs, labels).collect()}
    assert len(rows) == docs.count()
    for r in rows.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [(rows[x.doc_id], x.quality) for x in labels.collect() if rows[x.doc_id].held_out]
    right = sum(r.predicted == y for r, y in held)
    assert len(held) > 40 and right / len(held) > 0.9
    good = [r.score for r, y in held if y == 1]
    bad = [r.score for r, y in held if y == 0]
    assert np.mean([[b < g for g in good] for b in bad]) > 0.95


def test_sample_leaves_held_out_and_disputed_labels_away(workers):
    rows = [(k, k % 2) for k in range(200)] + [(1, 0), (7, None), (None, 1), (9, 5)]  # 5 is no label, so 9 keeps its own
    labels = workers.createDataFrame(rows, "doc_id long, quality int")
    got = {r.id: r.y for r in Q.labelled_sample(labels, Q.QualityParams()).collect()}
    want = {k: k % 2 for k in range(200) if zlib.crc32(str(k).encode()) % 5 and k not in (1,)}
    assert got == want
    assert Q.labelled_sample(labels, Q.QualityParams(max_labelled=10)).count() == 10


def test_edge_rows(workers):
    rows = [(None, "words here"), (1, None), (2, ""), (3, "a" * 200_000), (3, "a" * 200_000), (4, "x y " * 60_000)]
    docs = workers.createDataFrame([(*r, 1, 2.0) for r in rows], "doc_id long, text string, quality int, score double")
    none = workers.createDataFrame([], "doc_id long, quality int")
    out = Q.classify(docs, none).collect()
    assert len(out) == len(rows) and all(r.score == 0.5 and r.predicted == 1 for r in out)
    some = workers.createDataFrame([(k, k % 2) for k in range(1, 5)], "doc_id long, quality int")
    assert len(Q.classify(docs, some).collect()) == len(rows)
    assert Q.classify(docs.limit(0), some).collect() == []
    vectors, net = Q.fit(docs, none)
    assert Q.keep(docs, vectors, net).columns == docs.columns


def test_temperature_and_training():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 5)).astype(np.float32)
    y = (x[:, 0] + 0.3 * rng.normal(size=600) > 0).astype(float)
    net = Q.train(x, y, Q.QualityParams(epochs=100))
    assert net.temperature > 0 and ((net.scores(x) > 0.5) == y).mean() > 0.85
    assert Q.train(x, np.ones(600), Q.QualityParams()) is None
