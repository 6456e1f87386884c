import math
import random

from delaylens.llm import decontaminate as D
from delaylens.llm.common import words
from delaylens.llm.queries import OP5_SQL, all_queries

SMOKE = "/root/testdata/sf0.001"
ITEM = "the quick brown fox jumps over the lazy dog while seven green birds look on from a tree"


def test_matches_sql(workers, duck):
    query, sql = all_queries()["op5_benchmark_decontamination"]
    df = query(workers, SMOKE)
    got = sorted(tuple(r) for r in df.collect())
    res = duck.execute(sql)
    assert [c[0] for c in res.description] == df.columns
    assert got == sorted(res.fetchall()) and got


def test_edge_rows_and_long_documents(workers):
    filler = " ".join(f"w{k}" for k in range(40_000))
    rows = [(1, f"{filler} {ITEM.upper()}! {filler}"), (2, ITEM.replace("fox", "cat")), (3, None), (4, ""),
            (None, ITEM), (5, "short one"), (6, "only a short one here"), (7, ITEM), (7, ITEM), (8, ITEM[:40])]
    docs = workers.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, item_id string")
    items = workers.createDataFrame([(1, ITEM), (1, ITEM), (2, None), (3, "Short, one"), (None, "?")],
                                    "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in D.find(docs, items).collect()}
    assert got == {(1, 1), (None, 1), (7, 1), (5, 3), (6, 3)}  # a short item counts inside a text too
    kept = D.decontaminate(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 8]
    assert D.decontaminate(docs, items.limit(0)).count() == len(rows)
    assert D.find(docs.limit(0), items).collect() == []


def test_shuffled_and_broadcast_sketches_agree(workers):
    docs = workers.read.parquet(f"{SMOKE}/documents.parquet")
    items = workers.read.parquet(f"{SMOKE}/benchmark.parquet")
    a = {tuple(r) for r in D.find(docs, items).collect()}
    assert a == {tuple(r) for r in D.find(docs, items, D.ContainmentParams(broadcast_rows=0)).collect()} and a


def test_hits_of_a_class_keep_the_miss_rate_at_every_size():
    p = D.ContainmentParams()
    for q in (17, 31, 32, 63, 64, 100, 127, 500, 1023, 1024, 5000):
        need, found = p.hits(q.bit_length() - 1), math.ceil(p.similarity * q - 1e-9)
        below = sum(math.comb(found, m) * math.comb(q - found, p.sketch - m) for m in range(need)) / math.comb(q, p.sketch)
        assert below <= p.miss
    needs = [p.hits(c) for c in range(4, 12)]
    assert needs == sorted(needs, reverse=True) and needs[0] > needs[-1] >= 1
    assert len(words(ITEM)) == 18


def test_items_of_every_size_and_short_ones_equal_sql(workers, duck):
    rng = random.Random(7)
    texts = [" ".join(rng.choices(["red", "blue", "ox", "a1", "straße", "sol", "mar"], k=n)) for n in (1, 2, 3, 4, 5, 18, 25, 40, 70, 300)]
    docs = [(k, " ".join(rng.choices(["red", "blue", "ox", "a1", "straße", "mar"], k=rng.choice([1, 2, 4, 9, 60])))) for k in range(40)]
    docs += [(100 + k, f"x y z, {text.upper()}! {text}") for k, text in enumerate(texts)]
    docs += [(200 + k, " ".join(w if j % 40 else "other" for j, w in enumerate(text.split()))) for k, text in enumerate(texts)]
    for name, rows, key in (("documents", docs, "doc_id"), ("benchmark", list(enumerate(texts)), "item_id")):
        duck.execute(f"CREATE TEMP TABLE t_{name} ({key} BIGINT, text VARCHAR)")
        duck.executemany(f"INSERT INTO t_{name} VALUES (?, ?)", rows)
    sql = OP5_SQL.replace("FROM documents", "FROM t_documents").replace("FROM benchmark", "FROM t_benchmark")
    got = D.find(workers.createDataFrame(docs, "doc_id long, text string"),
                 workers.createDataFrame(list(enumerate(texts)), "item_id long, text string"))
    got = sorted(tuple(r) for r in got.select("doc_id", "item_id", "n_found", "n_shingles", "containment").collect())
    assert got == sorted(duck.execute(sql).fetchall()) and {i for _, i, *_ in got} == set(range(10))
