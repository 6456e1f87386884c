import math
import random
import re
from collections import Counter

import numpy as np

from delaylens.llm import queries
from delaylens.llm import ranked_search as R

SMOKE = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [t.translate({c: c + 32 for c in range(65, 91)}) for t in TERM.findall(text or "")]


def brute(docs, items, top=50):
    counted = [(d, Counter(found), len(found)) for d, t in docs if (found := terms(t))]
    n_docs, total = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    of = {}
    for item, text in items:
        of.setdefault(item, set()).update(terms(text))
    out = []
    for item, words in of.items():
        scored = []
        for d, c, n in counted:
            m = 100 - 50 + (50 * n * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                        for t in words if c[t])
            if score > 0:
                scored.append((-score, (d is not None, d), d))
        out += [(item, k, d, -s) for k, (s, _, d) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=repr)


def got(docs, items, **kw):
    return sorted(map(tuple, R.search(docs, items, R.SearchParams(**kw)).collect()), key=repr)


def frames(spark, docs, items):
    return (spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id string, text string"))


def test_query_equals_brute_force_and_sql(workers, duck):
    docs = [(r.doc_id, r.text) for r in workers.read.parquet(f"{SMOKE}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in workers.read.parquet(f"{SMOKE}/benchmark.parquet").collect()]
    run, sql = queries.all_queries()["op11_ranked_search"]
    rows = sorted(map(tuple, run(workers, SMOKE).select("item_id", "rank", "doc_id", "score").collect()), key=repr)
    assert rows == brute(docs, items)
    assert rows == sorted(duck.execute(f"SELECT item_id, rank, doc_id, score FROM ({sql})").fetchall(), key=repr)


def corpus(seed, n=400):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(60)] + ["Été", "É", "12", "中文"]
    text = lambda size: " ".join(rng.choice(words) for _ in range(rng.randint(0, size)))
    docs = [(k, text(30)) for k in range(n)]
    docs += [(n + k, "w1 W1, w2.") for k in range(90)]  # ties beyond the last place
    return docs, [(f"i{k}", text(12)) for k in range(15)] + [("tie", "w1-w2")]


def test_tiles_blocks_groups_and_cuts(workers):
    docs, items = corpus(1)
    d, i = frames(workers, docs, items)
    want = brute(docs, items)
    assert got(d.repartition(5), i) == want
    assert got(d.repartition(3), i, tile_items=2, block_docs=7, group_terms=20, exact_sum=10**10) == want
    assert got(d.repartition(9), i, top=3, tile_items=4, block_docs=50) == brute(docs, items, 3)


def test_odd_rows(workers):
    docs = [(None, "a b"), (None, "a b"), (1, None), (2, ""), (3, "...\n"), (4, "a " * 60_000), (5, "A B"), (5, "a b"), (6, "nothing")]
    items = [("x", "a"), ("x", "b"), (None, "b zz"), ("none", "qq"), ("empty", ""), ("null", None), ("x", "a")]
    d, i = frames(workers, docs, items)
    assert got(d, i) == brute(docs, items)
    assert got(d.limit(0), i) == [] == got(d, i.limit(0))
    assert got(d.where("doc_id < 4"), i) == []
    assert R.search(d, i.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]
    extra = d.selectExpr("doc_id", "text", "1 AS n", "'s' AS score", "2 AS rank", "3 AS item", "'q' AS salt")
    assert got(extra, i.selectExpr("*", "5 AS rank", "6 AS item", "7 AS term")) == brute(docs, items)


def test_partial_sums_are_exact():
    """Terms are cut so that partial sums stay below the bound; the sums equal exact integers."""
    rng = np.random.default_rng(3)
    weight = rng.integers(1, 40_000, 300)
    tile = R.Tile([np.arange(300), np.arange(0, 300, 2)], weight, 1 << 36)
    assert len(tile.cuts) > 20
    for a, b in zip(tile.cuts[:-1], tile.cuts[1:]):
        assert b - a == 1 or tile.matrix[a:b].sum(axis=0).max() * R.IMPACT_LIMIT < 1 << 36
    impact = rng.integers(0, R.IMPACT_LIMIT, 300)
    got_ = tile.scores(np.zeros(300, dtype=int), np.arange(300), impact, 1)
    assert got_.tolist() == [[sum(int(w) * int(x) for w, x in zip(weight[::s], impact[::s])) for s in (1, 2)]]
