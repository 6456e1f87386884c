import os

import numpy as np

from delaylens.llm import embedding_join as E
from delaylens.llm.common import table

SMOKE = "/root/testdata/sf0.001"


def brute(rows, cosine=0.9):
    """(id, links, component, kept) by comparing all pairs in double precision."""
    unit = []
    for _, v in rows:
        a = np.array([np.nan if c is None else c for c in v or []], dtype=float)
        unit.append(a / np.linalg.norm(a) if len(a) and np.isfinite(a).all() and np.linalg.norm(a) > 0 else None)
    n = len(rows)
    linked = {i: {j for j in range(n) if j != i and unit[i] is not None and unit[j] is not None
                  and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= cosine} for i in range(n)}
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            new = linked[todo.pop()] - seen
            seen |= new
            todo += new
        comp = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((rows[i][0], len(linked[i]), comp, rows[i][0] is not None and rows[i][0] == comp))
    return sorted(out, key=repr)


def got(df, p=E.RangeParams()):
    return sorted((tuple(r) for r in E.near_duplicates(df, p).collect()), key=repr)


def test_equals_all_pairs_on_embeddings(workers):
    df = table(workers, SMOKE, "embeddings")
    rows = [(r.vec_id, r.embedding) for r in df.select("vec_id", "embedding").collect()]
    assert got(df) == brute(rows)


def test_clusters_chains_and_hot_cells_in_many_tiles(workers):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 16))
    x = [c + rng.normal(size=16) * s for c in centres for s in (0.05, 0.2, 0.35, 0.5) for _ in range(10)]
    x += [centres[0] + rng.normal(size=16) * 0.1 for _ in range(150)]
    turn = [[np.cos(t), np.sin(t)] + [0.0] * 14 for t in np.arange(0, 3, 0.4)]  # a chain of links
    rows = [(k, [float(c) for c in v]) for k, v in enumerate([*x, *turn])]
    df = workers.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = brute(rows)
    assert got(df, E.RangeParams(cell=20, tile=32)) == want
    assert got(df, E.RangeParams(cell=10_000)) == want
    assert got(df, E.RangeParams(cell=1, max_pivots=1000)) == want  # more than 600 pivots


def test_edge_rows(workers):
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [None, 1.0]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]),
            (7, [1.0, 0.0]), (8, [1e30, 0.0]), (8, [1e-30, 0.0]), (None, [0.0, 2.0]), (9, [0.0, 1.0]), (10, [1.0, 0.0, 0.0])]
    df = workers.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, row string")
    assert got(df) == brute(rows)
    assert got(df.limit(0)) == [] and got(df.where("vec_id = 1")) == [(1, 0, 1, True)]


def test_every_length_is_joined(workers):
    rows = [(k, [1.0, 0.01 * k]) for k in range(5)] + [(10, [1.0, 0.0, 0.0]), (11, [1.0, 0.1, 0.0]), (12, [0.0, 0.0, 1.0]),
                                                     (13, [3.0]), (14, [2.0]), (15, [1.0, 0.0, 0.0, 0.0])]
    df = workers.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {r[0]: r[1:3] for r in got(df)}
    assert [found[k] for k in (10, 11, 12, 13, 14, 15)] == [(1, 10), (1, 10), (0, 12), (1, 13), (1, 13), (0, 15)]
    assert all(found[k] == (4, 0) for k in range(5))


def test_what_is_written_doesnt_grow_with_the_pairs(workers):
    """Without clusters every block meets every other; each vector is still written twice at most."""
    x = np.random.default_rng(7).normal(size=(3000, 32)).astype(np.float32)
    df = workers.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<float>").coalesce(2)
    base = f"{workers.sparkContext.getCheckpointDir()}/delaylens".removeprefix("file:")
    before = set(os.listdir(base)) if os.path.isdir(base) else set()
    got(df, E.RangeParams(cell=100, tile=128))
    sizes = [os.path.getsize(f"{d}/{f}") for name in set(os.listdir(base)) - before if name.startswith(("range-vectors", "range-cells", "range-blocks"))
             for d, _, files in os.walk(f"{base}/{name}") for f in files]
    assert 2 * x.nbytes < sum(sizes) < 3 * x.nbytes


def test_mixed_precision_lies_in_one_block(workers):
    """Vectors that single precision holds exactly, and others, are compared in double precision."""
    rows = [(k, [0.1 * k + 0.3, 1.0, 2.0]) for k in range(6)] + [(k, [float(k), 1.0, -2.0]) for k in range(6, 12)]
    assert got(workers.createDataFrame(rows, "vec_id long, embedding array<double>")) == brute(rows)
