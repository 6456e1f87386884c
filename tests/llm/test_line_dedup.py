import hashlib
import random
from collections import defaultdict

import numpy as np

from delaylens.llm import line_dedup as L
from delaylens.llm import queries

SMOKE = "/root/testdata/sf0.001"


def brute(rows, min_chars=20, min_docs=3):
    """(n_lines, kept) per row by the words of the contract."""
    keys = lambda t: [x.strip(L.BLANK).encode().lower().decode() for x in (t or "").split("\n")]
    docs = defaultdict(set)
    for d, t in rows:
        for k in keys(t):
            if len(k) >= min_chars:
                docs[k].add(-(1 << 70) if d is None else d)
    out = []
    for d, t in rows:
        me = -(1 << 70) if d is None else d
        lines = (t or "").split("\n")
        kept = [x for x, k in zip(lines, keys(t)) if len(docs.get(k, ())) < min_docs or max(docs[k]) == me]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def got(df, **kw):
    return sorted(((r.row.doc_id, r.n_lines, r.n_dropped, r.kept) for r in L.dedupe(df, **kw).collect()), key=repr)


def test_query_equals_brute_force_and_sql(workers, duck):
    rows = [(r.doc_id, r.text) for r in workers.read.parquet(f"{SMOKE}/documents.parquet").collect()]
    want = [(d, n, g, hashlib.sha256(t.encode()).hexdigest()) for d, n, g, t in brute(rows)]
    run, sql = queries.all_queries()["op13_line_dedup"]
    assert sorted(map(tuple, run(workers, SMOKE).collect()), key=repr) == sorted(want, key=repr)
    names = "doc_id, n_lines, n_dropped, kept_sha256"
    assert sorted(duck.execute(f"SELECT {names} FROM ({sql})").fetchall(), key=repr) == sorted(want, key=repr)
    assert sum(g for _, _, g, _ in want) > 0


def test_odd_rows(workers):
    line = "a line that is common to many"
    rows = [(1, None), (2, ""), (None, line), (None, line + "\nx"), (3, " \t" + line.upper() + "\x0b\r\n\n"), (4, f"{line}\nb\n{line}"),
            (4, f"{line}\nb\n{line}"), (4, "another text of four\n" + line), (5, "É" * 19), (6, "É" * 19), (7, "É" * 19),
            (5, "é" * 20 + " "), (6, "é" * 20 + " "), (7, "é" * 20 + " "), (8, "É" * 20 + " "),
            (9, "only the documents of two\n" * 5), (10, "only the documents of two"), (11, "\n" * 50)]
    df = workers.createDataFrame(rows, "doc_id long, text string")
    assert got(df) == brute(rows)
    assert got(df.limit(0)) == []


def test_columns_that_clash(workers):
    line = "a line that is common to many"
    df = workers.createDataFrame([(k, f"{line}\n{k}", "keep", 7, k, "m") for k in range(4)],
                                 "doc_id long, text string, keep string, n_lines int, id long, mark string")
    out = L.dedupe(df)
    assert out.select("row.*").columns == df.columns
    assert sorted((r.row.doc_id, r.row.keep, r.row.n_lines, r.row.mark, r.kept) for r in out.collect()) == [
        *[(k, "keep", 7, "m", str(k)) for k in range(3)], (3, "keep", 7, "m", f"{line}\n3")]


def test_common_lines_over_many_partitions(workers):
    """Keys that begin, end and fill partitions; few rows are held."""
    rng = random.Random(5)
    pool = [f"one of the lines that come often {k}" for k in range(6)] + [f"a rarer line, number {k}" for k in range(80)]
    rows = [(rng.choice([None, *range(300)]), "\n".join(rng.choice(pool[:6] if rng.random() < 0.6 else pool)
                                                        for _ in range(rng.randint(1, 12)))) for _ in range(600)]
    df = workers.createDataFrame(rows, "doc_id long, text string").repartition(7)
    before = workers.conf.get("spark.sql.shuffle.partitions")
    workers.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        for p in (L.LineParams(), L.LineParams(held_rows=2), L.LineParams(min_docs=40, held_rows=3), L.LineParams(min_docs=2)):
            assert got(df, p=p) == brute(rows, p.min_chars, p.min_docs)
    finally:
        workers.conf.set("spark.sql.shuffle.partitions", before)


def test_bitmaps_are_whole():
    rng = np.random.default_rng(2)
    for n in (1, 7, 8, 9, 1000):
        gone = np.flatnonzero(rng.random(n) < 0.3)
        keep = L.unpack(L.pack(n, gone), n)
        assert len(keep) == n and np.flatnonzero(~keep).tolist() == gone.tolist()
