import random

from delaylens.llm import licenses as L
from delaylens.llm.queries import all_queries

SMOKE = "/root/testdata/sf0.001"


def test_matches_sql(workers, duck):
    query, sql = all_queries()["op7_license_scan"]
    df = query(workers, SMOKE)
    res = duck.execute(sql)
    assert [c[0] for c in res.description] == df.columns
    got = sorted(tuple(r) for r in df.collect())
    assert got == sorted(res.fetchall()) and got


def test_found_anywhere_in_long_and_odd_documents(workers):
    rng = random.Random(2)
    rows, want = [], set()
    for k, (name, text) in enumerate(L.TEMPLATES * 6):
        before = " ".join(f"w{rng.randrange(10**6)}" for _ in range(rng.choice([0, 3, 17, 4090, 9000])))
        rows.append((k, f"{before} {text.upper()} and more words after it"))
        want.add((k, name))
    rows += [(1000, None), (1001, ""), (1002, "the license of this work is not stated here"), (None, "x " + L.TEMPLATES[1][1]),
             (1003, L.TEMPLATES[1][1]), (1003, L.TEMPLATES[1][1]), (1004, (L.TEMPLATES[2][1] + " ") * 3000)]
    want |= {(None, "GPL-3.0"), (1003, "GPL-3.0"), (1004, "MIT")}
    df = workers.createDataFrame([(*r, "n") for r in rows], "doc_id long, text string, name string")
    got = L.scan(df).collect()
    assert {(r.doc_id, r.license) for r in got} == want and len(got) == len(want)
    assert L.scan(df.limit(0)).collect() == [] and L.scan(df, ()).collect() == []


def test_changed_notices_need_four_fifths(workers):
    text = L.TEMPLATES[7][1]
    w = text.split()
    one, half = " ".join(["changed", *w[1:]]), " ".join(w[: len(w) // 2])
    df = workers.createDataFrame([(1, one), (2, half)], "doc_id long, text string")
    assert [(r.doc_id, r.license) for r in L.scan(df).collect()] == [(1, "BSD")]


def test_short_templates_and_bands(workers):
    df = workers.createDataFrame([(1, "all rights reserved"), (2, "all rights reserved here and there")], "doc_id long, text string")
    assert [r.doc_id for r in L.scan(df, [("ARR", "All rights reserved.")]).collect()] == [1]
    p = L.ScanParams()
    assert all((1 - p.similarity * (s // 2 + 1) / (2 * s + (s // 2 + 1) * (1 - p.similarity))) ** p.bands(s) <= p.miss for s in (1, 2, 8, 64))


def test_whole_license_texts_equal_brute_force(workers):
    rng = random.Random(5)
    texts = {n: [f"w{rng.randrange(4000)}" for _ in range(n)] for n in (6000, 2500)}
    templates = [(f"L{n}", " ".join(w)) for n, w in texts.items()]
    rows = []
    for n, w in texts.items():
        for every in (10**9, 40, 20):  # a changed word takes five shingles
            for before in (0, 9000):
                rows.append((len(rows), " ".join([f"x{k}" for k in range(before)] + [v if k % every else "new" for k, v in enumerate(w)])))
    got = {(r.doc_id, r.license, r.n_found, r.n_shingles, r.first_word)
           for r in L.scan(workers.createDataFrame(rows, "doc_id long, text string"), templates).collect()}
    runs = lambda w: [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
    want = set()
    for doc, text in rows:
        for n, w in texts.items():
            of, mine, size = set(runs(w)), runs(text.split()), 1 << (n - 5).bit_length()
            found = {at: len(of & set(mine[at : at + 2 * size])) for at in range(0, len(mine), size)}
            # Windows with four fifths of the template; the first of them is reported.
            ok = {at: f for at, f in found.items() if f >= 0.8 * len(of) - 1e-9}
            if ok:
                want.add((doc, f"L{n}", max(ok.values()), len(of), min(ok)))
    assert got == want and len(want) == 8


def test_whole_public_texts_and_the_query_equal_its_sql(workers, folder):
    import duckdb

    rng = random.Random(12)
    rows = []
    for name, text in L.WHOLE_TEXTS:
        w = text.split()
        changed = [v if k % 60 != 30 else "other" for k, v in enumerate(w)]
        for body in (w, changed, w[: len(w) // 2]):
            noise = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([0, 7, 700]))]
            rows.append((len(rows), " ".join([*noise, *body, "and", "more"]), name))
    workers.createDataFrame(rows, "doc_id long, text string, name string").write.parquet(f"{folder}/documents.parquet")
    query, sql = all_queries()["op7_license_scan"]
    got = sorted(tuple(r) for r in query(workers, folder).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet/*.parquet')")
    assert got == sorted(con.execute(sql).fetchall())
    found = {(r[0], r[1]) for r in got}
    assert all((doc, name) in found for doc, _, name in rows if doc % 3 == 0)
    assert all((doc, name) in found for doc, text, name in rows if doc % 3 == 1 and name.endswith(" text"))
    assert not any((doc, name) in found for doc, _, name in rows if doc % 3 == 2)
