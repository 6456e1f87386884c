import random

from delaylens.llm import ngram_join as N
from delaylens.llm.common import table, words

SMOKE = "/root/testdata/sf0.001"


def grams(text):
    w = words(text or "")
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows, near=0.8):
    """id -> (class, links, component) by comparing all pairs."""
    sets = [grams(t) for _, t in rows]
    linked = {k: set() for k in range(len(rows))}
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= near * len(sets[i] | sets[j]):
                linked[i].add(j)
                linked[j].add(i)
    out = []
    for k, (doc, _) in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            new = linked[todo.pop()] - seen
            seen |= new
            todo += new
        same = [rows[j][0] for j in range(len(rows)) if j == k or sets[k] and sets[j] == sets[k]]
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((doc, min((i for i in same if i is not None), default=None), len(linked[k]),
                    min(ids, default=None)))
    return sorted(out, key=repr)


def test_equals_all_pairs_on_documents(workers):
    docs = table(workers, SMOKE, "documents")
    got = sorted((tuple(r) for r in N.join(docs).collect()), key=repr)
    assert got == brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_dense_group_is_cut_in_blocks_and_loses_no_link(workers):
    rng = random.Random(5)
    base = [rng.choice("abcdefgh") + str(rng.randrange(500)) for _ in range(120)]
    rows = []
    for k in range(150):
        copy = list(base)
        for _ in range(k % 4):
            copy[rng.randrange(120)] = f"new{rng.randrange(10**6)}"
        rows.append((k, " ".join(copy)))
    rows += [(1000 + k, " ".join(f"w{rng.randrange(10**6)}" for _ in range(60))) for k in range(30)]
    df = workers.createDataFrame(rows, "doc_id long, text string")
    p = N.JoinParams(leaf=8, block=32)
    got = sorted((tuple(r) for r in N.join(df, p).collect()), key=repr)
    assert got == brute(rows)


def crowded(n, seed):
    """Copies of one text with four words replaced: nearly all pairs have similarities of 0.80 to 0.85."""
    rng = random.Random(seed)
    base = [f"w{k}" for k in range(370)]
    rows = []
    for k in range(n):
        copy = list(base)
        for at in rng.sample(range(5, 365, 5), 4):
            copy[at] = f"new{rng.randrange(10**9)}"
        rows.append((k, " ".join(copy)))
    return rows


def test_crowded_group_at_the_threshold_loses_no_link(workers):
    rows = crowded(400, seed=3)
    df = workers.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in N.join(df).collect()), key=repr)
    assert got == brute(rows)


def test_edge_rows(workers):
    long = " ".join(f"t{k}" for k in range(30_000))
    rows = [(None, "a b c d e f g h"), (1, None), (2, ""), (3, "?!"), (4, "a b c d e f g h"), (4, "a b c d e f g h"),
            (5, "one two"), (6, "One, two!"), (7, long), (8, long + " end")]
    df = workers.createDataFrame([(*r, "x", 9) for r in rows], "doc_id long, text string, fp string, th int")
    assert sorted((tuple(r) for r in N.join(df).collect()), key=repr) == brute(rows)
    kept = N.dedupe(df)
    assert kept.columns == ["doc_id", "text", "fp", "th"]
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == [1, 2, 3, 4, 5, 7]
    assert N.join(df.limit(0)).collect() == [] and N.dedupe(df.limit(0)).collect() == []


def test_runs_follow_the_target():
    assert N.JoinParams(recall=0.9).runs_for() < N.JoinParams(recall=0.999).runs_for() <= 40


def test_default_runs_count_the_spread_of_signatures():
    p = N.JoinParams()
    assert p.recall >= 1 - 1e-6 and p.runs_for() == 20


def test_dedupe_leaves_the_callers_columns_alone(workers):
    text = "one two three four five six seven eight"
    df = workers.createDataFrame([(1, text, "keepme1", 7.5, "a"), (2, text, "keepme2", 8.5, "b"), (3, "quite another text of six words", "k", 1.0, "c")],
                                 "doc_id long, text string, __id string, __th double, id string")
    out = N.dedupe(df)
    assert out.schema == df.schema
    assert sorted(map(tuple, out.collect())) == [(1, text, "keepme1", 7.5, "a"), (3, "quite another text of six words", "k", 1.0, "c")]
