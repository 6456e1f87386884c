import random
import re
from collections import Counter

import numpy as np

from delaylens.llm import collocations as C
from delaylens.llm import queries

SMOKE = "/root/testdata/sf0.001"


def cut(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return [re.findall(r"[^\x20\x09]+", x) for x in re.split(r"[.,;:!?\x0A-\x0D]", lower)]


def counts(rows):
    f, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for w in cut(text):
            n[lang] += len(w)
            for size in range(1, 5):
                f.setdefault(lang, Counter()).update(tuple(w[k : k + size]) for k in range(len(w) - size + 1))
    return f, n


def brute(rows, least=30, top=2000, covered=80):
    f, n = counts(rows)
    out = []
    for lang, c in f.items():
        cand = {x: a for x, a in c.items() if len(x) > 1 and a >= least}
        scored = []
        for x, a in cand.items():
            inside = lambda y: any(y[k : k + len(x)] == x for k in range(len(y) - len(x) + 1))  # noqa: E731, B023
            if any(len(y) > len(x) and 100 * b >= covered * a and inside(y) for y, b in cand.items()):
                continue
            score, k = min((2_000_000 * a // (c[x[:k]] + c[x[k:]]), k) for k in range(1, len(x)))
            scored.append((-score, -a, " ".join(x).encode(), x, k))
        for rank, (s, a, _, x, k) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, " ".join(x), -a, c[x[:k]], c[x[k:]], n[lang], -s))
    return sorted(out)


def got(df, **kw):
    return sorted(map(tuple, C.collocations(df, C.PhraseParams(**kw)).collect()))


def test_query_equals_brute_force_and_sql(workers, duck):
    rows = [(r.lang, r.text) for r in workers.read.parquet(f"{SMOKE}/documents.parquet").collect()]
    run, sql = queries.all_queries()["op12_phrase_collocations"]
    want = brute(rows)
    assert len(want) > 20
    assert sorted(map(tuple, run(workers, SMOKE).collect())) == want
    names = "lang, rank, phrase, a, l, r, n, score"
    assert sorted(duck.execute(f"SELECT {names} FROM ({sql})").fetchall()) == want


def corpus(seed, n=300):
    rng = random.Random(seed)
    words = ["a", "b", "The", "the", "c'est", "É", "é", "x\x00", "x\x01y", "\x1c", "中文", "z" * 70, " "]
    text = lambda: "".join(rng.choice(words) + rng.choice([" ", " ", " ", " \t", ". ", "\n", ";", "\x0b"])
                           for _ in range(rng.randint(0, 40)))
    return [(rng.choice(["en", "en", "en", "fr", None]), text()) for _ in range(n)]


def test_shards_ranges_and_lookups(workers):
    rows = corpus(1)
    df = workers.createDataFrame(rows, "lang string, text string").repartition(5)
    want = brute(rows, 5)
    assert got(df, min_count=5) == want
    for size in (50, 400, 3000):
        assert got(df, min_count=5, shard_bytes=size, range_bytes=2 * size, samples=3, lookups=20) == want
    assert got(df, min_count=5, top=3, range_bytes=1000, covered=50) == brute(rows, 5, 3, 50)
    assert got(df, min_count=1, range_bytes=1000) == brute(rows, 1)


def test_a_hot_phrase_is_cut_at_longer_ones(workers):
    rng = random.Random(2)
    rows = [("en", "hot pair " + " ".join(f"w{rng.randint(0, 40)}" for _ in range(6))) for _ in range(2000)]
    df = workers.createDataFrame(rows, "lang string, text string").repartition(6)
    slim = df.select("lang", "text")
    cuts = C._cuts(slim, C.PhraseParams(range_bytes=1000))["en"]
    assert sum(c[:2] == (b"hot", b"pair") for c in cuts) > 3
    assert got(df, range_bytes=1000, shard_bytes=9000) == brute(rows)


def test_odd_rows(workers):
    rows = [(None, None), ("en", ""), ("und", "a b. " * 20), (None, "A B\tc. " * 15), ("en", " .,;" * 50), ("fr", "one two " * 40_000),
            ("fr", "alone"), ("de", "ja ja " * 40)]
    df = workers.createDataFrame(rows, "lang string, text string")
    assert got(df) == brute(rows)
    assert got(df.limit(0)) == [] == got(df.where("lang = 'en'"))
    extra = df.selectExpr("lang", "text", "1 AS range", "2 AS part", "3 AS phrase", "4 AS a", "5 AS n")
    assert got(extra, range_bytes=1000) == brute(rows)


def test_automata_by_themselves():
    rng = random.Random(4)
    words = [b"a", b"ab", b"b", b"c", b"\x01", b"ca"]
    streams = [[rng.choice([C._BREAK, *words]) for _ in range(200)] for _ in range(4)]
    autos, total = [], Counter()
    for s in streams:
        numbers = C._Numbers({C._BREAK: 0})
        autos.append(C.Automaton.of_stream(np.array([numbers[w] for w in s]), numbers, 4))
        for k in range(len(s)):
            for n in range(1, 5):
                run = s[k : k + n]
                if len(run) == n and C._BREAK not in run:
                    total[tuple(run)] += 1
    whole = C.Automaton.union([C.Automaton.loads(a.dumps()) for a in autos])
    assert {p: w for _, p, w in whole.phrases(1)} == {b" ".join(x): w for x, w in total.items()}
    cuts = sorted(rng.sample(sorted(total), 9)) + [(b"zz",)]
    found = Counter()
    for k, part in whole.ranges(cuts):
        for _, p, w in C.Automaton.loads(part.dumps()).phrases(1):
            x = tuple(p.split(b" "))
            assert sum(c <= x for c in cuts) == k
            found[x] += w
    assert found == total
    asked = [b" ".join(x) for x in rng.sample(sorted(total), 50)] + [b"zz", b"a zz b", b"c c c c"]
    other, depth, state = C.Automaton.of_phrases(asked)
    weights = whole.compose(other)
    assert [int(weights[d][s]) for d, s in zip(depth, state)] == [total[tuple(a.split(b" "))] for a in asked]
