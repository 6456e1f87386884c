import random

from delaylens.llm import components as C


def brute(edges):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for u, v in edges:
        a, b = root(u), root(v)
        up[max(a, b)] = min(a, b)
    return sorted((x, root(x)) for x in list(up))


def test_hubs_chains_and_odd_links_equal_union_find(workers):
    rng = random.Random(8)
    edges = [(0, k) for k in range(1, 300)]                                  # a hub that is the smallest
    edges += [(9999, 1000 + k) for k in range(300)]                          # one that is the largest
    edges += [(2000 + k, 2001 + k) for k in range(60)]                       # a chain
    edges += [(rng.randrange(3000, 3400), rng.randrange(3000, 3400)) for _ in range(180)]
    want = brute([e for e in edges if e[0] != e[1]])
    rows = edges + edges[:50] + [(7, 7), (None, 4), (5, None)]
    rng.shuffle(rows)
    df = workers.createDataFrame([(*r, "m") for r in rows], "u long, v long, m string")
    assert sorted(map(tuple, C.components(df, "test").collect())) == want
    assert C.components(df.limit(0), "test").collect() == []


def test_rows_of_a_hub_stay_in_their_tasks(workers):
    rows = workers.range(20_000).selectExpr("if(id % 2 = 0, 0, id) as u", "id + 1 as v")
    made = C._with_least(rows, 20_000, False)
    assert made.count() == 20_000 and made.where("u = 0 and m = 1").count() == 10_000
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [u" in plan and "LeftAnti" in plan
