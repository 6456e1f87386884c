from collections import defaultdict

import pytest

from delaylens.llm import sharding as S
from delaylens.llm.queries import OP10_SQL, SHARD_BYTES, op10_sharding

DOCS = "/root/testdata/sf0.01/documents.parquet"


def by_shard(rows):
    out = defaultdict(list)
    for r in rows:
        out[r.shard].append(r)
    return out


@pytest.mark.parametrize("limit", [SHARD_BYTES, 20_000])
def test_matches_sql(workers, duck, limit):
    docs = workers.read.parquet(DOCS)
    df = S.assign(docs, limit)
    duck.execute(f"CREATE OR REPLACE TEMP VIEW documents AS SELECT * FROM read_parquet('{DOCS}')")
    res = duck.execute(OP10_SQL.replace(str(SHARD_BYTES), str(limit)))
    assert [c[0] for c in res.description] == df.columns
    rows = df.collect()
    assert sorted(tuple(r) for r in rows) == sorted(res.fetchall())
    duck.execute("DROP VIEW temp.documents")
    shards = by_shard(rows)
    assert len(shards) > 1 and all(sum(r.n_bytes for r in x) <= limit or len(x) == 1 for x in shards.values())


def test_query_covers_all(workers):
    assert op10_sharding(workers, "/root/testdata/sf0.001").count() == 200


def test_hot_ids_nulls_and_long_texts(workers):
    rows = [(7, "x" * 100)] * 300 + [(None, "y" * 50)] * 40 + [(k, None if k % 2 else "") for k in range(20)]
    rows += [(1000, "z" * 5000)]
    df = workers.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, shard string, fine int")
    placed = S.assign(df, 1000).collect()
    assert len(placed) == len(rows)
    for x in by_shard(placed).values():
        size = sum(r.n_bytes for r in x)
        assert size <= 1000 or len(x) == 1
        assert all((r.shard_bytes, r.shard_rows, r.depth) == (size, len(x), len(r.shard) - 1) for r in x)
    names = sorted(by_shard(placed))
    assert not any(b.startswith(a) for a, b in zip(names, names[1:]))
    assert S.assign(df.limit(0), 1000).collect() == []


def test_write_keeps_all_columns(workers, folder):
    df = workers.createDataFrame([(k, "t" * k, f"c{k}") for k in range(60)], "doc_id long, text string, n_bytes string")
    sizes = S.write(df, 200, f"{folder}/out").collect()
    back = workers.read.parquet(f"{folder}/out")
    assert sorted(back.drop("shard").collect()) == sorted(df.collect())
    assert sum(r.rows for r in sizes) == 60 and all(r.bytes <= 200 or r.rows == 1 for r in sizes)
