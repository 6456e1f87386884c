"""Ranked lexical search of all documents for a set of items, by dense blocked matrix products.

* A first pass over the documents counts each one's terms and keeps the frequencies of those terms
  that occur in an item. The number of documents and terms, and every term's documents, follow from it.
* Items are dealt into tiles; a tile has a compact vocabulary, the terms of its items, and a matrix
  of their weights (terms x items). A block of documents becomes a matrix of impacts (documents x
  terms); the product of both, by BLAS in float64, holds the scores. All factors are integers, and a
  tile's terms are cut where a partial sum could reach 2**53: partial products are exact, they are
  summed as 64-bit integers.
* The best of a tile are those not below the k-th score, ties by id; a task keeps k per item over all
  of its blocks, and two rounds of ranking bring tasks together.

Weights and impacts: with N the documents that have a term, L all their terms, df the documents of a
term, n and tf the terms of a document and the occurrences of one: w = floor(1000 ln((2N+2)/(2df+1))),
m = 100 - 50 + 50 n N div L, and the impact is 10**9 tf div (1000 tf + 20 m).

Items are looked up in groups of a bounded number of terms (``SearchParams.group_terms``), each with
a pass of its own, so what is broadcast has a bound whatever the number of items.

Defined results: null or empty text has no terms; an item's terms are those of all rows of its id, a
null id is an id; repeated documents are ranked each by itself, with null ids first; items without
hits and empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from delaylens.llm.common import arrow_map, batches, blocks_of, written

#: Bytes of terms: digits, letters and all bytes of other characters; A-Z become a-z, the rest blanks.
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

#: Impacts are below this, as 10**9 tf div (1000 tf + 20 m) with m of 50 at least.
IMPACT_LIMIT = 1_000_000


@dataclass(frozen=True)
class SearchParams:
    """``top`` documents per item; items of a tile, documents of a block; distinct terms (summed over
    items) of a group of items that is looked up in one pass; ``exact_sum`` bounds partial sums."""

    top: int = 50
    tile_items: int = 64
    block_docs: int = 512
    group_terms: int = 400_000
    exact_sum: int = 1 << 53


def terms(text: str | None) -> list[bytes]:
    """The terms of a text in order, with repeats."""
    return text.encode().translate(_TERM_BYTES).split() if text else []


def impacts(tf: np.ndarray, n: np.ndarray, docs: int, total: int) -> np.ndarray:
    """Integer impacts of frequencies in documents of ``n`` terms."""
    m = 50 + 50 * n * docs // total
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


def weights(df: np.ndarray, docs: int) -> np.ndarray:
    """Integer weights of terms by the number of their documents."""
    return np.floor(1000 * np.log((2 * docs + 2) / (2 * df + 1))).astype(np.int64)


class Tile:
    """The items of a tile, their compact vocabulary and its matrix of weights."""

    def __init__(self, items: list[np.ndarray], weight: np.ndarray, exact_sum: int):
        self.vocabulary = np.unique(np.concatenate(items)) if items else np.empty(0, dtype=np.int64)
        self.matrix = np.zeros((len(self.vocabulary), len(items)))
        for k, item in enumerate(items):
            at = np.searchsorted(self.vocabulary, item)
            self.matrix[at, k] = weight[item]
        # Terms are cut so that no item's sum over a cut reaches the bound.
        highest = self.matrix.max(axis=1, initial=0) * IMPACT_LIMIT
        self.cuts, start, room = [0], 0, 0.0
        for k, x in enumerate(highest):
            if k > start and room + x >= exact_sum:
                self.cuts.append(k)
                start, room = k, 0.0
            room += x
        self.cuts.append(len(self.vocabulary))

    def scores(self, rows: np.ndarray, term: np.ndarray, impact: np.ndarray, n_docs: int) -> np.ndarray:
        """(documents, items) scores of a block given as (row, term, impact) triples."""
        at = np.minimum(np.searchsorted(self.vocabulary, term), max(len(self.vocabulary) - 1, 0))
        inside = self.vocabulary[at] == term if len(self.vocabulary) else np.zeros(len(term), dtype=bool)
        dense = np.zeros((n_docs, len(self.vocabulary)))
        dense[rows[inside], at[inside]] = impact[inside]
        out = np.zeros((n_docs, self.matrix.shape[1]), dtype=np.int64)
        for a, b in zip(self.cuts[:-1], self.cuts[1:]):
            if b > a:
                out += (dense[:, a:b] @ self.matrix[a:b]).astype(np.int64)
        return out


def best(ids: np.ndarray, scores: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``top`` highest scores above 0, equal ones by ascending id."""
    hit = np.flatnonzero(scores > 0)
    if len(hit) > top:
        least = np.partition(scores[hit], len(hit) - top)[len(hit) - top]
        hit = hit[scores[hit] >= least]  # ties of the last place too
    order = hit[np.lexsort((ids[hit], -scores[hit]))][:top]
    return ids[order], scores[order]


#: Stands for a null id inside tasks: before all others.
_NO_ID = -(1 << 63)

_SPARSE = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int64()))])


def _frequencies(slim: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(id, n, terms, tfs) of every document that has a term: the known ones and how often they occur."""
    shared = slim.sparkSession.sparkContext.broadcast(vocabulary)

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value

        def rows() -> Iterator[tuple]:
            for part in parts:
                for some in blocks_of(part, 1):
                    for doc, text in zip(*(c.to_pylist() for c in some.columns)):
                        found = terms(text)
                        if found:
                            tf = Counter(filter(known.__contains__, found))
                            yield doc, len(found), [known[t] for t in tf], list(tf.values())

        yield from batches(rows(), _SPARSE, 1024)

    return slim.transform(arrow_map, count, "id long, n long, terms array<int>, tfs array<long>")


_FOUND = pa.schema([("item", pa.int32()), ("id", pa.int64()), ("score", pa.int64())])


def _ranked(sparse: DataFrame, items: list[list[int]], df: dict[int, int], docs: int, total: int, p: SearchParams) -> DataFrame:
    """(item, id, score): the best documents of each task for each item, by its place in ``items``."""
    frequency = np.zeros(1 + max((t for i in items for t in i), default=0), dtype=np.int64)
    for term, n in df.items():
        frequency[term] = n
    weight = weights(frequency, docs)
    # Items with neighbouring terms share a tile, whose vocabulary then is smaller.
    order = sorted(range(len(items)), key=lambda k: sorted(items[k])[:1])
    tiles = [order[a : a + p.tile_items] for a in range(0, len(order), p.tile_items)]
    shared = sparse.sparkSession.sparkContext.broadcast((tiles, items, weight))

    def rank(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles, items, weight = shared.value
        built = [Tile([np.array(sorted(items[k]), dtype=np.int64) for k in tile], weight, p.exact_sum) for tile in tiles]
        kept = [(np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)) for _ in items]
        for part in parts:
            for at in range(0, part.num_rows, p.block_docs):
                some = part.slice(at, p.block_docs)
                ids = some.column(0).fill_null(_NO_ID).to_numpy()
                n = some.column(1).to_numpy()
                per_doc = some.column(2).value_lengths().to_numpy()
                rows = np.repeat(np.arange(len(ids)), per_doc)
                term = some.column(2).flatten().to_numpy().astype(np.int64)
                impact = impacts(some.column(3).flatten().to_numpy(), n[rows], docs, total)
                for tile, table in zip(tiles, built):
                    scores = table.scores(rows, term, impact, len(ids))
                    for k, column in zip(tile, scores.T):
                        old_ids, old = kept[k]
                        floor = old[-1] if len(old) == p.top else 1
                        hit = np.flatnonzero(column >= floor)
                        if len(hit):
                            kept[k] = best(np.concatenate([old_ids, ids[hit]]), np.concatenate([old, column[hit]]), p.top)
        yield from batches(((k, None if i == _NO_ID else i, s) for k, (ids, scores) in enumerate(kept)
                            for i, s in zip(ids.tolist(), scores.tolist())), _FOUND)

    return sparse.transform(arrow_map, rank, "item int, id long, score long")


def _top(found: DataFrame, top: int, *salt: str) -> DataFrame:
    order = Window.partitionBy("item", *salt).orderBy(F.desc("score"), F.col("id").asc_nulls_first())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _groups(items: DataFrame, item_col: str, text_col: str, p: SearchParams) -> Iterator[list[tuple]]:
    """Groups of (item id, its terms) of a bounded number of terms; a longer item is one by itself."""
    slim = items.select(F.col(item_col).alias("item"), F.col(text_col).alias("text"))
    kind = slim.schema["item"].dataType.simpleString()
    schema = pa.schema([("item", _arrow(slim)), ("term", pa.binary())])

    def split(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches(((item, t) for part in parts for item, text in zip(*(c.to_pylist() for c in part.columns))
                            for t in set(terms(text))), schema)

    pairs = written(slim.transform(arrow_map, split, f"item {kind}, term binary").distinct(), "item-terms")
    sizes = pairs.groupBy("item").agg(F.count("term").alias("n"))
    whole = sizes.agg(F.sum("n")).first()[0] or 0
    parts = -(-whole // p.group_terms)
    for k in range(parts):
        mine = pairs.where(F.pmod(F.xxhash64("item"), F.lit(parts)) == k).groupBy("item").agg(F.collect_list("term").alias("terms"))
        group, size = [], 0
        for row in mine.toLocalIterator():
            if group and size + len(row.terms) > 2 * p.group_terms:
                yield group
                group, size = [], 0
            group.append((row.item, [bytes(t) for t in row.terms]))
            size += len(row.terms)
        if group:
            yield group


def _arrow(slim: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(slim.schema["item"].dataType)


def search(docs: DataFrame, items: DataFrame, p: SearchParams = SearchParams(), id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the highest-scoring documents of every item."""
    spark = docs.sparkSession
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    kind = items.schema[item_col].dataType
    out = []
    for group in _groups(items, item_col, item_text_col, p):
        vocabulary = {t: k for k, t in enumerate(sorted(set().union(*(x for _, x in group))))}
        sparse = written(_frequencies(slim, vocabulary), "term-frequencies")
        docs_n, total = sparse.agg(F.count("n"), F.sum("n")).first()
        if not docs_n:
            break
        df = dict(map(tuple, sparse.select(F.explode("terms").alias("t")).groupBy("t").count().collect()))
        coded = [[vocabulary[t] for t in x] for _, x in group]
        found = _ranked(sparse, coded, df, docs_n, total, p).withColumn("salt", F.spark_partition_id() % 64)
        near = _top(_top(found, p.top, "salt").drop("rank"), p.top)
        names = spark.createDataFrame([(k, item) for k, (item, _) in enumerate(group)],
                                      f"item int, `{item_col}` {kind.simpleString()}")
        out.append(near.join(names, "item").select(item_col, "rank", F.col("id").alias(id_col), "score"))
    if not out:
        return spark.createDataFrame([], f"`{item_col}` {kind.simpleString()}, rank int, `{id_col}` long, score long")
    return reduce(DataFrame.unionByName, out)
