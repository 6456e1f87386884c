"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaylens.session import scratch_path

#: Words of a shingle, and the similarity from which two texts count as near copies.
SHINGLE_WORDS = 5
NEAR = 0.8

_WORD = re.compile(r"[^\W_]+")
_MASK = (1 << 64) - 1


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the cluster's shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def arrow_map(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` in batches of at most 1,000 rows and 16 MB (a longer row is one by itself), so
    that texts in transit take little memory. The plan reads both settings when it runs, so they stay set."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    return df.mapInArrow(work, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: str) -> list[str]:
    """Lower-case runs of letters and digits."""
    return _WORD.findall(text.lower())


def splitmix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer: a bijection of 64-bit values that mixes all bits."""
    x = np.asarray(x, dtype=np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeds(n: int, salt: int) -> np.ndarray:
    """``n`` fixed 64-bit seeds."""
    step = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        return splitmix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(salt) * np.uint64(1_000_003)) * step)


class WordHashes(dict):
    """Memo of 64-bit word hashes, emptied at ``limit`` entries so that memory stays bounded."""

    def __init__(self, limit: int = 100_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: str) -> int:
        import xxhash

        if len(self) >= self.limit:
            self.clear()
        value = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        if len(word) <= 64:
            self[word] = value
        return value


def shingles(text: str | None, memo: WordHashes, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a whole text.

    A text of fewer than ``size`` words has one shingle of all its words; a text without words
    has none.
    """
    found = words(text) if text else []
    if not found:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter((memo[w] for w in found), dtype=np.uint64, count=len(found))
    return np.unique(rolling(h, min(size, len(h))))


def rolling(h: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` neighbours; the order within a run counts."""
    n = len(h) - size + 1
    out = np.full(n, np.uint64(size), dtype=np.uint64)
    for k in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[k : k + n]
        out ^= out >> np.uint64(29)
    return splitmix(out)


def strings(column: pa.Array | pa.ChunkedArray) -> list[str | None]:
    return column.to_pylist()


#: A block of texts that is looked up together holds about so many characters.
BLOCK_CHARS = 500_000


def blocks_of(part: pa.RecordBatch, text_at: int, chars: int = BLOCK_CHARS) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``chars`` bytes of text each, one row at least."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(part.column(text_at)), 0).to_numpy()
    block = np.cumsum(sizes) // chars
    edges = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), part.num_rows]
    for a, b in zip(edges[:-1], edges[1:]):
        if b > a:
            yield part.slice(a, b - a)


def batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Tuples to record batches of bounded length."""
    block: list[tuple] = []
    for row in rows:
        block.append(row)
        if len(block) >= size:
            yield _batch(block, schema)
            block = []
    if block:
        yield _batch(block, schema)


def _batch(block: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), type=f.type) for c, f in zip(zip(*block), schema)], schema=schema)


def with_native_shingles(df: DataFrame, text_col: str, out: str, size_out: str | None = None,
                         short: Sequence[int] = ()) -> DataFrame:
    """Add ``out``: 64-bit hashes of the five-word shingles in text order, by built-in functions.

    Words are lower-case runs of letters and digits. Fewer than five words give one shingle of all
    of them; null or no words give an empty array. ``size_out`` is the number of words. Neighbours
    are paired by shifted arrays, so the work is in proportion to the text. For each length in
    ``short`` (under five) the runs of so many words in longer texts follow, hashed like a text of
    just these words.
    """
    w, a, n, two, four = (f"__{x}_{out}" for x in ("words", "hashes", "size", "two", "four"))
    pair = lambda x, y: F.xxhash64(x, y)
    parts = F.split(F.lower(F.coalesce(F.col(text_col), F.lit(""))), r"[^\p{L}\p{N}]+")
    shifted = lambda c, k: F.slice(F.col(c), F.lit(k), F.col(n))
    out_df = (df.withColumn(w, F.filter(parts, lambda x: x != ""))
              .withColumn(a, F.transform(F.col(w), lambda x: F.xxhash64(x)))
              .withColumn(n, F.size(a))
              .withColumn(two, F.zip_with(F.col(a), shifted(a, 2), pair))
              .withColumn(four, F.zip_with(F.col(two), shifted(two, 3), pair))
              .withColumn(out, F.when(F.col(n) >= SHINGLE_WORDS,
                                      F.slice(F.zip_with(F.col(four), shifted(a, 5), pair), F.lit(1),
                                              F.greatest(F.col(n) - 4, F.lit(0))))
                          .when(F.col(n) > 0, F.array(F.xxhash64(F.concat_ws(" ", F.col(w)))))
                          .otherwise(F.array().cast("array<bigint>"))))
    for size in short:
        joined = F.col(w)
        for k in range(2, size + 1):
            joined = F.zip_with(joined, shifted(w, k), lambda x, y: F.concat(x, F.lit(" "), y))
        more = F.transform(F.slice(joined, F.lit(1), F.greatest(F.col(n) - size + 1, F.lit(0))), lambda x: F.xxhash64(x))
        out_df = out_df.withColumn(out, F.when(F.col(n) > size, F.concat(F.col(out), more)).otherwise(F.col(out)))
    if size_out:
        out_df = out_df.withColumn(size_out, F.col(n))
    return out_df.drop(w, a, n, two, four)
