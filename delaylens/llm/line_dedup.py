"""Line de-duplication across documents: keep bitmaps by range partition and secondary sort.

* Every line of a text that is long enough gives a row: 128-bit hash of its key (stripped of ASCII
  white space at both ends, A-Z lower-cased), document, place. A task gives the lines of a document
  that it has met before only once.
* The rows are range-partitioned and sorted by hash, then by document from the largest id down, then
  by place. A common line thus spreads over as many tasks as its rows need.
* One pass over the sorted rows streams the occurrences of each key: the first document keeps its
  lines, those of the others go as soon as the key has been seen in enough documents; only the rows
  of the second document are held meanwhile. A key that a partition begins or ends with may go on in
  its neighbours: its undecided rows are put aside with as many of its document ids as decide, which
  are brought together afterwards (two keys per partition at most).
* The lines to drop are gathered per document as a compressed bitmap of the lines that stay.

Defined results: null or empty text is one empty line; rows of one id are one document when documents
are counted, and the rows without an id are one document, smaller than all others; repeated rows get
equal bitmaps. A table without rows gives none. Ids are read as 64-bit integers (-2**63 counts as
null). Other columns, whatever their names, are passed on by ``dedupe`` and not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylens.llm.common import arrow_map, batches, blocks_of, written

#: White space that a key loses at both ends.
BLANK = " \t\n\x0b\x0c\r"

#: Kinds of rows that the pass over the sorted lines gives: a line that goes, one whose key may go on
#: in another partition, and a document id of such a key.
_DROP, _OPEN, _SEEN = 0, 1, 2

_NO_ID = -(1 << 63)


@dataclass(frozen=True)
class LineParams:
    """Keys of at least ``min_chars`` code points in at least ``min_docs`` documents are dropped.

    ``held_rows`` bounds the rows and documents a task remembers; beyond it the rows are decided
    afterwards, or given once more.
    """

    min_chars: int = 20
    min_docs: int = 3
    held_rows: int = 100_000


def pack(n_lines: int, dropped: np.ndarray) -> bytes:
    """The bitmap of the lines that stay, compressed."""
    keep = np.ones(n_lines, dtype=np.uint8)
    keep[dropped] = 0
    return zlib.compress(np.packbits(keep).tobytes(), 6)


def unpack(bitmap: bytes, n_lines: int) -> np.ndarray:
    """True for the lines that stay."""
    return np.unpackbits(np.frombuffer(zlib.decompress(bitmap), dtype=np.uint8), count=n_lines).astype(bool)


def _slim(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(text_col, F.lit("")).alias("text")) \
        .withColumn("mark", F.xxhash64("text"))


_LINES = pa.schema([("high", pa.int64()), ("low", pa.int64()), ("id", pa.int64()), ("mark", pa.int64()),
                    ("n_lines", pa.int32()), ("place", pa.int32())])


def _lines(slim: DataFrame, p: LineParams) -> DataFrame:
    """A row per long enough line: (high, low) hash of its key, id, mark, n_lines, place."""

    def lines(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        digest = xxhash.xxh3_128_digest
        met: set[tuple] = set()
        for part in parts:
            for some in blocks_of(part, 1):
                keys, rows, places, sizes = [], [], [], []
                for row, (doc, text, mark) in enumerate(zip(*(c.to_pylist() for c in some.columns))):
                    if (doc, mark) in met:
                        continue
                    if len(met) >= p.held_rows:
                        met.clear()
                    met.add((doc, mark))
                    found = text.split("\n")
                    before = len(keys)
                    for place, line in enumerate(found):
                        key = line.strip(BLANK)
                        if len(key) >= p.min_chars:
                            keys.append(digest(key.encode().lower()))  # of bytes: A-Z only
                            places.append(place)
                    rows.extend([row] * (len(keys) - before))
                    sizes.extend([len(found)] * (len(keys) - before))
                if keys:
                    both = np.frombuffer(b"".join(keys), dtype="<i8").reshape(-1, 2)
                    at = pa.array(rows, type=pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy()), some.column(0).take(at),
                         some.column(2).take(at), pa.array(sizes, type=pa.int32()), pa.array(places, type=pa.int32())],
                        schema=_LINES)

    return slim.transform(arrow_map, lines, "high long, low long, id long, mark long, n_lines int, place int")


_DECIDED = pa.schema([("kind", pa.int8()), *_LINES])


def _stream(rows: Iterator[tuple], p: LineParams) -> Iterator[tuple]:
    """(kind, row) of the sorted rows of a partition: what goes, what is undecided, whose it is."""
    key = None
    ids: list[int | None] = []        # of the key, as many as decide
    held: list[tuple] = []            # rows of the second document while there is no third
    first = True                      # the partition's first key may have begun before it
    aside = False                     # rows of the key have been left undecided

    def ended(last: bool) -> Iterator[tuple]:
        if last or first or aside:
            for row in held:
                yield _OPEN, *row
            for i in ids:
                yield _SEEN, *key, i, None, None, None

    for row in rows:
        if row[:2] != key:
            if key is not None:
                yield from ended(False)
                first = False
            key, ids, held, aside = row[:2], [row[2]], [], False
            if first:
                yield _OPEN, *row
            continue
        doc = row[2]
        if doc != ids[-1] and len(ids) < p.min_docs:
            ids.append(doc)
        if first:
            yield _OPEN, *row
        elif doc == ids[0]:
            pass  # the first document keeps its lines
        elif len(ids) >= p.min_docs:
            for old in held:
                yield _DROP, *old
            held = []
            yield _DROP, *row
        else:
            held.append(row)
            if len(held) >= p.held_rows:
                aside = True
                for old in held:
                    yield _OPEN, *old
                held = []
    if key is not None:
        yield from ended(True)


def dropped_lines(docs: DataFrame, p: LineParams = LineParams(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, mark, n_lines, place) of every line that goes; mark is the hash of the document's text."""
    lines = written(_lines(_slim(docs, id_col, text_col), p), "lines")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["high", "low", F.col("id").desc_nulls_last(), "mark", "place"]
    dealt = lines.repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def decide(batches_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for part in batches_in for row in zip(*(c.to_pylist() for c in part.columns)))
        yield from batches(_stream(rows, p), _DECIDED)

    made = written(dealt.transform(
        arrow_map, decide, "kind byte, high long, low long, id long, mark long, n_lines int, place int"), "line-decisions")
    # The keys at the ends of partitions: two per partition, with a few ids each.
    ends = made.where(F.col("kind") == _SEEN).groupBy("high", "low").agg(
        F.count_distinct(F.coalesce("id", F.lit(_NO_ID))).alias("n"), F.max("id").alias("top")).where(F.col("n") >= p.min_docs)
    late = made.where(F.col("kind") == _OPEN).join(F.broadcast(ends), ["high", "low"]).where(~F.col("id").eqNullSafe(F.col("top")))
    out = ["id", "mark", "n_lines", "place"]
    return made.where(F.col("kind") == _DROP).select(*out).unionByName(late.select(*out))


def keep_bitmaps(docs: DataFrame, p: LineParams = LineParams(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, mark, n_lines, n_dropped, keep) of every document that loses a line.

    ``keep`` is the compressed bitmap of the lines that stay (``unpack`` reads it). Documents without
    a row keep all of theirs.
    """
    gone = dropped_lines(docs, p, id_col, text_col).groupBy("id", "mark", "n_lines").agg(F.collect_set("place").alias("gone"))
    schema = pa.schema([("id", pa.int64()), ("mark", pa.int64()), ("n_lines", pa.int32()), ("n_dropped", pa.int32()),
                        ("keep", pa.binary())])

    def packed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((doc, mark, n, len(places), pack(n, np.array(places)))
                for part in parts for doc, mark, n, places in zip(*(c.to_pylist() for c in part.columns)))
        yield from batches(rows, schema)

    return gone.transform(arrow_map, packed, "id long, mark long, n_lines int, n_dropped int, keep binary")


def kept_text(text: str, n_lines: int | None, keep: bytes | None) -> str:
    """The lines of a text that stay, joined."""
    if keep is None:
        return text
    return "\n".join([line for line, stays in zip(text.split("\n"), unpack(keep, n_lines).tolist()) if stays])


def dedupe(docs: DataFrame, p: LineParams = LineParams(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` as they are in ``row`` (a struct of all columns), with (n_lines, n_dropped, kept): the
    number of lines before, of those dropped, and the text that stays."""
    maps = written(keep_bitmaps(docs, p, id_col, text_col), "line-bitmaps")
    whole = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("id"),
                        F.coalesce(text_col, F.lit("")).alias("text"))
    whole = whole.withColumn("mark", F.xxhash64("text"))
    m = maps.select(F.col("id").alias("m_id"), F.col("mark").alias("m_mark"), "n_lines", "n_dropped", "keep")
    joined = whole.join(m, F.col("id").eqNullSafe(F.col("m_id")) & (F.col("mark") == F.col("m_mark")), "left")
    slim = joined.select("row", "text", F.col("n_lines").alias("size"), F.coalesce("n_dropped", F.lit(0)).cast("long").alias("gone"), "keep")
    return slim.select("row", F.coalesce(F.col("size"), F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1)
                       .cast("long").alias("n_lines"), F.col("gone").alias("n_dropped"), _applied()("text", "size", "keep").alias("kept"))


def _applied():
    """Pandas UDF of ``kept_text``, in Arrow batches."""
    import pandas as pd

    def apply(text: pd.Series, n_lines: pd.Series, keep: pd.Series) -> pd.Series:
        return pd.Series([t if k is None else kept_text(t, int(n), k) for t, n, k in zip(text, n_lines, keep)], dtype=object)

    apply.__annotations__ = {"text": pd.Series, "n_lines": pd.Series, "keep": pd.Series, "return": pd.Series}
    return F.pandas_udf(apply, "string")
