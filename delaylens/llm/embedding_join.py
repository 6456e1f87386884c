"""Embedding near-duplicates: exact metric range join of unit vectors.

A cosine of at least s is a distance of at most r = sqrt(2 - 2s) between vectors of length one, a
metric. Pivots, chosen far apart from a bounded sample, partition the vectors: a vector's home is the
cell of its nearest pivot p, at distance d(p). A link to a vector at home in another cell q crosses the
plane half-way between the pivots, so both its ends lie near it: by the triangle inequality d(q) - d(p) <=
2r, and more tightly the distance to the plane, (d(q)^2 - d(p)^2) / (2 |pq|), is at most r.

Every vector is dealt once, to a block of about ``tile`` vectors of its cell, which is a file below the
shared folder. A task compares two runs of blocks, a block of each at a time, and reads the files of those
pairs of blocks that both have vectors near the other's cell: nothing is copied, however many blocks a
vector meets. Blocks hold single precision where that is exact, else double; vectors are compared
in single precision with a margin and decided in double precision.

Within a task numbers of links are summed per vector and links are reduced to a star per component,
so dense groups give no lists of pairs.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link with
nothing and are components of their own; vectors link only with others of their length; repeated ids
are joined as vectors of their own and then reported as rows of their own; null ids come back with a
null component unless they link to a known id; an empty table gives no rows. Other columns are not
read. In high dimensions without clusters no pivot can part anything: all pairs of blocks are then read
and compared, so time grows with the square of the vectors, and disk with their number.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylens.llm.common import arrow_map, batches, splitmix, written
from delaylens.llm.components import components


@dataclass(frozen=True)
class RangeParams:
    cosine: float = 0.9
    cell: int = 4096         # vectors per pivot, on average
    max_pivots: int = 256    # bounds the sample on the driver and the cells
    sample: int = 4096       # vectors among which pivots are chosen
    tile: int = 2048         # vectors of a block, on average at most
    run: int = 16            # blocks on each side of a task's comparison, at most


_CLEAN = pa.schema([("id", pa.int64()), ("row", pa.int64()), ("n", pa.int32()), ("v", pa.binary())])


def _clean(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, row, n, v): n components as bytes in v, in single precision if that is exact; both are null if the
    vector has no direction."""
    slim = vectors.select(F.col(id_col).cast("long").alias("id"), F.monotonically_increasing_id().alias("row"),
                          F.col(vec_col).cast("array<double>").alias("v"))

    def packed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for part in parts:
                for i, r, v in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2).to_pylist()):
                    n = raw = None
                    if v and None not in v:
                        a = np.array(v, dtype=np.float64)
                        top = np.abs(a).max()
                        if np.isfinite(top) and top > 0:
                            n, raw = len(a), _narrow(a).tobytes()
                    yield i, r, n, raw

        yield from batches(rows(), _CLEAN)

    return written(slim.transform(arrow_map, packed, "id long, row long, n int, v binary"), "range-vectors")


def _narrow(a: np.ndarray) -> np.ndarray:
    """``a`` in single precision if that is exact."""
    with np.errstate(over="ignore"):
        small = a.astype(np.float32)
    return small if (small == a).all() else a


def _wide(raw: list[bytes], n: int) -> np.ndarray:
    """Packed vectors of n components as rows of doubles."""
    return np.stack([np.frombuffer(v, dtype=np.float32 if len(v) == 4 * n else np.float64) for v in raw]).astype(np.float64, order="C")


def _unit(a: np.ndarray) -> np.ndarray:
    a = a / np.abs(a).max(1)[:, None]  # no overflow or underflow in the squares
    return a / np.sqrt((a * a).sum(1))[:, None]


def _pivots(clean: DataFrame, total: int, n: int, p: RangeParams) -> np.ndarray:
    """Pivots far apart: from a bounded sample, each the farthest from those before it."""
    place = F.xxhash64("row")
    # About twice the sample lies below this hash, so a task sends few rows more than are taken.
    low = clean.where(place <= min(2**63 - 1, -(2**63) + (2**64 // total) * (2 * p.sample + 64)))
    rows = low.orderBy(place).limit(p.sample).select("v").collect()
    x = _unit(_wide([r.v for r in rows], n))
    count = min(p.max_pivots, -(-total // p.cell))
    chosen = [0]
    near = ((x - x[0]) ** 2).sum(1)
    while len(chosen) < min(count, len(x)):
        far = int(near.argmax())
        if near[far] <= 1e-12:
            break
        chosen.append(far)
        near = np.minimum(near, ((x - x[far]) ** 2).sum(1))
    return x[chosen]


def _square(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Squared distances of unit vectors to the pivots."""
    return np.maximum(2 - 2 * (x @ pivots.T), 0)


def _near(x: np.ndarray, home: int, pivots: np.ndarray, radius: float) -> np.ndarray:
    """Which vectors (rows), at home in one cell, may have a link to a vector of which cell (columns)."""
    square = _square(x, pivots)
    own = square[:, home][:, None]
    apart = np.sqrt(((pivots - pivots[home]) ** 2).sum(1))
    with np.errstate(divide="ignore", invalid="ignore"):
        plane = (square - own) / (2 * apart)
    near = (plane <= radius + 1e-9) & (np.sqrt(square) - np.sqrt(own) <= 2 * radius + 1e-9)
    near[:, home] = True
    return near


_BLOCK = pa.schema([("block", pa.int32()), ("home", pa.int32()), ("name", pa.string()), ("n_rows", pa.int32()),
                    ("wide", pa.bool_()), ("near", pa.binary())])


def _blocks(clean: DataFrame, pivots: np.ndarray, n: int, base: str, radius: float, p: RangeParams) -> list:
    """Write every vector to the file of its block; returns a row per block, in the order of the cells.

    A file holds the rows' numbers, then their components. ``near`` are bits of the cells that one of its vectors
    may have a link to."""
    from delaylens.llm.ngram_join import _groups
    from delaylens.llm.token_files import _filesystem

    spark = clean.sparkSession
    shared = spark.sparkContext.broadcast(pivots)
    vectors = clean.select("row", "v")

    def homes(part: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
        for at in range(0, part.num_rows, 2048):
            some = part.slice(at, 2048)
            yield some, _square(_unit(_wide(some.column(1).to_pylist(), n)), shared.value).argmin(1)

    def counted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(len(shared.value), dtype=np.int64)
        for part in parts:
            for _, home in homes(part):
                seen += np.bincount(home, minlength=len(seen))
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(seen[at])], names=["home", "rows"])

    sizes = vectors.transform(arrow_map, counted, "home int, rows long").groupBy("home").agg(F.sum("rows").alias("rows"))
    of_cell = np.ones(len(pivots), dtype=np.int64)
    for r in sizes.collect():
        of_cell[r["home"]] = -(-r["rows"] // p.tile)
    first = np.concatenate([[0], np.cumsum(of_cell)])

    def dealt(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for some, home in homes(part):
                spread = splitmix(some.column(0).to_numpy().astype(np.uint64)) % of_cell[home].astype(np.uint64)
                block = first[home] + spread.astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(block.astype(np.int32)), some.column(0), some.column(1)],
                                                 names=["block", "row", "v"])

    def files(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _filesystem(base)
        system.create_dir(root, recursive=True)

        def made() -> Iterator[tuple]:
            for group in _groups(parts, ["block"]):
                block = group.column("block")[0].as_py()
                home = int(np.searchsorted(first, block, side="right")) - 1
                x = _wide(group.column("v").to_pylist(), n)
                held = _narrow(x)
                name = f"{block}-{uuid.uuid4().hex[:12]}"
                with system.open_output_stream(f"{root}/{name}") as out:
                    out.write(group.column("row").to_numpy().astype("<i8").tobytes())
                    out.write(held.astype(held.dtype.newbyteorder("<")).tobytes())
                near = _near(_unit(x), home, shared.value, radius).any(0)
                yield block, home, name, len(x), held.dtype == np.float64, np.packbits(near).tobytes()

        yield from batches(made(), _BLOCK)

    rows = vectors.transform(arrow_map, dealt, "block int, row long, v binary").repartition("block").sortWithinPartitions("block")
    written_blocks = rows.transform(arrow_map, files, "block int, home int, name string, n_rows int, wide boolean, near binary")
    return sorted(tuple(r) for r in written_blocks.collect())


_LINKED = pa.schema([("row", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])

#: A task keeps about so many bytes of blocks that it has read.
_HELD = 96 << 20


def _links(a: np.ndarray, b: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of the linked pairs of two sets of unit vectors; of one set with itself each pair once."""
    # 64 roundings of single precision are far below the margin; what it lets through is decided in double.
    i, j = np.nonzero(a.astype(np.float32) @ b.astype(np.float32).T >= cosine - 1e-4)
    if a is b:
        keep = i < j
        i, j = i[keep], j[keep]
    near = np.zeros(len(i), dtype=bool)
    for at in range(0, len(i), 65536):
        s = slice(at, at + 65536)
        near[s] = np.einsum("ij,ij->i", a[i[s]], b[j[s]]) >= cosine
    return i[near], j[near]


def _tied(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest place of each place's component, from earlier labels and more links."""
    k = np.flatnonzero(label != np.arange(len(label)))
    i, j = np.concatenate([i, k]), np.concatenate([j, label[k]])
    while True:
        least = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def links(clean: DataFrame, n: int, p: RangeParams) -> DataFrame:
    """(row, links, root) per vector and task: direct links, and a member of its component."""
    from delaylens.llm.token_files import _filesystem, _qualified
    from delaylens.session import scratch_path

    spark = clean.sparkSession
    radius, cosine = float(np.sqrt(2 - 2 * p.cosine)), p.cosine
    base = _qualified(spark, scratch_path(spark, "range-blocks"))
    pivots = _pivots(clean, clean.count(), n, p)
    found = _blocks(clean, pivots, n, base, radius, p)
    near = np.unpackbits(np.stack([np.frombuffer(b[5], dtype=np.uint8) for b in found]), axis=1, count=len(pivots)).astype(bool)
    shared = spark.sparkContext.broadcast((pivots, [b[1:5] for b in found], near))
    # As few blocks to a run as keep all tasks busy, so that small tables are spread too.
    cores = spark.sparkContext.defaultParallelism
    run = int(min(p.run, max(1, -(-len(found) // int(np.ceil(np.sqrt(8 * cores)))))))
    runs = -(-len(found) // run)
    total = runs * (runs + 1) // 2
    tasks = min(total, 100_000)

    def compared(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots, blocks, near = shared.value
        homes = np.array([b[0] for b in blocks])
        system, root = _filesystem(base)
        held: dict[int, tuple] = {}

        def block(k: int) -> tuple:
            """(rows, unit vectors, near) of a block; what is held is let go when it grows too large."""
            if k not in held:
                home, name, rows, wide = blocks[k]
                if (len(held) + 1) * max(rows * (8 * n + len(pivots)), 1) > _HELD:
                    held.clear()
                with system.open_input_stream(f"{root}/{name}") as f:
                    raw = f.read()
                x = _unit(np.frombuffer(raw, dtype="<f8" if wide else "<f4", offset=8 * rows).reshape(rows, n).astype(np.float64))
                held[k] = np.frombuffer(raw, dtype="<i8", count=rows), x, _near(x, home, pivots, radius)
            return held[k]

        def task(left: range, right: range) -> Iterator[pa.RecordBatch]:
            # Numbers of links and labels of the vectors of both runs, by place.
            ks = [*left] if left == right else [*left, *right]
            start = dict(zip(ks, np.concatenate([[0], np.cumsum([blocks[k][2] for k in ks])])))
            size = sum(blocks[k][2] for k in ks)
            count, label, rows = np.zeros(size, dtype=np.int64), np.arange(size), np.zeros(size, dtype=np.int64)
            pending: list[tuple] = []
            waiting = 0
            for a in left:
                for b in right:
                    if b < a or not (near[a, homes[b]] and near[b, homes[a]]):
                        continue
                    rows_a, x, near_a = block(a)
                    rows_b, y, near_b = block(b)
                    if a == b:
                        i, j = _links(x, x, cosine)
                    else:
                        u, v = np.flatnonzero(near_a[:, homes[b]]), np.flatnonzero(near_b[:, homes[a]])
                        i, j = _links(x[u], y[v], cosine)
                        i, j = u[i], v[j]
                    if not len(i):
                        continue
                    i, j = i + start[a], j + start[b]
                    rows[start[a] : start[a] + len(rows_a)], rows[start[b] : start[b] + len(rows_b)] = rows_a, rows_b
                    count += np.bincount(i, minlength=size) + np.bincount(j, minlength=size)
                    pending.append((i, j))
                    waiting += len(i)
                    if waiting > 1 << 20:
                        label, pending, waiting = _tied(label, *map(np.concatenate, zip(*pending))), [], 0
            if pending:
                label = _tied(label, *map(np.concatenate, zip(*pending)))
            linked = np.flatnonzero(count)
            for at in range(0, len(linked), 4096):
                k = linked[at : at + 4096]
                yield pa.RecordBatch.from_arrays([pa.array(rows[k]), pa.array(count[k]), pa.array(rows[label[k]])], schema=_LINKED)

        for part in parts:
            for first in part.column(0).to_pylist():
                for t in range(first, total, tasks):
                    # Pairs of runs a <= b are numbered by b, then a.
                    b = int((np.sqrt(8 * t + 1) - 1) / 2)
                    b += (b + 1) * (b + 2) // 2 <= t
                    b -= b * (b + 1) // 2 > t
                    a = t - b * (b + 1) // 2
                    yield from task(*[range(r * run, min(len(blocks), (r + 1) * run)) for r in (a, b)])

    numbers = spark.range(0, tasks, 1, tasks)
    return written(numbers.transform(arrow_map, compared, "row long, links long, root long"), "range-links")


def near_duplicates(vectors: DataFrame, p: RangeParams = RangeParams(), id_col: str = "vec_id",
                    vec_col: str = "embedding") -> DataFrame:
    """(id, n_links, component_id, kept): direct links, smallest id reachable, id = component_id."""
    clean = _clean(vectors, id_col, vec_col)
    lengths = clean.where("n is not null").groupBy("n").count().where("count > 1")
    # Vectors of different lengths have no cosine; each length, of which there are few, is joined by itself.
    joined = [links(clean.where(F.col("n") == r["n"]), r["n"], p) for r in lengths.orderBy("n").collect()]
    found = reduce(DataFrame.union, joined or [clean.sparkSession.createDataFrame([], "row long, links long, root long")])
    counts = found.groupBy("row").agg(F.sum("links").alias("n_links"))
    tied = components(found.select(F.col("row").alias("u"), F.col("root").alias("v")), "range")
    marked = (clean.select("id", "row").join(counts, "row", "left")
              .join(tied.withColumnRenamed("node", "row"), "row", "left")
              .withColumn("component", F.coalesce("component", "row")))
    marked = written(marked, "range-marked")
    least = marked.groupBy("component").agg(F.min("id").alias("component_id"))
    return marked.join(least, "component").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).alias("n_links"), "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
