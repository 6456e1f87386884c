"""N-gram Jaccard join: near copies among all documents by chosen-path set similarity search.

Documents are sets of hashed word shingles (64 bits). Equal sets are one class from the start, so
exact copies cost one row however many there are. Between classes, in ``runs`` independent runs:

* Every set is embedded as a signature of ``width`` min-wise sampled tokens.
* A node of a run's tree holds the sets that chose the same tokens on the way. A node with more than
  ``leaf`` sets picks one or two signature places by its own hash, 1.25 on average (one over the
  similarity), and splits its sets by the token there; a node of at most ``leaf`` sets is compared
  by brute force. Nodes that are still large after ``depth`` splits, such as big groups of near
  copies, are cut in blocks and all pairs of blocks compared in tasks of their own.
* Sets that agree in too few signature places are passed over; the rest is verified exactly on the
  shingle sets of the whole texts.

A pair of similarity s shares a leaf of one run with probability at least s**depth, more with the
second places; how many places of the signatures agree is the same in all runs. ``runs`` follows from
the target recall and both (see ``runs_for``). A pair that shares
several leaves is counted in the smallest one alone, so that numbers of links need no list of pairs.

Defined results: null text is an empty text; texts without words have no shingles and link with
nothing; texts of fewer than five words have one shingle; repeated rows count as copies of each
other; rows with a null id take part, the smallest id that is not null names a class. Other
columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylens.llm.common import NEAR, WordHashes, arrow_map, batches, seeds, shingles, strings, written
from delaylens.llm.components import components


@dataclass(frozen=True)
class JoinParams:
    similarity: float = NEAR
    recall: float = 1 - 1e-6   # target for a pair at the threshold
    width: int = 64            # signature places
    leaf: int = 64             # brute force up to so many sets
    depth: int = 3             # splits before large nodes are cut in blocks
    block: int = 512           # sets of a block
    slack: float = 0.3         # signature agreement may fall short of the similarity by this

    def runs_for(self) -> int:
        """Runs until the target recall. A pair at the threshold agrees in a binomial number of
        signature places, the same in all runs; with that share of places it survives a split with
        probability 1 - (3/4 (1-s) + 1/4 (1-s)^2 ...), carried through ``depth`` splits."""
        chances, lost = [], []
        for k in range(self.width + 1):
            s, live = k / self.width, 1.0
            for _ in range(self.depth):
                one = s * live
                live = 0.75 * one + 0.25 * (1 - (1 - one) ** 2)
            chances.append(math.comb(self.width, k) * self.similarity**k * (1 - self.similarity) ** (self.width - k))
            lost.append(1 - live)
        runs = 1
        while sum(c * x**runs for c, x in zip(chances, lost)) > 1 - self.recall:
            runs += 1
        return runs


def _signatures(sets: list[np.ndarray], width: int) -> np.ndarray:
    """The smallest token under each of ``width`` hash functions; the sets aren't empty."""
    tokens = np.concatenate(sets)
    low = (tokens >> np.uint64(32)).astype(np.uint32) ^ tokens.astype(np.uint32)
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    s = seeds(width, 11)
    out = np.empty((len(sets), width), dtype=np.uint32)
    for k in range(width):
        a, b = np.uint32(int(s[k]) & 0xFFFFFFFF | 1), np.uint32(int(s[k]) >> 32)
        h = (low ^ b) * a
        h ^= h >> np.uint32(15)
        out[:, k] = np.minimum.reduceat(h * np.uint32(0x2C1B3C6D), starts)
    return out


_PREPARED = pa.schema([("id", pa.int64()), ("th", pa.int64()), ("fp", pa.binary()), ("n", pa.int32()),
                       ("sig", pa.list_(pa.int32()))])


def prepare(docs: DataFrame, id_col: str, text_col: str, p: JoinParams) -> DataFrame:
    """(id, th, fp, n, sig) per row: hash of the text, fingerprint, size and signature of its set."""
    width = p.width

    def prepared(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        memo = WordHashes()
        for part in parts:
            for at in range(0, part.num_rows, 512):
                some = part.slice(at, 512)
                sets = [shingles(t, memo) for t in strings(some.column(2))]
                fps = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
                full = [s for s in sets if len(s)]
                rows = iter(_signatures(full, width).view(np.int32)) if full else iter(())
                sigs = [next(rows) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0).cast(pa.int64()), some.column(1), pa.array(fps, type=pa.binary()),
                     pa.array([len(s) for s in sets], type=pa.int32()),
                     pa.array(sigs, type=pa.list_(pa.int32()))], schema=_PREPARED)

    slim = docs.select(F.col(id_col).cast("long").alias("id"), _text_hash(text_col), F.col(text_col).alias("text"))
    return written(slim.transform(arrow_map, prepared, "id long, th long, fp binary, n int, sig array<int>"), "join-sets")


def _text_hash(text_col: str):
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("th")


def _children(node, width: int):
    """The places at which a node splits: one, and for every fourth node a second."""
    one = F.pmod(F.xxhash64(node, F.lit(1)), F.lit(width)).cast("int")
    two = F.pmod(one + 1 + F.pmod(F.xxhash64(node, F.lit(2)), F.lit(width - 1)).cast("int"), F.lit(width))
    return F.when(F.pmod(F.xxhash64(node, F.lit(3)), F.lit(4)) == 0, F.array(one, two)).otherwise(F.array(one))


def leaves(classes: DataFrame, p: JoinParams) -> DataFrame:
    """(node, m, fp) for each class in each leaf with m sets, two at least."""
    roots = F.explode(F.array(*(F.lit(r).cast("long") for r in range(p.runs_for())))).alias("node")
    level = classes.select("fp", "sig", roots)
    found = []
    for depth in range(1, p.depth + 1):
        split = level.select("fp", "sig", "node", F.explode(_children(F.col("node"), p.width)).alias("place"))
        nodes = split.select("fp", F.xxhash64("node", "place", F.element_at("sig", F.col("place") + 1)).alias("node"))
        nodes = written(nodes, f"join-nodes-{depth}")
        sizes = nodes.groupBy("node").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
        sized = written(nodes.join(sizes, "node").select("node", "m", "fp"), f"join-sized-{depth}")
        if depth == p.depth:
            found.append(sized)
            break
        found.append(sized.where(F.col("m") <= p.leaf))
        large = sized.where(F.col("m") > p.leaf)
        if large.isEmpty():
            break
        level = large.join(classes.select("fp", "sig"), "fp").select("fp", "sig", "node")
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def _tiles(rows: DataFrame, block: int) -> DataFrame:
    """Each row of a node of m sets for every tile of two blocks that its own block is part of."""
    blocks = F.ceil(F.col("m") / block).cast("int")
    own = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    return (rows.withColumn("block", own)
            .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
            .withColumn("ti", F.least("block", "other")).withColumn("tj", F.greatest("block", "other"))
            .drop("other", "m"))


def _groups(parts: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The runs of equal keys of a sorted partition, a group at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for part in parts:
        if not part.num_rows:
            continue
        cols = [part.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(part.num_rows, dtype=bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        starts = np.flatnonzero(change).tolist()
        if last is not None and tuple(c[0] for c in cols) != last:
            yield pa.Table.from_batches(held)
            held = []
        for a, b in zip([0, *starts], [*starts, part.num_rows]):
            held.append(part.slice(a, b - a))
            if b < part.num_rows:
                yield pa.Table.from_batches(held)
                held = []
        last = tuple(c[-1] for c in cols)
    if held:
        yield pa.Table.from_batches(held)


def _lists(column: pa.ChunkedArray) -> list[np.ndarray]:
    flat = column.combine_chunks()
    flat = flat.chunk(0) if isinstance(flat, pa.ChunkedArray) else flat
    values, offsets = flat.values.to_numpy(), flat.offsets.to_numpy()
    return [values[a:b] for a, b in zip(offsets[:-1], offsets[1:])]


def _pairs_to_check(tile: pa.Table, least: int, near: float) -> np.ndarray | None:
    """Upper triangle of the pairs of a tile to verify: owned by it, in size and signature near."""
    sig = np.stack(_lists(tile.column("sig")))
    n = tile.column("n").to_numpy().astype(np.float64)
    block = tile.column("block").to_numpy()
    ti, tj, node = (tile.column(c)[0].as_py() for c in ("ti", "tj", "node"))
    size = len(n)
    agree = np.zeros((size, size), dtype=np.uint8)
    for k in range(sig.shape[1]):
        agree += sig[:, k, None] == sig[None, :, k]
    hit = np.triu(agree >= least, 1) & (n[:, None] >= near * n[None, :]) & (n[None, :] >= near * n[:, None])
    if ti != tj:
        hit &= block[:, None] != block[None, :]
    if not hit.any():
        return None
    # Leaves smaller than this one, in which a pair may meet already; bits that both have set.
    nodes = _lists(tile.column("nodes"))
    earlier = [x[x < node] for x in nodes]
    every = np.unique(np.concatenate(earlier))
    for at in range(0, len(every), 4096):
        some = every[at : at + 4096]
        has = np.zeros((size, len(some)), dtype=np.float32)
        for i, x in enumerate(earlier):
            k = np.searchsorted(some, x)
            ok = (k < len(some)) & (some[np.minimum(k, len(some) - 1)] == x)
            has[i, k[ok]] = 1
        shared = has[:, has.sum(0) > 1]
        if shared.shape[1]:
            hit &= (shared @ shared.T) == 0
    return hit if hit.any() else None


_ACTIVE = pa.schema([("node", pa.int64()), ("ti", pa.int32()), ("tj", pa.int32()), ("place", pa.int32()),
                     ("fp", pa.binary()), ("partners", pa.binary())])


def candidates(classes: DataFrame, p: JoinParams) -> DataFrame:
    """(node, ti, tj, place, fp, partners): the sets of a tile that have pairs to verify in it.

    ``place`` orders them, ``partners`` has a bit for each of them.
    """
    rows = written(leaves(classes, p), "join-leaves")
    own = rows.groupBy("fp").agg(F.collect_list("node").alias("nodes"))  # runs x branching at most
    full = rows.join(classes.join(own, "fp").select("fp", "n", "sig", "nodes"), "fp")
    dealt = _tiles(full, p.block).repartition("node", "ti", "tj").sortWithinPartitions("node", "ti", "tj")
    least, near = round((p.similarity - p.slack) * p.width), p.similarity

    def active(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for tile in _groups(parts, ["node", "ti", "tj"]):
                if tile.num_rows < 2:
                    continue
                hit = _pairs_to_check(tile, least, near)
                if hit is None:
                    continue
                kept = np.flatnonzero(hit.any(0) | hit.any(1))
                bits = np.packbits(hit[np.ix_(kept, kept)], axis=1)
                key = [tile.column(c)[0].as_py() for c in ("node", "ti", "tj")]
                fps = tile.column("fp")
                for place, i in enumerate(kept):
                    yield (*key, place, fps[int(i)].as_py(), bits[place].tobytes())

        yield from batches(rows(), _ACTIVE)

    return written(dealt.transform(arrow_map, active, "node long, ti int, tj int, place int, fp binary, partners binary"),
                   "join-active")


def _verify(sets: list[np.ndarray], hit: np.ndarray, near: float) -> np.ndarray:
    """The pairs of ``hit`` whose exact Jaccard similarity is at least ``near``."""
    n = np.array([len(s) for s in sets], dtype=np.float64)
    size = len(sets)
    pairs = np.argwhere(hit)
    if len(pairs) <= 8 * size:
        out = np.zeros_like(hit)
        for i, j in pairs:
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            out[i, j] = both >= near * (n[i] + n[j] - both) - 1e-9
        return out
    tokens = np.concatenate(sets)
    owner = np.repeat(np.arange(size), [len(s) for s in sets])
    values, inverse, counts = np.unique(tokens, return_inverse=True, return_counts=True)
    number = np.cumsum(counts > 1) - 1  # a token of one set alone is in no intersection
    shared = counts[inverse] > 1
    column, owner = number[inverse[shared]], owner[shared]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    both = np.zeros((size, size), dtype=np.float32)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, 16384):
        a, b = np.searchsorted(column, [at, at + 16384])
        has = np.zeros((size, 16384), dtype=np.float32)
        has[owner[a:b], column[a:b] - at] = 1
        both += has @ has.T
    return hit & (both >= near * (n[:, None] + n[None, :] - both) - 1e-9)


def _roots(link: np.ndarray) -> np.ndarray:
    """Per row of a symmetric link matrix, the first row of its component."""
    label = np.arange(len(link))
    while True:
        least = np.where(link, label[None, :], len(link)).min(1)
        new = np.minimum(label, least)
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


_LINKED = pa.schema([("fp", pa.binary()), ("links", pa.int64()), ("root", pa.binary())])


def class_links(docs: DataFrame, classes: DataFrame, id_col: str, text_col: str, p: JoinParams) -> DataFrame:
    """(fp, links, root): per class and tile, the linked documents and a member of its component."""
    active = candidates(classes, p)
    wanted = active.select("fp").distinct().join(
        classes.select("fp", "c", F.col("least.id").alias("kid"), F.col("least.th").alias("kth")), "fp")
    # One text of each class with candidates: the texts of one class have one shingle set.
    texts = (docs.select(F.col(id_col).cast("long").alias("id"), _text_hash(text_col), F.col(text_col).alias("text"))
             .join(wanted, F.col("id").eqNullSafe(F.col("kid")) & (F.col("th") == F.col("kth")))
             .dropDuplicates(["fp"]).select("fp", "c", "text"))
    dealt = (active.join(texts, "fp").repartition("node", "ti", "tj")
             .sortWithinPartitions("node", "ti", "tj", "place").select("node", "ti", "tj", "fp", "partners", "c", "text"))
    near = p.similarity

    def linked(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()

        def rows() -> Iterator[tuple]:
            for tile in _groups(parts, ["node", "ti", "tj"]):
                size = tile.num_rows
                bits = np.stack([np.frombuffer(x, dtype=np.uint8) for x in tile.column("partners").to_pylist()])
                hit = np.unpackbits(bits, axis=1)[:, :size].astype(bool)
                sets = [shingles(t.as_py(), memo) for t in tile.column("text")]
                link = _verify(sets, hit, near)
                if not link.any():
                    continue
                link |= link.T
                weights = link @ tile.column("c").to_numpy().astype(np.int64)
                fps, roots = tile.column("fp").to_pylist(), _roots(link)
                for i in np.flatnonzero(weights):
                    yield fps[i], int(weights[i]), fps[roots[i]]

        yield from batches(rows(), _LINKED)

    return written(dealt.transform(arrow_map, linked, "fp binary, links long, root binary"), "join-links")


def _solve(docs: DataFrame, id_col: str, text_col: str, p: JoinParams) -> tuple[DataFrame, DataFrame]:
    """The prepared rows; and (fp, class_id, n_links, component, least id and text hash of it)."""
    sets = prepare(docs, id_col, text_col, p)
    classes = written(sets.where("fp is not null").groupBy("fp").agg(
        F.count(F.lit(1)).alias("c"), F.min("id").alias("class_id"), F.first("n").alias("n"),
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "th")).alias("least"), F.first("sig").alias("sig")), "join-classes")
    links = class_links(docs, classes, id_col, text_col, p)
    tied = components(links.select(F.col("fp").alias("u"), F.col("root").alias("v")), "join")
    counts = links.groupBy("fp").agg(F.sum("links").alias("links"))
    solved = (classes.select("fp", "c", "class_id", "least")
              .join(counts, "fp", "left").join(tied.withColumnRenamed("node", "fp"), "fp", "left")
              .select("fp", "class_id", "least", (F.col("c") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                      F.coalesce("component", "fp").alias("component")))
    solved = written(solved, "join-solved")
    keepers = solved.groupBy("component").agg(F.min("least").alias("keeper"))
    return sets, solved.join(keepers, "component")


def join(docs: DataFrame, p: JoinParams = JoinParams(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, class_id (smallest id with the same shingle set), n_links (other
    documents of similarity ``p.similarity`` or more, copies included) and component_id (smallest id
    reachable by links). A text without words is alone in its class."""
    sets, solved = _solve(docs, id_col, text_col, p)
    named = solved.select("fp", "class_id", "n_links", F.col("keeper.id").alias("component_id"))
    alone = sets.where("fp is null").select(
        "id", F.col("id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return (sets.where("fp is not null").select("id", "fp").join(named, "fp")
            .select("id", "class_id", "n_links", "component_id").union(alone).withColumnRenamed("id", id_col))


def dedupe(docs: DataFrame, p: JoinParams = JoinParams(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the row of the smallest id stays.

    Texts without words all stay; of rows that repeat an id and text one stays.
    """
    sets, solved = _solve(docs, id_col, text_col, p)
    keep = (solved.select(F.col("keeper.id").alias("kid"), F.col("keeper.th").alias("kth")).distinct()
            .union(sets.where("fp is null").select("id", "th").distinct()))
    # The caller's columns lie in one struct, whatever their names.
    marked = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("id"), _text_hash(text_col).alias("th"))
    return (marked.join(keep, F.col("id").eqNullSafe(F.col("kid")) & (F.col("th") == F.col("kth")), "left_semi")
            .dropDuplicates(["id", "th"]).select("row.*"))
