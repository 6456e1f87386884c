"""Shards of bounded size by extendible hashing.

A row's place is a stream of bits: 60 of md5(id as text), then 60 of a hash of its place in the
input. The directory starts with one bucket; a bucket over the byte limit splits on its next bit,
the others stay, so a shard is a bit prefix and neighbours differ in depth. A round takes a histogram
of bytes at a fine prefix (pre-aggregated, a few rows per shard), sums it up to every shorter prefix
and gives each fine prefix the shortest one that fits. Buckets too full even then, as when a single
id holds many rows, go through another round with their next bits; the place bits split them at last.

A bucket of one row is a shard whatever its size, since a row can't be split.

Defined results: null text has no bytes; null ids hash like empty text; repeated ids share their 60
bits and are parted by place; an empty table gives no rows. Other columns are carried on request.
All of it runs on built-in functions.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylens.llm.common import written

ID_BITS = PLACE_BITS = 60
ROUND_BITS = 10


def _bits(start: int, count: int):
    """Bits start..start+count of a row's stream as a number; a round stays in one of the hashes."""
    source, at, width = ("__h", start, ID_BITS) if start < ID_BITS else ("__place", start - ID_BITS, PLACE_BITS)
    return F.shiftrightunsigned(F.col(source), width - at - count).bitwiseAND(F.lit((1 << count) - 1).cast("long"))


def _directory(rows: DataFrame, start: int, count: int, limit: int, name: str) -> DataFrame:
    """(path, fine, depth) for each fine prefix in use: bits of the shortest prefix that fits, or null.

    It grows with the input, so nothing here is broadcast."""
    fine = written(rows.groupBy("__path", _bits(start, count).alias("fine")).agg(
        F.sum("n_bytes").alias("bytes"), F.count(F.lit(1)).alias("n")), name)
    depths = fine.withColumn("depth", F.explode(F.sequence(F.lit(0), F.lit(count)))).withColumn(
        "prefix", F.expr(f"shiftright(fine, {count} - depth)"))
    sums = depths.groupBy("__path", "depth", "prefix").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))
    fits = sums.where((F.col("bytes") <= limit) | (F.col("n") == 1)).select("__path", "depth", "prefix", "bytes", "n")
    found = (depths.select("__path", "fine", "depth", "prefix").join(fits.hint("merge"), ["__path", "depth", "prefix"])
             .groupBy("__path", "fine").agg(F.min(F.struct("depth", "prefix", "bytes", "n")).alias("leaf")))
    return written(fine.select("__path", "fine").join(found.hint("merge"), ["__path", "fine"], "left"), f"{name}-directory")


def assign(docs: DataFrame, limit: int, id_col: str = "doc_id", text_col: str = "text",
           carry: list[str] | None = None) -> DataFrame:
    """(id, n_bytes, shard, depth, shard_bytes, shard_rows, *carry) of every row.

    ``shard`` is "s" and the bits of the prefix; ``limit`` is in bytes of UTF-8 text.
    """
    if limit < 1:
        raise ValueError("the byte limit must be positive")
    hashed = docs.select(
        F.col(id_col).alias("__id"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"),
        F.conv(F.substring(F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10)
        .cast("long").alias("__h"),
        F.shiftrightunsigned(F.xxhash64(F.monotonically_increasing_id()), 4).alias("__place"), F.lit("").alias("__path"),
        *([F.struct(*(F.col(f"`{c}`") for c in carry)).alias("__carry")] if carry else []))
    # Written once: a row keeps its place bits even if the input is read again in another order.
    rows = written(hashed, "shard-rows")
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    start, done = 0, None
    count = min(ID_BITS, max(4, math.ceil(math.log2(max(1, total / limit))) + 4))
    kept = ["__id", "n_bytes", *(["__carry"] if carry else [])]
    while True:
        where = _directory(rows, start, count, limit, f"shard-bits-{start}")
        # The directory grows with the input: both sides are dealt by prefix, never broadcast.
        placed = rows.withColumn("fine", _bits(start, count)).join(where.hint("merge"), ["__path", "fine"])
        bits = F.when(F.col("leaf.depth") > 0, F.lpad(F.bin("leaf.prefix"), F.col("leaf.depth"), F.lit("0"))).otherwise("")
        leaf = placed.where("leaf is not null").select(
            *kept, F.concat(F.lit("s"), "__path", bits).alias("shard"),
            (F.length("__path") + F.col("leaf.depth")).alias("depth"),
            F.col("leaf.bytes").alias("shard_bytes"), F.col("leaf.n").alias("shard_rows"))
        done = leaf if done is None else done.union(leaf)
        start += count
        if start >= ID_BITS + PLACE_BITS or not where.where("leaf is null").limit(1).count():
            break
        rows = written(placed.where("leaf is null").select(
            *kept, "__h", "__place", F.concat("__path", F.lpad(F.bin("fine"), count, "0")).alias("__path")), "shard-rows")
        count = min(ROUND_BITS, (ID_BITS if start < ID_BITS else ID_BITS + PLACE_BITS) - start)
    out = [F.col("__id").alias(id_col), "n_bytes", "shard", "depth", "shard_bytes", "shard_rows"]
    return done.select(*out, *(F.col(f"__carry.`{c}`").alias(c) for c in carry or []))


def write(docs: DataFrame, limit: int, folder: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the rows of ``docs`` as Parquet, a folder per shard; returns (shard, rows, bytes)."""
    named = {c: f"c{i}" for i, c in enumerate(docs.columns)}  # apart from the operator's own columns
    plain = docs.toDF(*named.values())
    placed = assign(plain, limit, named[id_col], named[text_col], [c for c in plain.columns if c != named[id_col]])
    back = placed.select("shard", *(F.col(n).alias(f"{c}" if c != "shard" else "shard_") for c, n in named.items()))
    back.repartition("shard").write.partitionBy("shard").parquet(folder)
    return placed.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), F.sum("n_bytes").alias("bytes"))
