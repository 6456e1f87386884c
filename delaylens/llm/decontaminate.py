"""Benchmark decontamination: MinHash containment search, verified exactly.

An item (short) is contained in a document (long) if at least ``similarity`` of the item's distinct
five-word shingles occur anywhere in the document. Jaccard MinHash is blind to that when sizes
differ much, so the containment form is used:

1. An item's sketch is its ``sketch`` shingles of smallest hash. Items with no more shingles than the
   sketch are sketched whole and lose nothing. Longer items are partitioned by size in powers of two;
   each class has a number of hits of its own, as many as a contained item of any size in it reaches
   but for a chance of ``miss``: the smaller the items, the more hits, and the fewer false candidates.
2. A document's shingles are looked up among the sketches; documents with enough hits of an item
   are its candidates.
3. The candidates' shingle sets are intersected with the items' whole sets.

Everything runs on built-in functions. The sketches are broadcast if they have at most
``broadcast_rows`` rows, and joined by shuffling beyond that.

Defined results: null text is an empty text; texts without words contain nothing and are contained
in nothing; an item of fewer than five words is contained where its words stand in a row, so runs of
its length are looked up too (of the lengths that items have, no others); repeated items count once, repeated documents are judged alike, null ids are ids like others;
no items leave all documents. Other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaylens.llm.common import NEAR, SHINGLE_WORDS, with_native_shingles, written


@dataclass(frozen=True)
class ContainmentParams:
    similarity: float = NEAR
    sketch: int = 16               # smallest shingle hashes of an item
    miss: float = 1e-6             # chance to pass over a contained item
    broadcast_rows: int = 200_000  # sketches up to so many rows are broadcast (16 bytes each)

    def hits(self, size_class: int) -> int:
        """Hits that an item of 2**size_class and fewer than twice as many shingles needs, if its sketch
        is a sample. The sample is drawn without replacement, so the smaller the class, the surer its
        hits and the higher the number; the least over the sizes of the class holds for all of them."""
        k, low = self.sketch, 1 << size_class
        if low >= 1024:  # hardly differs from drawing with replacement, which needs no more hits
            s = self.similarity
            return self._least(lambda m: math.comb(k, m) * s**m * (1 - s) ** (k - m))
        return min((self._sampled(q) for q in range(max(low, k), 2 * low)), default=k)

    def _sampled(self, q: int) -> int:
        found = math.ceil(self.similarity * q - 1e-9)
        ways = math.comb(q, self.sketch)
        return self._least(lambda m: math.comb(found, m) * math.comb(q - found, self.sketch - m) / ways)

    def _least(self, chance) -> int:
        """The most hits that a contained item reaches but for a chance of ``miss``."""
        below, m = 0.0, 0
        while m < self.sketch:
            below += chance(m)
            if below > self.miss:
                break
            m += 1
        return max(m, 1)


def _text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _items(items: DataFrame, id_col: str, text_col: str, p: ContainmentParams) -> DataFrame:
    """(item, item_id, n_words, q, size_class, need, sh) of the distinct items that have shingles."""
    slim = items.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text"))
    made = with_native_shingles(slim, "text", "runs", "n_words").select(
        "item_id", "n_words", F.array_sort(F.array_distinct("runs")).alias("sh"))
    sized = made.where(F.size("sh") > 0).withColumn("q", F.size("sh"))
    size_class = F.floor(F.log2("q")).cast("int")
    # Up to the largest class of a 32-bit size.
    need = F.element_at(F.array(*(F.lit(p.hits(c)) for c in range(32))), F.col("size_class") + 1)
    whole = F.ceil(F.col("q") * F.lit(p.similarity) - F.lit(1e-9)).cast("int")
    return (sized.withColumn("size_class", size_class)
            .withColumn("need", F.when(F.col("q") <= p.sketch, whole).otherwise(need))
            .withColumn("item", F.xxhash64("item_id", "sh")).dropDuplicates(["item"]))


def find(docs: DataFrame, items: DataFrame, p: ContainmentParams = ContainmentParams(), id_col: str = "doc_id",
         text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(id, text_hash, item_id, n_found, n_shingles, containment) of each contained item and document."""
    known = written(_items(items, item_id_col, item_text_col, p), "bench-items")
    sketches = written(
        known.select("item", "need", F.explode(F.slice(F.array_sort(F.transform(
            "sh", lambda h: F.struct(F.xxhash64(h).alias("o"), h.alias("h")))), 1, p.sketch)).alias("s"))
        .select("item", "need", F.col("s.h").alias("h")), "bench-sketches")
    if sketches.limit(p.broadcast_rows + 1).count() <= p.broadcast_rows:
        sketches = F.broadcast(sketches)
    short = sorted(r[0] for r in known.where(F.col("n_words") < SHINGLE_WORDS).select("n_words").distinct().collect())
    slim = docs.select(F.col(id_col).alias("id"), _text_hash(F.col(text_col)).alias("text_hash"),
                       F.col(text_col).alias("text"))
    # The outer form: for the inner one Spark filters by the size of ``runs`` first, which makes all shingles
    # anew below the projections that make them, once per mention. The join drops the empty rows.
    runs = with_native_shingles(slim, "text", "runs", short=short).select("id", "text_hash", F.explode_outer("runs").alias("h"))
    # A shingle that a document repeats counts once; copies of a row are told apart by nothing.
    hit = runs.join(sketches, "h").groupBy("id", "text_hash", "item", "need").agg(
        F.count_distinct("h").alias("hits")).where("hits >= need")
    found = written(hit.select("id", "text_hash", "item"), "bench-candidates")
    pairs = found.select(F.col("id").alias("kid"), F.col("text_hash").alias("kth"), "item")
    texts = slim.join(pairs, F.col("id").eqNullSafe(F.col("kid")) & (F.col("text_hash") == F.col("kth")))
    sets = with_native_shingles(texts, "text", "runs", short=short).select("id", "text_hash", "item", "runs")
    return (sets.join(known.select("item", "item_id", "q", "sh"), "item")
            .select("id", "text_hash", "item", "item_id", F.col("q").alias("n_shingles"),
                    F.size(F.array_intersect("runs", "sh")).alias("n_found"))
            .where(F.col("n_found") >= F.col("n_shingles") * F.lit(p.similarity) - F.lit(1e-9))
            .dropDuplicates(["id", "text_hash", "item"])
            .select(F.col("id").alias(id_col), "text_hash", "item_id", "n_found", "n_shingles",
                    (F.col("n_found") / F.col("n_shingles")).alias("containment")))


def decontaminate(docs: DataFrame, items: DataFrame, p: ContainmentParams = ContainmentParams(),
                  id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
                  item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that contain no item, with all their columns."""
    found = find(docs, items, p, id_col, text_col, item_id_col, item_text_col)
    bad = written(found.select(F.col(id_col).alias("__kid"), F.col("text_hash").alias("__kth")).distinct(), "bench-found")
    same = docs[id_col].eqNullSafe(bad["__kid"]) & (_text_hash(docs[text_col]) == bad["__kth"])
    return docs.join(bad, same, "left_anti")
