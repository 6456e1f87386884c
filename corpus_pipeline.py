"""A corpus pipeline of the training-data operators.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame,
which is written as Parquet and read again as the documents of the next stage. All stages but the
last return the columns of the documents they keep. ``run`` applies them to the documents table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaylens.llm import decontaminate, ngram_join, quality
from delaylens.llm.common import table, written
from delaylens.llm.queries import bpe_digests, bpe_round_trip


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; rows without an id are scored like others.

    The word vectors come from the documents of this stage, the labels from the labels table.
    """
    columns = docs.columns
    vectors, net = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.keep(docs, vectors, net).select(*columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest id."""
    return ngram_join.dedupe(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no item of the benchmark table."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the encoded and decoded texts: doc_id, n_tokens, ids_sha256,
    decoded_sha256."""
    return bpe_digests(bpe_round_trip(docs))


STAGES = [
    ("quality", quality_filter),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark_free),
    ("byte_bpe", byte_bpe),
]

#: Model scores and sampled joins are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
