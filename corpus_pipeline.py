"""The corpus pipeline: documents in, packed training sequences out.

Every stage takes all rows that its predecessor kept and is written as Parquet before the next one
reads it, so lost executors cost one stage at most.

In every stage nulls may stand in any column, texts may be empty or very long, rows may repeat, columns beside those of
``documents`` are carried along whatever their names, and an empty table gives an empty result.
"""

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from hirelens.llm import decontaminate, mixing, packing, quality, simhash
from hirelens.llm.common import bound_batches, free_name, read
from hirelens.llm.shipping import shipped
from hirelens.operators.staging import scratch_path, staging_scope


def in_bounded_batches(function: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``function``, a stage, in a session that bounds Python's batches: stages share the workers of an executor, which keep
    what memory they once took."""

    @functools.wraps(function)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bound_batches(spark)
        return function(spark, docs, sf_dir)

    return run


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts (score 0.7 or more).

    Null and empty texts score 0 and are rejected; equal rows are all kept or all rejected; ids and labels that are null
    are not learnt from.  Without any labelled text nothing can be judged, and all documents stay.
    """
    model = quality.fit(docs, read(spark, sf_dir, "labels"), learn_from=~quality.in_hold_out())
    if model is None:
        return docs
    score, accepted = free_name("_score", docs.columns), free_name("_accepted", docs.columns)
    scored = quality.scores(docs, model, threshold=0.7, score_col=score, label_col=accepted)
    return scored.filter(F.col(accepted) == 1).select(*docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies.

    One row stays of rows with equal ids in a group; rows with equal ids and unlike texts are of different groups.  Rows
    without an id cannot be compared by it and stay.  Null and blank texts are copies of one another.
    """
    groups = simhash.simhash_groups(docs, shingle_words=4, distance=4, first_col="first")
    return simhash.keep_first(docs, groups, shingle_words=4, first_col="first")


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that copy no test item.

    A document whose id has a copying row goes with all its rows; rows without an id and null texts stay; null
    items are ignored, and without items all documents stay.
    """
    return decontaminate.without_leaks(docs, decontaminate.leaks(docs, read(spark, sf_dir, "benchmark")))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: the stretches of each document that it takes, once per pass; ids repeat as passes do.

    A null source is a source, the last; null and blank texts hold no words and are not taken; rows with equal or
    null ids are documents of their own.
    """
    return mixing.mixed_documents(docs)


def token_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed sequences of all stretches, an id matrix row each.

    Null ids and repeated rows are segments like others; a null or empty text is its end id alone.
    """
    return packing.packed_sequences(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("quality classifier", shipped(in_bounded_batches(quality_classifier))),
    ("SimHash near-dedup", shipped(in_bounded_batches(simhash_near_dedup))),
    ("benchmark decontamination", shipped(in_bounded_batches(benchmark_decontamination))),
    ("mixing sources to target weights", shipped(in_bounded_batches(source_mixing))),
    ("token-ID / binary output", shipped(in_bounded_batches(token_packing))),
]

# Nearest-neighbour scores, XXH64 fingerprints, alignments and tokens are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = read(spark, sf_dir, "documents")
    for name, function in STAGES:
        path = f"{scratch_path(spark, name.replace(' ', '_').replace('/', ''))}/rows"
        with staging_scope(spark):  # what a stage stages for itself goes once its result is written
            made = function(spark, docs, sf_dir)
            made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
    return docs
