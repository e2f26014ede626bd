"""Training-data pipeline over ``documents``: filter, deduplicate, decontaminate, redact, pack.

Every stage works on all rows its predecessor kept. All but the last return the columns of
``documents``; results between stages are written to the shared folder as Parquet. A stage's result
must be written before the next stage is called: that one removes what the former had staged.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlake.llm import decontaminate, jaccard, packing, secret_scan, toxicity
from emberlake.llm.common import discard, read_table, recorded, staged
from emberlake.llm.language import fold_of
from emberlake.llm.queries import tokenizer_path

_staged: list[DataFrame] = []  # what stages have staged for results that are written by now

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def stage(function: Stage) -> Stage:
    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        discard(*[t for t in _staged if t.sparkSession is spark and t is not docs])
        _staged.clear()
        with recorded(_staged):
            return function(spark, docs, sf_dir)

    return run_stage


@stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go. Labels are those the operator's query learns from."""
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "toxic").where(fold_of(F.col("doc_id"), 5) != 0)
    return toxicity.train(docs, labels).clean(docs)


@stage
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates stays."""
    return jaccard.one_of_each(docs)


@stage
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a verified overlap with a benchmark item go."""
    return decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark"))


@stage
def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reported spans are replaced; n_chars follows where the text has changed."""
    redacted = secret_scan.redact(docs.withColumn("_before", F.col("text")))
    length = F.when(F.col("text") == F.col("_before"), F.col("n_chars")).otherwise(F.length("text").cast("bigint"))
    return redacted.withColumn("n_chars", F.coalesce(length, F.col("n_chars"))).select(*docs.columns)


@stage
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents with their sequence and place."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scans", redact_secrets),
    ("best_fit_packing", pack_sequences),
]

#: Trees, components and packing have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        former, docs = docs, staged(function(spark, docs, sf_dir), f"pipeline-{name}")
        if hasattr(former, "_place"):
            discard(former)
    return STAGES[-1][1](spark, docs, sf_dir)
