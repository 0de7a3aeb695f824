"""A training corpus from the ``documents`` table, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as
Parquet to the session's shared folder and read again as the next stage's ``docs``. All but
the last return the columns of ``documents``.

What a stage keeps for itself (fingerprints, numbered texts, token ids) is needed until its
result is written. A later stage begins when that has happened, so it first deletes what
the stages before it kept: the shared folder holds one stage's tables at a time.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.fs import delete
from strata.llm import mixing, packing, pii, rules, simhash
from strata.llm.common import kept_in, table
from strata.session import new_scratch


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of texts that a stage may have changed."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select("doc_id", "text", "lang", "source", "n_chars")


_OWN = threading.local()  # kept: (place in the order of stages, path) of this thread's tables


def _clear(spark: SparkSession, before: int) -> None:
    """Delete what the stages before that place have kept."""
    kept = getattr(_OWN, "kept", [])
    for at, path in kept:
        if at < before:
            delete(spark, path)
    _OWN.kept = [x for x in kept if x[0] >= before]


def _stage(place: int) -> Callable:
    """A function as the stage at ``place``: begins by clearing up after those before it,
    so its ``docs`` must be their written result, not a plan that still reads them."""
    def named(f: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
        @wraps(f)
        def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            _clear(spark, place)
            paths: list[str] = []
            try:
                with kept_in(paths):
                    return f(spark, docs, sf_dir)
            finally:
                _OWN.kept += [(place, p) for p in paths]
        return stage
    return named


@_stage(0)
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return rules.drop_low_quality(docs, table(spark, sf_dir, "labels"))


@_stage(1)
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (that with the smallest id)."""
    return simhash.drop_near_duplicates(docs, shingle=3, max_bits=3)


@_stage(2)
def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, personal data and what reveals it replaced in its text."""
    return _counted(pii.redact(docs))


@_stage(3)
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources at their target weights: what each epoch takes of a document is a row."""
    return _counted(mixing.mixed_documents(docs))


@_stage(4)
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences of 4096 tokens, as operator 9 returns them."""
    return packing.pack(docs, packing.public_tokenizer(), length=4096, end=2)


STAGES = [
    ("quality_rules", quality),
    ("simhash_near_dedup", near_duplicates),
    ("pii", personal_data),
    ("mixing", mix),
    ("packing", pack),
]

# Learned rules, hashes and the mix cannot be said in SQL; the tests hold each stage
# against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; returns the last one's rows. What a stage keeps for
    itself is deleted when the next one begins (or the last has ended), its result when the
    next one's is written."""
    docs, before = table(spark, sf_dir, "documents"), None
    try:
        for name, stage in STAGES:
            path = new_scratch(spark, f"pipeline-{name}")
            stage(spark, docs, sf_dir).write.parquet(path)
            if before:
                delete(spark, before)
            docs, before = spark.read.parquet(path), path
    finally:
        _clear(spark, len(STAGES))
    return docs
