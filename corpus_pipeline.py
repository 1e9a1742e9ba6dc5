"""The corpus job: stages over ``documents``, each written and read again before the next."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from articlespark.llm import exact, jaccard, mixing, packing, quality
from articlespark.llm.common import table, word_count
from articlespark.llm.queries import MIX_BUDGET, MIX_REPEATS, MIX_WEIGHTS, vocabulary
from articlespark.runtime import Scratch, materialize

_used = Scratch()


def _stage(stage):
    """A stage's tables go when the next stage begins: by then its rows have been written, see ``run``."""
    @functools.wraps(stage)
    def begin(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        _used.free(spark)
        with _used:
            return stage(spark, docs, sf_dir)
    return begin


@_stage
def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


@_stage
def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return exact.drop_copies(docs)


@_stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked texts stays: sets of five-word shingles with a similarity of 0.8 or more."""
    return jaccard.drop_near_copies(docs)


@_stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources by target weight; a source may be repeated, and its last document cut off at the target."""
    return mixing.mix_documents(docs, word_count(F.col("text")), F.col("doc_id"), weights=MIX_WEIGHTS, budget=MIX_BUDGET,
                                max_repeats=MIX_REPEATS)


@_stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mixed documents in sequences of 4096 tokens, sources in the proportions of the mix."""
    pieces = packing.pack(docs, vocabulary())
    return pieces.select("doc_id", "source", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("quality_classifier", quality_classifier), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup),
          ("mix_sources", mix_sources), ("pack", pack)]

#: A classifier and a tokenizer are not SQL; tests hold the job against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
