"""The corpus pipeline: documents in, packed token shards out.

Every stage takes what its predecessor kept. The first four return rows with the
columns of ``documents``; the last writes the token shards and returns one row per
document, read back from them. Stages treat nulls, empty and long texts, ties, repeated
rows, empty tables and extra columns as their operators' docstrings say.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from folioflow.llm import decontam, mixing, queries, similar, token_binary, toxicity
from folioflow.llm.common import scratch, table, written
from folioflow.sources.sinks import recorded, removed


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the tagger scores 0.5 or more go."""
    return toxicity.clean(docs, toxicity.train(toxicity.sample(docs, table(spark, sf_dir, "labels"))))


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are alike stays: that with the smallest doc_id.

    Fingerprints and trees are those of the SimHash operator, over five-word shingles;
    texts are alike from a similarity of 0.8 of these.
    """
    return similar.deduplicated(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out so that the sources meet their targets."""
    return mixing.mixed(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards of all documents; one row per document as read back from them."""
    manifest = token_binary.write_shards(docs, scratch(spark, "token-shards"), queries.tokenizer_path())
    return token_binary.read_shards(manifest, with_ids=False)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicates_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("token_binary", token_stage),
]

#: SQL can express neither the trained tagger nor the fingerprints nor the tokenizer;
#: tests hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; what a stage has left behind goes when the next one is written."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        with recorded() as paths:
            docs = written(stage(spark, docs, sf_dir), name)
        for path in [*before, *paths[:-1]]:
            removed(spark, path)
        before = paths[-1:]
    return STAGES[-1][1](spark, docs, sf_dir)
