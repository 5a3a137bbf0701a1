"""From raw documents to packed training sequences: five stages, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rasterloom.llm import dedup, jaccard, mixing, packing, toxicity
from rasterloom.llm.queries import LANGUAGE_WEIGHTS, table, tree, vocabulary
from rasterloom.scratch import materialise, shared_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, fitted on the labelled rows, calls toxic go."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest identifier stays."""
    return dedup.distinct_texts(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by similar shingle sets the one with the smallest identifier stays."""
    return jaccard.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many tokens as there are, dealt by weight over domains, languages and sources."""
    return mixing.mix(docs, tree(), {"lang": LANGUAGE_WEIGHTS})


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every token of every document in sequences of at most 1024."""
    return packing.pack_documents(docs, vocabulary("byte_bpe_50k.json"), end_id=2, capacity=1024)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("n-gram jaccard join", drop_near_copies),
    ("mixing sources", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: Scores, sampling by a learned model and packing can't be put in SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = table(spark, sf_dir, "documents"), shared_dir(spark)
    for k, (_, stage) in enumerate(STAGES):
        docs = materialise(stage(spark, docs, sf_dir), folder, f"stage-{k}")
    return docs
