"""The corpus pipeline: language ID, toxicity, near-dedup, benchmark decontamination, BPE.

Each stage takes what its predecessor kept, as columns of ``documents``, and is written as Parquet before the next one reads
it. A stage drops what its operator rejects and keeps every other row as it is.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lattik.llm import bpe, decontam, langid, minhash, toxicity
from lattik.llm.common import anti_join_ids, materialize
from lattik.llm.queries import VOCABULARY, table

#: Least posterior of a language.
SURE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known: those with no letter or an unsure language go."""
    return langid.keep(docs, langid.train(docs), SURE)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't predicted toxic, by a model of the labelled ones among them."""
    return toxicity.keep(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8): the one with the smallest id."""
    return anti_join_ids(docs, minhash.near_duplicates(docs, width=5, percent=80).where("NOT kept"), "doc_id")


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return anti_join_ids(docs, decontam.find(docs, table(spark, sf_dir, "benchmark")), "doc_id")


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, with their digests."""
    return bpe.encode(docs, VOCABULARY).select("doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language_id", language), ("toxicity", not_toxic), ("near_dedup", deduplicated), ("decontamination", decontaminated), ("bpe", encoded),
]

#: Trained models and 64-bit similarity sketches have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialize(docs)
    return docs
