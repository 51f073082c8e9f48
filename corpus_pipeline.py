"""From raw documents to packed training sequences.

Each stage works on all that the one before has kept; all but the last return the columns of
``documents``.  A stage's result is written as Parquet and read again as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination, language_id, packing, simhash, suffix_dedup
from tidemark.llm.common import documents, written
from tidemark.sources.tables import read_table


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told; those that the model rejects go."""
    return language_id.accepted(docs, language_id.train(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.one_of_each(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document has; ``n_chars`` follows the text."""
    cut = suffix_dedup.deduplicated(docs)
    if "n_chars" not in docs.columns:
        return cut
    return cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.clean(docs, read_table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document, with a checksum of its ids."""
    return packing.digests(docs)


STAGES = [("language ID", languages), ("SimHash near-dedup", near_duplicates), ("suffix-array dedup", repeats),
          ("benchmark decontamination", benchmark_free), ("best-fit packing", packed)]

#: Models, fingerprints and token ids are beyond SQL; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
