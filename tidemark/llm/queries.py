"""The registered queries of this subpackage, each over its whole table, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (decontamination, language_id, lexical_search, license_scan, merkle, minhash, packing,
                          sharding, simhash, suffix_dedup, token_counts, url_filter, vector_search)
from tidemark.llm.common import documents, written
from tidemark.sources.tables import read_table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id")
    return sharding.place(docs, F.col("doc_id"), sharding.lookup_table(spark)).select("doc_id", "slot", "shard")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(documents(spark, sf_dir))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.matches(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digests(documents(spark, sf_dir))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # written, as the limits read it twice
    return token_counts.limits(written(token_counts.histogram(documents(spark, sf_dir)), "length-histogram"))


def op7_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.search(read_table(spark, sf_dir, "embeddings"), 5, F.pmod("vec_id", F.lit(50)) == 0)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return language_id.identify(docs, language_id.train(docs))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(read_table(spark, sf_dir, "pages"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return license_scan.scan(docs, license_scan.fit(license_scan.negatives(docs)))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tampering(documents(spark, sf_dir))


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (
    op1_simhash, op2_sharding, op3_suffix_dedup, op4_decontamination, op5_packing, op6_token_counts,
    op7_vector_search, op8_language_id, op9_url_filter, op10_license_scan,
    op11_merkle_manifest, op12_minhash, op13_lexical_search)}

#: The others need hashing, tokenizing or training that SQL lacks; tests hold them against brute force.
ORACLE_SQL = {"op2_sharding": sharding.ORACLE, "op7_vector_search": vector_search.ORACLE,
              "op9_url_filter": url_filter.ORACLE, "op11_merkle_manifest": merkle.ORACLE,
              "op12_minhash": minhash.ORACLE, "op13_lexical_search": lexical_search.ORACLE}
