"""A2: small dimensions (spec dictionary, level hierarchy)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ShortType, StringType, StructField, StructType, LongType

from tidemark.data.spec_labels import SPEC_LABELS

DICTIONARY_SCHEMA = StructType([
    StructField("grp", StringType(), False),
    StructField("item", StringType(), False),
    StructField("label", StringType(), False),
])

LEVEL_SCHEMA = StructType([
    StructField("id", LongType(), False),
    StructField("level_id", ShortType(), False),
    StructField("level_name", StringType(), True),
    StructField("parent_level_id", ShortType(), False),
])


def spec_dictionary(spark: SparkSession,
                    entries: list[tuple[str, str]] | None = None) -> DataFrame:
    """(grp, item, label): the dotted key is split once here."""
    rows = [tuple(k.split(".", 1)) + (label,) for k, label in (entries or SPEC_LABELS)]
    return spark.createDataFrame(rows, DICTIONARY_SCHEMA)


def level_dimension(spark: SparkSession, source: str | DataFrame,
                    fmt: str = "parquet") -> DataFrame:
    """(id, level_id, level_name, parent_level_id) projected from a table,
    a path or a DataFrame; ``parent_level_id`` 0 means no parent."""
    if isinstance(source, DataFrame):
        df = source
    elif "/" in source:
        df = spark.read.format(fmt).load(source)
    else:
        df = spark.table(source)
    return df.select(
        F.col("id").try_cast("long").alias("id"),
        F.col("level_id").try_cast("int").alias("level_id"),
        F.col("level_name").cast("string").alias("level_name"),
        F.coalesce(F.col("parent_level_id").try_cast("int"), F.lit(0)).alias("parent_level_id"))
