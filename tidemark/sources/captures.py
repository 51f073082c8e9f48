"""A1: the capture relation, read with a fixed schema (no inference)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import (BinaryType, LongType, StringType, StructField, StructType,
                               TimestampType)

from tidemark.functions.text import utf8_text

CAPTURE_KINDS = ("seed", "car_list", "version_list", "spec_page", "level_search", "car_page")

CAPTURE_SCHEMA = StructType([
    StructField("capture_seq", LongType(), False),
    StructField("kind", StringType(), False),
    StructField("url", StringType(), False),
    StructField("body", StringType(), False),
    StructField("fetched_at", TimestampType(), True),
    StructField("parent_id", StringType(), True),
    StructField("brand_name", StringType(), True),
    StructField("car_name", StringType(), True),
])


def read_captures(spark: SparkSession, path: str, kinds: list[str] | None = None,
                  stream: bool = False, fmt: str = "parquet",
                  max_files_per_trigger: int | None = None,
                  body_binary: bool = False) -> DataFrame:
    """Captures from ``path``; ``kinds`` becomes a filter the scan can push
    down.  ``body_binary``: bodies landed as bytes are decoded as UTF-8 (H16)."""
    schema = CAPTURE_SCHEMA
    if body_binary:
        schema = StructType([StructField(f.name, BinaryType(), f.nullable) if f.name == "body" else f
                             for f in CAPTURE_SCHEMA.fields])
    if stream:
        r = spark.readStream.schema(schema).format(fmt)
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
        df = r.load(path)
    else:
        df = spark.read.schema(schema).format(fmt).load(path)
    if body_binary:
        df = df.withColumn("body", utf8_text("body"))
    if kinds:
        df = df.filter(F.col("kind").isin(list(kinds)))
    return df
