"""Spec build -- spec pages -> version_attr."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.operators import markup, sinks, spec
from tidemark.schemas import VERSION_ATTR


def documents(spec_captures: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(capture_seq, car_version_third_id, content) per spec page capture;
    the version id comes from the capture's lineage (``parent_id``)."""
    pages = spec_captures.filter(F.col("kind") == "spec_page").select(
        "capture_seq", "parent_id", "body")
    rows = markup.spec_rows(pages, key=["capture_seq", "parent_id"])
    # the lineage is part of the page's key, so no join brings it back
    page = F.struct("capture_seq", "parent_id").alias("page_id")
    values = spec.spec_values(rows.withColumn("page_id", page), dictionary)
    docs = spec.assemble_documents(values, pages.select(page))
    return docs.select("page_id.capture_seq", F.col("page_id.parent_id").alias("car_version_third_id"),
                       "content")


def store(docs: DataFrame, target: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    conformed = sinks.conform(docs.withColumn("pos", F.lit(0)), VERSION_ATTR,
                              carry=["capture_seq", "pos"])
    ok, bad = sinks.split_valid(conformed)
    added = sinks.insert_if_absent(target, ok, list(VERSION_ATTR.keys), ["capture_seq", "pos"])
    return added, bad
