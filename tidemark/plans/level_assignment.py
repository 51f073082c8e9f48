"""Level assignment -- search pages + car pages -> car2level, totals.

Search captures carry the level id in ``parent_id`` and the page number in
the url; car pages carry the car id in ``parent_id``.  Pages that do not parse
and links whose ids do not fit the target go to quarantine.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators import extract, levels, markup, sinks
from tidemark.schemas import CAR2LEVEL
from tidemark.session import stored


@dataclass
class LevelResult:
    added: DataFrame       # car_third_id, level_id, branch, capture_seq, pos
    totals: DataFrame      # level_id, reported_count, n_pages
    total: Column          # scalar: reported counts + rows added by text
    quarantine: DataFrame  # target, capture_seq, reason


def search_result_rows(search_captures: DataFrame) -> DataFrame:
    caps = search_captures.filter(F.col("kind") == "level_search").select(
        "capture_seq", F.col("parent_id").alias("level_ref"),
        F.col("parent_id").try_cast("int").alias("level_id"),
        F.expr(r"try_cast(regexp_extract(url, '[?&]page=([0-9]+)', 1) AS INT)").alias("page"),
        "body")
    return extract.search_rows(caps)


def search_links(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links listed by search pages (car_third_id, level_id, capture_seq, pos), and the
    quarantine rows of pages that do not parse and of links with malformed ids."""
    broken = rows.filter(~F.col("parsed_ok")).select(
        F.lit("capture").alias("target"), "capture_seq",
        F.lit("unparsable:level_search").alias("reason"))
    listed = rows.filter(F.col("parsed_ok") & F.col("pos").isNotNull()).select(
        "capture_seq", "pos", F.col("car_ref").alias("car_third_id"), F.col("level_ref").alias("level_id"))
    links, bad = sinks.split_valid(sinks.conform(listed, CAR2LEVEL, carry=["capture_seq", "pos"]))
    return links, broken.unionByName(bad.select(F.lit(CAR2LEVEL.name).alias("target"), "capture_seq", "reason"))


def assign(captures: DataFrame, cars: DataFrame, level_dim: DataFrame,
           existing: DataFrame | None = None,
           synonyms: dict[str, str] | None = None, target=None) -> LevelResult:
    """``existing`` holds all links of earlier runs; ``target`` (default: the same) is
    what the insert compares with, and may be a bucketed target."""
    # a search body is parsed once: links, rejects and totals read the rows
    rows = stored(search_result_rows(captures), "search-rows")
    links, bad = search_links(rows)
    car_pages = captures.filter(F.col("kind") == "car_page").select(
        "capture_seq", F.col("parent_id").try_cast("int").alias("car_third_id"), "body")
    bad = bad.unionByName(car_pages.filter(F.col("car_third_id").isNull()).select(
        F.lit(CAR2LEVEL.name).alias("target"), "capture_seq", F.lit("type:car_third_id").alias("reason")))
    # only pages of cars without a level are tokenised
    linked = links.select("car_third_id")
    if existing is not None:
        linked = linked.unionByName(existing.select("car_third_id"))
    open_cars = stored(levels.unassigned(cars, linked).select(F.col("third_id").alias("car_third_id")),
                       "open-cars")
    car_pages = car_pages.join(open_cars, "car_third_id", "left_semi")
    heads = markup.headline_text(car_pages, markup.CAR_LEVEL_PATH,
                                 key=["capture_seq", "car_third_id"])
    added = levels.assign_levels(links, cars, heads, level_dim, existing=existing if target is None else target,
                                 synonyms=synonyms, candidates=open_cars)
    totals = levels.reported_totals(rows.filter(F.col("level_id").isNotNull() & F.col("parsed_ok")), level="level_id", page="page",
                                    seq="capture_seq")
    total = levels.grand_total(totals, added=added.filter(F.col("branch") == 1))
    return LevelResult(added, totals, total, bad)
