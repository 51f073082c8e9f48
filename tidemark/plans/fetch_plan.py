"""P5: the next requests (B5, B9, E3, F2, G2, H9, H10) as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.config import DEFAULT_SITE, SiteTemplates
from tidemark.functions.urls import from_template
from tidemark.operators import frontier as fr


def start_requests(spark: SparkSession, levels: DataFrame | None = None,
                   site: SiteTemplates = DEFAULT_SITE) -> DataFrame:
    """What a crawl begins with: the seed script and the first search page of every
    level.  The further pages of a level follow from its first (``next_requests``)."""
    one = spark.range(1).select(F.lit(None).cast("string").alias("parent_id"),
                                F.lit(0).cast("long").alias("capture_seq"), F.lit(0).alias("pos"))
    parts = [fr.requests(one, "seed", F.lit(site.seed_url), F.lit(0), "parent_id")]
    if levels is not None:
        first = levels.select("level_id", F.lit(0).cast("long").alias("capture_seq"),
                              F.lit(1).alias("page"))
        parts.append(_search_pages(first, site))
    return fr.frontier(parts, allowed_domains=list(site.allowed_domains))


def _search_pages(pages: DataFrame, site: SiteTemplates) -> DataFrame:
    url = from_template(site.level_search, F.col("level_id").cast("string"),
                        F.col("page").cast("string"), F.lit(str(site.page_size)))
    return fr.requests(pages, "level_search", url, F.lit(0), "level_id", pos="page")


def next_requests(brands: DataFrame | None = None, cars: DataFrame | None = None,
                  versions: DataFrame | None = None, search_totals: DataFrame | None = None,
                  unassigned_cars: DataFrame | None = None,
                  site: SiteTemplates = DEFAULT_SITE, ordered: bool = True) -> DataFrame:
    """Children of parsed entities: brand -> car list (priority 9999 - n),
    car -> version list (8999 - n), version -> spec page (0), level ->
    search pages 2..n (0), unassigned car -> car page (0)."""
    parts = []
    if brands is not None:
        parts.append(fr.requests(
            brands, "car_list", from_template(site.car_list, "third_id"),
            fr.position_priority(10000), "third_id"))
    if cars is not None:
        parts.append(fr.requests(
            cars, "version_list", from_template(site.version_list, "third_id"),
            fr.position_priority(9000), "third_id"))
    if versions is not None:
        parts.append(fr.requests(
            versions, "spec_page", from_template(site.spec_page, "third_id"),
            F.lit(0), "third_id"))
    if search_totals is not None:
        pages = fr.expand_pages(search_totals, "reported_count", site.page_size) \
                  .filter(F.col("page") >= 2).withColumn("capture_seq", F.lit(0).cast("long"))
        parts.append(_search_pages(pages, site))
    if unassigned_cars is not None:
        cars_ = unassigned_cars.withColumn("capture_seq", F.lit(0).cast("long")) \
                               .withColumn("pos", F.lit(0))
        parts.append(fr.requests(cars_, "car_page", from_template(site.car_page, "en_name"),
                                 F.lit(0), "third_id"))
    return fr.frontier(parts, allowed_domains=list(site.allowed_domains), ordered=ordered)
