"""Lineage columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.text import spaced_concat
from tidemark.operators.change import UNCHANGED

# The console tags of the crawl, by capture kind.
KIND_TAGS = {
    "seed": "品牌",
    "car_list": "车型",
    "version_list": "车款",
    "spec_page": "车款配置",
}


def kind_tag(kind: Column | str, tags: dict[str, str] | None = None) -> Column:
    """The console tag of a kind (the kind itself when it has none)."""
    k = F.col(kind) if isinstance(kind, str) else kind
    m = F.create_map(*[F.lit(x) for kv in (tags or KIND_TAGS).items() for x in kv])
    return F.coalesce(F.element_at(m, k), k)


def breadcrumb(*names: Column | str) -> Column:
    """B6: 'brand car version' joined by spaces; NULL when a part is NULL."""
    return spaced_concat(*names)


def audit_label(kind_label: Column | str, name: Column | str,
                status: Column | str = "status") -> Column:
    """B7: '[kind] ' + ('' when unchanged else '+ ') + name."""
    k = F.col(kind_label) if isinstance(kind_label, str) else kind_label
    n = F.col(name) if isinstance(name, str) else name
    s = F.col(status) if isinstance(status, str) else status
    mark = F.when(s == F.lit(UNCHANGED), F.lit("")).otherwise(F.lit("+ "))
    return F.concat(F.lit("["), k, F.lit("] "), mark, n)


def version_full_names(versions: DataFrame, cars: DataFrame, brands: DataFrame) -> DataFrame:
    """C5 by joins: versions with 'brand car version' names through
    version.car_third_id = car.third_id and car.brand_third_id = brand.third_id
    (inner: a version needs its car and brand)."""
    c = cars.select(F.col("third_id").alias("_car_id"), F.col("name").alias("_car_name"),
                    F.col("brand_third_id").alias("_brand_ref"))
    b = brands.select(F.col("third_id").alias("_brand_id"), F.col("name").alias("_brand_name"))
    j = (versions.join(c, versions["car_third_id"] == F.col("_car_id"))
                 .join(b, F.col("_brand_ref") == F.col("_brand_id")))
    return j.select(*[versions[x] for x in versions.columns],
                    breadcrumb("_brand_name", "_car_name", versions["name"]).alias("full_name"))
