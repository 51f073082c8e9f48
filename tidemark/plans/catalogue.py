"""Catalogue build -- captures -> brand, car and version tables.

A1 -> H2-H5 (B1-B3) -> A7 -> A9/A8 -> A3 per entity.  Extraction is narrow;
entity rows (never bodies) are conformed, split into valid and quarantined
rows and written first-write-wins against the existing targets.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from tidemark.config import DEFAULT_SITE, SiteTemplates
from tidemark.operators import extract, sinks
from tidemark.schemas import BRAND, CAR, VERSION, TargetSpec

ORDER = ["capture_seq", "pos"]


@dataclass
class EntityOutput:
    added: DataFrame          # rows a first-write-wins insert adds (target columns)
    quarantine: DataFrame     # rejected rows with a reason


def _store(rows: DataFrame, spec: TargetSpec, target: DataFrame | None,
           required: list[str] | None = None) -> EntityOutput:
    conformed = sinks.conform(rows, spec, carry=ORDER, required=required)
    ok, bad = sinks.split_valid(conformed)
    added = sinks.insert_if_absent(target, ok, list(spec.keys), ORDER)
    return EntityOutput(added.select(*spec.column_names, *ORDER), bad)


def store_brands(rows: DataFrame, manifest: DataFrame | None = None,
                 target: DataFrame | None = None) -> EntityOutput:
    """A7 + A9/A8 + A3 for extracted brand rows."""
    if manifest is not None:
        rows = sinks.attach_asset(rows, manifest)
    else:
        rows = rows.withColumn("logo", F.lit(None).cast("string"))
    return _store(rows, BRAND, target)


def store_cars(rows: DataFrame, target: DataFrame | None = None) -> EntityOutput:
    # the stored table never receives the parsed sale state (default 0)
    return _store(rows.drop("sale_state_raw"), CAR, target, required=["third_id", "name"])


def store_versions(rows: DataFrame, target: DataFrame | None = None) -> EntityOutput:
    return _store(rows, VERSION, target, required=["third_id", "name"])


def brands(captures: DataFrame, manifest: DataFrame | None = None,
           target: DataFrame | None = None, site: SiteTemplates = DEFAULT_SITE) -> EntityOutput:
    rows = extract.brand_rows(captures.filter(F.col("kind") == "seed"), site=site)
    return store_brands(rows, manifest, target)


def cars(captures: DataFrame, target: DataFrame | None = None) -> EntityOutput:
    return store_cars(extract.car_rows(captures.filter(F.col("kind") == "car_list")), target)


def versions(captures: DataFrame, target: DataFrame | None = None) -> EntityOutput:
    return store_versions(extract.version_rows(captures.filter(F.col("kind") == "version_list")),
                          target)


def unparsable_captures(captures: DataFrame) -> DataFrame:
    """Captures of list kinds whose JSON does not parse as an object of
    records (no '{', truncated, wrong shape); quarantined whole.  Trailing
    text after the object (';', ')') is accepted."""
    from pyspark.sql.types import MapType, StringType
    out = None
    for kind, fields in (("car_list", extract.CAR_FIELDS), ("version_list", extract.VERSION_FIELDS)):
        schema = MapType(StringType(), extract.string_struct(fields))
        bad = extract.unparsable(captures.filter(F.col("kind") == kind), "body", schema,
                                 reason=f"unparsable:{kind}").drop("body")
        out = bad if out is None else out.unionByName(bad)
    return out
