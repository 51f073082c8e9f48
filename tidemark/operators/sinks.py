"""Sinks: conform and quarantine, first write wins, routing, assets
(A3, A4, A6-A9, B13, C7, D5).

Scale notes
-----------
* ``first_by_key`` is an aggregation (``min`` of a struct led by the order
  columns), so it combines map-side: a key holding a third of the rows costs
  one partial row per map task, never one task holding the group.
* ``insert_if_absent`` reads only the key columns of the target, and of a bucketed
  target only the buckets that the batch's keys fall in; it deduplicates the
  source before the anti join, and lets the planner pick broadcast (small
  target, size known from statistics) or a shuffled anti join.
* ``attach_asset`` is a single left join: brands without a logo request pass
  through, brands with one need a successful asset.
"""

from __future__ import annotations

from functools import reduce
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.schemas import ColumnRule, TargetSpec
from tidemark.session import stored

if TYPE_CHECKING:
    from tidemark.sources.bucketed import BucketedTarget


def _any(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, cols) if cols else F.lit(False)


# ------------------------------------------------------------ A9 / A8

def conform(df: DataFrame, spec: TargetSpec | list[ColumnRule],
            carry: list[str] | None = None, required: list[str] | None = None) -> DataFrame:
    """Typed target columns plus ``reasons`` (array of broken rules).

    Text is converted with ``try_cast``; a value that does not convert, an
    explicit NULL in a NOT NULL column and text longer than the column are
    the reject reasons (``type:c``, ``null:c``, ``length:c``).  ``required``
    source fields must be present (``missing:c``): a record lacking them
    would have aborted its whole response.
    """
    rules = spec.columns if isinstance(spec, TargetSpec) else tuple(spec)
    typed, checks = [], []
    for req in required or []:
        checks.append(F.when(F.col(req).isNull(), F.lit(f"missing:{req}")))
    for r in rules:
        src = r.source or r.name
        if src in df.columns:
            raw = F.col(src)
            value = F.expr(f"try_cast(`{src}` AS {r.type})")
            checks.append(F.when(raw.isNotNull() & value.isNull(), F.lit(f"type:{r.name}")))
            if not r.nullable:
                checks.append(F.when(raw.isNull(), F.lit(f"null:{r.name}")))
        else:
            value = F.lit(r.default).cast(r.type)
            if not r.nullable and r.default is None:
                checks.append(F.lit(f"null:{r.name}"))
        if r.max_len is not None:
            checks.append(F.when(F.char_length(value) > r.max_len, F.lit(f"length:{r.name}")))
        typed.append(value.alias(r.name))
    reasons = F.filter(F.array(*checks), lambda x: x.isNotNull()) if checks else \
        F.array().cast("array<string>")
    return df.select(*(carry or []), *typed, reasons.alias("reasons"))


def split_valid(conformed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows to store, rows to quarantine with a ``reason`` text)."""
    ok = conformed.filter(F.size("reasons") == 0).drop("reasons")
    bad = (conformed.filter(F.size("reasons") > 0)
                    .withColumn("reason", F.array_join("reasons", ",")).drop("reasons"))
    return ok, bad


# ------------------------------------------------------------ D5 / A3 / A4

def first_by_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row per key by ``order`` (payload columns break ties).

    ``order`` must identify a row (e.g. capture_seq, pos).  Rows with a NULL
    in any key column are all kept: a unique index admits many NULLs.
    """
    payload = [c for c in df.columns if c not in keys and c not in order]
    null_key = _any([F.col(k).isNull() for k in keys])
    solo = F.when(null_key, F.struct(*[F.col(c) for c in order]))
    first = F.min(F.struct(*[F.col(c) for c in order + payload]))
    out = df.groupBy(*[F.col(k) for k in keys], solo.alias("_solo")).agg(first.alias("_first"))
    return out.select(*keys, *[F.col("_first")[c].alias(c) for c in order + payload])


def insert_if_absent(target: DataFrame | BucketedTarget | None, source: DataFrame, keys: list[str],
                     order: list[str]) -> DataFrame:
    """The source rows a first-write-wins insert would add.

    In-batch: first row per key; then keys already in the target are
    removed (anti join on equality, so NULL keys are never matched).
    """
    first = first_by_key(source, keys, order)
    if target is not None and not isinstance(target, DataFrame):
        first = stored(first, "first-rows")       # read for its buckets and for the join
        target = target.holding(first)
    if target is None:
        return first
    # once each, combined map-side: a key that fills the target is one row here
    existing = target.select(*[F.col(k).alias(f"_t_{k}") for k in keys]).distinct()
    cond = [F.col(k) == F.col(f"_t_{k}") for k in keys]
    return first.join(existing, cond, "left_anti")


def with_audit_columns(df: DataFrame, created: str = "created_time",
                       updated: str = "updated_time") -> DataFrame:
    """Insert time and an update time that stays NULL (rows are never
    updated).  Added at write time only, outside oracle-checked queries."""
    return df.withColumn(created, F.current_timestamp()).withColumn(
        updated, F.lit(None).cast("timestamp"))


def append_rows(df: DataFrame, path: str, batch_id: int | None = None,
                fmt: str = "parquet") -> None:
    """A3/A5 write: plain append, or one folder per batch (or run) id,
    overwritten on replay, so a retried batch adds nothing twice."""
    if batch_id is None:
        df.write.mode("append").format(fmt).save(path)
    else:
        df.write.mode("overwrite").format(fmt).save(f"{path}/run_id={batch_id}")


# ------------------------------------------------------------ A6 / B13

def tag_records(df: DataFrame, tag_source: str, mapping: dict[str, str],
                tag: str = "sink") -> DataFrame:
    """Tagged union; records of unknown type get no sink and are ignored."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return df.withColumn(tag, F.element_at(m, F.col(tag_source))).filter(F.col(tag).isNotNull())


def route(tagged: DataFrame, sinks: list[str], tag: str = "sink") -> dict[str, DataFrame]:
    """One filtered frame per sink (cache ``tagged`` when writing several)."""
    return {s: tagged.filter(F.col(tag) == F.lit(s)).drop(tag) for s in sinks}


# ------------------------------------------------------------ A7

def attach_asset(items: DataFrame, manifest: DataFrame, url: str = "remote_logo",
                 out: str = "logo") -> DataFrame:
    """Bind the first successful stored path (by ``pos``) of the item's
    asset url; items that ask for an asset and have none are dropped; items
    without an asset url pass through (B13)."""
    ok = (manifest.filter(F.col("ok"))
                  .groupBy(F.col("url").alias("_asset_url"))
                  .agg(F.min_by("path", "pos").alias(out)))
    base = items.drop(out) if out in items.columns else items
    joined = base.join(ok, base[url] == ok["_asset_url"], "left")
    return joined.filter(F.col(url).isNull() | F.col(out).isNotNull()).drop("_asset_url")
