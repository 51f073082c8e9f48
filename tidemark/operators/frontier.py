"""Fetch plan (B5, B9, E3, F2, G2, H9, H10): the next requests as a table.

Positions come from ``posexplode`` inside one response body, so priorities
need no shuffle.  The plan is ordered by (priority desc, order) with a range
partitioned sort only when an ordered table is asked for, and numbered by ranges and
offsets (``ranking``), never in one window over all requests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.paging import page_count, page_numbers
from tidemark.functions.urls import host_allowed
from tidemark.operators.ranking import global_rank

REQUEST_COLUMNS = ["parent_id", "kind", "url", "priority", "capture_seq", "pos"]


def requests(df: DataFrame, kind: str, url: Column, priority: Column,
             parent: Column | str, order: str = "capture_seq", pos: str = "pos") -> DataFrame:
    """One child request per row, in the common request shape."""
    p = F.col(parent) if isinstance(parent, str) else parent
    return df.select(p.cast("string").alias("parent_id"), F.lit(kind).alias("kind"),
                     url.alias("url"), priority.cast("int").alias("priority"),
                     F.col(order).cast("long").alias("capture_seq"),
                     F.col(pos).cast("int").alias("pos"))


def position_priority(base: int, pos: str = "pos") -> Column:
    """The n-th child (0-based) of a response gets base - (n + 1)."""
    return F.lit(base) - F.col(pos) - F.lit(1)


def expand_pages(df: DataFrame, count: str, page_size: int, page: str = "page") -> DataFrame:
    """H9 + H10: one row per page 1..ceil(count / page_size)."""
    n = page_count(count, page_size)
    return df.select("*", F.explode(page_numbers(n)).alias(page))


def ranked(requests_: DataFrame) -> DataFrame:
    """the place of each request in the queue, from 1: priority (desc), arrival, position;
    requests of one place in a response stand by kind, parent and url."""
    return global_rank(requests_, [F.col("priority").desc(), "capture_seq", "pos", "kind", "parent_id", "url"])


def frontier(parts: list[DataFrame], allowed_domains: list[str] | None = None,
             ordered: bool = False) -> DataFrame:
    """G2 (+ B9, F2): union of child requests of all kinds; off-domain URLs
    dropped; optionally sorted by priority (desc) then arrival order."""
    out = parts[0].select(*REQUEST_COLUMNS)
    for p in parts[1:]:
        out = out.unionByName(p.select(*REQUEST_COLUMNS))
    if allowed_domains:
        out = out.filter(host_allowed("url", allowed_domains))
    if ordered:
        out = out.orderBy(F.col("priority").desc(), F.col("capture_seq"), F.col("pos"))
    return out
