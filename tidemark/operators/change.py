"""Change detection over captures.

A capture is logged when its body digest differs from the previous capture of
the same page (the latest logged digest), so A, B, A logs three times.

Scale notes
-----------
* The previous digest comes from a segmented scan.  Captures are range-partitioned
  and sorted by (page, order), so a page with any share of the captures, whatever its
  order values, fills as many partitions as it needs.  Each partition hands every row the
  digest before it; a summary with one row per partition (its last page and
  digest) carries across the borders.  Captures are shuffled once, keys and digests only.
* The input should be keys and digests only: callers hash bodies once and
  materialise the fingerprints (``stored`` or a checkpoint) before this operator,
  as the ranges are sampled from it.
* The scan's result is written to the shared folder: partition numbers stay what
  they are, and the summary and the rows read the same scan.
* A resumed run reads the compacted state (one row per page), never the log; only the
  first capture of a page is joined with it.
* Bodies are dropped right after hashing: shuffles carry keys and digests.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import BooleanType, IntegerType, StringType, StructField, StructType

from tidemark.functions.digest import sha1_hex
from tidemark.operators.ranking import unused
from tidemark.session import stored

NEW, CHANGED, UNCHANGED = "new", "changed", "unchanged"


def add_fingerprints(df: DataFrame, url: str = "url", body: str = "body",
                     page_col: str = "page_uid", digest_col: str = "data_uid") -> DataFrame:
    """H1: SHA-1 hex of the url (page identity) and of the body (content)."""
    return df.withColumn(page_col, sha1_hex(url)).withColumn(digest_col, sha1_hex(body))


def latest_by_key(df: DataFrame, keys: list[str] | str, order: str,
                  values: list[str] | None = None) -> DataFrame:
    """The row with the largest ``order`` per key.

    ``max_by`` aggregates partially before the shuffle, so a hot key costs
    one row per map task, not one task holding the whole group.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    values = values or [c for c in df.columns if c not in keys]
    carried = [c for c in values if c != order]
    pick = F.max_by(F.struct(*[F.col(c) for c in [order] + carried]), F.col(order))
    return (df.groupBy(*keys).agg(pick.alias("_latest"))
              .select(*keys, *[F.col("_latest")[c].alias(c) for c in [order] + carried]))


def _after(column: pa.Array, first: pa.Scalar) -> pa.Array:
    """Each value's predecessor; ``first`` comes before all."""
    return pa.concat_arrays([pa.array([first.as_py()], column.type), column.slice(0, len(column) - 1)])


def _segment_scan(page: str, digest: str, prev: str, seen: str, last: str, segment: str):
    """Per sorted partition: the digest before each row where it is of the same page (``seen``),
    the partition's number, and a mark on its last row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        before, held = None, None

        def marked(b: pa.RecordBatch, is_last: bool) -> pa.RecordBatch:
            flags = pa.array([False] * (len(b) - 1) + [is_last])
            return pa.RecordBatch.from_arrays([*b.columns, flags], names=[*b.schema.names, last])

        for b in batches:
            if not len(b):
                continue
            p, d = b.column(page), b.column(digest)
            p0, d0 = before or (pa.scalar(None, p.type), pa.scalar(None, d.type))
            same = pc.fill_null(pc.equal(p, _after(p, p0)), False)
            if held is not None:
                yield marked(held, False)
            held = pa.RecordBatch.from_arrays(
                [*b.columns, pc.if_else(same, _after(d, d0), pa.scalar(None, d.type)), same,
                 pa.array([number] * len(b), pa.int32())],
                names=[*b.schema.names, prev, seen, segment])
            before = p[-1], d[-1]
        if held is not None:
            yield marked(held, True)

    return run


def change_status(captures: DataFrame, page: str = "page_uid", digest: str = "data_uid",
                  order: str = "capture_seq", prior_state: DataFrame | None = None,
                  segments: int | None = None) -> DataFrame:
    """E2 + C6: add ``prev_digest`` and ``status`` (new / changed / unchanged).

    ``prior_state`` holds (page, digest), one row per page: the latest logged
    capture of earlier runs, which comes before every capture here whatever its
    order value.  A page is new only where no capture came before; a NULL digest
    (a NULL body) is one of its own.  Captures without a page or an order have no
    place in a history and are left out: callers quarantine them (``rejected``).
    ``segments`` sets the number of ranges; by default the session's shuffle settings do.
    """
    cols = captures.columns
    prev, seen, last, segment, carry = (unused(cols, f"_{x}") for x in ("prev", "seen", "last", "segment", "carry"))
    cur = captures.filter(F.col(page).isNotNull() & F.col(order).isNotNull())
    ranges = [segments] if segments else []
    ranged = cur.repartitionByRange(*ranges, page, order).sortWithinPartitions(page, order)
    schema = StructType([*ranged.schema.fields, StructField(prev, StringType()), StructField(seen, BooleanType()),
                         StructField(segment, IntegerType()), StructField(last, BooleanType())])
    scanned = stored(ranged.mapInArrow(_segment_scan(page, digest, prev, seen, last, segment), schema), "change-scan")

    # one row per partition: what the partition before it ends with
    ends = scanned.filter(F.col(last)).select(F.col(segment).alias("_s"), F.col(page).alias("_p"),
                                              F.col(digest).alias("_d"))
    by_segment = Window.orderBy("_s")
    ends = ends.select("_s", F.lag("_p").over(by_segment).alias("_p"),
                       F.struct(F.lag("_d").over(by_segment).alias("digest")).alias(carry))
    # a page's first row in a partition follows the partition before, or else the prior state
    heads = scanned.filter(~F.col(seen))
    heads = heads.join(ends, (F.col(segment) == F.col("_s")) & (F.col(page) == F.col("_p")), "left")
    before = F.col(carry)
    if prior_state is not None:
        prior = prior_state.select(F.col(page).alias("_page"), F.struct(F.col(digest).alias("digest")).alias("_prior"))
        heads = heads.join(prior, F.col(page) == F.col("_page"), "left")
        before = F.coalesce(before, F.col("_prior"))
    rows = heads.select(*cols, before.alias(prev)).unionByName(
        scanned.filter(F.col(seen)).select(*cols, F.struct(F.col(prev).alias("digest")).alias(prev)))
    known = F.col(prev)            # NULL only where no capture came before
    status = (F.when(known.isNull(), F.lit(NEW))
               .when(known["digest"].eqNullSafe(F.col(digest)), F.lit(UNCHANGED))
               .otherwise(F.lit(CHANGED)))
    return rows.select(*[F.col(c) for c in cols], known["digest"].alias("prev_digest"),
                       status.alias("status"))


def rejected(captures: DataFrame, page: str = "page_uid", digest: str = "data_uid",
             order: str = "capture_seq") -> tuple[DataFrame, DataFrame]:
    """A8 for captures: (those with url, body and order, the others with a ``reason``).
    The digest of a NULL url or body is NULL, so fingerprints show what is missing."""
    reason = F.concat_ws(",", F.when(F.col(page).isNull(), F.lit("null:url")),
                         F.when(F.col(digest).isNull(), F.lit("null:body")),
                         F.when(F.col(order).isNull(), F.lit("null:capture_seq")))
    marked = captures.withColumn("reason", reason)
    return (marked.filter(F.col("reason") == "").drop("reason"),
            marked.filter(F.col("reason") != ""))


def log_delta(status_df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """A5: the captures to append to the change log (new or changed)."""
    out = status_df.filter(F.col("status") != F.lit(UNCHANGED))
    return out.select(*keep) if keep else out


def compact_state(log: DataFrame, page: str = "page_uid", digest: str = "data_uid",
                  order: str = "capture_seq", arrival: str | None = None) -> DataFrame:
    """C6 state: latest logged digest per page (one row per page).

    ``arrival`` numbers the run or batch that logged a row.  A later run logs
    later, also where its captures bear smaller order values, so it comes first.
    """
    by = F.struct(*[F.col(c) for c in ([arrival] if arrival else []) + [order]])
    pick = F.max_by(F.struct(order, digest), by)
    return log.groupBy(page).agg(pick.alias("_latest")).select(page, "_latest.*")


@dataclass(frozen=True)
class KindPolicy:
    """How the change gate treats one kind of capture."""
    gated: bool                      # consults the change log at all
    flag_unchanged: bool             # unchanged -> kept with a flag (else dropped)
    children_unchanged: bool         # children still followed when unchanged
    has_children: bool               # the kind produces child requests


# The decision table of the crawl (seed and list pages are
# flagged when unchanged; version lists then stop; spec pages and other
# responses are dropped; the level program never consults the log).
CRAWL_POLICY: dict[str, KindPolicy] = {
    "seed": KindPolicy(True, True, True, True),
    "car_list": KindPolicy(True, True, True, True),
    "version_list": KindPolicy(True, True, False, True),
    "spec_page": KindPolicy(True, False, False, False),
    "level_search": KindPolicy(False, False, False, True),
    "car_page": KindPolicy(False, False, False, False),
}
OTHER_POLICY = KindPolicy(True, False, False, False)


def is_gated(kind: Column | str = "kind", policy: dict[str, KindPolicy] | None = None) -> Column:
    """Whether captures of the kind consult the change log at all."""
    k = F.col(kind) if isinstance(kind, str) else kind
    return _policy_col(k, policy or CRAWL_POLICY, "gated")


def _policy_col(kind: Column, policy: dict[str, KindPolicy], field: str) -> Column:
    m = F.create_map(*[x for k, p in policy.items()
                       for x in (F.lit(k), F.lit(getattr(p, field)))])
    return F.coalesce(F.element_at(m, kind), F.lit(getattr(OTHER_POLICY, field)))


def fetch_decision(status_df: DataFrame, kind: str = "kind",
                   policy: dict[str, KindPolicy] | None = None) -> DataFrame:
    """``decision`` (emit / flag / drop), ``emit_items``, ``follow_children``."""
    policy = policy or CRAWL_POLICY
    k = F.col(kind)
    gated = _policy_col(k, policy, "gated")
    flag_u = _policy_col(k, policy, "flag_unchanged")
    kids_u = _policy_col(k, policy, "children_unchanged")
    has_kids = _policy_col(k, policy, "has_children")
    unchanged = gated & (F.col("status") == F.lit(UNCHANGED))
    decision = (F.when(~unchanged, F.lit("emit"))
                 .when(flag_u, F.lit("flag"))
                 .otherwise(F.lit("drop")))
    return status_df.select(
        "*", decision.alias("decision"), (~unchanged).alias("emit_items"),
        (has_kids & (~unchanged | (flag_u & kids_u))).alias("follow_children"))
