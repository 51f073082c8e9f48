"""Incremental refresh -- captures vs the change log.

Outputs decisions per capture (no bodies), the log delta, the next state and
the captures that cannot be compared, for quarantine.  ``gate`` keeps the
captures or entity rows whose items are emitted.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from tidemark.operators import change
from tidemark.session import stored


@dataclass
class RefreshResult:
    decisions: DataFrame     # capture_seq, kind, url, page_uid, data_uid, status, decision, ...
    log_delta: DataFrame     # rows to append to the change log
    next_state: DataFrame    # latest logged digest per page after this run
    quarantine: DataFrame    # capture_seq, reason: captures without url, body or order


def refresh(captures: DataFrame,
            prior_state: DataFrame | Callable[[DataFrame], DataFrame | None] | None = None,
            policy: dict[str, change.KindPolicy] | None = None,
            materialize: bool = True) -> RefreshResult:
    """H1 + C6 + E2 + I2 + A5.  Bodies are hashed once and dropped; the
    fingerprints (keys and digests only) are written to the shared folder, so the
    change scan never re-reads bodies and a lost executor does not recompute the
    hashing.  The decisions are written as well: the log, the state and every
    caller's branch read one status.

    ``prior_state`` may be a function from the batch's pages (page_uid) to their state;
    ``next_state`` then holds those pages and the logged ones only."""
    fp = change.add_fingerprints(captures.select("capture_seq", "kind", "url", "body")).drop("body")
    if materialize:
        fp = stored(fp, "fingerprints")
    fp, bad = change.rejected(fp)
    if callable(prior_state):
        prior_state = prior_state(fp.select("page_uid").distinct())
    decisions = change.fetch_decision(change.change_status(fp, prior_state=prior_state), policy=policy)
    if materialize:
        decisions = stored(decisions, "decisions")
    delta = change.log_delta(decisions.filter(change.is_gated(policy=policy))).select(
        F.lit(None).cast("string").alias("page_name"), "page_uid",
        F.col("url").alias("page_url"), "data_uid", "capture_seq")
    # what this run logs comes after all that earlier runs logged, late captures included
    state = ["page_uid", "data_uid", "capture_seq"]
    logged = delta.select(*state, F.lit(1).alias("_run"))
    if prior_state is not None:
        logged = prior_state.select(*state, F.lit(0).alias("_run")).unionByName(logged)
    nxt = change.compact_state(logged, arrival="_run")
    return RefreshResult(decisions, delta, nxt, bad.select("capture_seq", "reason"))


def gate(rows: DataFrame, decisions: DataFrame, flag: str = "emit_items",
         on: str = "capture_seq") -> DataFrame:
    """Keep rows (captures or entities) of captures whose ``flag`` is set."""
    keep = decisions.filter(F.col(flag)).select(on)
    return rows.join(keep, on, "left_semi")
