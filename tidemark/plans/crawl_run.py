"""One incremental batch over landed captures, end to end.

P4 (change gate) -> P1 (brand, car, version) + P2 (version_attr) + P3
(car2level) -> first-write-wins appends and quarantine -> change log ->
P5 (next requests).  Every output is a parquet folder under ``out_root``
partitioned by ``run_id``: run N reads only the folders of earlier runs as
its targets and state, and overwrites only its own folders, so a failed or
repeated run N rewrites the same rows and never reads its own first attempt.
Entities are written before the log.

A run's work follows its batch: the targets and the change state lie in key
buckets (``sources.bucketed``), of which it reads and writes those that its keys fall in.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.config import DEFAULT_SITE, SiteTemplates
from tidemark.operators import change, extract, levels as lv, lineage, sinks
from tidemark.plans import catalogue, fetch_plan, level_assignment, refresh as rf, spec_documents
from tidemark.schemas import BRAND, CAR, CAR2LEVEL, CHANGE_LOG, VERSION, VERSION_ATTR
from tidemark.session import stored
from tidemark.sources.bucketed import KEY_BUCKETS, STATE_BUCKETS, BucketedState, BucketedTarget
from tidemark.sources.dimensions import spec_dictionary

TABLES = ("brand", "car", "version", "version_attr", "car2level", "change_log", "quarantine",
          "state")


@dataclass
class RunPaths:
    root: str

    def table(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


def run_batch(spark: SparkSession, captures: DataFrame, out_root: str, run_id: int,
              prior_run_id: int | None = None, level_dim: DataFrame | None = None,
              manifest: DataFrame | None = None,
              site: SiteTemplates = DEFAULT_SITE, key_buckets: int = KEY_BUCKETS,
              state_buckets: int = STATE_BUCKETS) -> dict[str, DataFrame]:
    """Process one batch of captures as run ``run_id``; ``prior_run_id`` names
    the run whose change state this one continues.  Returns the written
    frames by name, the requests that follow from this batch as ``plan`` and
    those that begin a crawl as ``start``."""
    p = RunPaths(out_root)
    targets = {t.name: BucketedTarget(spark, p.table(t.name), t, run_id, key_buckets)
               for t in (BRAND, CAR, VERSION, VERSION_ATTR, CAR2LEVEL)}
    state = BucketedState(spark, p.table("state"), prior_run_id, state_buckets)
    # kinds that never consult the change log are neither hashed nor compared
    res = rf.refresh(captures.filter(change.is_gated()), prior_state=state.of)
    # one row per capture, used by every branch below: written once by refresh
    decisions = res.decisions.select("capture_seq", "kind", "decision", "emit_items", "follow_children")

    def emitted(rows: DataFrame) -> DataFrame:
        return rows.join(decisions.filter(F.col("emit_items")).select("capture_seq"),
                         "capture_seq", "left_semi")

    # list bodies are read once: entity rows (and parse failures) of every
    # list capture, checkpointed; items, audit lines and the plan are cut
    # from them by joining the decisions, never by re-reading bodies
    lin = ["capture_seq", "parent_id"] + [c for c in ("brand_name", "car_name")
                                          if c in captures.columns]
    b_rows = extract.brand_rows(captures.filter(F.col("kind") == "seed").select(*lin, "body"),
                                site=site).checkpoint(eager=True)
    c_all = extract.car_rows(captures.filter(F.col("kind") == "car_list").select(*lin, "body"),
                             outer=True).checkpoint(eager=True)
    v_all = extract.version_rows(captures.filter(F.col("kind") == "version_list")
                                 .select(*lin, "body"), outer=True).checkpoint(eager=True)
    c_rows = c_all.filter(F.col("pos").isNotNull()).drop("parsed_ok")
    v_rows = v_all.filter(F.col("pos").isNotNull()).drop("parsed_ok")

    out: dict[str, DataFrame] = {}
    quarantine = [res.quarantine.select(F.lit("capture").alias("target"), "capture_seq", "reason")]
    for name, fn in (("brand", lambda t: catalogue.store_brands(emitted(b_rows), manifest, t)),
                     ("car", lambda t: catalogue.store_cars(emitted(c_rows), t)),
                     ("version", lambda t: catalogue.store_versions(emitted(v_rows), t))):
        r = fn(targets[name])
        # kept: the target, the audit lines and the plan read it
        out[name] = stored(r.added.drop("capture_seq", "pos"), name)
        targets[name].append(sinks.with_audit_columns(out[name]))
        quarantine.append(r.quarantine.select(F.lit(name).alias("target"), "capture_seq",
                                              F.col("reason")))
    for kind, rows in (("car_list", c_all), ("version_list", v_all)):
        bad = rows.filter(~F.col("parsed_ok")).select("capture_seq").distinct()
        bad = bad.join(decisions.filter(F.col("decision") != "drop").select("capture_seq"),
                       "capture_seq", "left_semi")
        quarantine.append(bad.select(F.lit("capture").alias("target"), "capture_seq",
                                     F.lit(f"unparsable:{kind}").alias("reason")))

    # spec pages: gated first (a semi join on capture_seq, which shuffles the
    # spec bodies), then tokenised; unchanged pages never reach Python
    spec_pages = emitted(captures.filter(F.col("kind") == "spec_page")
                         .select("capture_seq", "kind", "parent_id", "body"))
    # one row a page, kept: the target rows, the rejects and the audit lines read it,
    # so each page is tokenised once
    docs = spec_documents.documents(spec_pages, spec_dictionary(spark)).checkpoint(eager=True)
    attrs, bad = spec_documents.store(docs, targets["version_attr"])
    targets["version_attr"].append(attrs.drop("capture_seq", "pos"))
    out["version_attr"] = attrs
    quarantine.append(bad.select(F.lit("version_attr").alias("target"), "capture_seq", "reason"))

    if level_dim is not None:
        before = targets["car"].earlier()
        cars_now = out["car"].select("third_id", "en_name")
        if before is not None:
            cars_now = before.select("third_id", "en_name").unionByName(cars_now)
        links = targets["car2level"].earlier()
        # never gated, so their bodies are not joined with the decisions
        level_caps = captures.filter(F.col("kind").isin("level_search", "car_page")).select(
            "capture_seq", "kind", "url", "parent_id", "body")
        lr = level_assignment.assign(level_caps, cars_now, level_dim, existing=links,
                                     target=targets["car2level"])
        # kept: the target, the rejects and the plan read the links
        added, bad = sinks.split_valid(sinks.conform(
            lr.added.checkpoint(eager=True), CAR2LEVEL, carry=["capture_seq"]))
        added_links = added.drop("capture_seq")
        quarantine += [lr.quarantine, bad.select(F.lit("car2level").alias("target"), "capture_seq", "reason")]
        targets["car2level"].append(added_links)
        out["car2level"] = added_links
        out["level_totals"] = lr.totals
        # cars still without a level after this run get their car page fetched
        linked = added_links.select("car_third_id")
        if links is not None:
            linked = links.select("car_third_id").unionByName(linked)
        out["unassigned"] = lv.unassigned(cars_now, linked)

    log, bad = sinks.split_valid(sinks.conform(res.log_delta, CHANGE_LOG, carry=["capture_seq"]))
    quarantine.append(bad.select(F.lit("change_log").alias("target"), "capture_seq", "reason"))
    q = quarantine[0]
    for x in quarantine[1:]:
        q = q.unionByName(x)
    sinks.append_rows(q, p.table("quarantine"), run_id)

    # log last, then the next state
    sinks.append_rows(sinks.with_audit_columns(log), p.table("change_log"), run_id)
    state.advance(res.log_delta, run_id)
    out["change_log"] = log

    # B6/B7 + C5: the console lines as data -- one per entity of a non-dropped
    # capture, '+ ' when its items were emitted
    shown = decisions.filter(F.col("decision") != "drop").select("capture_seq", "emit_items")
    lines = []
    for kind, rows in (("seed", b_rows), ("car_list", c_rows), ("version_list", v_rows)):
        name = F.col("name")
        if kind == "car_list" and "brand_name" in rows.columns:
            name = lineage.breadcrumb("brand_name", "name")
        if kind == "version_list" and "car_name" in rows.columns:
            name = lineage.breadcrumb("brand_name", "car_name", "name")
        mark = F.when(F.col("emit_items"), F.lit("new")).otherwise(F.lit("unchanged"))
        lines.append(rows.join(shown, "capture_seq").select(
            "capture_seq", "pos",
            lineage.audit_label(lineage.kind_tag(F.lit(kind)), name, mark).alias("line")))
    # spec pages are named through the stored version, car and brand; only new or
    # changed ones reach this line, which bears no mark
    full = lineage.version_full_names(*(targets[t].upto(run_id) for t in ("version", "car", "brand")))
    named = docs.select("capture_seq", F.lit(0).alias("pos"),
                        F.col("car_version_third_id").try_cast("int").alias("third_id")) \
        .join(full.select("third_id", "full_name"), "third_id")
    lines.append(named.select("capture_seq", "pos", lineage.audit_label(
        lineage.kind_tag(F.lit("spec_page")), "full_name", F.lit(change.UNCHANGED)).alias("line")))
    out["audit"] = lines[0].unionByName(lines[1]).unionByName(lines[2]).unionByName(lines[3])

    # children are followed per the decision table, also for flagged
    # (unchanged) list pages; positions restart in every response
    follow = decisions.filter(F.col("follow_children")).select("capture_seq")
    kids = lambda rows: rows.join(follow, "capture_seq", "left_semi")
    out["start"] = fetch_plan.start_requests(spark, level_dim, site=site)
    out["plan"] = fetch_plan.next_requests(
        brands=kids(b_rows), cars=kids(c_rows), versions=kids(v_rows),
        search_totals=out.get("level_totals"), unassigned_cars=out.get("unassigned"),
        site=site, ordered=True)
    return out
