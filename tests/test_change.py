"""Change detection: FIXTURES A.1, resume at every cut, the segmented scan vs a
sequential simulation (hypothesis)."""

import glob

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.operators import change

A1 = [(1, "p", "A"), (2, "p", "A"), (3, "q", "A"), (4, "p", "B"), (5, "p", "A"), (6, "q", "A")]
A1_STATUS = {1: "new", 2: "unchanged", 3: "new", 4: "changed", 5: "changed", 6: "unchanged"}


def _caps(spark, rows):
    return spark.createDataFrame(rows, "capture_seq long, page_uid string, data_uid string")


def _status(df):
    return {r.capture_seq: r.status for r in df.select("capture_seq", "status").collect()}


def simulate(rows):
    last, out = {}, {}
    for seq, page, digest in sorted(rows):
        prev = last.get(page)
        out[seq] = "new" if prev is None else ("unchanged" if prev == digest else "changed")
        if out[seq] != "unchanged":
            last[page] = digest
    return out


def test_fixture_statuses(spark):
    assert _status(change.change_status(_caps(spark, A1))) == A1_STATUS


def test_any_number_of_segments(spark):
    for segments in (1, 2, 3, 6):
        got = _status(change.change_status(_caps(spark, A1), segments=segments))
        assert got == A1_STATUS, segments


def test_segments_of_a_hot_page_with_sparse_orders(spark):
    """One page, orders in microseconds apart: as even as any range, and the same statuses."""
    n = 20_000
    caps = spark.range(n).select((F.col("id") * 1_000_003 + 1_700_000_000_000_000).alias("capture_seq"),
                                 F.lit("hot").alias("page_uid"),
                                 (F.col("id") % 7).cast("string").alias("data_uid"),
                                 F.lit("x").alias("_prev"), F.lit(1).alias("_segment"))
    before = set(glob.glob(f"{spark.sparkContext.getCheckpointDir().replace('file:', '')}/change-scan-*"))
    got = change.change_status(caps, segments=8)
    assert got.columns == [*caps.columns, "prev_digest", "status"]
    assert {r["status"]: r["count"] for r in got.groupBy("status").count().collect()} == {"new": 1, "changed": n - 1}
    [scan] = set(glob.glob(f"{spark.sparkContext.getCheckpointDir().replace('file:', '')}/change-scan-*")) - before
    sizes = [r["count"] for r in spark.read.parquet(scan).groupBy("_segment_").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * sorted(sizes)[4]


def test_log_delta_and_resume_every_cut(spark):
    full = change.log_delta(change.change_status(_caps(spark, A1)))
    assert sorted(r.capture_seq for r in full.collect()) == [1, 3, 4, 5]
    for cut in range(1, 7):
        first = [r for r in A1 if r[0] <= cut]
        rest = [r for r in A1 if r[0] > cut]
        log1 = change.log_delta(change.change_status(_caps(spark, first)))
        state = change.compact_state(log1)
        if not rest:
            continue
        log2 = change.log_delta(change.change_status(_caps(spark, rest), prior_state=state))
        seqs = sorted(r.capture_seq for r in log1.collect()) + \
            sorted(r.capture_seq for r in log2.collect())
        assert seqs == [1, 3, 4, 5], cut


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from("pqr"), st.sampled_from("AB")), min_size=1, max_size=40),
       st.integers(min_value=1, max_value=7))
def test_segmented_scan_matches_simulation(spark, seq, segments):
    rows = [(i * 3 + 1, p, d) for i, (p, d) in enumerate(seq)]
    got = _status(change.change_status(_caps(spark, rows), segments=segments))
    assert got == simulate(rows)


def test_latest_by_key(spark):
    latest = change.latest_by_key(_caps(spark, A1), "page_uid", "capture_seq",
                                  ["capture_seq", "data_uid"])
    got = {r.page_uid: (r.capture_seq, r.data_uid) for r in latest.collect()}
    assert got == {"p": (5, "A"), "q": (6, "A")}


def test_fetch_decision_table(spark):
    rows = [(1, "seed", "u"), (2, "car_list", "u"), (3, "version_list", "u"), (4, "spec_page", "u"),
            (5, "logo", "u"), (6, "level_search", "u")]
    df = spark.createDataFrame(rows, "capture_seq long, kind string, status string") \
              .withColumn("status", F.lit("unchanged"))
    got = {r.kind: (r.decision, r.emit_items, r.follow_children)
           for r in change.fetch_decision(df).collect()}
    assert got == {
        "seed": ("flag", False, True), "car_list": ("flag", False, True),
        "version_list": ("flag", False, False), "spec_page": ("drop", False, False),
        "logo": ("drop", False, False), "level_search": ("emit", True, True)}
    changed = {r.kind: (r.decision, r.follow_children) for r in
               change.fetch_decision(df.withColumn("status", F.lit("changed"))).collect()}
    assert changed["version_list"] == ("emit", True)
    assert changed["spec_page"] == ("emit", False)


def test_sha1_matches_python(spark):
    import hashlib
    df = spark.createDataFrame([("http://x/é", "body ")], "url string, body string")
    r = change.add_fingerprints(df).first()
    assert r.page_uid == hashlib.sha1("http://x/é".encode()).hexdigest()
    assert r.data_uid == hashlib.sha1("body ".encode()).hexdigest()
