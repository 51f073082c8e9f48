"""Skew check for the change scan: a third of all captures on one page, orders far apart.

Captures are derived from ``lineitem`` (page = supplier, except every third line goes to one
hot page; digest = return flag; order = line id in microseconds).  ``change_status`` runs once
in 16 segments and once in a single one, and the largest number of shuffle records read by one
task is taken from Spark's event log (written to a scratch folder).  Results must be equal; the
first maximum must be near a sixteenth of the captures.

Usage: python scripts/skew_check.py [sf_dir] [segments]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def max_task_records(log_dir: str) -> dict[int, int]:
    """Largest shuffle-read record count of one task, per job group (the
    number before ':' in the job description)."""
    out: dict[int, int] = {}
    stage_group: dict[int, int] = {}
    files = [p for p in glob.glob(f"{log_dir}/**/*", recursive=True) if os.path.isfile(p)]
    for path in sorted(files):
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    desc = (ev.get("Properties") or {}).get("spark.job.description") or ""
                    head = desc.split(":")[0]
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = int(head) if head.isdigit() else -1
                elif kind == "SparkListenerTaskEnd":
                    m = ev.get("Task Metrics") or {}
                    recs = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                    g = stage_group.get(ev.get("Stage ID"), -1)
                    out[g] = max(out.get(g, 0), recs)
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    segments = int(sys.argv[2]) if len(sys.argv) > 2 else 16
    log_dir = tempfile.mkdtemp(prefix="skew-eventlog-", dir="/tmp")
    from pyspark.sql import functions as F
    from tidemark.operators import change
    from tidemark.session import get_session
    from tidemark.sources.tables import read_table

    spark = get_session("local[8]", app="skew-check", shuffle_partitions=16,
                        extra={"spark.eventLog.enabled": "true",
                               "spark.eventLog.dir": f"file://{log_dir}",
                               "spark.eventLog.compress": "false",
                               "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    li = read_table(spark, sf_dir, "lineitem")
    line = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    seq = line * 1_000_003
    page = F.when(line % 3 == 0, F.lit("hot")).otherwise(F.col("l_suppkey").cast("string"))
    caps = li.select(seq.alias("capture_seq"), change.sha1_hex(page).alias("page_uid"),
                     change.sha1_hex("l_returnflag").alias("data_uid")).checkpoint(eager=True)
    total = caps.count()
    results = {}
    for group, n in ((1, segments), (2, 1)):
        spark.sparkContext.setJobDescription(f"{group}:segments={n}")
        st = change.change_status(caps, segments=n)
        results[group] = st.groupBy("status").count().orderBy("status").collect()
    # first write wins with one key holding a third of the rows (copies)
    from tidemark.operators import sinks
    src = caps.select("capture_seq", F.when(F.col("capture_seq") % 3 == 0, F.lit("copy"))
                      .otherwise(F.col("page_uid")).alias("doc_key"), "data_uid")
    spark.sparkContext.setJobDescription("3:first_by_key")
    firsts = sinks.first_by_key(src, ["doc_key"], ["capture_seq"]).count()
    # latest digest per page (the compacted state) with the hot page
    spark.sparkContext.setJobDescription("4:latest_by_key")
    latest = change.latest_by_key(caps, "page_uid", "capture_seq", ["capture_seq", "data_uid"]).count()
    spark.sparkContext.setJobDescription(None)
    spark.stop()
    mx = max_task_records(log_dir)
    print(json.dumps({
        "captures": total, "hot_page_share": 1 / 3, "segments": segments,
        "equal_results": results[1] == results[2],
        "max_task_shuffle_records_segmented": mx.get(1),
        "max_task_shuffle_records_one_segment": mx.get(2),
        "status_counts": {r["status"]: r["count"] for r in results[1]},
        "first_by_key_rows": firsts,
        "max_task_shuffle_records_first_by_key": mx.get(3),
        "latest_by_key_rows": latest,
        "max_task_shuffle_records_latest_by_key": mx.get(4),
    }))


if __name__ == "__main__":
    main()
