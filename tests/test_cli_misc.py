"""Command line and partitioning helpers."""

import json

from pyspark.sql import functions as F

from tidemark.session import shared_path
from tidemark.sources.captures import CAPTURE_SCHEMA

from test_crawl_run import _captures


def test_building_starts_no_job(spark):
    from tidemark.operators import change
    tracker = spark.sparkContext.statusTracker()
    grouped = spark.range(100).selectExpr("id % 7 AS id").groupBy("id").count().selectExpr(
        "cast(id AS string) AS url", "cast(count AS string) AS body")
    before = len(tracker.getJobIdsForGroup(None))
    change.add_fingerprints(grouped)
    assert len(tracker.getJobIdsForGroup(None)) == before


def test_unreadable_target_fails(spark):
    import pytest
    from tidemark.schemas import BRAND
    from tidemark.sources.bucketed import BucketedTarget
    root = shared_path(spark, "t-unreadable")
    assert BucketedTarget(spark, f"{root}/none", BRAND, 1).earlier() is None
    spark.createDataFrame([("x",)], "value string").write.text(f"{root}/text/key_bucket=1/run_id=0")
    with pytest.raises(Exception):
        BucketedTarget(spark, f"{root}/text", BRAND, 1).earlier().collect()


def test_null_digest_keeps_a_page_seen(spark):
    from tidemark.operators import change
    df = spark.createDataFrame([(1, "p", "A"), (2, "p", None), (3, "p", "A")],
                               "capture_seq long, page_uid string, data_uid string")
    got = {r.capture_seq: r.status for r in change.change_status(df).collect()}
    assert got == {1: "new", 2: "changed", 3: "changed"}


def test_first_capture_of_the_first_page_counts(spark):
    from tidemark.operators import levels
    rows = [(1, 1, 9, 40), (1, 1, 3, 90), (1, 2, 1, 7)]
    for some in (rows, rows[::-1]):
        df = spark.createDataFrame(some, "level_id int, page int, capture_seq long, reported_count int")
        [r] = levels.reported_totals(df, seq="capture_seq").collect()
        assert r.reported_count == 90


def test_cli_run(spark, capsys):
    from tidemark.__main__ import main
    root = shared_path(spark, "t-cli")
    caps = _captures(spark, 0)
    caps.select(*[F.col(c) if c in caps.columns else F.lit(None).cast(CAPTURE_SCHEMA[c].dataType).alias(c)
                  for c in CAPTURE_SCHEMA.names]).write.parquet(f"{root}/captures")
    assert main(["run", "--captures", f"{root}/captures", "--out", f"{root}/out", "--run-id", "1"]) == 0
    printed = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    plan = spark.read.parquet(printed["plan"])
    assert plan.filter(F.col("kind") == "car_list").count() == 2
    assert sorted(r.third_id for r in spark.read.parquet(f"{root}/out/brand").collect()) == [9, 10]


def test_binary_bodies_decoded_in_scan(spark):
    from tidemark.sources.captures import read_captures
    path = shared_path(spark, "t-binary")
    spark.createDataFrame([(1, "seed", "u", bytearray('{type:"mb",id:9,name:"甲",url:"/a/",cur:0}'.encode()))],
                          "capture_seq long, kind string, url string, body binary").write.parquet(path)
    df = read_captures(spark, path, kinds=["seed"], body_binary=True)
    assert df.first().body.startswith('{type:"mb",id:9,name:"甲"')


def test_shared_folder_comes_from_the_session(spark):
    from tidemark.session import ensure_checkpoint_dir, get_session
    configured = spark.sparkContext.getCheckpointDir()
    assert ensure_checkpoint_dir(spark) == configured
    assert shared_path(spark, "x").startswith(configured.rstrip("/") + "/x-")
    # building the session again keeps the configured folder
    assert ensure_checkpoint_dir(get_session()) == configured
