"""Bucketed targets and state, global ranks."""

import glob
import random

from pyspark.sql import functions as F

from tidemark.operators import ranking, sinks
from tidemark.schemas import BRAND, ColumnRule, TargetSpec
from tidemark.session import shared_path
from tidemark.sources.bucketed import BucketedState, BucketedTarget, bucket_of

from test_stream_plans import _plan

PAIR = TargetSpec("pair", (ColumnRule("a", "int"), ColumnRule("b", "smallint")), keys=("a", "b"))


def _files(path, run_id):
    return glob.glob(f"{path.replace('file:', '')}/*/run_id={run_id}")


def test_small_run_over_a_large_state_writes_few_buckets(spark):
    path = shared_path(spark, "t-state")
    first = BucketedState(spark, path)
    pages = spark.range(1_000_000).select(F.sha1(F.col("id").cast("string").cast("binary")).alias("page_uid"),
                                          F.lit("A").alias("data_uid"), F.col("id").alias("capture_seq"))
    first.advance(pages, 1)
    assert len(_files(first.data, 1)) == 1024
    second = BucketedState(spark, path, 1)
    ten = pages.limit(10).withColumn("data_uid", F.lit("B")).withColumn("capture_seq", F.lit(5).cast("long"))
    ten = spark.createDataFrame(ten.collect(), ten.schema)
    seen = second.of(ten.select("page_uid"))
    assert {r.data_uid for r in seen.collect()} == {"A"} and seen.count() == 10
    for _ in range(2):                                 # a repeated run rewrites its own buckets
        second.advance(ten, 2)
        assert 0 < len(_files(second.data, 2)) <= 10
    third = BucketedState(spark, path, 2)
    assert {r.data_uid for r in third.of(ten.select("page_uid")).collect()} == {"B"}
    assert third.all().count() == 1_000_000
    # the state of run 1 is still there for a repeated run 2
    assert {r.data_uid for r in BucketedState(spark, path, 1).of(ten.select("page_uid")).collect()} == {"A"}


def test_state_of_no_run(spark):
    state = BucketedState(spark, shared_path(spark, "t-none"), None, 4)
    assert state.all().count() == 0
    assert state.of(spark.createDataFrame([("p",)], "page_uid string")) is None
    state.advance(spark.createDataFrame([], "page_uid string, data_uid string, capture_seq long"), 1)
    assert BucketedState(spark, shared_path(spark, "t-none"), None, 4).versions == {}


def test_target_reads_its_keys_buckets(spark):
    path = shared_path(spark, "t-target")
    rows = spark.range(500).select(F.col("id").cast("int").alias("a"), F.lit(1).cast("smallint").alias("b"))
    one = BucketedTarget(spark, path, PAIR, 1, buckets=16)
    one.append(sinks.with_audit_columns(rows))
    # integers of another type fall in the same bucket
    batch = spark.createDataFrame([(7, 1), (900, 1), (7, 2)], "a long, b int").withColumn("seq", F.lit(1))
    two = BucketedTarget(spark, path, PAIR, 2, buckets=16)
    held = two.holding(batch)
    plan = _plan(held)
    assert "PartitionFilters: [" in plan and "key_bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    mine = {r[0] for r in batch.select(bucket_of(["a", "b"], 16)).collect()}
    assert 0 < len(mine) < 4 and {r[0] for r in held.select(bucket_of(["a", "b"], 16)).collect()} <= mine
    added = sinks.insert_if_absent(two, batch, ["a", "b"], ["seq"])
    assert sorted((r.a, r.b) for r in added.collect()) == [(7, 2), (900, 1)]
    # a run doesn't see its own first attempt, and overwrites it
    for _ in range(2):
        two.append(sinks.insert_if_absent(two, batch, ["a", "b"], ["seq"]).drop("seq"))
    assert two.upto(2).count() == 502 and two.earlier().count() == 500


def test_target_without_rows(spark):
    path = shared_path(spark, "t-empty")
    none = spark.createDataFrame([], "third_id int, name string, remote_logo string, logo string")
    BucketedTarget(spark, path, BRAND, 1).append(none)
    assert BucketedTarget(spark, path, BRAND, 2).earlier().count() == 0


def test_global_rank(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None]), rng.randrange(1000), i, "x") for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, v int, i int, _at string").repartition(7)
    got = ranking.global_rank(df, [F.col("v").desc(), "i"], ["g"], total="n")
    assert got.columns == ["g", "v", "i", "_at", "rank", "n"]
    for g in ("a", "b", None):
        mine = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2]))
        found = sorted((r for r in got.collect() if r.g == g), key=lambda r: r["rank"])
        assert [(r.v, r.i) for r in found] == [(r[1], r[2]) for r in mine]
        assert [r["rank"] for r in found] == list(range(1, len(mine) + 1)) and {r.n for r in found} == {len(mine)}
    assert ranking.global_rank(df.limit(0), ["i"]).count() == 0


def test_search_bodies_are_parsed_once(spark):
    """Links, rejects, totals and the cars left over read stored rows, not bodies."""
    from tidemark.plans import showcase
    res = showcase._level_result(spark, "/root/testdata/sf0.001")
    for df in (res.totals, res.quarantine, res.added):
        assert "from_json" not in _plan(df)
