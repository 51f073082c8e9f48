"""Streaming = batch, the state-store variant, refresh (P4), fetch plan (P5),
replay, and plan shapes."""


from pyspark.sql import functions as F

from tidemark.operators import change, extract
from tidemark.plans import catalogue, fetch_plan, refresh as rf
from tidemark.session import shared_path
from tidemark.sources.captures import read_captures
from tidemark.streaming.refresh import RefreshSink, start_refresh_stream, stateful_changes

CAP = "capture_seq long, kind string, url string, body string, parent_id string"

ROWS = [(1, "seed", "p", "A", None), (2, "seed", "p", "A", None), (3, "car_list", "q", "A", None),
        (4, "seed", "p", "B", None), (5, "seed", "p", "A", None), (6, "car_list", "q", "A", None),
        (7, "spec_page", "r", "S", None), (8, "spec_page", "r", "S", None),
        (9, "version_list", "v", "V", None), (10, "version_list", "v", "V", None)]


def _plan(df) -> str:
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_stream_equals_batch(spark):
    root = shared_path(spark, "t-stream")
    sink = RefreshSink(f"{root}/out")
    df = spark.createDataFrame(ROWS, CAP)
    for lo, hi in ((1, 3), (4, 7), (8, 10)):
        df.filter((F.col("capture_seq") >= lo) & (F.col("capture_seq") <= hi)) \
          .write.mode("append").parquet(f"{root}/in")
        start_refresh_stream(read_captures(spark, f"{root}/in", stream=True), sink,
                             f"{root}/ckpt").awaitTermination()
    streamed = sorted(r.capture_seq for r in spark.read.parquet(sink.log).collect())
    fp = change.add_fingerprints(df).drop("body")
    batch = sorted(r.capture_seq for r in change.log_delta(change.change_status(fp)).collect())
    assert streamed == batch == [1, 3, 4, 5, 7, 9]
    # replay of the last batch rewrites the same output
    from tidemark.streaming.refresh import refresh_batch
    last = spark.read.parquet(f"{root}/in").filter(F.col("capture_seq") >= 8)
    refresh_batch(read_captures(spark, f"{root}/in").filter(F.col("capture_seq") >= 8), 2, sink)
    again = sorted(r.capture_seq for r in spark.read.parquet(sink.log).collect())
    assert again == batch and last.count() == 3


def test_state_store_variant(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    root = shared_path(spark, "t-tws")
    df = spark.createDataFrame(ROWS, CAP)
    fp = change.add_fingerprints(df).drop("body")
    # three increments, one file each, so the state must carry across batches
    for lo, hi in ((1, 3), (4, 7), (8, 10)):
        fp.filter((F.col("capture_seq") >= lo) & (F.col("capture_seq") <= hi)).coalesce(1) \
          .write.mode("append").parquet(f"{root}/in")
    schema = spark.read.parquet(f"{root}/in").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(f"{root}/in")
    q = (stateful_changes(stream).writeStream.format("parquet")
         .option("checkpointLocation", f"{root}/ckpt").option("path", f"{root}/out")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert len(q.recentProgress) >= 3
    got = {r.capture_seq: r.status for r in spark.read.parquet(f"{root}/out").collect()}
    want = {r.capture_seq: r.status for r in change.change_status(fp).collect()}
    assert got == want


def test_refresh_decisions_and_gate(spark):
    df = spark.createDataFrame(ROWS, CAP)
    res = rf.refresh(df)
    d = {r.capture_seq: (r.status, r.decision) for r in res.decisions.collect()}
    assert d[2] == ("unchanged", "flag") and d[8] == ("unchanged", "drop")
    assert d[10] == ("unchanged", "flag")
    assert sorted(r.capture_seq for r in res.log_delta.collect()) == [1, 3, 4, 5, 7, 9]
    kept = sorted(r.capture_seq for r in rf.gate(df, res.decisions).collect())
    assert kept == [1, 3, 4, 5, 7, 9]
    # second run against the state: nothing new
    res2 = rf.refresh(df.filter(F.col("capture_seq").isin(5, 6, 7)), prior_state=res.next_state)
    assert res2.log_delta.count() == 0


def test_fetch_plan(spark):
    seed = ('{type:"mb",id:9,name:"甲",url:"/a/",cur:0},{type:"mb",id:10,name:"B",url:"/b/",cur:0}')
    cars = ('x={"s1":{"id":"11","name":"n","pid":"9","goid":"5","goname":"f"},'
            '"s2":{"id":"12","name":"m","pid":"9","goid":"5","goname":"f"}}')
    df = spark.createDataFrame([(1, "seed", "s", seed, None), (2, "car_list", "c", cars, "9")], CAP)
    b = extract.brand_rows(df.filter("kind = 'seed'"))
    c = catalogue.cars(df).added
    totals = spark.createDataFrame([(2, 201)], "level_id int, reported_count int")
    plan = fetch_plan.next_requests(brands=b, cars=c, search_totals=totals).collect()
    got = [(r.kind, r.parent_id, r.priority) for r in plan]
    assert got[:4] == [("car_list", "9", 9999), ("car_list", "10", 9998),
                       ("version_list", "11", 8999), ("version_list", "12", 8998)]
    assert sorted(r.url.split("page=")[1][:1] for r in plan if r.kind == "level_search") == ["2", "3"]


def test_replay_adds_nothing(spark):
    seed = '{type:"mb",id:9,name:"甲",url:"/a/",cur:0}'
    df = spark.createDataFrame([(1, "seed", "s", seed, None)], CAP)
    first = catalogue.brands(df).added
    target = spark.createDataFrame(first.select("third_id", "name", "remote_logo", "logo").collect(),
                                   first.select("third_id", "name", "remote_logo", "logo").schema)
    assert catalogue.brands(df, target=target).added.count() == 0


def test_plan_shapes(spark):
    from tidemark.plans.showcase import q_spec_values, q_unassigned, q_capture_status
    sf = "/root/testdata/sf0.001"
    assert "BroadcastHashJoin" in _plan(q_spec_values(spark, sf))
    assert "LeftAnti" in _plan(q_unassigned(spark, sf))
    p = _plan(q_capture_status(spark, sf))
    assert "Python" not in p and "ArrowEval" not in p
    # filters and projections reach the scan
    from tidemark.plans.showcase import q_insert_pairs
    p = _plan(q_insert_pairs(spark, sf))
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)" in p


def test_python_only_in_tokeniser_queries(spark):
    from tidemark.plans.showcase import QUERIES
    sf = "/root/testdata/sf0.001"
    python_nodes = ("MapInPandas", "MapInArrow", "ArrowEvalPython", "BatchEvalPython", "PythonUDF")
    for name, fn in QUERIES.items():
        if name == "stream_log_delta":        # runs a stream when called
            continue
        plan = _plan(fn(spark, sf))
        has_python = any(n in plan for n in python_nodes)
        assert has_python == (name in ("headline_text", "spec_rows", "spec_sheet_documents",
                                       "level_pages", "level_totals")), name


def test_level_join_is_broadcast(spark):
    from tidemark.plans.showcase import q_level_assignment
    p = _plan(q_level_assignment(spark, "/root/testdata/sf0.001"))
    assert "BroadcastHashJoin" in p


def test_refresh_batches_with_repeated_pages(spark):
    """A page logged several times in one batch (A, B) must seed the next
    batch with its latest digest (B), not an arbitrary one."""
    from tidemark.streaming.refresh import refresh_batch
    rows = [(1, "seed", "p", "A", None), (2, "seed", "p", "B", None), (3, "seed", "p", "A", None),
            (4, "seed", "p", "B", None), (5, "seed", "p", "B", None)]
    df = spark.createDataFrame(rows, CAP)
    sink = RefreshSink(shared_path(spark, "t-repeat"))
    refresh_batch(df.filter("capture_seq <= 3"), 0, sink)
    refresh_batch(df.filter("capture_seq > 3"), 1, sink)
    got = sorted(r.capture_seq for r in spark.read.parquet(sink.log).collect())
    assert got == [1, 2, 3, 4]


def test_scale_shapes(spark):
    from tidemark.operators import sinks
    src = spark.range(1000).selectExpr("id AS seq", "id % 7 AS k", "cast(id AS string) AS v")
    p = _plan(sinks.first_by_key(src, ["k"], ["seq"]))
    assert "partial_min" in p                      # combined map-side before the shuffle
    caps = spark.range(100).selectExpr("id AS capture_seq", "cast(id % 3 AS string) AS page_uid",
                                       "cast(id % 2 AS string) AS data_uid")
    # the written scan is read: no exchange of captures but that of the pages' first rows,
    # and the one window runs over a row per partition
    p = _plan(change.change_status(caps, segments=4))
    assert p.count("Window [") == 1 and "hashpartitioning(page_uid" not in p.split("Window [")[1]
    assert "_last#" in p.split("Window [")[1]


def test_snapshot_buckets_pruned(spark):
    import glob
    from tidemark.streaming.refresh import refresh_batch
    rows = [(i, "seed", f"u{i % 5}", "A" if i % 2 else "B", None) for i in range(1, 21)]
    df = spark.createDataFrame(rows, CAP)
    root = shared_path(spark, "t-buckets")
    sink = RefreshSink(root, compact_every=1, state_buckets=8)
    refresh_batch(df.filter("capture_seq <= 10"), 0, sink)
    local = root.replace("file:", "")
    assert glob.glob(f"{local}/state/batch_id=0/page_bucket=*")
    refresh_batch(df.filter("capture_seq > 10"), 1, sink)
    got = sorted(r.capture_seq for r in spark.read.parquet(sink.log).collect())
    fp = change.add_fingerprints(df).drop("body")
    want = sorted(r.capture_seq for r in change.log_delta(change.change_status(fp)).collect())
    assert got == want
    # a batch touching one page reads one bucket folder of the snapshot
    from tidemark.streaming.refresh import _read_snapshot
    one = spark.createDataFrame([("x",)], "page_uid string").select(
        change.sha1_hex("page_uid").alias("page_uid"))
    assert "page_bucket" not in _read_snapshot(spark, sink, 1, one).columns
    p = _plan(_read_snapshot(spark, sink, 1, one))
    assert "PartitionFilters: [isnotnull(page_bucket" in p


LATE = [(10, "seed", "p", "A", None), (5, "seed", "p", "B", None), (11, "seed", "p", "B", None)]


def test_late_captures_follow_arrival(spark):
    from tidemark.streaming.refresh import RefreshSink, refresh_batch
    rows = [spark.createDataFrame([r], CAP) for r in LATE]
    # snapshots off, after every batch, and in between
    for every in (10, 1, 2):
        sink = RefreshSink(shared_path(spark, f"t-late-{every}"), compact_every=every, state_buckets=4)
        for i, df in enumerate(rows):
            refresh_batch(df, i, sink)
        assert sorted(r.capture_seq for r in spark.read.parquet(sink.log).collect()) == [5, 10]
    state = None
    logged = []
    for df in rows:
        res = rf.refresh(df, prior_state=state)
        logged += [r.capture_seq for r in res.log_delta.collect()]
        state = res.next_state.checkpoint()
    assert logged == [10, 5]


def test_captures_that_cannot_be_compared(spark):
    from tidemark.streaming.refresh import RefreshSink, refresh_batch, rejected_captures
    df = spark.createDataFrame(
        [(1, "seed", "p", "A", None), (2, "seed", "p", None, None), (3, "seed", "p", "A", None),
         (4, "seed", None, "A", None), (None, "seed", "p", "B", None)], CAP)
    want = [(None, "null:capture_seq"), (2, "null:body"), (4, "null:url")]
    key = lambda r: (r[0] is not None, r[0])
    res = rf.refresh(df)
    assert {r.capture_seq: r.status for r in res.decisions.collect()} == {1: "new", 3: "unchanged"}
    assert sorted(map(tuple, res.quarantine.collect()), key=key) == want
    sink = RefreshSink(shared_path(spark, "t-rejected"))
    refresh_batch(df, 0, sink)
    assert [r.capture_seq for r in spark.read.parquet(sink.log).collect()] == [1]
    got = rejected_captures(spark, sink).select("capture_seq", "reason").collect()
    assert sorted(map(tuple, got), key=key) == want


def test_state_store_round_trips():
    """A page costs one read of the store, and one write only where its last digest is another."""
    from pyspark.sql import Row
    from tidemark.streaming.refresh import _processor_class

    class Value:
        def __init__(self):
            self.held, self.calls = None, []

        def exists(self):
            self.calls.append("exists")
            return self.held is not None

        def get(self):
            self.calls.append("get")
            return self.held

        def update(self, value):
            self.calls.append("update")
            self.held = value

    def run(*rows):
        value.calls.clear()
        out = list(p.handleInputRows(("p",), iter([Row(capture_seq=s, data_uid=d) for s, d in rows]), None))
        return [(r.capture_seq, r.data_uid, r.prev_digest, r.status) for r in out], list(value.calls)

    p = _processor_class()()
    p.last = value = Value()
    assert run((3, "A"), (1, "A"), (2, "B")) == (
        [(1, "A", None, "new"), (2, "B", "A", "changed"), (3, "A", "B", "changed")], ["get", "update"])
    assert run((5, "A"), (4, "A")) == ([(4, "A", "A", "unchanged"), (5, "A", "A", "unchanged")], ["get"])
    p.handleInitialState(("p",), Row(page_uid="p", data_uid="C"), None)
    assert run((6, "C"), (None, "D")) == ([(6, "C", "C", "unchanged"), (None, "D", "C", "changed")], ["get", "update"])
    # a NULL digest is one of its own
    assert run((8, None), (9, None)) == ([(8, None, "D", "changed"), (9, None, None, "unchanged")], ["get", "update"])
    assert run((10, None)) == ([(10, None, None, "unchanged")], ["get"])
