"""Property tests (hypothesis): first-write-wins vs a dict simulation,
document assembly vs nested dict writes, batch vs any order-preserving split
into micro-batches."""

import json

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.operators import change, sinks, spec
from tidemark.session import shared_path
from tidemark.streaming.refresh import RefreshSink, refresh_batch

SETTINGS = dict(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.sampled_from("abc")),
                min_size=1, max_size=25),
       st.sets(st.integers(0, 4), max_size=3))
def test_insert_if_absent_vs_dict(spark, source, existing):
    rows = [(i, k, v) for i, (k, v) in enumerate(source)]
    target = spark.createDataFrame([(k, "old") for k in existing], "k int, v string")
    src = spark.createDataFrame(rows, "seq long, k int, v string")
    got = sorted((r.seq, r.k, r.v) for r in sinks.insert_if_absent(target, src, ["k"], ["seq"]).collect())
    table, want = {k: "old" for k in existing}, []
    for seq, k, v in rows:             # one INSERT per row, unique index on k
        if k is None or k not in table:
            if k is not None:
                table[k] = v
            want.append((seq, k, v))
    assert got == sorted(want)


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.sampled_from(["g1", "g2"]), st.sampled_from(["a", "b", "c"]),
                          st.one_of(st.sampled_from(["x", "-", "", "●,y"]), st.just("●"))),
                max_size=12))
def test_documents_vs_nested_dict(spark, writes):
    rows = []
    for pos, (g, i, text) in enumerate(writes):
        flag = text == "●"
        value = None if flag else ("" if text == "-" else text)
        rows.append((1, pos, g, i, value, flag))
    df = spark.createDataFrame(rows, "page_id long, pos int, grp string, item string, value string, "
                                     "is_flag boolean")
    pages = spark.createDataFrame([(1,)], "page_id long")
    got = spec.assemble_documents(df, pages).first().content
    want: dict = {}
    for _, _, g, i, v, f in rows:
        want.setdefault(g, {})[i] = 1 if f else v
    assert got == json.dumps(want, sort_keys=True, ensure_ascii=False, separators=(",", ":"))


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from("pq"), st.sampled_from("AB")), min_size=2, max_size=14),
       st.sets(st.integers(1, 13), max_size=3))
def test_batch_equals_any_split(spark, seq, cuts):
    rows = [(i + 1, "seed", f"u/{p}", d) for i, (p, d) in enumerate(seq)]
    df = spark.createDataFrame(rows, "capture_seq long, kind string, url string, body string")
    fp = change.add_fingerprints(df).drop("body")
    want = sorted(r.capture_seq for r in change.log_delta(change.change_status(fp)).collect())
    sink = RefreshSink(shared_path(spark, "t-split"), compact_every=2, state_buckets=4)
    bounds = [0] + sorted(c for c in cuts if c < len(rows)) + [len(rows)]
    for bid, (lo, hi) in enumerate(zip(bounds, bounds[1:])):
        refresh_batch(df.filter((F.col("capture_seq") > lo) & (F.col("capture_seq") <= hi)), bid, sink)
    got = sorted(r.capture_seq for r in spark.read.parquet(sink.log).collect())
    assert got == want
