"""End-to-end batch runs over hand-written captures (FIXTURES A.1-A.9)."""

from pyspark.sql import functions as F

from tidemark.config import DEFAULT_SITE
from tidemark.functions.text import utf8_text
from tidemark.plans.crawl_run import run_batch
from tidemark.session import shared_path

from test_spec_levels import A5, LEVELS, _car_page

CAP = "capture_seq long, kind string, url string, body string, parent_id string"
SEED = '{type:"mb",id:9,name:"甲",url:"/a/",cur:0},{type:"mb",id:10,name:"B B",url:"/b/",cur:0}'
CARS = ('x={"s1":{"id":"11","name":"甲一","showName":"甲 甲一","urlSpell":"jiayi","pid":"9",'
        '"goid":"5","goname":"厂","csSale":"0"},"s2":{"id":"21","name":"乙","showName":"乙",'
        '"urlSpell":"yi","pid":"9","goid":"5","goname":"厂","csSale":"1"},'
        '"s3":{"id":"31","name":"丙","showName":"丙","urlSpell":"bing","pid":"9","goid":"5",'
        '"goname":"厂","csSale":"2"}}')
VERS = ('x={"n1":{"id":101,"name":"1.5L","pid":11,"referprice":"9.98","salestate":"在销",'
        '"goname":"2018","tt":"t"}}')
SEARCH = '{"Count":1,"ResList":[{"SerialId":11}]}'


def _captures(spark, base, cars_body=CARS):
    rows = [(base + 1, "seed", DEFAULT_SITE.seed_url, SEED, None),
            (base + 2, "car_list", "http://api.catalogue.example/cl?pid=9", cars_body, "9"),
            (base + 3, "version_list", "http://api.catalogue.example/vl?pid=11", VERS, "11"),
            (base + 4, "spec_page", "http://car.catalogue.example/m101/", A5, "101"),
            (base + 5, "level_search", "http://select.catalogue.example/s?l=2&page=1&pagesize=100",
             SEARCH, "2"),
            (base + 6, "car_page", "http://car.m.catalogue.example/yi", _car_page("中型车第3名"), "21")]
    return spark.createDataFrame(rows, CAP)


def test_run_twice_then_change(spark):
    root = shared_path(spark, "t-run")
    dim = spark.createDataFrame(LEVELS, "id long, level_id int, level_name string, parent_level_id int")
    out1 = run_batch(spark, _captures(spark, 0), root, 1, None, level_dim=dim)
    assert sorted(r.third_id for r in out1["brand"].collect()) == [9, 10]
    assert sorted(r.third_id for r in out1["car"].collect()) == [11, 21, 31]
    assert [r.third_id for r in out1["version"].collect()] == [101]
    assert out1["version_attr"].first().content.startswith('{"body":{"color"')
    assert sorted((r.car_third_id, r.level_id) for r in out1["car2level"].collect()) == \
        [(11, 2), (21, 2), (21, 5)]
    lines = sorted(r.line for r in out1["audit"].collect())
    assert "[品牌] + 甲" in lines and "[车款] + 1.5L" in lines
    plan = {(r.kind, r.parent_id, r.priority) for r in out1["plan"].collect()}
    assert ("car_list", "9", 9999) in plan and ("spec_page", "101", 0) in plan
    assert sorted(r.third_id for r in out1["unassigned"].collect()) == [31]
    car_pages = [r.url for r in out1["plan"].collect() if r.kind == "car_page"]
    assert car_pages == [DEFAULT_SITE.car_page % "bing"]

    # the same content landed again: nothing new, nothing logged
    out2 = run_batch(spark, _captures(spark, 100), root, 2, 1, level_dim=dim)
    for t in ("brand", "car", "version", "version_attr", "car2level", "change_log"):
        assert out2[t].count() == 0, t
    assert "[品牌] 甲" in {r.line for r in out2["audit"].collect()}
    kinds = {r.kind for r in out2["plan"].collect()}
    # flagged lists still fan out; the car without a level is asked for again
    assert kinds == {"car_list", "version_list", "car_page"}

    # a changed car list: the new car is added, the old one is kept as it was
    changed = CARS.replace('"name":"甲一"', '"name":"renamed"').replace('"id":"21"', '"id":"22"')
    out3 = run_batch(spark, _captures(spark, 200, changed), root, 3, 2, level_dim=dim)
    assert [r.third_id for r in out3["car"].collect()] == [22]
    stored = {r.third_id: r.name for r in spark.read.parquet(f"{root}/car").collect()}
    assert stored[11] == "甲一"
    # level search and car pages never touch the change log: 4 gated kinds + 1 change
    assert spark.read.parquet(f"{root}/change_log").count() == 4 + 1


def test_utf8_text(spark):
    df = spark.createDataFrame([(bytearray("甲".encode()),)], "b binary")
    assert df.select(utf8_text("b").alias("t")).first().t == "甲"


def test_crawl_stream_equals_batch(spark):
    from tidemark.sources.captures import CAPTURE_SCHEMA, read_captures
    from tidemark.streaming.crawl_stream import start_crawl_stream
    root = shared_path(spark, "t-crawl-stream")
    dim = spark.createDataFrame(LEVELS, "id long, level_id int, level_name string, parent_level_id int")
    caps = _captures(spark, 0)
    full = caps.select(*[F.col(c) if c in caps.columns else
                         F.lit(None).cast(CAPTURE_SCHEMA[c].dataType).alias(c) for c in CAPTURE_SCHEMA.names])
    for lo, hi in ((1, 3), (4, 6)):
        full.filter((F.col("capture_seq") >= lo) & (F.col("capture_seq") <= hi)) \
            .write.mode("append").parquet(f"{root}/in")
        start_crawl_stream(read_captures(spark, f"{root}/in", stream=True), f"{root}/out",
                           f"{root}/ckpt", level_dim=dim).awaitTermination()
    batch = run_batch(spark, caps, f"{root}/batch", 0, None, level_dim=dim)
    for t in ("brand", "car", "version", "version_attr", "car2level", "change_log", "quarantine"):
        stored = spark.read.parquet(f"{root}/out/{t}").drop("run_id", "created_time", "updated_time")
        whole = spark.read.parquet(f"{root}/batch/{t}").select(*stored.columns)
        assert sorted(map(repr, stored.collect())) == sorted(map(repr, whole.collect())), t


def test_version_full_names(spark):
    from tidemark.operators.lineage import version_full_names
    v = spark.createDataFrame([(101, 11, "1.5L"), (102, 99, "x")], "third_id int, car_third_id int, name string")
    c = spark.createDataFrame([(11, "甲一", 9)], "third_id int, name string, brand_third_id int")
    b = spark.createDataFrame([(9, "甲")], "third_id int, name string")
    assert [r.full_name for r in version_full_names(v, c, b).collect()] == ["甲 甲一 1.5L"]


def test_run_quarantines_broken_list(spark):
    root = shared_path(spark, "t-run-bad")
    caps = spark.createDataFrame([(1, "car_list", "http://api.catalogue.example/x", "oops", "9"),
                                  (2, "version_list", "http://api.catalogue.example/y",
                                   'x={"n":{"id":"abc","name":"q","pid":1}}', "1")], CAP)
    run_batch(spark, caps, root, 1)
    got = sorted((r.target, r.capture_seq, r.reason) for r in spark.read.parquet(f"{root}/quarantine").collect())
    assert got == [("capture", 1, "unparsable:car_list"), ("version", 2, "type:third_id")]


def test_malformed_links_go_to_quarantine(spark):
    root = shared_path(spark, "t-run-links")
    dim = spark.createDataFrame(LEVELS, "id long, level_id int, level_name string, parent_level_id int")
    url = "https://api.catalogue.example/levels/2/cars?page=1&size=100"
    caps = spark.createDataFrame(
        [(1, "level_search", url, SEARCH, "2"), (2, "level_search", url, SEARCH, "abc"),
         (3, "level_search", url, '{"Count":1,"ResList":[{"SerialId":"x9"}]}', "2"),
         (4, "level_search", url, "not json", "2"), (5, "level_search", url, SEARCH[:-3], "2"),
         (6, "level_search", url, None, "2"), (7, "level_search", url, '{"ResList":[]}', "2"),
         (8, "level_search", url, '{"Count":0,"ResList":[]}', "5"),
         (9, "car_page", "u", _car_page("中型车第3名"), "?"), (10, "seed", "s", None, None)], CAP)
    out = run_batch(spark, caps, root, 1, level_dim=dim)
    assert [(r.car_third_id, r.level_id) for r in out["car2level"].collect()] == [(11, 2)]
    got = sorted((r.capture_seq, r.target, r.reason) for r in spark.read.parquet(f"{root}/quarantine").collect())
    assert got == [(2, "car2level", "type:level_id"), (3, "car2level", "type:car_third_id")] + \
        [(i, "capture", "unparsable:level_search") for i in (4, 5, 6, 7)] + \
        [(9, "car2level", "type:car_third_id"), (10, "capture", "null:body")]
    # a broken page is not a page that reports nothing
    assert {r.level_id: r.reported_count for r in out["level_totals"].collect()} == {2: 1, 5: 0}
    start = {(r.kind, r.parent_id) for r in out["start"].collect()}
    assert start == {("seed", None)} | {("level_search", str(r[1])) for r in LEVELS}


def test_spec_page_line(spark):
    root = shared_path(spark, "t-run-line")
    out = run_batch(spark, _captures(spark, 0), root, 1)
    assert "[车款配置] 甲 甲一 1.5L" in {r.line for r in out["audit"].collect()}
