"""Extraction (FIXTURES A.2-A.4, A.7) and sinks (A.10, A.11, A9 rules)."""

from pyspark.sql.types import StringType

from tidemark.config import DEFAULT_SITE
from tidemark.operators import extract, sinks
from tidemark.plans import catalogue
from tidemark.schemas import ColumnRule

CAP = "capture_seq long, kind string, url string, body string, parent_id string"


def caps(spark, rows):
    return spark.createDataFrame(rows, CAP)


def test_seed_regex_and_edges(spark):
    body = ('{type:"mb",id:9,name:"甲",url:"/a/",cur:0},{type:"mb",id:10,name:"B B",url:"/b/",cur:0}'
            '\n{type:"mb",id:11,name:"x y\r",url:"/c/",cur:0}'
            '\n{type:"mb",id:12,name:"bro\nken",url:"/d/",cur:0}')
    df = extract.brand_rows(caps(spark, [(1, "seed", "s", body, None)]))
    got = [(r.pos, r.third_id, r.name, r.priority) for r in df.orderBy("pos").collect()]
    assert got == [(0, "9", "甲", 9999), (1, "10", "B B", 9998), (2, "11", "x y\r", 9997)]
    r0 = df.orderBy("pos").first()
    assert r0.remote_logo == DEFAULT_SITE.brand_logo % "9"


def test_seed_line_separators_and_empty_id(spark):
    body = ('{type:"mb",id:7,name:"a\u2028b",url:"/a/",cur:0},{type:"mb",id:8,name:"c\u0085d",url:"/b/",cur:0}'
            ',{type:"mb",id:,name:"e",url:"/c/",cur:0},{type:"mb",id:7,name:"again",url:"/d/",cur:0}')
    df = caps(spark, [(1, "seed", "s", body, None)])
    got = [(r.third_id, r.name) for r in extract.brand_rows(df).orderBy("pos").collect()]
    assert got == [("7", "a\u2028b"), ("8", "c\u0085d"), ("", "e"), ("7", "again")]
    out = catalogue.brands(df)
    assert sorted((r.third_id, r.name) for r in out.added.collect()) == [(7, "a\u2028b"), (8, "c\u0085d")]
    assert [r.reason for r in out.quarantine.collect()] == ["type:third_id"]


def test_json_raw_newline_and_shapes(spark):
    rows = [(1, "version_list", "u", 'x={"n":{"id":1,"name":"a\nb","pid":2}}', None),
            (2, "version_list", "u", 'x=[1, 2]', None),
            (3, "version_list", "u", 'x={"n":1}', None)]
    df = caps(spark, rows)
    got = [(r.third_id, r.name) for r in extract.version_rows(df).collect()]
    assert got == [("1", "a\nb")]
    assert sorted(r.capture_seq for r in catalogue.unparsable_captures(df).collect()) == [2, 3]


def test_seed_record_without_name_runs_on(spark):
    body = '{type:"a",id:1,url:"/x/",cur:0},{type:"b",id:2,name:"N",url:"/y/",cur:0}'
    r = extract.brand_rows(caps(spark, [(1, "seed", "s", body, None)])).collect()
    assert len(r) == 1 and r[0].third_id == '1,url:"/x/",cur:0},{type:"b",id:2' and r[0].name == "N"


def test_car_list_json_edges(spark):
    rows = [
        (1, "car_list", "u1", 'requestDatalist["x"]={"s1":{"id":"11","name":"甲一","showName":"甲 甲一",'
                              '"urlSpell":"jiayi","pid":"9","goid":"5","goname":"厂","csSale":"0"}}', None),
        (2, "car_list", "u2", 'x={"a":{"id":12,"name":"t\tab","goname":"f","pid":"9","goid":"5"},"b":{"id":16,"name":"t\tab","goname":"f","pid":"9","goid":"5"},"a":{"id":13,"name":"last","goname":"f","pid":"9","goid":"5"}};', None),
        (3, "car_list", "u3", 'x={"b":{"name":"no id"},"c":{"id":14}}', None),
        (4, "car_list", "u4", "no json here", None),
        (5, "car_list", "u5", 'x={"d":{"id":15,"name":"cut', None),
        (6, "car_list", "u6", "x={}", None),
    ]
    out = catalogue.cars(caps(spark, rows))
    added = {r.third_id: r for r in out.added.collect()}
    assert set(added) == {11, 13, 16}
    assert (added[13].pos, added[16].pos, added[16].name) == (0, 1, "t\tab")
    a = added[11]
    assert (a.name, a.show_name, a.en_name, a.brand_third_id, a.factory_third_id, a.factory_name,
            a.sale_state) == ("甲一", "甲 甲一", "jiayi", 9, 5, "厂", 0)
    reasons = sorted(r.reason for r in out.quarantine.collect())
    assert any("missing:third_id" in x for x in reasons)
    assert any("missing:name" in x for x in reasons)
    bad = {r.capture_seq for r in catalogue.unparsable_captures(caps(spark, rows)).collect()}
    assert bad == {4, 5}


def test_version_list(spark):
    body = ('x={"n1":{"id":101,"name":"1.5L","pid":11,"referprice":"9.98","salestate":"在销",'
            '"goname":"2018","tt":"t"}}')
    out = catalogue.versions(caps(spark, [(1, "version_list", "u", body, None)]))
    r = out.added.first()
    assert (r.car_third_id, r.third_id, r.name, r.refer_price, r.year_type, r.sale_state, r.tt) == \
        (11, 101, "1.5L", "9.98", "2018", "在销", "t")


def test_search_rows_and_pages(spark):
    from tidemark.functions.paging import page_count, page_numbers
    body = '{"Count":201,"ResList":[{"SerialId":11},{"SerialId":12},{"SerialId":11}]}'
    r = extract.search_rows(caps(spark, [(1, "level_search", "u", body, "2")])).collect()
    assert [(x.reported_count, x.car_third_id) for x in r] == [(201, 11), (201, 12), (201, 11)]
    df = spark.createDataFrame([(0,), (1,), (100,), (101,), (201,)], "c int")
    got = [(x.c, x.n, x.p) for x in df.select("c", page_count("c", 100).alias("n"),
                                                page_numbers(page_count("c", 100)).alias("p"))
           .orderBy("c").collect()]
    assert got == [(0, 0, []), (1, 1, [1]), (100, 1, [1]), (101, 2, [1, 2]), (201, 3, [1, 2, 3])]


def test_insert_if_absent_fixture(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    src = spark.createDataFrame([(1, 1, "z"), (2, 2, "b"), (3, 2, "c"), (4, None, "d"), (5, None, "e")],
                                "seq long, k int, v string")
    added = sinks.insert_if_absent(target, src, ["k"], ["seq"])
    assert sorted((r.k or 0, r.v) for r in added.collect()) == [(0, "d"), (0, "e"), (2, "b")]
    # replay: the target now holds the added rows; only NULL-key rows come again
    target2 = target.unionByName(added.select("k", "v"))
    again = sinks.insert_if_absent(target2, src, ["k"], ["seq"])
    assert sorted(r.v for r in again.collect()) == ["d", "e"]
    # non-nullable key: NULL rows go to quarantine
    conf = sinks.conform(src, [ColumnRule("k", "int", nullable=False), ColumnRule("v", "string")],
                         carry=["seq"])
    ok, bad = sinks.split_valid(conf)
    assert sorted(r.seq for r in bad.collect()) == [4, 5]
    assert {r.reason for r in bad.collect()} == {"null:k"}


def test_first_by_key_ties_and_pairs(spark):
    src = spark.createDataFrame([(1, 0, 7, 1, "x"), (1, 0, 7, 1, "a"), (2, 0, 7, 2, "q")],
                                "seq long, pos int, a int, b int, v string")
    got = sinks.first_by_key(src, ["a", "b"], ["seq", "pos"]).collect()
    assert sorted((r.a, r.b, r.v) for r in got) == [(7, 1, "a"), (7, 2, "q")]


def test_conform_rules(spark):
    df = spark.createDataFrame([("x" * 31, "12", None), ("ok", "zz", "n")],
                               "name string, third_id string, other string")
    rules = [ColumnRule("third_id", "int", nullable=False), ColumnRule("name", "string", max_len=30),
             ColumnRule("other", "string", nullable=False), ColumnRule("state", "tinyint", default=0)]
    got = sorted(r.reasons for r in sinks.conform(df, rules).collect())
    assert got == [["length:name", "null:other"], ["type:third_id"]]


def test_attach_asset(spark):
    brands = spark.createDataFrame([(1, "u1"), (2, "u2"), (3, "u3"), (4, None)],
                                   "third_id int, remote_logo string")
    manifest = spark.createDataFrame(
        [("u1", 2, True, "p12"), ("u1", 1, True, "p11"), ("u1", 0, False, "p10"),
         ("u2", 0, False, "p20")], "url string, pos int, ok boolean, path string")
    got = {r.third_id: r.logo for r in sinks.attach_asset(brands, manifest).collect()}
    assert got == {1: "p11", 4: None}


def test_route(spark):
    df = spark.createDataFrame([("brand", 1), ("car", 2), ("odd", 3)], "t string, v int")
    tagged = sinks.tag_records(df, "t", {"brand": "b_sink", "car": "c_sink"})
    parts = sinks.route(tagged, ["b_sink", "c_sink"])
    assert [r.v for r in parts["b_sink"].collect()] == [1]
    assert [r.v for r in parts["c_sink"].collect()] == [2]
    assert tagged.count() == 2


def test_many_repeated_keys_like_a_dict(spark):
    import json
    keys = [f"k{i * 7919 % 1500}" for i in range(6000)]
    pairs = [(k, str(n)) for n, k in enumerate(keys)]
    body = "x={" + ",".join(f"{json.dumps(k)}:{json.dumps(v)}" for k, v in pairs) + "}"
    df = spark.createDataFrame([(1, body)], "id int, body string")
    got = [(r.key, r.value) for r in extract.explode_json_map(df, "body", StringType()).orderBy("pos").collect()]
    assert got == list(dict(pairs).items())
