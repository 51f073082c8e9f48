"""Spec documents (FIXTURES A.5, A.6) and level assignment (A.7-A.9)."""

import json

from pyspark.sql import functions as F

from tidemark.operators import levels, markup
from tidemark.plans import level_assignment, spec_documents
from tidemark.sources.dimensions import spec_dictionary

A5 = """<div class="x config-section y"><div class="special-layout-18"><table>
<tr><td><span class="title">长：</span></td><td><span class="info">4500</span></td>
    <td><span class="title">定速巡航：</span></td><td><span class="info">●</span></td></tr>
<tr><td><span class="title">夜视系统：</span></td><td><span class="info">-</span></td>
    <td><span class="title">供油方式：</span></td><td><div class="l">a</div><div class="l">b</div></td></tr>
<tr><td><span class="title">车身颜色：</span></td><td><div class="focus-color-warp"><ul>
  <li><a title="白"><span style="background:#FFFFFF"></span></a></li>
  <li><a title="黑"><span style="background:#000000"></span></a></li></ul></div></td></tr>
<tr><td><span class="title">中控彩色液晶屏：</span></td><td><span class="info">●</span></td></tr>
</table></div></div>"""
A5_JSON = ('{"body":{"color":"白:#FFFFFF,黑:#000000","len":"4500"},"engine":{"fuelmethod":"a,b"},'
           '"entcom":{"consolelcdscreen":1,"huddisplay":1},"safe":{"cruisecontrol":1,"nightvisionsystem":""}}')

EDGES = """<div class="my-config-section-2"><div class="special-layout-18"><table>
<tr><td><span class="title">长：</span></td><td><span class="info">1</span>
    <td><span class="title">长：</span><td><span class="info">2</span></tr>
<tr><td><span class="title">X</span></td><td><span class="info">z</span></td></tr>
<tr><td><span class="title"></span></td><td><span class="info">z</span></td></tr>
<tr><td><span class="title big">宽：</span></td><td><span class="info">9</span></td></tr>
<tr><td><span class="title">高：</span></td><td><span class="info">●</span><br><span class="info">x</span></td></tr>
<tr><td><span class="title">\tLED日间行车灯：</span></td><td><span class="info">有</span></td></tr>
<tr><td><span class="title">LED日间行车灯：</span></td><td><span class="info">无</span></td></tr>
<tr><td><span class="title">车身颜色：</span></td><td><div class="focus-color-warp"><ul>
  <li><a title="红"><span style="color:#FF0000;"></span></a></ul></div></td></tr>
</table></div></div>"""

CAP = "capture_seq long, kind string, url string, body string, parent_id string"


def _docs(spark, pages):
    df = spark.createDataFrame(pages, CAP)
    return {r.car_version_third_id: r.content
            for r in spec_documents.documents(df, spec_dictionary(spark)).collect()}


def test_dictionary_shape(spark):
    d = spec_dictionary(spark)
    assert d.count() == 142
    assert d.select("label").distinct().count() == 141
    assert d.select("grp").distinct().count() == 13
    assert d.filter(F.col("label") == "\tLED日间行车灯").count() == 1


def test_spec_page_fixture(spark):
    docs = _docs(spark, [(1, "spec_page", "u", A5, "101"),
                         (2, "spec_page", "u", "<html><body>nothing</body></html>", "102")])
    assert docs["101"] == A5_JSON
    assert docs["102"] == "{}"


def test_spec_page_edges(spark):
    doc = json.loads(_docs(spark, [(1, "spec_page", "u", EDGES, "7")])["7"])
    assert doc["body"]["len"] == "2"              # label twice: last wins
    assert "width" not in doc["body"]              # class "title big" does not match
    assert doc["body"]["height"] == "●,x"          # only the whole text is a flag
    assert doc["light"]["daytimerunninglight"] == "有"   # label with the TAB only
    assert doc["body"]["color"] == "红:FF0000;"     # last 7 characters as they are


def test_tokeniser_void_and_unclosed():
    root = markup.parse_html("<div class='config-section'><div class='special-layout-18'><table>"
                             "<tr><td><span class=title>a:</span><td><span class=info>v<br>w</span>"
                             "<tr><td><span class=title>b:</span><td><div class=l>q</div></table>")
    rows = markup.spec_sheet_rows(root)
    assert [(r["label"], r["info"], r["alt"]) for r in rows] == [("a:", ["v", "w"], []),
                                                                 ("b:", [], ["q"])]


LEVELS = [(1, 2, "轿车", 0), (2, 5, "中型车", 2), (3, 8, "SUV", 0), (4, 16, "大型SUV", 8),
          (5, 12, "皮卡", 0), (6, 99, "皮卡", 0)]


def _car_page(text):
    if text is None:
        return "<html><div class='car-price'><dl><dd>x</dd></dl></div></html>"
    return f"<html><div class='car-price'><dl><dd>p</dd></dl><dl><dd>{text}</dd></dl></div></html>"


def test_level_fixture(spark):
    level_dim = spark.createDataFrame(LEVELS, "id long, level_id int, level_name string, parent_level_id int")
    cars = spark.createDataFrame(
        [(11, "a"), (12, "b"), (21, "c"), (22, "d"), (23, "e"), (24, "f"), (25, "g"), (26, "h"),
         (27, " "), (28, None)], "third_id int, en_name string")
    search = '{"Count":201,"ResList":[{"SerialId":11},{"SerialId":12},{"SerialId":11}]}'
    caps = [(1, "level_search", "http://s/?l=2&page=1&pagesize=100", search, "2"),
            (2, "level_search", "http://s/?l=2&page=2&pagesize=100",
             '{"Count":201,"ResList":[{"SerialId":12}]}', "2"),
            (3, "level_search", "http://s/?l=8&page=1&pagesize=100", '{"Count":0,"ResList":[]}', "8")]
    texts = {21: "中型车第3名", 22: "中大型SUV第1名", 23: "卡车第9名", 24: "未知第1名", 25: None,
             26: "皮卡", 27: "皮卡", 11: "SUV"}
    caps += [(100 + k, "car_page", "u", _car_page(v), str(k)) for k, v in texts.items()]
    df = spark.createDataFrame(caps, CAP)
    res = level_assignment.assign(df, cars, level_dim)
    got = sorted((r.car_third_id, r.level_id) for r in res.added.collect())
    assert got == [(11, 2), (12, 2), (21, 2), (21, 5), (22, 8), (22, 16), (23, 12), (26, 12)]
    totals = {r.level_id: (r.reported_count, r.n_pages) for r in res.totals.collect()}
    assert totals == {2: (201, 3), 8: (0, 0)}
    total = spark.range(1).select(F.lit(res.total).alias("t")).first().t
    assert total == 201 + 6          # six rows added by the text branch


def test_unassigned_blank_names(spark):
    cars = spark.createDataFrame([(1, "a"), (2, "  "), (3, None), (4, "")], "third_id int, en_name string")
    links = spark.createDataFrame([(9, 1)], "car_third_id int, level_id int")
    assert sorted(r.third_id for r in levels.unassigned(cars, links).collect()) == [1]


def test_level_dimension_scan(spark):
    from tidemark.session import shared_path
    from tidemark.sources.dimensions import level_dimension
    path = shared_path(spark, "t-levels")
    spark.createDataFrame(LEVELS, "id long, level_id int, level_name string, parent_level_id int") \
         .withColumn("extra", F.lit(1)).write.parquet(path)
    dim = level_dimension(spark, path)
    assert dim.columns == ["id", "level_id", "level_name", "parent_level_id"]
    first = {r.level_name: r.level_id for r in levels.first_level_per_name(dim).collect()}
    assert first["皮卡"] == 12                    # smallest id wins (C2)
