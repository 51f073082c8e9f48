"""The registered queries: each operator applied to the driver tables.

The driver tables hold no car catalogue, so every generic operator runs on a
table of the same shape (events as captures of pages, pages as HTML bodies,
orders and customers as search results and cars, ...).  Each function takes
(spark, sf_dir) and reads whole tables; columns are named as in
``tidemark.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType

from tidemark.config import DEFAULT_SITE
from tidemark.functions.digest import sha1_hex
from tidemark.functions.regex import regex_matches
from tidemark.functions.text import utf8_text
from tidemark.functions.urls import from_template, url_host, host_allowed
from tidemark.operators import change, extract, frontier as fr, levels, lineage, markup, sinks, spec
from tidemark.schemas import VERSION, ColumnRule, TargetSpec
from tidemark.session import stored
from tidemark.sources.dimensions import spec_dictionary
from tidemark.sources.tables import read_table


# --------------------------------------------------------------------------
# captures derived from events: page = user, body = event type, order = id
# --------------------------------------------------------------------------

CAPTURE_KIND_CYCLE = ["seed", "car_list", "version_list", "spec_page"]


def event_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    kinds = F.array(*[F.lit(k) for k in CAPTURE_KIND_CYCLE])
    return ev.select(
        F.col("event_id").alias("capture_seq"),
        F.element_at(kinds, (F.col("user_id") % len(CAPTURE_KIND_CYCLE) + 1).cast("int")).alias("kind"),
        F.format_string("user/%d", F.col("user_id")).alias("url"),
        F.col("event_type").alias("body"),
        F.col("user_id").cast("string").alias("parent_id"))


def _fingerprinted_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashed once: the change scan samples its ranges from the written fingerprints."""
    return stored(change.add_fingerprints(event_captures(spark, sf_dir)).drop("body"), "fingerprints")


def q_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    fp = change.add_fingerprints(pages, url="url", body="html")
    return fp.select("page_id", "page_uid", "data_uid")


def q_capture_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = change.change_status(_fingerprinted_events(spark, sf_dir))
    return st.select(F.col("capture_seq").alias("event_id"), "page_uid", "data_uid", "status")


def q_log_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = change.change_status(_fingerprinted_events(spark, sf_dir))
    return change.log_delta(st).select(
        F.col("capture_seq").alias("event_id"), "page_uid", "data_uid")


def q_resumed_log_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First run on the earlier half of the id range, second run resumed from
    the compacted log of the first; both halves together cover the table."""
    caps = _fingerprinted_events(spark, sf_dir)
    ids = read_table(spark, sf_dir, "events")
    # one scalar, computed once: the filters below then push down to the scan
    # as plain range predicates instead of repeating a subquery per branch
    cut = ids.agg(F.expr("(min(event_id) + max(event_id)) div 2")).first()[0]
    if cut is None:
        return spark.createDataFrame([], "event_id long, page_uid string, data_uid string")
    # the first run's log is a stored table when a run resumes; here it is
    # checkpointed so the second run reads it instead of recomputing run one
    log = ["capture_seq", "page_uid", "data_uid"]
    first_log = change.log_delta(change.change_status(caps.filter(F.col("capture_seq") < cut)),
                                 keep=log).checkpoint(eager=True)
    second = change.change_status(caps.filter(F.col("capture_seq") >= cut),
                                  prior_state=change.compact_state(first_log))
    return first_log.unionByName(change.log_delta(second, keep=log)).withColumnRenamed(
        "capture_seq", "event_id")


def q_fetch_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = change.fetch_decision(change.change_status(_fingerprinted_events(spark, sf_dir)))
    return st.select(F.col("capture_seq").alias("event_id"), "kind", "status", "decision",
                     "emit_items", "follow_children")


def q_latest_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    caps = change.add_fingerprints(event_captures(spark, sf_dir)).drop("body")
    return change.latest_by_key(caps, "page_uid", "capture_seq", ["capture_seq", "data_uid"])



# --------------------------------------------------------------------------
# extraction
# --------------------------------------------------------------------------

ANCHOR_PATTERN = r'<a href="(.*?)">(.*?)</a>'
LINK_TEMPLATE = "https://links.example/%s?from=%s"


def _anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "html")
    return extract.extract_matches(pages, "html", ANCHOR_PATTERN, {"href": 1, "text": 2})


def q_extracted_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H2 + F3 + B5: anchors as entities with a templated URL."""
    a = _anchors(spark, sf_dir)
    first_seg = F.coalesce(F.get(F.filter(F.split("href", "/"), lambda x: x != F.lit("")), 0),
                           F.lit(""))
    return a.select("page_id", F.col("pos").cast("int").alias("pos"), "href", "text",
                    from_template(LINK_TEMPLATE, first_seg, F.col("page_id").cast("string"))
                    .alias("url"))


def q_json_map_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H3-H5 + H18: JSONP body -> one row per key, typed with try_cast."""
    ev = read_table(spark, sf_dir, "events")
    bodies = ev.select("event_id", F.concat(F.lit("cb("), F.col("props"), F.lit(");")).alias("body"))
    rows = extract.explode_json_map(bodies, "body", StringType())
    return rows.select("event_id", F.col("pos").cast("int").alias("pos"), "key",
                       F.expr("try_cast(value AS INT)").alias("value"))


SEARCH_BUCKET = 100


def search_captures(items: DataFrame, level: str, item: str, site=DEFAULT_SITE) -> DataFrame:
    """Search result pages built from (level, item) rows: pages hold at most
    ``SEARCH_BUCKET`` items (each listed once, bucketed by item key, so no group
    is unbounded) and report the level's total ``Count``."""
    items = items.select(level, item).distinct()
    counts = items.groupBy(level).agg(F.count(F.lit(1)).alias("_count"))
    bucket = F.floor(F.col(item) / F.lit(SEARCH_BUCKET)).cast("long")
    pages = items.withColumn("page", bucket).groupBy(level, "page").agg(
        F.sort_array(F.collect_list(F.col(item))).alias("_ids"))
    pages = pages.join(counts, level)
    body = F.to_json(F.struct(
        F.col("_count").alias("Count"),
        F.transform("_ids", lambda x: F.struct(x.alias("SerialId"))).alias("ResList")))
    return pages.select(level, "page", F.col("page").alias("capture_seq"),
                        from_template(site.level_search, F.col(level).cast("string"),
                                      F.col("page").cast("string"),
                                      F.lit(str(site.page_size))).alias("url"),
                        body.alias("body"))


def q_json_array_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H6: search pages (orders per customer) parsed back to rows."""
    orders = read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    caps = search_captures(orders, "o_custkey", "o_orderkey")
    rows = extract.search_rows(caps)
    return rows.select(F.col("o_custkey").alias("level_id"), "page", "car_third_id",
                       "reported_count")


def q_entity_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B3 + B11 + A9: version lists (JSONP, dynamic keys) -> typed versions."""
    ev = read_table(spark, sf_dir, "events")
    value = F.struct(
        F.col("event_id").alias("id"),
        F.when(F.col("event_type") == "error", F.lit("")).otherwise(F.col("event_type")).alias("name"),
        F.col("user_id").alias("pid"),
        F.round(F.col("value") * 100).cast("long").cast("string").alias("referprice"),
        F.upper("event_type").alias("salestate"),
        F.date_format("ts", "yyyy").alias("goname"),
        F.col("props").alias("tt"))
    body = F.concat(F.lit("x="), F.to_json(F.create_map(
        F.concat(F.lit("e"), F.col("event_id").cast("string")), value)))
    caps = ev.select(F.col("event_id").alias("capture_seq"), body.alias("body"))
    rows = extract.version_rows(caps).filter(extract.non_empty("name"))
    ok, _bad = sinks.split_valid(sinks.conform(rows, VERSION))
    return ok


def q_insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3 + D5 + C7: documents keyed by text digest; the existing table holds
    the English documents; first document per digest by id is added."""
    docs = read_table(spark, sf_dir, "documents")
    src = docs.select(sha1_hex("text").alias("doc_key"), "doc_id", "lang", "source")
    target = src.filter(F.col("lang") == "en").select("doc_key")
    return sinks.insert_if_absent(target, src, ["doc_key"], ["doc_id"])


def q_insert_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4 + G1: (part, supplier) pairs first seen in (order, line) order,
    minus pairs already stored (those of returned lines)."""
    li = read_table(spark, sf_dir, "lineitem")
    src = li.select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber")
    target = li.filter(F.col("l_returnflag") == "R").select("l_partkey", "l_suppkey")
    return sinks.insert_if_absent(target, src, ["l_partkey", "l_suppkey"],
                                  ["l_orderkey", "l_linenumber"])


PART_RULES = [
    ColumnRule("p_partkey", "bigint", nullable=False),
    ColumnRule("p_name", "string", max_len=10),
    ColumnRule("p_brand", "string", nullable=False, max_len=8),
    ColumnRule("p_size", "tinyint", nullable=False),
]


def q_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A8 + A9: rows breaking NOT NULL / length / type rules, with reasons."""
    part = read_table(spark, sf_dir, "part")
    conformed = sinks.conform(part, PART_RULES)
    _ok, bad = sinks.split_valid(conformed)
    return bad.select("p_partkey", "reason")


ROUTES = {"signup": "brand", "view": "car", "click": "version", "purchase": "version_attr"}


def q_routed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed routing; unknown types ('error') are ignored."""
    ev = read_table(spark, sf_dir, "events")
    tagged = sinks.tag_records(ev, "event_type", ROUTES)
    return tagged.groupBy("sink").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.round(F.col("value") * 100).cast("long")).alias("value_cents"))


def q_attached_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A7 + B13: customers as brands; the asset manifest comes from orders
    (ok = status F, position = order key)."""
    cust = read_table(spark, sf_dir, "customer")
    orders = read_table(spark, sf_dir, "orders")
    brands = cust.select(F.col("c_custkey").alias("third_id"), F.col("c_name").alias("name"),
                         from_template(DEFAULT_SITE.brand_logo, F.col("c_custkey").cast("string"))
                         .alias("remote_logo"))
    manifest = orders.select(
        from_template(DEFAULT_SITE.brand_logo, F.col("o_custkey").cast("string")).alias("url"),
        F.col("o_orderkey").alias("pos"), (F.col("o_orderstatus") == "F").alias("ok"),
        F.format_string("full/%s.png", F.col("o_orderkey").cast("string")).alias("path"))
    return sinks.attach_asset(brands, manifest)


# --------------------------------------------------------------------------
# levels: customers as cars, nations and regions as levels
# --------------------------------------------------------------------------

DRIVER_SYNONYMS = {"NATION_7": "AMERICA", "NATION_11": "NATION_12"}


def _cars(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = read_table(spark, sf_dir, "customer")
    en = F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit("  ")).otherwise(F.lower("c_name"))
    return cust.select(F.col("c_custkey").alias("third_id"), en.alias("en_name"))


def _links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search results: orders with status F put their customer in level
    100 + order key mod 3."""
    o = read_table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F")
    return o.select(F.col("o_custkey").alias("car_third_id"),
                    (F.lit(100) + F.col("o_orderkey") % 3).cast("int").alias("level_id"),
                    F.col("o_orderkey").alias("capture_seq"), F.lit(0).alias("pos"))


def _levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = read_table(spark, sf_dir, "region")
    n = read_table(spark, sf_dir, "nation")
    top = r.select((F.col("r_regionkey") + 1).cast("long").alias("id"),
                   (F.col("r_regionkey") + 1).cast("int").alias("level_id"),
                   F.col("r_name").alias("level_name"), F.lit(0).alias("parent_level_id"))
    sub = n.select((F.col("n_nationkey") + 100).cast("long").alias("id"),
                   (F.col("n_nationkey") + 100).cast("int").alias("level_id"),
                   F.col("n_name").alias("level_name"),
                   (F.col("n_regionkey") + 1).cast("int").alias("parent_level_id"))
    return top.unionByName(sub)


def _headlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headline per customer: 'NATION_k第n名'; machinery customers give the
    bare name, furniture customers have no headline node."""
    cust = read_table(spark, sf_dir, "customer")
    nation = read_table(spark, sf_dir, "nation")
    j = cust.join(nation, cust.c_nationkey == nation.n_nationkey)
    text = (F.when(F.col("c_mktsegment") == "FURNITURE", F.lit(None).cast("string"))
             .when(F.col("c_mktsegment") == "MACHINERY", F.col("n_name"))
             .otherwise(F.concat(F.col("n_name"), F.lit("第"),
                                 (F.col("c_custkey") % 9 + 1).cast("string"), F.lit("名"))))
    return j.select(F.col("c_custkey").alias("car_third_id"),
                    F.col("c_custkey").alias("capture_seq"), text.alias("headline"))


def q_unassigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return levels.unassigned(_cars(spark, sf_dir), _links(spark, sf_dir))


def q_level_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = levels.classify(_headlines(spark, sf_dir), _levels(spark, sf_dir),
                          synonyms=DRIVER_SYNONYMS)
    return out.select("car_third_id", F.col("level_id").cast("int").alias("level_id"))


def q_level_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = levels.assign_levels(_links(spark, sf_dir), _cars(spark, sf_dir),
                               _headlines(spark, sf_dir), _levels(spark, sf_dir),
                               synonyms=DRIVER_SYNONYMS)
    return out.select("car_third_id", "level_id", "branch")


def _level_result(spark: SparkSession, sf_dir: str):
    """P3 end to end on pages: search result pages (JSON, orders with status F
    listing their customers under level 100 + order key mod 3) and car pages
    (HTML with the headline in the second dl of the price box) -> search
    parse, anti join, headline rule (J2), synonyms, first level per name,
    parents, union with first write wins."""
    from tidemark.plans import level_assignment
    o = read_table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F")
    items = o.select((F.lit(100) + F.col("o_orderkey") % 3).cast("int").alias("level"),
                     "o_custkey")
    search = search_captures(items, "level", "o_custkey").select(
        (F.col("level").cast("long") * 1000000 + F.col("page")).alias("capture_seq"),
        F.lit("level_search").alias("kind"), "url",
        F.col("level").cast("string").alias("parent_id"), "body")
    heads = _headlines(spark, sf_dir)
    box = F.when(F.col("headline").isNull(),
                 F.lit('<div class="car-price"><dl><dd>price</dd></dl></div>')) \
           .otherwise(F.concat(F.lit('<div class="car-price"><dl><dd>price</dd></dl><dl><dt>level</dt>'
                                     '<dd>'), F.col("headline"), F.lit("</dd></dl></div>")))
    car_seq_base = 1 << 40          # car pages arrive after every search page
    pages = heads.select("car_third_id", box.alias("_box")) \
        .select((F.lit(car_seq_base) + F.col("car_third_id")).alias("capture_seq"),
                F.lit("car_page").alias("kind"),
                F.format_string(DEFAULT_SITE.car_page, F.col("car_third_id").cast("string")).alias("url"),
                F.col("car_third_id").cast("string").alias("parent_id"),
                F.concat(F.lit("<html><body><h1>car</h1>"), F.col("_box"),
                         F.lit("</body></html>")).alias("body"))
    return level_assignment.assign(search.unionByName(pages), _cars(spark, sf_dir),
                                   _levels(spark, sf_dir), synonyms=DRIVER_SYNONYMS)


def q_level_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The links that the run adds."""
    return _level_result(spark, sf_dir).added.select("car_third_id", "level_id", "branch")


def q_level_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 + D2 of P3: count and pages per level; the record total is what the
    levels report plus the rows that the text branch added."""
    res = _level_result(spark, sf_dir)
    return res.totals.select("level_id", "reported_count", "n_pages", res.total.alias("total"))


def q_link_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A8 + H18 for links: a search page per order; urgent ones are cut off, those
    of open orders list a car id, and those of pending ones name a level, that is
    no number.  None of them stops the run."""
    from tidemark.plans import level_assignment
    o = read_table(spark, sf_dir, "orders")
    status, car = F.col("o_orderstatus"), F.col("o_custkey").cast("string")
    listed = F.concat(F.lit('{"Count":1,"ResList":[{"SerialId":"'),
                      F.when(status == "O", F.concat(F.lit("c"), car)).otherwise(car))
    caps = o.select(
        F.col("o_orderkey").alias("capture_seq"), F.lit("level_search").alias("kind"),
        F.lit("?page=1").alias("url"),
        F.when(status == "P", F.col("o_orderpriority")).otherwise(F.lit("7")).alias("parent_id"),
        F.when(F.col("o_orderpriority") == "1-URGENT", listed)
         .otherwise(F.concat(listed, F.lit('"}]}'))).alias("body"))
    # parsed once, as in a run: links and rejects read the rows
    _links, bad = level_assignment.search_links(stored(level_assignment.search_result_rows(caps), "search-rows"))
    return bad.select("target", F.col("capture_seq").cast("long").alias("capture_seq"), "reason")




def q_reported_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 + H9: parts listed per brand on search pages; the first page's
    Count per level, its page count, and the grand total."""
    part = read_table(spark, sf_dir, "part").select("p_brand", "p_partkey")
    rows = extract.search_rows(search_captures(part, "p_brand", "p_partkey"))
    # one row per level, materialised so the grand total (a scalar subquery)
    # reads it instead of recomputing the search-page pipeline
    totals = levels.reported_totals(rows, level="p_brand").checkpoint(eager=True)
    return totals.select(F.col("p_brand").alias("level"), "reported_count", "n_pages",
                         F.lit(levels.grand_total(totals)).alias("total"))


def q_page_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H9 + H10 + B5: search page URLs per part type."""
    part = read_table(spark, sf_dir, "part")
    counts = part.groupBy(F.col("p_type").alias("level")).agg(F.count(F.lit(1)).alias("n"))
    pages = fr.expand_pages(counts, "n", DEFAULT_SITE.page_size)
    return pages.select("level", "page", from_template(
        DEFAULT_SITE.level_search, F.col("level"), F.col("page").cast("string"),
        F.lit(str(DEFAULT_SITE.page_size))).alias("url"))


def _page_requests(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Link children (priority by position in the page) and one spec-page child per
    page (priority 0)."""
    a = _anchors(spark, sf_dir).withColumn("capture_seq", F.col("page_id"))
    links = fr.requests(a, "link", from_template("http://links.example%s", F.col("href")),
                        fr.position_priority(10000), "page_id")
    pages = read_table(spark, sf_dir, "pages").select(
        "page_id", F.col("page_id").alias("capture_seq"), F.lit(0).alias("pos"))
    specs = fr.requests(pages, "spec_page",
                        from_template(DEFAULT_SITE.spec_page, F.col("page_id").cast("string")),
                        F.lit(0), "page_id")
    return [links, specs]


def q_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E3 + G2 + F2: the requests of all pages, ordered."""
    return fr.frontier(_page_requests(spark, sf_dir), ordered=True)


def q_frontier_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the place of every request in the queue."""
    return fr.ranked(fr.frontier(_page_requests(spark, sf_dir)))


def q_allowed_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return pages.filter(host_allowed("url", ["example.com"])).select(
        "page_id", url_host("url").alias("host"))


def q_breadcrumbs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C5 + B6 + B7: captures joined up their lineage (user -> customer ->
    nation -> region); breadcrumb and audit label with the change mark."""
    st = change.change_status(_fingerprinted_events(spark, sf_dir))
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    # the capture carries its lineage (parent = user); no self-join back to events
    j = (st.withColumnRenamed("capture_seq", "event_id")
           .join(cust, F.col("parent_id").cast("long") == F.col("c_custkey"))
           .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
           .join(region, F.col("n_regionkey") == F.col("r_regionkey")))
    crumb = lineage.breadcrumb("r_name", "n_name", "c_name")
    return j.select("event_id", crumb.alias("breadcrumb"),
                    lineage.audit_label("kind", crumb).alias("label"))


# --------------------------------------------------------------------------
# specification documents: orders as spec pages
# --------------------------------------------------------------------------

def _spec_source_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label rows per order, in page order, as the tokeniser would emit them
    (labels still end with their colon).  Status P orders list only an
    unknown label and an empty one, so their document is '{}'."""
    o = read_table(spark, sf_dir, "orders").repartition("o_orderkey")
    empty = F.array().cast("array<string>")
    no_col = F.array().cast("array<struct<title:string,style:string>>")

    def row(label, info=None, alt=None, colours=None):
        return F.struct(F.lit(label).alias("label"),
                        (info if info is not None else empty).alias("info"),
                        (alt if alt is not None else empty).alias("alt"),
                        (colours if colours is not None else no_col).alias("colours"))

    status = F.col("o_orderstatus")
    mark = F.when(status == "F", F.lit("●")).otherwise(F.lit("-"))
    colour = F.array(
        F.struct(F.lit("白").alias("title"),
                 F.format_string("background:#%06X", (F.col("o_custkey") * 7919) % 16777216)
                 .alias("style")),
        F.struct(F.lit("黑").alias("title"),
                 F.format_string("background:#%06X;", (F.col("o_orderkey") * 104729) % 16777216)
                 .alias("style")))
    full = F.array(
        row("长：", F.array(F.floor("o_totalprice").cast("string"))),
        row("定速巡航：", F.array(mark)),
        row("中控彩色液晶屏：", F.when(status == "O", F.array(F.lit("●"))).otherwise(empty),
            F.array(F.col("o_orderpriority"))),
        row("供油方式：", None, F.split(F.col("o_orderpriority"), "-")),
        row("车身颜色：", None, None, colour),
        row("未知：", F.array(F.lit("x"))),
        row("长：", F.when(F.col("o_orderkey") % 2 == 0,
                           F.array(F.col("o_custkey").cast("string"))).otherwise(empty),
            F.array(F.lit("n/a"))),
        row("\tLED日间行车灯：", F.array(F.lit("●"), F.lit("x"))),
    )
    only_unknown = F.array(row("未知：", F.array(F.lit("x"))), row("：", F.array(F.lit("y"))))
    rows = F.when(status == "P", only_unknown).otherwise(full)
    return o.select(F.col("o_orderkey").alias("page_id"), F.posexplode(rows).alias("pos", "r")) \
            .select("page_id", F.col("pos").cast("int").alias("pos"), "r.label", "r.info",
                    "r.alt", "r.colours")


def q_spec_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    vals = spec.spec_values(_spec_source_rows(spark, sf_dir), spec_dictionary(spark))
    return vals.select("page_id", "pos", "grp", "item", "value", "is_flag")


def q_spec_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    vals = spec.spec_values(_spec_source_rows(spark, sf_dir), spec_dictionary(spark))
    pages = read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("page_id"))
    return spec.assemble_documents(vals, pages)


def q_colour_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H12 + D4: per page, anchors as (title = text, style = href) entries."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "html")
    m = F.transform(
        regex_matches("html", ANCHOR_PATTERN, {"style": 1, "title": 2}),
        lambda x: F.struct(x["title"].alias("title"), x["style"].alias("style")))
    return pages.select("page_id", spec.colour_list(m).alias("colours"))


# --------------------------------------------------------------------------
# the catalogue's own extraction paths on bodies derived from driver tables
# --------------------------------------------------------------------------

def q_catalogue_brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 brands: one seed script per region listing its nations as brand
    records -> regex extraction (B1, H2) -> conform -> first write wins."""
    from tidemark.plans import catalogue
    n = read_table(spark, sf_dir, "nation")
    record = F.format_string('{type:"mb",id:%s,name:"%s",url:"/n/",cur:0}',
                             F.col("n_nationkey").cast("string"), F.col("n_name"))
    # a seed script lists the rows of the (fixed, small) nation dimension
    seeds = n.groupBy("n_regionkey").agg(
        F.sort_array(F.collect_list(F.struct("n_nationkey", record.alias("r")))).alias("_r"))
    caps = seeds.select(F.col("n_regionkey").cast("long").alias("capture_seq"),
                        F.lit("seed").alias("kind"),
                        F.concat(F.lit("var tree=["),
                                 F.array_join(F.transform("_r", lambda x: x["r"]), ","),
                                 F.lit("];")).alias("body"))
    out = catalogue.brands(caps)
    return out.added.select("third_id", "name", "remote_logo", "logo", "capture_seq", "pos")


def _car_list_pages(c: DataFrame, goid) -> DataFrame:
    """(c_nationkey, _block, body): a JSONP list with dynamic keys per nation and block of
    100 customer keys, so no page is unbounded."""
    value = F.struct(
        F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"),
        F.concat_ws(" ", "c_name", "c_mktsegment").alias("showName"),
        F.lower(F.regexp_replace("c_name", "#", "")).alias("urlSpell"),
        F.col("c_nationkey").cast("string").alias("pid"),
        goid.alias("goid"),
        F.col("c_mktsegment").alias("goname"), F.lit("0").alias("csSale"))
    block = F.floor(F.col("c_custkey") / F.lit(100)).cast("long")
    pages = c.withColumn("_block", block).groupBy("c_nationkey", "_block").agg(
        F.sort_array(F.collect_list(F.struct(
            "c_custkey", F.concat(F.lit("s"), F.col("c_custkey").cast("string")).alias("k"),
            value.alias("v")))).alias("_e"))
    entries = F.transform("_e", lambda x: F.struct(x["k"].alias("key"), x["v"].alias("value")))
    body = F.concat(F.lit('requestDatalist["x"]='), F.to_json(F.map_from_entries(entries)), F.lit(";"))
    return pages.select("c_nationkey", "_block", body.alias("body"))


def car_list_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brand car lists built from customers."""
    pages = _car_list_pages(read_table(spark, sf_dir, "customer"), (F.col("c_nationkey") * 10).cast("string"))
    return pages.select(
        (F.col("c_nationkey").cast("long") * 1000000 + F.col("_block")).alias("capture_seq"),
        F.lit("car_list").alias("kind"), F.col("c_nationkey").cast("string").alias("parent_id"), "body")


def q_catalogue_cars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 cars: JSONP lists -> dict-semantics explode (H3-H5) -> renames
    (B2) -> conform (A9) -> first write wins (A3)."""
    from tidemark.plans import catalogue
    out = catalogue.cars(car_list_captures(spark, sf_dir))
    return out.added


def _spec_page_html(o: DataFrame) -> DataFrame:
    """A spec sheet page per order, with the same label rows as
    ``_spec_source_rows`` (title spans end with a colon)."""
    def info(*vals):
        return F.concat(*[F.concat(F.lit('<span class="info">'), v, F.lit("</span>")) for v in vals])

    def alt(v):
        return F.concat(F.lit('<div class="l">'), v, F.lit("</div>"))

    def row(label, cell):
        return F.concat(F.lit(f'<tr><td><span class="title">{label}</span></td><td>'), cell,
                        F.lit("</td></tr>\n"))

    status = F.col("o_orderstatus")
    mark = F.when(status == "F", F.lit("●")).otherwise(F.lit("-"))
    colours = F.concat(
        F.lit('<div class="focus-color-warp"><ul><li><a title="白"><span style="'),
        F.format_string("background:#%06X", (F.col("o_custkey") * 7919) % 16777216),
        F.lit('"></span></a></li><li><a title="黑"><span style="'),
        F.format_string("background:#%06X;", (F.col("o_orderkey") * 104729) % 16777216),
        F.lit('"></span></a></li></ul></div>'))
    prio_parts = F.array_join(F.transform(F.split("o_orderpriority", "-"), alt), "")
    full = F.concat(
        row("长：", info(F.floor("o_totalprice").cast("string"))),
        row("定速巡航：", info(mark)),
        row("中控彩色液晶屏：", F.concat(
            F.when(status == "O", info(F.lit("●"))).otherwise(F.lit("")),
            alt(F.col("o_orderpriority")))),
        row("供油方式：", prio_parts),
        row("车身颜色：", colours),
        row("未知：", info(F.lit("x"))),
        row("长：", F.concat(
            F.when(F.col("o_orderkey") % 2 == 0, info(F.col("o_custkey").cast("string")))
             .otherwise(F.lit("")), alt(F.lit("n/a")))),
        row("\tLED日间行车灯：", info(F.lit("●"), F.lit("x"))))
    only_unknown = F.concat(row("未知：", info(F.lit("x"))), row("：", info(F.lit("y"))))
    rows = F.when(status == "P", only_unknown).otherwise(full)
    html = F.concat(F.lit('<html><body><div class="box config-section"><div class="special-layout-18">'
                          '<table>\n'), rows, F.lit("</table></div></div></body></html>"))
    return o.select(F.col("o_orderkey").alias("capture_seq"), F.lit("spec_page").alias("kind"),
                    F.col("o_orderkey").cast("string").alias("parent_id"), html.alias("body"))


def q_spec_sheet_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P2 end to end: spec sheet HTML -> tokeniser rule (J1) -> dictionary
    (C4) -> normalised values (H11-H13, H17) -> documents (D3, H15)."""
    from tidemark.plans import spec_documents
    # dealt by key before the pages are made: the table may be one split
    caps = _spec_page_html(read_table(spark, sf_dir, "orders").repartition(
        spark.sparkContext.defaultParallelism, "o_orderkey"))
    return spec_documents.documents(caps, spec_dictionary(spark))


def q_refresh_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P4 composite: fingerprints (checkpointed), change window, decision
    table, gate and log delta, on the event captures."""
    from tidemark.plans import refresh as rf
    res = rf.refresh(event_captures(spark, sf_dir))
    return res.log_delta.select(F.col("capture_seq").alias("event_id"), "page_uid", "data_uid")


def q_fetch_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5 composite: children of the brand scripts (car lists, priority
    10000 - n per script) and of the car lists (version lists, 9000 - n per
    list page), templated, host-checked and in frontier order."""
    from tidemark.plans import fetch_plan
    n = read_table(spark, sf_dir, "nation")
    record = F.format_string('{type:"mb",id:%s,name:"%s",url:"/n/",cur:0}',
                             F.col("n_nationkey").cast("string"), F.col("n_name"))
    seeds = n.groupBy("n_regionkey").agg(
        F.sort_array(F.collect_list(F.struct("n_nationkey", record.alias("r")))).alias("_r"))
    seed_caps = seeds.select(F.col("n_regionkey").cast("long").alias("capture_seq"),
                             F.concat(F.lit("var tree=["),
                                      F.array_join(F.transform("_r", lambda x: x["r"]), ","),
                                      F.lit("];")).alias("body"))
    brands = extract.brand_rows(seed_caps)
    cars = extract.car_rows(car_list_captures(spark, sf_dir))
    return fetch_plan.next_requests(brands=brands, cars=cars, ordered=True)


def q_catalogue_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 versions into a target that holds rows: a version list per event names its
    user as the version, so a version comes many times; those of BUILDING
    customers are stored already."""
    from tidemark.plans import catalogue
    ev = read_table(spark, sf_dir, "events")
    value = F.struct(
        F.col("user_id").alias("id"), F.col("event_type").alias("name"), F.col("event_id").alias("pid"),
        F.round(F.col("value") * 100).cast("long").cast("string").alias("referprice"),
        F.upper("event_type").alias("salestate"), F.date_format("ts", "yyyy").alias("goname"),
        F.lit("t").alias("tt"))
    caps = ev.select(
        F.col("event_id").alias("capture_seq"), F.lit("version_list").alias("kind"),
        F.col("event_id").cast("string").alias("parent_id"),
        F.concat(F.lit("x="), F.to_json(F.create_map(F.lit("n"), value))).alias("body"))
    stored = read_table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    out = catalogue.versions(caps, target=stored.select(F.col("c_custkey").cast("int").alias("third_id")))
    return out.added.select("car_third_id", "third_id", "name",
                            F.col("refer_price").cast("long").alias("refer_price"), "year_type",
                            "sale_state", "capture_seq")


def q_version_attr_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P2 store: each order's document belongs to the version that its customer
    stands for; the first document of a version counts, unless one is stored."""
    from tidemark.plans import spec_documents
    o = read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("page_id"), F.col("o_custkey").cast("string").alias("car_version_third_id"))
    docs = q_spec_documents(spark, sf_dir).join(o, "page_id").withColumnRenamed("page_id", "capture_seq")
    stored = read_table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    added, _bad = spec_documents.store(
        docs, stored.select(F.col("c_custkey").cast("int").alias("car_version_third_id")))
    return added.select("car_version_third_id", "content", "capture_seq")


def q_fetch_plan_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5, the branches beside ``fetch_plan``: the seed and the first search page of
    every level, further search pages, spec pages, and pages of cars without a level."""
    from tidemark.plans import fetch_plan
    ev = read_table(spark, sf_dir, "events").filter(F.col("event_type") != "error")
    versions = ev.select(F.col("event_id").alias("third_id"), F.col("event_id").alias("capture_seq"),
                         F.lit(0).alias("pos"))
    totals = read_table(spark, sf_dir, "customer").groupBy(
        (F.col("c_nationkey") + 100).alias("level_id")).agg(F.count(F.lit(1)).alias("reported_count"))
    start = fetch_plan.start_requests(spark, _levels(spark, sf_dir))
    return start.unionByName(fetch_plan.next_requests(
        versions=versions, search_totals=totals, ordered=False,
        unassigned_cars=levels.unassigned(_cars(spark, sf_dir), _links(spark, sf_dir))))


STREAM_PARTS = 3


def q_stream_log_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I1 + I3: captures land in three increments (by id range); after each
    the refresh stream runs with ``availableNow`` on the same checkpoint.
    The accumulated log equals the batch log delta."""
    from tidemark.session import shared_path
    from tidemark.sources.captures import read_captures
    from tidemark.streaming.refresh import RefreshSink, start_refresh_stream

    root = shared_path(spark, "stream-log-delta")
    inbox, sink = f"{root}/inbox", RefreshSink(f"{root}/out")
    caps = event_captures(spark, sf_dir)
    lo, hi = caps.agg(F.min("capture_seq"), F.max("capture_seq")).first()
    if lo is not None:
        step = (hi - lo) // STREAM_PARTS + 1
        for i in range(STREAM_PARTS):
            part = caps.filter((F.col("capture_seq") >= lo + i * step) &
                               (F.col("capture_seq") < lo + (i + 1) * step))
            part.write.mode("append").parquet(inbox)
            q = start_refresh_stream(read_captures(spark, inbox, stream=True), sink,
                                     f"{root}/checkpoint")
            q.awaitTermination()
    if lo is None:                      # no captures: an empty log
        return spark.createDataFrame([], "event_id long, page_uid string, data_uid string")
    log = spark.read.parquet(sink.log)
    return log.select(F.col("capture_seq").alias("event_id"), "page_uid", "data_uid")


LATE_ORDER = (1, 2, 0)


def q_late_capture_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I1 + C6 with late captures: the three parts of the id range arrive middle
    first, then last, then first.  A capture is compared with what arrived before
    it, so the log follows (batch, id) order."""
    from tidemark.session import shared_path
    from tidemark.streaming.refresh import RefreshSink, refresh_batch

    sink = RefreshSink(shared_path(spark, "late-capture-log"))
    caps = event_captures(spark, sf_dir)
    lo, hi = caps.agg(F.min("capture_seq"), F.max("capture_seq")).first()
    if lo is None:                      # no captures: an empty log
        return spark.createDataFrame([], "batch_id int, event_id long, page_uid string, data_uid string")
    step = (hi - lo) // len(LATE_ORDER) + 1
    for batch_id, i in enumerate(LATE_ORDER):
        part = caps.filter((F.col("capture_seq") >= lo + i * step) &
                           (F.col("capture_seq") < lo + (i + 1) * step))
        refresh_batch(part, batch_id, sink)
    return spark.read.parquet(sink.log).select(
        "batch_id", F.col("capture_seq").alias("event_id"), "page_uid", "data_uid")


def q_state_store_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I1, state-store form, with late captures: the middle third of the ids is an earlier
    run, whose compacted log is the initial state; the last third and then the first arrive
    as a stream.  The log of all three follows arrival."""
    from tidemark.session import shared_path
    from tidemark.streaming.refresh import STATE_STORE_CONF, stateful_changes

    log = ["capture_seq", "page_uid", "data_uid"]
    caps = _fingerprinted_events(spark, sf_dir).select(*log)
    lo, hi = caps.agg(F.min("capture_seq"), F.max("capture_seq")).first()
    if lo is None:                      # no captures: an empty log
        return spark.createDataFrame([], "event_id long, page_uid string, data_uid string")
    step = (hi - lo) // len(LATE_ORDER) + 1
    early, *rest = [caps.filter((F.col("capture_seq") >= lo + i * step) & (F.col("capture_seq") < lo + (i + 1) * step))
                    for i in LATE_ORDER]
    first = stored(change.log_delta(change.change_status(early), keep=log), "first-log")
    state = stored(change.compact_state(first), "compacted-log")
    for k, v in STATE_STORE_CONF.items():
        spark.conf.set(k, v)
    root = shared_path(spark, "state-store-log")
    for part in rest:
        part.write.mode("append").parquet(f"{root}/inbox")
        arriving = spark.readStream.schema(caps.schema).parquet(f"{root}/inbox")
        (stateful_changes(arriving, state).writeStream.format("parquet")
         .option("checkpointLocation", f"{root}/checkpoint").option("path", f"{root}/out")
         .trigger(availableNow=True).start().awaitTermination())
    streamed = change.log_delta(spark.read.parquet(f"{root}/out"), keep=log)
    return first.unionByName(streamed).withColumnRenamed("capture_seq", "event_id")


# --------------------------------------------------------------------------
# runs that follow each other on stored targets
# --------------------------------------------------------------------------

DOCUMENT_SPEC = TargetSpec("document", (
    ColumnRule("doc_key", "string"), ColumnRule("doc_id", "bigint"),
    ColumnRule("lang", "string"), ColumnRule("source", "string")), keys=("doc_key",))


def q_bucketed_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3 + C7 + H19 on a bucketed target: run 1 stores the English documents by text digest,
    run 2 brings all of them and reads back the buckets of its keys."""
    from tidemark.session import shared_path
    from tidemark.sources.bucketed import BucketedTarget
    docs = read_table(spark, sf_dir, "documents")
    src = stored(docs.select(sha1_hex("text").alias("doc_key"), "doc_id", "lang", "source"), "document-keys")
    path = shared_path(spark, "bucketed-target")
    for run_id, rows in ((1, src.filter(F.col("lang") == "en")), (2, src)):
        target = BucketedTarget(spark, path, DOCUMENT_SPEC, run_id, buckets=32)
        target.append(sinks.with_audit_columns(sinks.insert_if_absent(target, rows, ["doc_key"], ["doc_id"])))
    return BucketedTarget(spark, path, DOCUMENT_SPEC, 3, buckets=32).upto(2).select(
        F.col("run_id").cast("int").alias("run_id"), "doc_key", "doc_id", "lang", "source",
        F.col("created_time").isNotNull().alias("created"), F.col("updated_time").isNull().alias("never_updated"))


def q_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1-P5 gated end to end, twice: car lists without the BUILDING customers, then with
    them.  Cars with a debt bear a factory id that is no number.  What the targets, the change log and
    the quarantine hold in the end, by run."""
    from tidemark.plans.crawl_run import RunPaths, run_batch
    from tidemark.schemas import CAR
    from tidemark.session import shared_path
    from tidemark.sources.bucketed import BucketedTarget
    paths = RunPaths(shared_path(spark, "two-runs"))
    c = read_table(spark, sf_dir, "customer")
    goid = F.when(F.col("c_acctbal") < 0, F.lit("n/a")).otherwise((F.col("c_nationkey") * 10).cast("string"))
    for run_id, listed in ((1, c.filter(F.col("c_mktsegment") != "BUILDING")), (2, c)):
        caps = _car_list_pages(listed, goid).select(
            (F.lit(run_id * 10 ** 12) + F.col("c_nationkey").cast("long") * 1000000 + F.col("_block")).alias("capture_seq"),
            F.lit("car_list").alias("kind"),
            F.concat(from_template(DEFAULT_SITE.car_list, F.col("c_nationkey").cast("string")), F.lit("?block="),
                     F.col("_block").cast("string")).alias("url"),
            F.col("c_nationkey").cast("string").alias("parent_id"), "body")
        run_batch(spark, stored(caps, "captures"), paths.root, run_id, run_id - 1 or None,
                  key_buckets=8, state_buckets=8)

    def held(df: DataFrame, target, item, detail) -> DataFrame:
        return df.select(F.col("run_id").cast("int").alias("run_id"), target.alias("target"),
                         item.cast("string").alias("item"), detail.cast("string").alias("detail"))

    cars = BucketedTarget(spark, paths.table("car"), CAR, 3).upto(2)
    log = spark.read.parquet(paths.table("change_log"))
    bad = spark.read.parquet(paths.table("quarantine"))
    return held(cars, F.lit("car"), F.col("third_id"), F.col("name")) \
        .unionByName(held(log, F.lit("change_log"), F.col("page_url"), F.lit(None))) \
        .unionByName(held(bad, F.concat(F.lit("quarantine/"), F.col("target")), F.col("capture_seq"), F.col("reason")))


# --------------------------------------------------------------------------
# scans and items beside the main path
# --------------------------------------------------------------------------

def q_level_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: levels from a stored table whose ids are text and whose top levels name no parent."""
    from tidemark.session import shared_path
    from tidemark.sources.dimensions import level_dimension
    path = shared_path(spark, "levels")
    _levels(spark, sf_dir).select(
        F.col("id").cast("string").alias("id"), F.col("level_id").cast("string").alias("level_id"), "level_name",
        F.when(F.col("parent_level_id") != 0, F.col("parent_level_id")).cast("string").alias("parent_level_id"),
        F.lit("x").alias("unread")).write.parquet(path)
    return level_dimension(spark, path)


def q_asset_pass_through(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Household customers ask for no logo and pass; of the others those whose
    asset was stored."""
    cust = read_table(spark, sf_dir, "customer")
    logo = from_template(DEFAULT_SITE.brand_logo, F.col("c_custkey").cast("string"))
    brands = cust.select(F.col("c_custkey").alias("third_id"),
                         F.when(F.col("c_mktsegment") != "HOUSEHOLD", logo).alias("remote_logo"))
    manifest = read_table(spark, sf_dir, "orders").select(
        from_template(DEFAULT_SITE.brand_logo, F.col("o_custkey").cast("string")).alias("url"),
        F.col("o_orderkey").alias("pos"), (F.col("o_orderstatus") == "F").alias("ok"),
        F.format_string("full/%s.png", F.col("o_orderkey").cast("string")).alias("path"))
    return sinks.attach_asset(brands, manifest)


def q_utf8_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies that landed as bytes, decoded."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", F.encode("text", "UTF-8").alias("body"))
    text = utf8_text("body")
    return docs.select("doc_id", F.char_length(text).cast("long").alias("n_chars"), F.md5(text).alias("digest"))


H1_PATH = [markup.Step("h1")]


def q_headline_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", F.col("html").alias("body"))
    return markup.headline_text(pages, H1_PATH)


def q_spec_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", F.col("html").alias("body"))
    return markup.link_table(pages)


QUERIES = {
    "fingerprints": q_fingerprints,
    "capture_status": q_capture_status,
    "log_delta": q_log_delta,
    "resumed_log_delta": q_resumed_log_delta,
    "fetch_decision": q_fetch_decision,
    "latest_fingerprint": q_latest_fingerprint,
    "extracted_entities": q_extracted_entities,
    "json_map_rows": q_json_map_rows,
    "json_array_rows": q_json_array_rows,
    "entity_projection": q_entity_projection,
    "insert_if_absent": q_insert_if_absent,
    "insert_pairs": q_insert_pairs,
    "quarantine": q_quarantine,
    "routed_counts": q_routed_counts,
    "attached_assets": q_attached_assets,
    "unassigned": q_unassigned,
    "level_assignment": q_level_assignment,
    "level_union": q_level_union,
    "reported_total": q_reported_total,
    "page_plan": q_page_plan,
    "frontier": q_frontier,
    "allowed_hosts": q_allowed_hosts,
    "breadcrumbs": q_breadcrumbs,
    "spec_values": q_spec_values,
    "spec_documents": q_spec_documents,
    "colour_lists": q_colour_lists,
    "headline_text": q_headline_text,
    "spec_rows": q_spec_rows,
    "stream_log_delta": q_stream_log_delta,
    "late_capture_log": q_late_capture_log,
    "level_pages": q_level_pages,
    "refresh_log": q_refresh_log,
    "fetch_plan": q_fetch_plan,
    "fetch_plan_full": q_fetch_plan_full,
    "catalogue_versions": q_catalogue_versions,
    "version_attr_store": q_version_attr_store,
    "link_quarantine": q_link_quarantine,
    "level_totals": q_level_totals,
    "catalogue_brands": q_catalogue_brands,
    "catalogue_cars": q_catalogue_cars,
    "spec_sheet_documents": q_spec_sheet_documents,
    "frontier_rank": q_frontier_rank,
    "state_store_log": q_state_store_log,
    "bucketed_target": q_bucketed_target,
    "two_runs": q_two_runs,
    "level_dimension": q_level_dimension,
    "asset_pass_through": q_asset_pass_through,
    "utf8_bodies": q_utf8_bodies,
}
