"""DuckDB SQL equal to each registered query (same column names)."""

from tidemark.data.spec_labels import SPEC_LABELS


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _decode(x: str) -> str:
    """HTML entity decoding for the entities present in the pages."""
    for ent, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
                    ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
        x = f"replace({x}, {_q(ent)}, {_q(ch)})"
    return x


_DICT = "(VALUES " + ", ".join(
    f"({_q(k.split('.', 1)[0])}, {_q(k.split('.', 1)[1])}, {_q(v)})" for k, v in SPEC_LABELS
) + ") AS d(grp, item, label)"

_ANCHOR = "'<a href=\"(.*?)\">(.*?)</a>'"

_ANCHORS = f"""
    SELECT page_id, h, t, i FROM (
      SELECT page_id,
             unnest(regexp_extract_all(html, {_ANCHOR}, 1)) AS h,
             unnest(regexp_extract_all(html, {_ANCHOR}, 2)) AS t,
             unnest(range(1, len(regexp_extract_all(html, {_ANCHOR}, 1)) + 1)) AS i
      FROM pages)
"""

_LEVELS = """
    lv AS (SELECT r_regionkey + 1 AS id, r_regionkey + 1 AS level_id, r_name AS level_name,
                  0 AS parent FROM region
           UNION ALL
           SELECT n_nationkey + 100, n_nationkey + 100, n_name, n_regionkey + 1 FROM nation),
    firstlv AS (SELECT level_name, arg_min(level_id, id) AS level_id, arg_min(parent, id) AS parent
                FROM lv GROUP BY level_name),
    heads AS (SELECT c_custkey,
                     CASE WHEN c_mktsegment = 'FURNITURE' THEN NULL
                          WHEN c_mktsegment = 'MACHINERY' THEN n_name
                          ELSE n_name || '第' || CAST(c_custkey % 9 + 1 AS VARCHAR) || '名' END AS headline
              FROM customer JOIN nation ON c_nationkey = n_nationkey),
    names AS (SELECT c_custkey, split_part(headline, '第', 1) AS raw FROM heads
              WHERE headline IS NOT NULL AND headline <> ''),
    names2 AS (SELECT c_custkey, CASE raw WHEN 'NATION_7' THEN 'AMERICA'
                                         WHEN 'NATION_11' THEN 'NATION_12' ELSE raw END AS level_name
               FROM names),
    matched AS (SELECT c_custkey, level_id, parent FROM names2 JOIN firstlv USING (level_name))
"""

_SPEC_SRC = """
    src AS (
      SELECT o_orderkey AS page_id, 0 AS pos, '长' AS label,
             CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) AS text
        FROM orders WHERE o_orderstatus <> 'P'
      UNION ALL SELECT o_orderkey, 1, '定速巡航',
             CASE WHEN o_orderstatus = 'F' THEN '●' ELSE '-' END FROM orders WHERE o_orderstatus <> 'P'
      UNION ALL SELECT o_orderkey, 2, '中控彩色液晶屏',
             CASE WHEN o_orderstatus = 'O' THEN '●' ELSE o_orderpriority END
        FROM orders WHERE o_orderstatus <> 'P'
      UNION ALL SELECT o_orderkey, 3, '供油方式', replace(o_orderpriority, '-', ',')
        FROM orders WHERE o_orderstatus <> 'P'
      UNION ALL SELECT o_orderkey, 4, '车身颜色',
             '白:' || right(printf('background:#%06X', (o_custkey * 7919) % 16777216), 7) ||
             ',黑:' || right(printf('background:#%06X;', (o_orderkey * 104729) % 16777216), 7)
        FROM orders WHERE o_orderstatus <> 'P'
      UNION ALL SELECT o_orderkey, 6, '长',
             CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_custkey AS VARCHAR) ELSE 'n/a' END
        FROM orders WHERE o_orderstatus <> 'P'
      UNION ALL SELECT o_orderkey, 7, chr(9) || 'LED日间行车灯', '●,x'
        FROM orders WHERE o_orderstatus <> 'P'),
    normalised AS (SELECT page_id, pos, label,
                          CASE WHEN text = '●' THEN NULL WHEN text = '-' THEN '' ELSE text END AS value,
                          coalesce(text = '●', false) AS is_flag FROM src),
    joined AS (SELECT page_id, CAST(pos AS INTEGER) AS pos, grp, item, value, is_flag
               FROM normalised JOIN """ + _DICT + """ USING (label))
"""

_EVENT_CAPTURES = """
    SELECT event_id,
           ['seed','car_list','version_list','spec_page'][user_id % 4 + 1] AS kind,
           sha1('user/' || CAST(user_id AS VARCHAR)) AS page_uid,
           sha1(event_type) AS data_uid,
           user_id
    FROM events
"""

_STATUS = f"""
    SELECT *, CASE WHEN prev IS NULL THEN 'new'
                   WHEN prev = data_uid THEN 'unchanged' ELSE 'changed' END AS status
    FROM (SELECT *, lag(data_uid) OVER (PARTITION BY page_uid ORDER BY event_id) AS prev
          FROM ({_EVENT_CAPTURES}))
"""

# spelled out here, so that a wrong template in the code shows
_TPL_SEED = "https://api.catalogue.example/brands"
_TPL_LOGO = "https://static.catalogue.example/logos/%s.png"
_TPL_SEARCH = "https://api.catalogue.example/levels/%s/cars?page=%s&size=%s"
_TPL_SPEC = "https://www.catalogue.example/versions/%s/specification"
_TPL_CAR = "https://www.catalogue.example/cars/%s"
_TPL_CARS = "https://api.catalogue.example/brands/%s/cars"
_TPL_VERSIONS = "https://api.catalogue.example/cars/%s/versions"

ORACLE_SQL = {
    "fingerprints": "SELECT page_id, sha1(url) AS page_uid, sha1(html) AS data_uid FROM pages",
    "capture_status": f"SELECT event_id, page_uid, data_uid, status FROM ({_STATUS})",
    "log_delta": f"SELECT event_id, page_uid, data_uid FROM ({_STATUS}) WHERE status <> 'unchanged'",
    "late_capture_log": f"""
        WITH r AS (SELECT min(event_id) AS lo, (max(event_id) - min(event_id)) // 3 + 1 AS step FROM events),
             c AS (SELECT e.*, CASE (event_id - lo) // step WHEN 1 THEN 0 WHEN 2 THEN 1 ELSE 2 END AS batch_id
                   FROM ({_EVENT_CAPTURES}) e, r),
             s AS (SELECT *, lag(data_uid) OVER (PARTITION BY page_uid ORDER BY batch_id, event_id) AS prev
                   FROM c)
        SELECT CAST(batch_id AS INTEGER) AS batch_id, event_id, page_uid, data_uid
        FROM s WHERE prev IS NULL OR prev <> data_uid""",
    "resumed_log_delta": f"""
        SELECT event_id, page_uid, data_uid FROM ({_STATUS}) WHERE status <> 'unchanged'""",
    "fetch_decision": f"""
        SELECT event_id, kind, status,
               CASE WHEN status <> 'unchanged' THEN 'emit'
                    WHEN kind IN ('seed','car_list','version_list') THEN 'flag'
                    ELSE 'drop' END AS decision,
               status <> 'unchanged' AS emit_items,
               CASE WHEN kind = 'spec_page' THEN false
                    WHEN status <> 'unchanged' THEN true
                    ELSE kind IN ('seed','car_list') END AS follow_children
        FROM ({_STATUS})""",
    "latest_fingerprint": f"""
        SELECT page_uid, max(event_id) AS capture_seq, arg_max(data_uid, event_id) AS data_uid
        FROM ({_EVENT_CAPTURES}) GROUP BY page_uid""",
    "stream_log_delta": f"SELECT event_id, page_uid, data_uid FROM ({_STATUS}) WHERE status <> 'unchanged'",
    "extracted_entities": f"""
        SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, h AS href, t AS text,
               printf('https://links.example/%s?from=%s',
                      coalesce(list_filter(string_split(h, '/'), lambda x: x <> '')[1], ''),
                      CAST(page_id AS VARCHAR)) AS url
        FROM ({_ANCHORS})""",
    "json_map_rows": """
        SELECT event_id, CAST(i - 1 AS INTEGER) AS pos, k AS key,
               TRY_CAST(json_extract_string(props, '$."' || k || '"') AS INTEGER) AS value
        FROM (SELECT event_id, props, unnest(json_keys(props)) AS k,
                     unnest(range(1, len(json_keys(props)) + 1)) AS i FROM events)""",
    "json_array_rows": """
        SELECT o_custkey AS level_id, CAST(floor(o_orderkey / 100) AS BIGINT) AS page,
               CAST(o_orderkey AS INTEGER) AS car_third_id,
               CAST(count(*) OVER (PARTITION BY o_custkey) AS INTEGER) AS reported_count
        FROM orders""",
    "entity_projection": """
        SELECT CAST(user_id AS INTEGER) AS car_third_id, CAST(event_id AS INTEGER) AS third_id,
               event_type AS name, CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) AS refer_price,
               strftime(ts, '%Y') AS year_type, upper(event_type) AS sale_state, props AS tt
        FROM events WHERE event_type <> 'error'""",
    "insert_if_absent": """
        WITH s AS (SELECT sha1(text) AS doc_key, doc_id, lang, source FROM documents),
             f AS (SELECT *, row_number() OVER (PARTITION BY doc_key ORDER BY doc_id, lang, source) AS rn
                   FROM s)
        SELECT doc_key, doc_id, lang, source FROM f
        WHERE (rn = 1 OR doc_key IS NULL)
          AND NOT EXISTS (SELECT 1 FROM s t WHERE t.lang = 'en' AND t.doc_key = f.doc_key)""",
    "insert_pairs": """
        WITH f AS (SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber,
                          row_number() OVER (PARTITION BY l_partkey, l_suppkey
                                             ORDER BY l_orderkey, l_linenumber) AS rn
                   FROM lineitem)
        SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber FROM f
        WHERE (rn = 1 OR l_partkey IS NULL OR l_suppkey IS NULL)
          AND NOT EXISTS (SELECT 1 FROM lineitem r WHERE r.l_returnflag = 'R'
                          AND r.l_partkey = f.l_partkey AND r.l_suppkey = f.l_suppkey)""",
    "quarantine": """
        SELECT p_partkey, reason FROM (
          SELECT p_partkey, concat_ws(',',
              CASE WHEN p_partkey IS NULL THEN 'null:p_partkey' END,
              CASE WHEN length(p_name) > 10 THEN 'length:p_name' END,
              CASE WHEN p_brand IS NULL THEN 'null:p_brand' END,
              CASE WHEN length(p_brand) > 8 THEN 'length:p_brand' END,
              CASE WHEN p_size IS NOT NULL AND TRY_CAST(p_size AS TINYINT) IS NULL THEN 'type:p_size' END,
              CASE WHEN p_size IS NULL THEN 'null:p_size' END) AS reason
          FROM part) WHERE reason <> ''""",
    "routed_counts": """
        SELECT CASE event_type WHEN 'signup' THEN 'brand' WHEN 'view' THEN 'car'
                               WHEN 'click' THEN 'version' WHEN 'purchase' THEN 'version_attr' END AS sink,
               count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS value_cents
        FROM events WHERE event_type IN ('signup', 'view', 'click', 'purchase') GROUP BY 1""",
    "attached_assets": f"""
        WITH m AS (SELECT o_custkey,
                          arg_min(printf('full/%s.png', CAST(o_orderkey AS VARCHAR)), o_orderkey) AS logo
                   FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey)
        SELECT c_custkey AS third_id, c_name AS name,
               printf('{_TPL_LOGO}', CAST(c_custkey AS VARCHAR)) AS remote_logo, m.logo AS logo
        FROM customer JOIN m ON m.o_custkey = customer.c_custkey""",
    "unassigned": """
        SELECT c_custkey AS third_id, lower(c_name) AS en_name FROM customer c
        WHERE c_mktsegment <> 'HOUSEHOLD' AND rtrim(lower(c_name)) > ''
          AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderstatus = 'F'
                          AND o.o_custkey = c.c_custkey)""",
    "level_assignment": f"""
        WITH {_LEVELS}
        SELECT c_custkey AS car_third_id, CAST(level_id AS INTEGER) AS level_id FROM matched
        UNION ALL
        SELECT c_custkey, CAST(parent AS INTEGER) FROM matched WHERE parent <> 0""",
    "level_union": f"""
        WITH s AS (SELECT o_custkey AS car_third_id, CAST(100 + o_orderkey % 3 AS INTEGER) AS level_id,
                          0 AS branch, o_orderkey AS seq, 0 AS pos
                   FROM orders WHERE o_orderstatus = 'F'),
             {_LEVELS},
             cand AS (SELECT c_custkey FROM customer c
                      WHERE c_mktsegment <> 'HOUSEHOLD' AND rtrim(lower(c_name)) > ''
                        AND NOT EXISTS (SELECT 1 FROM s WHERE s.car_third_id = c.c_custkey)),
             t AS (SELECT c_custkey AS car_third_id, CAST(level_id AS INTEGER) AS level_id, 1 AS branch,
                          c_custkey AS seq, 0 AS pos FROM matched WHERE c_custkey IN (SELECT c_custkey FROM cand)
                   UNION ALL
                   SELECT c_custkey, CAST(parent AS INTEGER), 1, c_custkey, 1 FROM matched
                   WHERE parent <> 0 AND c_custkey IN (SELECT c_custkey FROM cand)),
             u AS (SELECT * FROM s UNION ALL SELECT * FROM t),
             r AS (SELECT *, row_number() OVER (PARTITION BY car_third_id, level_id
                                                ORDER BY branch, seq, pos) AS rn FROM u)
        SELECT car_third_id, level_id, branch FROM r WHERE rn = 1""",
    "reported_total": """
        WITH c AS (SELECT p_brand AS level, CAST(count(*) AS INTEGER) AS reported_count
                   FROM part GROUP BY p_brand)
        SELECT level, reported_count, CAST(ceil(reported_count / 100) AS INTEGER) AS n_pages,
               (SELECT CAST(sum(reported_count) AS BIGINT) FROM c) AS total
        FROM c""",
    "page_plan": f"""
        WITH c AS (SELECT p_type AS level, count(*) AS n FROM part GROUP BY p_type),
             p AS (SELECT level, unnest(generate_series(1, CAST(ceil(n / 100) AS BIGINT))) AS page FROM c)
        SELECT level, CAST(page AS INTEGER) AS page,
               printf('{_TPL_SEARCH}', level, CAST(page AS VARCHAR), '100') AS url
        FROM p""",
    "frontier": f"""
        SELECT CAST(page_id AS VARCHAR) AS parent_id, 'link' AS kind, 'http://links.example' || h AS url,
               CAST(10000 - i AS INTEGER) AS priority, page_id AS capture_seq,
               CAST(i - 1 AS INTEGER) AS pos
        FROM ({_ANCHORS})
        UNION ALL
        SELECT CAST(page_id AS VARCHAR), 'spec_page', printf('{_TPL_SPEC}', CAST(page_id AS VARCHAR)),
               0, page_id, 0
        FROM pages""",
    "frontier_rank": f"""
        WITH r AS (
          SELECT CAST(page_id AS VARCHAR) AS parent_id, 'link' AS kind, 'http://links.example' || h AS url,
                 CAST(10000 - i AS INTEGER) AS priority, page_id AS capture_seq, CAST(i - 1 AS INTEGER) AS pos
          FROM ({_ANCHORS})
          UNION ALL
          SELECT CAST(page_id AS VARCHAR), 'spec_page', printf('{_TPL_SPEC}', CAST(page_id AS VARCHAR)),
                 0, page_id, 0
          FROM pages)
        SELECT *, row_number() OVER (ORDER BY priority DESC, capture_seq, pos, kind, parent_id, url) AS rank
        FROM r""",
    "state_store_log": f"""
        WITH r AS (SELECT min(event_id) AS lo, (max(event_id) - min(event_id)) // 3 + 1 AS step FROM events),
             c AS (SELECT e.*, CASE (event_id - lo) // step WHEN 1 THEN 0 WHEN 2 THEN 1 ELSE 2 END AS batch_id
                   FROM ({_EVENT_CAPTURES}) e, r),
             s AS (SELECT *, lag(data_uid) OVER (PARTITION BY page_uid ORDER BY batch_id, event_id) AS prev
                   FROM c)
        SELECT event_id, page_uid, data_uid FROM s WHERE prev IS NULL OR prev <> data_uid""",
    "bucketed_target": """
        WITH src AS (SELECT sha1(text) AS doc_key, doc_id, lang, source FROM documents),
             one AS (SELECT 1 AS run_id, * FROM src WHERE lang = 'en'
                     QUALIFY row_number() OVER (PARTITION BY doc_key ORDER BY doc_id) = 1),
             two AS (SELECT 2 AS run_id, * FROM src WHERE doc_key NOT IN (SELECT doc_key FROM one)
                     QUALIFY row_number() OVER (PARTITION BY doc_key ORDER BY doc_id) = 1)
        SELECT *, true AS created, true AS never_updated FROM (SELECT * FROM one UNION ALL SELECT * FROM two)""",
    "two_runs": f"""
        WITH listed AS (SELECT 1 AS run_id, * FROM customer WHERE c_mktsegment <> 'BUILDING'
                        UNION ALL SELECT 2, * FROM customer),
             cars AS (SELECT *, CAST(floor(c_custkey / 100) AS BIGINT) AS block,
                             bool_or(c_mktsegment = 'BUILDING')
                                 OVER (PARTITION BY run_id, c_nationkey, floor(c_custkey / 100)) AS grown
                      FROM listed),
             emitted AS (SELECT *, coalesce(c_acctbal < 0, false) AS owes FROM cars WHERE run_id = 1 OR grown)
        SELECT run_id, 'car' AS target, CAST(c_custkey AS VARCHAR) AS item, c_name AS detail
        FROM emitted WHERE NOT owes AND (run_id = 1 OR c_mktsegment = 'BUILDING')
        UNION ALL
        SELECT DISTINCT run_id, 'change_log',
               printf('{_TPL_CARS}', CAST(c_nationkey AS VARCHAR)) || '?block=' || CAST(block AS VARCHAR), NULL
        FROM emitted
        UNION ALL
        SELECT run_id, 'quarantine/car',
               CAST(run_id * 1000000000000 + CAST(c_nationkey AS BIGINT) * 1000000 + block AS VARCHAR),
               'type:factory_third_id'
        FROM emitted WHERE owes""",
    "level_dimension": f"""
        WITH {_LEVELS}
        SELECT CAST(id AS BIGINT) AS id, CAST(level_id AS INTEGER) AS level_id, level_name,
               CAST(parent AS INTEGER) AS parent_level_id FROM lv""",
    "asset_pass_through": f"""
        WITH m AS (SELECT o_custkey,
                          arg_min(printf('full/%s.png', CAST(o_orderkey AS VARCHAR)), o_orderkey) AS logo
                   FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey)
        SELECT c_custkey AS third_id, CASE WHEN c_mktsegment <> 'HOUSEHOLD'
                   THEN printf('{_TPL_LOGO}', CAST(c_custkey AS VARCHAR)) END AS remote_logo,
               CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN m.logo END AS logo
        FROM customer LEFT JOIN m ON m.o_custkey = c_custkey
        WHERE m.logo IS NOT NULL OR c_mktsegment = 'HOUSEHOLD'""",
    "utf8_bodies": "SELECT doc_id, length(text) AS n_chars, md5(text) AS digest FROM documents",
    "allowed_hosts": """
        SELECT page_id, host FROM (
          SELECT page_id, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)', 1)) AS host
          FROM pages)
        WHERE host = 'example.com' OR host LIKE '%.example.com'""",
    "breadcrumbs": f"""
        SELECT s.event_id, r_name || ' ' || n_name || ' ' || c_name AS breadcrumb,
               '[' || kind || '] ' || CASE WHEN status = 'unchanged' THEN '' ELSE '+ ' END
                   || r_name || ' ' || n_name || ' ' || c_name AS label
        FROM ({_STATUS}) s
        JOIN customer ON s.user_id = c_custkey
        JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "spec_values": f"""
        WITH {_SPEC_SRC}
        SELECT page_id, pos, grp, item, value, is_flag FROM joined""",
    "spec_documents": f"""
        WITH {_SPEC_SRC},
        last AS (SELECT *, row_number() OVER (PARTITION BY page_id, grp, item ORDER BY pos DESC) AS rn
                 FROM joined),
        inner_docs AS (SELECT page_id, grp,
                              '{{' || string_agg(to_json(item) || ':' ||
                                  CASE WHEN is_flag THEN '1' ELSE to_json(value) END, ',' ORDER BY item)
                              || '}}' AS m
                       FROM last WHERE rn = 1 GROUP BY page_id, grp),
        docs AS (SELECT page_id, '{{' || string_agg(to_json(grp) || ':' || m, ',' ORDER BY grp) || '}}'
                        AS content FROM inner_docs GROUP BY page_id)
        SELECT o_orderkey AS page_id, coalesce(content, '{{}}') AS content
        FROM orders LEFT JOIN docs ON docs.page_id = orders.o_orderkey""",
    "colour_lists": f"""
        SELECT page_id,
               array_to_string(list_transform(range(1, len(t) + 1),
                                              lambda i: t[i] || ':' || right(s[i], 7)), ',') AS colours
        FROM (SELECT page_id, regexp_extract_all(html, {_ANCHOR}, 2) AS t,
                     regexp_extract_all(html, {_ANCHOR}, 1) AS s FROM pages)""",
    "headline_text": f"""
        SELECT page_id, headline FROM (
          SELECT page_id, {_decode("regexp_extract(html, '<h1[^>]*>([^<]*)', 1)")} AS headline
          FROM pages WHERE regexp_matches(html, '<h1[^>]*>[^<]'))""",
    "spec_rows": f"""
        SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, {_decode("t")} AS label, {_decode("h")} AS href
        FROM ({_ANCHORS})""",
    "catalogue_brands": f"""
        SELECT CAST(n_nationkey AS INTEGER) AS third_id, n_name AS name,
               printf('{_TPL_LOGO}', CAST(n_nationkey AS VARCHAR)) AS remote_logo,
               CAST(NULL AS VARCHAR) AS logo, CAST(n_regionkey AS BIGINT) AS capture_seq,
               CAST(row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS INTEGER)
                   AS pos
        FROM nation""",
    "catalogue_cars": """
        SELECT CAST(c_custkey AS INTEGER) AS third_id, c_name AS name,
               c_name || ' ' || c_mktsegment AS show_name,
               lower(replace(c_name, '#', '')) AS en_name,
               CAST(c_nationkey AS INTEGER) AS brand_third_id,
               CAST(c_nationkey * 10 AS INTEGER) AS factory_third_id,
               c_mktsegment AS factory_name, CAST(0 AS TINYINT) AS sale_state,
               CAST(c_nationkey AS BIGINT) * 1000000 + CAST(floor(c_custkey / 100) AS BIGINT) AS capture_seq,
               CAST(row_number() OVER (PARTITION BY c_nationkey, floor(c_custkey / 100)
                                       ORDER BY c_custkey) - 1 AS INTEGER) AS pos
        FROM customer""",
    "spec_sheet_documents": f"""
        WITH {_SPEC_SRC},
        last AS (SELECT *, row_number() OVER (PARTITION BY page_id, grp, item ORDER BY pos DESC) AS rn
                 FROM joined),
        inner_docs AS (SELECT page_id, grp,
                              '{{' || string_agg(to_json(item) || ':' ||
                                  CASE WHEN is_flag THEN '1' ELSE to_json(value) END, ',' ORDER BY item)
                              || '}}' AS m
                       FROM last WHERE rn = 1 GROUP BY page_id, grp),
        docs AS (SELECT page_id, '{{' || string_agg(to_json(grp) || ':' || m, ',' ORDER BY grp) || '}}'
                        AS content FROM inner_docs GROUP BY page_id)
        SELECT o_orderkey AS capture_seq, CAST(o_orderkey AS VARCHAR) AS car_version_third_id,
               coalesce(content, '{{}}') AS content
        FROM orders LEFT JOIN docs ON docs.page_id = orders.o_orderkey""",
    "level_pages": f"""
        WITH s AS (SELECT o_custkey AS car_third_id, CAST(100 + o_orderkey % 3 AS INTEGER) AS level_id,
                          0 AS branch, o_orderkey AS seq, 0 AS pos
                   FROM orders WHERE o_orderstatus = 'F'),
             {_LEVELS},
             cand AS (SELECT c_custkey FROM customer c
                      WHERE c_mktsegment <> 'HOUSEHOLD' AND rtrim(lower(c_name)) > ''
                        AND NOT EXISTS (SELECT 1 FROM s WHERE s.car_third_id = c.c_custkey)),
             t AS (SELECT c_custkey AS car_third_id, CAST(level_id AS INTEGER) AS level_id, 1 AS branch,
                          c_custkey AS seq, 0 AS pos FROM matched WHERE c_custkey IN (SELECT c_custkey FROM cand)
                   UNION ALL
                   SELECT c_custkey, CAST(parent AS INTEGER), 1, c_custkey, 1 FROM matched
                   WHERE parent <> 0 AND c_custkey IN (SELECT c_custkey FROM cand)),
             u AS (SELECT * FROM s UNION ALL SELECT * FROM t),
             r AS (SELECT *, row_number() OVER (PARTITION BY car_third_id, level_id
                                                ORDER BY branch, seq, pos) AS rn FROM u)
        SELECT CAST(car_third_id AS INTEGER) AS car_third_id, level_id, branch FROM r WHERE rn = 1""",
    "refresh_log": f"SELECT event_id, page_uid, data_uid FROM ({_STATUS}) WHERE status <> 'unchanged'",
    "fetch_plan": f"""
        SELECT CAST(n_nationkey AS VARCHAR) AS parent_id, 'car_list' AS kind,
               printf('{_TPL_CARS}', CAST(n_nationkey AS VARCHAR)) AS url,
               CAST(10000 - row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS INTEGER)
                   AS priority,
               CAST(n_regionkey AS BIGINT) AS capture_seq,
               CAST(row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS INTEGER) AS pos
        FROM nation
        UNION ALL
        SELECT CAST(c_custkey AS VARCHAR), 'version_list',
               printf('{_TPL_VERSIONS}', CAST(c_custkey AS VARCHAR)),
               CAST(9000 - row_number() OVER (PARTITION BY c_nationkey, floor(c_custkey / 100)
                                              ORDER BY c_custkey) AS INTEGER),
               CAST(c_nationkey AS BIGINT) * 1000000 + CAST(floor(c_custkey / 100) AS BIGINT),
               CAST(row_number() OVER (PARTITION BY c_nationkey, floor(c_custkey / 100)
                                       ORDER BY c_custkey) - 1 AS INTEGER)
        FROM customer""",
    "fetch_plan_full": f"""
        WITH seg AS (SELECT r_regionkey + 1 AS level_id FROM region
                     UNION ALL SELECT n_nationkey + 100 FROM nation),
             tot AS (SELECT c_nationkey + 100 AS level_id, count(*) AS n FROM customer GROUP BY 1),
             nxt AS (SELECT level_id, unnest(generate_series(2, CAST(ceil(n / 100) AS BIGINT))) AS page FROM tot)
        SELECT CAST(NULL AS VARCHAR) AS parent_id, 'seed' AS kind, '{_TPL_SEED}' AS url,
               CAST(0 AS INTEGER) AS priority, CAST(0 AS BIGINT) AS capture_seq, CAST(0 AS INTEGER) AS pos
        UNION ALL
        SELECT CAST(level_id AS VARCHAR), 'level_search',
               printf('{_TPL_SEARCH}', CAST(level_id AS VARCHAR), '1', '100'), 0, 0, 1 FROM seg
        UNION ALL
        SELECT CAST(level_id AS VARCHAR), 'level_search',
               printf('{_TPL_SEARCH}', CAST(level_id AS VARCHAR), CAST(page AS VARCHAR), '100'),
               0, 0, CAST(page AS INTEGER) FROM nxt
        UNION ALL
        SELECT CAST(event_id AS VARCHAR), 'spec_page', printf('{_TPL_SPEC}', CAST(event_id AS VARCHAR)),
               0, event_id, 0
        FROM events WHERE event_type <> 'error'
        UNION ALL
        SELECT CAST(c_custkey AS VARCHAR), 'car_page', printf('{_TPL_CAR}', lower(c_name)), 0, 0, 0
        FROM customer WHERE c_mktsegment <> 'HOUSEHOLD' AND rtrim(lower(c_name)) > ''
          AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')""",
    "catalogue_versions": """
        WITH v AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events)
        SELECT CAST(event_id AS INTEGER) AS car_third_id, CAST(user_id AS INTEGER) AS third_id,
               event_type AS name, CAST(round(value * 100) AS BIGINT) AS refer_price,
               strftime(ts, '%Y') AS year_type, upper(event_type) AS sale_state, event_id AS capture_seq
        FROM v WHERE rn = 1
          AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = user_id AND c_mktsegment = 'BUILDING')""",
    "version_attr_store": f"""
        WITH {_SPEC_SRC},
        last AS (SELECT *, row_number() OVER (PARTITION BY page_id, grp, item ORDER BY pos DESC) AS rn
                 FROM joined),
        inner_docs AS (SELECT page_id, grp,
                              '{{' || string_agg(to_json(item) || ':' ||
                                  CASE WHEN is_flag THEN '1' ELSE to_json(value) END, ',' ORDER BY item)
                              || '}}' AS m
                       FROM last WHERE rn = 1 GROUP BY page_id, grp),
        docs AS (SELECT page_id, '{{' || string_agg(to_json(grp) || ':' || m, ',' ORDER BY grp) || '}}'
                        AS content FROM inner_docs GROUP BY page_id),
        firsts AS (SELECT o_custkey, min(o_orderkey) AS k FROM orders GROUP BY o_custkey)
        SELECT CAST(o_custkey AS INTEGER) AS car_version_third_id, coalesce(content, '{{}}') AS content,
               k AS capture_seq
        FROM firsts LEFT JOIN docs ON docs.page_id = k
        WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey
                          AND c_mktsegment = 'BUILDING')""",
    "link_quarantine": """
        WITH r AS (SELECT o_orderkey AS capture_seq,
                          CASE WHEN o_orderpriority = '1-URGENT' THEN 'unparsable:level_search'
                               WHEN o_orderstatus = 'O' THEN 'type:car_third_id'
                               WHEN o_orderstatus = 'P' THEN 'type:level_id' END AS reason,
                          CASE WHEN o_orderpriority = '1-URGENT' THEN 'capture' ELSE 'car2level' END AS target
                   FROM orders)
        SELECT target, capture_seq, reason FROM r WHERE reason IS NOT NULL""",
    "level_totals": f"""
        WITH s AS (SELECT o_custkey AS car_third_id, CAST(100 + o_orderkey % 3 AS INTEGER) AS level_id
                   FROM orders WHERE o_orderstatus = 'F'),
             {_LEVELS},
             cand AS (SELECT c_custkey FROM customer c
                      WHERE c_mktsegment <> 'HOUSEHOLD' AND rtrim(lower(c_name)) > ''
                        AND NOT EXISTS (SELECT 1 FROM s WHERE s.car_third_id = c.c_custkey)),
             t AS (SELECT c_custkey AS car, level_id AS lvl FROM matched
                   WHERE c_custkey IN (SELECT c_custkey FROM cand)
                   UNION
                   SELECT c_custkey, parent FROM matched
                   WHERE parent <> 0 AND c_custkey IN (SELECT c_custkey FROM cand)),
             n AS (SELECT level_id, count(DISTINCT car_third_id) AS c FROM s GROUP BY level_id)
        SELECT level_id, CAST(c AS INTEGER) AS reported_count, CAST(ceil(c / 100) AS INTEGER) AS n_pages,
               CAST((SELECT sum(c) FROM n) + (SELECT count(*) FROM t) AS BIGINT) AS total
        FROM n""",
}
