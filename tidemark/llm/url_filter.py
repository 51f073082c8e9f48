"""URL filter: block and allow rules, and a path-template tree for what they leave open
(DataFrame functions only).

Rules are host/path prefixes.  A rule fits its host and every subdomain, if the url's path
starts with the rule's; the longest wins.  The urls that rules decide are the labelled ones.

The tree, per host.  Urls are first counted by host and segment shapes (digits become ``#``;
``DEPTH`` segments, the last takes the rest), so that all later work is on distinct shapes.
Then, level by level below what the level above has merged:

1. a segment is variable, and becomes ``*``, if its node has ``CHILDREN`` or more different
   ones and this one has less than 1 / ``RARE`` of the node's urls;
2. branches of a node are merged if they are statistically similar: the shares of their next
   segments, of labelled and of blocked urls all agree to the nearest quarter.

A branch of the last level is a template.  Its purity is (blocked + 1) / (labelled + 5), in which
each url without a label counts as another 1 / ``UNSEEN`` labelled ones that are not blocked: the
labels that a rule makes are no sample of a template, as they lie where the rule points.  Urls
without a rule are blocked where the purity is ``PURE`` or more; with nothing but blocked labels
that takes a few more than half of the template's urls.  Labels may also come with the rows
(``blocked_col``; a rule's own goes first), as from a review of pages.

A null url, or one without ``://``, has the empty host and path; no rule fits it, and it has a
template like any other.  Repeated urls count each; an empty table gives no row; extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written

RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
DEPTH = 4
CHILDREN = 8
RARE = 20
PURE = 0.8
#: So many urls without a label weigh as much as one that is allowed.
UNSEEN = 4
#: Rules are compared one by one with each url.
MAX_RULES = 10_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = "(?s)^.*?://([^/?#]*)([^?#]*)"
SHAPES = [f"s{d}" for d in range(1, DEPTH + 1)]


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """(verdict, rule) of the longest rule that fits; null if none does."""
    if len(rules) > MAX_RULES:
        raise ValueError("too many rules to compare one by one")
    if not rules:
        return F.lit(None).cast("struct<verdict:string,rule:string>")
    fits = []
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        at, _, rest = rule.partition("/")
        fits.append(F.when(((host == at) | host.endswith(f".{at}")) & path.startswith(f"/{rest}"),
                           F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))))
    return F.coalesce(*fits)


def shapes(path: Column) -> list[Column]:
    """The segments' shapes; empty where there is none."""
    segments = F.filter(F.split(F.regexp_replace(path, "[0-9]+", "#"), "/"), lambda s: s != "")
    first = [F.coalesce(F.get(segments, F.lit(d)), F.lit("")) for d in range(DEPTH - 1)]
    return [*first, F.array_join(F.slice(segments, DEPTH, F.greatest(F.size(segments), F.lit(1))), "/")]


def _quarters(part: Column, whole: Column) -> Column:
    """4 part / whole to the nearest integer, in integers."""
    return F.floor((part * 8 + whole) / (whole * 2)).cast("long")


def templates(counted: DataFrame) -> DataFrame:
    """(host, shapes..., template, purity) of ``counted`` (host, shapes..., n, labelled, blocked)."""
    tree = written(counted.withColumn("template", F.lit("")), "url-shapes")
    node = ["host", "template"]
    for d, shape in enumerate(SHAPES):
        child = tree.groupBy(*node, shape).agg(F.sum("n").alias("c"))
        parent = child.groupBy(*node).agg(F.sum("c").alias("p"), F.count(F.lit(1)).alias("kinds"))
        named = child.join(parent, node).select(
            *node, shape, F.when((F.col("kinds") >= CHILDREN) & (F.col("c") * RARE < F.col("p")), "*")
            .otherwise(F.col(shape)).alias("segment"))
        named = written(tree.join(named, [*node, shape]), "url-segments")
        branch = [*node, "segment"]
        total = named.groupBy(*branch).agg(F.sum("n").alias("b"), F.sum("labelled").alias("l"),
                                           F.sum("blocked").alias("x"))
        signature = F.concat_ws("|", _quarters(F.col("l"), F.col("b")).cast("string"),
                                _quarters(F.col("x"), F.col("b")).cast("string"))
        if d + 1 < DEPTH:
            following = SHAPES[d + 1]
            # a share that rounds to a quarter or more: eight of a branch at most
            share = named.groupBy(*branch, following).agg(F.sum("n").alias("c")).join(total.select(*branch, "b"), branch)
            q = _quarters(F.col("c"), F.col("b"))
            share = share.filter(q > 0).groupBy(*branch).agg(F.array_join(F.sort_array(F.collect_list(
                F.concat_ws(":", following, q.cast("string")))), ",").alias("shares"))
            total = total.join(share, branch, "left")
            signature = F.concat_ws("|", signature, F.coalesce("shares", F.lit("")))
        merged = total.select(*branch, F.md5(F.concat_ws("|", "template", signature).cast("binary")).alias("deeper"))
        tree = written(named.join(merged, branch).drop("template", "segment").withColumnRenamed("deeper", "template"),
                       "url-branches")
    n, labelled, blocked = F.sum("n"), F.sum("labelled"), F.sum("blocked")
    purity = tree.groupBy("host", "template").agg(
        (UNSEEN * (blocked + 1) / (UNSEEN * (labelled + 5) + n - labelled)).alias("purity"))
    return tree.join(purity, ["host", "template"]).select("host", *SHAPES, "template", "purity")


def judged(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, id_col: str = "page_id",
           url_col: str = "url", blocked_col: str | None = None) -> DataFrame:
    """(page_id, host, path, rule, template, purity, verdict) of every row; ``blocked_col`` (boolean,
    null: not known) labels rows that no rule decides, whose verdict is then the label's."""
    url = F.col(url_col).cast("string")
    known = F.lit(None).cast("boolean") if blocked_col is None else F.col(blocked_col)
    rows = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"),
                        F.when(known, "block").when(~known, "allow").alias("known"))
    rows = rows.withColumn("fit", rule_of(F.col("host"), F.col("path"), rules)) \
        .withColumns({"label": F.coalesce("fit.verdict", "known"), **dict(zip(SHAPES, shapes(F.col("path"))))})
    counted = rows.groupBy("host", *SHAPES).agg(
        F.count(F.lit(1)).alias("n"), F.count("label").alias("labelled"),
        F.count(F.when(F.col("label") == "block", 1)).alias("blocked"))
    found = templates(counted)
    method = F.when(F.col("purity") >= PURE, "block").otherwise("allow")
    return rows.join(found, ["host", *SHAPES]).select(
        "page_id", "host", "path", F.col("fit.rule").alias("rule"), "template", "purity",
        F.coalesce("label", method).alias("verdict"))


def _oracle(rules: Sequence[tuple[str, str]]) -> str:
    """The same in DuckDB's SQL."""
    cases = []
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        at, _, rest = rule.partition("/")
        cases.append(f"WHEN (host = '{at}' OR ends_with(host, '.{at}')) AND starts_with(path, '/{rest}') "
                     f"THEN '{verdict} {rule}'")
    quarters = lambda a, b: f"CAST((8 * {a} + {b}) // (2 * {b}) AS BIGINT)"
    firsts = ", ".join(f"coalesce(seg[{d}], '') AS s{d}" for d in range(1, DEPTH))
    sql = f"""WITH parsed AS (
    SELECT page_id, translate(coalesce(regexp_extract(url, '{URL}', 1), ''), '{UPPER}', '{LOWER}') AS host,
           coalesce(regexp_extract(url, '{URL}', 2), '') AS path FROM pages),
ruled AS (SELECT *, CASE {' '.join(cases)} END AS fit,
    list_filter(string_split(regexp_replace(path, '[0-9]+', '#', 'g'), '/'), lambda s: s <> '') AS seg FROM parsed),
shaped AS (SELECT *, {firsts}, array_to_string(seg[{DEPTH}:], '/') AS s{DEPTH} FROM ruled),
tree0 AS (SELECT host, {', '.join(SHAPES)}, CAST(count(*) AS BIGINT) AS n, CAST(count(fit) AS BIGINT) AS labelled,
    CAST(count(*) FILTER (fit LIKE 'block %') AS BIGINT) AS blocked, '' AS template
    FROM shaped GROUP BY host, {', '.join(SHAPES)}),
"""
    for d, shape in enumerate(SHAPES):
        below = SHAPES[d + 1] if d + 1 < DEPTH else None
        sql += f"""child{d} AS (SELECT host, template, {shape}, sum(n) AS c FROM tree{d} GROUP BY ALL),
parent{d} AS (SELECT host, template, sum(c) AS p, count(*) AS kinds FROM child{d} GROUP BY ALL),
named{d} AS (SELECT t.*, CASE WHEN kinds >= {CHILDREN} AND c * {RARE} < p THEN '*' ELSE t.{shape} END AS segment
    FROM tree{d} t JOIN child{d} USING (host, template, {shape}) JOIN parent{d} USING (host, template)),
total{d} AS (SELECT host, template, segment, sum(n) AS b, sum(labelled) AS l, sum(blocked) AS x
    FROM named{d} GROUP BY ALL),
"""
        shares = "NULL"
        if below:
            sql += f"""next{d} AS (SELECT host, template, segment, {below} AS k, sum(n) AS c FROM named{d} GROUP BY ALL),
share{d} AS (SELECT host, template, segment, array_to_string(list_sort(list(k || ':' || {quarters('c', 'b')})), ',') AS shares
    FROM next{d} JOIN total{d} USING (host, template, segment) WHERE {quarters('c', 'b')} > 0
    GROUP BY host, template, segment),
"""
            shares = f"coalesce((SELECT shares FROM share{d} s WHERE s.host = t.host AND s.template = t.template " \
                     f"AND s.segment = t.segment), '')"
        tail = f" || '|' || {shares}" if below else ""
        sql += f"""merged{d} AS (SELECT host, template, segment,
    md5(template || '|' || {quarters('l', 'b')} || '|' || {quarters('x', 'b')}{tail}) AS deeper FROM total{d} t),
tree{d + 1} AS (SELECT t.* EXCLUDE (template, segment), deeper AS template
    FROM named{d} t JOIN merged{d} USING (host, template, segment)),
"""
    return sql + f"""pure AS (SELECT host, template,
    {UNSEEN} * (sum(blocked) + 1) / ({UNSEEN} * (sum(labelled) + 5) + sum(n) - sum(labelled)) AS purity
    FROM tree{DEPTH} GROUP BY ALL)
SELECT page_id, host, path, split_part(fit, ' ', 2) AS rule, template, CAST(purity AS DOUBLE) AS purity,
    coalesce(split_part(fit, ' ', 1), CASE WHEN purity >= {PURE} THEN 'block' ELSE 'allow' END) AS verdict
FROM shaped JOIN tree{DEPTH} USING (host, {', '.join(SHAPES)}) JOIN pure USING (host, template)"""


ORACLE = _oracle(RULES)
