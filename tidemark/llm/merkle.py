"""Merkle manifest of a data set by nested-interval labels.

Every row is a leaf; the leaves of a group (a source) stand in the order of their ids and
have ranks 0, 1, ...  A node is labelled by the interval [lo, hi) of the leaf ranks that it
covers.  A node of level k covers ``FANOUT ** k`` ranks (the last one fewer), and its digest
is H of its children's digests, so a level is one aggregation over the level below, by
``lo div FANOUT ** k``, with at most ``FANOUT`` rows to a group.  The nodes that cover their
whole group are leaves of one more tree, over the groups.

Proofs come from the labels alone.  From the roots down, the nodes of a level are joined with
the level above by containment of intervals, within the bucket ``lo div width`` that both share;
what the parent's interval holds beside the child's, [parent.lo, child.lo) and
[child.hi, parent.hi), are the child's siblings, cut out of the parent's row of digests.  A node
hands down what it has gathered, so a leaf joins once, with its parent, and the texts are never
moved: H of a record is taken in the scan.  Ranks come from ranges and offsets
(``operators.ranking``), so a source with a third of all rows is spread like any other.

Each level is written to the shared folder.  There are log16 of the largest group's size of them.

A null id sorts last, a null group first; of rows with one id, the one with the smaller
digest comes first (identical rows in any order: their proofs differ, their digests don't).  Null
fields are ``-`` in a record.  Without rows there is no leaf and no root.  Only the columns
that are named are read; others may be called anything.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written
from tidemark.operators.ranking import global_rank

FANOUT = 16
#: Hexadecimal digits of a digest.
DIGITS = 64
RECORD = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PATH = "array<struct<before: string, after: string>>"


def digest(*parts: Column) -> Column:
    """H: lowercase hex SHA-256 of the concatenation."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def record_digest(values: Sequence[Column]) -> Column:
    return digest(*[field(v) for v in values])


@dataclass(frozen=True)
class Manifest:
    leaves: DataFrame        # g, lo (rank from 0), n (leaves of the group), digest and what was carried
    levels: list[DataFrame]  # of levels 1, 2, ...: g, lo, hi, n, children (their digests in order), digest
    groups: DataFrame        # g, subroot, root, path (the subroot's siblings, upwards)


def group_key(group: Column) -> Column:
    """Null as '', others behind '=': no null in a join, and null sorts first."""
    text = group.cast("string")
    return F.when(text.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), text))


def _levels(leaves: DataFrame) -> list[DataFrame]:
    """The nodes over ``leaves`` (g, lo, n, digest), level by level."""
    largest = leaves.agg(F.max("n")).first()[0] or 0
    below = leaves.select("g", "lo", "n", "digest")
    levels, span = [], 1
    while span < largest:
        width = span * FANOUT
        lo = (F.expr(f"lo div {width}L") * F.lit(width)).alias("lo")
        level = below.filter(F.col("n") > span).groupBy("g", "n", lo).agg(
            F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(F.col("lo").alias("at"), "digest"))),
                                     lambda x: x["digest"]), "").alias("children"))
        level = written(level.select("g", "lo", F.least(F.col("lo") + width, "n").alias("hi"), "n", "children",
                                     F.sha2("children", 256).alias("digest")), "merkle-level")
        levels.append(level)
        below, span = level, width
    return levels


def _attached(nodes: DataFrame, parents: DataFrame, span: int) -> DataFrame:
    """``nodes`` (g, lo, hi, ...), of ``span`` ranks each, with subroot, root and the path of
    siblings from their own upwards: the parent of each is the node that contains its interval."""
    width = span * FANOUT
    n, p = nodes.alias("n"), parents.alias("p")
    inside = ((F.col("n.g") == F.col("p.g")) & (F.expr(f"n.lo div {width}L") == F.expr(f"p.lo div {width}L"))
              & (F.col("p.lo") <= F.col("n.lo")) & (F.col("n.hi") <= F.col("p.hi")))
    left = F.expr(f"(n.lo - p.lo) div {span}L").cast("int")
    right = F.ceil((F.col("p.hi") - F.col("n.hi")) / F.lit(span)).cast("int")
    siblings = F.struct(F.left("p.children", left * DIGITS).alias("before"),
                        F.right("p.children", right * DIGITS).alias("after"))
    return n.join(p, inside).select("n.*", "p.subroot", "p.root",
                                    F.concat(F.array(siblings), F.col("p.path")).alias("path"))


def _descended(leaves: DataFrame, levels: list[DataFrame], groups: DataFrame) -> DataFrame:
    """``leaves`` with subroot, root and path; ``groups`` (g, subroot, root, path) is what
    the nodes that cover their whole group start with."""
    above = None
    for k in range(len(levels), -1, -1):
        span = FANOUT ** k
        nodes = levels[k - 1].drop("digest") if k else leaves.withColumn("hi", F.col("lo") + 1)
        tops = nodes.filter(F.col("n") <= span).join(groups, "g").select(*nodes.columns, "subroot", "root", "path")
        if above is not None:
            tops = tops.unionByName(_attached(nodes.filter(F.col("n") > span), above, span))
        above = tops
    return above.drop("hi")


def _tops(leaves: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """(g, digest): the node of each group that covers all its leaves."""
    tops = leaves.filter("n = 1").select("g", "digest")
    for k, level in enumerate(levels, 1):
        tops = tops.unionByName(level.filter(F.col("n") <= FANOUT ** k).select("g", "digest"))
    return tops


def manifest(rows: DataFrame) -> Manifest:
    """The tree over ``rows`` (g, id, digest and any columns to carry along)."""
    rows = written(rows, "merkle-records")             # ranges are sampled: no text is read twice for that
    leaves = global_rank(rows, [F.col("id").asc_nulls_last(), "digest"], ["g"], rank="lo", total="n")
    leaves = written(leaves.withColumn("lo", F.col("lo") - 1), "merkle-leaves")
    levels = _levels(leaves)
    tops = written(_tops(leaves, levels), "merkle-subroots")
    # the subroots are the leaves of one tree
    upper = global_rank(tops, ["g"], rank="lo", total="n").select(
        F.lit("").alias("g"), F.col("g").alias("member"), (F.col("lo") - 1).alias("lo"), "n", "digest")
    upper = written(upper, "merkle-upper-leaves")
    upper_levels = _levels(upper)
    root = _tops(upper, upper_levels).select("g", F.col("digest").alias("subroot"), F.col("digest").alias("root"),
                                             F.array().cast(PATH).alias("path"))
    groups = _descended(upper, upper_levels, root).select(
        F.col("member").alias("g"), F.col("digest").alias("subroot"), "root", "path")
    return Manifest(leaves, levels, written(groups, "merkle-groups"))


def proofs(tree: Manifest) -> DataFrame:
    """The leaves with subroot, root and path (siblings before and after, from the leaf's own up)."""
    return _descended(tree.leaves, tree.levels, tree.groups)


def folded(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` gives with the siblings of ``path``."""
    return F.aggregate(path, leaf, lambda h, s: digest(s["before"], h, s["after"]))


def sibling_digest(path: Column) -> Column:
    """H of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def lowered(text: Column) -> Column:
    """A-Z alone in lower case."""
    return F.translate(text.cast("string"), UPPER, LOWER)


def tampering(docs: DataFrame, columns: Sequence[str] = RECORD, id_col: str = "doc_id", group_col: str = "source",
              text_col: str = "text") -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified), a row for each of ``docs``:
    their manifest, and what the proofs say where 5 divides the CRC-32 of the id and someone has
    lower-cased the text since."""
    whole = record_digest([F.col(c) for c in columns])
    changed = record_digest([lowered(F.col(c)) if c == text_col else F.col(c) for c in columns])
    hit = F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0
    rows = docs.select(group_key(F.col(group_col)).alias("g"), F.col(id_col).alias("id"), whole.alias("digest"),
                       F.when(hit, changed).alias("tampered"))
    found = proofs(manifest(rows))
    out = found.select(F.col("id").alias("doc_id"), F.col("digest").alias("leaf"), "subroot", "root",
                       sibling_digest(F.col("path")).alias("proof_sha256"),
                       folded(F.coalesce("tampered", "digest"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def _oracle(depth: int = 6) -> str:
    """DuckDB: the same tree, its levels written out (``depth`` of them hold 16 ** depth leaves)."""
    def f(c: str) -> str:
        return (f"CASE WHEN {c} IS NULL THEN '-' ELSE CAST(octet_length(encode(CAST({c} AS VARCHAR))) AS VARCHAR) "
                f"|| ':' || CAST({c} AS VARCHAR) END")

    def tree(name: str, leaves: str) -> list[str]:
        # a group that is down to one node keeps it as it is
        steps = [f"{name}0 AS (SELECT g, lo, h, n FROM {leaves})"]
        for k in range(1, depth + 1):
            steps.append(
                f"{name}{k} AS (SELECT g, lo // 16 AS lo, CASE WHEN any_value(n) = 1 THEN any_value(h) "
                f"ELSE sha256(string_agg(h, '' ORDER BY lo)) END AS h, (any_value(n) + 15) // 16 AS n "
                f"FROM {name}{k - 1} GROUP BY g, lo // 16)")
        return steps

    def paths(name: str) -> list[str]:
        run = "PARTITION BY g, lo // 16 ORDER BY lo ROWS BETWEEN"
        return [f"{name}p{k} AS (SELECT g, lo, n > 1 AS up, "
                f"coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, "
                f"coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r "
                f"FROM {name}{k})" for k in range(depth)]

    names = ["t", "u"]
    crc = ("list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(length(CAST(doc_id AS VARCHAR))), "
           "lambda i: CAST(ascii(substr(CAST(doc_id AS VARCHAR), i + 1, 1)) AS BIGINT))), "
           "lambda c, b: list_reduce(list_prepend(xor(c, b), [CAST(0 AS BIGINT) FOR x IN range(8)]), "
           "lambda a, z: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END))")
    ctes = [
        f"docs AS (SELECT doc_id, CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS g, "
        f"sha256({' || '.join(f(c) for c in RECORD)}) AS h, "
        f"sha256({' || '.join(f(c) if c != 'text' else f(f'translate(text, {UPPER!r}, {LOWER!r})') for c in RECORD)}) AS h2, "
        f"coalesce(xor({crc}, 4294967295) % 5 = 0, false) AS hit FROM documents)",
        "leaves AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS LAST, h) - 1 AS lo, "
        "count(*) OVER (PARTITION BY g) AS n FROM docs)",
        *tree("t", "leaves"), *paths("t"),
        f"tops AS (SELECT '' AS g, g AS member, h, row_number() OVER (ORDER BY encode(g)) - 1 AS lo, "
        f"count(*) OVER () AS n FROM t{depth})",
        *tree("u", "tops"), *paths("u"),
    ]
    joins, parts, fold = [], [], "CASE WHEN hit THEN d.h2 ELSE d.h END"
    for name, source in zip(names, ("d", "s")):
        for k in range(depth):
            a = f"{name}j{k}"
            joins.append(f"JOIN {name}p{k} {a} ON {a}.g = {source}.g AND {a}.lo = {source}.lo // {16 ** k}")
            parts.append(f"{a}.l || {a}.r")
    steps, inner = [], "base"
    steps.append(f"base AS (SELECT d.doc_id, d.h AS leaf, s.h AS subroot, top.h AS root, sha256({' || '.join(parts)}) "
                 f"AS proof_sha256, {fold} AS f, "
                 + ", ".join(f"{n}j{k}.{c} AS {n}{k}{c}" for n in names for k in range(depth) for c in ("l", "r", "up"))
                 + f" FROM leaves d JOIN tops s ON s.member = d.g CROSS JOIN u{depth} top " + " ".join(joins) + ")")
    for n in names:
        for k in range(depth):
            steps.append(f"f{n}{k} AS (SELECT * REPLACE (CASE WHEN {n}{k}up THEN sha256({n}{k}l || f || {n}{k}r) "
                         f"ELSE f END AS f) FROM {inner})")
            inner = f"f{n}{k}"
    return ("WITH " + ",\n".join(ctes + steps) + "\nSELECT doc_id, leaf, subroot, root, proof_sha256, "
            f"f AS folded_root, f = root AS verified FROM {inner}")


ORACLE = _oracle()
