"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written


def roots(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Smallest index of the component of each of ``n`` nodes, for one task's own links."""
    parent = np.arange(n)
    while len(u):
        pu, pv = parent[u], parent[v]
        open_ = pu != pv
        if not open_.any():
            break
        u, v, pu, pv = u[open_], v[open_], pu[open_], pv[open_]
        np.minimum.at(parent, np.maximum(pu, pv), np.minimum(pu, pv))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up
    return parent


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v); root: the smallest node that
    can be reached.

    Every round replaces, for each node, its larger neighbours' links (large star)
    and then its smaller neighbours' links (small star) by links to the smallest of
    them, until each node has one link and no root has any.  A node's minimum is a
    map-side aggregate joined back (the join splits hot nodes); each round is written
    to the shared folder, so lineage stays short and nothing is held on the driver.
    """
    e = written(edges.filter("u != v").select(F.greatest("u", "v").alias("hi"), F.least("u", "v").alias("lo"))
                .distinct(), "edges")
    while True:
        several = e.groupBy("hi").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).count()
        chained = several or e.join(e.select(F.col("lo").alias("x")).distinct(), F.col("hi") == F.col("x"),
                                    "left_semi").limit(1).count()
        if not chained:
            break
        both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(e.select("lo", "hi"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").filter("v != m").select(
            F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        large = written(large, "large-star")
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").filter("lo != m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        e = written(small.union(least.select("hi", F.col("m").alias("lo"))).distinct(), "small-star")
    least = e.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(least)
