"""Positions in a global order without a window over all rows.

A ``row_number`` over a whole table, or over a hot group, puts that many rows in
one task.  Here the rows are range-partitioned and sorted once, each notes its place
in its partition, and an offset table with one row for each partition and group adds
what comes before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.session import stored

#: ``monotonically_increasing_id`` is the partition, shifted by this, plus the row's place in it.
PARTITION_SHIFT = 33


def unused(columns: Sequence[str], name: str) -> str:
    """``name``, or a longer one where a column is called so already (in any case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def global_rank(df: DataFrame, order: Sequence[Column | str], group: Sequence[str] = (),
                rank: str = "rank", total: str | None = None) -> DataFrame:
    """``df`` with ``rank`` (long, from 1), each row's place by ``order`` within its
    ``group`` (null is a group of its own), and the group's size as ``total``, if named.

    Two passes: a sort over ranges of (group, order), written to the shared folder, so
    that places stay as they are whatever executors are lost, and a join with the offset
    table.  A hot group spreads over as many tasks as it fills; only rows that are equal in
    ``group`` and ``order`` stay together, so ``order`` should tell rows apart.  Rows equal
    in both get any of their places.
    """
    names = df.columns
    at, part, first, n, before, size = (unused(names, f"_{x}") for x in
                                        ("at", "part", "first", "n", "before", "size"))
    by = [*(F.col(g) for g in group), *(F.col(o) if isinstance(o, str) else o for o in order)]
    placed = df.repartitionByRange(*by).sortWithinPartitions(*by) \
               .withColumn(at, F.monotonically_increasing_id())
    placed = stored(placed, "ranked").withColumn(part, F.shiftright(at, PARTITION_SHIFT))
    runs = placed.groupBy(*group, part).agg(F.min(at).alias(first), F.count(F.lit(1)).alias(n))
    # one row for each partition and group
    so_far = Window.partitionBy(*group).orderBy(part)
    runs = runs.select(*[F.col(g).alias(f"{g}{before}") for g in group], F.col(part).alias(part + before), first,
                       (F.sum(n).over(so_far) - F.col(n)).alias(before),
                       F.sum(n).over(Window.partitionBy(*group)).alias(size))
    same = F.col(part) == F.col(part + before)
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"{g}{before}"))
    place = (F.col(at) - F.col(first) + F.col(before) + 1).alias(rank)
    return placed.join(runs, same).select(*names, place, *([F.col(size).alias(total)] if total else []))
