"""Page counts and page numbers."""

from pyspark.sql import Column, functions as F


def page_count(count: Column | str, page_size: int) -> Column:
    """ceil(count / page_size) with true division; 0 for count <= 0."""
    c = F.col(count) if isinstance(count, str) else count
    return F.greatest(F.ceil(c.cast("double") / F.lit(float(page_size))), F.lit(0)).cast("int")


def page_numbers(n: Column | str, start: int = 1) -> Column:
    """Array start..n; empty when n < start (``sequence(1, 0)`` would count down)."""
    c = F.col(n) if isinstance(n, str) else n
    return F.when(c >= start, F.sequence(F.lit(start), c.cast("int"))).otherwise(
        F.array().cast("array<int>"))
