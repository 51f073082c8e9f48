"""H2: find-all with Python regex semantics for '.'."""

from pyspark.sql import Column, functions as F


def python_dot(pattern: str) -> str:
    """Java's '.' also stops at '\\r', U+0085, U+2028 and U+2029; with the
    UNIX_LINES flag it stops only at '\\n', as Python's does."""
    return pattern if pattern.startswith("(?d)") else "(?d)" + pattern


def regex_matches(c: Column | str, pattern: str, groups: dict[str, int]) -> Column:
    """All non-overlapping matches as ``array<struct<name: string, ...>>``.

    The body is scanned once for whole matches; each group is then read from
    the (short) match text, which gives the same groups as a scan per group.
    """
    col = F.col(c) if isinstance(c, str) else c
    p = python_dot(pattern)
    whole = F.regexp_extract_all(col, F.lit(p), 0)
    return F.transform(
        whole,
        lambda m: F.struct(*[F.regexp_extract(m, p, g).alias(n) for n, g in groups.items()]),
    )
