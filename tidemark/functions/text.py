"""Small text rules of the extractors."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def head_before(c: Column | str, sep: str) -> Column:
    """H7: the text before the first ``sep`` (all of it when absent)."""
    return F.substring_index(_c(c), sep, 1)


def remap(c: Column | str, mapping: dict[str, str]) -> Column:
    """H8: exact-match synonyms, other values unchanged."""
    col = _c(c)
    if not mapping:
        return col
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.element_at(m, col), col)


def drop_last_char(c: Column | str) -> Column:
    """``s[:-1]``; '' for a one-character string."""
    col = _c(c)
    return F.substring(col, F.lit(1), F.greatest(F.char_length(col) - 1, F.lit(0)))


def colour_entry(title: Column | str, style: Column | str) -> Column:
    """``title + ':' + style[-7:]``."""
    s = _c(style)
    start = F.greatest(F.char_length(s) - 6, F.lit(1))
    return F.concat(_c(title), F.lit(":"), F.substring(s, start, F.lit(7)))


def joined_or_fallback(first: Column | str, second: Column | str, sep: str = ",") -> Column:
    """Join the first list when it is non-empty, else join the second."""
    a, b = _c(first), _c(second)
    return F.when(F.size(a) > 0, F.array_join(a, sep)).otherwise(
        F.coalesce(F.array_join(b, sep), F.lit("")))


def spaced_concat(*cols: Column | str) -> Column:
    """``a + ' ' + b + ...``; NULL when any part is NULL (unlike concat_ws)."""
    parts: list[Column] = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(" "))
        parts.append(_c(c))
    return F.concat(*parts)


def utf8_text(c: Column | str) -> Column:
    """Bodies landed as bytes are decoded as UTF-8; text passes through."""
    col = _c(c)
    return F.decode(col, "UTF-8")
