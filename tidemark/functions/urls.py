"""URL templates and the host allow-list."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F


def from_template(template: str, *args: Column | str) -> Column:
    """A format string ('%s'; '%1$s' where one argument is used again) over columns."""
    return F.format_string(template, *[F.col(a) if isinstance(a, str) else a for a in args])


def url_host(c: Column | str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.lower(F.try_parse_url(col, F.lit("HOST")))


def host_allowed(c: Column | str, domains: list[str]) -> Column:
    """True when the host is one of ``domains`` or a subdomain of one."""
    host = url_host(c)
    tests = [(host == F.lit(d.lower())) | host.endswith("." + d.lower()) for d in domains]
    return F.coalesce(reduce(lambda x, y: x | y, tests), F.lit(False))
