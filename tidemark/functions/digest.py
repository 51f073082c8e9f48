"""H1: content fingerprints."""

from pyspark.sql import Column, functions as F


def sha1_hex(c: Column | str) -> Column:
    """Lower-case hex SHA-1 of the UTF-8 bytes of a string column."""
    col = F.col(c) if isinstance(c, str) else c
    return F.sha1(F.encode(col.cast("string"), "UTF-8"))
