"""H3/H4: JSONP bodies and lenient JSON parsing."""

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DataType

# Control characters inside strings are accepted, as a non-strict parser does.
LENIENT = {"allowUnquotedControlChars": "true"}


def json_object_text(c: Column | str) -> Column:
    """Text from the first '{' on; NULL when the body has no '{'."""
    col = F.col(c) if isinstance(c, str) else c
    pos = F.instr(col, "{")
    return F.when(pos > 0, F.substr(col, pos))


def parse_lenient(c: Column | str, schema: DataType | str) -> Column:
    """``from_json`` that accepts raw control characters; NULL when malformed."""
    col = F.col(c) if isinstance(c, str) else c
    return F.from_json(col, schema, LENIENT)
