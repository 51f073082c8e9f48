"""Column-expression helpers: each returns a Column built from built-ins."""

from tidemark.functions.digest import sha1_hex
from tidemark.functions.json import json_object_text, parse_lenient
from tidemark.functions.regex import python_dot, regex_matches
from tidemark.functions.text import (
    colour_entry,
    drop_last_char,
    head_before,
    joined_or_fallback,
    remap,
    spaced_concat,
    utf8_text,
)
from tidemark.functions.urls import from_template, host_allowed, url_host
from tidemark.functions.paging import page_count, page_numbers

__all__ = [
    "sha1_hex", "json_object_text", "parse_lenient", "python_dot",
    "regex_matches", "colour_entry", "drop_last_char", "head_before",
    "joined_or_fallback", "remap", "spaced_concat", "utf8_text", "from_template",
    "host_allowed", "url_host", "page_count", "page_numbers",
]
