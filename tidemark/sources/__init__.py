"""Scans: captures (batch and stream), driver tables, dimensions."""

from tidemark.sources.captures import CAPTURE_SCHEMA, CAPTURE_KINDS, read_captures
from tidemark.sources.tables import read_table
from tidemark.sources.dimensions import level_dimension, spec_dictionary

__all__ = ["CAPTURE_SCHEMA", "CAPTURE_KINDS", "read_captures", "read_table",
           "level_dimension", "spec_dictionary"]
