"""tidemark: an incremental capture-to-catalogue engine on PySpark.

Captures (url, body, arrival order) come in as a table or a stream; the
operators fingerprint them, decide what changed since earlier runs, extract
entities from script, JSON and HTML bodies, write entity and link tables with
first-write-wins and quarantine, assemble normalised specification documents,
classify entities into a two-level hierarchy and plan the next fetches.

Every operator takes and returns DataFrames; the work stays in Catalyst.
"""

__version__ = "0.1.0"
