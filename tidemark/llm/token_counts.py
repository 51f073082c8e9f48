"""Exact histogram of encoded lengths, and what its suffix sums answer.

Each text is encoded whole; documents are counted by length (and optional keys)
with map-side aggregation, so what is shuffled is at most one row for each length,
key and task.  From the histogram alone, every context limit is answered: the
documents and tokens at or beyond it, the tokens left when every document is
truncated to it, and the share of documents within it.  The running sums are taken
in two levels (inside spans of 1024 lengths, then over the spans), so no window
holds the whole histogram.

A key may have any name: where it is that of a result column, that column gets a longer one
(``tokens_`` beside a key ``tokens``).

Null text has length 0 and is counted; repeated rows count each; extra columns are
ignored; an empty table gives an empty histogram.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches
from tidemark.llm.tokens import VOCABULARY, document_ids
from tidemark.operators.ranking import unused

SPAN = 1024


def lengths(docs: DataFrame, by: Sequence[str] = (), text_col: str = "text",
            vocabulary: str = VOCABULARY) -> DataFrame:
    """(by..., tokens): the encoded length of every document, no end mark."""
    keys = [F.col(k).alias(f"key{i}") for i, k in enumerate(by)]
    raw = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("raw")
    source = docs.select(*keys, raw)
    kept = [f"key{i}" for i in range(len(by))]
    schema = "".join(f"{k} {source.schema[k].dataType.simpleString()}, " for k in kept) + "tokens long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = np.array([len(document_ids(raw, vocabulary, None)) for raw in b.column("raw").to_pylist()],
                         dtype=np.int64)
            yield pa.RecordBatch.from_arrays([b.column(k) for k in kept] + [pa.array(n)], names=[*kept, "tokens"])

    out = map_batches(source, run, schema)
    return out.toDF(*by, unused(by, "tokens"))


def histogram(docs: DataFrame, by: Sequence[str] = (), text_col: str = "text",
              vocabulary: str = VOCABULARY) -> DataFrame:
    """(by..., tokens, n_docs)."""
    rows = lengths(docs, by, text_col, vocabulary)
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias(unused(by, "n_docs")))


def limits(hist: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """For every length L that occurs: docs_from and tokens_from (documents of L or
    more tokens), truncated_tokens (sum of min(length, L)), share_within (documents
    of at most L tokens, as a share)."""
    keys = [f"k{i}" for i in range(len(by))]
    rows = hist.select(*[F.col(c).alias(k) for c, k in zip(hist.columns, [*keys, "tokens", "n_docs"])])
    rows = rows.withColumn("span", F.floor(F.col("tokens") / SPAN)).withColumn(
        "n_tokens", F.col("n_docs") * F.col("tokens"))
    spans = rows.groupBy(*keys, "span").agg(F.sum("n_docs").alias("d"), F.sum("n_tokens").alias("t"))
    beyond = Window.partitionBy(*keys).orderBy(F.desc("span")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    spans = spans.select(*keys, "span", F.coalesce(F.sum("d").over(beyond), F.lit(0)).alias("d_beyond"),
                         F.coalesce(F.sum("t").over(beyond), F.lit(0)).alias("t_beyond"),
                         F.sum("d").over(whole).alias("d_all"), F.sum("t").over(whole).alias("t_all"))
    inside = Window.partitionBy(*keys, "span").orderBy(F.desc("tokens")).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.select(*keys, "tokens", "n_docs", "span", F.sum("n_docs").over(inside).alias("d"),
                       F.sum("n_tokens").over(inside).alias("t"))
    left, right = rows.alias("l"), spans.alias("r")
    same = F.col("l.span") == F.col("r.span")
    for k in keys:
        same = same & F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
    docs_from, tokens_from = F.col("d") + F.col("d_beyond"), F.col("t") + F.col("t_beyond")
    out = left.join(right, same).select(
        *[F.col(f"l.{k}") for k in keys], "tokens", "n_docs",
        docs_from.alias("docs_from"), tokens_from.alias("tokens_from"),
        (F.col("t_all") - tokens_from + docs_from * F.col("tokens")).alias("truncated_tokens"),
        ((F.col("d_all") - docs_from + F.col("n_docs")) / F.col("d_all")).alias("share_within"))
    return out.toDF(*by, *[unused(by, c) for c in out.columns[len(by):]])


def truncated_total(table: DataFrame, limit: int) -> DataFrame:
    """Tokens left at any limit, from ``limits`` without keys: one row."""
    left = F.least(F.col("tokens"), F.lit(limit)) * F.col("n_docs")
    return table.agg(F.coalesce(F.sum(left), F.lit(0)).alias("truncated_tokens"))


def quantile(table: DataFrame, share: float) -> DataFrame:
    """The smallest length that at least ``share`` of the documents don't exceed: one row."""
    return table.filter(F.col("share_within") >= share).agg(F.min("tokens").alias("tokens"))
