"""What the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import shared_path
from tidemark.sources.tables import read_table

#: A null document id sorts behind every other one.
LAST_ID = (1 << 63) - 1


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the cluster's shared folder and read again: its lineage
    is cut, and the rows survive the loss of any executor."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, raw): ids as long, texts as UTF-8 bytes, null as empty; all other
    columns, whatever their names, are left behind."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("raw"))


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                schema: str) -> DataFrame:
    return df.mapInArrow(fn, schema)


def batch(**columns) -> pa.RecordBatch:
    """A record batch of named pyarrow arrays, numpy arrays or lists."""
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c) for c in columns.values()],
        names=list(columns))


def sliced(column: pa.Array, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of a binary column that hold at most ``limit`` bytes each (or one row)."""
    start = size = 0
    for i, n in enumerate(pa.compute.binary_length(column).to_pylist()):
        if i > start and size + (n or 0) > limit:
            yield start, i
            start, size = i, 0
        size += n or 0
    if len(column) > start:
        yield start, len(column)


def task_id() -> int:
    """The partition that this task computes: the same if it is run again."""
    context = TaskContext.get()
    return context.partitionId() if context else 0


def total_bytes(docs: DataFrame, text_col: str) -> int:
    """Bytes of text; sizes the number of buckets, nothing else."""
    return docs.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0))).first()[0]
