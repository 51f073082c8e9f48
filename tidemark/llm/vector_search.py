"""Exact top-k by inner product with a vector-approximation file.

Vectors are integers (each component x becomes floor(``SCALE`` * x)).  Each dimension is cut
into ``CELLS`` intervals at the quantiles of a sample of ``SAMPLE`` vectors; the outer ends
are the least and greatest value of all vectors, so every row has a cell.  The file holds,
for each distinct vector, one byte for each dimension.

1. Scan.  A block of queries goes to all tasks, which read the whole file.  From the two
   ends of its cells, a vector's score with a query has a lower and an upper bound.  A task
   keeps each query's k + 1 greatest lower bounds so far and passes on what may still reach
   them; across tasks, what lies under a query's (k + 1)th lower bound goes.
2. Exact vectors are read in the order of the bounds: first each query's k + 1 candidates
   with the greatest upper bounds; then only those whose upper bound is not under the
   (k + 1)th exact score of these.  After that the result is certain.

Equal vectors are one entry of the file, with the k + 1 smallest of their ids: no more can
be returned.  Queries come in blocks of about ``BLOCK``, whose number grows with them.

Scores are exact integers: longs where a bound on the components proves that a long holds
them, else decimals.  A component's integer is held within +-``MOST`` (2^55), and a score that
no long holds is returned as the nearest long, but ranked by its own value.

Vectors that are null or empty, or hold null or non-finite components, and rows without an
id, take no part.  Repeated rows count once; of different vectors with the same id the least
counts.  A query is only compared with vectors of its length.  An empty table gives no row;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import batch, map_batches, written

SCALE = 256
CELLS = 64
SAMPLE = 4096
BLOCK = 4096
#: Vectors scored at a time.
ROWS = 1024
#: Integers of components: products of two of them, summed, fit a decimal of 38 digits.
MOST = 1 << 55
LONG = (-(1 << 63), (1 << 63) - 1)


def integers(table: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): the valid vectors as arrays of longs, one row for each id."""
    vector = F.col(vector_col)
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    rows = table.filter(F.col(id_col).isNotNull() & vector.isNotNull() & (F.size(vector) > 0) & ~bad).select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.transform(vector, lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(float(MOST))),
                                                         F.lit(-float(MOST)))).cast("long")).alias("v"))
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def entries(vectors: DataFrame, k: int) -> DataFrame:
    """(entry, v, ids): the distinct vectors, each with its k + 1 smallest ids; entry is the least."""
    n = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    return vectors.withColumn("n", n).filter(F.col("n") <= k + 1).groupBy("v").agg(
        F.sort_array(F.collect_list("vec_id")).alias("ids")).select(F.col("ids")[0].alias("entry"), "v", "ids")


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


class Cells:
    """The cut points of each dimension, and the ends of each cell."""

    def __init__(self, sample: np.ndarray, least: np.ndarray, greatest: np.ndarray, cells: int = CELLS):
        at = np.linspace(0, 1, cells + 1)[1:-1]
        self.cuts = np.ceil(np.quantile(sample, at, axis=0)).astype(np.int64).T      # dimension x cut
        self.low = np.concatenate([least[:, None], self.cuts], axis=1).astype(np.float64)
        self.high = np.concatenate([self.cuts - 1, greatest[:, None]], axis=1).astype(np.float64)
        self.low = np.minimum(self.low, self.high.max(axis=1, keepdims=True))
        self.high = np.maximum(self.high, self.low)

    def of(self, vectors: np.ndarray) -> np.ndarray:
        out = np.empty(vectors.shape, dtype=np.uint8)
        for d, cuts in enumerate(self.cuts):
            out[:, d] = np.searchsorted(cuts, vectors[:, d], "right")
        return out

    def bounds(self, cells: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(lower, upper) of each query's score with each vector; a margin covers rounding."""
        d = np.arange(cells.shape[1])
        low, high = self.low[d, cells], self.high[d, cells]
        centre, half = (low + high) / 2, (high - low) / 2
        size = np.abs(queries)
        middle, reach = queries @ centre.T, size @ half.T
        reach += 1e-12 * (size @ (np.abs(centre) + half).T) + 1e-9
        return middle - reach, middle + reach


def _cells(vectors: DataFrame, dim: int) -> Cells:
    ends = vectors.select(F.posexplode("v").alias("d", "x")).groupBy("d").agg(
        F.min("x").alias("a"), F.max("x").alias("b")).orderBy("d").collect()         # a row for each dimension
    sample = vectors.orderBy(F.xxhash64("entry"), "entry").limit(SAMPLE).select("v").collect()
    return Cells(np.array([r.v for r in sample], dtype=np.int64), np.array([r.a for r in ends], dtype=np.int64),
                 np.array([r.b for r in ends], dtype=np.int64))


def approximations(vectors: DataFrame, cells: Cells, dim: int) -> DataFrame:
    """(entry, cells): the file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                coded = cells.of(_matrix(b.column("v"), dim))
                yield batch(entry=b.column("entry"), cells=pa.array([r.tobytes() for r in coded], pa.binary()))

    return map_batches(vectors.select("entry", "v"), run, "entry long, cells binary")


def _scan(file: DataFrame, cells: Cells, dim: int, ids: list[int], queries: np.ndarray, keep: int) -> DataFrame:
    """(query_id, entry, lower, upper) of what may be among a query's best."""
    sent = file.sparkSession.sparkContext.broadcast((cells, np.array(ids, dtype=np.int64), queries.astype(np.float64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, ids, queries = sent.value
        best = np.full((len(ids), keep), -np.inf)                # greatest lower bounds so far
        for b in batches:
            entry = b.column("entry").to_numpy()
            coded = np.frombuffer(b"".join(b.column("cells").to_pylist()), np.uint8).reshape(-1, dim)
            for at in range(0, len(entry), ROWS):
                lower, upper = cells.bounds(coded[at:at + ROWS], queries)
                both = np.concatenate([best, lower], axis=1)
                best = -np.partition(-both, keep - 1, axis=1)[:, :keep]
                q, e = np.nonzero(upper >= best.min(axis=1)[:, None])
                yield batch(query_id=ids[q], entry=entry[at + e], lower=lower[q, e], upper=upper[q, e])

    return map_batches(file, run, "query_id long, entry long, lower double, upper double")


def _exact(candidates: DataFrame, vectors: DataFrame, queries: DataFrame, wide: bool) -> DataFrame:
    """(query_id, entry, score) of candidates (query_id, entry); ``wide``: a long may not hold a score."""
    factor, total = ("decimal(18,0)", "decimal(38,0)") if wide else ("long", "long")
    score = F.aggregate(F.zip_with("q", "v", lambda a, b: a.cast(factor) * b.cast(factor)), F.lit(0).cast(total),
                        lambda s, x: (s + x).cast(total))
    return candidates.join(queries, "query_id").join(vectors.select("entry", "v"), "entry").select(
        "query_id", "entry", score.alias("score"))


def search(table: DataFrame, k: int, is_query, id_col: str = "vec_id", vector_col: str = "embedding",
           scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows of each row for which ``is_query``,
    a condition on vec_id, holds; greatest score first, then smallest id."""
    spark = table.sparkSession
    vectors = written(integers(table, id_col, vector_col, scale), "vectors")
    distinct = written(entries(vectors, k), "vector-entries")
    queries = vectors.filter(is_query).select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"))
    keep, found, any_wide = k + 1, [], False
    for dim, n in sorted((r.dim, r.n) for r in queries.groupBy(F.size("q").alias("dim")).agg(
            F.count(F.lit(1)).alias("n")).collect()):                                 # a row for each length
        same = distinct.filter(F.size("v") == dim)
        cells = _cells(same, dim)
        wide = dim * int(max(abs(cells.low).max(initial=0), abs(cells.high).max(initial=0)) + 1) ** 2 >= 1 << 62
        any_wide |= wide
        file = written(approximations(same, cells, dim), "approximations")
        blocks = -(-n // BLOCK)
        for block in range(blocks):
            mine = queries.filter((F.size("q") == dim) & (F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == block))
            rows = mine.collect()
            if not rows:
                continue
            seen = written(_scan(file, cells, dim, [r.query_id for r in rows], np.array([r.q for r in rows]), keep),
                           "vector-candidates")
            by = Window.partitionBy("query_id")
            floor = seen.withColumn("n", F.row_number().over(by.orderBy(F.desc("lower")))).filter(F.col("n") <= keep) \
                .groupBy("query_id").agg(F.min("lower").alias("floor"), F.count(F.lit(1)).alias("n"))
            left = seen.join(floor, "query_id").filter((F.col("n") < keep) | (F.col("upper") >= F.col("floor")))
            order = F.row_number().over(by.orderBy(F.desc("upper"), "entry"))
            left = written(left.select("query_id", "entry", "upper", order.alias("n")), "vectors-to-read")
            first = written(_exact(left.filter(F.col("n") <= keep), same, mine, wide), "vectors-read")
            sure = first.groupBy("query_id").agg(F.min("score").alias("sure"))
            rest = left.filter(F.col("n") > keep).join(sure, "query_id").filter(F.col("upper") >= F.col("sure"))
            found.append(first.unionByName(_exact(rest, same, mine, wide)))
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    best = found[0]
    for more in found[1:]:
        best = best.unionByName(more)
    n = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "entry"))
    best = best.withColumn("n", n).filter(F.col("n") <= keep).drop("n")
    ids = best.join(distinct.select("entry", "ids"), "entry").select(
        "query_id", F.explode("ids").alias("vec_id"), "score").filter("vec_id != query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    score = F.col("score")
    if any_wide:
        score = F.greatest(F.least(score, F.lit(LONG[1])), F.lit(LONG[0])).cast("long").alias("score")
    return ids.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", score)


#: DuckDB: every query against every row.
ORACLE = f"""
WITH v AS (
    SELECT vec_id, min([CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding]) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    GROUP BY vec_id),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM scored
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 5
"""
