"""Ranked lexical search: item tiles times document tiles by dense matrix products.

The queries (items) are a stated set; every document is scored for each of them, in blocks.  A
block holds items with at most ``BLOCK_TERMS`` distinct terms together (or a single item); its
vocabulary is all that is broadcast.  For a block, one pass over the texts writes, for each
document, its number of terms and how often it holds each term of the vocabulary.  The corpus
counts (N, L and the document frequencies) are sums over that table, so they cover every
document and need no second tokenising.

Scoring multiplies tiles: an item tile of ``ITEMS`` items has a compact vocabulary of its own,
the distinct terms of just those items; its weights are one dense matrix, the impacts of
``DOCS`` documents on that vocabulary another, in float64, and BLAS multiplies them.  All
factors are integers.  A vocabulary is cut so that a tile's sums stay below 2^53 (terms times the
greatest weight times the greatest impact), where float64 is exact, and tiles add up as 64-bit
integers.  So scores are exact whatever the order of additions.

Top-k is tie-safe: a tile passes on whatever reaches the least score that a task still keeps for
an item, equal scores included, and the task keeps the ``k`` best by score, then id.  Tasks'
lists meet in two steps, first within a number of groups of tasks for each item, then for the item, so no
window sees more than a bounded share of them.

Null texts and texts without a term are in no ranking (and not in N); a null doc_id ranks behind
equal scores; repeated documents rank each; repeated items get a list each; fewer than ``k`` documents with
a score give fewer rows, an empty table none.  Other columns are ignored, whatever their names.
Long texts are tokenised in pieces.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - pa.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import LAST_ID, batch, map_batches, sliced, task_id, texts, written

#: Fixed values of the score.
WEIGHT_SCALE, IMPACT_SCALE, TF_SCALE, LENGTH_SCALE, FLAT, SLOPE = 1000, 1_000_000_000, 1000, 20, 50, 50
TOP = 50
#: Distinct terms in a block of items; items and documents of a tile; bytes of text in a batch.
BLOCK_TERMS, ITEMS, DOCS, PIECE = 1 << 16, 256, 512, 1 << 21
#: Columns of a tile's matrices.
TILE_TERMS = 1 << 13
#: Groups in which the tasks' lists of an item first meet.
GROUPS = 64
EXACT = 1 << 53

TERM = re.compile(rb"[0-9A-Za-z\x80-\xFF]+")      # bytes of a UTF-8 text: all beyond ASCII belong to terms
GAP = re.compile(rb"[^0-9A-Za-z\x80-\xFF]")


def counted(raw: bytes) -> Counter:
    """How often a text holds each of its terms."""
    out, at = Counter(), 0
    while at < len(raw):
        gap = GAP.search(raw, at + PIECE) if at + PIECE < len(raw) else None
        end = gap.start() if gap else len(raw)
        out.update(TERM.findall(raw[at:end].lower()))      # bytes: A-Z only
        at = end
    return out


def item_blocks(items: DataFrame, id_col: str = "item_id", text_col: str = "text",
                limit: int = BLOCK_TERMS) -> Iterator[list[tuple[int, list[bytes]]]]:
    """Blocks of (item_id, its distinct terms); the driver holds one at a time."""
    rows = items.select(F.col(id_col).cast("long"), F.col(text_col).cast("string").cast("binary"))
    block, terms = [], set()
    for item, raw in rows.toLocalIterator():
        own = set(counted(bytes(raw or b"")))
        if not own:
            continue
        if block and len(terms | own) > limit:
            yield block
            block, terms = [], set()
        block.append((item, sorted(own)))
        terms |= own
    if block:
        yield block


def term_counts(docs: DataFrame, vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, terms, tfs) of the documents with a term: n counts all their terms, terms and tfs
    (32-bit integers) are places in the broadcast ``vocabulary`` and occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {t: i for i, t in enumerate(vocabulary.value)}
        for b in batches:
            for i, j in sliced(b.column("raw"), PIECE):
                ids, ns, terms, tfs = [], [], [], []
                for doc, raw in zip(b.column("doc_id").slice(i, j - i).to_pylist(), b.column("raw").slice(i, j - i)):
                    found = counted(raw.as_py())
                    if not found:
                        continue
                    held = [(place[t], c) for t, c in found.items() if t in place]
                    ids.append(doc), ns.append(found.total())
                    terms.append(np.array([p for p, _ in held], np.int32).tobytes())
                    tfs.append(np.array([c for _, c in held], np.int32).tobytes())
                if ids:
                    yield batch(doc_id=pa.array(ids, pa.int64()), n=pa.array(ns, pa.int64()),
                                terms=pa.array(terms, pa.binary()), tfs=pa.array(tfs, pa.binary()))

    return map_batches(texts(docs, id_col, text_col), run, "doc_id long, n long, terms binary, tfs binary")


def document_frequencies(counts: DataFrame, size: int) -> np.ndarray:
    """In how many documents of ``counts`` each of ``size`` terms occurs: sums by task, then by term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for b in batches:
            df += np.bincount(np.frombuffer(b"".join(b.column("terms").to_pylist()), np.int32), minlength=size)
        held = np.flatnonzero(df)
        yield batch(term=held, df=df[held])

    out = np.zeros(size, np.int64)
    for term, df in map_batches(counts.select("terms"), run, "term long, df long").groupBy("term").agg(
            F.sum("df")).collect():                       # a row for each term of a block at most
        out[term] = df
    return out


def weights(df: np.ndarray, documents: int) -> np.ndarray:
    return np.array([math.floor(WEIGHT_SCALE * math.log((2 * documents + 2) / (2 * int(d) + 1))) for d in df], np.int64)


def impacts(tf: np.ndarray, n: np.ndarray, documents: int, total: int) -> np.ndarray:
    """Of each occurrence count, with n the terms of its document."""
    distinct, where = np.unique(n, return_inverse=True)
    m = np.array([100 - FLAT + SLOPE * int(x) * documents // total for x in distinct], np.int64)[where]
    return IMPACT_SCALE * tf // (TF_SCALE * tf + LENGTH_SCALE * m)


def tiles(block: list[tuple[int, list[bytes]]], place: dict[bytes, int], weight: np.ndarray) -> list[tuple]:
    """(first item, items, terms, weights): the items of a tile and a part of its compact vocabulary, as
    a sparse matrix (row, column, weight); parts keep the sums below 2^53."""
    most = IMPACT_SCALE // TF_SCALE                       # no impact exceeds it
    width = max(1, min(TILE_TERMS, (EXACT - 1) // (most * max(1, int(weight.max(initial=1))))))
    out = []
    for first in range(0, len(block), ITEMS):
        some = block[first:first + ITEMS]
        rows = np.repeat(np.arange(len(some)), [len(t) for _, t in some])
        cells = np.array([place[t] for _, terms in some for t in terms], np.int64)
        vocabulary, column = np.unique(cells, return_inverse=True)
        for at in range(0, len(vocabulary), width):
            part = (column >= at) & (column < at + width)
            out.append((first, len(some), vocabulary[at:at + width], rows[part], column[part] - at, weight[cells[part]]))
    return out


class _Best:
    """The ``k`` best documents of each item that a task has seen: score, then id."""

    def __init__(self, items: int, k: int):
        self.k, self.floor = k, np.zeros(items, np.int64)
        self.held = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in range(items)]

    def add(self, first: int, scores: np.ndarray, ids: np.ndarray) -> None:
        """``scores`` (documents x items from ``first``)."""
        floor = self.floor[first:first + scores.shape[1]]
        # below the floor k better ones are known; at it, the id decides
        hits = (scores >= floor) & (scores > 0)
        for i in np.flatnonzero(hits.any(axis=0)).tolist():
            rows = np.flatnonzero(hits[:, i])
            s, d = (np.concatenate(x) for x in zip(self.held[first + i], (scores[rows, i], ids[rows])))
            if len(s) > self.k:
                order = np.lexsort((d, -s))[:self.k]
                s, d = s[order], d[order]
                self.floor[first + i] = s[-1]
            self.held[first + i] = s, d


def _scored(counts: DataFrame, parts, size: int, ids, documents: int, total: int, k: int) -> DataFrame:
    """Each task's ``k`` best: (item, item_id, task, doc_id, score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(len(ids.value), k)
        for b in batches:
            for at in range(0, len(b), DOCS):
                some = b.slice(at, DOCS)
                term = some.column("terms").to_pylist()
                row = np.repeat(np.arange(len(some)), [len(t) // 4 for t in term])
                term = np.frombuffer(b"".join(term), np.int32)
                tf = np.frombuffer(b"".join(some.column("tfs").to_pylist()), np.int32).astype(np.int64)
                impact = impacts(tf, some.column("n").to_numpy()[row], documents, total)
                doc = pa.compute.fill_null(some.column("doc_id"), LAST_ID).to_numpy()
                scores, begun = None, None
                column_of = np.full(size, -1, np.int64)
                for first, n, vocabulary, r, c, w in parts.value:
                    if begun != first:
                        if scores is not None:
                            best.add(begun, scores, doc)
                        scores, begun = np.zeros((len(some), n), np.int64), first
                    column_of[vocabulary] = np.arange(len(vocabulary))
                    column = column_of[term]
                    column_of[vocabulary] = -1
                    held = column >= 0
                    left = np.zeros((len(some), len(vocabulary)))
                    left[row[held], column[held]] = impact[held]
                    right = np.zeros((len(vocabulary), n))
                    right[c, r] = w
                    scores += (left @ right).astype(np.int64)
                if scores is not None:
                    best.add(begun, scores, doc)
        for i, (s, d) in enumerate(best.held):
            if len(s):
                order = np.lexsort((d, -s))[:k]
                yield batch(item=np.full(len(order), i), item_id=pa.array([ids.value[i]] * len(order), pa.int64()),
                            task=np.full(len(order), task_id()), doc_id=d[order], score=s[order])

    return map_batches(counts, run, "item long, item_id long, task long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", limit: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item."""
    spark = docs.sparkSession
    found = None
    for block in item_blocks(items, item_col, item_text_col, limit):
        vocabulary = sorted({t for _, terms in block for t in terms})
        counts = written(term_counts(docs, spark.sparkContext.broadcast(vocabulary), id_col, text_col), "term-counts")
        documents, total = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not documents:
            break
        weight = weights(document_frequencies(counts, len(vocabulary)), documents)
        parts = tiles(block, {t: i for i, t in enumerate(vocabulary)}, weight)
        lists = _scored(counts, spark.sparkContext.broadcast(parts), len(vocabulary),
                        spark.sparkContext.broadcast([item for item, _ in block]), documents, total, k)
        best = F.row_number().over(Window.partitionBy("item", F.pmod("task", F.lit(GROUPS))).orderBy(F.desc("score"), "doc_id"))
        lists = lists.withColumn("n", best).filter(F.col("n") <= k)
        rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), "doc_id"))
        ranked = lists.withColumn("rank", rank).filter(F.col("rank") <= k).select(
            "item_id", F.col("rank").cast("int").alias("rank"),
            F.when(F.col("doc_id") != LAST_ID, F.col("doc_id")).alias("doc_id"), "score")
        found = ranked if found is None else found.unionByName(ranked)
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long") if found is None else found


#: DuckDB: every item against every document that holds one of its terms.
ORACLE = f"""
WITH term AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS t FROM documents),
tf AS (SELECT doc_id, t, count(*) AS tf FROM term GROUP BY doc_id, t),
len AS (SELECT doc_id, sum(tf) AS n FROM tf GROUP BY doc_id),
total AS (SELECT count(*) AS docs, sum(n) AS terms FROM len),
df AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
       FROM tf CROSS JOIN total GROUP BY t),
item AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS t FROM benchmark),
scored AS (
    SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * CAST(50 + (50 * n * docs) // terms AS BIGINT)))) AS BIGINT) AS score
    FROM item JOIN tf USING (t) JOIN df USING (t) JOIN len USING (doc_id) CROSS JOIN total GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER w AS INTEGER) AS rank, doc_id, score FROM scored WHERE score > 0
WINDOW w AS (PARTITION BY item_id ORDER BY score DESC, doc_id) QUALIFY row_number() OVER w <= {TOP}
"""
