"""Benchmark decontamination by the q-gram lemma and banded alignment.

Item and text are compared in lower case, character by character.  An item of m
characters occurs in a text if some stretch of it can be had with at most
k = min(m * ``rate``, m // q - 1) edits.  A stretch with k edits shares at least
m + 1 - q (k + 1) q-grams with the item, all on diagonals (text position minus item
position) that differ by k at most.

1. Each text is scanned once: its q-grams are looked up, first in a bit table, then in
   the sorted grams of the items; each hit has a diagonal.
2. Hits are counted in diagonal bands of a power of two above k, which overlap by k, so
   that any k + 1 neighbouring diagonals lie in one band.  Bands with fewer hits than the
   lemma asks for are left; no occurrence is lost.
3. The text along each other band is aligned with the item, in a band of the diagonals
   that its edits can reach; the start is found by aligning backwards from the best end, for inexact matches.

The benchmark is read in blocks of at most ``BLOCK_CHARS`` characters on average, whose
number grows with it: each block is sent to all tasks, and documents are scanned once for
each.  Texts are scanned whole, slice by slice.

Items of fewer than ``MIN_CHARS`` characters are found only as they are, at word borders (no
letter or digit on either side).  Items that are null or have fewer than a q-gram's characters
can't tell a leak from common words and are not searched.  Null and empty texts have no match; repeated rows have
the same matches; a null id is returned as null; with an empty benchmark or table there is
no row; extra columns are ignored (``clean`` keeps them).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batch, map_batches

Q = 8
RATE = 0.1
MIN_CHARS = 24
BLOCK_CHARS = 2_000_000
#: Hits counted at a time; more are counted in overlapping parts of the text.
HITS = 1 << 21
#: Characters of text scanned at a time; a longer text is scanned in overlapping parts.
PART = 1 << 20
#: Cells that a batch of alignments may hold.
CELLS = 1 << 21
BITS = 20

U = np.uint64
FAR = 1 << 20


def folded(text: str) -> np.ndarray:
    """Lower-case code points."""
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")


def grams(points: np.ndarray) -> np.ndarray:
    """Each character q-gram as a word: a byte for each character, folded from its code point
    (two grams may look alike; the alignment compares the characters themselves)."""
    small = (points ^ (points >> 8) ^ (points >> 16)).astype(np.uint8)
    n = len(small) - Q + 1
    if n <= 0:
        return np.empty(0, dtype=U)
    return np.ndarray((n,), "<u8", np.concatenate([small, np.zeros(8, np.uint8)]), strides=(1,))


def _cell(gram: np.ndarray) -> np.ndarray:
    return (gram * U(0x9E3779B97F4A7C15)) >> U(64 - BITS)


def align(items: list[np.ndarray], parts: list[np.ndarray], widths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(edits, end) of each item's best stretch in its part, over the diagonals 0 to width - 1;
    the leftmost of the best ends."""
    n, m, w = len(items), max(map(len, items)), int(widths.max())
    item = np.zeros((n, m), dtype=np.int32)
    text = np.full((n, m + w + 1), -1, dtype=np.int32)
    for i, (a, b) in enumerate(zip(items, parts)):
        item[i, :len(a)] = a
        b = b[:m + w + 1]
        text[i, :len(b)] = b
    sizes = np.array([len(a) for a in items])
    ends = np.array([len(b) for b in parts])[:, None]
    step = np.arange(w, dtype=np.int32)
    wall = np.where(step[None, :] < widths[:, None], 0, FAR).astype(np.int32)
    cost = wall.copy()
    cost[step[None, :] > ends] = FAR
    best, end = np.full(n, FAR), np.zeros(n, dtype=np.int64)
    for row in range(1, m + 1):
        change = cost + (item[:, row - 1:row] != text[:, row - 1:row - 1 + w])
        drop = np.full_like(cost, FAR)
        drop[:, :-1] = cost[:, 1:] + 1
        cost = np.minimum(np.minimum(change, drop) + wall, FAR)
        cost = np.minimum.accumulate(cost - step, axis=1) + step
        cost[step[None, :] + row > ends] = FAR
        done = np.flatnonzero(sizes == row)
        if len(done):
            at = np.argmin(cost[done], axis=1)
            best[done], end[done] = cost[done, at], at + row
    return best, end


def start_of(item: np.ndarray, text: np.ndarray, edits: int) -> int:
    """Where the stretch that ends with ``text`` and has so many edits starts; the first such place."""
    if not edits:
        return len(text) - len(item)
    text = text[::-1]
    cost = step = np.arange(len(text) + 1)
    for row, c in enumerate(item[::-1], 1):
        new = np.concatenate(([row], np.minimum(cost[1:] + 1, cost[:-1] + (text != c))))
        cost = np.minimum.accumulate(new - step) + step
    return len(text) - int(np.flatnonzero(cost == edits)[-1])


def bounded(text: str, item: str, at: int) -> int:
    """The first occurrence from ``at`` with no letter or digit beside it; -1 without one."""
    while at >= 0:
        end = at + len(item)
        if not (at and text[at - 1].isalnum() and item[0].isalnum()) and \
                not (end < len(text) and text[end].isalnum() and item[-1].isalnum()):
            return at
        at = text.find(item, at + 1)
    return -1


class Matcher:
    """Items of one block of the benchmark, ready to be searched for."""

    def __init__(self, items: list[str], rate: float):
        self.texts = [t.lower() for t in items]
        self.items = [folded(t) for t in items]
        self.edits = np.array([min(int(len(p) * rate), len(p) // Q - 1) for p in self.items], dtype=np.int64)
        sizes = np.array([len(p) for p in self.items], dtype=np.int64)
        self.sizes = sizes
        self.edits[sizes < MIN_CHARS] = 0
        self.least = sizes + 1 - Q * (self.edits + 1)
        self.shift = np.ceil(np.log2(self.edits + 1)).astype(np.int64)          # band: 2^shift > k diagonals
        self.shift += (1 << self.shift) <= self.edits
        gram = [grams(p) for p in self.items]
        all_ = np.concatenate(gram) if gram else np.empty(0, U)
        owner = np.repeat(np.arange(len(gram)), [len(g) for g in gram])
        place = np.concatenate([np.arange(len(g)) for g in gram]) if gram else owner
        order = np.argsort(all_, kind="stable")
        self.owner, self.place = owner[order], place[order]
        self.gram, first = np.unique(all_[order], return_index=True)
        self.first = np.append(first, len(all_))
        self.table = np.zeros(1 << BITS, dtype=bool)
        self.table[_cell(self.gram)] = True
        self.longest = int((sizes + 3 * self.edits + 2).max()) if len(sizes) else 0

    def bands(self, gram: np.ndarray, text_ends: np.ndarray) -> tuple[np.ndarray, ...]:
        """(text, item, band) with enough shared grams; ``text_ends``: ends of the texts whose
        characters, in a row, ``gram`` comes from (grams across a border only add hits)."""
        at = np.flatnonzero(self.table[_cell(gram)])
        found = np.searchsorted(self.gram, gram[at])
        found = np.minimum(found, len(self.gram) - 1)
        same = self.gram[found] == gram[at]
        at, found = at[same], found[same]
        parts = [self._counted(at[i:j], found[i:j], text_ends) for i, j in self._slices(at, found)]
        if len(parts) == 1:
            return parts[0]
        # an occurrence may show in two parts
        both = np.unique(np.stack([np.concatenate(x) for x in zip(*parts)]), axis=1)
        return both[0], both[1], both[2]

    def _slices(self, at: np.ndarray, found: np.ndarray) -> Iterator[tuple[int, int]]:
        """Ranges of grams with ``HITS`` hits or so each, which overlap by the longest occurrence."""
        hits = np.cumsum(self.first[found + 1] - self.first[found])
        start = 0
        while True:
            before = hits[start - 1] if start else 0
            end = int(np.searchsorted(hits, before + HITS, "right"))
            if end >= len(at):
                yield start, len(at)
                return
            # at least as far again as the parts overlap
            end = max(end, int(np.searchsorted(at, at[start] + 2 * self.longest, "right")))
            yield start, end
            if end >= len(at):
                return
            start = int(np.searchsorted(at, at[end] - self.longest))

    def _counted(self, at: np.ndarray, found: np.ndarray, text_ends: np.ndarray) -> tuple[np.ndarray, ...]:
        """``bands`` of grams at ``at``, which are the items' grams ``found``."""
        n = self.first[found + 1] - self.first[found]
        hit = np.repeat(self.first[found] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        item, at = self.owner[hit], np.repeat(at, n)
        text = np.searchsorted(text_ends, at, "right")
        diagonal = at - self.place[hit] + FAR                    # not below 0
        shift = self.shift[item]
        band = diagonal >> shift
        both = (diagonal & ((1 << shift) - 1)) < self.edits[item]
        key = (text * len(self.items) + item) << 24 | band
        key = np.concatenate([key, key[both] - 1])
        order = np.argsort(key)
        key = key[order]
        if not len(key):
            return key, key, key
        heads = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        counts = np.diff(np.append(heads, len(key)))
        enough = counts >= self.least[(key[heads] >> 24) % len(self.items)]
        # of those, an item's gram counts once, however often the text has it there
        inside = np.repeat(enough, counts)
        place = np.concatenate([self.place[hit], self.place[hit][both]])[order][inside]
        once = np.repeat(np.flatnonzero(enough), counts[enough]) << 24 | place
        band_of, counts = np.unique(np.unique(once) >> 24, return_counts=True)
        key = key[heads[band_of]]
        item = (key >> 24) % len(self.items)
        good = counts >= self.least[item]
        return ((key >> 24) // len(self.items))[good], item[good], (key & 0xFFFFFF)[good]

    def search(self, texts: list[str | None]) -> dict[tuple[int, int], tuple[int, int, int]]:
        """{(text, item): (edits, start, end)}, the fewest edits, then the first start."""
        points = [folded(t or "") for t in texts]
        found: dict[tuple[int, int], tuple[int, int, int]] = {}
        waiting: list[tuple[int, int, int]] = []                 # (text, item, first diagonal)
        group: list[int] = []
        size = 0

        def scan() -> None:
            ends = np.cumsum([len(points[i]) for i in group])
            starts = ends - [len(points[i]) for i in group]
            text, item, band = self.bands(grams(np.concatenate([points[i] for i in group])), ends)
            first = (band << self.shift[item]) - FAR - starts[text]
            waiting.extend(zip([group[t] for t in text.tolist()], item.tolist(), first.tolist()))

        for i, p in enumerate(points):
            if len(p) > PART:                                    # in parts that overlap by an occurrence
                for lo in range(0, len(p), PART):
                    part = p[lo:lo + PART + self.longest]
                    text, item, band = self.bands(grams(part), np.array([len(part)]))
                    first = (band << self.shift[item]) - FAR + lo
                    waiting.extend((i, a, b) for a, b in zip(item.tolist(), first.tolist()))
                continue
            if size + len(p) > PART:
                scan()
                group, size = [], 0
            group.append(i)
            size += len(p)
        if size:
            scan()
        low = {i: texts[i].lower() for i in {w[0] for w in waiting}}
        for i, item in sorted({w[:2] for w in waiting}):
            at = low[i].find(self.texts[item])                   # an alignment without edits
            if self.sizes[item] < MIN_CHARS:
                at = bounded(low[i], self.texts[item], at)
            if at >= 0:
                found[i, item] = (0, at, at + int(self.sizes[item]))
        inexact = [w for w in set(waiting) if w[:2] not in found and self.sizes[w[1]] >= MIN_CHARS]
        self._verify(points, inexact, found)
        return found

    def _verify(self, points: list[np.ndarray], waiting: list[tuple[int, int, int]],
                found: dict[tuple[int, int], tuple[int, int, int]]) -> None:
        """Aligns items with the text along their bands and adds those within their edits."""
        waiting = sorted(waiting, key=lambda x: (len(self.items[x[1]]), x))
        at = 0
        while at < len(waiting):
            some, cells = [], 0
            while at < len(waiting):
                i, item, first = waiting[at]
                k = int(self.edits[item])
                width = (1 << int(self.shift[item])) + 3 * k + 1         # k on either side of the band
                size = width + int(self.sizes[item])
                if some and cells + size > CELLS:
                    break
                some.append((i, item, first - k, width))
                cells += size
                at += 1
            parts, lows = [], []
            for i, item, low, width in some:
                lo = max(low, 0)
                parts.append(points[i][lo:max(low + width + int(self.sizes[item]), 0)])
                lows.append(lo)
            widths = np.array([max(1, w + min(low, 0)) for _, _, low, w in some])
            edits, end = align([self.items[x[1]] for x in some], parts, widths)
            good = [c for c in range(len(some)) if edits[c] <= self.edits[some[c][1]]]
            if not good:
                continue
            start = [start_of(self.items[some[c][1]], parts[c][:end[c]], int(edits[c])) for c in good]
            for c, s in zip(good, start):
                i, item = some[c][:2]
                row = (int(edits[c]), lows[c] + int(s), lows[c] + int(end[c]))
                if (i, item) not in found or row < found[i, item]:
                    found[i, item] = row


def _blocks(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple[int | None, str]]]:
    """The items to search for, block by block; the driver never holds more than one."""
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"),
                             F.col(text_col).cast("string").alias("text")) \
        .filter(F.char_length("text") >= Q)
    chars = items.agg(F.coalesce(F.sum(F.char_length("text")), F.lit(0))).first()[0]
    n = -(-chars // BLOCK_CHARS)
    for k in range(n):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()
        if rows:
            yield sorted(((r.item_id, r.text) for r in rows), key=lambda r: (r[0] is None, r))


def matches(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, id_col: str = "doc_id",
            text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, edits, start, end): for each document and item found in it, its best
    stretch [start, end) in characters of the lower-cased text."""
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, edits int, start long, end long"
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = None
    for block in _blocks(benchmark, item_col, item_text_col):
        sent = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            matcher = Matcher([t for _, t in sent.value], rate)
            ids = [i for i, _ in sent.value]
            for b in batches:
                doc = b.column("doc_id").to_pylist()
                found = sorted(matcher.search(b.column("text").to_pylist()).items())
                yield batch(doc_id=pa.array([doc[i] for (i, _), _ in found], pa.int64()),
                            item_id=pa.array([ids[k] for (_, k), _ in found], pa.int64()),
                            edits=pa.array([v[0] for _, v in found], pa.int32()),
                            start=pa.array([v[1] for _, v in found], pa.int64()),
                            end=pa.array([v[2] for _, v in found], pa.int64()))

        part = map_batches(rows, run, schema)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], schema) if out is None else out


def clean(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that hold an item."""
    spark, at = docs.sparkSession, docs.columns.index(text_col)
    for block in _blocks(benchmark, item_col, item_text_col):
        sent = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            matcher = Matcher([t for _, t in sent.value], rate)
            for b in batches:
                hit = {i for i, _ in matcher.search(b.column(at).to_pylist())}
                yield b.filter(pa.array([i not in hit for i in range(b.num_rows)], pa.bool_()))

        docs = map_batches(docs, run, docs.schema)
    return docs
